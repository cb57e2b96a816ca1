"""Conformity of posts and candidates with the record rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from talentgrid import vocab
from talentgrid.functions import experience, levels
from talentgrid.functions.lookup import literal_table, lookup

Rules = dict[str, Column]
#: category -> terms, or a table (category, term), which may be of any size
Vocabulary = Mapping[str, Sequence[str]] | DataFrame
#: the lists that vocabularies cover, and their rules
LISTS = {"skills": "skills in vocabulary", "certificates": "certificates in vocabulary"}
#: a term is spread over as many parts as it makes up shares of this size of all terms used
SHARES = 5000


def with_category_rules(records: DataFrame, category: str) -> DataFrame:
    """Add what the rules on the size of lists ask of a record's category: fewest, most, skill_count.

    NULL where nothing is known of the category.
    """
    name = F.col(category)
    return records.withColumns({
        "fewest": lookup({k: low for k, (low, _) in vocab.CERTIFICATE_RANGES.items()}, name),
        "most": lookup({k: high for k, (_, high) in vocab.CERTIFICATE_RANGES.items()}, name),
        "skill_count": lookup(vocab.SKILL_COUNTS, name),
    })


def _term(column: Column) -> Column:
    """A term as a join key that is never NULL: a NULL element is a term no vocabulary holds."""
    return F.coalesce(F.concat(F.lit("="), column), F.lit(""))


def _vocabulary(spark: SparkSession, **vocabularies: Vocabulary) -> DataFrame:
    """(list, category, term) of all lists."""
    def table(name: str, held: Vocabulary) -> DataFrame:
        if not isinstance(held, DataFrame):
            rows = [(category, word) for category, words in held.items() for word in words or [None]]
            held = literal_table(spark, ["category", "term"], rows or [("", "")])
            held = held if rows else held.filter("false")
        term = F.concat(F.lit("="), F.col("term").cast("string"))  # NULL where a category is known to have no terms
        return held.filter(F.col("category").isNotNull()).select(F.lit(name).alias("list"), "category", term.alias("term"))

    return reduce(DataFrame.unionAll, [table(name, held) for name, held in vocabularies.items()])


def vocabulary_failures(lists: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(source, list, failed): records of each source with a term that their category's vocabulary lacks.

    ``lists`` has source, category, skills and certificates of each record.  The terms used are reduced
    to distinct ones before they meet the vocabulary, whatever its size; only those it lacks go on
    to the records.  A term that many records use is parted by record, and what it lacks is copied to each
    part: at most SHARES copies in all beyond one of each.
    """
    key = ["list", "category", "term"]
    cells = [F.struct(F.lit(name).alias("list"), F.col(name).alias("terms")) for name in LISTS]
    words = lists.filter(F.col("category").isNotNull()).select(
        F.monotonically_increasing_id().alias("record"), "source", "category", F.inline(F.array(*cells))
    ).select("record", "source", "list", "category", F.explode(F.array_distinct("terms")).alias("term"))
    words = words.withColumn("term", _term(F.col("term")))
    used = words.groupBy(*key).agg(F.count("*").alias("n"))
    share = F.col("n") * SHARES / used.agg(F.sum("n").alias("n")).scalar()
    used = used.withColumn("parts", F.ceil(share).cast("int"))
    hot = F.broadcast(used.filter(F.col("parts") > 1).select(*key, "parts"))  # SHARES rows at most
    lacking = (
        used.join(vocabulary, key, "left_anti")
        .join(vocabulary.select("list", "category").distinct(), ["list", "category"], "left_semi")
        .select(*key, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    )
    part = F.coalesce(F.pmod(F.xxhash64("record"), F.col("parts")).cast("int"), F.lit(0))
    found = words.join(hot, key, "left").withColumn("part", part).join(lacking, [*key, "part"])
    return (
        found.select("source", "list", "record").distinct()
        .groupBy("source", "list").agg(F.count("*").alias("failed"))
    )


def _list_rules(skills: str) -> Rules:
    """Rules on the sizes of the lists of records ``with_category_rules``."""
    return {
        "certificate count in range": F.size("certifications").between(F.col("fewest"), F.col("most")),
        "skill count exact": F.size(skills) == F.col("skill_count"),
    }


def _level_rules(level: str, salary: str, years: str) -> Rules:
    band = levels.salary_band_level(F.col(level))
    low, high = levels.salary_band(band)
    return {
        "salary in band": F.col(salary).between(low, high),
        "years allowed for level": F.array_contains(levels.years_texts(band), F.col(years)),
    }


def post_rules() -> Rules:
    """Rule name -> condition on a post; NULL where the rule says nothing about a row."""
    days = F.datediff("deadline", "post_date")
    return {
        "deadline after posting": days.between(*vocab.DEADLINE_DAYS),
        **_list_rules("skills_needed"),
        **_level_rules("detailed_experience_level", "salary", "years_experience"),
        "employment allowed for level": F.array_contains(
            levels.allowed_employment(levels.seniority_from_title(F.col("job_title"))),
            F.col("employment_type"),
        ),
        "language allowed in country": F.array_contains(
            levels.allowed_languages(F.col("country")), F.col("language")
        ),
    }


def candidate_rules() -> Rules:
    """Rule name -> condition on a candidate."""
    text = F.col("experience_range")
    fewest, most = experience.employer_range(experience.years_for_employers(text))
    since = vocab.RULE_YEAR - F.col("graduation_year") - experience.most_years(text)
    birth = F.col("date_of_birth").try_cast("int")
    return {
        **_list_rules("skills"),
        **_level_rules("seniority", "current_salary", "experience_range"),
        "employers in range": F.when(
            text.isNotNull(), F.size("previous_companies").between(fewest, most)
        ),
        "industry per employer": F.size("previous_industries") == F.size("previous_companies"),
        "graduation fits experience": F.when(
            text.isNotNull(), since.between(0, vocab.GRADUATION_GAP)
        ),
        "birth fits graduation": birth == F.col("graduation_year") - vocab.GRADUATION_AGE,
        "employer unless intern": (F.col("seniority") == "Internship") == (F.col("current_company") == ""),
    }


def _by_category(records: DataFrame, rules: Rules, category: str, skills: str) -> DataFrame:
    """One row for each category: its records, those with each list, and how many pass and fail each rule."""
    flags = records.select(
        F.col(category).alias("category"), F.col(skills).isNotNull().alias("has_skills"),
        F.col("certifications").isNotNull().alias("has_certificates"),
        *[rule.alias(f"r{at}") for at, rule in enumerate(rules.values())],
    )
    return flags.groupBy("category").agg(
        F.count("*").alias("rows"), *[F.count_if(f"has_{name}").alias(name) for name in LISTS],
        *[F.count_if(F.col(f"r{at}")).alias(f"p{at}") for at in range(len(rules))],
        *[F.count_if(~F.col(f"r{at}")).alias(f"f{at}") for at in range(len(rules))],
    )


def _rule_rows(counts: DataFrame, rules: Rules, source: str) -> DataFrame:
    """(source, rule, passed, failed, unknown) of the rules on single records."""
    sums = counts.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts.columns if name != "category"])

    def row(at: int, rule: str) -> Column:
        passed, failed = F.col(f"p{at}"), F.col(f"f{at}")
        return F.struct(
            F.lit(rule).alias("rule"), passed.alias("passed"), failed.alias("failed"),
            (F.col("rows") - passed - failed).alias("unknown"),
        )

    return sums.select(F.lit(source).alias("source"), F.inline(F.array(*[row(*pair) for pair in enumerate(rules)])))


def conformity_report(
    posts: DataFrame, candidates: DataFrame, skills: Vocabulary, certificates: Vocabulary
) -> DataFrame:
    """Pass and fail counts of every rule over both tables.

    A list conforms if its category's vocabulary holds all of it; without a list, or where no
    vocabulary knows the category, that is unknown.
    """
    spark = posts.sparkSession
    vocabulary = _vocabulary(spark, skills=skills, certificates=certificates)
    tables = {
        "job_posts": (posts, post_rules(), "category", "skills_needed"),
        "candidate_info": (candidates, candidate_rules(), "job_category", "skills"),
    }
    reports, lists, held = [], [], []
    for source, (records, rules, category, skill_list) in tables.items():
        counts = _by_category(with_category_rules(records, category), rules, category, skill_list)
        reports.append(_rule_rows(counts, rules, source))
        cells = [F.struct(F.lit(name).alias("list"), F.col(name).alias("listed")) for name in LISTS]
        held.append(counts.select(F.lit(source).alias("source"), "category", "rows", F.inline(F.array(*cells))))
        lists.append(records.select(
            F.lit(source).alias("source"), F.col(category).alias("category"), F.col(skill_list).alias("skills"),
            F.col("certifications").alias("certificates"),
        ))
    known = vocabulary.select("list", "category").distinct().withColumn("known", F.lit(True))
    sizes = (
        reduce(DataFrame.unionAll, held).join(known, ["list", "category"], "left").groupBy("source", "list")
        .agg(F.sum("rows").alias("rows"), F.coalesce(F.sum(F.when(F.col("known"), F.col("listed"))), F.lit(0)).alias("judged"))
    )
    failures = vocabulary_failures(reduce(DataFrame.unionAll, lists), vocabulary)
    names = literal_table(spark, ["source", "list", "rule"], [(s, name, rule) for s in tables for name, rule in LISTS.items()])
    failed, judged, rows = (F.coalesce(name, F.lit(0)) for name in ("failed", "judged", "rows"))
    reports.append(
        names.join(sizes, ["source", "list"], "left").join(failures, ["source", "list"], "left").select(
            "source", "rule", (judged - failed).alias("passed"), failed.alias("failed"), (rows - judged).alias("unknown")
        )
    )
    return reduce(DataFrame.unionAll, reports)
