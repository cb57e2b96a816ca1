"""Column rules on hand-written edge tables."""

import pytest
from pyspark.sql import functions as F

from talentgrid import vocab
from talentgrid.functions import bands, draws, experience, levels, lookup, scoring
from harness import rules

TEXTS = [None, "", "0 years", "3 years", "3-5 years", "10+ years", "5 to 7 years", "3-", "+", " 3-5 YEARS ",
         "1-2-3 years", "years", "12-15 years"]


def values(spark, rows, schema, **columns):
    frame = spark.createDataFrame(rows, schema)
    return [tuple(row) for row in frame.select(*[c.alias(n) for n, c in columns.items()]).collect()]


def test_year_bounds(spark):
    low, high = experience.year_bounds(F.col("t"))
    got = values(spark, [(t,) for t in TEXTS], "t string", low=low, high=high)
    assert got == [rules.bounds(t) for t in TEXTS]


def test_most_years(spark):
    cases = {"3-5 years": 5, "10+ years": 12, "0-2 years": 2, "15-20 years": 20, "3 years": 3, "years": 0,
             "3-": 0, "": 0, None: 0, "7 - 9 years": 9}
    got = values(spark, [(t,) for t in cases], "t string", y=experience.most_years(F.col("t")))
    assert [row[0] for row in got] == list(cases.values())


def test_employer_range(spark):
    cases = {0: (0, 1), 1: (0, 2), 2: (0, 2), 3: (1, 3), 5: (1, 3), 7: (2, 4), 10: (3, 5), 15: (4, 6), 20: (5, 8),
             21: (6, 10)}
    low, high = experience.employer_range(F.col("y"))
    assert values(spark, [(y,) for y in cases], "y int", low=low, high=high) == list(cases.values())


TITLES = [
    ("Internal Auditor", "Internship", "Internship"),
    ("Vice President of Engineering", "Engineer", "Director/VP"),
    ("Vice President of Sales", "Mid Level", "Director/VP"),
    ("Chief Technology Officer (CTO)", "C-Level Executive (CXO)", "C-Level Executive (CXO)"),
    ("Accountant", "Mid Level", "Director/VP"),
    ("Quality Control Inspector", "Mid Level", "Director/VP"),
    ("Engineering Manager", "Manager", "Manager"),
    ("Sr. Analyst", "Analyst", "Senior"),
    ("Web Developer", "Mid Level", "Mid Level"),
    ("Junior Developer", "Junior", "Junior"),
    ("Graduate Trainee", "Mid Level", "Internship"),
    ("Bookkeeper", "Mid Level", "Internship"),
    ("Head of Data", "Head", "Director/VP"),
]


@pytest.mark.parametrize("title, seniority, level", TITLES)
def test_titles(spark, title, seniority, level):
    got = values(
        spark, [(title, "Accounting & Finance")], "t string, c string",
        s=levels.seniority_from_title(F.col("t")), l=levels.level_from_title(F.col("t"), F.col("c")),
    )
    assert got == [(seniority, level)]


def test_strict_words(spark):
    got = values(
        spark, [("Accountant", "Consulting"), ("CTO", "Consulting"), ("Sr. Clerk", "Consulting")], "t string, c string",
        l=levels.level_from_title(F.col("t"), F.col("c"), strict_words=True),
    )
    assert [row[0] for row in got] == ["Internship", "Director/VP", "Senior"]


def test_salary_band(spark):
    band = levels.salary_band_level(F.col("t"))
    got = values(spark, [("senior",), ("Director/VP",), ("wizard",), (None,)], "t string",
                 b=band, low=levels.salary_band(band)[0], high=levels.salary_band(band)[1])
    assert got == [("Senior", 100000, 150000), ("Director", 150000, 220000), (None, 0, 0), (None, 0, 0)]


def test_salary_points(spark):
    cases = {(0., 0.): 10, (None, 50.): 10, (100., 120.): 10, (100., 100.): 8, (100., 90.): 6, (100., 70.): 3,
             (100., 69.): 0, (100., None): 0}
    got = values(spark, list(cases), "c double, j double", s=scoring.salary_points(
        F.coalesce("c", F.lit(0.0)), F.coalesce("j", F.lit(0.0))))
    assert [row[0] for row in got] == list(cases.values())


SIDES = [
    ("A", None, None, None, None),
    ("A", [], "0 years", "Junior", 0.0),
    ("A", [None], "3-5 years", "senior", 100.0),
    ("A", ["sql", "SQL", "Spark"], "10+ years", "Mid Level", 120.0),
    ("A", ["SQL", "spark", "Python", "Go"], "5 to 7 years", "Chief", 90.0),
    ("B", ["sql", "spark", "python"], "3-", "Vice President", 70.0),
    (None, ["sql"], "+", "", 69.0),
]
SIDE = "category string, skills array<string>, years string, level string, salary double"


def test_score_of_raw_pairs(spark):
    c = spark.createDataFrame(SIDES, SIDE).select([F.col(n).alias("c_" + n) for n in
                                                   ("category", "skills", "years", "level", "salary")])
    p = spark.createDataFrame(SIDES, SIDE)
    pairs = c.crossJoin(p)
    names = ("category", "skills", "years", "level", "salary")
    pairs = pairs.withColumn("score", scoring.compatibility_score(
        {n: F.col("c_" + n) for n in names}, {n: F.col(n) for n in names}))
    seen = 0
    for row in pairs.collect():
        left, right = tuple(row["c_" + n] for n in names), tuple(row[n] for n in names)
        assert row["score"] == rules.score(left, right), (left, right)
        seen += 1
    assert seen == len(SIDES) ** 2


def test_reasons_of_raw_pairs(spark):
    names = ("category", "skills", "years", "level", "salary")
    c = spark.createDataFrame(SIDES, SIDE).select([F.col(n).alias("c_" + n) for n in names])
    shared = F.array_intersect(scoring.skill_set(F.col("c_skills")), scoring.skill_set(F.col("skills")))
    pairs = c.crossJoin(spark.createDataFrame(SIDES, SIDE)).withColumn(
        "reason",
        scoring.match_reason(
            F.coalesce(F.col("c_category") == F.col("category"), F.lit(False)),
            F.coalesce(F.size(shared), F.lit(0)),
            scoring.name_skills(shared),
            experience.year_bounds(F.col("c_years"))[0],
            experience.year_bounds(F.col("years"))[0],
            F.lower("c_level"),
            F.lower("level"),
        ),
    )
    told = set()
    for row in pairs.filter("c_category IS NOT NULL OR category IS NOT NULL").collect():
        left, right = tuple(row["c_" + n] for n in names), tuple(row[n] for n in names)
        assert row["reason"] == rules.reason(left, right), (left, right)
        told.add(row["reason"])
    assert "Career growth opportunity" in told


@pytest.mark.parametrize("score, days, options", [
    (80, 7, ["Under Review", "Interview Scheduled", "Shortlisted"]),
    (80, 8, ["Applied", "Under Review", "Shortlisted"]),
    (60, 0, ["Applied", "Under Review", "Shortlisted"]),
    (59, 0, ["Applied", "Under Review", "Rejected"]),
])
def test_status_by_tier(spark, score, days, options):
    at = spark.range(3).select(scoring.application_status(F.lit(score), F.lit(days), (F.col("id") + 0.5) / 3).alias("s"))
    assert [row.s for row in at.collect()] == options


def test_status_without_dates(spark):
    none = F.lit(None).cast("int")
    assert spark.range(1).select(scoring.application_status(F.lit(95), none, F.lit(0.9))).first()[0] == "Applied"


def test_time_bands(spark):
    hours = [(f"2024-03-01 {h:02d}:59:59",) for h in range(24)]
    got = values(spark, hours, "t string", b=bands.time_band_label(bands.time_band_index(F.col("t"))))
    assert [row[0] for row in got] == [vocab.TIME_BANDS[h // 3] for h in range(24)]


def test_age_bands(spark):
    got = values(spark, [(24,), (25,), (34,), (35,), (49,), (50,), (None,)], "a int", b=bands.age_band(F.col("a")))
    assert [row[0] for row in got] == ["under 25", "25-34", "25-34", "35-49", "35-49", "50 and over", None]


def test_constants_keep_quotes_and_backslashes(spark):
    table = {"it's": "a\\b", "\"x\"": "c'd"}
    got = values(spark, [(key,) for key in table] + [(None,)], "k string", v=lookup.lookup(table, F.col("k"), "none"))
    assert [row[0] for row in got] == ["a\\b", "c'd", "none"]


def test_pair_draws_are_even_and_unrelated(spark):
    pairs = spark.range(400).withColumnRenamed("id", "c").crossJoin(spark.range(400).withColumnRenamed("id", "p"))
    residue = draws.pair_residue(
        draws.seed(draws.digest(F.concat(F.lit("cand-"), F.col("c").cast("string")))),
        draws.seed(draws.digest(F.concat(F.lit("post-"), F.col("p").cast("string")))),
    )
    units = [draws.pair_unit(residue, draws.seed(draws.digest(F.lit(name)))) for name in ("one", "two")]
    rows = pairs.select("c", units[0].alias("u"), units[1].alias("v"))
    row = rows.agg(
        F.avg("u"), F.avg((F.col("u") < 0.2).cast("int")), F.avg((F.col("u") < 0.8).cast("int")),
        F.avg(((F.col("u") < 0.5) & (F.col("v") < 0.5)).cast("int")), F.corr("u", "v"),
    ).first()
    assert all(abs(got - want) < 0.01 for got, want in zip(row, (0.5, 0.2, 0.8, 0.25, 0.0)))
    per_candidate = rows.groupBy("c").agg(F.avg((F.col("u") < 0.5).cast("int")).alias("rate"))
    low, high = per_candidate.agg(F.min("rate"), F.max("rate")).first()
    assert 0.38 < low and high < 0.62


def test_sample_has_no_position_twice(spark):
    frame = spark.createDataFrame([(i, list("abcdefgh")) for i in range(50)], "k int, items array<string>")
    rows = frame.select(draws.sample(F.col("items"), F.lit(5), F.col("k").cast("string")).alias("s")).collect()
    assert all(len(set(row.s)) == 5 for row in rows)
    assert len({tuple(row.s) for row in rows}) > 40


def test_dimensions_have_the_published_sizes(spark):
    from talentgrid.sources.dimensions import dimensions, register

    sizes = {name: rows.count() for name, rows in dimensions(spark).items()}
    assert sizes["category_family"] == 39 and sizes["title_keyword"] == 21 and sizes["salary_band"] == 22
    assert sizes["level_years"] == 22 and sizes["employment_rule"] == 21 and sizes["category_counts"] == 20
    assert sizes["seniority_rank"] == 21 and sizes["industry_weight"] == 18 * 6 and sizes["education_weight"] == 32
    register(spark)
    assert spark.sql("SELECT count(DISTINCT family_group) FROM category_family").first()[0] == 14
    assert spark.sql("SELECT count(DISTINCT country) FROM country_language").first()[0] == len(vocab.COUNTRY_LANGUAGES)


def test_time_bands_of_any_zone(spark):
    moments = spark.range(-400, 400).select(F.timestamp_seconds(F.col("id") * 4321 + 1711846800).alias("t")).unionAll(
        spark.range(-50, 50).select(F.timestamp_micros(F.col("id") * 3_600_000_007))  # also before 1970
    )
    for zone in ("UTC", "Europe/Berlin", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            wrong = moments.filter(bands.time_band_index(F.col("t")) != F.floor(F.hour("t") / 3))
            assert wrong.isEmpty()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    plan = moments.select(bands.time_band_index(F.col("t")).alias("band"))._jdf.queryExecution().optimizedPlan().toString()
    assert "hour(" not in plan
