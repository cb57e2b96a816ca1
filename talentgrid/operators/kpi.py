"""Market indicators over applications, job posts and candidates.

Each indicator is a small DataFrame.  Rows are reduced to counts by a map-side
combine first; everything after that (shares, quartiles, orderings) works on the
counts.  Indicators skip NULL keys.  ``weight`` names a column that says how many rows a
row stands for, so that tables of counts give the same indicators as the rows counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from talentgrid.functions.bands import equal_width_bin, time_band_index, time_band_label
from talentgrid.functions.lookup import literal_list

SCORE_BINS, SCORE_BIN_WIDTH = 20, 5
SALARY_BINS = 30
RECENT_COLUMNS = [
    "application_id", "candidate_id", "post_id", "compatibility_score", "status",
    "application_method", "timestamp",
]


def _scalar(table: DataFrame, value: Column) -> Column:
    """One aggregate value of a table, usable beside rows of another one."""
    return table.agg(value.alias("value")).scalar()


def _rows(weight: str | None) -> Column:
    """Number of rows, each standing for ``weight`` of them if given."""
    return F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0).cast("bigint"))


def totals(applications: DataFrame, posts: DataFrame, candidates: DataFrame) -> DataFrame:
    """The headline numbers, one row; an absent column gives NULL or 0."""
    columns = applications.columns
    score = F.avg("compatibility_score") if "compatibility_score" in columns else F.lit(None).cast("double")
    listed = F.count_if(F.col("status") == "Shortlisted") if "status" in columns else F.lit(0).cast("bigint")
    return applications.agg(
        F.count("*").alias("total_applications"),
        F.round(score, 1).alias("avg_match_score"),
        F.coalesce(listed, F.lit(0)).alias("shortlisted"),
    ).select(
        "*",
        _scalar(posts, F.count("*")).alias("total_job_posts"),
        _scalar(candidates, F.count("*")).alias("total_candidates"),
    )


def cards(totals_row: DataFrame) -> DataFrame:
    """The headline numbers as shown: thousands separators, one decimal, "N/A" where unknown."""

    def card(name: str, text: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), text.alias("shown"))

    return totals_row.select(
        F.inline(
            F.array(
                card("Total Applications", F.format_number("total_applications", 0)),
                card("Active Job Posts", F.format_number("total_job_posts", 0)),
                card("Active Candidates", F.format_number("total_candidates", 0)),
                card(
                    "Avg Match Score",
                    F.when(F.col("avg_match_score").isNull(), "N/A").otherwise(
                        F.format_string("%.1f%%", "avg_match_score")
                    ),
                ),
                card("Shortlisted", F.format_number("shortlisted", 0)),
            )
        )
    )


def source_counts(**tables: DataFrame) -> DataFrame:
    """(source, rows) of any number of tables."""
    counts = [
        table.agg(F.count("*").alias("rows")).select(F.lit(name).alias("source"), "rows")
        for name, table in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionAll(other)
    return out


def value_counts(table: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """(column, n), NULL keys dropped."""
    return (
        table.filter(F.col(column).isNotNull()).groupBy(column).agg(_rows(weight).alias("n"))
    )


def value_shares(table: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """(column, n, percent of all counted rows)."""
    counts = value_counts(table, column, weight)
    total = _scalar(counts, F.sum("n"))
    return counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, 2))


def top_values(table: DataFrame, column: str, k: int, weight: str | None = None) -> DataFrame:
    """The ``k`` most frequent values; ties go to the smaller value."""
    return value_counts(table, column, weight).orderBy(F.desc("n"), column).limit(k)


def top_families(applications: DataFrame, k: int = 10, weight: str | None = None) -> DataFrame:
    return top_values(applications, "job_post_family_group", k, weight)


def top_countries(posts: DataFrame, k: int = 15) -> DataFrame:
    return top_values(posts, "country", k)


def by_time_band(applications: DataFrame) -> DataFrame:
    """(band, time_interval, applications) in day order; bands without rows are absent."""
    band = time_band_index(F.col("application_date"))
    return (
        applications.select(band.alias("band"))
        .filter(F.col("band").isNotNull())
        .groupBy("band")
        .agg(F.count("*").alias("applications"))
        .select("band", time_band_label(F.col("band")).alias("time_interval"), "applications")
        .orderBy("band")
    )


def peak_band(applications: DataFrame) -> DataFrame:
    """The busiest band; ties go to the earlier one."""
    return by_time_band(applications).orderBy(F.desc("applications"), "band").limit(1)


def _score_bin(score: Column) -> Column:
    top = SCORE_BINS * SCORE_BIN_WIDTH
    return equal_width_bin(score.cast("double"), F.lit(0.0), F.lit(float(top)), SCORE_BINS)


def score_histogram(applications: DataFrame, weight: str | None = None) -> DataFrame:
    """(bin, bin_from, bin_to, n): 20 bins of width 5 over [0, 100], the last one closed."""
    return (
        applications.withColumn("bin", _score_bin(F.col("compatibility_score")))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(_rows(weight).alias("n"))
        .select(
            "bin",
            (F.col("bin") * SCORE_BIN_WIDTH).alias("bin_from"),
            ((F.col("bin") + 1) * SCORE_BIN_WIDTH).alias("bin_to"),
            "n",
        )
    )


def salary_histogram(posts: DataFrame, bins: int = SALARY_BINS) -> DataFrame:
    """(bin, bin_from, bin_to, n) over the positive salaries, equal widths from min to max."""
    paid = posts.filter(F.col("salary") > 0).select("salary")
    low, high = _scalar(paid, F.min("salary")), _scalar(paid, F.max("salary"))
    width = (high - low) / bins
    return (
        paid.select(equal_width_bin(F.col("salary"), low, high, bins).alias("bin"))
        .groupBy("bin")
        .agg(F.count("*").alias("n"))
        .select(
            "bin",
            F.round(low + F.col("bin") * width, 2).alias("bin_from"),
            F.round(low + (F.col("bin") + 1) * width, 2).alias("bin_to"),
            "n",
        )
    )


def score_box(applications: DataFrame, weight: str | None = None) -> DataFrame:
    """Box statistics of the score per status: quartiles, whiskers at 1.5 IQR, outliers.

    Scores are whole numbers from 0 to 100, so the (status, score) counts hold at
    most 101 rows per status; quartiles, whiskers and outliers all come from them.
    """
    counts = (
        applications.filter(F.col("status").isNotNull() & F.col("compatibility_score").isNotNull())
        .groupBy("status", F.col("compatibility_score").alias("score"))
        .agg(_rows(weight).alias("n"))
    )
    boxes = counts.groupBy("status").agg(
        F.sum("n").alias("n"),
        F.min("score").alias("min"),
        F.percentile("score", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("n")).alias("q"),
        F.max("score").alias("max"),
    ).select(
        "status", "n", "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"), "max",
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("score").between(F.col("q1") - reach, F.col("q3") + reach)
    ends = (
        counts.withColumnRenamed("n", "score_n")
        .join(boxes, "status")
        .groupBy("status")
        .agg(
            F.min(F.when(inside, F.col("score"))).alias("lower_whisker"),
            F.max(F.when(inside, F.col("score"))).alias("upper_whisker"),
            F.sum(F.when(inside, 0).otherwise(F.col("score_n"))).alias("outliers"),
        )
    )
    return boxes.join(ends, "status").select(
        "status", "n", "min", F.round("q1", 3).alias("q1"), F.round("median", 3).alias("median"),
        F.round("q3", 3).alias("q3"), "max", "lower_whisker", "upper_whisker", "outliers",
    )


def recent(applications: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` newest applications with those display columns that exist."""
    shown = [name for name in RECENT_COLUMNS if name in applications.columns]
    order = [F.desc("timestamp")] if "timestamp" in shown else []
    order += [F.asc("application_id")] if "application_id" in shown else []
    table = applications.select(*shown)
    return (table.orderBy(*order) if order else table).limit(n)


def _tally(table: DataFrame, weight: str | None = None, **keys: Column) -> DataFrame:
    """(kpi, key, n) for several keys of a table in one scan and one shuffle."""
    cells = [
        F.struct(F.lit(kpi).alias("kpi"), key.cast("string").alias("key"))
        for kpi, key in keys.items()
    ]
    weights = [weight] if weight else []
    return (
        table.select(*weights, F.inline(F.array(*cells)))
        .filter(F.col("key").isNotNull())
        .groupBy("kpi", "key")
        .agg(_rows(weight).alias("n"))
    )


#: for a column of texts, the column that holds their places in a list, and that list
Codes = Mapping[str, tuple[str, Sequence[str]]]


def application_tally(applications: DataFrame, codes: Codes | None = None) -> DataFrame:
    """All counted indicators of applications; also runs on a stream.

    On tables the few combinations of keys are counted first, so an application is one row and not one
    for each indicator.  Columns named in ``codes`` are counted by their codes there, which cost less than
    texts, and read as texts afterwards.
    """
    codes = codes or {}

    def key(column: str) -> Column:
        return F.col(codes[column][0] if column in codes else column)

    def text(column: str, name: str) -> Column:
        return F.get(literal_list(codes[column][1]), F.col(name)) if column in codes else F.col(name)

    score = F.col("compatibility_score")
    whole = dict(applications.dtypes)["compatibility_score"] == "int"  # few values, put into bins once counted
    keys = {
        "band": time_band_index(F.col("application_date")),
        "family": key("job_post_family_group"),
        "score": score if whole else _score_bin(score),
        "status": key("status"),
    }
    applications = applications.select(*(key.alias(name) for name, key in keys.items()))
    weight = None
    if not applications.isStreaming:
        weight = "rows"
        applications = applications.groupBy(*keys).agg(F.count("*").alias(weight))
    return _tally(
        applications,
        weight,
        applications=F.lit("all"),
        time_band=time_band_label(F.col("band")),
        job_family=text("job_post_family_group", "family"),
        score_bin=_score_bin(F.col("score")) if whole else F.col("score"),
        status=text("status", "status"),
    )


def report(
    applications: DataFrame, posts: DataFrame, candidates: DataFrame, codes: Codes | None = None
) -> DataFrame:
    """Every counted indicator as (kpi, key, n): each table is scanned once.  ``codes`` as in :func:`application_tally`."""
    on_posts = _tally(
        posts,
        job_posts=F.lit("all"),
        work_mode=F.col("work_mode"),
        employment_type=F.col("employment_type"),
        country=F.col("country"),
    )
    on_candidates = _tally(
        candidates, candidates=F.lit("all"), education_level=F.col("education_level")
    )
    return application_tally(applications, codes).unionAll(on_posts).unionAll(on_candidates)


#: what a tally of applications is grouped by; every application is in each of the three kinds once
TALLY = "kind string, key string, score int, n bigint"


def joint_tally(applications: DataFrame) -> DataFrame:
    """(kind, key, score, n): counts that all indicators of applications follow from; also runs on a stream.

    ``status`` counts are by status and score, so that means, shares and boxes follow from them;
    ``time_band`` and ``job_family`` counts are by that key.  NULL keys are counted too.
    """
    none = F.lit(None).cast("int")

    def cell(kind: str, key: Column, score: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), score.alias("score"))

    cells = F.array(
        cell("status", F.col("status"), F.col("compatibility_score").cast("int")),
        cell("time_band", time_band_index(F.col("application_date")), none),
        cell("job_family", F.col("job_post_family_group"), none),
    )
    return applications.select(F.inline(cells)).groupBy("kind", "key", "score").agg(F.count("*").alias("n"))


def indicators_of(tally: DataFrame) -> DataFrame:
    """(indicator, key, n, value): every indicator of applications from a joint tally.

    Totals and shares as :func:`totals`, :func:`value_shares`, :func:`score_histogram`, :func:`top_families`,
    :func:`by_time_band`, :func:`peak_band` and :func:`score_box` give them; a box has a row for each of its numbers.
    """
    by_status = tally.filter("kind = 'status'").select(
        F.col("key").alias("status"), F.col("score").alias("compatibility_score"), "n"
    )
    bands = tally.filter("kind = 'time_band'").select(F.col("key").cast("int").alias("band"), "n")
    families = tally.filter("kind = 'job_family'").select(F.col("key").alias("job_post_family_group"), "n")
    scored = F.when(F.col("compatibility_score").isNotNull(), F.col("n"))
    mean = F.sum(F.col("compatibility_score") * scored) / F.sum(scored)
    listed = F.sum(F.when(F.col("status") == "Shortlisted", F.col("n")))
    nothing, no_value = F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def row(indicator: str, key: Column, n: Column = nothing, value: Column = no_value) -> Column:
        return F.struct(
            F.lit(indicator).alias("indicator"), key.cast("string").alias("key"),
            n.cast("bigint").alias("n"), value.cast("double").alias("value"),
        )

    def rows(table: DataFrame, *cells: Column) -> DataFrame:
        return table.select(F.inline(F.array(*cells)))

    whole = by_status.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.round(mean, 1).alias("mean"), F.coalesce(listed, F.lit(0)).alias("listed")
    )
    labelled = value_counts(bands, "band", "n")
    label = time_band_label(F.col("band"))
    box = ["n", "min", "q1", "median", "q3", "max", "lower_whisker", "upper_whisker", "outliers"]
    return (
        rows(
            whole, row("total_applications", F.lit("all"), F.col("n")),
            row("avg_match_score", F.lit("all"), value=F.col("mean")), row("shortlisted", F.lit("all"), F.col("listed")),
        )
        .unionAll(rows(labelled, row("time_band", label, F.col("n"))))
        .unionAll(rows(labelled.orderBy(F.desc("n"), "band").limit(1), row("peak_band", label, F.col("n"))))
        .unionAll(rows(top_families(families, weight="n"), row("job_family", F.col("job_post_family_group"), F.col("n"))))
        .unionAll(rows(score_histogram(by_status, "n"), row("score_bin", F.col("bin"), F.col("n"))))
        .unionAll(rows(value_shares(by_status, "status", "n"), row("status", F.col("status"), F.col("n"), F.col("percent"))))
        .unionAll(rows(
            score_box(by_status, "n"),
            *[row(f"score_{name}", F.col("status"), value=F.col(name)) for name in box],
        ))
    )
