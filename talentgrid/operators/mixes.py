"""Observed against expected shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from talentgrid import vocab
from talentgrid.functions.bands import age_band
from talentgrid.functions.lookup import literal_table


def _against(observed: DataFrame, expected: DataFrame, group: str, member: str) -> DataFrame:
    """Join counts with weights; shares are percentages within ``group``.

    Both inputs are aggregates.  A member only one side knows is kept with a zero
    on the other.
    """
    within = Window.partitionBy(group)
    return (
        observed.join(expected, [group, member], "full")
        .select(
            group,
            member,
            F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("weight", F.lit(0)).alias("weight"),
        )
        .withColumn("total", F.sum("n").over(within))
        .withColumn("weights", F.sum("weight").over(within))
        .select(
            group,
            member,
            "n",
            F.coalesce(F.round(F.col("n") * 100.0 / F.nullif("total", F.lit(0)), 2), F.lit(0.0)).alias("observed"),
            F.coalesce(F.round(F.col("weight") * 100.0 / F.nullif("weights", F.lit(0)), 2), F.lit(0.0)).alias("expected"),
        )
        .withColumn("difference", F.round(F.col("observed") - F.col("expected"), 2))
    )


def education_mix(candidates: DataFrame) -> DataFrame:
    """Education levels per age band against the band's weights."""
    age = F.lit(vocab.RULE_YEAR) - F.col("date_of_birth").try_cast("int")
    observed = (
        candidates.select(age_band(age).alias("age_band"), "education_level")
        .filter(F.col("age_band").isNotNull() & F.col("education_level").isNotNull())
        .groupBy("age_band", "education_level")
        .agg(F.count("*").alias("n"))
    )
    weights = [
        (band, level, weight)
        for band, (_, row) in vocab.EDUCATION_WEIGHTS.items()
        for level, weight in zip(vocab.EDUCATION_LEVELS, row)
    ]
    expected = literal_table(
        candidates.sparkSession, ["age_band", "education_level", "weight"], weights
    )
    return _against(observed, expected, "age_band", "education_level")


def continent_mix(posts: DataFrame) -> DataFrame:
    """Continents per industry against the industry's weights; unnamed industries share the default."""
    known = F.col("industry").isin([name for name in vocab.CONTINENT_WEIGHTS if name != "default"])
    observed = (
        posts.filter(F.col("continent").isNotNull())
        .groupBy(F.when(known, F.col("industry")).otherwise("default").alias("industry"), "continent")
        .agg(F.count("*").alias("n"))
    )
    weights = [
        (industry, continent, weight)
        for industry, row in vocab.CONTINENT_WEIGHTS.items()
        for continent, weight in zip(vocab.CONTINENTS, row)
    ]
    expected = literal_table(posts.sparkSession, ["industry", "continent", "weight"], weights)
    return _against(observed, expected, "industry", "continent")
