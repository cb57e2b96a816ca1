"""Category -> job family: the dimension, the enrichment and its fan-out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from talentgrid import vocab
from talentgrid.functions.lookup import literal_table

Families = Mapping[str, Sequence[str]]


def family_table(spark: SparkSession, families: Families = vocab.FAMILY_CATEGORIES) -> DataFrame:
    """(category, family_group) rows of a family -> categories mapping."""
    pairs = [(category, family) for family, members in families.items() for category in members]
    return literal_table(spark, ["category", "family_group"], pairs)


def mapped_categories(families: Families = vocab.FAMILY_CATEGORIES) -> list[str]:
    return sorted({category for members in families.values() for category in members})


def with_family(
    records: DataFrame,
    category: str,
    family: str,
    families: Families = vocab.FAMILY_CATEGORIES,
) -> DataFrame:
    """Left-join the family: one row per family, NULL for an unmapped category.

    The mapping is a literal of a few dozen rows, so broadcasting it is safe at
    any data size; it works on a stream as well.
    """
    mapping = family_table(records.sparkSession, families).select(
        F.col("category").alias("_category"), F.col("family_group").alias(family)
    )
    joined = records.join(F.broadcast(mapping), records[category] == mapping["_category"], "left")
    return joined.drop("_category")


def family_pairs(
    candidates: DataFrame, posts: DataFrame, families: Families = vocab.FAMILY_CATEGORIES
) -> DataFrame:
    """Size of the family equi-join, counted without forming a single pair.

    Both sides are reduced to one count per (family, category) first; the number
    of pairs is then a product of counts.
    """
    have = (
        with_family(candidates.select("job_category"), "job_category", "family", families)
        .filter(F.col("family").isNotNull())
        .groupBy("family", F.col("job_category").alias("category"))
        .agg(F.count("*").alias("candidates"))
    )
    need = (
        with_family(posts.select("category"), "category", "family", families)
        .filter(F.col("family").isNotNull())
        .groupBy("family", "category")
        .agg(F.count("*").alias("posts"))
    )
    per_category = have.join(need, ["family", "category"], "full").select(
        "family",
        F.coalesce("candidates", F.lit(0)).alias("candidates"),
        F.coalesce("posts", F.lit(0)).alias("posts"),
    )
    return (
        per_category.groupBy("family")
        .agg(
            F.sum("candidates").alias("candidates"),
            F.sum("posts").alias("posts"),
            F.sum(F.col("candidates") * F.col("posts")).alias("same_category_pairs"),
        )
        .withColumn("family_pairs", F.col("candidates") * F.col("posts"))
    )
