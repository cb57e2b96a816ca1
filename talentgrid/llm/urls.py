"""URL filters: allow and block rules matched by hashed host-suffix and path-prefix expressions.

A rule is a host and the beginning of a path.  Each URL is expanded into the expressions it could
match: a suffix of its host, as many labels as some rule's host has, joined to as long a
beginning of its path as some rule with such a host has.  Expressions meet the rules by an
equi-join on the first PREFIX hex digits of their SHA-256 digests; the full digests then
confirm a match.  The longest matching rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentgrid.llm.frames import pick

#: Hex digits that are joined on; parts that a hot expression is dealt to.
PREFIX, SALTS = 8, 16


def host_of(url: Column) -> Column:
    """What lies between the first :// and the next /, ? or #, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def verdicts(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page's url.

    ``rules`` has columns host, path and verdict ("allow" or "block").  A rule fits its host and
    all hosts below it, if the url's path starts with the rule's path.  Of several the longest
    text of host and path wins, then the longest host, then block.  Where no rule fits, rule is
    null and the verdict is ``default``; so it is for a null url and one without ://, whose
    host and path are empty.  Repeated pages stay; rules with nulls fit nothing.
    """
    found = pick(pages, "page_id", "url").select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    known = pick(rules, "host", "path", "verdict").dropna().select(
        F.concat("host", "path").alias("rule"), "verdict", F.char_length("host").alias("host_chars"),
        (F.size(F.split("host", r"\.")) - 1).alias("dots"), F.char_length("path").alias("path_chars"),
    ).withColumn("digest", F.sha2(F.concat_ws("\n", "rule", "host_chars"), 256))
    # pairs of host labels and path length that some rule has: bounded by the lengths of rules
    shapes = known.agg(F.collect_set(F.struct("dots", "path_chars")).alias("shapes")).scalar()
    asked = found.select("page_id", "url", "host", "path").distinct().withColumn("shape", F.explode(shapes))
    labels = F.expr("substring_index(host, '.', -(shape.dots + 1))")
    dots = F.char_length("host") - F.char_length(F.translate("host", ".", ""))
    asked = asked.withColumn("suffix", labels).filter(
        (F.char_length("path") >= F.col("shape.path_chars")) & (dots >= F.col("shape.dots"))
    )
    expression = F.concat("suffix", F.substring("path", F.lit(1), F.col("shape.path_chars")))
    asked = asked.select(
        "page_id", "url", F.sha2(F.concat_ws("\n", expression, F.char_length("suffix")), 256).alias("asked"),
        F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).alias("salt"),
    ).withColumn("prefix", F.left("asked", F.lit(PREFIX)))
    listed = known.withColumn("prefix", F.left("digest", F.lit(PREFIX))).withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint")))
    )
    best = F.max(F.struct(
        F.char_length("rule").alias("chars"), "host_chars", (F.col("verdict") == "block").alias("block"), "rule", "verdict"
    )).alias("best")
    decided = asked.join(listed, ["prefix", "salt"]).filter("asked = digest").groupBy(
        F.col("page_id").alias("of_page"), F.col("url").alias("of_url")
    ).agg(best)
    same = F.col("page_id").eqNullSafe(F.col("of_page")) & F.col("url").eqNullSafe(F.col("of_url"))
    return found.join(decided, same, "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
