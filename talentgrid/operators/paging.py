"""Sorted pages of a table."""

from __future__ import annotations

import json
from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame, Row, SparkSession, Window, functions as F, types as T

PAGE_SIZES = (10, 25, 50, 100)


def _order(field: str, ascending: bool, key: str) -> list:
    first = F.col(field).asc_nulls_last() if ascending else F.col(field).desc_nulls_last()
    return [first] if field == key else [first, F.col(key).asc()]


def sort_rows(table: DataFrame, field: str, ascending: bool, key: str) -> DataFrame:
    """Sort by any column in either direction; ``key`` breaks ties."""
    return table.orderBy(*_order(field, ascending, key))


def page(
    table: DataFrame, field: str, key: str, number: int, size: int = PAGE_SIZES[0], ascending: bool = True
) -> DataFrame:
    """Page ``number`` (from 1) of the sorted table.

    Offset and limit over a sort become a distributed top-k: each task keeps the first
    ``number * size`` rows at most, and one task merges them.  For deep pages use
    :func:`page_after`.
    """
    return sort_rows(table, field, ascending, key).offset((number - 1) * size).limit(size)


def page_count(table: DataFrame, size: int = PAGE_SIZES[0]) -> DataFrame:
    """(rows, pages); a partly filled last page counts, an empty table has one page."""
    return table.agg(F.count("*").alias("rows")).withColumn(
        "pages", F.greatest(F.lit(1), F.ceil(F.col("rows") / size)).cast("bigint")
    )


def page_after(
    table: DataFrame, field: str, key: str, last: tuple, size: int = PAGE_SIZES[0], ascending: bool = True
) -> DataFrame:
    """The page that follows a row with the values ``last`` of (field, key).

    However deep the page, each task keeps ``size`` rows; :func:`page` keeps as many as lie
    before its end.  NULLs of the field come last; ``last[0]`` may be None.
    """
    value, at = last
    here = F.col(field).eqNullSafe(F.lit(value)) & (F.col(key) > at)
    if value is None:
        beyond = F.lit(False)
    else:
        beyond = (F.col(field) > value if ascending else F.col(field) < value) | F.col(field).isNull()
    return sort_rows(table.filter(here | beyond), field, ascending, key).limit(size)


def numbered_pages(
    table: DataFrame, field: str, key: str, size: int = PAGE_SIZES[0], ascending: bool = True
) -> DataFrame:
    """All rows with ``row`` and ``page`` numbers in the sorted order.

    The sort deals ranges to tasks; a row's number is its place in its task plus the rows of
    the tasks before.  Only these counts, one a task, go through the driver, and the sorted
    rows are checkpointed, so that counts and places speak of the same tasks.
    """
    places = sort_rows(table, field, ascending, key).checkpoint().select(
        "*", F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_place")
    )
    counts = sorted(places.groupBy("_task").count().collect())
    before, offsets = 0, []
    for task, rows in counts:
        offsets += [F.lit(task), F.lit(before)]
        before += rows
    offset = F.create_map(*offsets)[F.col("_task")] if offsets else F.lit(0)
    row = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + offset.cast("bigint") + 1
    return places.withColumn("row", row).withColumn("page", F.ceil(F.col("row") / size).cast("bigint")).drop(
        "_task", "_place"
    )


def write_page_index(table: DataFrame, field: str, key: str, path: str, ascending: bool = True) -> None:
    """Store a table so that any of its pages can be read from the ranges that hold it.

    The sort deals ranges of rows to tasks, and each range is stored as one folder.  The index says
    how many rows each holds; it is written last.
    """
    spark = table.sparkSession
    ranges = sort_rows(table, field, ascending, key).withColumn("_range", F.spark_partition_id())
    ranges.write.partitionBy("_range").parquet(f"{path}/rows")
    counts = spark.read.schema(ranges.schema).parquet(f"{path}/rows").groupBy("_range").agg(F.count("*").alias("rows"))
    counts.coalesce(1).write.parquet(f"{path}/index")
    how = [(field, ascending, key, ranges.schema.json())]
    spark.createDataFrame(how, "field string, ascending boolean, key string, columns string").coalesce(1).write.parquet(f"{path}/order")


def _index(spark: SparkSession, path: str) -> list[Row]:
    """The rows of a page index in order, one for each range."""
    return sorted(spark.read.parquet(f"{path}/index").collect(), key=lambda entry: entry["_range"])


def indexed_pages(spark: SparkSession, path: str, size: int = PAGE_SIZES[0]) -> int:
    """Number of pages of an indexed table; an empty one has one page."""
    return max(1, -(-sum(entry.rows for entry in _index(spark, path)) // size))


def page_by_index(spark: SparkSession, path: str, number: int, size: int = PAGE_SIZES[0]) -> DataFrame:
    """Page ``number`` (from 1) of a table stored by :func:`write_page_index`, with each row's number.

    Only the ranges that the page touches are read, one or two unless pages are larger than ranges.
    """
    index, order = _index(spark, path), spark.read.parquet(f"{path}/order").first()
    rows = spark.read.schema(T.StructType.fromJson(json.loads(order.columns))).parquet(f"{path}/rows")
    ends = list(accumulate(entry.rows for entry in index))
    start = (number - 1) * size
    first, last = bisect_right(ends, start), bisect_right(ends, start + size - 1)
    touched = index[first:last + 1]
    if not touched:
        return rows.drop("_range").withColumn("row", F.lit(0).cast("bigint")).filter("false")
    before = ends[first] - touched[0].rows
    # the rows before the page's end in these ranges, numbered in their order
    found = sort_rows(rows.filter(F.col("_range").isin([entry["_range"] for entry in touched])), order.field, order.ascending, order.key)
    page_rows = found.drop("_range").offset(start - before).limit(size)
    place = F.row_number().over(Window.orderBy(*_order(order.field, order.ascending, order.key)))  # one page of rows
    return page_rows.withColumn("row", (place + start).cast("bigint"))
