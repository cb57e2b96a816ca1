"""Rules of loading records into a table with a primary key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def first_per_key(records: DataFrame, key: str, *order: str) -> DataFrame:
    """One record per key: the first by ``order``, of equal ones that with the least hash.

    Records without a key are left out.  Copies combine before the shuffle.
    """
    others = [name for name in records.columns if name != key]
    first = F.min_by(F.struct(*others), F.struct(*order, F.xxhash64(*others))).alias("first")
    return records.filter(F.col(key).isNotNull()).groupBy(key).agg(first).select(key, "first.*").select(*records.columns)


def new_records(incoming: DataFrame, existing: DataFrame, key: str, *order: str) -> DataFrame:
    """Records whose key the table does not hold yet, each key once."""
    unique = first_per_key(incoming, key, *order)
    return unique.join(existing.select(key), key, "left_anti")
