"""From a record topic into a table that holds each key once."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from talentgrid.operators.loading import first_per_key, new_records
from talentgrid.sinks.tables import BatchWriter, committed_batches, parquet_batches
from talentgrid.sources.tables import read_if_there
from talentgrid.sources.topics import TopicSource, decode, rejects
from talentgrid.streaming.jobs import start_outputs

#: how rows are packed as JSON and unpacked, without loss
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
#: lists that the keys of a stream are kept in: a call for a list costs about a millisecond, so few are better for large
#: micro-batches and many for small ones into a table of very many keys
KEY_BUCKETS = 1 << 16


def new_key_batches(path: str, schema: T.StructType, key: str, *order: str) -> BatchWriter:
    """Write the records of a micro-batch whose key no other batch has brought.

    A replayed batch doesn't look at what its own first attempt left, and overwrites it.  Each
    batch reads all keys of the table, so this is for tables that other jobs fill as well;
    :func:`mark_first_records` keeps the keys in the stream's state instead.
    """
    write = parquet_batches(path)

    def run(batch: DataFrame, batch_id: int) -> None:
        held = read_if_there(
            batch.sparkSession, path, T.StructType([*schema, T.StructField("batch_id", T.LongType())])
        )
        if held is None:  # the first batch makes the table
            write(first_per_key(batch, key, *order), batch_id)
        else:
            write(new_records(batch, held.filter(F.col("batch_id") != batch_id), key, *order), batch_id)

    return run


def _mark_first(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """All records of a bucket of keys, the least one of each key marked that no earlier micro-batch has brought.

    One record of each new key is held back, however many there are.  The state is the list of keys, as JSON.
    """
    seen = json.loads(state.get[0]) if state.exists else []
    known, held = set(seen), {}
    for rows in frames:
        free = []
        orders = zip(*[rows[name].tolist() for name in rows.columns[3:]])
        for key, record, place in zip(rows["key"].tolist(), rows["record"].tolist(), orders):
            if key is None or key in known:
                free.append(record)
                continue
            least = held.get(key)
            if least is None or place < least[0]:
                held[key], record = (place, record), least and least[1]
            if record is not None:
                free.append(record)
        if free:
            yield pd.DataFrame({"record": free, "first": np.zeros(len(free), bool)})
    if held:
        state.update((json.dumps([*seen, *held]),))
        yield pd.DataFrame({"record": [record for _, record in held.values()], "first": np.ones(len(held), bool)})


def mark_first_records(rows: DataFrame, key: str, *order: str, buckets: int = KEY_BUCKETS) -> DataFrame:
    """All records of a stream with ``first``: true for one record of each key, in the micro-batch that brings the key.

    Of a micro-batch's records of one key the first by ``order`` (numbers or times, NULL first) counts,
    of equal ones that with the least hash, as in :func:`first_per_key`.  Keys that have been seen are
    in the state store, in ``buckets`` lists by hash, a number that is fixed for the query's life.  A micro-batch reads and
    writes the lists of its own keys, so nothing of the table; there is one Python call a list.
    Records without a key are never marked.
    """
    others = [name for name in rows.columns if name != key]
    kinds, lowest = dict(rows.dtypes), F.lit(-(1 << 63))

    def place(name: str) -> Column:
        value = F.unix_micros(name) if kinds[name] == "timestamp" else F.col(name).cast("bigint")
        return F.coalesce(value, lowest)

    digest = F.xxhash64(*others)
    text = F.hex(key) if kinds[key] == "binary" else F.col(key).cast("string")
    part = F.when(F.col(key).isNull(), digest).otherwise(F.xxhash64(text))  # records without a key spread
    packed = rows.select(
        F.pmod(part, F.lit(buckets)).cast("int").alias("bucket"), text.alias("key"),
        F.to_json(F.struct("*"), JSON).alias("record"),
        *[place(name).alias(f"order{at}") for at, name in enumerate(order)], digest.alias("hash"),
    )
    marked = packed.groupBy("bucket").applyInPandasWithState(
        _mark_first, "record string, first boolean", "seen string", "append", GroupStateTimeout.NoTimeout
    )
    return marked.select(F.from_json("record", rows.schema, JSON).alias("row"), "first").select("row.*", "first")


def _firsts(write: BatchWriter) -> BatchWriter:
    return lambda batch, batch_id: write(batch.filter("first").drop("first"), batch_id)


def _all(write: BatchWriter) -> BatchWriter:
    return lambda batch, batch_id: write(batch.drop("first"), batch_id)


def decoded(write: BatchWriter, schema: T.StructType) -> BatchWriter:
    """An output of topic records that gets them decoded."""
    return lambda batch, batch_id: write(decode(batch, schema), batch_id)


def rejected(write: BatchWriter, schema: T.StructType) -> BatchWriter:
    """An output of topic records that gets those which don't parse, with their offsets and texts."""
    return lambda batch, batch_id: write(rejects(batch, schema), batch_id)


def start_table_load(
    spark: SparkSession, source: TopicSource, topic: str, schema: T.StructType, key: str,
    path: str, checkpoint: str, *more: BatchWriter, trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Decode a topic as it grows and load each key's first record into a Parquet table.

    The table is one of committed batches (:func:`talentgrid.sinks.tables.read_committed`); records without a key
    are left out.  ``more`` outputs get every decoded record.
    """
    rows = mark_first_records(decode(source.stream(spark, topic), schema), key, "timestamp")
    outputs = [_firsts(committed_batches(path)), *map(_all, more)]
    return start_outputs(rows, checkpoint, *outputs, trigger=trigger)
