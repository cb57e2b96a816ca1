"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is heavy if it holds more than one row in HEAVY_SHARE (so at most that many keys
#: are heavy, which bounds what is broadcast) and more than HEAVY_ROWS rows.
HEAVY_SHARE, HEAVY_ROWS = 5000, 100


#: Rows that a Python worker gets at once: texts are long, and workers share an executor's memory.
BATCH_ROWS = 256


def small_batches(spark: SparkSession) -> None:
    """Have the session hand Python workers few rows at once; operators see to this by ``pick`` and ``numbered``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by exact name.

    Other columns, also ones that differ only in case or repeat a name, do no harm.
    """
    small_batches(df.sparkSession)
    at = [df.columns.index(name) for name in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(name) for i, name in zip(at, names)])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The table with its columns renamed c0, c1, ..., and the new name of each old one."""
    small_batches(df.sparkSession)
    names = [f"c{i}" for i in range(len(df.columns))]
    new = dict(reversed(list(zip(df.columns, names))))
    return df.toDF(*names), new


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where nothing is named, as in tests on a local master, a temporary folder is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        named = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as files in the shared folder: lost executors cost no recomputation."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys holding more than a 1/HEAVY_SHARE share of the rows (HEAVY_SHARE rows at most)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(
        (F.col("n") > HEAVY_ROWS) & (F.col("n") * HEAVY_SHARE > total.scalar())
    ).select(key)


def join_unique(left: DataFrame, right: DataFrame, key: str, how: str = "inner", hint: str | None = None) -> DataFrame:
    """left joined to right, which has one row a key; no key of left overfills a task.

    Rows of heavy keys meet the few right rows of these keys by broadcast, the others by
    shuffle, in the way that ``hint`` names.  Both sides are read more than once: pass checkpointed or cheap ones.
    """
    heavy = F.broadcast(heavy_keys(left, key))
    few = right.join(heavy, key, "left_semi")
    light = left.join(heavy, key, "left_anti").join(right.hint(hint) if hint else right, key, how)
    return light.unionByName(left.join(heavy, key, "left_semi").join(F.broadcast(few), key, how))
