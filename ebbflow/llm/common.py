"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch: whole texts are long, and a task holds a batch on either side of its Python worker.
BATCH_ROWS = 1000


def settings(spark: SparkSession) -> None:
    """Small Arrow batches; shuffle files go when the execution that made them ends, as its result is stored."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on a local master alone, one of this machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it names the folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='ebbflow-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet in the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table from stored() that nothing reads any more."""
    spark = df.sparkSession
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that hands freed memory back when it ends: its worker lives on, beside the executor's heap."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
            if trim:
                trim(0)

    return run


def word_count(text: Column) -> Column:
    """Number of words as long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix(columns: list[str], name: str) -> str:
    """A prefix for helper columns that begins none of the columns, whose names are the caller's."""
    while any(c.lower().startswith(name) for c in columns):
        name = f"_{name}"
    return name


#: Bits of the map of keys by which thinned() tells rows, 4 MB in all.
KEY_BITS = 1 << 25


def thinned(rows: DataFrame, keyed: DataFrame, key: str) -> DataFrame:
    """rows without most of those whose key isn't in keyed, so that a join with keyed needn't shuffle them.

    It loses no row that joins: a bit is set for the hash of each key, and keys that share a bit stay. Null keys go.
    """
    slot = 1 + F.pmod(F.xxhash64(key), F.lit(KEY_BITS))
    at = F.bitmap_bit_position(slot)
    name = prefix(rows.columns, "bits_")
    bits = keyed.groupBy(F.bitmap_bucket_number(slot).alias(f"{name}bucket")).agg(F.bitmap_construct_agg(at).alias(name))
    both = rows.where(F.col(key).isNotNull()).join(F.broadcast(bits), F.bitmap_bucket_number(slot) == F.col(f"{name}bucket"))
    byte = F.conv(F.hex(F.substring(F.col(name), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return both.where(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)


def look_up(rows: DataFrame, keyed: DataFrame, keys: list[str], count: str, spread: Column) -> DataFrame:
    """rows left join keyed, where a few keys may hold much of rows.

    keyed has one row a key and in `count` the number of rows with it. Keys with over a 500th of all rows, so
    500 at most, are broadcast; rows of such a key get a key of their own in the shuffled join, which finds
    no match, so they spread by `spread`. `count` isn't in the result. Null keys match nothing.
    """
    total = keyed.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n"))
    limit = max(1000, (total.first()["n"] or 0) // 500)
    values = [c for c in keyed.columns if c not in (*keys, count)]
    hot_, cold_ = prefix(rows.columns, "hot_"), prefix(rows.columns, "cold_")
    hot_values, cold_values, lane, cold_lane = f"{hot_}values", f"{cold_}values", f"{hot_}lane", f"{cold_}lane"
    hot = keyed.where(F.col(count) > limit).select(
        *[F.col(k).alias(f"{hot_}key_{k}") for k in keys], F.struct(*values).alias(hot_values)
    )
    cold = keyed.where(F.col(count) <= limit).select(
        *[F.col(k).alias(f"{cold_}key_{k}") for k in keys], F.lit(0).cast("long").alias(cold_lane), F.struct(*values).alias(cold_values)
    )
    on = [F.col(k) == F.col(f"{hot_}key_{k}") for k in keys]
    first = rows.join(F.broadcast(hot), on, "left").withColumn(
        lane, F.when(F.col(hot_values).isNull(), F.lit(0)).otherwise(1 + F.pmod(F.xxhash64(spread), F.lit(1 << 40))).cast("long")
    )
    on = [F.col(k) == F.col(f"{cold_}key_{k}") for k in keys] + [F.col(lane) == F.col(cold_lane)]
    both = first.join(cold, on, "left")
    found = F.coalesce(F.col(hot_values), F.col(cold_values))
    return both.select(*[F.col(f"`{c}`") for c in rows.columns], *[found[v].alias(v) for v in values])

