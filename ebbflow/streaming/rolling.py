"""The panel kept up to date month by month: a batch of records rebuilds only the accounts that it can change.

Accounts lie in partitions by the last month that they were seen in; those seen in the panel's last month are OPEN. A new
month can change open accounts (they go on, close or fall below the floor) and closed ones that it names again, so
the open partition and the partitions of such accounts are rebuilt and all others stay as they are. A batch writes
new folders and then one file that lists which partitions of which batches make up the panel: until that file is there,
readers see the panel as it was, and a batch that is run again starts anew or is skipped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panel
from ..sources import dumps

#: Partition of the accounts that were seen in the panel's last month.
OPEN = -1
LISTED = "last_month int, batch long, panel_start int, panel_end int, taken long"


def _listed(spark: SparkSession, store: str) -> list:
    """Partitions that make up the panel, one row a last month and batch; none before the first batch."""
    try:
        lists = spark.read.schema(LISTED).parquet(f"{store}/lists")
        newest = lists.agg(F.max("taken")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return [] if newest is None else lists.where(F.col("taken") == newest).collect()  # some hundred rows


def _read(spark: SparkSession, store: str, table: str, parts: set[tuple[int, int]]) -> DataFrame:
    paths = [f"{store}/{table}/batch={b}/last_month={m}" for m, b in sorted(parts)]
    return spark.read.option("basePath", f"{store}/{table}").parquet(*paths).drop("batch")


def _write(rows: DataFrame, store: str, table: str, batch: int, last_seen: Column, end: int) -> None:
    part = F.when(last_seen == end, OPEN).otherwise(last_seen).cast("int")
    # accounts of a month go to few files, and a large month is split
    dealt = rows.withColumn("last_month", part).hint("rebalance", "last_month")
    dealt.write.mode("overwrite").partitionBy("last_month").parquet(f"{store}/{table}/batch={batch}")


def merge(records: DataFrame, store: str, batch: int, floor: float = 0.0) -> bool:
    """Take up records (account_id, month_int, ctrvl_kda, segment, open_month) as batch number `batch`; False if that is done already.

    Numbers must rise from batch to batch. Records of any month count, also late ones: several of an account and month
    add up. current() then equals build() of all records so far. No records change nothing. A batch costs the rows of
    open accounts and of the months whose accounts come back, and a scan of the closing rows of the others.
    """
    spark = records.sparkSession
    state = _listed(spark, store)
    if state and batch <= state[0]["taken"]:
        return False
    fresh = panel.monthly(records.where("account_id is not null and month_int is not null")).persist()
    start, end = fresh.agg(F.min("month_int"), F.max("month_int")).first()
    if start is None:
        fresh.unpersist()
        return False
    live = {(r["last_month"], r["batch"]) for r in state}
    months, changed = fresh, set()
    if state:
        start, end = min(start, state[0]["panel_start"]), max(end, state[0]["panel_end"])
        changed = {p for p in live if p[0] == OPEN}
        if live - changed:
            closings = _read(spark, store, "panel", live - changed).where("event = 1").select("account_id", "last_month")
            again = closings.join(fresh.select("account_id").distinct(), "account_id", "left_semi").select("last_month").distinct()
            names = {r["last_month"] for r in again.collect()}  # a row a month
            changed |= {p for p in live if p[0] in names}
        old = _read(spark, store, "months", changed).select(fresh.columns)
        months = fresh.unionByName(old).groupBy("account_id", "month_int").agg(
            F.sum("balance_kda").alias("balance_kda"), F.min("segment").alias("segment"), F.min("open_month").alias("open_month")
        )
    seen = F.expr("max(month_int) over (partition by account_id)")
    _write(months.withColumn("seen", seen), store, "months", batch, F.col("seen"), end)
    fresh.unpersist()
    written = spark.read.parquet(f"{store}/months/batch={batch}")
    rows = panel.from_months(written.drop("seen", "last_month"), floor, bounds=(start, end), keep=("last_seen",))
    _write(rows, store, "panel", batch, F.col("last_seen"), end)
    made = {(r["last_month"], batch) for r in written.select("last_month").distinct().collect()}
    listed = [(m, b, start, end, batch) for m, b in sorted((live - changed) | made)]
    spark.createDataFrame(listed, LISTED).drop("taken").coalesce(1).write.mode("overwrite").parquet(f"{store}/lists/taken={batch}")
    return True


def current(spark: SparkSession, store: str, pit: DataFrame | None = None) -> DataFrame | None:
    """The panel as it is, None before the first batch; pit: macro columns by month_int, joined when it is read, so they may be revised."""
    state = _listed(spark, store)
    if not state:
        return None
    rows = _read(spark, store, "panel", {(r["last_month"], r["batch"]) for r in state}).drop("last_month", "last_seen")
    return rows if pit is None else rows.join(F.broadcast(pit), "month_int", "left")


def follow(spark: SparkSession, folder: str, store: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame], floor: float = 0.0):
    """Start a query that takes up new dumps of a folder; prepare names the account of their records."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(folder)

    def take(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.select("path").collect()]  # names of new files
        if paths:
            merge(prepare(dumps.unioned([dumps.records(dumps.read_dumps(spark, p)) for p in paths])), store, number, floor)

    return files.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
