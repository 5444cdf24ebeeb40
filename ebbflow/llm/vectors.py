"""What the vector searches share: clean rows, tasks of a query block against a part of all rows, and top lists."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Queries of a task, rows of all that a task holds at a time, and parts that all rows are dealt out to for a query block.
QUERY_BLOCK, ROW_BLOCK, PART_ROWS, MAX_PARTS = 1024, 8192, 16_384, 16


def cleaned(rows: DataFrame, of_id: str, of_vector: str, zero: bool, map_: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """(row, id, size, data), stored: data is the vector's float64 bytes, row a number of its own.

    Without rows whose id or vector is null or that hold null or non-finite components; zero: zero vectors stay.
    map_ is applied to the components; where one becomes infinite the row is left out too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        n = TaskContext.get().partitionId() << 32
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for name, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n += 1
                if name is None or not vector.is_valid or vector.values.null_count:
                    continue
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not np.isfinite(x).all() or not (zero or x.any()):
                    continue
                if map_:
                    with np.errstate(over="ignore"):
                        x = map_(x)
                    if not np.isfinite(x).all():
                        continue
                for column, value in zip(out, (n, name, len(x), x.astype("<f8").tobytes()), strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], ["row", "id", "size", "data"])

    chosen = rows.select(F.col(of_id).cast("long"), F.col(of_vector).cast("array<double>"))
    return common.stored(chosen.mapInArrow(run, "row long, id long, size int, data binary"), "vectors")


def matrix(data: list[bytes], size: int) -> np.ndarray:
    """Rows of the data; shorter vectors are filled up with zeros."""
    out = np.zeros((len(data), size))
    for row, x in zip(out, data, strict=True):
        row[: len(x) // 8] = np.frombuffer(x, "<f8")
    return out


class Top:
    """The k best (key, id) of each query: smallest keys, then smallest ids. kind: of the keys, float64 or int64."""

    def __init__(self, n: int, k: int, kind: type = np.float64):
        self.k, self.n = k, n
        self.query, self.key, self.id = np.empty(0, np.int64), np.empty(0, kind), np.empty(0, np.int64)
        self.worst = np.full(n, np.inf if kind is np.float64 else np.iinfo(np.int64).max, kind)

    def add(self, query: np.ndarray, key: np.ndarray, ids: np.ndarray) -> None:
        query, key, ids = np.append(self.query, query), np.append(self.key, key), np.append(self.id, ids)
        order = np.lexsort((ids, key, query))
        query, key, ids = query[order], key[order], ids[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        self.query, self.key, self.id = query[keep], key[keep], ids[keep]
        last = rank[keep] == self.k - 1
        self.worst[self.query[last]] = self.key[last]


def search(rows: DataFrame, queries: DataFrame, k: int, make: Callable, kind: str, descending: bool) -> DataFrame:
    """(query_id, rank, id, score) of the k best of rows for each query, both from cleaned().

    make(ids, rows, matrix of queries) gives an object with block(ids, rows, matrix of rows) and top, whose keys
    times -1 (descending) or 1 are scores of the SQL type kind. It sees all rows of its part, ROW_BLOCK at a time;
    a task is a block of queries and a part of all rows. The query's own row (by row number) is no result.
    """
    sizes = rows.agg(F.count("*").alias("n"), F.coalesce(F.max("size"), F.lit(0)).alias("size")).first()
    size, parts = sizes["size"], min(MAX_PARTS, max(1, -(-sizes["n"] // PART_ROWS)))
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    mine = queries.select("row", "id", "data", F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("role"))
    all_ = rows.select("row", "id", "data", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(F.xxhash64(F.lit(1), "row"), F.lit(parts)).alias("part"), F.lit(1).alias("role"))
    task = (F.col("block") * parts + F.col("part")).alias("task")
    both = mine.unionByName(all_).select(task, "role", "row", "id", "data")
    dealt = both.repartition(blocks * parts, "task").sortWithinPartitions("task", "role", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, held, role = None, None, [], None

        def flush():
            nonlocal state, held
            if held and role == 0:
                state = make(np.array([h[1] for h in held]), np.array([h[0] for h in held]), matrix([h[2] for h in held], size))
            elif held and state is not None:
                state.block(np.array([h[1] for h in held]), np.array([h[0] for h in held]), matrix([h[2] for h in held], size))
            held = []

        def result():
            top = state.top
            scores = -top.key if descending else top.key
            columns = [state.rows[top.query], state.ids[top.query], top.id, scores]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_row", "query_id", "id", "score"])

        for batch in batches:
            for t, r, row, name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (t, r) != (now, role):
                    flush()
                    if t != now and state is not None:
                        yield result()
                    if t != now:
                        state = None
                    now, role = t, r
                elif r == 1 and len(held) == ROW_BLOCK:
                    flush()
                held.append((row, name, data))
        flush()
        if state is not None:
            yield result()

    found = dealt.mapInArrow(run, f"query_row long, query_id long, id long, score {kind}")
    order = [F.col("score").desc() if descending else F.col("score").asc(), F.col("id")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
