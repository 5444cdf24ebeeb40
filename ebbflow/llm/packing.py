"""Sum-of-squares packing of documents into sequences of a fixed token capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY = 4096
#: Pieces of a group are packed together in one task: so many tokens or rows at most, on average.
GROUP_TOKENS, GROUP_ROWS = 1 << 24, 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, spread long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, spread) of each document's ids and end id.

    Only documents of over `capacity` ids are cut. A null or empty text is its end id alone. Repeated rows
    and null doc_ids give pieces like others. `spread` numbers a task's rows, for dealing them out evenly.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, n = tokens.encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in (part for whole in batches for part in tokens.slices(whole, 1)):
            ids, ends = tokens.ended(*coder.batch(batch.column(1)), end_id)
            sizes = np.diff(ends)
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            length = np.minimum(sizes[row] - start, capacity)
            first = ends[row] + start
            crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
            spread = n + np.arange(len(row))
            n += len(row)
            values = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), *map(pa.array, (start, length)), pa.array(crc, pa.int64()), pa.array(spread)]
            yield pa.RecordBatch.from_arrays(values, ["doc_id", "piece", "start", "length", "ids_crc32", "spread"])
        coder.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(common.lean(cut), PIECES)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length, 1 to capacity.

    Longest first, each goes where the sum over all gaps of the squared number of open bins with that gap
    becomes smallest: into the open bin of some gap or into a new bin. Ties: the smaller gap, then open bins
    before a new one. A full bin is open no more.
    """
    count = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    bins, offsets, made = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        # from gap g to g - s: the squares change by (1 - 2 N[g]) + (1 + 2 N[g - s]), the second not for a full bin
        before = count[s:]
        change = 2 - 2 * before + 2 * count[: capacity + 1 - s]
        change[0] -= 1 + 2 * count[0]
        change = np.where(before > 0, change, np.iinfo(np.int64).max)
        gap = int(change.argmin())
        fresh = 1 + 2 * int(count[capacity - s]) if s < capacity else 0
        if change[gap] <= fresh:
            bins[i] = stacks[gap + s].pop()
            count[gap + s] -= 1
        else:
            bins[i], gap = made, capacity - s
            made += 1
        offsets[i] = capacity - gap - s
        if gap:
            count[gap] += 1
            stacks.setdefault(gap, []).append(int(bins[i]))
    return bins, offsets


def pack(rows: DataFrame, capacity: int = CAPACITY, group_tokens: int = GROUP_TOKENS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Pieces with sequence_id and offset: those of a sequence stand one after another from 0, without gaps.

    rows: from pieces(), best stored, as they are read twice. They are dealt out evenly over groups of bounded
    size that are packed apart: each leaves a few sequences that aren't full. No rows give no rows.
    """
    total = rows.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    groups = max(1, -(-total["t"] // group_tokens), -(-total["n"] // group_rows))

    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("spread", ignore_index=True)
        own, offset = sum_of_squares(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=group["pack_group"] * (1 << 32) + own, offset=offset).drop(columns=["spread", "pack_group"])

    group = F.pmod(F.xxhash64("spread"), F.lit(groups))
    types = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return rows.withColumn("pack_group", group).groupBy("pack_group").applyInPandas(one, types)


def best_fit(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Documents to packed pieces."""
    return pack(common.stored(pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity)
