"""Spelling variants by pivotal grams.

Two near words (one code point inserted, deleted or replaced) agree on one of any two disjoint bigrams. Of each word's
rarest bigrams two disjoint ones, its pivots, are chosen by dynamic programming; they meet the other words' gram prefixes at
positions that one edit allows. Every meeting is verified.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from . import common
from .shingles import mixed

#: Runs of Latin-1 letters, as named in the contract.
RUN = r"[A-Za-zÀ-ÿ]"
#: Bigrams are counted by 16 bits; those that fall together count as one.
GRAMS = 1 << 16
#: A word's prefix holds its three rarest bigrams and, of the third, so many occurrences in all: one edit makes two new ones before it.
OCCURRENCES = 5
#: Words that one task indexes, about.
WORDS_A_TASK = 50_000
#: Longer words are compared by a function of time in proportion to their length.
LONG = 128
_R = np.uint64(0x5851F42D4C957F2D)
_R_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))


def runs(docs: DataFrame, least: int, typo_every: int = 0, text: str = "text", name: str = "doc_id") -> DataFrame:
    """(word, n long): A-Z-lower-cased runs of letters of at least `least` code points and how often they occur.

    typo_every: an occurrence whose crc32 of `name:run` it divides loses its code point crc32 % length first, so that there
    are variants to find; a null name is empty. Null texts have no runs.
    """
    run = F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(RUN + f"{{{least},}}"), F.lit(0)))
    rows = docs.select(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias("name"), run.alias("run"))
    rows = rows.select("name", F.translate("run", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("word"))
    if typo_every:
        h = F.crc32(F.encode(F.concat("name", F.lit(":"), "word"), "UTF-8"))
        rows = rows.select("word", h.alias("h")).withColumn("at", F.pmod("h", F.length("word")).cast("int"))
        short = F.concat(F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + 2))
        rows = rows.select(F.when(F.col("h") % typo_every == 0, short).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least)
    return rows.groupBy("word").agg(F.count("*").alias("n"))


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(numbers of the words of one length, their code points, a row a word)."""
    coded = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words.to_pylist()]
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, np.stack([coded[i] for i in at]).astype(np.uint64)


def _grams(points: np.ndarray) -> np.ndarray:
    """16 bits of each bigram; of Latin-1 letters they are the bigram itself."""
    a, b = points[:, :-1], points[:, 1:]
    return ((a * np.uint64(256) + b + (a >> np.uint64(8)) * np.uint64(7919) + (b >> np.uint64(8)) * np.uint64(104729)) & np.uint64(GRAMS - 1)).astype(np.int64)


def gram_counts(words: DataFrame) -> np.ndarray:
    """How often each bigram stands in the words of a table, each word counted once."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(GRAMS, np.int64)
        for batch in batches:
            for _, points in _by_length(batch.column(0)):
                counts += np.bincount(_grams(points).ravel(), minlength=GRAMS)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["gram", "n"])

    out = np.zeros(GRAMS, np.int64)
    for r in words.select("word").mapInArrow(common.lean(task), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():  # GRAMS rows at most
        out[r["gram"]] = r["n"]
    return out


def pivots(places: np.ndarray, costs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two disjoint bigrams of least cost together, a row a word: their columns' places, which rise along each row.

    Dynamic programming: the best single bigram that ends before column j, and the best pair that ends at j.
    """
    rows, n = places.shape
    best = np.full(rows, np.iinfo(np.int64).max // 4)
    first, second = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for j in range(1, n):
        single, at = np.full(rows, np.iinfo(np.int64).max // 4), np.zeros(rows, np.int64)
        for i in range(j):
            better = (places[:, j] - places[:, i] >= 2) & (costs[:, i] < single)
            single, at = np.where(better, costs[:, i], single), np.where(better, places[:, i], at)
        better = single + costs[:, j] < best
        best = np.where(better, single + costs[:, j], best)
        first, second = np.where(better, at, first), np.where(better, places[:, j], second)
    return first, second


class _Pieces:
    """Hashes of pieces of equally long words, wherever they stand."""

    def __init__(self, points: np.ndarray):
        self.rows, self.size = points.shape
        powers = np.multiply.accumulate(np.append(np.uint64(1), np.full(self.size, _R)))
        self.inverse = np.multiply.accumulate(np.append(np.uint64(1), np.full(self.size, _R_INVERSE)))
        self.sums = np.zeros((self.rows, self.size + 1), np.uint64)
        np.cumsum((points + np.uint64(1)) * powers[:-1], axis=1, out=self.sums[:, 1:])

    def _of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        start, end = np.clip(start, 0, self.size), np.clip(end, 0, self.size)
        row = np.arange(self.rows)
        return mixed((self.sums[row, end] - self.sums[row, start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def both(self, end: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the word up to `end` and from `start` on, whether both are within the word and apart)."""
        key = mixed(self._of(np.zeros_like(end), end) + np.uint64(3) * self._of(start, np.full_like(start, self.size)))
        return key, (end >= 0) & (start <= self.size) & (end <= start)

    def keys(self, place: np.ndarray, slack: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What a near word shares if the bigram at `place` is left whole, so that the edit is wholly right or left of it.

        Of the part that holds the edit one half is left whole too. slack: by how much that part's length may differ.
        """
        whole = np.full_like(place, self.size)
        right, left = self.size - place - 2, place
        for d in slack:
            half = np.floor_divide(right + d, 2)  # of the right part, as long as it is in the other word
            yield self.both(place + 2 + half, whole)
            yield self.both(place + 2, self.size - (right + d - half))
            half = np.floor_divide(left + d, 2)
            yield self.both(half, place)
            yield self.both(np.zeros_like(place), place - (left + d - half))


def _lists(found: list[tuple[np.ndarray, np.ndarray]], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys of all rows, how many each has), each key once a row."""
    keys, valid = np.stack([k for k, _ in found], 1), np.stack([v for _, v in found], 1)
    keys = np.where(valid, keys, np.uint64(0))
    keys.sort(axis=1)
    keep = keys > 0
    keep[:, 1:] &= keys[:, 1:] != keys[:, :-1]
    return keys[keep], keep.sum(1)


def _index(points: np.ndarray, rank: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, tuple, tuple]:
    """(rank of each word's third rarest bigram, keys of its pivots, keys of its prefix) of words of one length."""
    rows, size = points.shape
    grams = _grams(points)
    ranks = rank[grams]
    order = np.argsort(ranks, axis=1, kind="stable")[:, : min(size - 1, 2 + OCCURRENCES)]
    ranked = np.take_along_axis(ranks, order, 1)
    last = ranked[:, 2]
    pieces = _Pieces(points)
    rarest = np.sort(order[:, :3], axis=1)
    found = []
    for place in pivots(rarest, counts[np.take_along_axis(grams, rarest, 1)]):
        found += pieces.keys(place, (0,))
    own = _lists(found, rows)
    found, seen = [], np.zeros(rows, np.int64)
    for j in range(order.shape[1]):
        seen += ranked[:, j] == last
        inside = (ranked[:, j] < last) | ((ranked[:, j] == last) & (seen <= OCCURRENCES))
        found += [(k, v & inside) for k, v in pieces.keys(order[:, j], (-1, 1))]
    return last, own, _lists(found, rows)


def indexed(words: DataFrame) -> DataFrame:
    """(word, n, size int, last int, pivots, prefix array<long>) of a table (word, n); stored."""
    words = words.repartition(max(1, -(-words.count() // WORDS_A_TASK)), "word")
    counts = gram_counts(words)
    rank = np.empty(GRAMS, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(GRAMS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, points in _by_length(batch.column(0)):
                last, *both = _index(points, rank, counts)
                lists = [pa.ListArray.from_arrays(np.append(0, np.cumsum(n)).astype(np.int32), keys.view(np.int64)) for keys, n in both]
                rows = batch.take(pa.array(at))
                size = np.full(len(at), points.shape[1], np.int32)
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(size), pa.array(last.astype(np.int32)), *lists], ["word", "n", "size", "last", "pivots", "prefix"])

    schema = "word string, n long, size int, last int, pivots array<long>, prefix array<long>"
    return common.stored(words.select("word", "n").mapInArrow(common.lean(task), schema), "spelling-index")


@F.pandas_udf(BooleanType())
def _differ_by_one(words: pd.Series, others: pd.Series) -> pd.Series:
    """Whether two different words are equal but for one code point, in time by their length."""

    def near(a: str, b: str) -> bool:
        a, b = sorted((a, b), key=len)
        i = len(os.path.commonprefix([a, b]))
        return len(b) - len(a) <= 1 and a[i + (len(a) == len(b)) :] == b[i + 1 :]

    return pd.Series([near(a, b) for a, b in zip(words, others)], dtype=bool)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n) for all near words, both ways, of a table (word, n): distinct words of four code points or more."""
    index = indexed(words)

    def met(index: DataFrame) -> DataFrame:
        ours = index.select("word", "n", "size", "last", F.explode("pivots").alias("key"))
        theirs = index.select(F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("size").alias("other_size"), F.col("last").alias("other_last"), F.explode("prefix").alias("key"))
        return ours.join(theirs, "key").where("other_last >= last and abs(size - other_size) <= 1 and word <> other")

    # Spark's distance takes time by the square of a word's length, so words of LONG code points or more are compared apart
    near = met(index).where(f"size <= {LONG} and other_size <= {LONG}").where(F.levenshtein("word", "other", 1) == 1)
    long = met(index.where(f"size >= {LONG}")).where(f"size > {LONG} or other_size > {LONG}").where(_differ_by_one("word", "other"))
    near = near.unionByName(long)
    way = lambda a, b, n: F.struct(F.col(a).alias("word"), F.col(b).alias("other"), F.col(n).alias("other_n"))
    pairs = near.select(F.explode(F.array(way("word", "other", "other_n"), way("other", "word", "n"))).alias("p")).select("p.*").distinct()
    pairs = common.stored(pairs, "near-words")
    common.dropped(index)
    return pairs


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) without circles: the last word that forms lead to. Each round doubles the steps."""
    out = common.stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = out.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = common.stored(out.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        common.dropped(out)
        out = longer
        if out.where("moved").isEmpty():
            return out.select("word", "root")


def grouped(words: DataFrame, times: int = 10) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table (word, n): distinct words of at least four code points.

    A word's form is its near word of largest n (ties: the smaller by code point), if that n is at least `times` its own,
    else null; root follows forms to the last, and is the word itself if it has none. An empty table gives an empty one.
    """
    if times < 2:
        raise ValueError("forms could go round in circles")
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("w"))).alias("best"))
    rows = words.select("word", "n").join(best, "word", "left")
    fits = -F.col("best.n") >= times * F.col("n")
    rows = rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.w")).alias("form"), F.when(fits, -F.col("best.n")).alias("form_n"))
    rows = common.stored(rows, "spelling-forms")
    roots = followed(rows.where("form is not null"))
    found = rows.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
