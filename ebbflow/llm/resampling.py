"""Target-distribution importance resampling.

Hashed n-grams of words of a source and of a target are counted by bucket; an array of gains, one a bucket, scores every
text of the source. A Gumbel draw by name is added, and the highest scores are drawn without replacement. Their cutoff is
found by a quantile sketch: it brackets the score, exact counts outside the bracket validate or widen it, and only the
bracket's rows are sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Words are runs of digits, letters and all that is not ASCII.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_POLYNOMIAL = np.uint32(0xEDB88320)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ _POLYNOMIAL, _CRC >> 1)
#: Bytes of text that are worked on at once; a longer word makes its part longer.
PART = 1 << 21
#: Features of more bytes are hashed one by one.
LONG = 64
#: Rows that are sorted in one task to find the cutoff, at most.
SORT_ROWS = 100_000
#: Half a bracket's width, as a share of the rows that it is made of.
SKETCH_ERROR = 1e-3
#: Rows of the drawn that one task ranks, about.
RANK_ROWS = 1_000_000


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 of data[start:end] for all spans, a byte of every span at a time."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    size, at = size[order], starts[order]
    crc = np.full(len(size), 0xFFFFFFFF, np.uint32)
    n_long = int(np.searchsorted(-size, -LONG))  # of more than LONG bytes
    for i in range(n_long):
        crc[i] = zlib.crc32(data[at[i] : at[i] + size[i]]) ^ 0xFFFFFFFF
    active = np.searchsorted(-size, -np.arange(LONG))  # spans that have a byte k
    for k in range(LONG):
        a, b = n_long, int(active[k])
        if b <= a:
            break
        crc[a:b] = _CRC[(crc[a:b] ^ data[at[a:b] + k]) & 255] ^ (crc[a:b] >> 8)
    out = np.empty(len(size), np.uint32)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def _features(data: np.ndarray, ends: np.ndarray, max_n: int, carried: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc32 and text number of every feature, words by text) of texts that end at `ends`.

    The first `carried` words were seen before: they only help features that end behind them.
    """
    data = _LOWER[data]
    inside = _IN_WORD[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = ends[(ends > 0) & (ends < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(ends, starts, "right")
    words = np.bincount(text, minlength=len(ends))
    if max_n == 1:
        return crc32(data, starts[carried:], stops[carried:]), text[carried:], words
    sizes = stops - starts
    at = np.cumsum(sizes + 1) - sizes - 1  # one space between words
    joined = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = data[inside]
    crcs, texts = [], []
    for n in range(1, max_n + 1):
        i = np.arange(max(0, carried - n + 1), max(0, len(starts) - n + 1))
        i = i[text[i] == text[i + n - 1]]
        crcs.append(crc32(joined, at[i], at[i + n - 1] + sizes[i + n - 1]))
        texts.append(text[i])
    return np.concatenate(crcs), np.concatenate(texts), words


def _parts(texts: pa.Array, max_n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(crc32 of features, number of their text, words by text, number of the first of these texts) of parts of a batch."""
    values = [(t or b"") for t in texts.cast(pa.binary()).to_pylist()]
    at = 0
    while at < len(values):
        until, size = at, 0
        while until < len(values) and (until == at or size + len(values[until]) <= PART):
            size += len(values[until])
            until += 1
        if size <= PART:
            data = np.frombuffer(b"".join(values[at:until]), np.uint8)
            crcs, text, words = _features(data, np.cumsum([len(v) for v in values[at:until]]), max_n)
            yield crcs, text, words, at
        else:
            data, start, fresh, carried = np.frombuffer(values[at], np.uint8), 0, 0, 0
            while fresh < len(data):
                end = min(fresh + PART, len(data))
                while end < len(data) and _IN_WORD[_LOWER[data[end]]]:
                    end += 1
                part = data[start:end]
                crcs, text, words = _features(part, np.array([len(part)]), max_n, carried)
                yield crcs, text, words - carried, at
                start = fresh = end
                if max_n > 1:  # the next part begins with the last words of this one
                    inside = np.flatnonzero(np.diff(_IN_WORD[_LOWER[part]].astype(np.int8), prepend=0) == 1)
                    carried = min(max_n - 1, len(inside))
                    start = end - (len(part) - int(inside[-carried])) if carried else end
        at = until


def bucket_counts(texts: DataFrame, text: str, max_n: int, buckets: int) -> DataFrame:
    """(bucket, n long): features of all texts by bucket; one without features is left out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for crcs, *_ in _parts(batch.column(0), max_n):
                counts += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["bucket", "n"])

    partial = texts.select(F.col(f"`{text}`")).mapInArrow(common.lean(task), "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))) of every bucket, of two tables by bucket_counts()."""
    spark = source.sparkSession
    s, t = source.select("bucket", F.col("n").alias("s")), target.select("bucket", F.col("n").alias("t"))
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(s, "bucket", "left").join(t, "bucket", "left").na.fill(0)
    both = common.stored(both, "bucket-counts")
    total = both.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    gain = F.floor(1000 * F.log((t + 1) * float(total["s"] + buckets) / ((s + 1) * float(total["t"] + buckets))))
    rows = both.select("bucket", gain.alias("gain")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def scored(docs: DataFrame, target: DataFrame, text: str = "text", max_n: int = 1, buckets: int = 10_000, keep: list[str] | None = None) -> DataFrame:
    """docs' columns `keep` (all) with n_words, n_features, weight (long); columns of these names are replaced.

    Features are runs of 1 to max_n consecutive words; target has a column of the same name as docs' text. Null and empty
    texts have no words and weight 0. Repeated rows count and stay. Of an empty source or target all its counts are 0.
    """
    table = gains(bucket_counts(docs, text, max_n, buckets), bucket_counts(target, text, max_n, buckets), buckets)
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "n_features", "weight")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for crcs, of, n, first in _parts(batch.column(1), max_n):
                gained = table[crcs % np.uint32(buckets)]
                words[first : first + len(n)] += n
                features[first : first + len(n)] += np.bincount(of, minlength=len(n))
                order = np.argsort(of, kind="stable") if max_n > 1 else slice(None)
                sums = np.append(0, np.cumsum(gained[order]))
                last = np.cumsum(np.bincount(of, minlength=len(n)))
                weight[first : first + len(n)] += sums[last] - sums[np.append(0, last[:-1])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, features, weight))], ["own", "n_words", "n_features", "weight"])

    own = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))
    rows = docs.select(own.alias("own"), F.col(f"`{text}`").alias("text"))
    schema = rows.select("own").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    made = rows.mapInArrow(common.lean(task), schema)
    return made.select(*[F.col("own").getField(c).alias(c) for c in names], "n_words", "n_features", "weight")


def gumbel(seed: int, name: Column) -> Column:
    """floor(-1000 ln(-ln((h + 0.5) / 2^32))), h from the first eight digits of sha256 of `seed:name`; a null name is empty."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(name.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _kth(rows: DataFrame, key: Column, k: int, sort_rows: int) -> tuple[int, int, int]:
    """(value, rows below it, rows with it) of the k-th smallest key (long, not null), k from 1.

    A sketch's percentiles bracket it; exact counts outside tell whether they do. One that misses is widened to all rows on the
    side that the counts name; one of over sort_rows rows is narrowed, by a new sketch or else by halves; then its rows alone are sorted.
    """
    keyed = rows.select(key.alias("key"))
    found = keyed.agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    lo, hi, below, inside = found["lo"], found["hi"], 0, found["n"]  # `inside` rows in [lo, hi], `below` ones under it
    while inside > sort_rows and lo < hi:
        held = keyed.where(F.col("key").between(lo, hi))
        place = (k - below) / inside
        marks = [max(0.0, place - SKETCH_ERROR), min(1.0, place + SKETCH_ERROR)]
        a, b = held.agg(F.percentile_approx("key", marks, int(10 / SKETCH_ERROR)).alias("p")).first()["p"]
        a, b = max(lo, min(a, hi)), min(hi, max(a, b, lo))
        if (a, b) == (lo, hi):
            b = lo + (hi - lo) // 2
        counts = held.agg(F.count(F.when(F.col("key") < a, 1)).alias("under"), F.count(F.when(F.col("key") <= b, 1)).alias("until")).first()
        under, until = counts["under"], counts["until"]
        if k <= below + under:
            hi, inside = a - 1, under
        elif k > below + until:
            lo, below, inside = b + 1, below + until, inside - until
        else:
            lo, hi, below, inside = a, b, below + under, until - under
    if lo < hi:
        value = keyed.where(F.col("key").between(lo, hi)).orderBy("key").offset(k - below - 1).limit(1).first()["key"]
    else:
        value = lo
    counts = keyed.agg(F.count(F.when(F.col("key") < value, 1)).alias("under"), F.count(F.when(F.col("key") == value, 1)).alias("same")).first()
    return value, counts["under"], counts["same"]


def highest(rows: DataFrame, keys: Callable[[], list[Column]], k: int, sort_rows: int = SORT_ROWS) -> Column:
    """Condition that holds for exactly the first k of rows by keys (longs, ascending, together different in each row).

    Key by key: rows below the k-th value are in, those with it go on to the next key.
    """
    taken, tied, held = F.lit(False), F.lit(True), rows
    if k <= 0:
        return taken
    for key in keys():
        value, below, same = _kth(held, key, k, sort_rows)
        taken = taken | (tied & (key < value))
        tied = tied & (key == value)
        if k == below + same:
            break
        k, held = k - below, held.where(key == value)
    return taken | tied


def drawn(docs: DataFrame, name: str, percent: int, min_words: int, seed: int, sort_rows: int = SORT_ROWS, rank_rows: int = RANK_ROWS) -> DataFrame:
    """docs (from scored()) with score and rank (long); columns of these names are replaced.

    Of the N rows with at least min_words words those floor(percent N / 100) of the highest score (weight plus a Gumbel draw)
    get ranks 1, 2, 3...; ties go to the smaller name (long; null last), then to fewer features. All others have a null rank. Rows that are
    equal in all of these may take each other's place. An empty table gives an empty one.
    """
    names = [c for c in docs.columns if c not in ("score", "rank")]
    own = F.struct(*[F.col(f"`{c}`") for c in names])
    score = F.col("weight") + gumbel(seed, F.col(f"`{name}`"))
    rows = docs.select(own.alias("own"), score.alias("score"), F.monotonically_increasing_id().alias("row"))
    rows = common.stored(rows, "importance")
    held = rows.where(F.col("own").getField("n_words") >= min_words)
    who = F.col("own").getField(name)

    def keys() -> list[Column]:
        return [-F.col("score"), who.isNull().cast("long"), F.coalesce(who.cast("long"), F.lit(0)), F.col("own").getField("n_features"), F.col("row")]

    k = percent * held.count() // 100
    inside = (F.col("own").getField("n_words") >= min_words) & highest(held, keys, k, sort_rows)
    order = [k_.alias(f"k{i}") for i, k_ in enumerate(keys())]
    taken = rows.where(inside).select("own", "score", *order)
    by = [f"k{i}" for i in range(len(order))]
    parts = max(1, -(-k // rank_rows))
    taken = taken.repartitionByRange(parts, *by).withColumn("part", F.spark_partition_id())
    taken = common.stored(taken, "importance-drawn")  # from here on a row's part stands
    starts = sorted((r["part"], r["count"]) for r in taken.groupBy("part").count().collect())
    places, at = [], 0
    for part, n in starts:
        places.append((part, at))
        at += n
    starts = F.broadcast(rows.sparkSession.createDataFrame(places, "part int, before long"))  # a row a part
    window = "row_number() over (partition by part order by " + ", ".join(by) + ")"
    ranked = taken.withColumn("place", F.expr(window)).join(starts, "part")
    ranked = ranked.select("own", "score", (F.col("before") + F.col("place")).cast("long").alias("rank"))
    rest = rows.where(~inside).select("own", "score", F.lit(None).cast("long").alias("rank"))
    return rest.unionByName(ranked).select(*[F.col("own").getField(c).alias(c) for c in names], "score", "rank")
