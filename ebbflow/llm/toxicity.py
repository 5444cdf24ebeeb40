"""Class-conditional Kneser-Ney models of toxic and ordinary documents.

Words are A-Z lower-cased and parted by ASCII punctuation and white space; a document is the set of its pairs (h, w) of
neighbouring words, the first after a start mark, so repeated lines weigh no more. Class c has n_c(h, w) documents with a
pair, n_c(h) their sum over w, and c_c(w) different words before w; C_c is its sum and c(w), C are those of both classes
together. With the discounts D(1) = 1 and D(n) = 0.75 of larger counts, and M for what is discounted from a sum,

    P_c(w | h) = max(n_c(h, w) - D, 0) / n_c(h)  +  M_c(h) / n_c(h) * P_c(w)
    P_c(w)     = max(c_c(w) - E, 0) / C_c        +  M_c / C_c * c(w) / C,   E(n) = min(n, 4)

so a pair backs off to its class's continuation counts and these to continuation counts that both classes share. A pair of
one document of a class and a word behind up to four different ones have the shared backoff alone. All pairs and words of both classes count. A history that a
class hasn't seen has P_c(w); of a word of no class the ratio is the limit for c(w) near 0.

The log ratio of a document's likelihoods is a sum over its pairs of u(w), the ratio of P_c(w), of l(h), the ratio of what
is discounted, and, where a class has the pair twice or more, of log(1 + (n_c - D) / (M_c(h) P_c(w))). So the tables hold
numbers by word and by pair, and words and pairs that no class has twice need no row. A document's features are both
models' log ratio normalised by its length, and the largest such ratio of a stretch of one word, log(P_t(w) / P_o(w)), as one
insult in a long text does not show in a mean. A logistic curve of them that never falls, fitted on labelled documents that aren't counted, at most FIT_ROWS, gives the score.

The commonest words and pairs, BROADCAST_ROWS of them, go to every task; the documents' others are joined by shuffle,
without those that a bitmap shows to have no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import mixed, word_hashes

#: Discounts of a pair's count of one and of larger counts, and of a word's continuation counts: all of them up to this.
DISCOUNT_ONE, DISCOUNT, WORD_DISCOUNT = 1.0, 0.75, 4
#: Share of the labelled documents that the logistic curve is fitted on and that aren't counted; at most so many.
FIT_SHARE, FIT_ROWS = 0.2, 20_000
#: Rows of the tables that go to every task at most, 20 bytes each.
BROADCAST_ROWS = 4_000_000
#: Bits, a power of two, of the map of rows that are joined; a fuller map only lets more through.
MAP_BITS = 1 << 27
#: Bytes of labelled text whose pairs one task counts, on average, and pairs that a task adds up before sending them.
BUCKET_BYTES, CHUNK_PAIRS = 4 << 20, 1 << 19
#: Labels of up to so many documents go to every task.
BROADCAST_LABELS = 2_000_000
_SALTS = np.uint64(15)

PARTS = "kind byte, a long, b long, x1 long, x2 long, x3 double, x4 double"


def _pairs(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(h, w) of each word of a text: the word before it, 0 at the start, and itself."""
    words = word_hashes(text or b"", plain=True)
    return np.append(np.zeros(1, np.uint64), words)[:-1] if len(words) else words, words


def _keys(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(h * np.uint64(0x9E3779B97F4A7C15) + mixed(w))


def _unique(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, histories and words of a document's different pairs."""
    h, w = _pairs(text)
    keys, at = np.unique(_keys(h, w), return_index=True)
    return keys, h[at], w[at]


def discounted(n: np.ndarray) -> np.ndarray:
    return np.where(n == 1, DISCOUNT_ONE, np.minimum(n, DISCOUNT))


# --- counts ------------------------------------------------------------------------------------------------------


def counted(docs: DataFrame) -> DataFrame:
    """Counts of docs (text, toxic: 0 or 1), stored, in rows of three kinds.

    0: a pair (a, b) that a class has twice or more: toxic and ordinary documents with it. 1: part of a history a: sums of
    both classes and what is discounted from them. 2: part of a word a: its histories in each class and in any.
    Pairs meet by history and a few bits of the word, so a common history is counted in several tasks.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    buckets = max(1, -(-size // BUCKET_BYTES))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def chunk() -> pa.RecordBatch:
            h, w, toxic = (np.concatenate([x[k] for x in held]) for k in range(3))
            held.clear()
            bucket = (mixed(h ^ mixed(w & _SALTS)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((w, h, bucket))
            h, w, toxic, bucket = h[order], w[order], toxic[order], bucket[order]
            fresh = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (w[1:] != w[:-1]))))
            n_t = np.add.reduceat(toxic.astype(np.int64), fresh)
            n_o = np.diff(np.append(fresh, len(h))) - n_t
            h, w, bucket = h[fresh], w[fresh], bucket[fresh]
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            columns: list[list] = [[] for _ in range(6)]
            for i, j in zip(cuts, [*cuts[1:], len(h)], strict=True):
                heads = np.flatnonzero(np.concatenate(([True], h[i + 1 : j] != h[i : j - 1])))
                runs = np.diff(np.append(heads, j - i)).astype("<u4")
                parts = (h[i:j][heads].tobytes(), runs.tobytes(), w[i:j].tobytes(), n_t[i:j].astype("<u4").tobytes(), n_o[i:j].astype("<u4").tobytes())
                for column, value in zip(columns, (int(bucket[i]), *parts), strict=True):
                    column.append(value)
            kinds = [pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["bucket", "h", "runs", "w", "n_t", "n_o"])

        n = 0
        for batch in batches:
            for text, toxic in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
                _, h, w = _unique(text)
                held.append((h, w, np.full(len(h), toxic == 1)))
                n += len(h)
                if n >= CHUNK_PAIRS:
                    yield chunk()
                    n = 0
        if n:
            yield chunk()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[tuple]) -> Iterator[pa.RecordBatch]:
            h = np.concatenate([np.repeat(np.frombuffer(x[0], "<u8"), np.frombuffer(x[1], "<u4")) for x in held])
            w = np.concatenate([np.frombuffer(x[2], "<u8") for x in held])
            n_t, n_o = (np.concatenate([np.frombuffer(x[k], "<u4") for x in held]).astype(np.int64) for k in (3, 4))
            order = np.lexsort((w, h))
            h, w, n_t, n_o = h[order], w[order], n_t[order], n_o[order]
            fresh = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (w[1:] != w[:-1]))))
            h, w, n_t, n_o = h[fresh], w[fresh], np.add.reduceat(n_t, fresh), np.add.reduceat(n_o, fresh)
            seen = (n_t >= 2) | (n_o >= 2)
            yield rows(0, h[seen], w[seen], n_t[seen], n_o[seen], None, None)
            first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            yield rows(1, h[first], None, *(np.add.reduceat(x, first) for x in (n_t, n_o, discounted(n_t), discounted(n_o))))
            order = np.argsort(w, kind="stable")
            w, n_t, n_o = w[order], n_t[order], n_o[order]
            first = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1])))
            any_ = np.diff(np.append(first, len(w))).astype(float)
            yield rows(2, w[first], None, *(np.add.reduceat((x > 0).astype(np.int64), first) for x in (n_t, n_o)), any_, None)

        def rows(kind: int, a: np.ndarray, *columns: np.ndarray | None) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            made = [pa.nulls(len(a), k) if c is None else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int8)), pa.array(a.view(np.int64)), *made], ["kind", "a", "b", "x1", "x2", "x3", "x4"])

        now, held = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != now and held:
                    yield from done(held)
                    held = []
                now = row[0]
                held.append(row[1:])
        if held:
            yield from done(held)

    sent = docs.select(F.col("text").cast("string"), "toxic").mapInArrow(common.lean(send), "bucket int, h binary, runs binary, w binary, n_t binary, n_o binary")
    return common.stored(sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(common.lean(add), PARTS), "pair-counts")


def _kept(n: Column) -> Column:
    """What is left of a pair's count after its discount."""
    return F.when(n > 1, n - DISCOUNT).otherwise(0.0)


def _word_kept(n: Column) -> Column:
    return F.greatest(n - WORD_DISCOUNT, F.lit(0)).cast("double")


def ratios(parts: DataFrame) -> tuple[DataFrame, float]:
    """(key, n, a, b), stored, and the ratio of a word without a row; parts: from counted().

    Of a pair a is what it adds beyond its backoff and b is 0. Of a word a is l(h) and b is u(w) beyond that of a word
    without a row. n: of a pair its documents, of a word its pairs.
    """
    heads = parts.where("kind = 1").groupBy("a").agg(*[F.sum(f"x{k}").alias(f"x{k}") for k in (1, 2, 3, 4)], F.count("*").alias("rows"))
    tails = parts.where("kind = 2").groupBy("a").agg(F.sum("x1").alias("c_t"), F.sum("x2").alias("c_o"), F.sum("x3").alias("c"))
    heads, tails = common.stored(heads, "histories"), common.stored(tails, "continuations")
    taken = [F.sum(F.col(c) - _word_kept(F.col(c))) for c in ("c_t", "c_o")]
    total = tails.agg(F.sum("c_t"), F.sum("c_o"), F.sum("c"), *taken).first()
    types = "key long, n double, a float, b float"
    if not (total[0] and total[1] and total[3] and total[4]):
        return parts.sparkSession.createDataFrame([], types), 0.0
    c_t, c_o, c, m_t, m_o = map(float, total)
    p_t, p_o = (_word_kept(F.col(n)) / of + m / of * F.col("c") / c for n, of, m in (("c_t", c_t, m_t), ("c_o", c_o, m_o)))
    base = float(np.log(m_t / c_t) - np.log(m_o / c_o))
    left = [F.when(F.col(n) > 0, F.log(F.col(m) / F.col(n))).otherwise(0.0) for n, m in (("x1", "x3"), ("x2", "x4"))]
    h = heads.select(F.col("a").alias("key"), F.col("x1").cast("double").alias("n_h"), (left[0] - left[1]).alias("l"))
    w = tails.select(F.col("a").alias("key"), F.col("c").alias("n_w"), (F.log(p_t) - F.log(p_o) - base).alias("u"))
    zero = F.lit(0.0)
    words = h.join(w, "key", "full").select(
        "key", (F.coalesce("n_h", zero) + F.coalesce("n_w", zero)).alias("n"), F.coalesce("l", zero).cast("float").alias("a"), F.coalesce("u", zero).cast("float").alias("b")
    ).where("abs(a) > 1e-12 or abs(b) > 1e-12")  # the others are as good as no row
    pairs = parts.where("kind = 0").select(F.col("a").alias("h"), F.col("b").alias("w"), F.col("x1").alias("n_t"), F.col("x2").alias("n_o"))
    # the rows of a key are at most its count, so no hot history or word is one task's
    of_h = heads.select(F.col("a").alias("h"), F.col("x3").alias("m_t"), F.col("x4").alias("m_o"), F.col("x1").cast("long").alias("n1"), F.col("x2").alias("n2"))
    of_h = of_h.select("h", "m_t", "m_o", (F.col("n1") + F.col("n2")).alias("rows"))
    of_w = tails.select(F.col("a").alias("w"), p_t.alias("p_t"), p_o.alias("p_o"), F.col("c").cast("long").alias("rows"))
    found = common.look_up(common.look_up(pairs, of_h, ["h"], "rows", F.col("w")), of_w, ["w"], "rows", F.col("h"))
    more = [F.log1p(F.when(F.col(n) > 1, _kept(F.col(n)) / (F.col(m) * F.col(p))).otherwise(0.0)) for n, m, p in (("n_t", "m_t", "p_t"), ("n_o", "m_o", "p_o"))]
    rated = found.select("h", "w", (F.col("n_t") + F.col("n_o")).cast("double").alias("n"), (more[0] - more[1]).cast("float").alias("a"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, w = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(_keys(h, w).view(np.int64)), batch.column(2), batch.column(3), pa.array(np.zeros(len(h), np.float32))], ["key", "n", "a", "b"])

    out = common.stored(words.union(rated.mapInArrow(common.lean(named), types)), "toxicity-ratios")
    common.dropped(heads)
    common.dropped(tails)
    return out, base


class Table:
    """Ratios by word and pair: the commonest in arrays for all tasks, the others as a table with a bitmap of them."""

    def __init__(self, rated: DataFrame, base: float):
        self.base, self.cold, bitmap = base, None, None
        hot = rated
        if rated.count() > BROADCAST_ROWS:
            level = F.floor(F.log2("n") * 8)
            least, total = None, 0
            for r in sorted(rated.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r["level"]):  # some hundred levels
                total += r["rows"]
                if total > BROADCAST_ROWS:
                    break
                least = r["level"]
            hot = rated.where(level >= least) if least is not None else rated.limit(0)
            self.cold = rated.where(level < least) if least is not None else rated
            bit = F.col("key").bitwiseAND(F.lit(MAP_BITS - 1))
            words = self.cold.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(key & 63))")).alias("bits")).toArrow()
            bitmap = np.zeros(max(1, MAP_BITS // 64), np.int64)
            bitmap[words.column("word").to_numpy().astype(np.int64)] = words.column("bits").to_numpy().astype(np.int64)
        got = hot.select("key", "a", "b").toArrow()
        keys = got.column("key").to_numpy().astype(np.int64)
        order = np.argsort(keys)
        numbers = [got.column(c).to_numpy().astype(np.float32)[order] for c in ("a", "b")]
        self.sent = rated.sparkSession.sparkContext.broadcast((keys[order], *numbers, bitmap))


#: Sums are of whole numbers of these parts, so they depend neither on their order nor on where a row is looked up.
PARTS_OF_ONE = float(2**32)


def _split(text: bytes | None, table: tuple) -> tuple[int, int, int, float, tuple[np.ndarray, ...]]:
    """Words, pairs, sum in PARTS_OF_ONE and greatest b of what is in the arrays, and (keys, times as a, times as b) that the bitmap lets through."""
    keys, a, b, bitmap = table
    own, h, w = _unique(text)
    words, at = np.unique(np.append(h, w), return_inverse=True)
    all_ = np.append(own, words).view(np.int64)
    x = np.append(np.ones(len(own)), np.bincount(at[: len(h)], minlength=len(words)))
    y = np.append(np.zeros(len(own)), np.bincount(at[len(h) :], minlength=len(words)))
    hit, place = np.zeros(len(all_), bool), np.zeros(len(all_), np.int64)
    if len(keys):
        place = np.minimum(np.searchsorted(keys, all_), len(keys) - 1)
        hit = keys[place] == all_
    p = place[hit]
    total = int(np.floor((x[hit] * a[p].astype(float) + y[hit] * b[p].astype(float)) * PARTS_OF_ONE + 0.5).astype(np.int64).sum())
    top = float(b[p][y[hit] > 0].max(initial=0.0))
    cold = np.flatnonzero(~hit) if bitmap is not None else np.empty(0, np.int64)
    if len(cold):
        bit = all_[cold] & (64 * len(bitmap) - 1)
        cold = cold[(bitmap[bit >> 6] >> (bit & 63)) & 1 == 1]
    return len(w), len(own), total, top, (all_[cold], x[cold].astype(np.int32), y[cold].astype(np.int32))


def likelihoods(docs: DataFrame, table: Table, keep_text: bool = False) -> DataFrame:
    """docs, without text unless it is kept, with n_pairs, mean_ratio and top_ratio; the latter is at least that of a word without a row, and 0."""
    rest = [c for c in docs.columns if c not in ("n_pairs", "mean_ratio", "top_ratio") and (c != "text" or keep_text)]
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*[F.col(f"`{c}`") for c in rest]).schema)
    sent, has_cold = table.sent, table.cold is not None
    text = F.col("text").cast("string")
    row = [F.xxhash64(text).alias("row_key")] if has_cold else []  # equal texts share theirs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            got = [_split(t, known)[1:4] for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
            columns = [pa.array([g[k] for g in got], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*rest, *["row_key"] * has_cold, "n_pairs", "own_sum", "own_top"])

    rows = docs.select(*[F.col(f"`{c}`") for c in rest], *row, text.alias("pairs_of"))
    rows = rows.mapInArrow(common.lean(run), f"{kinds}{'row_key long, ' if has_cold else ''}n_pairs long, own_sum long, own_top double")
    total, top = F.col("own_sum"), F.col("own_top")
    if has_cold:

        def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = sent.value
            for batch in batches:
                names, found = [], []
                for name, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    own = _split(t, known)[4]
                    names.append(np.full(len(own[0]), name, np.int64))
                    found.append(own)
                columns = [np.concatenate([np.empty(0, np.int64), *names])] + [np.concatenate([np.empty(0, k), *[f[i] for f in found]]) for i, k in enumerate((np.int64, np.int32, np.int32))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row_key", "key", "x", "y"])

        texts = docs.select(F.xxhash64(text).alias("row_key"), text.alias("pairs_of")).groupBy("row_key").agg(F.count("*").alias("copies"))
        # a text that stands in many rows is looked up once in each task that holds it, and once again by distinct()
        parts = docs.select(F.xxhash64(text).alias("row_key"), text.alias("pairs_of")).mapInArrow(common.lean(others), "row_key long, key long, x int, y int")
        parts = parts.repartition("key").distinct().join(table.cold, "key")
        a, b = F.col("a").cast("double"), F.col("b").cast("double")
        exact = F.floor((F.col("x") * a + F.col("y") * b) * F.lit(PARTS_OF_ONE) + 0.5)
        sums = parts.groupBy("row_key").agg(F.sum(exact).alias("more"), F.max(F.when(F.col("y") > 0, b)).alias("top"))
        sums = common.stored(sums.join(texts, "row_key"), "joined-likelihoods")
        rows = common.look_up(rows, sums, ["row_key"], "copies", F.col("n_pairs"))
        total = total + F.coalesce("more", F.lit(0))
        top = F.greatest(top, F.coalesce("top", F.lit(0.0)))
    some = F.col("n_pairs") > 0
    mean = F.when(some, total / F.lit(PARTS_OF_ONE) / F.col("n_pairs") + F.lit(table.base)).otherwise(0.0)
    top = F.when(some, F.greatest(top + F.lit(table.base), F.lit(0.0))).otherwise(0.0)
    return rows.select(*[F.col(f"`{c}`") for c in rest], "n_pairs", mean.alias("mean_ratio"), top.alias("top_ratio"))


# --- scores ------------------------------------------------------------------------------------------------------


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Weights, the intercept first, by Newton's method with halved steps; ridge on standardised columns, not on the intercept."""
    mean, size = (x.mean(0), x.std(0)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    size = np.where(size > 1e-9, size, 1.0)
    z = np.column_stack([np.ones(len(x)), (x - mean) / size])
    w, keep = np.zeros(z.shape[1]), np.diag([1e-6] + [ridge] * (z.shape[1] - 1))
    prior = (y.sum() + 0.5) / (len(y) + 1)
    w[0] = np.log(prior / (1 - prior))

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ keep @ w / 2)

    for _ in range(100 if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p))[:, None]) + keep, z.T @ (y - p) - keep @ w)
        now, share = loss(w), 1.0
        while share > 1e-6 and loss(w + share * step) > now:
            share /= 2
        w = w + share * step
        if np.abs(share * step).max() < 1e-9:
            break
    w[1:] /= size
    w[0] -= w[1:] @ mean
    return w


def rising(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """logistic() without the columns that would lower the score: what speaks for the toxic class never does."""
    kept = np.arange(x.shape[1])
    while True:
        w = logistic(x[:, kept], y)
        if not len(kept) or w[1:].min() >= 0:
            return np.concatenate([w[:1], np.bincount(kept, w[1:], x.shape[1])])
        kept = np.delete(kept, w[1:].argmin())


def labelled(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, toxic) of labelled documents that aren't held out: those to count and those to fit the curve on."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.where(~held_out("label_id"))
    n = marks.count()
    if n <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    known = docs.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")
    share = min(FIT_SHARE, FIT_ROWS / max(1, n))
    fitted = F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))
    return known.where(~fitted), known.where(fitted)


def trained(docs: DataFrame, labels: DataFrame) -> tuple[Table, np.ndarray]:
    """The ratios and the logistic curve's weights, learned as score() says."""
    known, held = labelled(docs, labels)
    parts = counted(known)
    table = Table(*ratios(parts))
    common.dropped(parts)
    rated = likelihoods(held, table).select("toxic", *[c.alias(f"x{k}") for k, c in enumerate(_shaped())])
    rows = rated.collect()  # about FIT_ROWS of three numbers
    return table, rising(np.array([r[1:] for r in rows], float).reshape(-1, 2), np.array([r[0] for r in rows], float))


def held_out(name: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 3 is 1; not for a null doc_id."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _shaped() -> list[Column]:
    """The root of the mean ratio, as it says more near 0, and the largest."""
    return [F.signum("mean_ratio") * F.sqrt(F.abs("mean_ratio")), F.col("top_ratio")]


def score(docs: DataFrame, labels: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs (doc_id, text and any other columns) with n_pairs, mean_ratio, top_ratio and score, a row for each.

    Learns from labels (doc_id, toxic) of documents that aren't held out. Null labels are no labels; of several for a
    doc_id the largest counts. A null doc_id has no label. Null and empty texts have ratios of 0 and so the
    score of a document whose words say nothing. Without labels of both classes that is the smoothed
    share of toxic labels among those the curve is fitted on, for all. Columns of the new names are replaced.
    """
    fitted, w = trained(docs, labels)
    a, b = _shaped()
    z = F.lit(float(w[0])) + a * float(w[1]) + b * float(w[2])
    return likelihoods(docs, fitted, keep_text).withColumn("score", 1 / (1 + F.exp(-z)))
