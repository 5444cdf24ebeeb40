"""Mixing sources to target weights by fixed-length blocks of words."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WEIGHTS, MOST = (5.0, 2.0, 1.0), 3.0
BLOCK, SHARD_BLOCKS = 64, 4096
#: Characters of mixed text that a task holds before it hands them on.
CUT_CHARS = 4 << 20
#: Documents of a source's bucket, on average: a window runs over each.
BUCKET_DOCS = 1000


def sized(docs: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, source, size (words), text_hash and start of each document: its place in its source's stream.

    A source's documents stand by bucket (a hash of doc_id and text), doc_id and text; it has as many buckets as its
    number of documents asks for, and starts are sums over buckets and within them, so no task takes a whole source.
    """
    text = F.col("text").cast("string")
    rows = common.stored(docs.select("doc_id", "source", common.word_count(text).alias("size"), F.xxhash64(text).alias("text_hash")), "mix-sizes")
    counts = rows.groupBy("source").agg(F.count("*").alias("docs"))
    counts = counts.select(F.col("source").alias("of"), F.ceil(F.col("docs") / BUCKET_DOCS).alias("buckets"), "docs")
    spread = F.xxhash64(F.lit(seed), "doc_id", "text_hash")
    # null-safe, so that documents without source are one
    rows = rows.withColumn("of", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    counts = counts.withColumn("of", F.coalesce(F.concat(F.lit("s"), "of"), F.lit("")))
    rows = common.look_up(rows, counts, ["of"], "docs", spread).withColumn("bucket", F.pmod(spread, F.col("buckets")))
    before = Window.partitionBy("of", "bucket").orderBy("doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    rows = common.stored(rows.withColumn("own_start", F.coalesce(F.sum("size").over(before), F.lit(0))), "mix-buckets")
    sums = rows.groupBy("of", "bucket").agg(F.sum("size").alias("bucket_size"), F.count("*").alias("docs"))
    earlier = Window.partitionBy("of").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("of", "bucket", "docs", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)).alias("bucket_start"))
    joined = common.look_up(rows, common.stored(sums, "mix-starts"), ["of", "bucket"], "docs", F.col("text_hash"))
    return joined.select("doc_id", "source", "size", "text_hash", (F.col("bucket_start") + F.col("own_start")).alias("start"))


def plan(rows: DataFrame, block: int = BLOCK, most: float = MOST) -> DataFrame:
    """source_no, source, source_size, target, blocks and taken_blocks of each source, by code point, null last; stored.

    Targets share the sum of sizes by weight; none is above `most` times its size, the excess is reshared by weight. So
    each is min(level * weight, most * size) for one level: by rising most * size / weight the first sources are full,
    and the level is what they leave by the weight of the others, at the first source that does not become full by it.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))  # a row a source, as below
    number = F.row_number().over(by) - 1
    weight = F.array(*map(F.lit, WEIGHTS))[F.pmod(number, F.lit(len(WEIGHTS)))]
    out = common.stored(sizes.select(number.alias("source_no"), "source", "source_size", weight.alias("weight")), "mix-sources")
    total = out.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("double").alias("t"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("w")).first()
    full = F.col("source_size") * most / F.col("weight")
    earlier = Window.orderBy("full", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    spent, weighed = (F.coalesce(F.sum(c).over(earlier), F.lit(0.0)) for c in (F.col("source_size") * most, F.col("weight")))
    levels = out.withColumn("full", full).select("full", "source_no", ((total["t"] - spent) / (total["w"] - weighed)).alias("level"))
    level = levels.where("full >= level").agg(F.min_by("level", F.struct("full", "source_no"))).first()[0]
    target = F.least(F.lit(level if level is not None else float("inf")) * F.col("weight"), F.col("source_size") * most)
    out = out.withColumn("target", F.when(F.col("source_size") > 0, target).otherwise(0.0)).withColumn("blocks", F.ceil(F.col("source_size") / block))
    # in blocks of the source's mean length, as its last may be short; at most MOST turns of all of them
    taken = F.least(F.round(F.col("target") / F.col("source_size") * F.col("blocks")).cast("long"), int(most) * F.col("blocks"))
    out = out.withColumn("taken_blocks", F.when(F.col("source_size") > 0, taken).otherwise(0).cast("long"))
    return common.stored(out.select("source_no", "source", "source_size", "target", "blocks", "taken_blocks"), "mix-plan")


def _rng(*key: int) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(int.from_bytes(hashlib.sha256(repr(key).encode()).digest()[:16], "little")))


def drawn(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each kind are in a random choice of n items out of counts, all choices being equally likely.

    Each item is chosen by itself with the probability n / N; then so many random items are taken out, or put in, as n
    asks for. Numbers of any size do.
    """
    total = int(counts.sum())
    left = rng.binomial(counts, n / total) if total else counts.copy()
    gap = int(left.sum()) - n
    ends = np.cumsum(left if gap > 0 else counts - left)
    moved = np.empty(0, np.int64)
    while len(moved) < abs(gap):
        moved = np.unique(np.append(moved, rng.integers(0, ends[-1], abs(gap) - len(moved))))
    change = np.bincount(np.searchsorted(ends, moved, side="right"), minlength=len(counts))
    return left - change if gap > 0 else left + change


def shard_counts(shard: int, totals: np.ndarray, shard_blocks: int, seed: int, known: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source in an output shard, and in all shards before it.

    Draws are multinomial without replacement, so over all shards each source has just its total. A tree of
    halves makes any shard's draw in logarithmic time: each node splits its counts between its two sides, with
    random numbers seeded by the node; all shards below see the same. known keeps the nodes of the last path.
    """
    low, high, before = 0, -(-int(totals.sum()) // shard_blocks), np.zeros_like(totals)
    counts, path = totals, {}
    while high - low > 1:
        mid = (low + high) // 2
        left = (known or {}).get((low, high))
        if left is None:
            left = drawn(counts, (mid - low) * shard_blocks, _rng(seed, low, high))
        path[low, high] = left
        if shard < mid:
            counts, high = left, mid
        else:
            counts, before, low = counts - left, before + left, mid
    if known is not None:
        known.clear()
        known.update(path)
    return counts, before


def permuted(i: np.ndarray, n: int, key: tuple) -> np.ndarray:
    """The places of indices i in a pseudorandom permutation of range(n): four Feistel rounds, walked until below n."""
    half = np.uint64(max(1, -(-max(1, n - 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    keys = _rng(*key).integers(0, 1 << 63, 4, np.uint64)
    out, todo = i.astype(np.uint64), np.ones(len(i), bool)
    while todo.any():
        a, b = out[todo] >> half, out[todo] & mask
        for k in keys:
            f = (b ^ k) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            a, b = b, a ^ ((f >> np.uint64(32)) & mask)
        out[todo] = (a << half) | b
        todo &= out >= n
    return out.astype(np.int64)


def slots(sources: DataFrame, seed: int = 0, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(shard, slot, source_no, turn, block): the block that stands in each slot of each output shard.

    A source's slots are numbered over all shards; slot q takes block p(q mod n) of its n blocks, where p is
    the permutation of its turn q div n. So no block is taken once more before all others are. Tasks hold two numbers a source.
    """
    spark = sources.sparkSession
    numbers = sources.select("source_no", "taken_blocks", "blocks").orderBy("source_no").toArrow()
    sent = spark.sparkContext.broadcast(tuple(numbers.column(c).to_numpy().astype(np.int64) for c in ("taken_blocks", "blocks")))
    n_shards = -(-int(sent.value[0].sum()) // shard_blocks)

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, blocks = sent.value
        known: dict = {}
        for frame in frames:
            for shard in frame["id"]:
                counts, before = shard_counts(int(shard), totals, shard_blocks, seed, known)
                held = np.flatnonzero(counts)
                numbers = np.repeat(held, counts[held])
                q = np.arange(len(numbers)) - np.repeat(np.cumsum(counts[held]) - counts[held], counts[held]) + before[numbers]
                turn, place = np.divmod(q, blocks[numbers]) if len(q) else (q, q)
                for s in held:
                    for t in np.unique(turn[numbers == s]):
                        at = (numbers == s) & (turn == t)
                        place[at] = permuted(place[at], int(blocks[s]), (seed, int(s), int(t)))
                where = _rng(seed, int(shard), -1).permutation(len(numbers))
                yield pd.DataFrame({"shard": int(shard), "slot": where, "source_no": numbers, "turn": turn, "block": place})

    parts = min(max(1, n_shards), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.range(0, n_shards, 1, parts).mapInPandas(common.lean(draw), "shard long, slot long, source_no int, turn long, block long")


def mix(docs: DataFrame, seed: int = 0, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sources, pieces) of a mix of docs (doc_id, text, source).

    documents: doc_id, source, source_no, source_size, target, size, text_hash and start in the source's stream. sources: see
    plan(). pieces: for each slot (shard, slot, source_no, turn, block) the parts of documents in its block: doc_id, text_hash
    and size of the document, its start, from (words of the document before the part) and length. A null text has no words;
    documents without words have no pieces. Rows of one doc_id count apart. An empty table or one without words gives no pieces.
    """
    rows = common.stored(sized(docs, seed), "mix-documents")
    sources = plan(rows, block)
    counts = rows.groupBy("source").agg(F.count("*").alias("docs"))
    named = sources.join(counts, sources["source"].eqNullSafe(counts["source"])).select(sources["source"], "source_no", "source_size", "target", "docs")
    of = F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))
    rows = common.look_up(rows.withColumn("of", of), named.withColumn("of", of).drop("source"), ["of"], "docs", F.col("text_hash")).drop("of")
    cut = rows.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))))
    first = F.greatest(F.col("start"), F.col("block") * block)
    last = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    parts = cut.select("source_no", "block", "doc_id", "text_hash", "size", "start", (first - F.col("start")).alias("from"), (last - first).alias("length"))
    # slots grow with the corpus, but Spark sees only a few shard numbers there: never broadcast them
    return rows, sources, slots(sources, seed, shard_blocks).hint("merge").join(parts, ["source_no", "block"])


def taken_text(text: str, spans: list[tuple]) -> str:
    """The words of spans (turn, from, length) by turn and place; runs of a turn keep the white space within them."""
    data = np.frombuffer(text.encode(), np.uint8)
    inside = np.concatenate(([False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    runs: list[list] = []
    for turn, first, length in sorted(spans):
        if runs and runs[-1][0] == turn and runs[-1][2] == first:
            runs[-1][2] += length
        else:
            runs.append([turn, first, first + length])
    return "\n".join(bytes(data[starts[a] : ends[min(b, len(ends)) - 1]]).decode() for _, a, b in runs if a < len(starts))


def mixed_documents(docs: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Documents as a mix takes them: each with the words it takes, repeats after one another, n_chars anew.

    The columns are those of docs, which needs doc_id, text, source and n_chars. Documents of which it takes no word are
    left out. Rows of one doc_id take part each, with words of their own; rows equal in doc_id, source and text come out
    as one, with the words that the mix takes of all of them. Rows without doc_id are like others.
    """
    names = docs.columns
    rows, _, pieces = mix(docs, seed, block)
    keys = ["source_no", "doc_id", "text_hash", "size"]
    # spans of one document; copies of one row follow each other by start
    helper = common.prefix(names, "mix_")
    doc, source, hashed, size, own_spans = (f"{helper}{c}" for c in ("doc", "source", "hash", "size", "spans"))
    spans = pieces.groupBy(*keys).agg(F.collect_list(F.struct("start", "turn", "from", "length")).alias(own_spans))
    of = rows.select("source", "source_no").distinct()
    spans = spans.join(of, "source_no").select(
        F.col("doc_id").alias(doc), F.col("source").alias(source), F.col("text_hash").alias(hashed), F.col("size").alias(size), own_spans
    )

    def cut(batches: Iterator) -> Iterator:
        """A document at a time; what is made goes out by CUT_CHARS of text."""
        import pyarrow as pa

        for batch in batches:
            texts, lists = batch.column("text"), batch.column(own_spans)
            ends = lists.offsets.to_numpy()
            fields = [lists.values.field(c).to_numpy() for c in ("turn", "start", "from", "length")]
            first, made, held = 0, [], 0
            for i in range(batch.num_rows):
                turn, start, at, length = (f[ends[i] : ends[i + 1]].tolist() for f in fields)
                made.append(taken_text(texts[i].as_py() or "", [((t, s), a, n) for t, s, a, n in zip(turn, start, at, length)]))
                held += len(made[-1])
                if held >= CUT_CHARS or i + 1 == batch.num_rows:
                    new = {"text": pa.array(made, pa.string()), "n_chars": pa.array([len(t) for t in made], pa.int64())}
                    yield pa.RecordBatch.from_arrays([new[c] if c in new else batch.column(c)[first : i + 1] for c in names], names)
                    first, made, held = i + 1, [], 0

    kinds = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else 'long' if f.name == 'n_chars' else f.dataType.simpleString()}" for f in docs.schema)
    text = F.col("text").cast("string")
    both = docs.withColumn(f"{helper}own_hash", F.xxhash64(text)).withColumn(f"{helper}own_size", common.word_count(text))
    on = [F.col(f"{helper}own_hash") == F.col(hashed), F.col(f"{helper}own_size") == F.col(size), F.col("doc_id").eqNullSafe(F.col(doc)), F.col("source").eqNullSafe(F.col(source))]
    both = both.join(spans, on).dropDuplicates([f"{helper}own_hash", f"{helper}own_size", "doc_id", "source"])
    return both.select(*[F.col(f"`{c}`") for c in names], own_spans).mapInArrow(common.lean(cut), kinds)
