"""Jaccard join on word shingles with signature trees.

Two sets x and y link when q * |x n y| >= p * |x u y|. The steps, each exact:

1. Documents of equal sets form a class, which goes on as one node under its smallest doc_id.
2. Linked sets of s tokens together differ in at most d(s) = s(q - p)/(q + p) tokens. The hash space is cut into
   m > d segments; then two linked sets agree in m - d whole segments. A node emits a key for each non-empty segment;
   m comes from a ladder, so a node uses one or two values. Passages that many documents share would tie documents
   that aren't alike, so tokens are graded by how many documents hold them (counted over all documents in a table of
   fixed size) and keys are first of tokens below the lowest grade. Any split of tokens keeps this exact: a
   set with no more empty segments than m - d - 1 agrees in a non-empty one, and a set with more emits keys of the
   next grade too, the last of all its tokens.
   Nodes of one key are tied to its smallest node, first within each task, so a key held by many nodes is a few
   rows when it is shuffled.
3. Connected nodes form a block, which holds all their links. One task builds signature trees over a block and
   traverses them together. Nodes hold OR-combined token bitmaps, size ranges and the most bitmap collisions.
   Common bits and collisions bound the overlap of any two sets below a pair of nodes; pairs below the overlap
   that a link needs are pruned. Surviving sets are compared token by token, unless already in one component.
4. Larger blocks are dealt out by size band and hash. First each part is joined with itself and with an anchor of
   each near band, which ties together groups of near copies. Then sets outside the block's main component, in
   parts of bounded size, meet every part of near bands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, graph
from .shingles import mixed, shingle_set

#: A block of more sets or tokens is dealt out over several tasks.
BLOCK_SETS, BLOCK_TOKENS = 512, 4_000_000
FANOUT = 8


# --- keys of a set ---------------------------------------------------------------------------------------------

#: Counters of tokens, and how far above the counters' noise each grade begins.
COUNTERS, GRADES = 1 << 22, (32, 256, 2048)
_CHUNK = 1 << 16


def grades(docs: DataFrame, words: int) -> np.ndarray:
    """For each counter the number of GRADES that its tokens reach; a document counts once for each of its tokens.

    Each task adds up its documents; tasks' counters meet in chunks, added as they come. Only grades reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = batch.column(0).slice(at, 256).cast(pa.binary()).to_pylist()
                tokens = np.concatenate([shingle_set(t, words) for t in texts])
                at_, n = np.unique((tokens & np.uint64(COUNTERS - 1)).astype(np.uint32), return_counts=True)
                own[at_] += n.astype(np.uint32)
        parts = np.minimum(own, 65_535).astype("<u2").reshape(-1, _CHUNK)
        for k, part in enumerate(parts):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["chunk", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums.setdefault(k, np.zeros(_CHUNK, np.int64))
                sums[k] += np.frombuffer(part, "<u2")
        for k, total in sums.items():
            noise = total.mean()
            grade = sum((total > noise + 6 * np.sqrt(noise) + g).astype(np.uint8) for g in GRADES)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([grade.tobytes()], pa.binary())], ["chunk", "grades"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(common.lean(count), "chunk int, counts binary")
    out = np.zeros(COUNTERS, np.uint8)
    for row in counted.repartition("chunk").mapInArrow(common.lean(add), "chunk int, grades binary").collect():  # a byte a counter
        out[row["chunk"] * _CHUNK : (row["chunk"] + 1) * _CHUNK] = np.frombuffer(row["grades"], np.uint8)
    return out


def _spare(d: int) -> int:
    """Segments beyond d + 1, so that some may be empty."""
    return 2 + d // 16


def _ladder(top: int) -> list[tuple[int, int]]:
    """(segments, differences that they allow), ascending, until top differences fit."""
    out, m = [], 4
    while not out or out[-1][1] < top:
        out.append((m, next(d for d in range(m, -1, -1) if d + 1 + _spare(d) <= m)))
        m = -(-m * 7 // 5)
    return out


class Keys:
    def __init__(self, p: int, q: int, grade: np.ndarray | None = None):
        self.p, self.q, self.ladder, self.grade = p, q, _ladder(1000), grade

    def segments(self, n: int) -> list[tuple[int, int]]:
        """(segments, differences) that a set of n tokens needs for partners of any possible size."""
        p, q = self.p, self.q
        low, high = ((n + k) * (q - p) // (q + p) for k in (-(-p * n // q), q * n // p))
        if high < 1:
            return []
        if self.ladder[-1][1] < high:
            self.ladder = _ladder(2 * high)
        first, last = (next(i for i, (_, d) in enumerate(self.ladder) if d >= max(1, k)) for k in (low, high))
        return [(m, min(d, high)) for m, d in self.ladder[first : last + 1]]

    def of(self, s: np.ndarray) -> np.ndarray:
        """Of a sorted set: for each m and grade, a hash for each segment's part of it."""
        out = []
        parts = [s]
        if self.grade is not None and len(s):
            own = self.grade[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
            parts = [s[own <= g] for g in range(len(GRADES))] + [s]
        sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(x + np.uint64(1))))) for x in parts]
        for m, differences in self.segments(len(s)):
            for g, x in enumerate(parts):
                place = (x >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)
                ends = np.searchsorted(place, np.arange(m + 1, dtype=np.uint64))
                own = sums[g][ends[1:]] - sums[g][ends[:-1]]
                number = np.arange(m, dtype=np.uint64)
                full = ends[1:] > ends[:-1]
                enough = m - full.sum() <= m - differences - 1
                if enough or g < len(parts) - 1:
                    own, number = own[full], number[full]
                salt = np.uint64(m * 8 + (g if g < len(parts) - 1 else 7))
                out.append(mixed(own ^ mixed(number * np.uint64(0x9E3779B97F4A7C15) + salt)))
                if enough:
                    break
        return np.concatenate(out) if out else np.empty(0, np.uint64)


def _sets(docs: DataFrame, words: int, p: int, q: int) -> DataFrame:
    grade = docs.sparkSession.sparkContext.broadcast(grades(docs, words))  # COUNTERS bytes

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = Keys(p, q, grade.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                sets = [shingle_set(t, words) for t in some.column(1).cast(pa.binary()).to_pylist()]
                made = [keys.of(s) for s in sets]
                prints = [np.array([mixed(s ^ np.uint64(c)).sum() for s in sets], np.uint64).view(np.int64) for c in (0x5BF03635, 0x27D4EB2F)]
                flat = np.concatenate([np.empty(0, np.uint64), *made]).view(np.int64)
                ends = np.concatenate(([0], np.cumsum([len(k) for k in made]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                values = [some.column(0), pa.array([len(s) for s in sets], pa.int64()), *map(pa.array, prints), lists]
                yield pa.RecordBatch.from_arrays(values, ["doc_id", "n_shingles", "print_a", "print_b", "segment_keys"])

    types = "doc_id long, n_shingles long, print_a long, print_b long, segment_keys array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(common.lean(make), types)


# --- nodes that share a key ------------------------------------------------------------------------------------


def _tie_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, keys) to (key, a, b): one row with a = b for each key of a batch; a row of its own key for each tie."""
    for batch in batches:
        lists = batch.column(1)
        counts = np.diff(lists.offsets.to_numpy())
        key, node = lists.flatten().to_numpy(), np.repeat(batch.column(0).to_numpy(), counts)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        fresh = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.empty(0, bool)
        least = node[np.flatnonzero(fresh)][np.cumsum(fresh) - 1] if len(key) else node
        ties = np.unique(np.stack((least, node), 1)[least != node], axis=0)
        own = mixed(mixed(ties[:, 0].astype(np.uint64)) + ties[:, 1].astype(np.uint64)).view(np.int64)
        columns = [np.concatenate(x) for x in ((key[fresh], own), (node[fresh], ties[:, 0]), (node[fresh], ties[:, 1]))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "a", "b"])


def _tie_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, a, b) sorted by key to edges: a to b, and each a to the first a of its key."""
    held_key, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, a, b = (batch.column(k).to_numpy() for k in range(3))
        fresh = np.concatenate(([key[0] != held_key if held_key is not None else True], key[1:] != key[:-1]))
        runs = np.cumsum(fresh)
        firsts = np.concatenate(([held if held is not None else 0], a[fresh]))
        first = firsts[runs]
        held_key, held = key[-1], first[-1]
        pairs = np.concatenate((np.stack((first, a), 1)[first != a], np.stack((a, b), 1)[a != b]))
        pairs = np.unique(pairs, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


# --- signature trees -------------------------------------------------------------------------------------------


class SignatureTree:
    """Levels from the sets themselves up to one root; level k + 1 combines FANOUT neighbours of level k."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        sizes = np.array([len(s) for s in sets])
        self.order = np.lexsort(([int(s[0]) for s in sets], sizes))
        low = sizes[self.order]
        bitmap = np.zeros((len(sets), bits), bool)
        for row, i in enumerate(self.order):
            bitmap[row, (sets[i] % np.uint64(bits)).astype(np.int64)] = True
        lost = low - bitmap.sum(1)
        ors = np.packbits(bitmap, axis=1).view(np.uint64)
        self.levels = [(ors, low, low, lost)]
        while len(ors) > 1:
            at = np.arange(0, len(ors), FANOUT)
            ors, lost = np.bitwise_or.reduceat(ors, at), np.maximum.reduceat(lost, at)
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(self.levels[-1][2], at)
            self.levels.append((ors, low, high, lost))


def candidates(x: SignatureTree, y: SignatureTree, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets, one of each tree, that no bound rules out; of a tree with itself, each pair of two sets once."""
    depth = max(len(x.levels), len(y.levels))
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for level in range(depth - 1, -1, -1):
        kx, ky = min(level, len(x.levels) - 1), min(level, len(y.levels) - 1)
        (xo, xl, xh, xc), (yo, yl, yh, yc) = x.levels[kx], y.levels[ky]
        keep = (q * xh[i] >= p * yl[j]) & (q * yh[j] >= p * xl[i])
        if x is y:
            keep &= (i < j) | ((i == j) & (level > 0))
        i, j = i[keep], j[keep]
        need = -(-p * (xl[i] + yl[j]) // (p + q))
        same = np.concatenate([np.empty(0, np.int64), *(np.bitwise_count(xo[i[a : a + 512]] & yo[j[a : a + 512]]).sum(1, dtype=np.int64) for a in range(0, len(i), 512))])
        keep = same + np.minimum(xc[i], yc[j]) >= need
        i, j = i[keep], j[keep]
        if level:
            i, j = _children(i, j, x, level - 1, 0), _children(i, j, y, level - 1, 1)
            inside = (i >= 0) & (j >= 0)
            i, j = i[inside], j[inside]
    return x.order[i], y.order[j]


def _children(i: np.ndarray, j: np.ndarray, tree: SignatureTree, level: int, side: int) -> np.ndarray:
    """Of pairs, the FANOUT squared pairs of children: the child of one side, -1 where there is none."""
    own = (j if side else i)[:, None]
    if level < len(tree.levels) - 1:
        child = own * FANOUT + np.arange(FANOUT)
        child[child >= len(tree.levels[level][1])] = -1
    else:  # this tree is lower: its root stays
        child = np.where(np.arange(FANOUT) == 0, own, -1)
    wide = np.repeat(child, FANOUT, axis=1) if not side else np.tile(child, (1, FANOUT))
    return wide.ravel()


def _bits(sets: list[np.ndarray]) -> int:
    return 1 << min(16, max(9, int(4 * max(len(s) for s in sets) - 1).bit_length()))


def join_block(sets: list[np.ndarray], label: np.ndarray, p: int, q: int, outer: np.ndarray | None = None) -> np.ndarray:
    """Labels after joining: linked sets get the smaller of their labels, and so do all sets of either label.

    outer: then only its sets are compared, each with all others that aren't outer and with each other.
    """
    if len(sets) < 2:
        return label
    bits, label = _bits(sets), label.copy()
    if outer is None or outer.all():
        tree = SignatureTree(sets, bits)
        pairs = [candidates(tree, tree, p, q)]
    else:
        a, b = np.flatnonzero(outer), np.flatnonzero(~outer)
        x, y = SignatureTree([sets[i] for i in a], bits), SignatureTree([sets[i] for i in b], bits)
        i, j = candidates(x, y, p, q)
        own = candidates(x, x, p, q)
        pairs = [(a[i], b[j]), (a[own[0]], a[own[1]])]
    i, j = (np.concatenate([pair[k] for pair in pairs]) for k in (0, 1))
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    if not len(i):
        return label
    cuts = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
    for start, end in zip(cuts, [*cuts[1:], len(i)], strict=True):
        one, others = i[start], j[start:end]
        others = others[label[others] != label[one]]
        if not len(others):
            continue
        flat = np.concatenate([sets[k] for k in others])
        sizes = np.array([len(sets[k]) for k in others])
        at = np.minimum(np.searchsorted(sets[one], flat), len(sets[one]) - 1)
        common_ = np.add.reduceat((sets[one][at] == flat).astype(np.int64), np.cumsum(sizes) - sizes)
        for k in others[q * common_ >= p * (sizes + len(sets[one]) - common_)]:
            if label[k] != label[one]:
                low, high = sorted((label[k], label[one]))
                label[label == high] = low
    return label


def _joined(rows: DataFrame, words: int, p: int, q: int) -> DataFrame:
    """Edges (a, b) from rows (task, node, label, outer, text), by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list) -> pa.RecordBatch:
            sets = [shingle_set(r[3], words) for r in held]
            label, outer = np.array([r[1] for r in held]), np.array([r[2] for r in held])
            after = join_block(sets, label, p, q, outer if outer.any() else None)
            pairs = np.unique(np.stack((label, after), 1)[label != after], axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])

        now, held = None, []
        for batch in batches:
            columns = [batch.column(k).cast(pa.binary()) if k == 4 else batch.column(k) for k in range(5)]
            for row in zip(*(c.to_pylist() for c in columns), strict=True):
                if row[0] != now:
                    if len(held) > 1:
                        yield done(held)
                    now, held = row[0], []
                held.append(row[1:])
        if len(held) > 1:
            yield done(held)

    dealt = rows.select("task", "node", "label", "outer", "text").repartition("task").sortWithinPartitions("task", "node")
    return dealt.mapInArrow(common.lean(run), "a long, b long")


def _large(members: DataFrame, texts: DataFrame, words: int, p: int, q: int, sets_most: int, tokens_most: int) -> DataFrame:
    """Edges of blocks that are dealt out, a part by its sets or their tokens, whichever makes more: members (node, block, n_shingles)."""
    pieces = F.greatest(F.ceil(F.count("*") / sets_most), F.ceil(F.sum("n_shingles") / tokens_most))
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(q / p)))  # linked sets: same or next
    members = members.withColumn("band", band)
    parts = members.groupBy("block", "band").agg(pieces.alias("parts"), F.min("node").alias("anchor"))
    parts = common.stored(parts, "block-parts")
    part = F.pmod(F.xxhash64("node"), F.col("parts"))
    dealt = common.stored(members.join(parts.select("block", "band", "parts"), ["block", "band"]).withColumn("part", part), "block-members")
    near = parts.select("block", F.explode(F.array(F.col("band") - 1, "band", F.col("band") + 1)).alias("band"), F.col("anchor").alias("node"))
    near = near.join(parts.select("block", "band", "parts"), ["block", "band"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = F.xxhash64("block", "band", "part").alias("task")
    first = dealt.select(task, "node").union(near.select(task, "node")).distinct()
    first = first.join(texts, "node").select("task", "node", F.col("node").alias("label"), F.lit(False).alias("outer"), "text")
    edges = common.stored(_joined(first, words, p, q), "block-edges")
    found = graph.components(edges)
    label = F.coalesce("component", "node").alias("label")
    labelled = common.stored(dealt.join(found, "node", "left").select(*dealt.columns, label), "block-labels")
    main = labelled.groupBy("block", "label").count().groupBy("block").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    outside = labelled.join(main, "block").where("label <> main").select("node", "block", "band", "label", "n_shingles")
    chunks = outside.groupBy("block", "band").agg(pieces.alias("chunks")).withColumnRenamed("band", "own_band")
    outside = outside.withColumnRenamed("band", "own_band").join(chunks, ["block", "own_band"])
    outside = outside.withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("chunks")))
    near = F.explode(F.array(F.col("own_band") - 1, "own_band", F.col("own_band") + 1)).alias("band")
    task = F.xxhash64("block", "own_band", "chunk", "band", "part").alias("task")
    sent = outside.select("*", near).join(parts.select("block", "band", "parts"), ["block", "band"])
    sent = sent.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    sent = sent.select(task, "node", "label", F.lit(True).alias("outer"))
    met = chunks.select("*", near).join(labelled, ["block", "band"]).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    met = met.select(task, "node", "label", F.lit(False).alias("outer"))
    pairs = sent.union(met).groupBy("task", "node", "label").agg(F.max("outer").alias("outer"))
    return edges.union(_joined(pairs.join(texts, "node"), words, p, q))


# --- the join --------------------------------------------------------------------------------------------------


def components(docs: DataFrame, words: int = 5, p: int = 80, q: int = 100, block_sets: int = BLOCK_SETS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, n_shingles, component_id (the smallest doc_id reachable by links).

    Sets: distinct `words`-word shingles of the A-Z lower-cased text; a shorter text is one shingle. Null, empty
    and white texts have no shingles, link with nothing and are their own component. Rows of one doc_id, whatever their
    texts, are one document: all links of each row are its. A row without doc_id has the component of documents with an equal set, else null,
    and links nothing else. No rows give no rows.
    """
    common.settings(docs.sparkSession)
    keyed = common.stored(_sets(docs, words, p, q), "shingle-sets")
    prints = ["n_shingles", "print_a", "print_b"]
    # documents are tied, not classes: equal sets share all keys, and keys needn't be shuffled to find the classes first
    tied = keyed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "segment_keys").mapInArrow(common.lean(_tie_within), "key long, a long, b long")
    edges = tied.repartition("key").sortWithinPartitions("key").mapInArrow(common.lean(_tie_sorted), "a long, b long")
    blocks = graph.components(edges).select("node", F.col("component").alias("block"))
    sets = common.stored(keyed.select("doc_id", *prints), "shingle-prints")
    common.dropped(keyed)
    classes = sets.where("n_shingles > 0").groupBy(*prints).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"))
    classes = common.stored(classes, "shingle-classes")
    members = common.stored(classes.select("node", "n_shingles").join(blocks, "node"), "block-nodes")
    sizes = members.groupBy("block").agg(F.count("*").alias("sets"), F.sum("n_shingles").alias("tokens"))
    large = sizes.where((F.col("sets") > block_sets) | (F.col("tokens") > block_tokens)).select("block")
    large = common.stored(large, "large-blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string"))
    texts = common.thinned(texts, members, "node")  # most documents are in no block
    small = members.join(large, "block", "left_anti")
    rows = small.join(texts, "node").select(F.col("block").alias("task"), "node", F.col("node").alias("label"), F.lit(False).alias("outer"), "text")
    found = common.stored(_joined(rows, words, p, q), "links")
    found = found.select(F.col("a").alias("node"), F.col("b").alias("component"))
    if large.count():
        of_large = common.stored(members.join(large, "block"), "large-nodes")
        own = common.stored(of_large.select("node").distinct().join(texts, "node"), "large-texts")
        found = found.union(graph.components(_large(of_large, own, words, p, q, block_sets, block_tokens)))
    # rows of one doc_id with different texts are one document, so their classes belong together
    of_id = sets.where("doc_id is not null").groupBy("doc_id").agg(F.countDistinct(*prints).alias("texts"))
    several = common.stored(of_id.where("texts > 1").select("doc_id"), "several-texts")
    if several.count():
        tied = sets.join(several, "doc_id").join(classes, prints).select("doc_id", "node").distinct()
        least = tied.groupBy("doc_id").agg(F.min("node").alias("least"))
        links = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = graph.components(links.union(tied.join(least, "doc_id").select(F.col("node").alias("a"), F.col("least").alias("b"))))
    found = found.groupBy("node").agg(F.min("component").alias("component"))
    named = classes.join(found, "node", "left").select(*prints, "copies", F.coalesce("component", "node").alias("component_id"))
    out = common.look_up(sets.select("doc_id", *prints), named, prints, "copies", F.coalesce("doc_id", "print_a"))
    out = out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    if several.count():  # a row of one of them without shingles has no class
        out = common.stored(out, "components")
        whole = out.join(several, "doc_id").groupBy("doc_id").agg(F.min("component_id").alias("whole"), F.count("*").alias("rows"))
        out = common.look_up(out, whole, ["doc_id"], "rows", F.monotonically_increasing_id()).select("doc_id", "n_shingles", F.coalesce("whole", "component_id").alias("component_id"))
    return out


def deduplicated(docs: DataFrame, words: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """docs with one document of each component: that of the smallest doc_id, with all its rows of different texts.

    Of rows equal in doc_id and text one stays. Documents without shingles and rows without doc_id all stay.
    """
    text = F.col("text").cast("string")
    helper = common.prefix(docs.columns, "text_")
    docs = docs.withColumn(f"{helper}hash", F.xxhash64(text)).withColumn(f"{helper}size", F.octet_length(text))
    found = components(docs.select("doc_id", "text"), words, p, q)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", f"{helper}hash", f"{helper}size"])
    return named.unionByName(docs.where("doc_id is null")).drop(f"{helper}hash", f"{helper}size")
