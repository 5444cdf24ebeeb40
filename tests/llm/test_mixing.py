import math
import re

import numpy as np
import pytest

from ebbflow.llm import mixing


def targets(sizes, weights, most=3.0):
    """Round by round: sources over their bound are set to it, what they leave is shared anew."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total > most * sizes[i]]
        for i in full or open_:
            out[i] = most * sizes[i] if full else left * weights[i] / total
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ -= set(full)
    return out


@pytest.mark.parametrize("sizes", [[100, 100, 100], [10, 1000, 0], [], [0, 0], [7, 900, 3, 44, 0, 5000], [1, 1, 1, 10_000, 1, 1, 2, 5, 1], [5]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"s{i:03}", n) for i, n in enumerate(sizes)], "source string, size long")
    got = [r.target for r in mixing.plan(rows, 8).orderBy("source_no").collect()]
    assert got == pytest.approx(targets(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))]))


def test_sources_stand_by_code_point(spark):
    names = ["b", "a", None, "", "ä", "\U0001f600", "\uffee", "B", "ab"]
    rows = spark.createDataFrame([(n, 10) for n in names], "source string, size long")
    got = [r.source for r in mixing.plan(rows).orderBy("source_no").collect()]
    assert got == [*sorted(n for n in names if n is not None), None]


def test_drawn_is_a_fair_choice():
    counts, seen = np.array([3, 0, 5, 2]), {}
    for k in range(4000):
        got = mixing.drawn(counts, 4, np.random.default_rng(k))
        assert got.sum() == 4 and (got >= 0).all() and (got <= counts).all()
        seen[tuple(got)] = seen.get(tuple(got), 0) + 1
    for got, n in seen.items():
        want = np.prod([math.comb(int(c), int(g)) for c, g in zip(counts, got)]) / math.comb(10, 4)
        assert abs(n / 4000 - want) < 0.04
    big = np.array([10**13, 5, 3 * 10**12])
    got = mixing.drawn(big, 6 * 10**12, np.random.default_rng(1))
    assert got.sum() == 6 * 10**12 and (got <= big).all() and 0 < abs(got[0] / 10**13 - 6 / 13) < 1e-5


def test_permutation():
    for n in (1, 2, 5, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, (1, 2, n))) == list(range(n))


def test_shards_add_up():
    totals = np.array([50, 3, 0, 200, 1])
    n = -(-totals.sum() // 16)
    seen = np.zeros(5, int)
    for shard in range(n):
        counts, before = mixing.shard_counts(shard, totals, 16, 9)
        assert (before == seen).all() and counts.sum() == min(16, totals.sum() - 16 * shard)
        seen += counts
    assert (seen == totals).all()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix(docs):
    rows, sources, pieces = mixing.mix(docs, block=8, shard_blocks=32)
    size = {r.source: 0 for r in docs.select("source").distinct().collect()}
    for r in docs.collect():
        size[r.source] += len(words(r.text))
    by = {r.source: r for r in sources.collect()}
    assert {s: r.source_size for s, r in by.items()} == size
    taken = {}
    for r in pieces.groupBy("source_no").sum("length").collect():
        taken[r[0]] = r[1]
    for r in by.values():
        assert abs(taken.get(r.source_no, 0) - r.target) <= max(24, 0.02 * r.target)
    most = pieces.groupBy("source_no", "start").sum("length").join(rows.where("size > 0").select("source_no", "start", "size"), ["source_no", "start"]).collect()
    assert all(r[2] <= 3 * r[3] for r in most)
    again = mixing.mix(docs, block=8, shard_blocks=32)[2]
    assert sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, pieces.collect()), key=repr)


def test_a_hot_source_is_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 4)
    docs = spark.createDataFrame([(i % 50, f"w{i} x", "s" if i % 3 else None) for i in range(150)], "doc_id long, text string, source string")
    rows = mixing.sized(docs).collect()
    for source in ("s", None):
        own = sorted((r.start, r.size) for r in rows if r.source == source)
        assert [a for a, _ in own] == [2 * k for k in range(len(own))]


def test_mixed_documents(spark, docs, empty):
    got = mixing.mixed_documents(docs, block=8)
    assert got.columns == docs.columns
    whole = {}
    for r in docs.collect():
        whole.setdefault(r.doc_id, words(r.text))
    for r in got.collect():
        own = words(r.text)
        assert own and set(own) <= set(whole[r.doc_id]) and r.n_chars == len(r.text)
    assert mixing.mixed_documents(empty).count() == 0
    # rows of one doc_id get words of their own, equal ones come out once; rows without doc_id take part
    rows = [(1, "a b c d", "s", 1), (1, "q r", "s", 1), (1, "q r", "s", 1), (None, "m n", "s", 1), (None, "o", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    got = mixing.mixed_documents(docs, block=1).collect()
    pieces = mixing.mix(docs, block=1)[2].groupBy("doc_id", "text_hash", "size").sum("length").collect()
    assert sum(len(words(r.text)) for r in got) == sum(r[3] for r in pieces) and len(got) == len(pieces)
    for r in got:
        assert any(set(words(r.text)) <= set(words(t)) for d, t, *_ in rows if d == r.doc_id)


def test_taken_text():
    assert mixing.taken_text("a b\n c  d", [(0, 0, 2), (0, 2, 2), (1, 1, 1)]) == "a b\n c  d\nb"
    assert mixing.taken_text("a b c", [(0, 2, 1), (0, 0, 1)]) == "a\nc"
