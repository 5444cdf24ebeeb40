import random
import re

import numpy as np
import pytest

from ebbflow.llm import common, graph, ngram_join
from ebbflow.llm.shingles import shingle_set


def plain_set(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + min(n, len(words))]) for i in range(len(words) - min(n, len(words)) + 1))


def brute(rows, n, p, q):
    sets, up = [(d, plain_set(t, n)) for d, t in rows if d is not None], {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and q * len(x & y) >= p * len(x | y):
                low, high = sorted((find(a), find(b)))
                up[high] = low
    return {(d, len(s), find(d)) for d, s in sets}


@pytest.mark.parametrize(("n", "p", "sets"), [(3, 90, 512), (5, 80, 512), (2, 50, 3)])
def test_equals_all_pairs(docs, n, p, sets):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_join.components(docs, n, p, 100, block_sets=sets).collect()
    assert len(got) == len(rows)
    assert {tuple(r) for r in got if r[0] is not None} == brute(rows, n, p, 100)
    assert [r[2] for r in got if r[0] is None] == [None]


def test_deduplicated_keeps_one_of_each_group(docs):
    found = brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80, 100)
    got = ngram_join.deduplicated(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.where("doc_id is not null").collect()) == sorted({c for _, _, c in found})
    assert got.where("doc_id is null").count() == 1


def test_empty(empty):
    assert ngram_join.components(empty).count() == 0


def test_word_borders_and_case():
    assert np.array_equal(shingle_set(b"A  b\tC d", 3), shingle_set(b"a b c\nD", 3))
    assert len(shingle_set("é É".encode(), 1)) == 2
    assert len(shingle_set(b"x" * 3_000_000 + b" y", 1)) == 2
    assert len(shingle_set(None, 3)) == 0


def test_keys_meet_for_all_linked_sets():
    rng = np.random.default_rng(1)
    keys = ngram_join.Keys(80, 100, rng.integers(0, 4, ngram_join.COUNTERS).astype(np.uint8))
    for n in [9, 10, 11, 14, 20, 45, 100, 333, 2000]:
        for _ in range(20):
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            k = int(n * rng.uniform(0, 0.11))
            y = np.unique(np.append(rng.permutation(x)[k:], rng.integers(0, 1 << 63, k).astype(np.uint64)))
            inter = len(np.intersect1d(x, y))
            if 100 * inter >= 80 * (len(x) + len(y) - inter) and k:
                assert np.intersect1d(keys.of(x), keys.of(y)).size


def test_tree_prunes_no_link():
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 1 << 63, s).astype(np.uint64)) for s in rng.integers(5, 200, 60)]
    sets = base + [np.unique(np.append(s[2:], rng.integers(0, 1 << 63, 2).astype(np.uint64))) for s in base]
    tree = ngram_join.SignatureTree(sets, 1024)
    got = {tuple(sorted(x)) for x in zip(*ngram_join.candidates(tree, tree, 80, 100))}
    for i in range(len(sets)):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                assert (j, i) in got
    assert len(got) < 200


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(30)] + [(100, 90), (None, 3), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 90, 90: 90}


def test_long_near_copies_are_dealt_by_tokens(spark, monkeypatch):
    words, rows = [f"w{i}" for i in range(300)], []
    for k in range(40):
        rows.append((k, " ".join([*words[: 7 * k], f"own{k}", *words[7 * k + 1 :]])))
    docs, tasks, joined = spark.createDataFrame(rows, "doc_id long, text string"), [], ngram_join._joined

    def spied(dealt, *more):
        tasks.extend(r["count"] for r in dealt.groupBy("task").count().collect())
        return joined(dealt, *more)

    monkeypatch.setattr(ngram_join, "_joined", spied)
    got = ngram_join.components(docs, 5, 80, 100, block_sets=512, block_tokens=2000).collect()
    assert {r.component_id for r in got} == {0} and len(got) == 40
    assert max(tasks) < 20


def test_rows_of_one_document_tie_their_texts(spark):
    """As the same doc_id stands with two texts, or with one and none, its links are those of all its rows."""
    a, b, c = "a b c d e f g h", "q r s t u v w x y", "one two three four five six"
    rows = [(3, a), (5, a), (5, b), (7, b), (9, c), (12, c), (12, None), (12, ""), (20, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in ngram_join.components(docs, 3, 90, 100).collect()}
    assert got == brute(rows, 3, 90, 100) | {(12, 0, 9)}
    assert {(r[0], r[2]) for r in got} == {(3, 3), (5, 3), (7, 3), (9, 9), (12, 9), (20, 20)}
    kept = ngram_join.deduplicated(docs).collect()
    assert sorted(r.doc_id for r in kept) == [3, 9, 20]
    both = spark.createDataFrame([(5, a), (5, b), (5, b), (7, b)], "doc_id long, text string")
    assert sorted(r.text for r in ngram_join.deduplicated(both, 3, 90, 100).collect()) == [a, b]


def test_thinned_loses_no_row_that_joins(spark, monkeypatch):
    monkeypatch.setattr(common, "KEY_BITS", 1 << 17)
    rows = spark.range(-20_000, 20_000).withColumnRenamed("id", "node").union(spark.sql("SELECT CAST(NULL AS LONG)"))
    keyed = rows.where("node % 50 = 7 or node is null")
    got = {r.node for r in common.thinned(rows, keyed, "node").collect()}
    assert {r.node for r in keyed.where("node is not null").collect()} <= got and len(got) < 1500 and None not in got


def test_texts_of_no_block_are_not_shuffled(spark):
    """With tables too large to broadcast, what is shuffled stays far below the texts, as few of them are in a block."""
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=250)) for _ in range(80))) for i in range(400)]
    rows.append((1000, rows[5][1] + " more"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    store = spark.sparkContext._jsc.sc().statusStore()
    quantiles = spark.sparkContext._gateway.new_array(spark._jvm.double, 0)

    def written():
        stages = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(store.stageList(None, False, False, quantiles, None))
        return {s.stageId(): s.shuffleWriteBytes() for s in stages}

    docs = common.stored(docs, "shuffle-test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = written()
        got = {r.doc_id: r.component_id for r in ngram_join.components(docs, 3, 90, 100).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == {i: i for i in range(400)} | {1000: 5}
    assert sum(n for k, n in written().items() if k not in before) < sum(len(t) for _, t in rows) / 2
