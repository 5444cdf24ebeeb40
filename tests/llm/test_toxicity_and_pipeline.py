import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ebbflow.llm import toxicity


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(900):
        text = rng.choices(words, k=rng.randint(5, 80))
        toxic = i % 5 == 0
        if toxic:
            text.insert(rng.randrange(len(text)), rng.choice(["vile", "Vile!", "nasty"]))
        rows.append((i, " ".join(text), "x"))
        if i % 3:
            marks.append((i, int(toxic), "y"))
    rows += [(900, None, "n"), (901, "", None), (None, "vile", "n"), (5, "vile", "again"), (902, "w1 " * 50_000, "long")]
    marks += [(1, None, "z"), (None, 1, "z"), (2, 1, "clash")]
    return spark.createDataFrame(rows, "doc_id long, text string, score_of string"), spark.createDataFrame(marks, "doc_id long, toxic int, text string")


def test_scores(corpus):
    docs, labels = corpus
    got = toxicity.score(docs, labels).collect()
    assert len(got) == 905
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.score >= 0.7) == ("vile" in (r.text or "").lower() or "nasty" in (r.text or ""))


def test_held_out(corpus):
    for r in corpus[0].withColumn("h", toxicity.held_out()).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_held_out_labels_are_not_read(spark, corpus):
    docs, labels = corpus
    flipped = labels.withColumn("h", toxicity.held_out()).selectExpr("doc_id", "case when h then 1 - toxic else toxic end as toxic")
    a, b = ({r.doc_id: r.score for r in toxicity.score(docs.where("doc_id <> 5"), x).collect()} for x in (labels, flipped))
    assert a == b


def test_joined_tables_agree(corpus, monkeypatch):
    docs, labels = corpus
    want = sorted(((r.doc_id, r.mean_ratio, r.top_ratio, r.score) for r in toxicity.score(docs, labels).collect()), key=repr)
    for most in (20, 0):
        monkeypatch.setattr(toxicity, "BROADCAST_ROWS", most)
        assert sorted(((r.doc_id, r.mean_ratio, r.top_ratio, r.score) for r in toxicity.score(docs, labels).collect()), key=repr) == want


def _words(text):
    return re.findall(r"[a-z0-9]+", text.lower()) if text else []


class Plain:
    """The models as formulas over dictionaries, a class at a time."""

    def __init__(self, rows):
        self.n, self.before = ({0: Counter(), 1: Counter()} for _ in range(2))
        for text, toxic in rows:
            words = _words(text)
            self.n[toxic].update(set(zip(["", *words], words)))
        self.any = Counter(w for _, w in set(self.n[0]) | set(self.n[1]))
        for c in (0, 1):
            self.before[c].update(w for _, w in self.n[c])

    @staticmethod
    def cut(n):
        return 1.0 if n == 1 else min(n, 0.75)

    def word(self, c, w):
        counts = self.before[c]
        total = sum(counts.values())
        left = sum(min(n, 4) for n in counts.values())
        shared = self.any[w] / sum(self.any.values()) if w in self.any else 1e-12
        return max(counts[w] - 4, 0) / total + left / total * shared

    def pair(self, c, h, w):
        own = {x: n for (g, x), n in self.n[c].items() if g == h}
        if not own:
            return self.word(c, w)
        total, n = sum(own.values()), own.get(w, 0)
        return (n - self.cut(n)) / total + sum(map(self.cut, own.values())) / total * self.word(c, w)

    def mean_ratio(self, text):
        words = _words(text)
        pairs = set(zip(["", *words], words))
        toxic, ordinary = (sum(math.log(self.pair(c, h, w)) for h, w in pairs) for c in (1, 0))
        return (toxic - ordinary) / len(pairs) if pairs else 0.0

    def top_ratio(self, text):
        words = _words(text)
        return max(0.0, *[math.log(self.word(1, w) / self.word(0, w)) for w in [*words, "without a row"]]) if words else 0.0


@pytest.mark.parametrize("rows_most", [4_000_000, 20, 0])
def test_likelihoods_by_brute_force(spark, monkeypatch, rows_most):
    """All pairs and words of both classes, rare ones too, whether sent to all tasks or joined, dealt out or not."""
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(25)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) + rng.choice(["", " vile", ", Vile v3!"]) * (i % 4 == 0), int(i % 4 == 0)) for i in range(60)]
    rows += [(None, 1), ("", 0), ("v1 " * 40, 0), rows[0], rows[0]]
    plain = Plain(rows)
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", rows_most)
    monkeypatch.setattr(toxicity, "MAP_BITS", 64)
    monkeypatch.setattr(toxicity, "BUCKET_BYTES", 300)
    monkeypatch.setattr(toxicity, "CHUNK_PAIRS", 50)
    table = toxicity.Table(*toxicity.ratios(toxicity.counted(spark.createDataFrame(rows, "text string, toxic int"))))
    asked = [t for t, _ in rows] + ["vile new words", "vile", "v1", "unknown", "v3 vile v3 vile"]
    got = toxicity.likelihoods(spark.createDataFrame([(t, k) for k, t in enumerate(asked)], "text string, k int"), table).collect()
    assert len(got) == len(asked)
    for r in got:
        assert r.mean_ratio == pytest.approx(plain.mean_ratio(asked[r.k]), abs=2e-6)
        assert r.top_ratio == pytest.approx(plain.top_ratio(asked[r.k]), abs=2e-6)


def test_scores_by_brute_force(corpus):
    """The curve of both ratios, fitted on the rows that aren't counted."""
    docs, labels = corpus
    known, fitted = toxicity.labelled(docs, labels)
    plain = Plain([(r.text, r.toxic) for r in known.collect()])

    def features(text):
        mean = plain.mean_ratio(text)
        return [math.copysign(math.sqrt(abs(mean)), mean), plain.top_ratio(text)]

    rows = fitted.collect()
    w = toxicity.rising(np.array([features(r.text) for r in rows]), np.array([r.toxic for r in rows], float))
    assert w[1:].min() >= 0
    for r in toxicity.score(docs, labels).collect():
        assert r.score == pytest.approx(1 / (1 + math.exp(-(w[0] + w[1:] @ features(r.text)))), abs=1e-3)


def test_the_curve_never_falls():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 2))
    y = (x[:, 0] - x[:, 1] > 0).astype(float)
    w = toxicity.rising(x, y)
    assert w[1] > 0 and w[2] == 0
    assert (toxicity.rising(-x[:, :1], y)[1:] == 0).all()


def test_without_labels(corpus):
    docs, labels = corpus
    assert {round(r.score, 6) for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_pipeline(spark, docs, empty, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    from ebbflow.llm import common

    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(0, 80, 3)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "mixing", "packing"]
    for table in (docs, empty):
        now = table
        for name, stage in pipeline.STAGES:
            out = common.stored(stage(spark, now, str(tmp_path)), "stage-test")
            if name != "packing":
                assert out.columns == docs.columns
                assert {r[0] for r in out.select("doc_id").collect()} <= {r[0] for r in now.select("doc_id").collect()}
            now = out
        assert (now.count() > 0) == (table is docs)
    got = pipeline.run(spark, str(tmp_path))
    assert sorted(got.columns) == sorted(["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]) and got.count() > 0
