import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbflow.llm import common, packing, queries, token_files, tokens

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def plain():
    return tokenizers.Tokenizer.from_file(queries.TOKENIZER)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_word_by_word_is_the_tokenizer(text):
    plain = tokenizers.Tokenizer.from_file(queries.TOKENIZER) if not hasattr(test_word_by_word_is_the_tokenizer, "t") else test_word_by_word_is_the_tokenizer.t
    test_word_by_word_is_the_tokenizer.t = plain
    assert tokens.encoder(queries.TOKENIZER).encode([text.encode()])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_full_cache_still_encodes(monkeypatch, plain):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 2)
    own = tokens.WordEncoder(queries.TOKENIZER)
    for text in ("a b c d e f", "some other words", "a b"):
        assert own.encode([text.encode()])[0].tolist() == plain.encode(text, add_special_tokens=False).ids


def test_many_words_reach_the_tokenizer_in_parts(monkeypatch, plain):
    """What the tokenizer returns for all words of a batch at once took most of a worker's memory."""
    own, seen = tokens.WordEncoder(queries.TOKENIZER), []
    ids, letters = own._ids, own._letters
    monkeypatch.setattr(own, "_ids", lambda some: seen.append(len(some)) or ids(some))
    monkeypatch.setattr(own, "_letters", lambda some: seen.append(len(some)) or letters(some))
    texts = [" ".join(f"w{i}x word{chr(97 + i % 26) * (i % 7)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}q" for i in range(k, k + 100)) for k in range(0, 15_000, 100)]
    got = own.encode([t.encode() for t in texts])
    assert max(seen) <= 4096 < sum(seen)
    assert [x.tolist() for x in got] == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


def test_slices_are_bounded_by_bytes_and_lose_no_row():
    rows = [None, "", "a" * 5000, "b", *["c" * 700] * 20, None, "é" * 900, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), pa.array(rows)], ["doc_id", "text"])
    parts = list(tokens.slices(batch.slice(1), 1, 2000))
    assert [r for part in parts for r in part.column(1).to_pylist()] == rows[1:]
    assert all(part.num_rows and (part.num_rows == 1 or sum(len((r or "").encode()) for r in part.column(1).to_pylist()) <= 2000) for part in parts)
    assert len(parts) > 8 and list(tokens.slices(batch.slice(0, 0), 1)) == []


def test_token_files(spark, docs, plain):
    folder = common.new_path(spark, "token-test")
    manifest = token_files.write(docs, queries.TOKENIZER, folder, 2, length=16, batch_rows=4)
    got = sorted((tuple(r) for r in token_files.read(manifest).collect()), key=lambda r: r[1])
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, start = [], 0
    for doc, text in rows:
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == want
    shard = token_files.Shard(manifest.orderBy("shard").first()["path"])
    flat = [shard.sequence(i) for i in range(sum(shard.file.get_batch(b).num_rows for b in range(shard.file.num_record_batches)))]
    assert all(len(ids) == 16 for ids, _ in flat)
    total = sum(n for _, _, n in shard.documents())
    assert sum(mask.sum() for _, mask in flat) == total
    assert np.array_equal(np.concatenate([ids for ids, _ in flat])[:total], shard.ids(0, total))


def test_token_files_of_nothing(spark, empty):
    manifest = token_files.write(empty, queries.TOKENIZER, common.new_path(spark, "token-empty"))
    assert token_files.read(manifest).count() == 0


def test_packing(spark, docs, plain):
    got = packing.best_fit(docs, queries.TOKENIZER, 1, 64).collect()
    held = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.start == 64 * r.piece and 0 < r.length <= 64
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    want = []
    for d in docs.collect():
        ids = np.array(plain.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
        want += [(d.doc_id, k, zlib.crc32(ids[s : s + 64].tobytes())) for k, s in enumerate(range(0, len(ids), 64))]
    assert sorted(((r.doc_id, r.piece, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert len(held) <= 1.05 * sum(r.length for r in got) / 64 + 2


def test_sum_of_squares_takes_the_least():
    rng = np.random.default_rng(0)
    lengths, cap = rng.integers(1, 21, 120), 20
    bins, offsets = packing.sum_of_squares(lengths, cap)
    open_, at = {}, {}
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])

        def cost(gaps):
            count = np.bincount(gaps, minlength=cap + 1)
            return int((count[1:] ** 2).sum())

        now = list(open_.values())
        fresh = cost([*now, cap - s])
        options = [(cost([g for k, g in open_.items() if k != b] + [open_[b] - s]), open_[b]) for b in open_ if open_[b] >= s]
        best = min([c for c, _ in options] + [fresh])
        gap = open_.get(bins[i], cap)
        made = cost([g for k, g in open_.items() if k != bins[i]] + [gap - s])
        assert made == best and offsets[i] == at.get(bins[i], 0)
        open_[bins[i]] = gap - s
        at[bins[i]] = at.get(bins[i], 0) + s


def test_packing_nothing(empty):
    assert packing.best_fit(empty, queries.TOKENIZER).count() == 0
