"""Token ids of texts in tasks."""

from __future__ import annotations

import gc
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A worker keeps the ids of so many words at most, about 200 bytes each, and those of the last batch.
CACHED_WORDS = 150_000
#: Words that go to the tokenizer at once, as what it returns takes a hundred times their memory; texts whose ids are put in their places at once.
AT_ONCE, STEP = 4096, 64
#: Words of Latin-1 letters, whose lower case and composed form are no question, and ASCII punctuation after them.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*%&$#()\[\]\"/-]*)")


class WordEncoder:
    """Ids of texts, word by word.

    For tokenizers whose pre-tokenizer drops white space no token spans two words, so a text's ids are its words' ids one
    after another. A batch's different words are found by Arrow and encoded once; those that stand in two batches running are
    kept. Where the tokenizer lower-cases and parts letters from punctuation, which is tried out at the start, words of plain letters
    go to its model without the normaliser, whose cost is most of encoding a word. Where it does not drop white space,
    whole texts are encoded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.by_word = all(
            self._ids([a + gap + b])[0] == self._ids([a])[0] + self._ids([b])[0]
            for a, b in (("an", "other"), ("é", "́x"), ("1", "2."), ("'", "s"))
            for gap in (" ", "\n", " \t ")
        )
        self.simple = Tokenizer.from_file(path)
        self.simple.normalizer = normalizers.Sequence([])
        self.simple.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        tried = ("another", "Été", "ÑANDÚ", "aßÿ", "weiß", "QUEUE")
        self.parts = self.by_word and all(
            self._ids([w + p])[0] == np.frombuffer(self._letters([w.lower()])[0], self.dtype).tolist() + (self._ids([p])[0] if p else [])
            for w in tried
            for p in ("", ".", "?!", "***", "-", '",')
        )
        self.words: dict[bytes, bytes] = {}
        self.last: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of lower-cased words of letters."""
        found = self.simple.encode(" ".join(words), add_special_tokens=False)
        ids, of = np.array(found.ids, self.dtype), np.array(found.word_ids, np.int64)
        data, ends = ids.tobytes(), (np.searchsorted(of, np.arange(len(words) + 1)) * self.dtype.itemsize).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _made(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words that aren't kept yet."""
        out: dict[bytes, bytes] = {}
        whole, parted, stems = [], [], {}
        for word in words:
            m = _SIMPLE.fullmatch(word.decode()) if self.parts else None
            if m:
                stem, mark = m[1].lower(), m[2]
                parted.append((word, stem, mark))
                stems[stem] = b""
                if mark not in self.marks:
                    self.marks[mark] = np.array(self._ids([mark])[0], self.dtype).tobytes()
            else:
                whole.append(word)
        new = list(stems)
        for some in (new[a : a + AT_ONCE] for a in range(0, len(new), AT_ONCE)):
            stems.update(zip(some, self._letters(some), strict=True))
        for word, stem, mark in parted:
            out[word] = stems[stem] + self.marks[mark]
        if len(self.marks) > CACHED_WORDS:
            self.marks = {"": b""}
        for some in (whole[a : a + AT_ONCE] for a in range(0, len(whole), AT_ONCE)):
            for word, ids in zip(some, self._ids([w.decode() for w in some]), strict=True):
                out[word] = np.array(ids, self.dtype).tobytes()
        return out

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends) of UTF-8 texts: text i has ids[ends[i] : ends[i + 1]], little-endian unsigned; a null text has none."""
        if not self.by_word:
            made = [np.array(x, self.dtype) for x in self._ids([t or "" for t in texts.cast(pa.string()).to_pylist()])]
            return np.concatenate([np.empty(0, self.dtype), *made]), np.cumsum([0, *map(len, made)])
        lists = pc.ascii_split_whitespace(texts.cast(pa.string()))
        coded = lists.flatten().dictionary_encode()
        distinct, known, last = coded.dictionary.cast(pa.binary()).to_pylist(), self.words, self.last
        gc.disable()  # none of what follows is cyclic, and the collector would walk all kept words time and again
        again = {w: last[w] for w in distinct if w in last}
        made = self._made([w for w in distinct if w not in known and w not in again])
        gc.enable()
        if len(known) + len(again) <= CACHED_WORDS:
            known.update(again)
        else:
            made |= again
        values = [known[w] if w in known else made[w] for w in distinct]
        self.last = made
        table = np.frombuffer(b"".join(values), self.dtype)
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        borders = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(), dtype=np.int64))
        parts, ends = [], np.zeros(len(borders), np.int64)
        for a in range(0, len(texts), STEP):  # the places of ids take several times the memory of the ids
            own = borders[a : a + STEP + 1]
            words = at[own[0] : own[-1]]
            n = sizes[words]
            last = np.append(0, np.cumsum(n))
            parts.append(table[np.repeat(starts[words] - last[:-1], n) + np.arange(last[-1])])
            ends[a + 1 : a + STEP + 1] = ends[a] + last[own[1:] - own[0]]
        return np.concatenate([np.empty(0, self.dtype), *parts]), ends

    def forget(self) -> None:
        """Let go of all words, as the worker may go on to other work."""
        self.words, self.last, self.marks = {}, {}, {"": b""}

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text (UTF-8; null: empty)."""
        ids, ends = self.batch(pa.array(texts, pa.binary()))
        return [ids[a:b] for a, b in zip(ends, ends[1:])]


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose texts in that column take about `most` bytes; a larger text is a part of its own."""
    place = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(place, place[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def ended(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends) with end_id after each text's ids."""
    new = ends + np.arange(len(ends))
    out = np.full(len(ids) + len(ends) - 1, end_id, ids.dtype)
    keep = np.ones(len(out), bool)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new


@lru_cache(4)
def encoder(path: str) -> WordEncoder:
    """One for each file and Python worker."""
    return WordEncoder(path)
