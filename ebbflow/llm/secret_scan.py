"""Secrets: patterns of known kinds, and candidates whose format is that of known credentials.

What the patterns find are labelled credentials. For each kind a prefix tree of a sample of them is made into a probabilistic
automaton by merging states that are statistically compatible. All other long runs of credential characters are scored by the
log ratio of the automaton's likelihood to that of a character model of all such runs.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import common

#: Kinds in their order, their patterns over UTF-8 bytes (letters of assign in either case), the group that is the
#: secret and its least length. Patterns of a whole run ask for that length themselves: shorter runs fail.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: Characters of credentials; a candidate is a whole run of at least so many of them.
CHARS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
RUN = re.compile(rb"[A-Za-z0-9+/_.=-]{12,}")
#: Kinds of found candidates, after the base kinds in order.
LIKELY = tuple(f"likely_{k}" for k in KINDS)
#: Automata are fitted on a sample of so many different credentials of a kind, of up to so many characters, drawn by hash. All
#: candidates are scored, whatever their length. As many others of the sample, a quarter, are held out for thresholds.
FIT_CREDENTIALS, FIT_CHARS = 4000, 128
#: Fewer credentials of a kind than this are no sample: then no candidate is likely to be of that kind.
LEAST_CREDENTIALS = 8
#: Bound of error of each comparison of two states; what is added to each count, so little that a character that never followed all but rejects; share of held-out credentials that may fall below the threshold.
ALPHA, SMOOTH, MISSED = 0.05, 1e-6, 0.02
#: Least log odds in all: an ordinary run reaches them once in e^12 at most.
LOG_ODDS = 12.0
_N = len(CHARS)
_INDEX = np.full(256, _N, np.int64)
_INDEX[np.frombuffer(CHARS, np.uint8)] = np.arange(_N)
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def base_spans(text: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) in bytes of the patterns' matches: leftmost, not overlapping within a kind, those that are too short left out."""
    out = [(m.start(2), m.end(2), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def candidates(text: bytes, spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """(start, end) in bytes of runs of credential characters that overlap no span."""
    out, i = [], 0
    spans = sorted(spans)
    reach = 0
    for m in RUN.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reach = max(reach, spans[i][1])
            i += 1
        if reach <= m.start():
            out.append(m.span())
    return out


def _in_points(text: bytes, places: list[int]) -> list[int]:
    """Byte places as places of code points."""
    if not places or text.isascii():
        return places
    before = np.append(0, np.cumsum(_CONTINUES[np.frombuffer(text, np.uint8)], dtype=np.int64))
    return (np.array(places) - before[places]).tolist()


def scanned(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(own: a struct of the columns kept, base, others: spans with values) of each row; stored. Null texts are empty."""
    names = docs.columns if keep is None else keep
    own = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(0).alias("none"))
    rows = docs.select(own.alias("own"), F.col(f"`{text}`").alias("text"))
    types = "base array<struct<start:long,end:long,kind:string,value:string>>, others array<struct<start:long,end:long,value:string>>"
    schema = StructType(rows.select("own").schema.fields + StructType.fromDDL(types).fields)

    def lists(found: list[list[tuple]], names: list[str], types: list[pa.DataType]) -> pa.Array:
        flat = [x for each in found for x in each]
        columns = [pa.array([x[i] for x in flat], t) for i, t in enumerate(types)]
        return pa.ListArray.from_arrays(np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32), pa.StructArray.from_arrays(columns, names))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, others = [], []
            for t in batch.column(1).cast(pa.binary()):
                data = t.as_py() or b""
                spans = base_spans(data)
                more = candidates(data, spans)
                at = _in_points(data, [p for s in (*spans, *more) for p in s[:2]])
                pairs = list(zip(at[::2], at[1::2]))
                base.append([(a, b, s[2], data[s[0] : s[1]].decode()) for (a, b), s in zip(pairs, spans)])
                others.append([(a, b, data[s:e].decode()) for (a, b), (s, e) in zip(pairs[len(spans) :], more)])
            long, string = pa.int64(), pa.string()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(base, ["start", "end", "kind", "value"], [long, long, string, string]), lists(others, ["start", "end", "value"], [long, long, string])], ["own", "base", "others"]
            )

    return common.stored(rows.mapInArrow(common.lean(task), schema), "secret-spans")


class PrefixTree:
    """States of a prefix tree with their numbers of strings, ends and next states; merging makes it an automaton."""

    def __init__(self, strings: list[str]):
        self.n, self.ends, self.next = [0], [0], [{}]
        for s in strings:
            at = 0
            self.n[0] += 1
            for c in s:
                to = self.next[at].get(c)
                if to is None:
                    to = self.next[at][c] = len(self.n)
                    self.n.append(0)
                    self.ends.append(0)
                    self.next.append({})
                at = to
                self.n[at] += 1
            self.ends[at] += 1

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        """Hoeffding's bound on two shares a/n and b/m."""
        return abs(a / n - b / m) > math.sqrt(math.log(2 / ALPHA) / 2) * (n**-0.5 + m**-0.5)

    def compatible(self, p: int, q: int) -> bool:
        """No share of ends or of a next character differs, from these states on."""
        todo, least = [(p, q)], math.log(2 / ALPHA) / 2
        while todo:
            p, q = todo.pop()
            n, m = self.n[p], self.n[q]
            if math.sqrt(least) * (n**-0.5 + m**-0.5) >= 1:
                continue  # too few strings to tell, and fewer further on
            if self._differ(self.ends[p], n, self.ends[q], m):
                return False
            for c in self.next[p].keys() | self.next[q].keys():
                i, j = self.next[p].get(c), self.next[q].get(c)
                if self._differ(self.n[i] if i is not None else 0, n, self.n[j] if j is not None else 0, m):
                    return False
                if i is not None and j is not None:
                    todo.append((i, j))
        return True

    def merge(self, parent: int, char: str, p: int, q: int) -> None:
        """q, reached from parent by char and the root of a tree, is folded into p."""
        self.next[parent][char] = p
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.n[p] += self.n[q]
            self.ends[p] += self.ends[q]
            for c, j in self.next[q].items():
                i = self.next[p].get(c)
                if i is None:
                    self.next[p][c] = j
                else:
                    todo.append((i, j))

    def inferred(self) -> list[int]:
        """Merge until no two states are left to compare; returns the states that remain, the start first.

        States next to those kept are taken by number of strings; each is merged into the first kept one that is compatible, or kept.
        """
        kept = [0]
        while True:
            inside = set(kept)
            near = [(-self.n[q], p, c, q) for p in kept for c, q in self.next[p].items() if q not in inside]
            if not near:
                return kept
            _, parent, char, q = min(near)
            for p in kept:
                if self.compatible(p, q):
                    self.merge(parent, char, p, q)
                    break
            else:
                kept.append(q)


def automaton(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(next state, log likelihood) by state and character (the last column: end) from distinct strings of credential characters.

    SMOOTH is added to each count. A character that never followed leads back to the start.
    """
    tree = PrefixTree(sorted(strings))
    kept = tree.inferred()
    number = {p: i for i, p in enumerate(kept)}
    to, count = np.zeros((len(kept), _N + 1), np.int64), np.zeros((len(kept), _N + 1))
    for p, i in number.items():
        count[i, _N] = tree.ends[p]
        for c, q in tree.next[p].items():
            k = _INDEX[ord(c)]
            to[i, k], count[i, k] = number[q], tree.n[q]
    # the counts of strings that came into a state by a merge have followed other ways: shares are of what leaves the state
    total = count.sum(1, keepdims=True) + SMOOTH * (_N + 1)
    return to, np.log((count + SMOOTH) / total)


def log_likelihoods(values: list[bytes], to: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Of each value with its end, a character of all values at a time."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    order = np.argsort(-sizes, kind="stable")
    data = _INDEX[np.frombuffer(b"".join(values), np.uint8)]
    starts, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
    state, total = np.zeros(len(values), np.int64), np.zeros(len(values))
    active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0))
    for k, m in enumerate(active):
        c = data[starts[:m] + k]
        total[:m] += logs[state[:m], c]
        state[:m] = to[state[:m], c]
    total += logs[state, _N]
    out = np.empty(len(values))
    out[order] = total
    return out


def _pair_counts(rows: DataFrame) -> np.ndarray:
    """How often a credential character follows two others, or a start, in all different candidates; _N stands for starts and ends."""
    size = _N + 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size**3, np.int64)
        for batch in batches:
            values = batch.column(0).cast(pa.binary()).to_pylist()
            data = _INDEX[np.frombuffer(b"  " + b"".join(v + b"  " for v in values), np.uint8)]
            counts += np.bincount((data[:-2] * size + data[1:-1]) * size + data[2:], minlength=size**3)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], ["key", "n"])

    out = np.zeros(size**3, np.int64)
    values = rows.select(F.explode("others.value").alias("value")).distinct()
    for r in values.mapInArrow(common.lean(task), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect():  # 69^3 rows at most
        out[r["key"]] = r["n"]
    return out.reshape(size, size, size)


def _discounted(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Shares along the last axis, one taken off each count and given to those by the shorter context; without counts these alone."""
    total = counts.sum(-1, keepdims=True)
    given = (counts > 0).sum(-1, keepdims=True)
    return np.where(total > 0, (np.maximum(counts - 1, 0) + given * shorter) / np.maximum(total, 1), shorter)


def ordinary(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The character model of all candidates, in an automaton's form: a state is the two characters before.

    What was seen once is left to the shorter context, so that random runs among the candidates, each different, do not explain themselves.
    """
    size = _N + 1
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + size)
    two = _discounted(counts.sum(0), one)
    three = _discounted(counts, two)
    # state 0 must be the start, before which there are two places outside
    at = (np.arange(size)[:, None] + 1) % size * size + (np.arange(size)[None, :] + 1) % size
    logs, to = np.empty((size * size, size)), np.empty((size * size, size), np.int64)
    logs[at.ravel()] = np.log(three).reshape(size * size, size)
    to[at.ravel()] = np.tile(((np.arange(size)[:, None] + 1) % size * size + (np.arange(size)[None, :] + 1) % size), (size, 1))
    return to, logs


def models(rows: DataFrame) -> tuple[tuple[np.ndarray, np.ndarray], dict[str, tuple[np.ndarray, np.ndarray, float]]]:
    """(the ordinary model, by kind: automaton and its least log likelihood a character) from scanned() rows.

    The sample: different values of a kind by hash. Three quarters are fitted; of the rest all but MISSED reach that.
    """
    plain = ordinary(_pair_counts(rows))
    spans = rows.select(F.explode("base").alias("s")).select("s.kind", "s.value").where(F.length("value") <= FIT_CHARS)
    found = {}
    for kind in KINDS:
        values = spans.where(F.col("kind") == kind).select("value").distinct()
        drawn = [r["value"] for r in values.orderBy(F.xxhash64("value"), "value").limit(FIT_CREDENTIALS).collect()]  # bounded
        fit, held = [v for i, v in enumerate(drawn) if i % 4], [v.encode() for v in drawn[::4]]
        if len(drawn) < LEAST_CREDENTIALS:
            continue
        to, logs = automaton(fit)
        found[kind] = (to, logs, float(np.quantile(log_likelihoods(held, to, logs) / [len(v) + 1 for v in held], MISSED)))
    return plain, found


def likely(values: list[bytes], plain: tuple, found: dict) -> list[str | None]:
    """The kind of each value whose format is likeliest, if it reaches that kind's threshold and LOG_ODDS; else null."""
    best, kind = np.full(len(values), -np.inf), np.full(len(values), -1)
    if not values or not found:
        return [None] * len(values)
    size = np.fromiter(map(len, values), np.int64, len(values)) + 1
    base = log_likelihoods(values, *plain)
    for k, (to, logs, least) in found.items():
        own = log_likelihoods(values, to, logs)
        odds = own - base
        passes = (own / size >= least) & (odds >= LOG_ODDS) & (odds > best)
        best[passes], kind[passes] = odds[passes], KINDS.index(k)
    return [LIKELY[k] if k >= 0 else None for k in kind]


def found_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """docs' columns `keep` (all) with base and added: array of (start, end, kind, value); columns of these names are replaced.

    base: matches of the patterns, by start, then kind; added: likely candidates by start. Places count code points, ends are exclusive.
    Null and empty texts have none; repeated rows stay; an empty table gives an empty one. Without enough labelled
    credentials of a kind no candidate is likely.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("base", "added")]
    rows = scanned(docs, text, names)
    plain, kinds = models(rows)
    schema = StructType(rows.select("own", "base").schema.fields + StructType.fromDDL("added array<struct<start:long,end:long,kind:string,value:string>>").fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.column(2)
            flat = others.flatten()
            coded = flat.field("value").dictionary_encode()
            kind = pa.array(likely(coded.dictionary.cast(pa.binary()).to_pylist(), plain, kinds), pa.string()).take(coded.indices)
            chosen = np.flatnonzero(kind.is_valid().to_numpy(zero_copy_only=False))
            offsets = np.searchsorted(chosen, others.offsets.to_numpy() - others.offsets[0].as_py()).astype(np.int32)
            values = pa.StructArray.from_arrays([flat.field("start"), flat.field("end"), kind, flat.field("value")], ["start", "end", "kind", "value"]).take(pa.array(chosen))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, values)], ["own", "base", "added"])

    made = rows.mapInArrow(common.lean(task), schema)
    return made.select(*[F.col("own").getField(c).alias(c) for c in names], "base", "added")


def joined(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
