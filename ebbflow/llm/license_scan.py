"""Licences of files: TF-IDF cosine of passages to templates, then inheritance from the nearest ancestor directory."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .shingles import word_hashes

THRESHOLD = 0.75


def terms(text: str | bytes) -> np.ndarray:
    """Hashes of the terms, in order: runs of ASCII letters and digits and of all other characters beyond ASCII."""
    return word_hashes(text.encode() if isinstance(text, str) else text, plain=True).view(np.int64)


class Weights:
    """Sparse TF-IDF vectors of templates; n documents, seen: how many of them hold each term (others: none)."""

    def __init__(self, templates: list[tuple[str, str]], n: int, seen: dict[str, int] | tuple[np.ndarray, np.ndarray]):
        if isinstance(seen, dict):
            seen = np.array([terms(t)[0] for t in seen], np.int64), np.array(list(seen.values()), np.int64)
        order = np.argsort(seen[0])
        self.n, self.keys, self.docs = n, seen[0][order], seen[1][order]
        own = [(name, terms(text)) for name, text in sorted(templates)]
        own = [(name, words) for name, words in own if len(words)]
        self.names, self.lengths = [name for name, _ in own], np.array([len(words) for _, words in own], np.int64)
        self.vectors = [self.unit(words) for _, words in own]
        sizes = [len(keys) for keys, _ in self.vectors]
        keys, x = (np.concatenate([np.empty(0, kind), *[v[k] for v in self.vectors]]) for k, kind in ((0, np.int64), (1, float)))
        order = np.argsort(keys, kind="stable")
        self.vocabulary, first = np.unique(keys[order], return_index=True)
        self.ends = np.append(first, len(keys))
        self.of, self.squares = np.repeat(np.arange(len(own)), sizes)[order], x[order] ** 2

    def idf(self, words: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(words), math.log(1 + self.n) + 1)
        at = np.minimum(np.searchsorted(self.keys, words), len(self.keys) - 1)
        return np.log((1 + self.n) / (1 + np.where(self.keys[at] == words, self.docs[at], 0))) + 1

    def unit(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, k = np.unique(words, return_counts=True)
        x = k * self.idf(keys)
        return keys, x / math.sqrt((x * x).sum() or 1.0)

    def reachable(self, own: np.ndarray, threshold: float) -> np.ndarray:
        """Templates that a passage of the distinct terms can reach: a cosine is at most the root of the squares it covers."""
        if not len(self.names) or not len(own):
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, own), len(self.vocabulary) - 1)
        at = at[self.vocabulary[at] == own]
        size = self.ends[at + 1] - self.ends[at]
        flat = np.repeat(self.ends[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.flatnonzero(np.bincount(self.of[flat], self.squares[flat], len(self.names)) >= threshold * threshold - 1e-9)

    def _parts(self, template: int, words: np.ndarray) -> np.ndarray:
        keys, x = self.vectors[template]
        at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
        return np.where(keys[at] == words, x[at], 0.0)

    def best(self, passage: str) -> tuple[str, float] | None:
        """The most similar template, of equal ones the first by name."""
        own, x = self.unit(terms(passage))
        found = [(float((x * self._parts(k, own)).sum()), name) for k, name in enumerate(self.names)]
        cosine, name = max(found, key=lambda p: (round(p[0], 12), [-ord(c) for c in p[1]]), default=(0.0, ""))
        return (name, cosine) if cosine > 0 else None

    def match(self, words: np.ndarray, spans: list[tuple[int, int]], threshold: float) -> tuple[str, float, int, int] | None:
        """Template, cosine, first and last (exclusive) word of the passage that matches best.

        Passages are the spans and, for each template, all windows of as many words as it has. A template's match gives way
        to that of one at least twice as long around it: a whole text holds its own headers. Of the others the highest
        cosine counts, then the first passage, the shortest and the first name.
        """
        own, at = np.unique(words, return_inverse=True)
        reach = self.reachable(own, threshold)
        if not len(reach):
            return None
        size, idf = len(words), self.idf(own)
        a, b = (np.array([s[k] for s in spans], np.int64) for k in (0, 1))
        squares = np.array([(np.bincount(at[i:j]) ** 2 * idf[: at[i:j].max(initial=-1) + 1] ** 2).sum() for i, j in spans])
        place = at.astype(np.int64) * (size + 1) + np.arange(size)
        order, found = np.sort(place), []

        def within(shift: int, width: int) -> np.ndarray:
            """For each place, others of its term in the width places from shift on."""
            low = np.clip(np.arange(size) + shift, 0, size) - np.arange(size) + place
            high = np.clip(np.arange(size) + shift + width, 0, size) - np.arange(size) + place
            return np.searchsorted(order, high) - np.searchsorted(order, low)

        for k in reach:
            length, sums = int(self.lengths[k]), np.append(0.0, np.cumsum((self._parts(k, own) * idf)[at]))
            first, last, square = a, b, squares
            if size > length:
                # a window's squares: those of the first, and what each step adds at its end and takes at its start
                own_squares = idf[at] ** 2
                come = (2 * within(1 - length, length - 1) + 1) * own_squares
                go = (2 * within(1, length - 1) + 1) * own_squares
                start = (np.bincount(at[:length], minlength=len(own)) ** 2 * idf**2).sum()
                more = start + np.append(0.0, np.cumsum(come[length:] - go[: size - length]))
                s = np.arange(size - length + 1)
                first, last, square = np.append(a, s), np.append(b, s + length), np.append(squares, more)
            cosine = (sums[last] - sums[first]) / np.sqrt(np.maximum(square, 1e-12))
            top = np.flatnonzero(cosine >= cosine.max() - 1e-9)
            i = min(top, key=lambda i: (first[i], last[i]))
            if cosine[i] >= threshold - 1e-9:
                found.append((int(k), min(1.0, float(cosine[i])), int(first[i]), int(last[i])))
        left = [f for f in found if not any(self.lengths[g[0]] >= 2 * self.lengths[f[0]] and g[2] <= f[2] and f[3] <= g[3] and g[3] - g[2] > f[3] - f[2] for g in found)]
        if not left:
            return None
        k, cosine, i, j = min(left, key=lambda f: (-round(f[1], 8), f[2], f[3], self.names[f[0]]))
        return self.names[k], cosine, i, j


def _lines(text: bytes) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Words, the word at which each line ends, and passages: the whole text, blocks between blank lines, and lines."""
    parts = [terms(line) for line in text.split(b"\n")]
    ends = np.cumsum([len(p) for p in parts])
    words, spans, block = np.concatenate(parts), {(0, int(ends[-1]))}, 0
    for k, (line, end) in enumerate(zip(text.split(b"\n"), ends.tolist(), strict=True)):
        spans.add((end - len(parts[k]), end))
        if not line.strip():
            spans.add((block, end))
            block = end
    spans.add((block, len(words)))
    return words, ends, sorted(s for s in spans if s[0] < s[1])


def counted(files: DataFrame) -> DataFrame:
    """(key, n), stored: in how many files each term stands; n of the null key is the number of files."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.unique(terms(t or b"")) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            keys, n = np.unique(np.concatenate([np.empty(0, np.int64), *own]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([*keys.tolist(), None], pa.int64()), pa.array([*n.tolist(), len(own)], pa.int64())], ["key", "n"])

    got = files.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "key long, n long")
    return common.stored(got.groupBy("key").agg(F.sum("n").alias("n")), "term-counts")


def _collected(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    got = counts.where("key is not null").select("key", "n").toArrow()
    return got.column("key").to_numpy().astype(np.int64), got.column("n").to_numpy().astype(np.int64)


def matched(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """files without text, with license_id, cosine, line, n_lines and whole of the passage that is most like a template.

    files: text and any other columns. Templates (license_id, text) are statements, headers and whole texts, any number for a
    license_id. Passages are a text as a whole, its blocks between blank lines, its lines, and all windows of a
    template's length over its words, across line ends; Weights.match() says which counts. line, from 0, is that in which
    the passage begins, n_lines the number of all lines; whole: the passage is of several lines and all words of the text.
    Without a passage at or above threshold, and for null or empty texts, license_id, cosine, line and whole are null.

    The templates are a parameter, whole in the driver and each task. Document counts of all terms come from all files. Only files whose terms cover enough of a template are scored; the driver
    and each task hold the counts of their distinct terms, 16 bytes each.
    """
    spark = files.sparkSession
    known = [(r[0], r[1]) for r in templates.where("license_id is not null and text is not null").select("license_id", "text").collect()]
    counts = counted(files)
    n = counts.where("key is null").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    vocabulary = np.unique(np.concatenate([np.empty(0, np.int64), *[terms(text) for _, text in known]]))
    of_templates = spark.createDataFrame([(k,) for k in vocabulary.tolist()], "key long")
    first = spark.sparkContext.broadcast(Weights(known, n, _collected(counts.join(F.broadcast(of_templates), "key", "left_semi"))))

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = first.value
        for batch in batches:
            own = [np.unique(terms(t or b"")) for t in batch.column(0).cast(pa.binary()).to_pylist()]
            held = [x for x in own if len(weights.reachable(x, threshold))]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([np.empty(0, np.int64), *held])))], ["key"])

    text = F.col("text").cast("string").alias("text")
    needed = files.select(text).mapInArrow(candidates, "key long").distinct().union(of_templates).distinct()
    full = spark.sparkContext.broadcast(Weights(known, n, _collected(counts.join(needed, "key", "left_semi"))))
    rest = [c for c in files.columns if c not in ("text", "license_id", "cosine", "line", "n_lines", "whole")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = full.value
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist():
                t, row = t or b"", (None, None, None, None)
                if len(weights.reachable(np.unique(terms(t)), threshold)):
                    words, ends, spans = _lines(t)
                    got = weights.match(words, spans, threshold)
                    if got:
                        line, last = np.searchsorted(ends, [got[2], got[3] - 1], side="right")
                        row = (got[0], got[1], int(line), bool(line < last and got[3] - got[2] == len(words)))
                for column, value in zip(out, (*row[:3], t.count(b"\n") + 1, row[3]), strict=True):
                    column.append(value)
            types = (pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, k) for c, k in zip(out, types, strict=True)]], [*rest, "license_id", "cosine", "line", "n_lines", "whole"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in files.select(*rest).schema)
    return files.select(*rest, text).mapInArrow(scan, f"{kinds}license_id string, cosine double, line int, n_lines int, whole boolean")


def directory(path: Column) -> Column:
    """Without the last part; a path without / is in the root, whose name is empty."""
    return F.regexp_replace(path, r"(?s)/?[^/]*$", "")


def inherited(files: DataFrame) -> DataFrame:
    """files with license_id, cosine, from_dir (null for an own licence) and inherited.

    files: path, license_id, cosine (null: no own), is_license_file. The own licence stands; else that of the nearest
    directory, the file's own first, that holds a licence file with one: of several the most similar, then the
    first by license_id. Files without path, or without a licensed directory above, get nulls.
    """
    held = files.where("is_license_file and license_id is not null and path is not null")
    order = F.struct(F.col("cosine"), F.transform(F.split("license_id", ""), lambda c: -F.ascii(c)))
    licensed = held.groupBy(directory(F.col("path")).alias("from_dir")).agg(F.max_by(F.struct("license_id", "cosine"), order).alias("given"))
    dirs = files.where("license_id is null and path is not null").groupBy(directory(F.col("path")).alias("dir")).agg(F.count("*").alias("files_in"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("from_dir")))
    steps = dirs.select("dir", "files_in", F.explode(above).alias("a")).select("dir", "files_in", "a.depth", "a.from_dir")
    nearest = steps.join(licensed, "from_dir").groupBy("dir").agg(
        F.max("files_in").alias("files_in"), F.max_by(F.struct("given.license_id", "given.cosine", "from_dir"), "depth").alias("got")
    )
    helper = common.prefix(files.columns, "licensed_")
    key, got = f"{helper}dir", f"{helper}got"
    nearest = common.stored(nearest.select(F.col("dir").alias(key), "files_in", F.col("got").alias(got)), "licensed-directories")
    own_dir = F.when(F.col("license_id").isNull(), directory(F.col("path"))).alias(key)
    rows = common.look_up(files.select("*", own_dir), nearest, [key], "files_in", F.col("path"))
    rest = [F.col(f"`{c}`") for c in files.columns if c not in ("license_id", "cosine", "from_dir", "inherited")]
    return rows.select(
        *rest, F.coalesce("license_id", F.col(got)["license_id"]).alias("license_id"), F.coalesce("cosine", F.col(got)["cosine"]).alias("cosine"),
        F.col(got)["from_dir"].alias("from_dir"), (F.col("license_id").isNull() & F.col(got).isNotNull()).alias("inherited"),
    )


def licences(files: DataFrame, templates: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """matched() and inherited() for files (path, text, is_license_file and any other columns)."""
    own = common.stored(matched(files, templates, threshold).drop("whole"), "own-licences")
    return inherited(own)

