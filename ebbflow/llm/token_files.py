"""Token ids in Arrow IPC files of fixed-size-list batches, in document order.

A shard is two files. `N.arrow`: batches of columns `ids` (fixed-size list of unsigned integers) and `mask`
(fixed-size list of bytes, 1 for an id and 0 on the padding after the last one); every batch but the last has
`batch_rows` sequences, so sequence i is row i % batch_rows of batch i // batch_rows. `N.index.arrow`:
doc_id, start and n_tokens of each document of the shard, start within it. Ids have two bytes where the
vocabulary fits, else four. Nothing is compressed, so a mapped file gives
sequences and their masks without a copy.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common, tokens

SEQUENCE, BATCH_ROWS = 2048, 64
#: Bytes of text of a shard, on average, and documents of an index batch.
SHARD_BYTES, INDEX_ROWS = 16 << 20, 1 << 16
MANIFEST = "shard int, path string, n_docs long, n_tokens long"
INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
DOCS = "shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Streams ids into one shard, a batch in memory at a time; the files appear under their names when closed."""

    def __init__(self, uri: str, dtype: np.dtype, length: int, batch_rows: int):
        self.files, self.path = _open(uri)
        self.length, self.rows, self.dtype = length, batch_rows, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.uint8(), length))], {"batch_rows": str(batch_rows)})
        import uuid

        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.sink = self.files.open_output_stream(self.part)
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.index_sink = self.files.open_output_stream(f"{self.part}.index")
        self.index = pa.ipc.new_file(self.index_sink, INDEX)
        self.held: list[np.ndarray] = []
        self.n_held = self.n = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        """Documents whose ids stand one after another: document i has ids[ends[i] : ends[i + 1]]."""
        for at in range(0, len(doc_ids), INDEX_ROWS):
            own = ends[at : at + INDEX_ROWS + 1]
            self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids[at : at + INDEX_ROWS], pa.array(self.n + own[:-1]), pa.array(np.diff(own))], schema=INDEX))
        self.held.append(ids)
        self.n += len(ids)
        self.n_docs += len(doc_ids)
        self.n_held += len(ids)
        size = self.length * self.rows
        if self.n_held >= size:
            flat = np.concatenate(self.held)
            for at in range(0, len(flat) - size + 1, size):
                self._write(flat[at : at + size], size)
            self.held = [flat[len(flat) - len(flat) % size :]]
            self.n_held = len(self.held[0])

    def _write(self, flat: np.ndarray, real: int) -> None:
        mask = pa.array((np.arange(len(flat)) < real).astype(np.uint8))
        lists = [pa.FixedSizeListArray.from_arrays(x, self.length) for x in (pa.array(flat), mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            flat = np.concatenate(self.held)
            self._write(np.append(flat, np.zeros(-len(flat) % self.length, self.dtype)), len(flat))
        self.out.close()
        self.sink.close()
        self.index.close()
        self.index_sink.close()
        self.files.move(f"{self.part}.index", self.path.removesuffix(".arrow") + ".index.arrow")
        self.files.move(self.part, self.path)


class Shard:
    """Random access to a shard's sequences and documents."""

    def __init__(self, uri: str):
        files, path = _open(uri)
        local = files.type_name == "local"
        self._sources = [pa.memory_map(p) if local else files.open_input_file(p) for p in (path, path.removesuffix(".arrow") + ".index.arrow")]
        self.file, self.index = map(pa.ipc.open_file, self._sources)
        self.rows = int(self.file.schema.metadata[b"batch_rows"])
        self.length = self.file.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def _ids(self, batch: int) -> np.ndarray:
        if batch != self._at:
            self._at, self._batch = batch, self.file.get_batch(batch)
        return self._batch.column(0).flatten().to_numpy()

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence i, views of the file."""
        row = i % self.rows
        own = slice(row * self.length, (row + 1) * self.length)
        return self._ids(i // self.rows)[own], self._batch.column(1).flatten().to_numpy()[own]

    def ids(self, start: int, n: int) -> np.ndarray:
        """n ids from a place in the shard."""
        size, out = self.length * self.rows, []
        while n > 0:
            part = self._ids(start // size)[start % size :][:n]
            out.append(part)
            start, n = start + len(part), n - len(part)
        return out[0] if len(out) == 1 else np.concatenate([np.empty(0, "<u2"), *out])

    def documents(self) -> Iterator[tuple]:
        """(doc_id, start, n_tokens), in order."""
        for k in range(self.index.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self.index.get_batch(k).columns), strict=True)

    def close(self) -> None:
        self._batch = None
        for s in self._sources:
            s.close()


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 2, length: int = SEQUENCE, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Encode documents into shards of `folder`, a URI that all executors reach, in ascending doc_id order.

    Returns the manifest (shard, path, n_docs, n_tokens), stored; shards in order of number are the whole
    stream. Null texts are empty and have their end id alone. Null doc_ids come first; rows of one doc_id go
    by a hash of the text and text, so many of them spread over shards. An empty table gives no shard. A task that runs again replaces its files with equal ones.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, shard, out = tokens.encoder(tokenizer), TaskContext.get().partitionId(), None
        for batch in batches:
            out = out or ShardWriter(path := f"{folder}/{shard:06d}.arrow", coder.dtype, length, batch_rows)
            out.add(batch.column(0), *tokens.ended(*coder.batch(batch.column(1)), end_id))
        if out:
            out.close()
            values = ([shard], [path], [out.n_docs], [out.n])
            types = (pa.int32(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], ["shard", "path", "n_docs", "n_tokens"])

    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    ordered = rows.repartitionByRange(max(1, -(-size // SHARD_BYTES)), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return common.stored(ordered.mapInArrow(common.lean(save), MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """One row per document from the files of a manifest: doc_id, start in the whole stream, n_tokens, ids_crc32."""

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, rows = Shard(path), []
                for doc, start, n in own.documents():
                    rows.append((shard, doc, start, n, zlib.crc32(own.ids(start, n).astype("<u4").tobytes())))
                    if len(rows) == 10_000:
                        yield _rows(rows)
                        rows = []
                yield _rows(rows)
                own.close()

    def _rows(rows: list) -> pa.RecordBatch:
        types = (pa.int32(), *[pa.int64()] * 4)
        names = ["shard", "doc_id", "local_start", "n_tokens", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    spark = manifest.sparkSession
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = manifest.select("shard", before.alias("base"))  # a row for each shard
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = manifest.select("shard", "path").repartition(tasks).mapInArrow(load, DOCS)
    return found.join(F.broadcast(starts), "shard").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
