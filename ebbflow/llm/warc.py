"""WARC archives: written as one gzip stream each, normalised to a member per record with an offset index, read back."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1000
DATE, LEVEL, CHUNK = "2024-01-01T00:00:00Z", 4, 1 << 18
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = pa.schema([("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string())])


def _files(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _name(page: int | None) -> str:
    return f"<urn:ebbflow:page:{'none' if page is None else page}>"


def _page(name: str) -> int | None:
    found = re.fullmatch(r"<urn:ebbflow:page:(-?\d+)>", name)
    return int(found[1]) if found else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response record, or a revisit record without the payload; digest in hex, of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _name(page)}
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._|")
    head |= {"WARC-Date": DATE, "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if revisit:
        head |= {"WARC-Refers-To": _name(refers_to), "WARC-Profile": PROFILE}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:] if line)}


class _Inflated:
    """Bytes of a gzip file of one or more members, inflated once from start to end."""

    def __init__(self, file):
        self.file, self.state, self.held = file, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        while True:
            raw = self.state.unused_data if self.state.eof else b""
            if self.state.eof:
                raw = raw or self.file.read(CHUNK)
                if not raw:
                    return False
                self.state = zlib.decompressobj(31)
            else:
                raw = self.state.unconsumed_tail or self.file.read(CHUNK)
                if not raw:
                    raise ValueError("the gzip stream ends early")
            got = self.state.decompress(raw, 4 * CHUNK)
            self.held += got
            if got:
                return True

    def until(self, mark: bytes) -> bytes | None:
        """Through the mark; None at the end of the file."""
        at = 0
        while (found := self.held.find(mark, at)) < 0:
            at = max(0, len(self.held) - len(mark) + 1)
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(found + len(mark))

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.held and not self.more():
                raise ValueError("the archive ends within a record")
            part = self.take(min(n, len(self.held)))
            n -= len(part)
            yield part


def normalise(source: str, target: str, index: str) -> int:
    """Rewrite a gzipped archive with each record as a member of its own, and write its index; returns the records.

    The file is inflated once, a chunk in memory at a time. Files appear under their names when complete.
    """
    files, path = _files(source)
    out_files, out_path = _files(target)
    _, index_path = _files(index)
    part, n, at = f".{uuid.uuid4().hex}.part", 0, 0
    rows: list[tuple] = []
    with files.open_input_stream(path, compression=None) as raw, out_files.open_output_stream(out_path + part, compression=None) as out:
        with out_files.open_output_stream(index_path + part) as sink, pa.ipc.new_file(sink, INDEX) as table:
            stream = _Inflated(raw)
            while (head := stream.until(b"\r\n\r\n")) is not None:
                own = headers(head)
                member, start = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), at
                out.write(member.compress(head))
                for piece in stream.exactly(int(own["content-length"]) + 4):
                    out.write(member.compress(piece))
                out.write(member.flush())
                at = out.tell()
                rows.append((start, at - start, own["warc-record-id"], own["warc-type"]))
                n += 1
                if len(rows) == 10_000:
                    table.write_batch(_index_rows(rows))
                    rows = []
            if rows:
                table.write_batch(_index_rows(rows))
    out_files.move(index_path + part, index_path)
    out_files.move(out_path + part, out_path)
    return n


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), INDEX, strict=True)], schema=INDEX)


class Archive:
    """Random access to a normalised archive by its index."""

    def __init__(self, path: str, index: str):
        files, self.path = _files(path)
        self.file = files.open_input_file(self.path)
        self.table = pa.ipc.open_file(files.open_input_file(_files(index)[1]))

    def index(self) -> Iterator[tuple]:
        for k in range(self.table.num_record_batches):
            yield from zip(*(c.to_pylist() for c in self.table.get_batch(k).columns), strict=True)

    def read(self, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
        """WARC headers, HTTP headers and payload of the record at an offset."""
        self.file.seek(offset)
        raw = zlib.decompress(self.file.read(length), 31)
        head, _, rest = raw.partition(b"\r\n\r\n")
        own = headers(head)
        block = rest[: int(own["content-length"])]
        http, _, payload = block.partition(b"\r\n\r\n")
        return own, headers(http), payload


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as archives of one gzip stream each in folder; returns (archive), stored.

    Payload: html in UTF-8, null as empty. Of rows with equal payloads of REVISIT_BYTES or more, that with the
    largest page_id is a response and the others revisit it; rows that repeat that page_id are responses too. A
    group without any page_id is all responses. A null url has no target URI; bytes that a URI can't hold are
    percent-encoded. No rows give no archive.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
    large = rows.where(F.octet_length("html") >= REVISIT_BYTES)
    groups = large.groupBy("digest").agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
    groups = common.stored(groups.where("copies > 1 and response is not null"), "payload-groups")
    placed = common.look_up(rows, groups, ["digest"], "copies", F.coalesce("page_id", F.xxhash64("url")))
    revisit = F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    placed = placed.select("page_id", "url", "html", "digest", "response", revisit.alias("revisit"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files = out = None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                if out is None:
                    uri = f"{folder}/{TaskContext.get().partitionId():06d}.warc.gz"
                    files, path = _files(uri)
                    part = f"{path}.{uuid.uuid4().hex}.part"
                    out, stream = files.open_output_stream(part, compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                columns = [c.cast(pa.binary()).to_pylist() if k == 2 else c.to_pylist() for k, c in enumerate(some.columns)]
                for page, url, payload, digest, response, again in zip(*columns, strict=True):
                    out.write(stream.compress(record(page, url, payload, digest, response, again)))
        if out is not None:
            out.write(stream.flush())
            out.close()
            files.move(part, path)
            yield pa.RecordBatch.from_arrays([pa.array([uri])], ["archive"])

    files, path = _files(folder)
    files.create_dir(path, recursive=True)
    return common.stored(placed.mapInArrow(save, "archive string"), "archives")


def normalised(archives: DataFrame) -> DataFrame:
    """Normalise archives (archive), one task each at most; returns (archive, index, records), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                stem = uri.removesuffix(".warc.gz")
                new, index = f"{stem}.members.warc.gz", f"{stem}.members.index.arrow"
                n = normalise(uri, new, index)
                yield pa.RecordBatch.from_arrays([pa.array([new]), pa.array([index]), pa.array([n], pa.int64())], ["archive", "index", "records"])

    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = archives.repartition(tasks)
    return common.stored(dealt.mapInArrow(run, "archive string, index string, records long"), "members")


def read(members: DataFrame) -> DataFrame:
    """A row per record of normalised archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's payload is hashed anew and must have the digest of its header; a revisit has the length and
    digest of the full payload in its headers.
    """
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                archive, rows = Archive(path, index), []
                for offset, length, name, kind in archive.index():
                    own, http, payload = archive.read(offset, length)
                    digest = base64.b32decode(own["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{name}: the payload has another digest than its header says")
                    refers = _page(own["warc-refers-to"]) if kind == "revisit" else None
                    rows.append((_page(name), int(http["content-length"]), digest, kind, refers))
                    if len(rows) == 10_000:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)

    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return members.select("archive", "index").repartition(tasks).mapInArrow(load, schema)
