"""WARC archives written and read as a chunked record table."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, scratch, small_reads, wide

CHUNK = 64 << 10
#: Repeated payloads, told by their digests, that a partition may hold in a hash table.
KEYS = 200_000
#: Bytes of archives that a task reads, where there are enough for every core.
READ = 16 << 20
MEMBER_DATE = "2000-01-01T00:00:00Z"
RECORD = "urn:x-page:"
CHUNKS = "archive string, record_id string, record_type string, target_uri string, refers_to string, payload_digest string, payload_bytes long, chunk_no long, chunk binary, bytes_so_far long, digest_so_far string, last boolean"


def chunk_table(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", chunk: int = CHUNK, least: int = 0) -> DataFrame:
    """Rows (record_id, url, refers_to, sha1, n_bytes, chunk_no, chunk), the chunks of a record one after another.

    refers_to is set on every row but the smallest id of those with equal payloads of at least ``least`` bytes.
    Equal payloads are told by length, SHA-1 and SHA-256 together. Payloads are streamed past a hash table of the repeated ones, never sorted,
    unless there are so many rows that a partition's table might pass ``KEYS``.
    """
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    p = p.select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha2"))
    same = ["n_bytes", "sha1", "sha2"]
    again = p.where(F.col("n_bytes") >= least).groupBy(*same).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    few = pages.count() <= 2 * KEYS * wide(pages.sparkSession)  # a repeated payload has two rows at least
    p = p.join(again.hint("shuffle_hash" if few else "merge"), same, "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    last = F.when(revisit, F.lit(0)).otherwise(F.greatest(F.lit(0), F.ceil(F.col("n_bytes") / chunk).cast("int") - 1))
    part = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    cut = p.select("page_id", "url", F.when(revisit, F.col("first")).alias("refers_to"), "sha1", "n_bytes", part.alias("payload"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    # a row per chunk from the start: no row holds all chunks of a record
    return cut.select(F.col("page_id").cast("string").alias("record_id"), "url", F.col("refers_to").cast("string").alias("refers_to"), "sha1", "n_bytes", "chunk_no", F.substring("payload", F.col("chunk_no") * chunk + 1, F.lit(chunk)).alias("chunk"))


def _name(record: str | None) -> str:
    return f"<{RECORD}{'null' if record is None else 'id-' + quote(record, safe='')}>"


def _id(name: str | None) -> str | None:
    if name is None or name == f"<{RECORD}null>":
        return None
    return unquote(name[len(RECORD) + 4 : -1])


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


class _Archive:
    """One gzip member per record, streamed through a fixed buffer."""

    def __init__(self, folder: str):
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        self._out = system.open_output_stream(fs.FileSystem.from_uri(self.path)[1])
        self.bytes = self.records = 0
        self._gz = None

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self._out.write(data)

    def begin(self, head: bytes) -> None:
        self._gz = zlib.compressobj(6, zlib.DEFLATED, 31)
        self.records += 1
        self.add(head)

    def add(self, data: bytes) -> None:
        self._put(self._gz.compress(data))

    def end(self) -> None:
        self._put(self._gz.compress(b"\r\n\r\n") + self._gz.flush())
        self._gz = None

    def close(self) -> None:
        self._out.close()


def write_archives(chunks: DataFrame, folder: str, roll: int = 256 << 20) -> DataFrame:
    """Writes the chunk table to WARC files in ``folder``; returns the table of finished archives (path, records, bytes).

    A task writes files of its own name and reports them only when it ends well, so what a lost executor
    or a second attempt leaves behind is never listed and never read. A record is written chunk by chunk.
    The list, a few rows per task, is held by the driver as Spark holds what its own writers commit: so no task starts the processes
    that a table's file costs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done, open_record = None, [], False
        for b in batches:
            for r in b.to_pylist():
                if r["chunk_no"] == 0:
                    if open_record:
                        archive.end()
                    if archive is not None and archive.bytes >= roll:
                        archive.close()
                        done.append(archive)
                        archive = None
                    archive = archive or _Archive(folder)
                    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['n_bytes']}\r\n\r\n".encode()
                    again = r["refers_to"] is not None
                    head = ["WARC/1.1", f"WARC-Type: {'revisit' if again else 'response'}", f"WARC-Record-ID: {_name(r['record_id'])}", f"WARC-Date: {MEMBER_DATE}"]
                    if r["url"] is not None:
                        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", r["url"]))
                    if again:
                        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_name(r['refers_to'])}"]
                    head += [f"WARC-Payload-Digest: sha1:{_base32(r['sha1'])}", f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(http) + (0 if again else r['n_bytes'])}"]
                    archive.begin(("\r\n".join(head) + "\r\n\r\n").encode() + http)
                    open_record = True
                archive.add(r["chunk"])
        if archive is not None:
            archive.end()
            archive.close()
            done.append(archive)
        yield pa.RecordBatch.from_arrays([pa.array([a.path for a in done], pa.string()), pa.array([a.records for a in done], pa.int64()), pa.array([a.bytes for a in done], pa.int64())], names=["path", "records", "bytes"])

    spark, kinds = chunks.sparkSession, "path string, records long, bytes long"
    bounded_batches(spark)
    with small_reads(spark):
        done = chunks.mapInArrow(run, kinds).toArrow()
    return spark.createDataFrame(done, kinds)


class _Stream:
    """Bytes of a multi-member gzip file, inflated a piece at a time."""

    def __init__(self, path: str):
        system, where = fs.FileSystem.from_uri(path)
        self._in = system.open_input_stream(where)
        self._z, self._raw, self._buf = zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        if self._z.eof:
            self._raw = self._z.unused_data
            self._z = zlib.decompressobj(31)
        raw = self._raw or self._z.unconsumed_tail or self._in.read(CHUNK)
        self._raw = b""
        if not raw:
            return False
        self._buf += self._z.decompress(raw, CHUNK)
        return True

    def line(self) -> bytes | None:
        while (at := self._buf.find(b"\r\n")) < 0:
            if not self._more():
                return None
        out, self._buf = self._buf[:at], self._buf[at + 2 :]
        return out

    def read(self, n: int) -> bytes:
        while len(self._buf) < n:
            if not self._more():
                raise EOFError("the archive ends within a record")
        out, self._buf = self._buf[:n], self._buf[n:]
        return out

    def headers(self) -> dict[str, str]:
        out = {}
        while line := self.line():
            k, _, v = line.decode().partition(":")
            out[k.strip().lower()] = v.strip()
        return out


def _records(path: str, chunk: int, contents: bool) -> Iterator[tuple]:
    s = _Stream(path)
    while (version := s.line()) is not None:
        if not version:
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"{path}: no WARC record where one should begin: {version[:40]!r}")
        h = s.headers()
        if not (status := s.line()).startswith(b"HTTP/"):
            raise ValueError(f"{path}: no HTTP response in {h.get('warc-record-id')}: {status[:40]!r}")
        http = s.headers()
        n = int(http["content-length"])
        left = 0 if h["warc-type"] == "revisit" else n
        fixed = (path, _id(h["warc-record-id"]), h["warc-type"], h.get("warc-target-uri"), _id(h.get("warc-refers-to")), h["warc-payload-digest"].removeprefix("sha1:"), n)
        sha, so_far, no = hashlib.sha1(), 0, 0
        while True:
            part = s.read(min(chunk, left))
            left -= len(part)
            so_far += len(part)
            sha.update(part)
            digest = base64.b32encode(sha.copy().digest()).decode()
            if not left and h["warc-type"] == "response" and digest != fixed[5]:
                raise ValueError(f"{path}: the payload of {fixed[1]} has digest {digest}, not {fixed[5]}")
            yield (*fixed, no, part if contents else None, so_far, digest, not left)
            no += 1
            if not left:
                break
        s.read(4)


def read_archives(archives: DataFrame, chunk: int = CHUNK, contents: bool = True) -> DataFrame:
    """The records of the listed archives as rows of a record's identifier and a chunk's number.

    Each row has the SHA-1 and the length of the payload up to and with its chunk; at the last one they are
    held against the record's header, and a difference stops the read. No record is held as a whole.
    Without ``contents`` the chunks themselves are left out. A revisit has one empty chunk.
    """
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    types = [pa.string()] * 6 + [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows, size = [], 0
                for r in _records(path, chunk, contents):
                    rows.append(r)
                    size += 300 + len(r[8] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    spark = archives.sparkSession
    cores = spark.sparkContext.defaultParallelism
    count, size = archives.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    n = max(1, min(count, 4 * cores, max(cores, -(-size // READ))))
    return archives.select("path").repartition(n).mapInArrow(run, CHUNKS)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None, chunk: int = CHUNK, least: int = 0, contents: bool = False) -> DataFrame:
    """Writes a record per row, then reads the archives back; the chunk rows that ``read_archives`` gives.

    Of rows with equal payloads of at least ``least`` bytes, that with the smallest id is a response, the others revisit
    it. A null payload is empty, a null URL is left out, a null id is written as such and never the smallest while
    there is another (with none, all are responses). Rows that repeat both the smallest id and its payload are
    responses each. No rows give no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    chunks = chunk_table(pages, id_col, url_col, payload_col, chunk, least)
    return read_archives(write_archives(chunks, folder or scratch(spark, "warc")), chunk, contents)
