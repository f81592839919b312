"""WARC archives, a gzip member for each record: written from a page table, read back as a chunked record table.

``write_archives`` streams one archive per task into the shared folder; ``read_chunks`` streams the
archives into rows (record, chunk number), each with the digest and length of the payload so far, so
neither side ever holds more of an archive than one chunk besides the row at hand. The row of a record's
last chunk carries the digest of the whole payload; ``records`` keeps those rows.

Defined cases: a null payload is empty; a null url leaves out WARC-Target-URI; a null page id leaves out
the id, and such a record reads back with a null id; payloads under ``least`` bytes are never revisited;
rows that repeat the smallest page id of a payload are all responses; an empty table gives an empty one.
Other columns of the page table are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import create, fresh_folder, stream, task_file
from .shared import bounded_batches, keep, table

VERSION = b"WARC/1.1"
EOL = b"\r\n"
#: Fixed values of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEAST_BYTES = 100
CHUNK_BYTES = 1 << 20
GZIP = 31
DATE = "2020-01-01T00:00:00Z"
CHUNKS = "record_id string, page_id long, record_type string, refers_to long, chunk long, last boolean, chunk_bytes long, payload_bytes long, payload_digest string, intact boolean"


def with_revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest, refers_to: the smallest page id among equal payloads, null for itself.

    Only digests with at least two rows are joined back; a digest that a third of all rows share is
    pre-aggregated by the group-by and split by the adaptive skew join.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    shared = rows.where(F.octet_length("payload") >= least).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = rows.join(shared, "payload_digest", "left")
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first")).alias("refers_to"))


def _record(page_id, url, payload: pa.Buffer, digest: str, refers_to) -> tuple[bytes, memoryview | bytes]:
    """Header block and payload of one record."""
    size = len(payload)
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    head.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if refers_to is not None:
        head += [("WARC-Profile", REVISIT_PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    body = memoryview(payload) if refers_to is None else b""
    head += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(http) + len(body)))]
    return VERSION + EOL + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + EOL + http, body


def write_archives(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write every row as a record; returns the manifest (path, records) of the archives that count."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = fresh_folder(spark, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, n = task_file(folder, ".warc.gz"), None, 0
        for batch in batches:
            ids, urls, digests, refers = (batch.column(k).to_pylist() for k in ("page_id", "url", "payload_digest", "refers_to"))
            payloads = batch.column("payload")
            for k in range(len(ids)):
                out = out or create(path)
                head, body = _record(ids[k], urls[k], payloads[k].as_buffer(), digests[k], refers[k])
                member = zlib.compressobj(2, wbits=GZIP)
                out.write(member.compress(head))
                for at in range(0, len(body), CHUNK_BYTES):
                    out.write(member.compress(body[at : at + CHUNK_BYTES]))
                out.write(member.compress(EOL + EOL) + member.flush())
                n += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return keep(with_revisits(pages, least).mapInArrow(write, "path string, records long"), "warc-manifest")


class _Members:
    """What the gzip members of a stream hold, at most 64 KB at a time."""

    def __init__(self, source):
        self.source, self.left, self.member = source, b"", zlib.decompressobj(GZIP)

    def read(self, _: int) -> bytes:
        while True:
            if self.member.eof:
                self.left, self.member = self.member.unused_data, zlib.decompressobj(GZIP)
            self.left = self.left or self.source.read(1 << 16)
            if not self.left:
                return self.member.decompress(b"", 1 << 16)
            found = self.member.decompress(self.left, 1 << 16)
            self.left = self.member.unconsumed_tail
            if found:
                return found


class _Reader:
    """Lines and byte ranges of a stream, by a bounded buffer."""

    def __init__(self, source):
        self.source, self.left = source, b""

    def line(self) -> bytes | None:
        while (at := self.left.find(EOL)) < 0:
            more = self.source.read(1 << 16)
            if not more:
                if self.left:
                    raise ValueError("an archive ends within a line")
                return None
            self.left += more
        found, self.left = self.left[:at], self.left[at + 2 :]
        return found

    def take(self, n: int) -> bytes:
        """At most n bytes, at least one."""
        if not self.left:
            self.left = self.source.read(max(n, 1 << 16))
            if not self.left:
                raise ValueError("an archive ends within a record")
        found, self.left = self.left[:n], self.left[n:]
        return found


def parse(source, chunk_bytes: int = CHUNK_BYTES, data: bool = False) -> Iterator[tuple]:
    """The rows of CHUNKS (and the chunk's bytes) of one archive."""
    reader = _Reader(_Members(source))
    while (line := reader.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while line := reader.line():
            name, _, value = line.partition(b":")
            head[name.decode().lower()] = value.strip().decode()
        left = int(head["content-length"])
        http_length = 0
        if head.get("content-type", "").startswith("application/http"):
            while True:
                line = reader.line()
                left -= len(line) + 2
                if line.lower().startswith(b"content-length:"):
                    http_length = int(line.partition(b":")[2])
                if not line:
                    break
        number = lambda key: int(head[key]) if key in head else None
        said = head.get("warc-payload-digest", "").removeprefix("sha256:")
        fixed = (head.get("warc-record-id"), number("x-page-id"), head["warc-type"], number("x-refers-to-page-id"))
        if head["warc-type"] == "revisit":
            yield (*fixed, 0, True, 0, http_length, said, True, *([b""] if data else []))
            while left:
                left -= len(reader.take(left))
            continue
        digest, chunk, done = hashlib.sha256(), 0, 0
        while True:
            parts, size = [], 0
            while left and size < chunk_bytes:
                part = reader.take(min(left, chunk_bytes - size))
                digest.update(part)
                size, left = size + len(part), left - len(part)
                if data:
                    parts.append(part)
            done += size
            so_far = digest.hexdigest()
            yield (*fixed, chunk, not left, size, done, so_far, bool(left) or so_far == said, *([b"".join(parts)] if data else []))
            chunk += 1
            if not left:
                break


def read_chunks(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES, data: bool = True) -> DataFrame:
    """One row per record and chunk number; payload_bytes and payload_digest are those of the payload so far."""
    spark = manifest.sparkSession
    schema = CHUNKS + (", data binary" if data else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with stream(path) as source:
                    rows, held = [], 0
                    for row in parse(source, chunk_bytes, data):
                        rows.append(row)
                        held += row[6] if data else 64
                        if held >= 4 * chunk_bytes or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return manifest.select("path").repartition(spread(spark)).mapInArrow(read, schema)


def spread(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: its last chunk knows the whole payload's length and digest."""
    return chunks.where("last").drop("last", "chunk", "chunk_bytes")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write ``pages`` as WARC archives and read them back: see the module."""
    found = records(read_chunks(write_archives(table(spark, sf_dir, "pages")), data=False))
    whole = F.when(F.col("intact"), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id")))
    return found.select("page_id", "payload_bytes", whole.cast("string").alias("payload_digest"), "record_type", "refers_to")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, CAST(d.payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
  CASE WHEN d.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN d.page_id > f.first THEN f.first END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)"""
