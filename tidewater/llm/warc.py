"""WARC archives written from, and read back as, a chunked record table.

``write_archives`` turns a table of records into chunk rows (record columns,
chunk number, at most ``chunk_bytes`` of payload) inside the JVM and streams them
into WARC/1.1 files, one gzip member per record, checking the payload's SHA-1 on
the way.  Each file is written by one task under a name that no other attempt
uses, and listed in a manifest that Spark commits, so files of lost or repeated
attempts are never read.  ``read_chunks`` streams listed archives back as rows of
(archive, offset, record header fields, chunk_no, chunk, bytes_so_far,
sha1_so_far, last): each row carries the running digest, and no record is held whole.

Files are reached through pyarrow's file systems (local or mounted folders, S3,
GCS, HDFS), by the scheme of the cluster's shared folder.

Defined results: a null payload is empty; a null url is an empty target; records
of equal payload and the smallest id are responses, all others revisit it (a null
id is never the smallest unless there is no other); repeated rows give repeated records.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import fresh_path, stored

HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MANIFEST = "archive string, records long, bytes long"
CHUNKS = ("archive string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
          "payload_digest string, chunk_no long, chunk binary, bytes_so_far long, sha1_so_far string, last boolean")
ID_PREFIX = "urn:x-record:"


def base32_sha1(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def plan_records(pages: DataFrame, id_col: str, payload_col: str, url_col: str) -> DataFrame:
    """Each row with its payload bytes, their digest, and what it refers to (null: a response)."""
    rows = pages.select(F.col(id_col).alias("id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"),
                        F.coalesce(F.encode(F.col(payload_col), "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    first = rows.groupBy("sha1").agg(F.min("id").alias("first_id"))
    return (rows.join(first, "sha1")
            .withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("first_id")), F.col("first_id").cast("string")))
            .drop("first_id"))


def chunk_rows(records: DataFrame, chunk_bytes: int) -> DataFrame:
    """One row per chunk, a record's chunks together and in order; a revisit has one empty
    chunk.  The payload is cut before its pieces become rows, so no row holds it whole."""
    last = F.greatest(F.ceil(F.octet_length("payload") / chunk_bytes) - 1, F.lit(0)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring("payload", k * chunk_bytes + 1, F.lit(chunk_bytes)))
    cut = F.when(F.col("refers_to").isNull(), pieces).otherwise(F.array(F.lit(b"")))
    return records.select(F.col("id").cast("string").alias("id"), "url", "sha1", "refers_to",
                          F.octet_length("payload").cast("long").alias("n_bytes"), F.posexplode(cut).alias("chunk_no", "chunk"))


def _header(row: dict, date: str) -> bytes:
    revisit = row["refers_to"] is not None
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: "%%%02X" % ord(m[0]), row["url"])
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<{ID_PREFIX}{row['id'] if row['id'] is not None else ''}>"),
              ("WARC-Date", date), ("WARC-Target-URI", uri),
              ("WARC-Payload-Digest", "sha1:" + base32_sha1(row["sha1"]))]
    if revisit:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{row['refers_to']}>"),
                   ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"),
               ("Content-Length", str(len(HTTP_HEAD) + (0 if revisit else row["n_bytes"])))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


class ArchiveWriter:
    """Streams chunk rows into archives of about ``target_bytes`` each."""

    def __init__(self, folder: str, target_bytes: int, date: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.uri, self.target, self.date = folder, target_bytes, date
        self.out = self.name = None
        self.size = self.records = 0

    def close(self):
        if self.out is None:
            return []
        self.out.close()
        self.out = None
        return [(self.name, self.records, self.size)]

    def add(self, row: dict):
        """Returns the manifest rows of archives that this row completed."""
        done = []
        if row["chunk_no"] == 0:
            if self.out is not None and self.size >= self.target:
                done = self.close()
            if self.out is None:
                file = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
                self.name, self.size, self.records = f"{self.uri.rstrip('/')}/{file}", 0, 0
                self.out = self.fs.open_output_stream(posixpath.join(self.folder, file))
            self.zip = zlib.compressobj(6, zlib.DEFLATED, 31)
            self.sha1, self.left = hashlib.sha1(), 0 if row["refers_to"] is not None else row["n_bytes"]
            self.records += 1
            self._write(self.zip.compress(_header(row, self.date) + HTTP_HEAD))
        self.sha1.update(row["chunk"])
        self.left -= len(row["chunk"])
        self._write(self.zip.compress(row["chunk"]))
        if self.left == 0:
            if row["refers_to"] is None and self.sha1.hexdigest() != row["sha1"]:
                raise ValueError(f"payload of record {row['id']} changed while it was written")
            self._write(self.zip.compress(b"\r\n\r\n") + self.zip.flush())
        return done

    def _write(self, data: bytes):
        if data:
            self.out.write(data)
            self.size += len(data)


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str = "url", chunk_bytes: int = 1 << 20, target_bytes: int = 1 << 30,
                   date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write WARC archives; returns their manifest (archive, records, bytes) as a stored table."""
    spark = pages.sparkSession
    ensure_checkpoint_dir(spark)
    folder = folder or fresh_path(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = "file://" + folder
    fs, root = pafs.FileSystem.from_uri(folder)
    fs.create_dir(root, recursive=True)

    def run(batches):
        writer, done = ArchiveWriter(folder, target_bytes, date), []
        for batch in batches:
            for at in range(0, len(batch), 64):
                for row in batch.slice(at, 64).to_pylist():
                    done += writer.add(row)
        done += writer.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["archive", "records", "bytes"])

    chunks = chunk_rows(plan_records(pages, id_col, payload_col, url_col), chunk_bytes)
    return stored(chunks.mapInArrow(run, MANIFEST), "warc_manifest")


class _Inflate:
    """Reads a file of gzip members forward in bounded pieces."""

    def __init__(self, stream, piece: int = 1 << 18):
        self.stream, self.piece = stream, piece
        self.z, self.raw, self.buf, self.start, self.read_bytes = None, b"", bytearray(), 0, 0

    def _more(self) -> bool:
        """Some more bytes of the current member; False at its end."""
        while True:
            if self.z.eof:
                return False
            if not self.raw:
                self.raw = self.stream.read(self.piece)
                self.read_bytes += len(self.raw)
                if not self.raw:
                    raise EOFError("archive ends inside a record")
            data = self.z.decompress(self.raw, self.piece)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if data:
                self.buf += data
                return True

    def next_member(self) -> bool:
        if not self.raw:
            self.raw = self.stream.read(self.piece)
            self.read_bytes += len(self.raw)
        if not self.raw:
            return False
        self.start = self.read_bytes - len(self.raw)
        self.z, self.buf = zlib.decompressobj(31), bytearray()
        return True

    def until(self, mark: bytes) -> bytes:
        at = 0
        while (found := self.buf.find(mark, max(0, at - len(mark)))) < 0:
            at = len(self.buf)
            if not self._more():
                raise ValueError("record header without an end")
        out = bytes(self.buf[:found])
        del self.buf[:found + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buf) < n and self._more():
            pass
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out

    def finish(self):
        while self._more():
            self.buf.clear()


def _fields(head: bytes) -> dict:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def archive_chunks(uri: str, chunk_bytes: int):
    """The chunk rows of one archive, in order, from a forward-only read."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path) as stream:
        z = _Inflate(stream)
        while z.next_member():
            h = _fields(z.until(b"\r\n\r\n"))
            left = int(h["content-length"])
            if h.get("content-type", "").startswith("application/http"):
                left -= len(z.until(b"\r\n\r\n")) + 4
            record = (uri, z.start, h["warc-record-id"].strip("<>"), h["warc-type"], h.get("warc-target-uri"),
                      h.get("warc-refers-to", "").strip("<>") or None, h.get("warc-payload-digest", "").partition(":")[2] or None)
            sha1, done, n = hashlib.sha1(), 0, 0
            while True:
                chunk = z.take(min(chunk_bytes, left))
                if left and not chunk:
                    raise EOFError(f"{uri}: record at {z.start} is cut short")
                left -= len(chunk)
                done += len(chunk)
                sha1.update(chunk)
                yield (*record, n, chunk, done, base64.b32encode(sha1.digest()).decode(), left == 0)
                n += 1
                if left == 0:
                    break
            z.finish()


def read_chunks(spark: SparkSession, manifest: DataFrame, chunk_bytes: int = 1 << 20) -> DataFrame:
    """The chunked record table of the archives listed in ``manifest``, one task per archive."""
    names = [c.split()[0] for c in CHUNKS.split(", ")]

    def run(batches):
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                rows, size = [], 0
                for row in archive_chunks(uri, chunk_bytes):
                    rows.append(row)
                    size += len(row[8]) + 400
                    if size > 4 << 20:
                        yield _batch(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    archives = manifest.select("archive")
    return archives.repartition(max(1, archives.count()), "archive").mapInArrow(run, CHUNKS)


def _batch(rows, names):
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
             pa.binary(), pa.int64(), pa.string(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def records(chunks: DataFrame, id_type: str = "long") -> DataFrame:
    """One row per record from the last chunk's running totals; a revisit takes size
    and digest from the response that it refers to."""
    own_id = F.substring(F.col("record_id"), len(ID_PREFIX) + 1, 1 << 20)
    ref_id = F.substring(F.col("refers_to"), len(ID_PREFIX) + 1, 1 << 20)
    ends = chunks.filter("last").select(
        F.when(own_id != "", own_id).cast(id_type).alias("id"), ref_id.cast(id_type).alias("refers_to"),
        "record_type", "target_uri", "payload_digest", F.col("bytes_so_far").alias("n"), F.col("sha1_so_far").alias("sha1"))
    ends = stored(ends, "warc_records")
    responses = (ends.filter("record_type = 'response'").groupBy(F.col("id").alias("refers_to"), F.col("sha1").alias("payload_digest"))
                 .agg(F.max("n").alias("n_there")))
    own = ends.filter("record_type <> 'revisit'").select("id", "target_uri", F.col("n").alias("payload_bytes"),
                                                         F.col("sha1").alias("payload_digest"), "record_type", "refers_to")
    revisits = (ends.filter("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
                .select("id", "target_uri", F.col("n_there").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
    return own.unionByName(revisits)
