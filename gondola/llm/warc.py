"""WARC archives: written by Spark tasks, read back sequentially.

An archive is a run of gzip members, one per record. The reader inflates step by step,
frames a record by its Content-Length, and checks the block and payload digests, so it
holds no more than one record and one piece of the file.

A task writes each archive under a name of its own and reports it as a row. Only the
reported archives of the attempt that succeeded are read; what a lost attempt
leaves behind is in no list.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from ..session import shared_dir
from .common import pick, position, saved, small

#: Smallest payload that is stored once for all records that have it.
LEAST_SHARED = 1000
#: An archive is closed once it has so many bytes.
ARCHIVE_BYTES = 64 << 20
#: Bytes of a file read at a time, and bytes inflated at a time.
PIECE = 1 << 16
DATE = "2000-01-01T00:00:00Z"
VERSION = b"WARC/1.1"
HTTP_TYPE = "application/http; msgtype=response"


class Record(NamedTuple):
    """``digest`` is measured on the payload that was read; ``payload_ok`` is null for a revisit,
    which leaves its payload out."""
    headers: dict[str, str]
    payload: bytes
    digest: str
    block_ok: bool
    payload_ok: bool | None


def _line(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def _sha1(data: bytes) -> str:
    return hashlib.sha1(data).hexdigest()


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def record_bytes(key: str, uri: str | None, payload: bytes, refers_to: str | None, digest: str,
                 length: int, date: str = DATE) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header only, and names its
    response's key, the digest and the length of the payload that it leaves out."""
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             + f"Content-Length: {length}\r\n\r\n".encode()
             + (payload if refers_to is None else b""))
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(key)), ("WARC-Date", date), ("WARC-Target-URI", _line(uri)),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{_sha1(block)}"),
        ("X-Page-ID", key), ("X-Payload-Length", str(length))]
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                    ("WARC-Refers-To", record_id(refers_to)), ("X-Refers-To-Page-ID", refers_to)]
    headers += [("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in headers) + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


class _Members:
    """The inflated bytes of a run of gzip members, a piece at a time."""

    def __init__(self, source: BinaryIO):
        self.source, self.raw, self.out = source, b"", bytearray()
        self.inflater = zlib.decompressobj(31)

    def _more(self) -> bool:
        """Inflate a piece of the current member; false at its end."""
        if self.inflater.eof:
            return False
        if not self.inflater.unconsumed_tail and not self.raw:
            self.raw = self.source.read(PIECE)
            if not self.raw:
                raise ValueError("the archive ends within a record")
        data, self.raw = self.inflater.unconsumed_tail + self.raw, b""
        self.out += self.inflater.decompress(data, PIECE)
        return True

    def next_member(self) -> bool:
        """Go to the next member; false at the end of the archive."""
        if self.inflater.eof:
            self.raw = self.inflater.unused_data + self.raw
            self.inflater = zlib.decompressobj(31)
        if not self.raw:
            self.raw = self.source.read(PIECE)
        return bool(self.raw)

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with ``mark``."""
        at, start = self.out.find(mark), 0
        while at < 0:
            start = max(0, len(self.out) - len(mark))
            if not self._more():
                raise ValueError("a record's header does not end")
            at = self.out.find(mark, start)
        return self._take(at + len(mark))

    def exactly(self, n: int) -> bytes:
        while len(self.out) < n:
            if not self._more():
                raise ValueError("a record is shorter than its Content-Length")
        return self._take(n)

    def rest(self) -> bytes:
        while self._more():
            pass
        return self._take(len(self.out))

    def _take(self, n: int) -> bytes:
        taken = bytes(self.out[:n])
        del self.out[:n]
        return taken


def _headers(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name."""
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != VERSION.decode():
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _same(stated: str | None, data: bytes) -> bool:
    return stated is None or stated.lower() == f"sha1:{_sha1(data)}"


def read_records(source: BinaryIO) -> Iterator[Record]:
    """All records of an archive in order. Broken framing raises ``ValueError``."""
    members = _Members(source)
    while members.next_member():
        headers = _headers(members.until(b"\r\n\r\n"))
        block = members.exactly(int(headers["content-length"]))
        if members.rest() != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        _, _, payload = block.partition(b"\r\n\r\n")
        digest = _sha1(payload)
        stated = (headers.get("warc-payload-digest", f"sha1:{digest}").lower(),
                  headers.get("x-payload-length", str(len(payload))))
        whole = headers["warc-type"] != "revisit"
        yield Record(headers, payload, digest, _same(headers.get("warc-block-digest"), block),
                     stated == (f"sha1:{digest}", str(len(payload))) if whole else None)


def _write(folder: str, archive_bytes: int):
    """Arrow function: write records to archives in ``folder``, report the archives."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        files.create_dir(path, recursive=True)
        out, name, size, records, done = None, "", 0, 0, []
        for batch in batches:
            for key, uri, html, digest, length, refers_to in zip(
                    *(batch.column(k) for k in range(6))):
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, records = files.open_output_stream(
                        f"{path}/{name}", compression=None), 0, 0
                member = record_bytes(
                    key.as_py(), uri.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass"),
                    refers_to.as_py(), digest.as_py(), length.as_py())
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, records))
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{d[0]}" for d in done])]
                + [pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)],
                names=["archive", "n_bytes", "n_records"])

    return write


def write_warc(pages: DataFrame, folder: str | None = None, page_id: str = "page_id",
               url: str = "url", html: str = "html", least_shared: int = LEAST_SHARED,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row; returns the archives as ``archive, n_bytes, n_records``.

    The payload is the html in UTF-8, empty for null. Of rows with equal payloads of at
    least ``least_shared`` bytes the one with the largest id is a response, others
    revisit it. Rows that repeat with that same id are responses each. A null id is
    smaller than any other and written as an empty key.
    """
    spark = pages.sparkSession
    folder = folder or shared_dir(spark)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pick(pages, page_id=page_id, url=url, html=html).select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("key"), "page_id", "url",
        "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("length"))
    owners = (rows.filter(F.col("length") >= least_shared).groupBy("digest")
              .agg(F.max("page_id").alias("owner"), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("digest", "owner"))
    refers = F.when((F.col("length") >= least_shared) & F.col("owner").isNotNull()
                    & ~F.col("page_id").eqNullSafe(F.col("owner")), F.col("owner").cast("string"))
    records = rows.join(owners, "digest", "left").select(
        "key", "url", F.when(refers.isNull(), F.col("html")).alias("html"), "digest", "length",
        refers.alias("refers_to"))
    if "://" not in folder:
        folder = f"file://{os.path.abspath(folder)}"
    return saved(records.mapInArrow(_write(folder, archive_bytes),
                                    "archive string, n_bytes bigint, n_records bigint"))


def _read(with_payload: bool, strict: bool):
    """Arrow function: the records of archives; ``strict`` raises on a wrong digest or length."""
    fields = [("warc_type", pa.string()), ("page_id", pa.string()), ("url", pa.string()),
              ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("refers_to", pa.string()), ("block_ok", pa.bool_()), ("payload_ok", pa.bool_()),
              ("payload", pa.binary())]

    def row(r: Record) -> tuple:
        h, whole = r.headers, r.headers["warc-type"] != "revisit"
        if strict and not (r.block_ok and r.payload_ok is not False):
            raise ValueError(f"record {h['warc-record-id']} isn't what its digests say")
        # A response is measured; a revisit only states what its response has.
        return (h["warc-type"], h["x-page-id"], h["warc-target-uri"],
                len(r.payload) if whole else int(h["x-payload-length"]),
                r.digest if whole else h["warc-payload-digest"].partition(":")[2].lower(),
                h.get("x-refers-to-page-id"), r.block_ok, r.payload_ok,
                r.payload if with_payload and whole else None)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)],
            names=[n for n, _ in fields])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                files, path = fs.FileSystem.from_uri(archive)
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as source:
                    for r in read_records(source):
                        rows.append(row(r))
                        held += len(r.payload) if with_payload else 256
                        if held >= 1 << 24 or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return read


def read_warc(archives: DataFrame, with_payload: bool = True, strict: bool = True) -> DataFrame:
    """The records of the archives whose paths are in ``archive``.

    ``warc_type, page_id, url, payload_bytes, payload_digest, refers_to, block_ok,
    payload_ok, payload``; ids are texts, a revisit has no payload. Length and digest of a
    response are those of the payload read. A record that isn't what it states raises, unless
    ``strict`` is off: then ``block_ok`` and ``payload_ok`` tell. One archive is one task's
    sequential read.
    """
    names = pick(archives, archive="archive")
    spread = names.repartition(max(1, min(10_000, names.count())), "archive")
    return spread.mapInArrow(_read(with_payload, strict), (
        "warc_type string, page_id string, url string, payload_bytes bigint, "
        "payload_digest string, refers_to string, block_ok boolean, payload_ok boolean, "
        "payload binary"))


def warc_round_trip(pages: DataFrame, folder: str | None = None, page_id: str = "page_id",
                    url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, verified`` of every
    page, as read back from the archives it was written to.

    Length and digest of a response are measured on what was read, those of a revisit come from
    the response that it refers to. A damaged record, or a revisit whose response isn't there
    with that digest, raises, so ``verified`` is true in every row that comes back. Null
    html has an empty payload; null and repeated ids keep their rows. An empty table
    writes no archive and gives an empty result.
    """
    kind = pages.schema.fields[position(pages, page_id)].dataType
    found = saved(read_warc(write_warc(pages, folder, page_id, url, html), with_payload=False)
                  .drop("payload"))
    return with_responses(found).select(
        F.when(F.col("page_id") != "", F.col("page_id")).cast(kind).alias("page_id"),
        "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"), F.lit(True).alias("verified"))


def with_responses(found: DataFrame) -> DataFrame:
    """Records with the measured length of their response in every revisit.

    A revisit whose response isn't there, or has another payload, raises.
    """
    whole = found.filter("warc_type <> 'revisit'")
    there = whole.groupBy(F.col("page_id").alias("_key"), F.col("payload_digest").alias("_digest")
                          ).agg(F.max("payload_bytes").alias("_bytes"))
    revisits = found.filter("warc_type = 'revisit'").join(small(there), (
        (F.col("refers_to") == F.col("_key")) & (F.col("payload_digest") == F.col("_digest"))), "left")
    lost = F.raise_error(F.concat(F.lit("no such response: "), F.col("refers_to"), F.lit(" "),
                                  F.col("payload_digest"))).cast("bigint")
    measured = F.when(F.col("_bytes").isNull(), lost).otherwise(F.col("_bytes"))
    return whole.unionByName(revisits.withColumn("payload_bytes", measured)
                             .drop("_key", "_digest", "_bytes"))


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS owner FROM p WHERE payload_bytes >= 1000
      GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN owner IS NULL OR owner = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN owner <> page_id THEN owner END AS refers_to, true AS verified
FROM p LEFT JOIN o USING (payload_digest)
"""
