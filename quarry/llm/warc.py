"""WARC archives with an index that is written first-class and read by range.

``write`` puts one gzip-compressed WARC/1.1 record per page into archive files
on shared storage and returns the index: file, offset, length, URL, payload
digest and record type of every record. ``read`` takes any rows of an index,
sorts them by file and offset, merges neighbouring ranges into reads of about
``READ_BYTES`` and parses the records found there.

Of the records with equal payloads of at least ``REVISIT_BYTES`` bytes, the
one with the largest page id holds the payload and the others are revisit
records that refer to it. File access goes through Arrow's file systems, so
the folder may be local shared storage or a store that Arrow knows by URI.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .spread import stage

REVISIT_BYTES = 1000
READ_BYTES = 4_000_000
GAP_BYTES = 64_000  # unwanted bytes that a merged read may skip over

INDEX = "page_key string, file string, offset long, length long, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def _clean(value: object) -> str:
    """A header value on one line."""
    return " ".join(str("" if value is None else value).split())


def record(page: str, url: str | None, payload: bytes, digest: str, kind: str, refers_to: str | None) -> bytes:
    """One gzip member that holds a WARC record. A revisit holds no payload."""
    body = b"" if kind == "revisit" else payload
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + body
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{_clean(page)}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{_clean(refers_to)}>"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}"]) + "\r\n\r\n"
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> dict:
    """Header fields (lower-case names) and payload of a gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    fields = {k.lower(): v for k, v in fields.items()}
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["payload"] = payload
    fields["http-length"] = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
    return fields


def _target(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _target(folder)
        name, out, at = f"{path}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = []
                for r in batch.slice(first, 256).to_pylist():
                    if out is None:  # each attempt of a task has a file of its own
                        out = store.open_output_stream(name, compression=None)
                    payload = (r["html"] or "").encode("utf-8", "surrogatepass")
                    kind = "revisit" if r["refers_to"] is not None else "response"
                    member = record(r["page_key"], r["url"], payload, r["digest"], kind, r["refers_to"])
                    out.write(member)
                    rows.append((r["page_key"], name, at, len(member), r["url"], len(payload), r["digest"], kind, r["refers_to"]))
                    at += len(member)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()])],
                        [x.split()[0] for x in INDEX.split(", ")])
        if out is not None:
            out.close()

    return run


def write(pages: DataFrame, folder: str, key: str = "page_id", source: str = "html", url: str = "url") -> DataFrame:
    """Write the archives and return their index.

    A null html is the empty payload. Repeated rows each have a record; those
    that repeat the id of the holder of a payload are responses like it. Rows
    with a null id are never referred to and, having no id to be compared, are
    always responses. An empty table writes no archive.
    """
    body = F.coalesce(F.col(source), F.lit(""))
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"), F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("bytes"))
    large = stage(rows.where((F.col("bytes") >= REVISIT_BYTES) & F.col("page_id").isNotNull()).select("page_id", "digest"), "digests")
    kept = large.groupBy("digest").agg(F.max("page_id").alias("holder"), F.min("page_id").alias("least")).where("least < holder").select("digest", "holder")
    kept = stage(kept, "holders")
    revisits = large.join(kept, "digest").where("page_id < holder").select("page_id", "digest", F.col("holder").cast("string").alias("refers_to")).distinct()
    marked = rows.join(stage(revisits, "revisits"), ["page_id", "digest"], "left")
    marked = marked.select(F.col("page_id").cast("string").alias("page_key"), "url", "html", "digest", "refers_to")
    return stage(marked.mapInArrow(_writer(folder), INDEX), "index")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Coalesce sorted (offset, length) ranges into reads (begin, end, ranges)."""
    out: list[list] = []
    for offset, length in ranges:
        if out and offset - out[-1][1] <= GAP_BYTES and offset + length - out[-1][0] <= READ_BYTES:
            out[-1][1] = max(out[-1][1], offset + length)
            out[-1][2].append((offset, length))
        else:
            out.append([offset, offset + length, [(offset, length)]])
    return [tuple(x) for x in out]


RECORDS = "file string, offset long, page_key string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string, intact boolean"


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = _target(folder)
        name, source = None, None
        for batch in batches:
            for file in dict.fromkeys(files := batch.column("file").to_pylist()):
                own = [(o, n) for f, o, n in zip(files, batch.column("offset").to_pylist(), batch.column("length").to_pylist()) if f == file]
                if file != name:
                    name, source = file, store.open_input_file(file)
                for begin, end, parts in merged(sorted(own)):
                    source.seek(begin)
                    data = memoryview(source.read(end - begin))
                    rows = []
                    for offset, length in parts:
                        r = parse(bytes(data[offset - begin:offset - begin + length]))
                        kind, digest = r["warc-type"], r["warc-payload-digest"].removeprefix("sha1:")
                        intact = kind == "revisit" or hashlib.sha1(r["payload"]).hexdigest() == digest and len(r["payload"]) == r["http-length"]
                        refers = r.get("warc-refers-to")
                        rows.append((file, offset, r["warc-record-id"][10:-1], r["warc-target-uri"], r["payload"] if kind == "response" else None,
                                     r["http-length"], digest, kind, refers and refers[10:-1], intact))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), [pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()])],
                        [x.split()[0] for x in RECORDS.split(", ")])

    return run


def read(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of an index point to, with their payloads
    (null for revisits) and whether digest and length agree with the payload.
    Rows of a null id come back with an empty page_key."""
    asked = index.select("file", "offset", "length")
    tasks = index.sparkSession.sparkContext.defaultParallelism
    dealt = asked.repartitionByRange(max(tasks, 1) * 4, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(_reader(folder), RECORDS)


def archive_folder(spark) -> str:
    """A new folder for archives on the shared checkpoint storage."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quarry-warc/{uuid.uuid4().hex}"
    store, path = _target(folder)
    store.create_dir(path, recursive=True)
    return folder
