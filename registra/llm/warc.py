"""Deterministic sharded WARC writer and its reader.

Records are sorted by page id in shards with exact cut points; a task writes a shard as a row of .warc.gz
files, one gzip member a record, and begins a new file when the compressed size is reached.  Headers,
record ids and digests are made anew from the page, so equal input gives equal bytes.  Files get temporary
names and are moved to their final ones by a commit that writes the manifest last.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm import shards
from registra.llm.common import fresh_path, small_or_shuffled, written

#: Equal payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1_000
#: Least and most payload bytes of a shard, and compressed bytes at which a file is closed and the next begun.
LEAST_BYTES, MOST_BYTES, FILE_BYTES = 32 << 20, 2 << 30, 1 << 30
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's for URLs


def resolve(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, bytes, digest, refers_to): refers_to is null for responses.

    Of rows with equal payloads of ``least`` bytes or more, those with the largest page_id are responses, the
    others revisit it; without any page_id all are responses.  Only digests that occur twice are kept to look up.
    """
    payload = F.coalesce(F.col(f"`{body_col}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.unhex(F.sha1("payload")))
    long = rows.where(F.col("bytes") >= least).select("digest", "page_id")
    twice = long.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
    known = small_or_shuffled(written(twice.select("digest", "first"), "copies"))
    revisit = (F.col("bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(known, "digest", "left").select(
        "page_id", "url", "payload", "bytes", "digest", F.when(revisit, F.col("first")).alias("refers_to")
    )


def record_id(page_id: int | None, digest: bytes, nth: int = 0) -> str:
    """Of the nth row with this id and payload; references lead to the first."""
    return f"<{uuid.uuid5(_NAMESPACE, f'page:{page_id}:{digest.hex()}' + (f':{nth}' if nth else '')).urn}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(data).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A gzip member with one record."""
    lines = [*headers, ("WARC-Block-Digest", _sha1(hashlib.sha1(block).digest())), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, nth: int = 0) -> bytes:
    """The record of a page; a revisit has the HTTP headers alone, with the length of the full payload."""
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id, digest, nth)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", f"urn:page:{page_id}" if url is None else quote(url, safe="!#$&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", _sha1(digest)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return record(headers, http if refers_to is not None else http + payload)


class _File:
    """A file under a temporary name of its own."""

    def __init__(self, base: str, name: str):
        store, path = shards.file_system(base)
        store.create_dir(f"{path}/_temporary", recursive=True)
        self.name, self.temp, self.records, self.bytes, self.digest = name, f"_temporary/{name}.{uuid.uuid4().hex}", 0, 0, hashlib.sha256()
        self.out = store.open_output_stream(f"{path}/{self.temp}", compression=None)
        info = f"software: registra\r\nformat: WARC File Format 1.1\r\nfilename: {name}\r\n".encode()
        self.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid.uuid5(_NAMESPACE, name).urn}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], info))
        self.records = 0

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        return self.temp, self.name, self.records, self.bytes, self.digest.hexdigest()


def write_warc(
    pages: DataFrame, base: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", shard_bytes: int | None = None, file_bytes: int = FILE_BYTES
) -> None:
    """Write a record for each row, in ascending page id (nulls first), then digest of the payload and url.

    A null payload is empty, a null url is a URN of the page.  A payload of any length is one record, which a task holds
    whole.  Repeated rows are written each, with record ids of their own.  An empty
    table gives a manifest without files.  Columns other than the three are not read.
    """
    found = resolve(pages, id_col, url_col, body_col)
    sizes = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), (F.coalesce(F.octet_length(F.col(f"`{body_col}`").cast("string")), F.lit(0)) + 512).alias("weight")
    )
    shard_bytes = shard_bytes or shards.sized(sizes.agg(F.sum("weight")).first()[0] or 0, LEAST_BYTES, MOST_BYTES)
    cuts = shards.cut_points(sizes, "page_id", "weight", shard_bytes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = np.array([int.from_bytes(d.as_py()[:4], "big") for d in b.column(3)], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cuts.shard_of(b.column(0), hashes)), *b.columns], names=["shard", *b.schema.names])

    schema = pa.schema([("temp", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, shard, part = None, None, 0
        before, nth = None, 0
        for b in batches:
            for s, *page in zip(*b.columns, strict=True):
                s, page = s.as_py(), [v.as_py() for v in page]
                nth = nth + 1 if (page[0], page[3]) == before else 0
                before = page[0], page[3]
                if now is not None and (s != shard or now.bytes >= file_bytes):
                    part = part + 1 if s == shard else 0
                    yield now.close()
                    now = None
                if now is None:
                    now, shard = _File(base, f"pages-{s:06d}-{part:04d}.warc.gz"), s
                now.add(page_record(*page, nth))
        if now is not None:
            yield now.close()

    placed = found.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(
        place, "shard int, page_id long, url string, payload binary, digest binary, refers_to long"
    )
    dealt = placed.repartitionById(cuts.count, F.col("shard")).sortWithinPartitions("shard", F.asc_nulls_first("page_id"), "digest", "url")
    done = dealt.mapInArrow(lambda it: shards.batches_of(files(it), schema, 64), "temp string, name string, records long, bytes long, sha256 string").collect()
    store, folder = shards.file_system(base)
    store.create_dir(folder, recursive=True)
    shards.commit(pages.sparkSession, base, sorted((r.asDict() for r in done), key=lambda f: f["name"]))


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    with gzip.GzipFile(fileobj=stream) as f:
        while line := f.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record begins with {line[:40]!r}")
            headers = {}
            while (line := f.readline()).strip():
                k, _, v = line.decode().partition(":")
                headers[k.lower()] = v.strip()
            block = f.read(int(headers["content-length"]))
            if headers.get("warc-block-digest", "") not in ("", _sha1(hashlib.sha1(block).digest())):
                raise ValueError(f"{headers.get('warc-record-id')} differs from its digest")
            yield headers, block


def read_warc(spark: SparkSession, base: str) -> DataFrame:
    """(page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload) of the records of the manifest's files.

    The digest is bare lower-case hex; that of a response is taken from the payload itself.  The payload of a
    revisit is null.
    """
    kinds = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        store, folder = shards.file_system(base)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(f"{folder}/{name}", compression=None) as f:
                    for h, block in parse(f):
                        if h["warc-type"] not in ("response", "revisit"):
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        page, to = h.get("x-page-id"), h.get("x-refers-to-page")
                        if h["warc-type"] == "response":
                            size, digest = len(payload), hashlib.sha1(payload).hexdigest()
                        else:
                            size = int(http.lower().partition(b"content-length:")[2].split()[0])
                            digest, payload = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex(), None
                        url = h["warc-target-uri"]
                        url = None if url == f"urn:page:{page}" else unquote(url)
                        yield None if page is None else int(page), url, h["warc-type"], size, digest, None if to is None else int(to), payload

    return shards.file_rows(spark, shards.manifest(base), "name string").mapInArrow(lambda it: shards.batches_of(rows(it), schema, 256), kinds)


def round_trip(pages: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every row, from archives written and read back."""
    base = fresh_path(pages.sparkSession, "warc")
    write_warc(pages, base)
    return read_warc(pages.sparkSession, base).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
