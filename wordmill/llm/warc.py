"""A deterministic sharded WARC writer and its reader (operator 4).

Records are sorted by page id and payload digest and cut into shards at keys
that a hash of the two picks (one in M, M from the measured volume), so the
shards depend on the data alone: not on the number of executors, the split of
the input or a retried task, and an id with many payloads is cut as well. A
shard is a partition of its own, written by one task in order and rolled into
files by compressed size. Headers, ids and digests are made anew from the payload.

Every task attempt writes under a temporary name of its own. The manifest of
finished files is a table that Spark commits, so it names the files of
successful attempts only; these are then renamed (a second, idempotent pass),
and only after that the final manifest appears. Readers go by the manifest.

Files go through ``pyarrow.fs``, so the target may be a local or shared
folder, or an object store or HDFS that it can open; a path without a scheme
means the session's default file system, as it does for Spark.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlparse

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..store import Store
from .common import frozen, text_or_empty

#: A payload of at least so many bytes that equals another's becomes a revisit.
MIN_REVISIT_BYTES = 1000
#: A file is closed when it has this many compressed bytes.
ROLL_BYTES = 32 << 20
#: Payload bytes of a shard on average, and how many shards there are at most
#: (about): from some 3 TB on shards grow instead, files are rolled as before.
SHARD_BYTES = 32 << 20
MAX_SHARDS = 100_000
#: Archives carry this date unless the caller gives one, so equal pages make equal files.
DATE = "1970-01-01T00:00:00Z"
_READ_BATCH_BYTES = 4 << 20
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = "shard int, part int, temp string, name string, n_records long, n_bytes long, sha1 string"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    if urlparse(path).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(path).path
    return pafs.FileSystem.from_uri(path)


# -- records ---------------------------------------------------------------

def _base32(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def record_id(page_id, digest: str) -> str:
    """A record's id, made from the page id and the payload's hex digest."""
    return f"<urn:uuid:{uuid.UUID(hashlib.md5(f'{page_id}|{digest}'.encode()).hexdigest())}>"


def _head(lines: list[tuple]) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v is not None) + "\r\n").encode()


def _record(page_id, url, date: str, digest: bytes, payload: bytes | None, n_bytes: int, refers_to=None) -> bytes:
    """A record as one gzip member: a response, or without payload a revisit."""
    block = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {n_bytes}\r\n\r\n").encode() + (payload or b"")
    revisit = payload is None
    uri = quote(url, safe=":/?#[]@!$&'()*+,;=%") if url is not None else f"urn:page:{page_id}"
    head = _head([
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Target-URI", uri), ("WARC-Date", date),
        ("WARC-Record-ID", record_id(page_id, digest.hex() + ("r" if revisit else ""))),
        ("WARC-Refers-To", record_id(refers_to, digest.hex()) if revisit else None),
        ("WARC-Profile", _REVISIT_PROFILE if revisit else None),
        ("WARC-Payload-Digest", _base32(digest)),
        ("WARC-Block-Digest", _base32(hashlib.sha1(block).digest())),
        ("X-Page-Id", page_id), ("X-Refers-To-Page-Id", refers_to),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))])
    return _member(head + block + b"\r\n\r\n")


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # its header holds no time and no name
    return packer.compress(data) + packer.flush()


class _Roll:
    """The files of one shard, written by one task attempt."""

    def __init__(self, target: str, attempt: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.root = open_store(target)
        self.attempt, self.shard, self.roll_bytes, self.date = attempt, shard, roll_bytes, date
        self.part = -1
        self.out = None
        self.done: list[tuple] = []

    def add(self, member: bytes) -> None:
        if self.out is None:
            self.part += 1
            self.name = f"shard-{self.shard:06d}-{self.part:05d}.warc.gz"
            self.temp = f"_temporary/{self.attempt}/{self.name}"
            self.fs.create_dir(f"{self.root}/_temporary/{self.attempt}", recursive=True)
            self.out = self.fs.open_output_stream(f"{self.root}/{self.temp}", compression=None)
            self.sha1, self.size, self.records = hashlib.sha1(), 0, 0
            info = f"format: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
            self._write(_member(_head([
                ("WARC-Type", "warcinfo"), ("WARC-Date", self.date),
                ("WARC-Record-ID", record_id(self.name, "info")), ("WARC-Filename", self.name),
                ("Content-Type", "application/warc-fields"), ("Content-Length", len(info))])
                + info + b"\r\n\r\n"))
        self._write(member)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.sha1.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.shard, self.part, self.temp, self.name, self.records, self.size,
                              self.sha1.hexdigest()))
            self.out = None


def _batch(rows: list[tuple], types: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return _batch(rows, types, [f.split()[0] for f in _FIELDS.split(", ")])


# -- writer ----------------------------------------------------------------

def revisits(meta: DataFrame, min_bytes: int) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages that revisit another: among
    equal payloads of at least ``min_bytes`` the largest page id is the response."""
    same = ["digest", "n_bytes"]
    first = frozen(meta.where(F.col("n_bytes") >= min_bytes).groupBy(*same)
                   .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    # Written first, so that a payload with very many copies is a splittable join key.
    return (meta.join(first, same).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to").distinct())


def _shard_key(page_id: int | None, digest: str) -> tuple:
    """Sorts as the records do: null ids first."""
    return (page_id is not None, page_id or 0, digest)


def write_warc(pages: DataFrame, target: str, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", min_revisit_bytes: int = MIN_REVISIT_BYTES,
               roll_bytes: int = ROLL_BYTES, shard_bytes: int = SHARD_BYTES, date: str = DATE) -> DataFrame:
    """Write one record per row under ``target`` and return the manifest
    (``shard, part, name, n_records, n_bytes, sha1``).

    The payload is the HTML in UTF-8 (null: empty). Rows with a null id come
    first, never are revisited and revisit the largest id of their payload; a
    null URL becomes ``urn:page:<id>``. Rows that repeat an id and a payload
    are all of the same type. An empty table gives an empty manifest; other
    columns are ignored. ``target`` must be new or hold only an earlier result
    of the same table.
    """
    spark = pages.sparkSession
    target = Store(spark, target).qualified(target)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        text_or_empty(html_col).alias("html"))
    meta = frozen(rows.select("page_id", F.sha1(F.col("html").cast("binary")).alias("digest"),
                              F.octet_length("html").cast("long").alias("n_bytes")))

    # One in M keys starts a shard, so there are about as many starts as shards:
    # a short list whatever the corpus holds.
    n, volume = meta.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    every = max(1, n * max(shard_bytes, volume // MAX_SHARDS) // max(1, volume))
    starts = sorted(_shard_key(r.page_id, r.digest) for r in
                    meta.where(F.pmod(F.xxhash64("page_id", "digest"), F.lit(every)) == 0)
                    .select("page_id", "digest").distinct().collect())

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series, digests: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(starts, _shard_key(None if pd.isna(i) else int(i), d))
                          for i, d in zip(ids.astype("Int64"), digests)], dtype="int32")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for page_id, url, html in zip(*(c for c in batch.columns)):
                page_id, url, payload = page_id.as_py(), url.as_py(), html.as_py().encode()
                sha1 = hashlib.sha1(payload)
                rows.append((page_id, url, sha1.hexdigest(), len(payload),
                             _record(page_id, url, date, sha1.digest(), payload, len(payload))))
                held += len(rows[-1][-1]) + 200
                if held > _READ_BATCH_BYTES:
                    yield _batch(rows, member_types, member_names)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, member_types, member_names)

    member_names = ["page_id", "url", "digest", "n_bytes", "member"]
    member_types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    members = rows.mapInArrow(compress, "page_id long, url string, digest string, n_bytes long, member binary")

    # Records are compressed where the pages are read, so only compressed bytes
    # are shuffled, once. What is known of a revisit travels as a row of its
    # own, sorted just before the page's records, so no payload is joined.
    known = revisits(meta, min_revisit_bytes).select(
        "page_id", F.lit(None).cast("string").alias("url"), "digest", F.lit(None).cast("long").alias("n_bytes"),
        F.lit(None).cast("binary").alias("member"), "refers_to")
    both = (members.withColumn("refers_to", F.lit(None).cast("long")).unionByName(known)
            .withColumn("shard", shard_of("page_id", "digest"))
            .repartitionById(len(starts) + 1, F.col("shard"))
            .sortWithinPartitions("shard", "page_id", "digest", F.col("member").isNotNull(), "url"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, roll, last = uuid.uuid4().hex, None, (None, None, None)
        for batch in batches:
            for shard, page_id, url, digest, n_bytes, member, refers_to in zip(*batch.to_pydict().values()):
                if member is None:
                    last = (page_id, digest, refers_to)
                    continue
                if roll is None or roll.shard != shard:
                    if roll is not None:
                        roll.close()
                        if roll.done:
                            yield _manifest_batch(roll.done)
                    roll = _Roll(target, attempt, shard, roll_bytes, date)
                if last[:2] == (page_id, digest):
                    member = _record(page_id, url, date, bytes.fromhex(digest), None, n_bytes, last[2])
                roll.add(member)
        if roll is not None:
            roll.close()
            if roll.done:
                yield _manifest_batch(roll.done)

    attempts, final = f"{target}/_attempts", f"{target}/manifest"
    (both.select("shard", "page_id", "url", "digest", "n_bytes", "member", "refers_to")
     .mapInArrow(write, _FIELDS).write.mode("overwrite").parquet(attempts))

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(target)
        for batch in batches:
            for temp, name, size in zip(*(batch.column(c).to_pylist() for c in ("temp", "name", "n_bytes"))):
                there = fs.get_file_info([f"{root}/{temp}", f"{root}/{name}"])
                if there[0].type == pafs.FileType.File:
                    fs.move(f"{root}/{temp}", f"{root}/{name}")
                elif there[1].size != size:  # neither to be renamed nor renamed before
                    raise FileNotFoundError(f"{root}/{name}")
            yield batch

    schema = both.sparkSession.read.parquet(attempts)
    (schema.mapInArrow(rename, _FIELDS).drop("temp").write.mode("overwrite").parquet(final))
    fs, root = open_store(target)
    if fs.get_file_info(f"{root}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{root}/_temporary")
    return spark.read.parquet(final)


# -- reader ----------------------------------------------------------------

def _records(stream) -> Iterator[tuple[dict, bytes]]:
    """Headers (names in lower case) and block of each record."""
    with gzip.GzipFile(fileobj=stream) as lines:
        while line := lines.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not a record: {line[:40]!r}")
            head = {}
            while (line := lines.readline()).strip():
                name, _, value = line.decode().partition(":")
                head[name.strip().lower()] = value.strip()
            yield head, lines.read(int(head["content-length"]))


def _page(head: dict, block: bytes) -> tuple:
    """The page of a response or revisit record; a response's payload is
    digested again and must agree with its header."""
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = head["warc-type"] == "revisit"
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:"))
    if not revisit and (len(payload) != length or hashlib.sha1(payload).digest() != digest):
        raise ValueError(f"damaged record {head['warc-record-id']}")
    number = lambda name: int(head[name]) if name in head and head[name] != "None" else None
    return (number("x-page-id"), head["warc-target-uri"], None if revisit else payload, length, digest.hex(),
            head["warc-type"], number("x-refers-to-page-id"))


def read_warc(spark: SparkSession, target: str) -> DataFrame:
    """One row per page record of the manifest's files: ``page_id, url,
    payload, payload_bytes, payload_digest, record_type, refers_to`` (a
    revisit has no payload of its own; its length and digest are the
    payload's). Each file is streamed by one task."""
    target = Store(spark, target).qualified(target)
    manifest = spark.read.parquet(f"{target}/manifest").select("name")
    files = max(1, manifest.count())
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_store(target)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for head, block in _records(stream):
                        if head["warc-type"] not in ("response", "revisit"):
                            continue
                        rows.append(_page(head, block))
                        held += len(block) + 500
                        if held > _READ_BATCH_BYTES:
                            yield _batch(rows, types, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, types, names)

    return manifest.repartition(files, "name").mapInArrow(
        read, "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long")
