"""WARC: round trip, determinism, rolling, lost attempts."""

from __future__ import annotations

import gzip
import hashlib
import io
import os

import pytest

from tests.llm.helpers import SF, files_under
from wordmill.llm import warc

BIG = "<p>é" * 400
ROWS = [(1, "http://a/1", BIG), (2, "http://a/2 x", BIG), (3, None, BIG), (None, "http://a/n", BIG),
        (4, "http://a/4", None), (5, "http://a/5", ""), (6, "u", "short"), (7, "u", "short"),
        (7, "u", "short"), (8, "u\r\nX: y", "x" * 999), (9, "u", "x" * 999), (10, "u", "x" * 1000),
        (11, "u", "x" * 1000), (11, "u", "x" * 1000), (12, "u", "WARC/1.1\r\n\r\n" * 9000)]
SCHEMA = "page_id long, url string, html string, shard string, digest string, refers_to string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)


def want(rows):
    out = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        revisit = len(data) >= 1000 and page_id != max(same)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    max(same) if revisit else None))
    return sorted(map(str, out))


def read(spark, target):
    return sorted(str(tuple(r)) for r in warc.read_warc(spark, target).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


def test_hard_rows_round_trip(spark, scratch):
    warc.write_warc(frame(spark, ROWS), scratch, shard_bytes=2000, roll_bytes=300)
    assert read(spark, scratch) == want(ROWS)
    payloads = {r.page_id: r.payload for r in warc.read_warc(spark, scratch).where("record_type = 'response'").collect()}
    assert payloads[12] == ROWS[-1][2].encode() and payloads[3] == BIG.encode()
    assert not os.path.exists(f"{scratch}/_temporary")
    names = [r.name for r in spark.read.parquet(f"{scratch}/manifest").collect()]
    assert len(names) > 3
    assert sorted(names) == sorted(f for f in os.listdir(scratch) if f.endswith(".warc.gz"))


def test_empty_table(spark, scratch):
    assert warc.write_warc(frame(spark, []), scratch).collect() == []
    assert read(spark, scratch) == []


def test_one_id_with_many_pages_is_cut(spark, tmp_path):
    rows = [(i, "u", f"{k} " + "y" * 3000) for i in (None, 7) for k in range(40)] + [(9, "u", "z" * 3000)]
    manifest = warc.write_warc(frame(spark, rows), str(tmp_path / "w"), shard_bytes=10_000).collect()
    assert read(spark, str(tmp_path / "w")) == want(rows)
    assert len({r.shard for r in manifest}) > 8 and max(r.n_records for r in manifest) < 30


def test_a_bare_path_is_that_of_the_default_file_system(spark, tmp_path):
    target = str(tmp_path / "w")
    warc.write_warc(frame(spark, ROWS), target)
    assert read(spark, "file://" + target) == read(spark, target) == want(ROWS)


def archives(path):
    return {os.path.basename(f): hashlib.sha1(open(f, "rb").read()).hexdigest()
            for f in files_under(path) if f.endswith(".warc.gz")}


def test_files_depend_on_the_data_alone(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for name, df in (("a", pages), ("b", pages.repartition(7)), ("c", pages.coalesce(1))):
        warc.write_warc(df, str(tmp_path / name), shard_bytes=50_000, roll_bytes=20_000)
    first = archives(tmp_path / "a")
    assert len(first) > 3
    assert first == archives(tmp_path / "b") == archives(tmp_path / "c")
    listed = {r.name: r.sha1 for r in spark.read.parquet(str(tmp_path / "a" / "manifest")).collect()}
    assert listed == first


def test_files_of_lost_attempts_are_not_read(spark, tmp_path):
    target = str(tmp_path / "w")
    os.makedirs(f"{target}/_temporary/lost")
    with open(f"{target}/_temporary/lost/shard-000000-00000.warc.gz", "wb") as f:
        f.write(b"half a file")
    warc.write_warc(frame(spark, ROWS), target)
    assert read(spark, target) == want(ROWS)


def test_damaged_payload_is_noticed(spark, tmp_path):
    record = warc._record(1, "u", warc.DATE, hashlib.sha1(b"payload").digest(), b"payload", 7)
    good = gzip.decompress(record)
    head, block = next(warc._records(io.BytesIO(gzip.compress(good))))
    assert warc._page(head, block)[3] == 7
    with pytest.raises(ValueError):
        warc._page(head, block.replace(b"payload", b"pAyload"))
