"""The archive against hashlib and plain grouping, and exact round trips through WARC files."""

import base64
import hashlib

import pytest

from lendframe.llm import archive

PAGES = [(1, "http://a/", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://c/\r\nX: y", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (4, "u", None), (5, "u", ""),
         (6, "u", "<p>é</p>"), (7, "u", "x" * 300_000), (8, "u", "a\x00b\r\n\r\n")]


def brute(pages, least=0):
    out = []
    order = sorted(pages, key=lambda p: (p[0] is not None, p[0] or 0, p[2] or ""))
    for i, (pid, _, html) in enumerate(order):
        raw = (html or "").encode()
        last = max(j for j, p in enumerate(order) if (p[2] or "") == (html or ""))
        revisit = len(raw) >= least and last != i
        out.append((pid, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", order[last][0] if revisit else None))
    return sorted(out, key=repr)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, payload string")


@pytest.mark.parametrize("least", [0, 5])
def test_report_equals_plain_grouping(spark, tmp_path, least):
    got = archive.report(frame(spark, PAGES), str(tmp_path / "a"), least).collect()
    assert sorted(map(tuple, got), key=repr) == brute(PAGES, least)


def test_null_and_repeated_ids(spark, tmp_path):
    pages = [(None, "a", "x"), (None, "a", "x"), (3, "b", "x"), (3, "b", "x"), (3, "b", "y")]
    got = archive.report(frame(spark, pages), str(tmp_path / "a")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(pages)


def test_each_payload_is_stored_once(spark, tmp_path):
    archive.write_archive(frame(spark, PAGES), str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a/payloads")).count() == len({p[2] or "" for p in PAGES})


def test_records_survive_warc_files(spark, tmp_path):
    archive.write_archive(frame(spark, PAGES), str(tmp_path / "a"))
    records = archive.read_archive(spark, str(tmp_path / "a"))
    archive.export_warc(records, str(tmp_path / "w"))
    want = {bytes(r.header): bytes(r.payload) if r.record_type == "response" else b"" for r in records.collect()}
    got = {bytes(r.header): bytes(r.block) for r in archive.import_warc(spark, str(tmp_path / "w")).collect()}
    assert got == want and len(got) == len(PAGES)
    whole = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    assert sorted(bytes(r.record) for r in records.collect()) == sorted(h + b"\r\n\r\n" + b + b"\r\n\r\n" for h, b in got.items())
    assert len(whole) == sum(len(r.record) for r in records.collect())


def test_damage_is_found(spark, tmp_path):
    from pyspark.sql import functions as F

    archive.write_archive(frame(spark, PAGES), str(tmp_path / "a"))
    bad = spark.read.parquet(str(tmp_path / "a/payloads")).withColumn("payload", F.concat("payload", F.lit(b"!")))
    bad.write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(str(tmp_path / "a/headers")).write.parquet(str(tmp_path / "b/headers"))
    with pytest.raises(Exception, match="damaged"):
        archive.read_archive(spark, str(tmp_path / "b")).select("payload_digest").collect()


def test_empty_table(spark, tmp_path):
    assert archive.report(frame(spark, []), str(tmp_path / "a")).count() == 0
