import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import warc
from quarry.llm.common import shared_path

LONG = "Ünïcode and line ends\r\n\r\nWARC/1.1\r\n" * 50_000


def pages(spark):
    big = "x" * 100
    rows = [
        (3, "http://a/3", big), (1, "http://a/1", big), (2, None, big), (None, "http://a/n", big), (4, "http://a/\r\nX: y", "x" * 99), (5, "u", "x" * 99), (6, "u", None), (7, "u", ""),
        (None, "u", "é" * 60), (8, "u", "é" * 60), (8, "v", "é" * 60), (None, "p", "n" * 200), (None, "q", "n" * 200), (9, "long", LONG), (10, "u\r\n\r\n", LONG),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("header", F.lit("clash")).withColumn("row", F.lit("clash"))


def parse(record: bytes) -> tuple[dict, bytes]:
    """An independent reader of one WARC record."""
    head, rest = record.split(b"\r\n\r\n", 1)
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    assert first == "WARC/1.1" and len(fields) == len(lines)
    size = int(fields["Content-Length"])
    assert rest[size:] == b"\r\n\r\n"
    return fields, rest[:size]


def test_round_trip(spark):
    got = [tuple(r) for r in warc.round_trip(pages(spark)).collect()]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    line = lambda key, t, kind="response", to=None: (key, len(t.encode()), digest(t), kind, to)
    big, e, n = "x" * 100, "é" * 60, "n" * 200
    want = [
        line(1, big), line(2, big, "revisit", 1), line(3, big, "revisit", 1), line(None, big, "revisit", 1), line(4, "x" * 99), line(5, "x" * 99), line(6, ""), line(7, ""),
        line(8, e), line(8, e, "revisit", 8), line(None, e, "revisit", 8), line(None, n), line(None, n, "revisit", None), line(9, LONG), line(10, LONG, "revisit", 9),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_records_are_rebuilt_as_warc(spark):
    archive = warc.write_archive(pages(spark), shared_path(spark, "warc-test"))
    assert archive.payloads.count() == 6
    path = shared_path(spark, "warc-out")
    warc.export_records(warc.read_records(archive), path)
    records = [parse(bytes(r.record)) for r in spark.read.parquet(path).collect()]
    assert len(records) == 15
    uris = {f["WARC-Record-ID"]: (f, block) for f, block in records}
    assert len(uris) == 15 and all(re.fullmatch("<urn:uuid:[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}>", u) for u in uris)
    for fields, block in records:
        digest = fields["WARC-Payload-Digest"]
        if fields["WARC-Type"] == "response":
            assert digest == "sha256:" + hashlib.sha256(block).hexdigest() and not {"WARC-Refers-To", "WARC-Profile", "X-Refers-To-Key"} & set(fields)
        else:
            first, payload = uris[fields["WARC-Refers-To"]]
            assert block == b"" and first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == digest
            assert fields.get("X-Refers-To-Key") == first.get("X-Record-Key")
    assert {f.get("WARC-Target-URI") for f, _ in records} == {"http://a/3", "http://a/1", None, "http://a/n", "http://a/%0D%0AX: y", "u", "v", "p", "q", "long", "u%0D%0A%0D%0A"}


def test_originals_come_back(spark):
    archive = warc.write_archive(pages(spark), shared_path(spark, "warc-test"))
    got = sorted(((r.page_id, bytes(r.payload)) for r in warc.originals(archive).collect()), key=repr)
    assert got == sorted(((r.page_id, (r.html or "").encode()) for r in pages(spark).collect()), key=repr)


def test_damage_is_found(spark):
    archive = warc.write_archive(pages(spark), shared_path(spark, "warc-test"))
    bad, none = shared_path(spark, "warc-bad"), shared_path(spark, "warc-none")
    archive.payloads.withColumn("payload", F.lit(b"forged")).write.parquet(f"{bad}/payloads")
    archive.records.write.parquet(f"{bad}/records")
    with pytest.raises(Exception, match="match its digest"):
        warc.describe(warc.read_records(warc.Archive(spark, bad))).collect()
    archive.payloads.limit(0).write.parquet(f"{none}/payloads")
    archive.records.write.parquet(f"{none}/records")
    with pytest.raises(Exception, match="no payload is stored"):
        warc.describe(warc.read_records(warc.Archive(spark, none))).collect()
    cut = warc.read_records(archive).withColumn("record", F.expr("substring(record, 1, octet_length(record) - 1)"))
    with pytest.raises(Exception, match="length isn't its header's"):
        warc.describe(cut).collect()


def test_empty(spark):
    assert warc.round_trip(pages(spark).limit(0)).count() == 0
