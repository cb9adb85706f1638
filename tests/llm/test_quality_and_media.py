import hashlib
import math
import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

from quarry.llm import compression_quality as q
from quarry.llm import media as m
from quarry.llm import queries
from quarry.llm.common import shared_path
from tests.llm.fixtures import awkward, empty, words


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op9_compression_quality(spark, sf).join(labels, "doc_id").where("held_out")
    row = got.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("acc"), F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("kept"), F.avg("score").alias("mean"), F.avg("quality").alias("share")).head()
    assert row.acc > 0.95 and row.kept > 0.98
    assert row.mean == pytest.approx(row.share, abs=0.05)


def test_equal_texts_score_alike_and_labels_are_no_input(spark):
    rng = random.Random(0)
    rows = [(i, words(rng, 50) if i % 2 else ("BUY NOW!! " * 20 + str(i)), "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = q.train(docs, labels, dictionary_bytes=4000, calibration_rows=40)
    scored = q.score(awkward(spark), model, keep=["text"]).collect()
    assert len(scored) == 13 and all(0 <= r.quality_score <= 1 for r in scored)
    assert len({r.text: r.quality_score for r in scored}) == len({(r.text, r.quality_score) for r in scored})
    assert {r.quality_score for r in scored if not r.text} == {next(r.quality_score for r in scored if r.text is None)}
    whole = q.score(awkward(spark), model)
    assert "payload" in whole.columns and whole.columns.count("quality_score") == 1 and whole.count() == 13
    assert q.score(empty(spark), model).count() == 0


def test_scores_follow_from_compressed_sizes(spark):
    """Against zstandard called here, block by block, without the model's code."""
    rng = random.Random(4)
    good, bad = words(rng, 400).encode(), b"click here to win " * 150
    model = q.CompressionModel(good, bad, 3.0, 0.25)

    def size(text: bytes, raw: bytes) -> int:
        held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return sum(len(zstandard.ZstdCompressor(level=q.LEVEL, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False).compress(text[i : i + q.BLOCK])) for i in range(0, len(text), q.BLOCK))

    texts = [words(rng, 30), words(rng, 3000), "click here to win " * 20, "", "é" * 700, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.quality_score for r in q.score(df, model, keep=["doc_id"]).collect()}
    for k, text in enumerate(texts):
        raw = (text or "").encode()
        d = (size(raw, bad) - size(raw, good)) / max(1, len(raw))
        assert got[k] == pytest.approx(1 / (1 + math.exp(-(3.0 * d + 0.25))), rel=1e-9)
    assert got[0] > got[3] > got[2] and got[3] == got[5]


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.train(awkward(spark), none)
    assert {r.quality_score for r in q.score(awkward(spark), model, keep=["doc_id"]).collect()} == {0.5}


@pytest.mark.parametrize("payload", [b"", b"a", b"x" * 576, b"\xff\x00" * 300])
def test_png(payload):
    full = m.pad(payload)
    assert len(full) % 576 == 0 and full and full.startswith(payload)
    samples, n = m.png_decode(m.png_encode(full, len(payload)))
    assert samples.tobytes() == full and n == len(payload)
    bad = bytearray(m.png_encode(full, len(payload)))
    bad[60] ^= 1
    with pytest.raises(ValueError):
        m.png_decode(bytes(bad))


def independent_png(media: bytes) -> bytes:
    """Samples of an 8-bit grey PNG, by the format's rules (all five line filters)."""
    at, chunks = 8, []
    while at < len(media):
        n, kind = int.from_bytes(media[at : at + 4], "big"), media[at + 4 : at + 8]
        assert zlib.crc32(media[at + 4 : at + 8 + n]) == int.from_bytes(media[at + 8 + n : at + 12 + n], "big")
        chunks.append((kind, media[at + 8 : at + 8 + n]))
        at += 12 + n
    assert media[:8] == bytes([137, 80, 78, 71, 13, 10, 26, 10]) and chunks[0][0] == b"IHDR" and chunks[-1] == (b"IEND", b"")
    width, height = int.from_bytes(chunks[0][1][:4], "big"), int.from_bytes(chunks[0][1][4:8], "big")
    assert tuple(chunks[0][1][8:]) == (8, 0, 0, 0, 0)
    raw = zlib.decompress(b"".join(body for kind, body in chunks if kind == b"IDAT"))
    before, out = [0] * width, []
    for y in range(height):
        how, line, now = raw[y * (width + 1)], raw[y * (width + 1) + 1 : (y + 1) * (width + 1)], []
        for x, v in enumerate(line):
            left, up, corner = now[x - 1] if x else 0, before[x], before[x - 1] if x else 0
            paeth = min((left, up, corner), key=lambda c: abs(left + up - corner - c))
            now.append((v + (0, left, up, (left + up) // 2, paeth)[how]) % 256)
        before = now
        out.append(bytes(now))
    return b"".join(out)


def test_an_independent_reader_sees_the_payload(spark):
    docs = awkward(spark).where("doc_id is null or doc_id not in (5, 6)")
    path = shared_path(spark, "media-read")
    got = [(r.id, independent_png(bytes(r.media))) for r in m.read_archives(spark, path, manifest=m.manifested(docs, path)).collect()]
    want = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    want = [(i, t + b"\xff" * (-len(t) % 576 if t else 576)) for i, t in want]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_stores_by_sparks_names(monkeypatch):
    asked = []
    monkeypatch.setattr(m.pafs, "FileSystem", type("F", (), {"from_uri": staticmethod(lambda u: asked.append(u) or (None, u))}))
    for uri in ("s3a://bucket/x", "abfss://c@a.dfs.core.windows.net/x", "hdfs://h/x", "file:/tmp/x", "/tmp/x"):
        m.store_of(uri)
    assert asked == ["s3://bucket/x", "abfs://c@a.dfs.core.windows.net/x", "hdfs://h/x", "file:/tmp/x", "/tmp/x"]


def test_round_trip(spark):
    got = m.round_trip(awkward(spark)).collect()
    assert len(got) == 13
    want = sorted(((r.doc_id, r.text or "") for r in awkward(spark).collect()), key=repr)
    for r, (i, t) in zip(sorted(got, key=lambda r: repr((r.doc_id, r.payload_sha256))), sorted(want, key=lambda x: repr((x[0], hashlib.sha256(m.pad(x[1].encode())).hexdigest())))):
        full = m.pad(t.encode())
        assert (r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (i, len(t.encode()), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
    assert m.round_trip(empty(spark)).count() == 0


def test_small_ranges_and_broken_members(spark):
    path = shared_path(spark, "media-test")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string").coalesce(1)
    manifest = m.manifested(docs, path)
    m.write_archives(docs, path).collect()  # an attempt that no manifest names
    read = lambda **o: m.read_archives(spark, path, manifest=manifest, **o)
    assert read(rangebytes="100").rdd.getNumPartitions() > 5
    assert sorted(r.id for r in read(rangebytes="100").collect()) == list(range(20))
    assert m.read_archives(spark, path).count() == 40
    file = f"{path.removeprefix('file:')}/{spark.read.parquet(manifest).head().archive}"
    raw = bytearray(open(file, "rb").read())
    raw[60] ^= 255
    open(file, "wb").write(bytes(raw))
    lost = read(onerror="null").collect()
    assert len(lost) == 20 and sum(r.media is None for r in lost) == 1
    with pytest.raises(Exception, match="can't be read"):
        read(retries="1").collect()


class Flaky:
    """A file whose first reads come back short."""

    def __init__(self, data: bytes, failures: int):
        self.data, self.left, self.at = data, failures, 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        self.left -= 1
        return self.data[self.at : self.at + n // (2 if self.left >= 0 else 1)]


def test_members_are_read_again():
    body = b"payload"
    data = b"\0" * m.HEAD_SIZE + body
    assert m.read_member(Flaky(data, 2), 0, len(body), zlib.crc32(body), 3) == body
    assert m.read_member(Flaky(data, 9), 0, len(body), zlib.crc32(body), 3) is None


def test_repeated_ids_train_once(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, words(rng, 40) if i % 2 else f"BUY NOW {i} " * 20) for i in range(80)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    more = docs.unionByName(docs.where("doc_id < 2").crossJoin(spark.range(2000)).select("doc_id", "text"))
    a, b = q.train(docs, labels, calibration_rows=10), q.train(more, labels.unionByName(labels), calibration_rows=10)
    assert a == b
    one = q.train(docs, labels.where("doc_id < 2"))
    assert one.good and one.bad and 0 <= one.scores([b"x"])[0] <= 1
