"""Media columns: archives of lossless images and a Spark data source over them.

:func:`write_archives` turns payloads into 8-bit grey PNG files and packs them
into archives.  An archive is a run of members, each with a local header, then a
directory of (offset, length, id, crc) and a fixed tail that says where the directory
starts, so any byte range of the archive can be read on its own.

:class:`ArchiveSource` is registered as ``quarry_media``.  The driver plans byte
ranges from the archives' sizes alone, as Spark does for its own files; sizes come from a manifest table if
there is one, else from listing the folder.  A task knows its own range and nothing of the others: it reads
the directory of its archive, takes the members whose offset is in its range, streams them in
Arrow batches and reads a member that fails again by its offset, up to ``retries`` times,
without touching the others.

Defined results: a null payload counts as empty and is padded like any other; repeated rows are a member
each; ids may be null; an archive without members is skipped; a member that stays unreadable fails the
task (``onerror=fail``) or comes back with a null media column (``onerror=null``); an empty table has no archive
and no row.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import dataset as ds
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from quarry.llm.common import in_arrow, shared_path
from quarry.session import ship

#: Formats of a member's header, a directory entry and the tail, and their sizes.
MAGIC, HEAD, ENTRY, TAIL = b"QMA1", "<4sqqI", "<qqqI", "<qq4s"
HEAD_SIZE, ENTRY_SIZE, TAIL_SIZE = map(struct.calcsize, (HEAD, ENTRY, TAIL))
WIDTH, NO_ID = 576, -(1 << 63)
RANGE_BYTES = 64 << 20
MANIFEST = [("archive", pa.string()), ("bytes", pa.int64()), ("members", pa.int64())]
PNG = b"\x89PNG\r\n\x1a\n"


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store and the path in it for a folder as Spark names it.

    Spark's names for object stores are turned into Arrow's; a store that Arrow doesn't know is
    looked for in fsspec, where that is installed.
    """
    scheme, rest = uri.split(":", 1) if ":" in uri else ("file", uri)
    plain = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}.get(scheme, scheme)
    try:
        return pafs.FileSystem.from_uri(f"{plain}:{rest}" if ":" in uri else uri)
    except pa.ArrowInvalid:
        import fsspec  # only for stores unknown to Arrow

        store, path = fsspec.core.url_to_fs(uri)
        return pafs.PyFileSystem(pafs.FSSpecHandler(store)), path


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_encode(payload: bytes, n_bytes: int, width: int = WIDTH, level: int = 1) -> bytes:
    """8-bit grey PNG whose samples are ``payload``, a positive multiple of ``width``.
    A text chunk says how many of the samples aren't padding."""
    rows = len(payload) // width
    if rows < 1 or rows * width != len(payload):
        raise ValueError("the payload is no positive multiple of the width")
    lines = np.zeros((rows, width + 1), np.uint8)  # the first byte of a line: filter 0
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, width)
    return PNG + _chunk(b"IHDR", struct.pack(">IIBBBBB", width, rows, 8, 0, 0, 0, 0)) + _chunk(b"tEXt", b"Bytes\0%d" % n_bytes) + _chunk(b"IDAT", zlib.compress(lines.data, level)) + _chunk(b"IEND", b"")


def png_decode(media: bytes) -> tuple[np.ndarray, int]:
    """Samples (rows, width) of a PNG by :func:`png_encode`, and how many aren't
    padding; wrong checksums raise."""
    if media[:8] != PNG:
        raise ValueError("not a PNG")
    at, packed, shape, n_bytes = 8, [], None, 0
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", media, at + 8 + size)[0]:
            raise ValueError("a chunk's checksum is wrong")
        if kind == b"IHDR":
            shape = struct.unpack(">IIBBBBB", body)
        elif kind == b"tEXt":
            n_bytes = int(body.removeprefix(b"Bytes\0"))
        elif kind == b"IDAT":
            packed.append(body)
        at += 12 + size
    width, rows = shape[:2]
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(rows, width + 1)
    if lines[:, 0].any():
        raise ValueError("a line has a filter")
    return lines[:, 1:], n_bytes


def pad(payload: bytes, unit: int = WIDTH) -> bytes:
    return payload + b"\xff" * (-len(payload) % unit or (0 if payload else unit))


def features(samples: np.ndarray) -> str:
    """Rows, mean, deviation and mean step along the lines, as exact integers' ratios."""
    n, x = samples.size, samples
    total = int(x.sum(dtype=np.int64))
    squares = int((np.bincount(x.ravel(), minlength=256).astype(np.int64) * np.arange(256, dtype=np.int64) ** 2).sum())
    steps = int(np.abs(x[:, 1:].astype(np.int16) - x[:, :-1]).sum(dtype=np.int64))
    return f"{x.shape[0]}x{x.shape[1]}:mean={1000 * total // n}:var={1000 * (squares * n - total * total) // (n * n)}:step={1000 * steps // n}"


def write_archives(docs: DataFrame, path: str, *, id_col: str = "doc_id", payload: Column | None = None, archive_bytes: int = 256 << 20) -> DataFrame:
    """Write the archives below ``path``; (archive, bytes, members), one row each: the manifest.

    A task writes archives under names of its own and only its result names
    them, so what a lost or repeated attempt leaves behind is never read.
    The frame is lazy: write it before use, see :func:`manifested`.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col("text").cast("binary") if payload is None else payload, F.lit(b"")).alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = store_of(path)
        store.create_dir(root, recursive=True)
        out, name, at, entries = None, "", 0, []

        def close() -> pa.RecordBatch:
            for e in entries:
                out.write(struct.pack(ENTRY, *e))
            out.write(struct.pack(TAIL, at, len(entries), MAGIC))
            out.close()
            size = at + len(entries) * ENTRY_SIZE + TAIL_SIZE
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([len(entries)], pa.int64())], ["archive", "bytes", "members"])

        for b in batches:
            for key, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if out is None:
                    name, at, entries = f"{uuid.uuid4().hex}.qma", 0, []
                    out = store.open_output_stream(f"{root}/{name}")
                data = raw.as_py()
                media = png_encode(pad(data), len(data))
                key = NO_ID if key is None else key
                out.write(struct.pack(HEAD, MAGIC, key, len(media), zlib.crc32(media)))
                out.write(media)
                entries.append((at, len(media), key, zlib.crc32(media)))
                at += HEAD_SIZE + len(media)
                if at >= archive_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return in_arrow(rows, run, "archive string, bytes long, members long")


def manifested(docs: DataFrame, path: str, **options) -> str:
    """Write archives and their manifest below ``path``; the manifest's folder."""
    manifest = f"{path}/manifest"
    write_archives(docs, path, **options).write.parquet(manifest)
    return manifest


class _Range(InputPartition):
    def __init__(self, archive: str, start: int, end: int):
        self.archive, self.start, self.end = archive, start, end


def read_member(f, offset: int, length: int, crc: int, retries: int) -> bytes | None:
    """One member by its offset; read again if the bytes are short or wrong."""
    for _ in range(retries + 1):
        try:
            f.seek(offset)
            media = f.read(HEAD_SIZE + length)[HEAD_SIZE :]
            if len(media) == length and zlib.crc32(media) == crc:
                return media
        except OSError:
            pass
    return None


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options
        self.retries, self.fail = int(options.get("retries", 3)), options.get("onerror", "fail") == "fail"

    def partitions(self) -> list[InputPartition]:
        """Ranges of at most ``rangebytes`` of each archive: the driver reads names and sizes only."""
        step = int(self.options.get("rangebytes", RANGE_BYTES))
        store, root = store_of(self.options["path"])
        if "manifest" in self.options:
            store, at = store_of(self.options["manifest"])
            rows = ds.dataset([i.path for i in store.get_file_info(pafs.FileSelector(at)) if i.path.endswith(".parquet")], filesystem=store, format="parquet", schema=pa.schema(MANIFEST))
            sizes = ((f"{root}/{name}", size) for b in rows.to_batches() for name, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        else:
            sizes = ((i.path, i.size) for i in store.get_file_info(pafs.FileSelector(root)) if i.path.endswith(".qma"))
        return [_Range(path, s, min(size, s + step)) for path, size in sorted(sizes) for s in range(0, size, step)]

    def read(self, part: _Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # nothing was planned
            return
        store, _ = store_of(self.options["path"])
        most = int(self.options.get("batchbytes", 4 << 20))
        with store.open_input_file(part.archive) as f:
            f.seek(f.size() - TAIL_SIZE)
            start, count, magic = struct.unpack(TAIL, f.read(TAIL_SIZE))
            if magic != MAGIC:
                raise OSError(f"no directory at the end of {part.archive}")
            f.seek(start)
            entries = np.frombuffer(f.read(count * ENTRY_SIZE), np.dtype([("at", "<i8"), ("size", "<i8"), ("id", "<i8"), ("crc", "<u4")]))
            mine = entries[(entries["at"] >= part.start) & (entries["at"] < part.end)]
            ids, media, held = [], [], 0
            for at, size, key, crc in mine.tolist():
                got = read_member(f, at, size, crc, self.retries)
                if got is None and self.fail:
                    raise OSError(f"member {key} at {at} of {part.archive} can't be read")
                ids.append(key if key != NO_ID else None)
                media.append(got)
                held += size
                if held >= most:
                    yield self.batch(part, ids, media)
                    ids, media, held = [], [], 0
            if ids:
                yield self.batch(part, ids, media)

    @staticmethod
    def batch(part: _Range, ids: list, media: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([os.path.basename(part.archive)] * len(ids)), pa.array(ids, pa.int64()), pa.array(media, pa.binary())], ["archive", "id", "media"])


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "quarry_media"

    def schema(self) -> StructType:
        return StructType([StructField("archive", StringType()), StructField("id", LongType()), StructField("media", BinaryType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def media_columns(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per member: checksums of the samples read back, the stored form's, features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for raw in b.column(1):
                stored_form = raw.as_py()
                samples, n_bytes = png_decode(stored_form)
                payload = samples.tobytes()
                rows.append((n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(stored_form), hashlib.sha256(stored_form).hexdigest(), features(samples)))
            cols = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    schema = f"{id_col} long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return in_arrow(media.select(F.col("id"), F.col("media")), run, schema)


def round_trip(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Store every payload in archives, read them through the source, describe them."""
    spark = docs.sparkSession
    path = shared_path(spark, "media")
    manifest = manifested(docs, path, id_col=id_col)
    return media_columns(read_archives(spark, path, manifest=manifest), id_col)


def read_archives(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """(archive, id, media) of the members of the archives in a folder."""
    spark.dataSource.register(ArchiveSource)
    return ship(spark).read.format("quarry_media").option("path", path).options(**options).load()
