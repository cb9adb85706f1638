"""Tables of Arrow stream files with one commit for data, parts and lineage.

A table is a folder: files below ``data/<part>/``, and a log, ``log/<version>.json``.  Tasks write files that nothing names yet; when all have
succeeded the driver writes one log entry, under a name of its own first and then moved, that names the files of each part, the schema and the
step of the lineage.  So a write is there as a whole or not at all: files of failed tasks, attempts and jobs are named by no entry and read by
nobody.  Reading follows the log: the newest entry that replaces the table and those after it.

One writer at a time; a second one whose version is taken meanwhile raises and leaves nothing.  A folder without a log is read as it is, every
``.arrow`` file below it.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

from quarry.session import ship

FILE_BYTES, TASK_BYTES, OPEN_BYTES = 128 << 20, 64 << 20, 1 << 20  # of a file written; of the small files that one task reads, and what opening one counts


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    store, root = pafs.FileSystem.from_uri(path)
    return store, root.rstrip("/")


def entries(path: str) -> list[dict]:
    """The log, oldest entry first; empty for a folder without one."""
    store, root = _store(path)
    found = store.get_file_info(pafs.FileSelector(f"{root}/log", allow_not_found=True))
    out = []
    for info in sorted((i for i in found if i.base_name.endswith(".json") and i.base_name[0] != "_"), key=lambda i: i.base_name):
        with store.open_input_stream(info.path) as f:
            out.append(json.loads(f.read()) | {"version": int(info.base_name.split(".")[0])})
    return out


def is_table(path: str) -> bool:
    """Whether a write was ever begun in the folder, which then is never read without a log."""
    store, root = _store(path)
    return store.get_file_info(f"{root}/log/_table").type != pafs.FileType.NotFound


def live_files(log: list[dict], part: str | None = None) -> list[dict]:
    """The files of the table as it stands: {path, part, bytes, rows}."""
    first = max((k for k, e in enumerate(log) if e["replace"]), default=0)
    return [f for e in log[first:] for f in e["files"] if part is None or f["part"] == part]


def lineage(path: str) -> list[dict]:
    """The steps that made a table, in order."""
    return [s for e in entries(path)[-1:] for s in e["lineage"]]


def _append(path: str, entry: dict, version: int) -> None:
    store, root = _store(path)
    store.create_dir(f"{root}/log", recursive=True)
    name, waiting = f"{root}/log/{version:012d}.json", f"{root}/log/_{uuid.uuid4().hex}"
    with store.open_output_stream(waiting) as f:
        f.write(json.dumps(entry).encode())
    if store.get_file_info(name).type != pafs.FileType.NotFound:
        store.delete_file(waiting)
        raise RuntimeError(f"another write of {path} was committed meanwhile")
    store.move(waiting, name)


def _schema_text(schema: pa.Schema) -> str:
    return base64.b64encode(schema.serialize().to_pybytes()).decode()


def _schema_of(text: str) -> pa.Schema:
    return pa.ipc.read_schema(pa.py_buffer(base64.b64decode(text)))


@dataclass
class _Files(InputPartition):
    paths: tuple[str, ...]


def _packed(files: list[tuple[str, int]]) -> list[_Files]:
    """Small files together, up to TASK_BYTES a task."""
    out, held, size = [], [], 0
    for path, many in files:
        if held and size + many + OPEN_BYTES > TASK_BYTES:
            out.append(_Files(tuple(held)))
            held, size = [], 0
        held.append(path)
        size += many + OPEN_BYTES
    return out + ([_Files(tuple(held))] if held else [])


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        path = self.options["path"]
        log = entries(path)
        store, root = _store(path)
        if log:
            return _packed([(f"{root}/{f['path']}", f["bytes"]) for f in live_files(log, self.options.get("part"))]) or [_Files(())]
        if is_table(path):
            return []
        found = store.get_file_info(pafs.FileSelector(root, recursive=True))
        return _packed([(i.path, i.size) for i in sorted(found, key=lambda i: i.path) if i.path.endswith(".arrow")])

    def read(self, part: _Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.options["path"])
        for path in part.paths:
            with store.open_input_stream(path) as f:
                yield from pa.ipc.open_stream(f)


class _Commits(DataSourceStreamReader):
    """New commits as they come; an offset is the number of log entries read.

    With ``max_commits`` a batch takes at most so many; how far a reader's batches are planned stands beside the log, under
    the reader's ``consumer`` name, so that the bound holds after a restart as well.
    """

    def __init__(self, options: dict[str, str]):
        self.options = options
        self.most = int(options.get("max_commits", 0))
        if self.most and "consumer" not in options:
            raise ValueError("max_commits needs the option consumer")

    def _mark(self) -> tuple[pafs.FileSystem, str]:
        store, root = _store(self.options["path"])
        return store, f"{root}/consumers/{quote(self.options['consumer'], safe='')}.json"

    def initialOffset(self) -> dict:
        return {"entries": 0}

    def latestOffset(self) -> dict:
        there = len(entries(self.options["path"]))
        if self.most:
            store, mark = self._mark()
            done = 0
            if store.get_file_info(mark).type != pafs.FileType.NotFound:
                with store.open_input_stream(mark) as f:
                    done = json.loads(f.read())["entries"]
            there = min(there, done + self.most)
        return {"entries": there}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        _, root = _store(self.options["path"])
        if self.most:  # Spark has noted this batch in its checkpoint and would plan it again as it is
            store, mark = self._mark()
            store.create_dir(mark.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(mark) as f:
                f.write(json.dumps(end).encode())
        new = entries(self.options["path"])[start["entries"] : end["entries"]]
        return _packed([(f"{root}/{f['path']}", f["bytes"]) for e in new for f in e["files"]]) or [_Files(())]

    def read(self, part: _Files) -> Iterator[pa.RecordBatch]:
        return _Reader(self.options).read(part)


@dataclass
class _Written(WriterCommitMessage):
    files: list[dict]


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.options, self.overwrite, self.run = options, overwrite, uuid.uuid4().hex
        self.part = options.get("part")
        if self.part and self.part not in schema.fieldNames():
            raise ValueError(f"no column {self.part}")
        whole = to_arrow_schema(schema)
        self.schema = pa.schema([f for f in whole if f.name != self.part])
        log = entries(options["path"])
        store, root = _store(options["path"])
        store.create_dir(f"{root}/log", recursive=True)
        store.open_output_stream(f"{root}/log/_table").close()
        self.version = log[-1]["version"] + 1 if log else 1
        self.before = [s for e in (entries(options["before"]) if "before" in options else log)[-1:] for s in e["lineage"]]
        if log and not overwrite and not _schema_of(log[-1]["schema"]).equals(self.schema):
            raise ValueError("rows of another schema can't be added to the table")

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        store, root = _store(self.options["path"])
        files: list[dict] = []
        sink = writer = None
        now = None

        def close() -> None:
            nonlocal sink, writer, now
            if writer is not None:
                writer.close()
                files[-1]["bytes"] = sink.tell()
                sink.close()
            sink = writer = now = None

        for b in batches:
            names = b.column(b.schema.get_field_index(self.part)).to_pylist() if self.part else [None] * b.num_rows
            rows = b.drop_columns([self.part]) if self.part else b
            rows = rows.cast(self.schema) if not rows.schema.equals(self.schema) else rows
            at = 0
            while at < b.num_rows:
                stop = at + 1
                while stop < b.num_rows and names[stop] == names[at]:
                    stop += 1
                if writer is None or names[at] != now or sink.tell() > FILE_BYTES:
                    close()
                    now = names[at]
                    folder = "data" if now is None else f"data/{quote(str(now), safe=' ')}"
                    store.create_dir(f"{root}/{folder}", recursive=True)
                    name = f"{folder}/{self.run}-{uuid.uuid4().hex}.arrow"
                    sink = store.open_output_stream(f"{root}/{name}")
                    writer = pa.ipc.new_stream(sink, self.schema)
                    files.append({"path": name, "part": None if now is None else str(now), "rows": 0, "bytes": 0})
                writer.write_batch(rows.slice(at, stop - at))
                files[-1]["rows"] += stop - at
                at = stop
        close()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        files = [f for m in messages if m is not None for f in m.files]
        step = json.loads(self.options.get("step", "{}")) | {"timestamp": datetime.now(timezone.utc).isoformat()}
        _append(self.options["path"], {"replace": self.overwrite, "schema": _schema_text(self.schema), "files": files, "lineage": [*self.before, step]}, self.version)

    def abort(self, messages: list[_Written | None]) -> None:
        store, root = _store(self.options["path"])
        for m in messages:
            for f in m.files if m is not None else ():
                store.delete_file(f"{root}/{f['path']}")


class ArrowTables(DataSource):
    """Option ``part``: for writing the column that names a row's part (left out of the data), for reading the part to read."""

    @classmethod
    def name(cls) -> str:
        return "arrow_tables"

    def schema(self) -> StructType:
        log = entries(self.options["path"])
        if log:
            return from_arrow_schema(_schema_of(log[-1]["schema"]))
        parts = self.reader(None).partitions()
        if not parts:
            raise FileNotFoundError(f"no table and no .arrow file in {self.options['path']}")
        store, _ = _store(self.options["path"])
        with store.open_input_stream(parts[0].paths[0]) as f:
            return from_arrow_schema(pa.ipc.open_stream(f).schema)

    def reader(self, schema: StructType | None) -> DataSourceReader:
        return _Reader(dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Commits(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), schema, overwrite)


def _known(spark: SparkSession) -> SparkSession:
    ship(spark).dataSource.register(ArrowTables)
    return spark


def read_arrow(spark: SparkSession, path: str, part: str | None = None) -> DataFrame:
    """A table, or one part of it; or all Arrow stream files of a folder without a log."""
    reader = _known(spark).read.format("arrow_tables")
    return (reader.option("part", part) if part is not None else reader).load(path)


def follow_arrow(spark: SparkSession, path: str, *, max_commits: int = 0, consumer: str = "") -> DataFrame:
    """A stream of what is added to a table, each commit once."""
    reader = _known(spark).readStream.format("arrow_tables")
    if max_commits:
        reader = reader.option("max_commits", str(max_commits)).option("consumer", consumer)
    return reader.load(path)


def save_arrow(df: DataFrame, path: str, step: dict, *, part: str | None = None, append: bool = False, before: str | None = None) -> None:
    """Write ``df`` and its lineage, that of the table ``before`` (default: this one's) and this step, in one commit.

    With ``part`` each of that column's values is a part of its own, to be read by itself; a task's rows are sorted by it, so one file is open at a time.
    """
    rows = df if part is None else df.sortWithinPartitions(F.col(part))
    _known(df.sparkSession)
    writer = rows.write.format("arrow_tables").mode("append" if append else "overwrite").option("step", json.dumps(step))
    writer = writer.option("part", part) if part is not None else writer
    (writer.option("before", before) if before is not None else writer).save(path)


def parts(path: str) -> dict[str, int]:
    """Rows of each part of a table, by name; names and counts stand in the log."""
    out: dict[str, int] = {}
    for f in live_files(entries(path)):
        if f["part"] is not None:
            out[f["part"]] = out.get(f["part"], 0) + f["rows"]
    return dict(sorted(out.items()))


def swept(path: str) -> int:
    """Delete the files that no log entry names, and say how many; not while another write is under way."""
    store, root = _store(path)
    named = {f["path"] for e in entries(path) for f in e["files"]}
    found = store.get_file_info(pafs.FileSelector(f"{root}/data", recursive=True, allow_not_found=True))
    stale = [i.path for i in found if i.is_file and unquote(i.path[len(root) + 1 :]) not in {unquote(n) for n in named}]
    for p in stale:
        store.delete_file(p)
    return len(stale)
