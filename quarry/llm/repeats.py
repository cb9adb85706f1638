"""Exact repeated substrings by bucket-pointer refinement, distributed.

Every byte covered by a ``length``-byte string that also starts earlier (in a row with
a smaller id, or earlier in the same row) is found and can be removed.

A suffix array by bucket pointers starts from buckets of equal q-grams and refines a
bucket by sorting it on the buckets of later offsets; refined pointers are used again
for longer prefixes.  Here the pointer of a bucket is a 64-bit name that follows
from the pointers of its halves, ``name(p, 2d) = f(name(p, d), name(p + d, d))``, so all
executors name equal buckets alike without a global sort, and each refinement
reuses the one before it: 1, 2, 4, ... 32 bytes, then 100 = 32 + 32 + 32 + 4.

Only few suffixes need to be refined to the end:

1. The *initial bucket* of a suffix is the smallest GRAM-byte bucket name among the
   offsets that its ``length`` bytes hold.  Equal strings have equal initial buckets, and
   neighbours mostly share one, so a row has a run of suffixes for about 27 bytes.
2. Runs whose initial bucket occurs once in the corpus hold no repeat and leave.
3. Runs with the same bytes are one run: all but those of the smallest id are
   covered as a whole.
4. Where an initial bucket has different runs, their suffixes are refined to the full
   length: small buckets in memory, large ones as rows of a shuffled aggregate.

Repeats within a row are found while the row is read.  No group is gathered in one
task: buckets are aggregated before the shuffle, joins on them are ones whose hot
keys Spark splits, and what a row gathers is a set of places in its own text, however often the row is repeated.

What names may confuse: step 4 compares the bytes where a bucket fits in memory, and 128-bit names where it
doesn't.  Steps 2 and 3 and the repeats within a row go by 64-bit names, step 3 by those of whole runs in one bucket: two
different runs of one bucket are taken for one with a probability of 2^-64, so for n different runs in a
bucket n^2 / 2^65.  A text that isn't made to collide meets no such pair.

Defined results: null texts count as empty; texts shorter than ``length`` have no repeat
across rows or in themselves; rows that share an id are of equal rank, so neither
is the earlier one; a null id is smaller than any other; an empty table gives an
empty result; other columns can have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import apart, drop_path, dropped_after, in_arrow, shared_path, stored

GRAM, SPLIT, CHUNK = 48, 64, 1 << 18
_ODD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)
_FIRST = np.random.default_rng(2007).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of buckets from the names of their halves."""
    x = a * _ODD
    x += b
    x ^= x >> _SHIFT
    x *= _ODD
    return x


class Buckets:
    """Bucket names of all suffixes of a buffer, for prefixes of 1, 2, 4, ... bytes."""

    def __init__(self, data: np.ndarray):
        at, width = _FIRST[data], 1
        self.names = {1: at}
        while width * 2 <= GRAM and len(at) > width:
            at = _name(at[:-width], at[width:])
            width *= 2
            self.names[width] = at
        self.widest = width

    def refined(self, at: np.ndarray, length: int) -> np.ndarray:
        """Names for prefixes of ``length`` bytes of the suffixes ``at``."""
        found, done = None, 0
        while done < length:
            width = min(self.widest, 1 << (length - done).bit_length() - 1)
            part = self.names[width][at + done]
            found = part if found is None else _name(found, part)
            done += width
        return found

    def grams(self) -> np.ndarray:
        """Names of the GRAM-byte prefixes of all suffixes that have as many bytes."""
        found, done = self.names[self.widest], self.widest
        while done < GRAM:
            width = 1 << (GRAM - done).bit_length() - 1
            found = _name(found[: len(found) - width], self.names[width][done:])
            done += width
        return found

    def smallest(self, grams: np.ndarray, length: int) -> np.ndarray:
        """Initial bucket of each suffix that has ``length`` bytes."""
        low, width, all_ = grams, 1, length - GRAM + 1
        while width * 2 <= all_:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        return np.minimum(low[: len(low) - (all_ - width)], low[all_ - width :]) if width < all_ else low


def _spread(first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """first[0] .. first[0] + many[0] - 1, first[1] ..."""
    ends = np.cumsum(many)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many) + np.repeat(first, many)


def _intervals(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and count of each run of consecutive numbers in sorted ``at``."""
    cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1] + 1))) if len(at) else np.zeros(0, np.int64)
    return at[cut], np.diff(np.append(cut, len(at)))


def runs_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, start, count, bucket, name) of the runs of each text, and (text, start,
    count) of the suffixes whose string starts earlier in the same text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(texts), np.uint8)
    buckets = Buckets(data)
    grams = buckets.grams()
    low = buckets.smallest(grams, length)
    n = len(low)
    cut = np.empty(n, bool)
    cut[0] = True
    np.not_equal(low[1:], low[:-1], out=cut[1:])
    stop = ends - (length - 1)  # from here on a suffix of this text is too short
    cut[begins[begins < n]] = True
    cut[stop[stop < n]] = True
    start = np.flatnonzero(cut)
    count = np.diff(np.append(start, n))
    text = np.searchsorted(begins, start, "right") - 1
    good = start < stop[text]
    start, count, text = start[good], count[good], text[good]
    bucket = low[start]

    # A bucket's gram occurs twice in a run if a suffix starts with it and the run goes on.
    twice = np.zeros(len(start), bool)
    heads = np.flatnonzero(grams[:n] == low)
    run = np.searchsorted(start, heads, "right") - 1
    inside = (run >= 0) & (heads < start[run] + count[run] - 1)
    twice[run[inside]] = True
    order = np.lexsort((bucket, text))
    same = (bucket[order][1:] == bucket[order][:-1]) & (text[order][1:] == text[order][:-1])
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = _spread(start[twice], count[twice])
    of = np.repeat(text[twice], count[twice])
    name = buckets.refined(at, length)
    order = np.lexsort((at, name, of))
    later = (name[order][1:] == name[order][:-1]) & (of[order][1:] == of[order][:-1])
    again = np.sort(at[order[1:][later]])
    own_start, own_count = _intervals(again)
    own_text = np.searchsorted(begins, own_start, "right") - 1

    pieces = -(-count // SPLIT)
    base = np.repeat(start, pieces)
    piece = _spread(np.zeros(len(start), np.int64), pieces) * SPLIT
    whole = np.repeat(count, pieces)
    text, bucket = np.repeat(text, pieces), np.repeat(bucket, pieces)
    start, count = base + piece, np.minimum(SPLIT, whole - piece)
    name = _name(buckets.refined(start, length), buckets.refined(start + count - 1, length)) + count.astype(np.uint64)
    return text, start - begins[text], count, bucket, name, own_text, own_start - begins[own_text], own_count


def late_suffixes(data: np.ndarray, at: np.ndarray, owner: np.ndarray, name: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes ``at`` have their first ``length`` bytes in common with one of a smaller owner.

    Suffixes of one name are compared with the one of the smallest owner, byte by byte; a name
    under which different strings meet is refined by the strings themselves.
    """
    if not len(at):
        return np.zeros(0, bool)
    order = np.lexsort((owner, name))
    new = np.concatenate(([True], name[order][1:] != name[order][:-1]))
    group = np.cumsum(new) - 1
    head = order[np.flatnonzero(new)][group]  # the suffix of the smallest owner
    late = np.zeros(len(at), bool)
    late[order] = owner[order] > owner[head]
    mixed = np.zeros(int(group[-1]) + 1, bool)
    span, check = np.arange(length), np.flatnonzero(order != head)
    for k in range(0, len(check), CHUNK // length + 1):
        rows = check[k : k + CHUNK // length + 1]
        differ = (data[at[order[rows]][:, None] + span] != data[at[head[rows]][:, None] + span]).any(1)
        mixed[group[rows[differ]]] = True
    lowest: dict[bytes, int] = {}
    again = order[mixed[group]]
    strings = [data[at[i] : at[i] + length].tobytes() for i in again]
    for i, string in zip(again, strings, strict=True):
        lowest[string] = min(lowest.get(string, owner[i]), owner[i])
    for i, string in zip(again, strings, strict=True):
        late[i] = owner[i] > lowest[string]
    return late


def _chunks(texts: list[bytes], length: int) -> Iterator[list[int]]:
    """Numbers of the texts that are long enough, in chunks of about CHUNK bytes."""
    held, size = [], 0
    for k, t in enumerate(texts):
        if len(t) >= length:
            held.append(k)
            size += len(t)
            if size >= CHUNK:
                yield held
                held, size = [], 0
    if held:
        yield held


def _rows(docs: DataFrame, id_col: str, text_col: str, keep: list[str] = (), *, marked: bool = True) -> DataFrame:
    """(id, mark, t[, row]); the mark tells rows of one id apart, and is 0 if ids are unique."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    own = [F.struct(*[F.col(c) for c in keep]).alias("row")] if keep else []
    return docs.select(key.alias("id"), (F.xxhash64(text) if marked else F.lit(0).cast("long")).alias("mark"), text.alias("t"), *own)


def _ids_repeat(docs: DataFrame, id_col: str) -> bool:
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    return not docs.groupBy(key.alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def covered(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100, marked: bool = True, bucket_runs: int = 1000, task_bytes: int = 8 << 20) -> DataFrame:
    """(id, mark, start, count): suffixes whose first ``length`` bytes, GRAM or more, start earlier."""
    if length < GRAM:
        raise ValueError(f"repeats of fewer than {GRAM} bytes aren't looked for")
    spark = docs.sparkSession
    source = _rows(docs, id_col, text_col, marked=marked)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, marks = b.column(0).to_numpy(), b.column(1).to_numpy()
            texts = b.column(2).to_pylist()
            for chosen in _chunks(texts, length):
                text, start, count, bucket, name, own_text, own_start, own_count = runs_of([texts[k] for k in chosen], length)
                pick = np.array(chosen)[np.concatenate((text, own_text))]
                zero = np.zeros(len(own_text), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[pick]),
                        pa.array(marks[pick]),
                        pa.array(np.concatenate((start, own_start)).astype(np.int32)),
                        pa.array(np.concatenate((count, own_count)).astype(np.int32)),
                        pa.array(np.concatenate((bucket.view(np.int64), zero))),
                        pa.array(np.concatenate((name.view(np.int64), zero))),
                        pa.array(np.concatenate((np.zeros(len(text), bool), np.ones(len(own_text), bool)))),
                    ],
                    ["id", "mark", "start", "count", "bucket", "name", "own"],
                )

    path = shared_path(spark, "runs")
    runs = stored(in_arrow(source, find, "id long, mark long, start int, count int, bucket long, name long, own boolean"), "runs", path)
    across = runs.where(~F.col("own")).drop("own")
    shared = stored(across.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("bucket"), "shared-buckets")
    # Runs in buckets that occur again; hot buckets are split by the join.
    again_path = shared_path(spark, "repeated-runs")
    again = stored(across.join(shared, "bucket"), "repeated-runs", again_path)
    own = stored(runs.where("own").select("id", "mark", "start", "count"), "own-repeats")
    drop_path(spark, path)
    first = again.groupBy("bucket", "name").agg(F.min("id").alias("first"))
    first = stored(first, "first-runs")
    several = first.groupBy("bucket").agg((F.count(F.lit(1)) > 1).alias("mixed")).select(apart(F.col("bucket")).alias("bucket"), "mixed")
    first = first.join(several, "bucket")
    judged = again.join(first, ["bucket", "name"]).select("bucket", "id", "mark", "start", "count", "mixed", (F.col("id") > F.col("first")).alias("later"))
    judged = stored(judged.where("mixed or later"), "judged-runs")
    drop_path(spark, again_path)
    whole = judged.where("later").select("id", "mark", "start", "count")

    # The bytes of the first run of each name in buckets with several names.
    wanted = judged.where("mixed and not later").groupBy("id", "mark").agg(F.collect_set(F.struct("bucket", "start", "count")).alias("runs"))
    joined = source.join(wanted, ["id", "mark"]).select("id", "mark", "t", F.explode("runs").alias("run"))
    detail = joined.select("run.bucket", "id", "mark", "run.start", F.substring(F.col("t"), F.col("run.start") + 1, F.col("run.count") + (length - 1)).alias("bytes"))
    detail = stored(detail, "open-runs")
    sizes = detail.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("bytes")).alias("size"))
    large = stored(sizes.where(F.col("n") > bucket_runs).select("bucket"), "large-buckets")
    total = detail.agg(F.sum(F.octet_length("bytes"))).head()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // task_bytes))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [b for b in batches if b.num_rows]
        if not found:
            return
        held = pa.Table.from_batches(found).combine_chunks()
        texts = held.column("bytes").to_pylist()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        count = sizes - (length - 1)
        ids, begins = held.column("id").to_numpy(), np.cumsum(sizes) - sizes
        data, at = np.frombuffer(b"".join(texts), np.uint8), _spread(begins, count)
        late = late_suffixes(data, at, np.repeat(ids, count), Buckets(data).refined(at, length), length)
        # Numbered with a hole after each run, so that no interval spans two.
        place = np.flatnonzero(late)
        run = np.repeat(np.arange(len(count)), count)[place]
        first, many = _intervals(place + run)
        run = run[np.searchsorted(place + run, first)]
        start = first - run - (np.cumsum(count) - count)[run] + held.column("start").to_numpy()[run]
        yield pa.RecordBatch.from_arrays([pa.array(ids[run]), pa.array(held.column("mark").to_numpy()[run]), pa.array(start.astype(np.int32)), pa.array(many.astype(np.int32))], ["id", "mark", "start", "count"])

    small = in_arrow(detail.join(large, "bucket", "left_anti").repartition(parts, "bucket"), settle, "id long, mark long, start int, count int")
    # Buckets too large for a task: one row a suffix, aggregated before the shuffle.
    wide = detail.join(large, "bucket", "left_semi")
    rows = wide.select("bucket", "id", "mark", "start", "bytes", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - length)).alias("k"))
    rows = rows.select("bucket", "id", "mark", (F.col("start") + F.col("k")).alias("start"), F.substr(F.col("bytes"), F.col("k") + 1, F.lit(length)).alias("s"))
    rows = rows.select("bucket", "id", "mark", "start", F.xxhash64("s").alias("name"), F.xxhash64(F.lit(1), "s").alias("more"))  # 128 bits
    lowest = rows.groupBy("bucket", "name", "more").agg(F.min("id").alias("lowest")).select(apart(F.col("bucket")).alias("bucket"), "name", "more", "lowest")
    late = rows.join(lowest, ["bucket", "name", "more"]).where(F.col("id") > F.col("lowest")).select("id", "mark", "start", F.lit(1).alias("count"))
    return own.unionByName(whole).unionByName(stored(small, "settled")).unionByName(stored(late, "settled-wide"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100, keep: list[str] | None = None, kept_text: bool = True) -> DataFrame:
    """The columns ``keep`` (default: all but the text), then n_bytes, n_removed, n_spans,
    kept_sha256 and, if ``kept_text``, the remaining bytes as ``kept``."""
    keep = [c for c in docs.columns if c != text_col] if keep is None else keep
    marked = _ids_repeat(docs, id_col)
    with dropped_after(docs.sparkSession):  # the runs aren't read once what is covered is written
        found = covered(docs, id_col=id_col, text_col=text_col, length=length, marked=marked)
        lists = found.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "count")).alias("s"))  # a set: rows that share id and text find the same
        lists = lists.select("id", "mark", F.col("s.start").alias("starts"), F.col("s.count").alias("counts"))
        lists = stored(lists, "covered", shared_path(docs.sparkSession, "covered"))
    rows = _rows(docs, id_col, text_col, keep, marked=marked).join(lists, ["id", "mark"], "left").select("row", "t", "starts", "counts")
    names = ["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * kept_text]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, cell in enumerate(b.column(1)):
                text = cell.as_py()
                starts = b.column(2)[k].values
                removed = spans = 0
                rest = text
                if starts is not None and len(starts):
                    at, many = starts.to_numpy().astype(np.int64), b.column(3)[k].values.to_numpy().astype(np.int64)
                    step = np.zeros(len(text) + 1, np.int32)
                    np.add.at(step, at, 1)
                    np.add.at(step, at + many + length - 1, -1)
                    gone = np.cumsum(step)[:-1] > 0
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((len(text), removed, spans, hashlib.sha256(rest).hexdigest(), rest))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            arrays = [pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.string())]
            if kept_text:
                arrays.append(pa.array(cols[4], pa.binary()))
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays], names)

    schema = rows.select("row").withColumns({"n_bytes": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "n_spans": F.lit(0).cast("long"), "kept_sha256": F.lit("")} | ({"kept": F.lit(b"")} if kept_text else {})).schema
    done = in_arrow(rows, cut, schema)
    return done.select(*[F.col("row")[c].alias(c) for c in keep], *names[1:])
