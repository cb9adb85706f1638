"""Packing by patterns: non-negative least squares over the length histogram.

Token lengths up to ``max_len`` fall into at most ``bins`` bins: each length by itself where there are few, else of equal
numbers of tokens.  A pattern is a few pieces, or bundles of short ones, of these bins whose lengths fit into a sequence; non-negative least squares finds how
often each should be repeated so that together they use up the histogram in no more sequences than its tokens
need, and the counts are rounded down.  A pattern is then filled with real lengths: the largest of each bin that leave room for the rest,
and for its last place the largest that still fits.  Whatever is left goes best-fit into the gaps and into new sequences.

Both steps work on (length, count), not on documents: the driver holds at most
``max_len`` lengths and a plan whose rows follow from the lengths and patterns, however many
documents there are.  A piece finds its sequence from its rank among the pieces of
its length; ranks come from counts per salted group, so no length, however
common, meets in one task.

Defined results: a null text counts as empty and is the end token alone; equal rows
are packed once each, rows without an id or with a repeated one like any other; an empty table packs into no sequence; other
columns are not read, so their names can't clash.  The vocabulary is a file of the driver's and goes to the executors with the application.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.common import in_arrow, stored
from quarry.session import sent_file

#: Bytes of memory for the parts that a worker remembers unless a caller says otherwise, what each costs beside its bytes, and the longest that is remembered.
CACHE_BYTES, PART_BYTES, LONGEST = 64 << 20, 200, 64

#: Shares of the fitted repeats that are tried, what best fit alone has to spare to be taken instead, and pairs of last lengths that are tried.
SHARES, LOSS, TRIED = (1.0, 0.9, 0.6), 0.002, 32

_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
_TAIL = re.compile(rb"([a-z]+)([!-&(-/:-@\[-`{-~]+)").fullmatch


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    return {b: chr(b) for b in kept} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(kept)))}


class WordCoder(dict):
    """Ids (little-endian unsigned 32-bit) of what stands between ASCII white space.

    The vocabulary's rules never cross white space and fold case, so a text's ids
    are those of its parts in order.  Plain words go straight to the vocabulary's
    merges; any other part through the whole tokenizer.  Parts of up to
    LONGEST bytes are remembered, ``cache_bytes`` of them in two generations: when the younger one is full it becomes the older one, and what
    is used again comes back from there.  A longer part, as in texts without blanks, is coded each time.  Special tokens are found first, in the text as it stands, as the
    tokenizer does it; they cut the text, and what lies between them is coded as above.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        super().__init__()
        self.held, self.older, self.most = 0, {}, cache_bytes
        self.plain = Tokenizer.from_file(path)
        self.merge, self.symbols = self.plain.model.tokenize, byte_symbols()
        self.special = {t.content.encode(): np.array([i], "<u4").tobytes() for i, t in self.plain.get_added_tokens_decoder().items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")").split if longest_first else lambda text: [text]
        self.plain.encode_special_tokens = True  # what a lower-cased part may look like without being that token

    def __missing__(self, part: bytes) -> bytes:
        if (known := self.older.get(part)) is not None:
            return self._kept(part, known)
        if _PLAIN(part):
            word = part.decode() if part.isascii() else part.decode().lower().encode().decode("latin-1").translate(self.symbols)
            ids = [t.id for t in self.merge(word)]
        elif end := _TAIL(part):
            return self._kept(part, self[end[1]] + self[end[2]])
        else:
            ids = self.plain.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids
        return self._kept(part, np.array(ids, "<u4").tobytes())

    def _kept(self, part: bytes, ids: bytes) -> bytes:
        if len(part) <= LONGEST:
            if self.held > self.most // 2:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[part] = ids
            self.held += len(part) + len(ids) + PART_BYTES
        return ids

    def encode(self, text: bytes) -> bytes:
        out, code = [], self.__getitem__
        for k, part in enumerate(self.cut(text)):
            if k % 2:
                out.append(self.special[part])
            else:
                out.extend(map(code, part.lower().split()))
        return b"".join(out)


_coders: dict[tuple[str, int], WordCoder] = {}


def coder(path: str, cache_bytes: int = CACHE_BYTES) -> WordCoder:
    """One coder for each worker and vocabulary, kept over its tasks."""
    if (path, cache_bytes) not in _coders:
        _coders[path, cache_bytes] = WordCoder(path, cache_bytes)
    return _coders[path, cache_bytes]


def pieces(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", max_len: int = 4096, end_id: int = 1, with_ids: bool = False, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) in pieces of at most ``max_len``.

    ``cache_bytes`` is the memory a worker has for parts that it has coded before: more of it saves CPU time.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    name = sent_file(docs.sparkSession, vocabulary)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(SparkFiles.get(name), cache_bytes).encode
        for b in batches:
            out = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids = encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * max_len)):
                    part = ids[at : at + 4 * max_len]
                    out.append((key, k, at // 4, len(part) // 4, zlib.crc32(part), part))
            cols = list(zip(*out, strict=True)) or [[]] * 6
            arrays = [pa.array(c, pa.int64()) for c in cols[:5]]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in cols[5]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    return in_arrow(rows, run, "id long, piece long, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


def length_bins(counts: dict[int, int], bins: int) -> list[tuple[int, int]]:
    """(smallest, largest) length of at most ``bins`` bins: each length by itself where there are so few, else of about equal numbers of tokens."""
    sizes = sorted(counts)
    if len(sizes) <= bins:
        return [(n, n) for n in sizes]
    tokens = np.cumsum([n * counts[n] for n in sizes], dtype=np.float64)
    of = np.minimum((tokens - tokens[0] / 2) / tokens[-1] * bins, bins - 1).astype(int)
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    return [(sizes[a], sizes[b - 1]) for a, b in zip(first, np.append(first[1:], len(sizes)), strict=True)]


def patterns(means: list[float], max_len: int, depth: int) -> list[tuple[tuple[int, int], ...]]:
    """Patterns of (bin, how many) whose mean lengths fit into ``max_len``, the longest part first.

    A part is a piece, or a bundle of short pieces of a bin that fills a quarter of a sequence, a half, three quarters or all of it, so few parts fill a
    sequence whatever the lengths are.  All choices of parts but the last are tried, and the last is the longest that still fits.
    """
    parts = {(b, 1): m for b, m in enumerate(means)}
    for b, m in enumerate(means):
        if 8 * m <= max_len:
            parts |= {(b, int(q * max_len / 4 / m)): int(q * max_len / 4 / m) * m for q in (1, 2, 3, 4)}
    order = sorted(parts, key=lambda p: (parts[p], p))
    sizes = [parts[p] for p in order]
    found: set[tuple[tuple[int, int], ...]] = set()

    def grow(head: tuple[int, ...], left: float, deep: int) -> None:
        at = min(bisect_right(sizes, left), head[-1] + 1 if head else len(sizes)) - 1  # the longest that fits, no longer than the part before
        if at < 0 or len(head) >= depth:
            if head:
                found.add(tuple(order[k] for k in head))
            return
        grow((*head, at), left - sizes[at], deep)
        if len(head) < deep:
            for k in range(at):
                grow((*head, k), left - sizes[k], deep)

    # Two parts are chosen freely among all, three among the longer ones, which are few.
    grow((), max_len, 2)
    return sorted(found, key=lambda p: [-parts[x] for x in p])


def nnls(a: np.ndarray, y: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Non-negative least squares by active sets."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    for _ in range(rounds):
        slope = a.T @ (y - a @ x)
        slope[active] = -np.inf
        best = int(slope.argmax())
        if slope[best] <= 1e-9 * max(1.0, float(np.abs(y).max())):
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            fit = np.linalg.lstsq(a[:, on], y, rcond=None)[0]
            if (fit > 0).all():
                x[:] = 0
                x[on] = fit
                break
            bad = fit <= 0
            ratio = x[on][bad] / np.maximum(x[on][bad] - fit[bad], 1e-300)
            x[on] += ratio.min() * (fit - x[on])
            drop = on[bad & (x[on] <= 1e-9)]
            active[drop] = False
            x[drop] = 0
            if not len(drop):
                active[on[bad][ratio.argmin()]] = False
    return x


class Plan:
    """Rows (length, first rank, how many, first sequence, offset), by patterns and then by best fit; ``by_pattern`` sequences began as patterns.

    ``share`` of the fitted repeats are filled, and best fit closes their gaps with the rest; without it those of SHARES that take the fewest sequences.  Best
    fit alone is taken where that spares more than LOSS of the sequences, as it can on a handful of pieces.
    """

    def __init__(self, counts: dict[int, int], max_len: int = 4096, bins: int = 40, depth: int = 6, *, share: float | None = None):
        self.max_len, self.rows, self.sequences, self.by_pattern = max_len, [], 0, 0
        self.left = {n: c for n, c in counts.items() if c > 0}
        self.used = dict.fromkeys(self.left, 0)
        self.sizes = sorted(self.left)  # lengths that still have pieces
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, how many)
        self.open: list[int] = []
        if share is None:
            best = min((Plan(counts, max_len, bins, depth, share=s) for s in SHARES), key=lambda p: p.sequences)
            if best.sequences > -(-sum(n * c for n, c in self.left.items()) // max_len):
                plain = Plan(counts, max_len, share=0.0)
                best = plain if plain.sequences < (1 - LOSS) * best.sequences else best
            self.__dict__.update(best.__dict__)
            return
        if share and self.left:
            self.by_pattern = self._patterns(bins, depth, share)
        self._rest()

    def _take(self, length: int, many: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.used[length], many, sequence, offset))
        self.used[length] += many
        self.left[length] -= many
        if not self.left[length]:
            del self.sizes[bisect_left(self.sizes, length)]

    def _free(self, gap: int, sequence: int, many: int) -> None:
        if gap and many:
            if gap not in self.gaps:
                self.gaps[gap] = []
                insort(self.open, gap)
            self.gaps[gap].append((sequence, many))

    def _largest(self, low: int, high: int) -> int | None:
        at = bisect_left(self.sizes, high + 1) - 1
        return self.sizes[at] if at >= 0 and self.sizes[at] >= low else None

    def _patterns(self, bins: int, depth: int, share: float) -> int:
        """Sequences started by patterns."""
        edges = length_bins(self.left, bins)
        own = [[n for n in self.sizes if low <= n <= high] for low, high in edges]
        tall = np.array([sum(self.left[n] for n in ns) for ns in own], np.float64)
        means = [sum(n * self.left[n] for n in ns) / t for ns, t in zip(own, tall, strict=True)]
        known = patterns(means, self.max_len, depth)
        shape = np.zeros((len(edges) + 1, len(known)))
        for k, p in enumerate(known):
            for b, many in p:
                shape[b, k] += many
        # In sequences: a missed piece weighs its tokens, and there shall be no more sequences than the tokens need.
        weight = np.array(means) / self.max_len
        shape[:-1] *= weight[:, None]
        shape[-1] = 1.0
        times = np.floor(share * nnls(shape, np.append(tall * weight, (tall * weight).sum())) + 1e-6).astype(int)
        for k in np.flatnonzero(times):
            self._filled(known[k], edges, means, int(times[k]))
        return self.sequences

    def _filled(self, pattern: tuple[tuple[int, int], ...], edges: list[tuple[int, int]], means: list[float], todo: int) -> None:
        """The pattern with real lengths, ``todo`` times or as long as there are pieces for it.

        A place gets the largest of its bin that leaves the others their means, else the next larger one that leaves them their least, else
        what is smaller; the last place the largest that fits.
        """
        places = [b for b, many in pattern for _ in range(many)]
        while todo > 0:
            spot, want, taken = 0, {}, []
            rest_low, rest_mean = sum(edges[b][0] for b in places), sum(means[b] for b in places)
            for at, b in enumerate(places):
                low, high = edges[b]
                rest_low, rest_mean = rest_low - low, rest_mean - means[b]
                room = self.max_len - spot
                most, wish = min(high, room - rest_low), int(room - rest_mean + 1e-6)
                if at == len(places) - 1:
                    n = self._free_below(1, room, want)
                elif at == len(places) - 2:
                    n = self._tightest(low, high, room, want)
                else:
                    n = self._free_below(low, min(most, wish), want)
                    n = self._free_above(max(low, wish + 1), most, want) if n is None else n
                    n = self._free_below(1, min(most, low - 1), want) if n is None else n
                if n is not None:
                    taken.append((n, spot))
                    want[n] = want.get(n, 0) + 1
                    spot += n
            if not taken or 2 * len(taken) < len(places):
                return  # best fit takes it from here
            many = min(todo, *(self.left[n] // c for n, c in want.items()))
            for n, at in taken:
                self._take(n, many, self.sequences, at)
            self._free(self.max_len - spot, self.sequences, many)
            self.sequences += many
            todo -= many

    def _tightest(self, low: int, high: int, room: int, want: dict[int, int]) -> int | None:
        """Of TRIED lengths of the bin, the one with which the last place leaves the smallest gap."""
        best, least, n = None, room + 1, self._free_below(low, min(high, room), want)
        for _ in range(TRIED):
            if n is None or not least:
                break
            last = self._free_below(1, room - n, want | {n: want.get(n, 0) + 1})
            if room - n - (last or 0) < least:
                best, least = n, room - n - (last or 0)
            n = self._free_below(low, n - 1, want)
        return best

    def _free_below(self, low: int, high: int, want: dict[int, int]) -> int | None:
        """The largest length from ``low`` to ``high`` that has a piece beside those wanted."""
        n = self._largest(low, high)
        while n is not None and self.left[n] <= want.get(n, 0):
            n = self._largest(low, n - 1)
        return n

    def _free_above(self, low: int, high: int, want: dict[int, int]) -> int | None:
        """The smallest one."""
        at = bisect_left(self.sizes, low)
        while at < len(self.sizes) and self.sizes[at] <= high:
            n = self.sizes[at]
            if self.left[n] > want.get(n, 0):
                return n
            at += 1
        return None

    def _rest(self) -> None:
        """Best fit, longest first, into gaps and then into new sequences."""
        while self.sizes:
            n = self.sizes[-1]
            at = bisect_left(self.open, n)
            if at < len(self.open):
                gap = self.open[at]
                sequence, many = self.gaps[gap].pop()
                if not self.gaps[gap]:
                    del self.gaps[gap], self.open[at]
                fill = min(many, self.left[n])
                self._take(n, fill, sequence, self.max_len - gap)
                self._free(gap - n, sequence, fill)
                self._free(gap, sequence + fill, many - fill)
                continue
            each = self.max_len // n
            many, one = divmod(self.left[n], each)
            for count, places in ((many, each), (1 if one else 0, one)):
                if count:
                    for k in range(places):
                        self._take(n, count, self.sequences, k * n)
                    self._free(self.max_len - places * n, self.sequences, count)
                    self.sequences += count


def pack(cut: DataFrame, *, max_len: int = 4096, bins: int = 40, depth: int = 6, group_rows: int = 1000) -> DataFrame:
    """``cut`` (a stored table with a column length and a unique ``uid``) with
    sequence_id and offset."""
    spark = cut.sparkSession
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most max_len rows
    plan = Plan(counts, max_len, bins, depth)
    rows = np.array(sorted(plan.rows) or [(0, 0, 0, 0, 0)], np.int64)
    salts = spark.createDataFrame([(n, -(-c // group_rows)) for n, c in counts.items()], "length long, _salts long")  # at most max_len rows
    salted = cut.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64("uid"), "_salts")).drop("_salts")
    tally = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    tally = tally.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("uid")) - 1
    ranked = salted.withColumn("_within", within).join(tally, ["length", "_salt"])
    ranked = ranked.select(*cut.columns, (F.col("_before") + F.col("_within")).cast("long").alias("_rank"))
    held = spark.sparkContext.broadcast(rows)  # rows follow from lengths and patterns, not from documents
    names = [*cut.columns, "sequence_id", "offset"]
    at_length, at_rank = ranked.columns.index("length"), len(ranked.columns) - 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        starts = (table[:, 0] << 44) + table[:, 1]
        for b in batches:
            length, rank = b.column(at_length).to_numpy(), b.column(at_rank).to_numpy()
            row = table[np.searchsorted(starts, (length << 44) + rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], names)

    schema = cut.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long")).schema
    return in_arrow(ranked, place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", max_len: int = 4096, end_id: int = 1, bins: int = 40, depth: int = 6, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row a piece."""
    cut = pieces(docs, vocabulary, id_col=id_col, text_col=text_col, max_len=max_len, end_id=end_id, cache_bytes=cache_bytes)
    cut = stored(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    packed = pack(cut, max_len=max_len, bins=bins, depth=depth)
    return packed.select(F.col("id").alias(id_col), F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def efficiency(packed: DataFrame, max_len: int = 4096) -> DataFrame:
    """One row: sequences, the least number possible for the tokens, share filled."""
    sums = packed.agg(F.countDistinct("sequence_id").alias("sequences"), F.sum("length").alias("tokens"))
    return sums.select("sequences", F.ceil(F.col("tokens") / max_len).alias("least"), (F.col("tokens") / (F.col("sequences") * max_len)).alias("filled"))


__all__ = ["Plan", "WordCoder", "coder", "efficiency", "length_bins", "nnls", "pack", "pack_documents", "patterns", "pieces"]
