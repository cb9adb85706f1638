"""Benchmark decontamination: shared n-grams give candidates, matching blocks verify.

Tokens are words or the ids of a subword tokenizer.  N-grams are rolling 64-bit hashes over tokens, made in Arrow batches where
the tokens are; a Bloom filter of the benchmarks' grams drops nearly all of them there, and only what it lets through becomes a
row, with its gram in full, so that a collision makes no pair.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast, SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.text import lazy_udf
from quarry.model import strip
from quarry.operators.blocks import Benchmark
from quarry.session import in_arrow, sent_file, ship, spread, stored
from quarry.sources.io import cached

Tokeniser = Callable[[Column], Column]


def words(text: Column) -> Column:
    """Default tokens: lower-cased, split at white space."""
    return F.array_remove(F.split(F.lower(strip(text)), r"\s+"), "")


#: Texts that are encoded at a time: a tokenizer's answer has over a hundred bytes a token beside the ids.
ENCODED = 32


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # their strings in a text are ordinary text
    return made


@cache
def token_bytes(path: str) -> list[bytes] | None:
    """The bytes of each id of a tokenizer file, if the bytes of any text are those of its ids in order; else None."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    first, model = said.get("pre_tokenizer") or {}, said["model"]
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]  # bytes that byte-level vocabularies write as they are
    symbols = {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(kept)))}
    whole = first.get("type") == "ByteLevel" and not first.get("add_prefix_space", True) and model.get("type") == "BPE" and symbols.keys() <= model["vocab"].keys()
    changed = [said.get(k) for k in ("normalizer", "truncation", "padding")] + [model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix")]
    if not whole or any(changed) or not all(t["special"] for t in said.get("added_tokens") or []):
        return None
    out = [b""] * (max(model["vocab"].values()) + 1)
    for token, i in model["vocab"].items():
        out[i] = bytes(symbols[c] for c in token) if symbols.keys() >= set(token) else b""
    return out


def subwords(path: str) -> Tokeniser:
    """Tokens by a tokenizer file: its ids, without special tokens.

    The file goes to the executors with the application, which needn't share the driver's disk.  ``bytes_of`` of the tokeniser gives
    the bytes of its ids to executors; it is None where a text's bytes aren't those of its ids.
    """
    name = os.path.basename(path)

    def ids(texts: pd.Series) -> pd.Series:
        encode, out = _tokenizer(SparkFiles.get(name)).encode_batch, []
        for at in range(0, len(texts), ENCODED):
            some = texts.iloc[at : at + ENCODED]
            found = encode([t or "" for t in some], add_special_tokens=False)
            out += [None if t is None else np.array(e.ids, np.int32) for t, e in zip(some, found, strict=True)]
        return pd.Series(out, dtype=object)

    made = lazy_udf("array<int>", own_step=True)(ids)

    def column(text: Column) -> Column:
        sent_file(SparkSession.active(), path)
        return made(text)

    column.bytes_of = (lambda: token_bytes(SparkFiles.get(name))) if token_bytes(path) else None
    return column


def ngrams(tokens: Column, n: int, last: bool = False) -> Column:
    """Distinct n-grams; without ``last`` the final one is left out, so that n tokens give none."""
    most = F.size(tokens) - n + (1 if last else 0)
    found = F.transform(F.sequence(F.lit(1), most), lambda i: F.array_join(F.slice(tokens, i, F.lit(n)), " "))
    return F.when(most > 0, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


#: Grams, each about a hundred bytes, that are sent to all tasks; bits of a filter (64 MB), and those for each gram it holds.
MOST_ROWS, MOST_BITS, GRAM_BITS, PROBES = 500_000, 1 << 29, 16, 4
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _codes(tokens: pa.Array) -> np.ndarray:
    """A 64-bit number for each token: of a word its hash, computed once for each word of the batch."""
    if pa.types.is_integer(tokens.type):
        return tokens.to_numpy(zero_copy_only=False).astype(np.uint64)
    known = tokens.dictionary_encode()
    named = np.array([xxhash.xxh64_intdigest(w.encode()) for w in known.dictionary.to_pylist()] or [0], np.uint64)
    return named[known.indices.to_numpy(zero_copy_only=False)] if len(tokens) else np.zeros(0, np.uint64)


def rolling(codes: np.ndarray, sizes: np.ndarray, n: int, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, hash) of the n-grams of rows whose ``sizes`` tokens follow one another in ``codes``."""
    if len(codes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    mixed = (codes + _MIX) * _ODD
    mixed ^= mixed >> np.uint64(32)
    held = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        held *= _MIX
        held += mixed[k : k + len(held)]
    held ^= held >> np.uint64(29)
    held *= _ODD
    held ^= held >> np.uint64(32)
    row = np.repeat(np.arange(len(sizes)), sizes)[: len(held)]
    place = np.flatnonzero(np.arange(len(held)) + n + (0 if last else 1) <= np.cumsum(sizes)[row])
    return row[place], place, held[place]


def _probes(hashes: np.ndarray, bits: int, probes: int = PROBES) -> Iterator[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    for k in range(probes):
        yield (hashes + np.uint64(k) * step) & np.uint64(bits - 1)


def maybe_in(hashes: np.ndarray, bloom: np.ndarray, probes: int = PROBES) -> np.ndarray:
    """Which hashes the filter, an array of 64-bit numbers, may hold: all that it holds and few others."""
    found = np.ones(len(hashes), bool)
    for at in _probes(hashes, len(bloom) * 64, probes):
        found &= (bloom[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found


def _windows(b: pa.RecordBatch, n: int, last: bool) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The tokens of a batch's last column, and its n-grams as (row, place, hash)."""
    cells = b.column(b.num_columns - 1)
    tokens, sizes = cells.flatten(), cells.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return tokens, *rolling(_codes(tokens), sizes, n, last)


def _grams(df: DataFrame, keys: list[str], n: int, last: bool, tokenise: Tokeniser, known: Broadcast | None = None) -> DataFrame:
    """(keys, gram, h): the distinct n-grams of each row that ``known`` may hold."""
    rows = df.select(*keys, tokenise(F.col("text")).alias("tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens, row, place, held = _windows(b, n, last)
            if known is not None:
                keep = maybe_in(held, known.value)
                row, place, held = row[keep], place[keep], held[keep]
            order = np.lexsort((place, held, row))
            row, place, held = row[order], place[order], held[order]
            new = np.concatenate(([True], (row[1:] != row[:-1]) | (held[1:] != held[:-1])))[: len(row)]
            row, place, held = row[new], place[new], held[new]
            grams = [" ".join(map(str, tokens.slice(p, n).to_pylist())) for p in place.tolist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(row)) for k in range(len(keys))), pa.array(grams, pa.string()), pa.array(held.view(np.int64))], [*keys, "gram", "h"])

    return in_arrow(rows, run, df.select(*keys, F.lit("").alias("gram"), F.lit(0).cast("long").alias("h")).schema)


def gram_filter(bench: DataFrame, *, n: int = 8, last: bool = False, tokenise: Tokeniser = words, most_bits: int = MOST_BITS) -> tuple[Broadcast, int]:
    """A Bloom filter of the n-grams of ``bench``, and at most how many it holds.

    Tasks make partial filters, whose words Spark merges by ``bit_or``.  The filter has GRAM_BITS bits a gram up to ``most_bits``, which is all that
    passes the driver; beyond that it lets more through, never less.
    """
    spark = bench.sparkSession
    rows = bench.select(tokenise(F.col("text")).alias("tokens"))
    many = rows.agg(F.sum(F.greatest(F.size("tokens") - n + int(last), F.lit(0)))).head()[0] or 0
    bits = max(64, min(most_bits, 1 << max(0, many * GRAM_BITS - 1).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, _, held = _windows(b, n, last)
            at = np.unique(np.concatenate(list(_probes(held, bits))))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "bits"])

    found = in_arrow(rows, run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bloom = np.zeros(bits // 64, np.uint64)
    bloom[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bloom), many


def bench_grams(bench: DataFrame, folder: str, name: str, tokeniser: str = "words", *, n: int = 8, last: bool = False, tokenise: Tokeniser = words) -> DataFrame:
    """(benchmark, eval_idx, gram, h) of a benchmark, kept in ``folder`` under its name, tokeniser and length."""
    return cached(bench.sparkSession, folder, lambda: _grams(bench, ["benchmark", "eval_idx"], n, last, tokenise), name, tokeniser, n)


#: Bytes at the beginning of a gram that are looked for in texts, as many as it has of these; bytes of texts that are looked at at a time.
#: A text has thousands of such stretches, and none may hit by chance: bits of the filter for each gram, and probes.
WINDOWS, BLOCK, START_BITS, START_PROBES = (8, 12, 16, 20), 1 << 15, 64, 8


def _windows_of_bytes(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each size of WINDOWS the hashes of all stretches of so many bytes."""
    four = np.zeros(max(len(data) - 3, 0), np.uint64)
    for k in range(min(4, len(four))):
        four[k::4] = data[k : k + (len(data) - k) // 4 * 4].view("<u4")
    held = four
    for size in range(8, WINDOWS[-1] + 1, 4):
        many = len(data) - size + 1
        if many <= 0:
            return
        held = (held ^ (held >> np.uint64(29)))[:many]
        held *= _ODD
        held += four[size - 4 : size - 4 + many]
        if size in WINDOWS:
            mixed = held ^ (held >> np.uint64(32))
            mixed += np.uint64(size)
            mixed *= _MIX
            mixed ^= mixed >> np.uint64(29)
            yield size, mixed


def _worth(train: DataFrame, bench: DataFrame, n: int, last: bool, tokenise: Tokeniser, many: int, most_bits: int = MOST_BITS) -> DataFrame:
    """(id, text) of the rows of ``train`` that may share a gram with ``bench``, by their bytes.

    Equal grams of ids are equal bytes, so a text that holds none of the grams' beginnings needn't be tokenized.  Beginnings are
    looked up in a Bloom filter, made as :func:`gram_filter` makes its own.  All rows stay if the ids' bytes aren't the text's or a gram is shorter than WINDOWS.
    """
    rows, bytes_of = spread(train).select("id", "text"), getattr(tokenise, "bytes_of", None)
    if bytes_of is None:
        return rows
    bits = max(64, min(most_bits, 1 << max(20, (many * START_BITS - 1).bit_length())))  # two probes' places differ in few bits where a filter is small

    def beginnings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bytes_of()
        for b in batches:
            tokens, _, place, _ = _windows(b, n, last)
            own = [known[i] for i in tokens.to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int64)
            begin, size = ends[place], ends[place + n] - ends[place]
            at = [np.zeros(0, np.uint64)]
            data = np.frombuffer(b"".join(own), np.uint8)
            fits = np.array(WINDOWS)[np.searchsorted(WINDOWS, size, "right") - 1]
            for k, held in _windows_of_bytes(data):
                at += _probes(held[begin[(fits == k) & (size >= k)]], bits, START_PROBES)
            at = np.unique(np.concatenate(at))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            value = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(word) else at
            short = [-1] * bool((size < WINDOWS[0]).any())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((word.astype(np.int64), np.array(short, np.int64)))), pa.array(np.concatenate((value.view(np.int64), np.array(short, np.int64))))], ["word", "bits"])

    found = in_arrow(bench.select(tokenise(F.col("text")).alias("tokens")), beginnings, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    word = found.column("word").to_numpy()
    if (word < 0).any():
        return rows
    bloom = np.zeros(bits // 64, np.uint64)
    bloom[word] = found.column("bits").to_numpy().view(np.uint64)
    sent = train.sparkSession.sparkContext.broadcast(bloom)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = sent.value
        for b in batches:
            texts, keep = b.column(1).cast(pa.large_binary()), np.zeros(b.num_rows, bool)
            ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
            for at in range(int(ends[0]), int(ends[-1]), BLOCK):
                for _, held in _windows_of_bytes(data[at : min(at + BLOCK + WINDOWS[-1] - 1, int(ends[-1]))]):
                    bit = held & np.uint64(bits - 1)  # the first probe, of which few are left
                    hit = np.flatnonzero((bloom[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1))
                    hit = hit[maybe_in(held[hit], bloom, START_PROBES)]
                    keep[np.searchsorted(ends[1:], hit + at, "right")] = True
            yield b.filter(pa.array(keep))

    return in_arrow(rows, run, rows.schema)


def shared_grams(train: DataFrame, bench: DataFrame, *, n: int = 8, last: bool = False, tokenise: Tokeniser = words, most_rows: int = MOST_ROWS, most_bits: int = MOST_BITS) -> DataFrame:
    """(id, benchmark, eval_idx, grams): how many distinct n-grams each pair shares.

    ``train`` has (id, text), ``bench`` (benchmark, eval_idx, text).  What the benchmarks' filter lets through meets their grams, by hash and gram: benchmarks of
    at most ``most_rows`` grams go to all tasks, of larger ones only what was let through is shuffled, never the corpus.
    """
    known, many = gram_filter(bench, n=n, last=last, tokenise=tokenise, most_bits=most_bits)
    left, right = _grams(_worth(train, bench, n, last, tokenise, many, most_bits), ["id"], n, last, tokenise, known), _grams(bench, ["benchmark", "eval_idx"], n, last, tokenise)
    met = left.join(F.broadcast(right) if many <= most_rows else right, ["h", "gram"])
    return met.groupBy("id", "benchmark", "eval_idx").agg(F.count(F.lit(1)).alias("grams"))


def candidates_only(train: DataFrame, bench: DataFrame, *, n: int = 8, last: bool = False, tokenise: Tokeniser = words, most_rows: int = MOST_ROWS) -> DataFrame:
    """Rows of ``train`` that share an n-gram with any benchmark: what the other steps need to look at."""
    known, many = gram_filter(bench, n=n, last=last, tokenise=tokenise)
    grams = _grams(bench, [], n, last, tokenise).select("h", "gram").distinct()
    met = _grams(_worth(train, bench, n, last, tokenise, many), ["id"], n, last, tokenise, known).join(F.broadcast(grams) if many <= most_rows else grams, ["h", "gram"], "left_semi")
    hits = met.select("id").distinct()
    return train.join(hits, train["id"].eqNullSafe(hits["id"]), "left_semi")


def match_ratio(train: list, evaluation: list, least: int = 5) -> float:
    """Tokens in matching blocks of at least ``least``, as a share of the benchmark's tokens."""
    return Benchmark(evaluation).ratio(train, least)


#: Bytes of benchmark texts that are sent to all tasks at a time; candidates of a text in one row; benchmark texts whose automata a task keeps.
MOST_BYTES, ROW_CANDIDATES, AUTOMATA = 32 << 20, 500, 256


def _slices(bench: DataFrame, most_bytes: int) -> list[DataFrame]:
    """``bench`` in slices of about ``most_bytes``, dealt out by a hash of (benchmark, eval_idx)."""
    size = bench.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    many = -(-int(size) // most_bytes) or 1
    return [bench] if many == 1 else [bench.where(F.pmod(F.xxhash64("benchmark", "eval_idx"), F.lit(many)) == k) for k in range(many)]


def verify(candidates: DataFrame, train: DataFrame, bench: DataFrame, *, threshold: float = 0.5, least: int = 5, tokenise: Tokeniser = words, most_bytes: int = MOST_BYTES) -> DataFrame:
    """(benchmark, id, eval_idx): per benchmark and id the smallest eval_idx that is confirmed.

    A text's candidates are one list (of ROW_CANDIDATES at most, longer ones are dealt out), so a text moves once and not for each pair.
    The benchmark texts that have candidates are sent to the tasks, in slices of ``most_bytes``.  The candidates are read several times and
    written before, so that the corpus is searched for them once.
    """
    spark = ship(train.sparkSession)
    pairs = stored(candidates.select("id", "benchmark", "eval_idx"), "candidates")
    wanted = bench.join(pairs.select("benchmark", "eval_idx").distinct(), ["benchmark", "eval_idx"], "left_semi").select("benchmark", "eval_idx", "text")
    slices = _slices(wanted, most_bytes)
    kind = dict(candidates.dtypes)
    out = None
    for k, part in enumerate(slices):
        held = spark.sparkContext.broadcast(part.select("benchmark", "eval_idx", tokenise(F.col("text")).alias("tokens")).toArrow())
        own = pairs if len(slices) == 1 else pairs.where(F.pmod(F.xxhash64("benchmark", "eval_idx"), F.lit(len(slices))) == k)
        dealt = own.select("*", F.pmod(F.xxhash64("benchmark", "eval_idx"), F.ceil(F.count(F.lit(1)).over(Window.partitionBy("id")) / ROW_CANDIDATES)).alias("deal"))
        lists = dealt.groupBy("id", "deal").agg(F.collect_set(F.struct("benchmark", "eval_idx")).alias("found")).drop("deal")
        rows = lists.join(train.select("id", F.col("text")), "id").select("id", "found", tokenise(F.col("text")).alias("tokens"))
        hits = in_arrow(rows, _confirm(held, threshold, least), f"benchmark {kind['benchmark']}, id {kind['id']}, eval_idx {kind['eval_idx']}")
        out = hits if out is None else out.unionByName(hits)
    return out.groupBy("benchmark", "id").agg(F.min("eval_idx").alias("eval_idx"))


def _confirm(held: Broadcast, threshold: float, least: int) -> Callable:
    """Batches of (id, candidates, tokens) to the first confirmed candidate of each benchmark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = held.value
        names = list(zip(texts.column("benchmark").to_pylist(), texts.column("eval_idx").to_pylist(), strict=True))
        several: dict[tuple, list[int]] = {}
        for k, name in enumerate(names):
            several.setdefault(name, []).append(k)
        made = lru_cache(AUTOMATA)(lambda k: Benchmark(texts.column("tokens")[k].as_py() or []))
        for b in batches:
            out = []
            for row in range(b.num_rows):
                own, done = b.column(2)[row].as_py() or [], set()
                for name in sorted((f["benchmark"], f["eval_idx"]) for f in b.column(1)[row].as_py()):
                    if name[0] not in done and any(made(k).ratio(own, least) >= threshold for k in several.get(name, ())):
                        done.add(name[0])
                        out.append((name[0], row, name[1]))
            benchmarks, rows, places = zip(*out, strict=True) if out else ((), (), ())
            kinds = [b.column(1).type.value_type.field(k).type for k in ("benchmark", "eval_idx")]
            yield pa.RecordBatch.from_arrays([pa.array(benchmarks, kinds[0]), b.column(0).take(pa.array(rows, pa.int64())), pa.array(places, kinds[1])], ["benchmark", "id", "eval_idx"])

    return run


def report(verified: DataFrame) -> DataFrame:
    """Contaminated ids per benchmark, most first."""
    return verified.groupBy("benchmark").agg(F.countDistinct("id").alias("contaminated")).orderBy(F.desc("contaminated"), "benchmark")


def merge_reports(*reports: DataFrame) -> DataFrame:
    """Distinct contaminated ids of all reports."""
    ids = [r.select("id") for r in reports]
    out = ids[0]
    for r in ids[1:]:
        out = out.unionByName(r)
    return out.distinct()


def decontaminate(train: DataFrame, contaminated: DataFrame) -> DataFrame:
    return train.join(contaminated.select("id").distinct(), "id", "left_anti")


def removal(train: DataFrame, contaminated: DataFrame) -> DataFrame:
    """One row: rows before, after, removed and the percentage removed."""
    marked = train.join(contaminated.select("id").distinct().withColumn("bad", F.lit(1)), "id", "left")
    n, bad = F.count(F.lit(1)), F.count("bad")
    return marked.agg(n.alias("before"), (n - bad).alias("after"), bad.alias("removed"), F.try_divide(bad * 100.0, n).alias("percent"))


def subset(bench: DataFrame, names: list[str] | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """Benchmarks by name (a comma list in one name is split), or by place in the sorted list."""
    if names is not None:
        return bench.where(F.col("benchmark").isin(*[x.strip() for n in names for x in n.split(",")]))
    known = [r.benchmark for r in bench.select("benchmark").distinct().orderBy("benchmark").collect()]  # benchmark names
    return bench.where(F.col("benchmark").isin(*known[start:end]))


def named(bench: DataFrame, names: list[str]) -> tuple[DataFrame, list[str]]:
    """The benchmarks of a list, and the names in it that no benchmark has."""
    wanted = list(dict.fromkeys(x.strip() for n in names for x in n.split(",") if x.strip()))
    known = {r.benchmark for r in bench.where(F.col("benchmark").isin(*wanted)).select("benchmark").distinct().collect()}  # benchmark names
    return bench.where(F.col("benchmark").isin(*known)), [n for n in wanted if n not in known]


def job_chunks(bench: DataFrame, chunk: int) -> DataFrame:
    """(benchmark, job): benchmarks in the order of their names, ``chunk`` to a job."""
    place = F.row_number().over(Window.orderBy("benchmark")) - 1  # benchmark names only
    return bench.select("benchmark").distinct().withColumn("job", F.floor(place / chunk).cast("int"))


def write_reports(verified: DataFrame, path: str, *, overwrite: bool = False) -> DataFrame:
    """Contaminated ids below ``path``, a folder for each benchmark; those that have one are left alone
    unless ``overwrite``.  The reports there are afterwards."""
    spark = verified.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    known = [s.getPath().getName().split("=", 1)[1] for s in store.listStatus(folder) if "=" in s.getPath().getName()] if store.exists(folder) else []
    due = verified if overwrite else verified.where(~F.col("benchmark").isin(*known))
    due.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("benchmark").parquet(path)
    return spark.read.parquet(path)


def prompt_text(prompt: Column, fields: list[str]) -> Column:
    """A prompt's text: its content, else its text; neither raises."""
    found = F.coalesce(*[prompt.getField(f) for f in ("content", "text") if f in fields])
    return F.coalesce(found, F.raise_error(F.lit("a prompt has neither content nor text")).cast("string"))
