"""Quality by compression: how much smaller does a text get with a zstandard
dictionary of good text than with one of bad text?

Both dictionaries are raw content: labelled texts, one after another.  A text is
compressed in blocks of ``block`` bytes, each for itself, so that the dictionary and
not the text's own beginning explains it.  The feature is (size with the bad one -
size with the good one) / bytes of the text; a logistic curve fitted on labelled rows outside the dictionaries turns it into
a score between 0 and 1.

Training reads a bounded sample: per class at most ``dictionary_bytes`` for the
dictionary and ``calibration_rows`` rows for the curve, of labelled texts no
longer than ``max_train_bytes``, chosen by a hash of the id.  Scoring reads every
text whole.

Defined results: a null text counts as empty; an empty text has difference 0 and
the score of that; without labels of both classes the score is the share of
good labels (0.5 without any label); labels that are null, other than 0 and 1 or without an id aren't learned from; an id
that is labelled or occurs several times is learned once, by its smaller label and its smallest text; with one labelled text of a class dictionary and
curve share it; equal texts have equal scores; an empty table gives an empty result; an older ``quality_score`` is replaced, other
columns can have any name.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_arrow, stored

LEVEL, BLOCK = 6, 2048


@dataclass(frozen=True)
class CompressionModel:
    good: bytes
    bad: bytes
    slope: float
    intercept: float
    level: int = LEVEL

    def differences(self, texts: list[bytes]) -> np.ndarray:
        sizes = []
        for raw in (self.good, self.bad):
            held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=self.level)
            press = zstandard.ZstdCompressor(dict_data=held, level=self.level, write_content_size=False, write_dict_id=False, write_checksum=False).compress
            whole = (sum(len(press(t[i : i + BLOCK])) for i in range(0, len(t), BLOCK)) for t in texts)
            sizes.append(np.fromiter(whole, dtype=np.float64, count=len(texts)))
        return (sizes[1] - sizes[0]) / np.fromiter((max(1, len(t)) for t in texts), dtype=np.float64, count=len(texts))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(texts) + self.intercept, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept by Newton's method, on the standardised feature."""
    centre, scale = float(x.mean()), float(x.std()) or 1.0
    a = np.column_stack([(x - centre) / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-10:
            break
    return float(w[0] / scale), float(w[1] - w[0] * centre / scale)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    dictionary_bytes: int = 1 << 20,
    calibration_rows: int = 2000,
    max_train_bytes: int = 20_000,
    level: int = LEVEL,
) -> CompressionModel:
    """Fit dictionaries and curve on a bounded sample of the labelled rows.

    The sample is drawn among the labels, without texts; only the ids drawn, a
    bounded number, then meet the documents.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    known = stored(known.groupBy("id").agg(F.min("y").alias("y")), "labelled")
    base = known.agg(F.avg(F.col("y").cast("double"))).head()[0]
    most = dictionary_bytes // 400 + calibration_rows
    order = [F.xxhash64("id"), F.col("id")]
    drawn = known.where("y = 0").orderBy(*order).limit(most).unionByName(known.where("y = 1").orderBy(*order).limit(most))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t"))
    rows = rows.where(F.col("t").isNotNull() & (F.octet_length("t") <= max_train_bytes) & (F.octet_length("t") > 0))
    # One row an id, so at most 2 * most rows.
    got = rows.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("t").alias("t")).coalesce(4).toLocalIterator()
    ordered = sorted((zlib.crc32(str(r.id).encode()), r.id, r.y, bytes(r.t)) for r in got)
    sample = {y: [t for _, _, label, t in ordered if label == y] for y in (0, 1)}
    if not sample[0] or not sample[1]:
        share = min(max(0.5 if base is None else base, 1e-6), 1 - 1e-6)
        return CompressionModel(b"", b"", 0.0, math.log(share / (1 - share)), level)

    held: dict[int, list[bytes]] = {}
    raw: dict[int, bytes] = {}
    for y, texts in sample.items():
        half = min(calibration_rows, len(texts) // 2)
        held[y], rest = texts[:half] or texts, texts[half:]  # a single text has to do for both
        parts, size = [], 0
        for t in rest:
            if size + len(t) > dictionary_bytes:
                break
            parts.append(t)
            size += len(t)
        raw[y] = b"\n".join(reversed(parts)) or rest[0][:dictionary_bytes]
    # Dictionaries of one size, so that neither class wins by knowing more.
    size = min(len(raw[0]), len(raw[1]))
    model = CompressionModel(raw[1][-size:], raw[0][-size:], 1.0, 0.0, level)
    d = model.differences(held[0] + held[1])
    y = np.r_[np.zeros(len(held[0])), np.ones(len(held[1]))]
    slope, intercept = _logistic(d, y)
    # The sample takes the classes alike; the curve is moved to their true share.
    share = min(max(base, 1e-6), 1 - 1e-6)
    intercept += math.log(share / (1 - share)) - math.log(len(held[1]) / len(held[0]))
    return CompressionModel(model.good, model.bad, slope, intercept, level)


def score(docs: DataFrame, model: CompressionModel, *, text_col: str = "text", keep: list[str | Column] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but an older score) and ``quality_score``.

    The model travels as one broadcast of at most twice ``dictionary_bytes``.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    kept = docs.select(*(keep or [c for c in docs.columns if c != "quality_score"]), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))
    names = kept.columns[:-1]
    rows = kept.toDF(*names, payload := next(n for n in ("payload" + "_" * k for k in range(len(names) + 1)) if n not in names))
    schema = rows.drop(payload).withColumn("quality_score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held.value
        for b in batches:
            got = own.scores(b.column(b.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.float64())], [*b.schema.names[:-1], "quality_score"])

    return in_arrow(rows, run, schema)
