"""Toxicity by a classifier whose scores must not change when one group of people is named for another.

A text's features are the shares of its words (runs of letters and digits, lower-cased) and of their beginnings of 3 to 8 bytes, hashed to
SLOTS numbers; a beginning stands for all words of a stem, in languages whose words are joined as in those whose aren't.  The score is logistic in the
sum of the features' weights, so scoring is one table look-up a feature over the whole text.

The weights are fitted to labelled rows, and counterfactuals to those: in sentences of the labelled texts a term
for a group of people is swapped for the other terms of its kind; a text that names no group lends a sentence in which, at one place, one or another
term is put.  The penalty ``counter`` * mean((score of the sentence - score of its counterfactual)^2), taken before the logistic
curve, is part of the loss.  So a group that the labels mention mostly in toxic texts brings no toxicity by itself, and what
was said of it must.

Training reads a bounded sample: per class ``class_rows`` labelled rows, drawn by a hash of the id, one row an id, of texts of at
most ``max_train_bytes``; features seen in fewer than ``least_rows`` of them, and all but the ``most_features`` that tell the classes apart best,
get no weight; identity terms always have one.  What a fit on two thirds of the sample says of the last third, for each third, gives
slope and intercept of the curve, as a text that was learned from scores more surely than a new one.  Scoring reads every text whole.

Defined results: a null text counts as empty; a text without words has the score of the intercept; without labels of both classes every score
is the share of toxic labels (0 without any label); labels that are null, other than 0 and 1 or without an id aren't learned from; an id
labelled twice is learned by the smaller label and its smallest text; equal texts have equal scores; an empty table gives an empty result; an older ``toxicity_score`` is replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_arrow, stored

BITS, SCALE, SMOOTH, CHUNK, FOLDS = 18, 50.0, 50.0, 1 << 20, 3
SLOTS = 1 << BITS
BEGINNINGS = (3, 4, 5, 6, 7, 8)
#: Terms of one kind that stand for one another; each kind's first is the neutral one.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("people", "women", "men", "girls", "boys", "gays", "lesbians", "straights", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "immigrants", "refugees", "foreigners", "africans", "asians", "europeans"),
    ("person", "woman", "man", "girl", "boy", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "immigrant", "refugee", "foreigner", "african", "asian", "european"),
    ("human", "female", "male", "gay", "lesbian", "bisexual", "straight", "transgender", "queer", "black", "white", "latino", "jewish", "catholic", "disabled", "deaf", "blind", "old", "young"),
    ("leute", "frauen", "männer", "muslime", "christen", "juden", "flüchtlinge", "ausländer", "schwule", "lesben"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "réfugiés", "étrangers", "homosexuels", "lesbiennes"),
    ("gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "refugiados", "extranjeros", "homosexuales", "lesbianas"),
)
_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
_ODD, _NEXT, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x100000001B3), np.uint64(64 - BITS)
_PLACES = np.random.default_rng(13).integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _slots(names: np.ndarray, kind: int) -> np.ndarray:
    return (((names + np.uint64(kind)) * _ODD) ^ (names >> np.uint64(29))) * _ODD >> _SHIFT


def features(texts: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each (lower-cased) text, and for each kind of feature (text, slot) of every word that has it."""
    data = np.frombuffer(b" ".join([*texts, b"", b""]), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    inside = _WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    start, stop = edge[::2], edge[1::2]
    of, size = np.searchsorted(ends, start, "right"), stop - start
    words = np.bincount(of, minlength=len(texts))
    found = []
    if not len(start):
        return words, found
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, size)
    names = np.add.reduceat((data[at].astype(np.uint64) + _NEXT) * _PLACES[place & 63], np.cumsum(size) - size)
    found.append((of, _slots(names, 1)))
    name, left, begin = np.zeros(len(start), np.uint64), np.arange(len(start)), start
    for k in range(1, BEGINNINGS[-1] + 1):
        keep = size[left] > k  # a whole word has its own feature
        left, begin, name = left[keep], begin[keep], name[keep]
        name = (name * _NEXT) ^ data[begin + (k - 1)]
        name = (name ^ (name >> np.uint64(31))) * _ODD
        if k in BEGINNINGS:
            found.append((of[left], _slots(name, 100 + k)))
    return words, found


def shares(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values) of one text: scaled shares of its words; the shares of short texts are drawn towards 0."""
    words, found = features([text])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    slots, many = np.unique(np.concatenate([s for _, s in found]).astype(np.int64), return_counts=True)
    return slots, many * (SCALE / (float(words[0]) + SMOOTH))


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray  # SLOTS numbers, nearly all of them 0
    bias: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """Of lower-cased texts; long ones by themselves, short ones together."""
        out, at = np.empty(len(texts)), 0
        while at < len(texts):
            stop, size = at + 1, len(texts[at])
            while stop < len(texts) and size + len(texts[stop]) < CHUNK:
                size += len(texts[stop])
                stop += 1
            words, found = features(texts[at:stop])
            sums = np.zeros(stop - at)
            for of, slots in found:
                sums += np.bincount(of, self.weights[slots], minlength=stop - at)
            out[at:stop] = sums * (SCALE / (words + SMOOTH)) + self.bias
            at = stop
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def counterfactuals(text: str, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, swaps: int = 4) -> list[tuple[str, str]]:
    """At most ``swaps`` pairs of a sentence and what it is with another group named.

    Which term comes in follows from a hash of the sentence, so that all of a kind get their turn.
    """
    kinds = {t: kind for kind in terms for t in kind}
    sentences = [s for s in re.split(r"[.!?;\n]+", text.lower()) if s.strip()]
    out: list[tuple[str, str]] = []
    for sentence in sentences:
        parts = re.split(r"(\w+)", sentence)
        for k in range(1, len(parts), 2):
            if parts[k] in kinds and len(out) < swaps:
                others = [t for t in kinds[parts[k]] if t != parts[k]]
                other = others[zlib.crc32(f"{k}:{sentence}".encode()) % len(others)]
                out.append((sentence, "".join([*parts[:k], other, *parts[k + 1 :]])))
    if out or not sentences or not terms:
        return out
    mark = zlib.crc32(text.encode("utf-8", "replace"))
    words = sentences[mark % len(sentences)].split()
    for k in range(swaps):
        draw = zlib.crc32(f"{k}:{mark}".encode())
        kind = terms[draw % len(terms)]
        a, place = kind[0], (draw >> 8) % (len(words) + 1)
        b = kind[1 + (draw >> 16) % (len(kind) - 1)]
        out.append(tuple(" ".join([*words[:place], term, *words[place:]]) for term in (a, b)))
    return out


def _difference(pair: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the sentence less those of its counterfactual."""
    (a, x), (b, y) = (shares(lowered(s)) for s in pair)
    slots, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    values = np.bincount(where, np.concatenate([x, -y]), minlength=len(slots))
    return slots[values != 0], values[values != 0]


class _Rows:
    """Sparse rows over the features that have weights."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], slots: np.ndarray):
        of = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
        flat = np.concatenate([s for s, _ in rows] or [np.zeros(0, np.int64)])
        values = np.concatenate([v for _, v in rows] or [np.zeros(0)])
        column = np.searchsorted(slots, flat)
        known = column < len(slots)
        known[known] = slots[column[known]] == flat[known]
        self.n, self.width = len(rows), len(slots)
        self.row, self.column, self.values = of[known], column[known], values[known]

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.values * w[self.column], minlength=self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, self.values * r[self.row], minlength=self.width)


def _chosen(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, least_rows: int, most: int) -> np.ndarray:
    """The slots that tell the classes apart best, by the G statistic of the rows that have them."""
    seen = [np.zeros(SLOTS), np.zeros(SLOTS)]
    for (slots, _), label in zip(rows, y, strict=True):
        seen[int(label)][slots] += 1
    n0, n1 = float((y == 0).sum()), float((y == 1).sum())
    both = seen[0] + seen[1]
    g = np.zeros(SLOTS)
    for have, n in ((seen[0], n0), (seen[1], n1)):
        for observed, expected in ((have, both * n / (n0 + n1)), (n - have, n - both * n / (n0 + n1))):
            use = observed > 0
            g[use] += observed[use] * np.log(observed[use] / expected[use])
    g[both < least_rows] = 0
    best = np.argsort(-g, kind="stable")[:most]
    return best[g[best] > 0]


def _fit(x: _Rows, y: np.ndarray, swapped: _Rows, ridge: float, counter: float, rounds: int) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps, each weight's step by its own curvature."""
    n, width = max(1, x.n), x.width
    # Rows have several features each: a diagonal bound on the curvature needs the rows' sums of sizes.
    reach = np.bincount(x.row, np.abs(x.values), minlength=x.n) + 1
    bound = 0.25 * np.bincount(x.column, np.abs(x.values) * reach[x.row], minlength=width) / n + ridge
    far = np.bincount(swapped.row, np.abs(swapped.values), minlength=max(1, swapped.n))
    pairs = max(1, swapped.n)
    bound += 2 * counter * np.bincount(swapped.column, np.abs(swapped.values) * far[swapped.row], minlength=width) / pairs
    size, size0 = 1 / bound, 1 / (0.25 * float(reach.mean()))
    w, b, v, c, t = np.zeros(width), 0.0, np.zeros(width), 0.0, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-np.clip(x.times(v) + c, -30, 30))) - y
        slope = x.back(error) / n + ridge * v
        if swapped.n:
            slope += 2 * counter * swapped.back(swapped.times(v)) / pairs
        w1, b1, t1 = v - size * slope, c - size0 * float(error.mean()), (1 + math.sqrt(1 + 4 * t * t)) / 2
        if float(slope @ (w1 - w)) > 0:
            t1 = t = 1.0  # the steps have overshot: gather speed anew
        v, c = w1 + (t - 1) / t1 * (w1 - w), b1 + (t - 1) / t1 * (b1 - b)
        w, b, t = w1, b1, t1
    return w, b


def _curve(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and intercept of the logistic curve over z, by Newton's method; labels are
    drawn a little towards each other, so that classes that z tells apart fully have a finite slope."""
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    wanted = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, w = np.column_stack([z, np.ones_like(z)]), np.array([1.0, 0.0])
    loss = lambda u: float(np.logaddexp(0, a @ u).sum() - wanted @ (a @ u))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-6 * np.eye(2), a.T @ (wanted - p))
        while loss(w + step) > loss(w) + 1e-9 and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def fitted(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, others: list[list[tuple[np.ndarray, np.ndarray]]], named: list[np.ndarray], *, least_rows: int, most_features: int, counter: float, ridge: float, rounds: int) -> ToxicityModel:
    """The model of sampled rows x, their labels, each row's counterfactual differences, and the identity terms' slots."""

    def model(rows: np.ndarray, turns: int) -> ToxicityModel:
        own = [x[i] for i in rows]
        slots = np.unique(np.concatenate([_chosen(own, y[rows], least_rows, most_features), *named]).astype(np.int64))
        w, bias = _fit(_Rows(own, slots), y[rows], _Rows([d for i in rows for d in others[i]], slots), ridge, counter, turns)
        weights = np.zeros(SLOTS)
        weights[slots] = w
        return ToxicityModel(weights, bias)

    whole, held = model(np.arange(len(x)), rounds), np.full(len(x), np.nan)
    for k in range(FOLDS):
        out = np.arange(len(x)) % FOLDS == k
        if len(np.unique(y[~out])) == 2:
            part = model(np.flatnonzero(~out), rounds // 2)
            held[out] = [float(part.weights[x[i][0]] @ x[i][1]) + part.bias for i in np.flatnonzero(out)]
    judged = ~np.isnan(held)
    if len(np.unique(y[judged])) < 2:
        return whole
    slope, intercept = _curve(held[judged], y[judged])
    return ToxicityModel(whole.weights * slope, whole.bias * slope + intercept)


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    class_rows: int = 2500,
    max_train_bytes: int = 8_000,
    least_rows: int = 4,
    most_features: int = 4096,
    swaps: int = 4,
    counter: float = 10.0,
    ridge: float = 5e-5,
    rounds: int = 400,
) -> ToxicityModel:
    """Fit on a bounded sample of the labelled rows.

    Ids are drawn among the labels, without texts; only they meet the documents, and tasks send features and no texts.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(F.col("y").isin(0, 1) & F.col("id").isNotNull())
    known = stored(known.groupBy("id").agg(F.min("y").alias("y")), "labelled")
    share = known.agg(F.avg(F.col("y").cast("double"))).head()[0]
    order = [F.xxhash64("id"), F.col("id")]
    drawn = known.where("y = 0").orderBy(*order).limit(class_rows).unionByName(known.where("y = 1").orderBy(*order).limit(class_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where((F.octet_length("t") > 0) & (F.octet_length("t") <= max_train_bytes))
    # One row an id, so at most 2 * class_rows reach the driver.
    chosen = rows.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("t").alias("t"), F.min("y").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, other = [], []
            for t in b.column(1).to_pylist():
                slots, values = shares(lowered(t))
                own.append((slots.astype("<i4").tobytes(), values.astype("<f4").tobytes()))
                made = [_difference(p) for p in counterfactuals(t, terms, swaps)]
                other.append([{"s": s.astype("<i4").tobytes(), "v": v.astype("<f4").tobytes()} for s, v in made if len(s)])
            cells = [pa.array([s for s, _ in own], pa.binary()), pa.array([v for _, v in own], pa.binary()), pa.array(other, pa.list_(pa.struct([("s", pa.binary()), ("v", pa.binary())])))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *cells], ["id", "y", "s", "v", "other"])

    kind = chosen.select("id", "y", F.lit(b"").alias("s"), F.lit(b"").alias("v"), F.lit(None).cast("array<struct<s:binary,v:binary>>").alias("other")).schema
    got = sorted(((r.id, r.y, bytes(r.s), bytes(r.v), [(bytes(o.s), bytes(o.v)) for o in r.other]) for r in stored(in_arrow(chosen.select("id", "t", "y"), run, kind), "sample").coalesce(4).toLocalIterator()), key=lambda r: r[0])
    read = lambda s, v: (np.frombuffer(s, "<i4").astype(np.int64), np.frombuffer(v, "<f4").astype(np.float64))
    y, x, other = np.array([r[1] for r in got], np.float64), [read(r[2], r[3]) for r in got], [[read(*o) for o in r[4]] for r in got]
    if len(np.unique(y)) < 2:
        base = min(max(share or 0.0, 1e-6), 1 - 1e-6)
        return ToxicityModel(np.zeros(SLOTS), math.log(base / (1 - base)))
    named = [shares(lowered(t))[0] for same in terms for t in same]
    model = fitted(x, y, other, named, least_rows=least_rows, most_features=most_features, counter=counter, ridge=ridge, rounds=rounds)
    # The sample may take the classes unlike their share; the curve is moved back.
    share = min(max(share, 1e-6), 1 - 1e-6)
    return ToxicityModel(model.weights, model.bias + math.log(share / (1 - share)) - math.log(float((y == 1).sum()) / float((y == 0).sum())))


def score(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", keep: list[str | Column] | None = None) -> DataFrame:
    """The columns ``keep`` (default: all but an older score) and ``toxicity_score``; the model travels as one broadcast of SLOTS numbers."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.select(*(keep or [c for c in docs.columns if c != "toxicity_score"]))
    rows = docs.select(F.struct(*(keep or [F.col(c) for c in kept.columns])).alias("row"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = held.value.scores([lowered(t) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], ["row", "toxicity_score"])

    schema = rows.select("row", F.lit(0.0).alias("toxicity_score")).schema
    return in_arrow(rows, run, schema).select("row.*", "toxicity_score")
