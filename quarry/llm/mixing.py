"""Mixing documents to target weights with soft domain membership.

A classifier trained on the labelled table gives each document a posterior over
the domains: multinomial logistic regression on hashed byte pairs, so one pass over a
text's bytes.  Its training sample is bounded by ``sample_rows`` a domain, whatever the texts' lengths:
the tasks send features, at most ``SLOTS`` numbers a text, and no texts.

The rates r >= ``low`` solve

    min  m' W m  +  ridge * sum_d (r_d - 1)^2,    m_k = sum_d r_d tokens_d p_dk - target_k

(least squares of the domains' totals, the ridge choosing among the many rates that meet them) by projected
gradient steps.  The posteriors of all documents stay distributed: a step
sums (domains) numbers over them, and the rates are computed again from the steps'
few multipliers, so no state of the size of the corpus moves.  W is the
inverse of the domains' second moments, over the documents whose rates the step before has left free, so a step lands
on the targets but for the rates that it newly brings to ``low`` or takes from there, and a handful are enough.  Steps go on until the totals meet the targets or don't move any more, and
the shares reached are returned; :func:`demand` raises where they miss the targets.

Defined results: a null text counts as empty and has no token; a document without
tokens keeps rate 1; a target for a domain nobody knows raises; an empty table gives
an empty result; without any label all targets are equally likely; null labels are not learned from; repeated rows get equal rates; rows without an id count like any other;
columns of ``keep`` are fields of ``row``, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import in_arrow, stored

SLOTS, MOST_DOMAINS, DRAWS = 4096, 200, 1 << 30
_GOLDEN = (5**0.5 - 1) / 2


def pair_features(text: bytes) -> np.ndarray:
    """Square roots of the shares of hashed byte pairs, over the whole text."""
    data = np.frombuffer(text, np.uint8)
    if len(data) < 2:
        return np.zeros(SLOTS, np.float32)
    slot = (data[:-1].astype(np.uint32) * np.uint32(2531) + data[1:].astype(np.uint32) * np.uint32(97)) & np.uint32(SLOTS - 1)
    return np.sqrt(np.bincount(slot, minlength=SLOTS) / len(slot)).astype(np.float32)


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    weights: np.ndarray  # (SLOTS, domains)
    bias: np.ndarray

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty((len(texts), len(self.domains)))
        for at in range(0, len(texts), 512):
            x = np.stack([pair_features(t) for t in texts[at : at + 512]])
            z = (x @ self.weights + self.bias).astype(np.float64)
            z = np.exp(z - z.max(1, keepdims=True))
            out[at : at + 512] = z / z.sum(1, keepdims=True)
        return out


def train_domains(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", domain_col: str = "domain", sample_rows: int = 1500, rounds: int = 150, rate: float = 4.0, ridge: float = 1e-4) -> DomainModel:
    """Fit on at most ``sample_rows`` labelled rows of each domain.

    ``labelled`` has (id, domain); ids are drawn by their hash before any text is read.  An id is learned once: by its first domain in
    the order of names, and by the first of its texts.  More than ``MOST_DOMAINS`` domains raise.
    """
    known = labelled.select(F.col(id_col).alias("id"), F.col(domain_col).cast("string").alias("y")).where(F.col("y").isNotNull() & F.col("id").isNotNull())
    known = stored(known.groupBy("id").agg(F.min("y").alias("y")), "labelled")
    domains = tuple(sorted(r.y for r in known.select("y").distinct().limit(MOST_DOMAINS + 1).collect()))
    if not domains:
        raise ValueError("no labelled row")
    if len(domains) > MOST_DOMAINS:
        raise ValueError(f"more than {MOST_DOMAINS} domains")
    order = [F.xxhash64("id"), F.col("id")]
    drawn = None
    for d in domains:
        part = known.where(F.col("y") == d).orderBy(*order).limit(sample_rows)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).where(F.octet_length("t") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = [pair_features(t.as_py()) for t in b.column(2)]
            slots = [np.flatnonzero(f).astype("<u2") for f in whole]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([s.tobytes() for s in slots], pa.binary()), pa.array([f[s].tobytes() for f, s in zip(whole, slots, strict=True)], pa.binary())], ["id", "y", "slots", "values"])

    # One row an id, so at most sample_rows rows a domain.
    chosen = rows.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("y").alias("y"), F.min("t").alias("t"))
    kind = chosen.select("id", "y").withColumns({"slots": F.lit(b""), "values": F.lit(b"")}).schema
    got = sorted((r.id, r.y, bytes(r.slots), bytes(r.values)) for r in stored(in_arrow(chosen, run, kind), "sample").coalesce(4).toLocalIterator())
    weights, bias = np.zeros((SLOTS, len(domains)), np.float32), np.zeros(len(domains), np.float32)
    if got:
        x, y = np.zeros((len(got), SLOTS), np.float32), np.zeros((len(got), len(domains)), np.float32)
        for k, (_, domain, slots, values) in enumerate(got):
            x[k, np.frombuffer(slots, "<u2")] = np.frombuffer(values, np.float32)
            y[k, domains.index(domain)] = 1
        for _ in range(rounds):
            z = x @ weights + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            step = (y - p) / len(got)
            weights += rate * (x.T @ step * 10 - ridge * weights)
            bias += rate * step.sum(0)
    return DomainModel(domains, weights, bias)


def _draw(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("mix"), key), F.lit(DRAWS))


def _turns(draws: list[int], seen: dict[int, int]) -> list[int]:
    """How often each draw was seen before in the task."""
    out = []
    for d in draws:
        out.append(k := seen.get(d, 0))
        seen[d] = k + 1
    return out


def membership(docs: DataFrame, model: DomainModel, *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` as ``row``, a draw by the id (see :func:`copies`), the tokens (words between ASCII white space) and
    the posterior over the domains, for each row."""
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("row"), _draw(F.col(id_col)).alias("draw"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("t"))
    held = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS x domains numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            p = held.value.posteriors(texts)
            tokens = [float(len(t.split())) for t in texts]
            offsets = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tokens, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.ravel()))], ["row", "draw", "tokens", "posterior"])

    schema = rows.select("row", "draw").withColumns({"tokens": F.lit(0.0), "posterior": F.array(F.lit(0.0))}).schema
    return in_arrow(rows, run, schema)


def _rates(mass: np.ndarray, steps: list[np.ndarray], ridge_step: float, low: float, high: float = np.inf) -> np.ndarray:
    """Rates after the steps g: r - r's share of the gradient, projected; ``mass`` is (rows, domains) of tokens times posterior."""
    r = np.ones(len(mass))
    for g in steps:
        r = np.clip(r - mass @ g - ridge_step * (r - 1), low, high)
    return r


def fit_rates(members: DataFrame, targets: Mapping[str, float], domains: tuple[str, ...], *, rounds: int = 1000, ridge: float = 1e-6, low: float = 0.0, high: float = np.inf, total: float | None = None, tolerance: float = 1e-4) -> tuple[DataFrame, dict[str, float]]:
    """``members`` with a column rate, and the share of tokens each domain ends up with.

    ``total`` is the number of tokens wanted, by default as many as there are;
    ``total=math.inf`` means the least total for which no domain must shrink.  Rates have
    no upper bound unless ``high`` sets one.  The steps end when every domain's total is within
    ``tolerance`` of the wanted total, when a step moves none by a thousandth of that, or after ``rounds``.
    """
    if set(targets) - set(domains):
        raise ValueError(f"no labelled row of {sorted(set(targets) - set(domains))}")
    k = len(domains)
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    share = share / share.sum()
    schema = "sums array<double>, gram array<double>"

    def summed(fn) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, gram = np.zeros(k), np.zeros(k * k)
            for b in batches:
                if b.num_rows:
                    mass = b.column(1).flatten().to_numpy().reshape(-1, k) * b.column(0).to_numpy()[:, None]
                    r = fn(mass)
                    sums += r @ mass
                    moved = mass[(r > low) & (r < high)] if steps else mass
                    gram += (moved.T @ moved).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()]), pa.array([gram.tolist()])], ["sums", "gram"])

        parts = in_arrow(members.select("tokens", "posterior"), run, schema)
        row = parts.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(k)], *[F.sum(F.col("gram")[i]).alias(f"g{i}") for i in range(k * k)]).head()
        values = np.array([x or 0.0 for x in row])
        return values[:k], values[k:].reshape(k, k)

    def inverse(gram: np.ndarray) -> np.ndarray:
        scale = 1 / np.sqrt(np.maximum(np.diag(gram), 1e-300))
        return scale[:, None] * np.linalg.pinv(scale[:, None] * gram * scale, rcond=1e-10, hermitian=True) * scale

    steps: list[np.ndarray] = []
    sums, gram = summed(lambda mass: np.ones(len(mass)))
    if not sums.sum():
        plain = members.withColumn("rate", F.lit(1.0))
        return plain.withColumn("turn", F.lit(0).cast("long")) if "draw" in members.columns else plain, dict.fromkeys(domains, 0.0)
    if total is None:
        total = float(sums.sum())
    elif not np.isfinite(total):
        total = float((sums[share > 0] / share[share > 0]).max())
    goal = share * total
    whole = weight = inverse(gram)  # W
    size, scaled = 1 / (1 + ridge), True
    now = sums
    for _ in range(rounds):
        if np.abs(now - goal).max() <= tolerance * total:
            break
        steps.append(size * (weight @ (now - goal)))
        before = now
        now, gram = summed(lambda mass: _rates(mass, steps, size * ridge, low, high))
        if scaled and len(steps) > 1 and np.abs(now - goal).max() >= np.abs(before - goal).max():
            steps.pop()  # it brought nothing: from here on all documents count for W
            now, weight, scaled = before, whole, False
            continue
        if scaled:
            weight = inverse(gram)
        if np.abs(now - before).max() <= 1e-3 * tolerance * total:
            break

    drawn = "draw" in members.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for b in batches:
            at = b.schema.get_field_index("posterior")
            tokens = b.column(b.schema.get_field_index("tokens")).to_numpy()
            mass = b.column(at).flatten().to_numpy().reshape(-1, k) * tokens[:, None]
            turn = [pa.array(_turns(b.column(b.schema.get_field_index("draw")).to_pylist(), seen), pa.int64())] if drawn else []
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_rates(mass, steps, size * ridge, low, high)), *turn], [*b.schema.names, "rate", *["turn"] * drawn])

    out = in_arrow(members, run, members.withColumns({"rate": F.lit(0.0)} | ({"turn": F.lit(0).cast("long")} if drawn else {})).schema)
    return out, dict(zip(domains, (now / now.sum()).tolist(), strict=True))


def demand(reached: Mapping[str, float], targets: Mapping[str, float], within: float = 0.01) -> None:
    """Raise if a share reached misses its target by more than ``within``; without tokens there is nothing to reach."""
    whole = sum(max(0.0, x) for x in targets.values())
    missed = {d: (round(x, 4), max(0.0, targets.get(d, 0.0)) / whole) for d, x in reached.items() if abs(x - max(0.0, targets.get(d, 0.0)) / whole) > within}
    if missed and any(reached.values()):
        raise ValueError(f"shares of tokens (reached, wanted) miss the targets: {missed}")


def mix(docs: DataFrame, labelled: DataFrame, targets: Mapping[str, float], *, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, **options) -> tuple[DataFrame, tuple[str, ...], dict[str, float]]:
    """(row, tokens, posterior, rate) per row, the domains, and the shares reached."""
    if labelled.isEmpty():  # nothing is known: all targets are equally likely
        names = tuple(sorted(targets))
        model = DomainModel(names, np.zeros((SLOTS, len(names)), np.float32), np.zeros(len(names), np.float32))
    else:
        model = train_domains(docs, labelled, id_col=id_col, text_col=text_col)
    members = stored(membership(docs, model, id_col=id_col, text_col=text_col, keep=keep), "membership")
    rated, reached = fit_rates(members, targets, model.domains, **options)
    return rated, model.domains, reached


def copies(rated: DataFrame) -> DataFrame:
    """``row`` as often as its rate says: the whole part, and one more with the probability of the rest.

    The draw is a hash of the row's id, so it doesn't depend on how rows are dealt out.  Of rows that share an id, null
    being one, a task gives each further one the draw after it in an even sequence (``turn``), so their copies add up to their rates as well.
    """
    draw = (F.col("draw") / F.lit(float(DRAWS)) + F.col("turn") * F.lit(_GOLDEN)) % 1.0
    return rated.select("row", F.explode(F.array_repeat(F.lit(1), F.floor(F.col("rate") + draw).cast("int"))).alias("_copy")).select("row.*")
