"""Judge answers, rankings and their statistics."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import inversions
from quarry.session import drop_path, in_arrow, shared_path, ship, stored

EMPTY = "[EMPTY RESPONSE]"

# ---- parsing ----------------------------------------------------------------


def ranking_list(text: Column) -> Column:
    """The items between the brackets of ``RANKING: [...]``, null if there are none."""
    inside = F.regexp_extract(text, r"(?is)RANKING:\s*\[(.*?)\]", 1)
    return F.when(text.rlike(r"(?is)RANKING:\s*\[.*?\]"), F.transform(F.split(inside, ","), lambda x: F.trim(x)))


def ranking_numbers(text: Column, labels: Sequence[str] | None = None) -> Column:
    items = ranking_list(text)
    if labels is None:
        return F.transform(items, lambda x: x.try_cast("int"))
    names = F.array(*map(F.lit, labels))
    return F.transform(items, lambda x: F.nullif(F.array_position(names, F.regexp_replace(x, "[\"']", "")), F.lit(0)).cast("int"))


def ranking_error(text: Column, n: int = 9, labels: Sequence[str] | None = None) -> Column:
    """The first thing wrong with a ranking, null if nothing is."""
    got = ranking_numbers(text, labels)
    unread = F.exists(got, lambda x: x.isNull())
    out = F.exists(got, lambda x: ~x.between(1, n))
    return (
        F.when(got.isNull(), "no_ranking_found")
        .when(unread, "invalid_labels" if labels else "non_numeric")
        .when(F.size(got) != n, "wrong_count")
        .when(F.size(F.array_distinct(got)) != n, "duplicate_values")
        .when(out, "invalid_range")
    )


def back_to_items(ranking: Column, order: Column) -> Column:
    """Ranks by item, from ranks at the places where the items were shown."""
    return F.transform(F.array_sort(order), lambda i: F.try_element_at(ranking, F.array_position(order, i).cast("int")))


def single_score(text: Column, top: int = 9) -> Column:
    """A score from the first line, the last, any digit that stands alone, or SCORE:."""
    lines = F.split(F.trim(text), "\n")
    alone = lambda x: F.when(F.trim(x).rlike("^[0-9]+$"), F.trim(x).try_cast("int"))
    good = lambda x: F.when(x.between(1, top), x)
    digit = F.nullif(F.regexp_extract(text, r"(?:^|[^0-9A-Za-z_])([0-9])(?:$|[^0-9A-Za-z_])", 1), F.lit("")).try_cast("int")
    marked = F.nullif(F.regexp_extract(text, r"(?i)SCORE:\s*([0-9])", 1), F.lit("")).try_cast("int")
    return F.coalesce(good(alone(F.try_element_at(lines, F.lit(1)))), good(alone(F.try_element_at(lines, F.lit(-1)))), good(digit), good(marked))


def expected_score(top: Column, low: int = 1, high: int = 9) -> Column:
    """Mean score under the probabilities of the scale's tokens among (token, logprob)."""
    scale = F.filter(top, lambda x: F.trim(x["token"]).try_cast("int").between(low, high))
    mass = F.aggregate(scale, F.lit(0.0), lambda a, x: a + F.exp(x["logprob"]))
    return F.try_divide(F.aggregate(scale, F.lit(0.0), lambda a, x: a + F.exp(x["logprob"]) * F.trim(x["token"]).cast("double")), mass)


def scored_token(tokens: Column, low: int = 1, high: int = 9) -> Column:
    """The first of the answer's tokens (token, top) after any thinking that is on the scale; null if none is."""
    start = F.struct(F.lit(False).alias("thinking"), F.lit(None).cast("int").alias("at"), F.lit(0).alias("n"))

    def step(s: Column, t: Column) -> Column:
        word = F.trim(t["token"])
        thinking = F.when(word == "<think>", True).when(word == "</think>", False).otherwise(s["thinking"])
        hit = s["at"].isNull() & ~thinking & F.coalesce(word.try_cast("int").between(low, high) & word.rlike("^[0-9]+$"), F.lit(False))
        return F.struct(thinking.alias("thinking"), F.when(hit, s["n"]).otherwise(s["at"]).alias("at"), (s["n"] + 1).alias("n"))

    return F.try_element_at(tokens, F.aggregate(tokens, start, step)["at"] + 1)


def token_score(tokens: Column, low: int = 1, high: int = 9, *, modal: bool = False) -> Column:
    """The score of that token, or its mean under the token's alternatives."""
    token = scored_token(tokens, low, high)
    return F.trim(token["token"]).try_cast("double") if modal else expected_score(token["top"], low, high)


def winner_letter(text: Column, field: str = "winner") -> Column:
    """One letter from the outermost braces of an answer, upper-cased; else null."""
    said = F.upper(F.trim(F.get_json_object(F.regexp_extract(text, r"(?s)\{.*\}", 0), f"$.{field}")))
    return F.when(said.rlike("^[A-Z]$"), said)


def letter_place(letter: Column) -> Column:
    """1 for A, 2 for B, ..."""
    return F.ascii(letter) - 64


def pair_logprobs(tokens: list[dict], labels: tuple[str, str] = ("A", "B"), marker: str | None = None) -> tuple[float, float]:
    """Log-probabilities of both labels at the first label token after thinking (and
    after ``marker``); a label that isn't listed gets -inf, no label token (-10, -10.1)."""
    thinking, armed, seen = False, marker is None, ""
    for t in tokens:
        word = t["token"].strip()
        if word in ("<think>", "</think>"):
            thinking = word == "<think>"
            continue
        if thinking:
            continue
        if not armed:
            seen += t["token"]
            armed = marker in seen
            continue
        if word in labels:
            listed = {x["token"].strip(): x["logprob"] for x in reversed(t["top_logprobs"])}
            listed.setdefault(word, t["logprob"])
            return tuple(listed.get(k, -math.inf) for k in labels)
    return -10.0, -10.1


def choice_logprobs(tokens: Column, labels: tuple[str, ...] = ("A", "B", "C", "D")) -> Column:
    """Log-probabilities of the labels, by label, at the first token that is one of them, thinking left out; null without such a token.

    ``tokens`` are (token, top array of (token, logprob)); a label that isn't listed there has none.
    """
    word = lambda t: F.trim(t["token"])
    # What a think tag opens isn't an answer until its end.
    state = F.struct(F.lit(False).alias("thinking"), F.lit(None).cast("array<struct<token:string,logprob:double>>").alias("top"))

    def step(s: Column, t: Column) -> Column:
        thinking = F.when(word(t) == "<think>", True).when(word(t) == "</think>", False).otherwise(s["thinking"])
        hit = s["top"].isNull() & ~thinking & word(t).isin(*labels)
        listed = F.transform(t["top"], lambda x: F.struct(F.trim(x["token"]).alias("token"), x["logprob"].cast("double").alias("logprob")))
        return F.struct(thinking.alias("thinking"), F.when(hit, listed).otherwise(s["top"]).alias("top"))

    top = F.aggregate(tokens, state, step)["top"]
    best = lambda k: F.array_max(F.transform(F.filter(top, lambda x: x["token"] == k), lambda x: x["logprob"]))
    return F.when(top.isNotNull(), F.map_filter(F.create_map(*[y for k in labels for y in (F.lit(k), best(k))]), lambda _, v: v.isNotNull()))


def choices_over_repeats(answers: DataFrame, by: list[str], choices: str = "choices") -> DataFrame:
    """(by, label, picked, asked, share, mean_probability): over the repeats of a question, how often each label was the likeliest
    (ties: the first by name), and its mean probability among the labels that were listed."""
    rows = answers.where(F.col(choices).isNotNull() & (F.size(choices) > 0)).select(*by, F.array_sort(F.map_entries(choices)).alias("e"))
    mass = F.aggregate("e", F.lit(0.0), lambda s, x: s + F.exp(x["value"]))
    first = F.array_min(F.transform("e", lambda x: F.named_struct(F.lit("v"), -x["value"], F.lit("k"), x["key"])))["k"]
    each = rows.select(*by, first.alias("_won"), mass.alias("_m"), F.explode("e").alias("x"))
    counted = each.groupBy(*by, F.col("x.key").alias("label")).agg(F.count_if(F.col("x.key") == F.col("_won")).alias("picked"), F.avg(F.exp("x.value") / F.col("_m")).alias("mean_probability"))
    asked = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("asked"))
    return counted.join(asked, by).select(*by, "label", "picked", "asked", (F.col("picked") / F.col("asked")).alias("share"), "mean_probability")


def dual_winner(ab_a: Column, ab_b: Column, ba_a: Column, ba_b: Column) -> list[Column]:
    """Winner over both orders by mean log-probability, and whether the orders agree.

    In the second order the first item is called B.
    """
    first, second = (ab_a + ba_b) / 2, (ab_b + ba_a) / 2
    agree = (ab_a > ab_b) == (ba_b > ba_a)
    return [F.when(first >= second, "A").otherwise("B").alias("winner"), agree.alias("consistent"), (first - second).alias("margin")]


# ---- prompts ----------------------------------------------------------------


def filled(text: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(EMPTY))


def pair_prompt(charter: Column, question: Column, a: Column, b: Column) -> Column:
    return F.concat(charter, F.lit("\n\nQuestion:\n"), question, F.lit("\n\nResponse A:\n"), filled(a), F.lit("\n\nResponse B:\n"), filled(b), F.lit("\n\nWhich is better? Answer A or B."))


def labelled_block(items: Column, labels: str = "ABCDEFGHIJKLMNOPQRSTUVWXYZ") -> Column:
    return F.array_join(F.transform(items, lambda x, i: F.concat(F.lit("Completion "), F.substr(F.lit(labels), i + 1, F.lit(1)), F.lit(":\n"), filled(x))), "\n\n")


def list_prompt(instructions: Column, question: Column, items: Column, order: Column) -> Column:
    shown = F.transform(order, lambda i: F.element_at(items, i))
    return F.concat(instructions, F.lit("\n\n"), question, F.lit("\n\n"), labelled_block(shown))


def score_prompt(instructions: Column, question: Column, content: Column, *, low: int = 1, high: int = 9, thinking: bool = False) -> Column:
    """The question for one completion's label on a scale; an answer without thinking starts after LABEL."""
    # The wording of the prompt.
    scale = f"Based on these quality indicators, label the following completion on a scale from {low} to {high}, where {high} is best and {low} is worst."
    plain, rule = "Do not use any reasoning and respond with only the quality label.", "======"
    lines = [instructions, F.lit(""), F.lit(scale), F.lit(plain), F.lit(rule), F.concat(F.lit("QUESTION: "), question), F.lit(""), F.lit(rule), F.concat(F.lit("COMPLETION: "), content), F.lit(rule)]
    return F.concat_ws("\n", *lines, *([] if thinking else [F.lit("LABEL: ")]))


def winner_completion(letter: Column, order: Column, ids: Column) -> Column:
    """(id, place): the completion shown under a letter, and the place from 1 where it was shown; null beyond the last."""
    place = F.when(letter_place(letter).between(1, F.size(order)), letter_place(letter))
    return F.struct(F.try_element_at(ids, F.try_element_at(order, place)).alias("id"), place.alias("place"))


def shown_order(key: Column, ordering: Column, n: int) -> Column:
    """A permutation of 1..n that follows from key and ordering."""
    ranked = F.array_sort(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.xxhash64(key, ordering, i).alias("h"), i.alias("i"))))
    return F.transform(ranked, lambda x: x["i"])


def completions(branches: Column) -> Column:
    """(id, content) of the first response of each branch's first assistant message."""
    first = lambda b: F.try_element_at(F.filter(F.try_element_at(F.filter(b["messages"], lambda m: m["role"] == "assistant"), F.lit(1))["parts"], lambda p: p["type"] == "response"), F.lit(1))["content"]
    return F.filter(F.transform(branches, lambda b, i: F.struct(F.concat(F.lit("branch_"), i.cast("string")).alias("id"), first(b).alias("content"))), lambda x: x["content"].isNotNull())


# ---- ranking ----------------------------------------------------------------


def rank_by_score(df: DataFrame, by: list[str], score: str, index: str) -> DataFrame:
    """``place`` 1 for the highest score; equal scores in the index's order."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc_nulls_last(score), index)))


def hybrid_ranks(df: DataFrame, by: list[str], score: str, judged: str, index: str) -> DataFrame:
    """Ranks n downwards: first those with a judge's place, in its order, then by score."""
    w = Window.partitionBy(*by)
    order = w.orderBy(F.col(judged).isNull(), F.col(judged), F.desc_nulls_last(score), index)
    return df.withColumn("final_rank", F.count(F.lit(1)).over(w) - F.row_number().over(order) + 1)


def average_ranks(df: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    w = Window.partitionBy(*by)
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
    return df.withColumn(name, F.rank().over(w.orderBy(value)) + (ties - 1) / 2.0)


def spearman(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """(by, spearman): correlation of average ranks."""
    ranked = average_ranks(average_ranks(df, by, x, "_x"), by, y, "_y")
    return ranked.groupBy(*by).agg(F.corr("_x", "_y").alias("spearman"))


def kendall(df: DataFrame, by: list[str], x: str, y: str) -> DataFrame:
    """(by, kendall): tau-b, by inversion counts, so lists may be of any length."""
    return inversions.kendall(df, by, x, y)


def top_hits(df: DataFrame, by: list[str], truth: str, predicted: str, index: str, k: int = 3) -> DataFrame:
    """(by, hits): how many of the k best by truth are among the k best by prediction."""
    w = Window.partitionBy(*by)
    best = df.withColumn("_t", F.row_number().over(w.orderBy(F.desc(truth), index))).withColumn("_n", F.count(F.lit(1)).over(w))
    return best.groupBy(*by).agg(F.count(F.when((F.col("_t") <= k) & (F.col(predicted) > F.col("_n") - k), 1)).alias("hits"))


def array_ranks(values: Column) -> Column:
    """Ranks of a short array's items from 1, equal items their mean rank."""
    less = lambda x: F.size(F.filter(values, lambda y: y < x))
    same = lambda x: F.size(F.filter(values, lambda y: y == x))
    return F.transform(values, lambda x: less(x) + (same(x) + 1) / 2.0)


def array_pearson(a: Column, b: Column) -> Column:
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    n, product = F.size(a), lambda x, y: total(F.zip_with(x, y, lambda p, q: (p * q).cast("double")))
    spread = lambda x: n * product(x, x) - total(x) * total(x)
    return F.try_divide(n * product(a, b) - total(a) * total(b), F.sqrt(spread(a) * spread(b)))


def array_spearman(a: Column, b: Column) -> Column:
    return array_pearson(array_ranks(a), array_ranks(b))


def array_kendall(a: Column, b: Column) -> Column:
    """Kendall's tau-b of two short arrays."""
    signs = lambda xs: F.transform(item_pairs(xs), lambda p: F.signum((F.get(xs, p["i"]) - F.get(xs, p["j"])).cast("double")))
    x, y = signs(a), signs(b)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, v: s + v)
    decided = lambda xs: total(F.transform(xs, lambda v: F.abs(v)))
    return F.try_divide(total(F.zip_with(x, y, lambda p, q: p * q)), F.sqrt(decided(x) * decided(y)))


def best_places(truth: Column, k: int = 3) -> Column:
    """Places from 0 of the ``k`` largest items, earlier ones first among equals."""
    placed = F.array_sort(F.transform(truth, lambda x, i: F.struct((-x).alias("x"), i.alias("i"))))
    return F.slice(F.transform(placed, lambda p: p["i"]), 1, k)


def judged_ranking(df: DataFrame, answer: Column, order: Column, truth: Column, *, n: int = 9, k: int = 3) -> DataFrame:
    """``df`` with (success, error, predicted, spearman, kendall, top3): an answer's ranking, brought
    back from the order shown (from 1) and held against the truth; without a valid ranking there is only the error."""
    error = ranking_error(answer, n)
    predicted = F.when(error.isNull(), back_to_items(ranking_numbers(answer), order))
    rows = df.withColumn("error", error).withColumn("success", error.isNull()).withColumn("predicted", predicted)
    hits = F.size(F.filter(best_places(truth, k), lambda i: F.get(F.col("predicted"), i) > n - k))
    done = F.col("predicted").isNotNull()
    return rows.withColumns({"spearman": F.when(done, array_spearman(truth, F.col("predicted"))), "kendall": F.when(done, array_kendall(truth, F.col("predicted"))), "top3": F.when(done, hits)})


def judged_scores(df: DataFrame, scores: Column, truth: Column, *, ties: bool = False, k: int = 3) -> DataFrame:
    """``df`` with (success, error, spearman, kendall, top3) of one score a completion.

    The first score that is missing fails the row; equal scores all over do so too unless ``ties``.
    """
    missing = F.array_position(F.transform(scores, lambda x: x.isNull()), True)
    same = F.size(F.array_distinct(scores)) == 1
    error = F.when(missing > 0, F.concat(F.lit("Failed to parse valid score for "), (missing - 1).cast("string")))
    error = error if ties else error.when(same, "All predicted scores identical, correlation undefined")
    rows = df.withColumn("error", error).withColumn("success", F.col("error").isNull())
    place = lambda i: F.array_position(F.transform(F.array_sort(F.transform(scores, lambda x, j: F.struct((-x).alias("x"), j.alias("j")))), lambda p: p["j"]), i)
    hits = F.size(F.filter(best_places(truth, k), lambda i: place(i) <= k))
    done = lambda c: F.when(F.col("success"), c)
    return rows.withColumns({"spearman": done(array_spearman(truth, scores)), "kendall": done(array_kendall(truth, scores)), "top3": done(hits)})


def degraded_answer(text: Column) -> Column:
    """(completion, reasoning) of an answer in two marked parts; without the marks it is the completion."""
    marked = text.contains("REASONING:") & text.contains("COMPLETION:")
    pieces = F.split(text, "COMPLETION:")
    strip_ = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.struct(F.when(marked, strip_(pieces[1])).otherwise(text).alias("completion"), F.when(marked, strip_(F.replace(pieces[0], F.lit("REASONING:"), F.lit("")))).otherwise("Format not followed correctly").alias("reasoning"))


def degradation_history(completions: Column, reasonings: Column, most: int = 500) -> Column:
    """What the model is shown of the steps so far, each completion cut to ``most`` characters."""
    short = lambda c: F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("..."))).otherwise(c)
    lines = F.transform(completions, lambda c, i: F.concat(F.when(i == 0, "ORIGINAL COMPLETION:\n").otherwise(F.concat(F.lit("ITERATION "), i.cast("string"), F.lit(" (Previous Reasoning: "), F.coalesce(F.get(reasonings, i - 1), F.lit("")), F.lit("):\n"))), short(c), F.lit("\n\n")))
    return F.array_join(lines, "")


def degrade(samples: DataFrame, ask: Callable[[str], str], steps: int, path: str, template: str, failures: tuple[type[Exception], ...] = (OSError, ValueError, RuntimeError)) -> DataFrame:
    """Samples (key columns, question, completions, reasonings) after ``steps`` answers of the model, each worse than the last.

    ``template`` has places {question}, {history} and {latest}.  Every step is a table below ``path``; a run that
    finds some of them goes on from there, so neither a lost executor nor a lost driver asks a question twice.  A call that fails in a way
    named fails for its sample alone, which stays as it was in that step.
    """
    spark = ship(samples.sparkSession)
    now = samples.withColumn("iteration", F.lit(0))

    def answered(text: str) -> str | None:
        try:
            return ask(text)
        except failures:
            return None

    for k in range(1, steps + 1):
        at = f"{path}/step={k}"
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            asked = now.withColumn("_h", degradation_history(F.col("completions"), F.col("reasonings"))).withColumn("_q", F.element_at("completions", -1))

            def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for b in batches:
                    said = [answered(template.format(question=q, history=h, latest=t)) for q, h, t in zip(b["question"], b["_h"], b["_q"], strict=True)]
                    yield b.assign(_a=said)

            shape = asked.withColumn("_a", F.lit(None).cast("string")).schema
            done = asked.mapInPandas(answers, shape).withColumn("_x", degraded_answer(F.col("_a")))
            more = lambda old, new: F.when(F.col("_a").isNull(), F.col(old)).otherwise(F.concat(old, F.array(new)))
            done = done.withColumns({"completions": more("completions", "_x.completion"), "reasonings": more("reasonings", "_x.reasoning"), "iteration": F.lit(k)})
            done.select(*now.columns).write.mode("overwrite").parquet(at)
        now = spark.read.schema(now.schema).parquet(at)
    return now


def odd_even(items: Sequence, better: Callable[[object, object], bool], *, quiet: int = 2, rounds: int | None = None) -> tuple[list[int], int]:
    """Odd-even transposition sort by a judge: (places of the items, best first; calls).

    Each unordered pair is asked once; ``quiet`` rounds without a swap end it.
    """
    order, memory, calm, calls = list(range(len(items))), {}, 0, 0
    for r in range(rounds if rounds is not None else 2 * len(items)):
        swapped = False
        for i in range(r % 2, len(order) - 1, 2):
            a, b = order[i], order[i + 1]
            key = (min(a, b), max(a, b))
            if key not in memory:
                memory[key] = key[0] if better(items[key[0]], items[key[1]]) else key[1]
                calls += 1
            if memory[key] == b:
                order[i], order[i + 1] = b, a
                swapped = True
        calm = 0 if swapped else calm + 1
        if calm >= quiet:
            break
    return order, calls


Better = Callable[[str, str], bool]


#: Questions that a judge of batches gets at a time.
QUESTIONS = 1_000


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values))


def _round(r: int, quiet: int, judge: Callable[[list[tuple[str, str]]], list[bool]]) -> Callable:
    """Round ``r`` of lists (..., texts, order, known, calm, open), all lists of a batch at once.

    ``order`` has places in ``texts``; ``known`` has a cell for each pair of places: 0 is not asked, 1 the smaller place wins, 2 the greater one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, order, known, calm = (b.column(b.schema.get_field_index(c)) for c in ("texts", "order", "known", "calm"))
            sizes, cells = (c.value_lengths().to_numpy().astype(np.int64) for c in (order, known))
            row, first = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
            texts, order, known = texts.flatten(), order.flatten().to_numpy().copy(), known.flatten().to_numpy().copy()
            place = np.arange(len(row)) - first[row]
            left = np.flatnonzero(((place - r) % 2 == 0) & (place + 1 < sizes[row]))
            own = row[left]
            lo, hi = np.minimum(order[left], order[left + 1]).astype(np.int64), np.maximum(order[left], order[left + 1]).astype(np.int64)
            cell = (np.cumsum(cells) - cells)[own] + hi * (hi - 1) // 2 + lo
            new = np.flatnonzero(known[cell] == 0)
            for at in range(0, len(new), QUESTIONS):
                k = new[at : at + QUESTIONS]
                asked = (texts.take(pa.array(first[own[k]] + end[k])).to_pylist() for end in (lo, hi))
                said = list(judge(list(zip(*asked, strict=True))))
                if len(said) != len(k):
                    raise ValueError(f"the judge was asked {len(k)} questions and gave {len(said)} answers")
                known[cell[k]] = [1 if x else 2 for x in said]
            swaps = np.where(known[cell] == 1, lo, hi) == order[left + 1]
            at = left[swaps]
            order[at], order[at + 1] = order[at + 1], order[at]
            calm = np.where(np.isin(np.arange(len(sizes)), own[swaps]), 0, calm.to_numpy() + 1)
            done = {"order": _lists(order, sizes), "known": _lists(known, cells), "calm": pa.array(calm.astype(np.int32)), "open": pa.array((calm < quiet) & (r + 1 < 2 * sizes))}
            yield pa.RecordBatch.from_arrays([done.get(n, b.column(k)) for k, n in enumerate(b.schema.names)], b.schema.names)

    return run


def rank_with_judge(df: DataFrame, key: str, index: str, text: str, better: Better | None = None, quiet: int = 2, *, better_all: Callable[[list[tuple[str, str]]], list[bool]] | None = None) -> DataFrame:
    """(key, index, place) per list of completions, in rounds over all lists at once, as :func:`odd_even` sorts one.

    A list is a row with its texts and the answers so far, so rows are shuffled once, to make the lists, and a round joins nothing.  A round's
    pairs that nobody has asked yet go to the judge in batches; its answers and orders are one table that is written before the next round reads
    it, so a lost executor asks no earlier round's question again, and the table before is deleted.  A list is done after ``quiet`` rounds
    without a swap, or twice as many rounds as it has items; then its texts and answers go, and the rounds end with the last list.
    Items of equal index start in the order of their texts; a null index is the least.
    """
    if (better is None) == (better_all is None):
        raise ValueError("one judge, of a pair or of a batch of pairs")
    spark, judge = df.sparkSession, better_all or (lambda many: [better(a, b) for a, b in many])
    lists = df.groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(F.struct(F.col(index).alias("i"), F.col(text).alias("t")))).alias("x"))
    n = F.size("x")
    state = lists.select(
        "_k", F.col("x.i").alias("indexes"), F.col("x.t").alias("texts"), F.sequence(F.lit(0), n - 1).alias("order"),
        F.array_repeat(F.lit(0).cast("byte"), F.floor(n * (n - 1) / 2).cast("int")).alias("known"), F.lit(0).alias("calm"), ((n > 1) & F.lit(quiet > 0)).alias("open"),
    )
    path, r = shared_path(spark, "lists"), 0
    state = stored(state, "lists", path)
    while not state.where("open").isEmpty():
        told = in_arrow(state.where("open"), _round(r, quiet, judge), state.schema)
        told = told.withColumns({c: F.when(F.col("open"), F.col(c)) for c in ("texts", "known")})
        before, path, r = path, shared_path(spark, "lists"), r + 1
        state = stored(told.unionByName(state.where("not open")), "lists", path)
        drop_path(spark, before)
    places = state.select("_k", "indexes", F.posexplode("order").alias("place", "p"))
    return places.select(F.col("_k").alias(key), F.get("indexes", F.col("p")).alias(index), (F.col("place") + 1).cast("int").alias("place"))


def sorted_branches(branches: Column, score_key: str = "score") -> Column:
    """Branches by their score, highest first; equal ones stay in order, none counts 0."""
    rows = F.transform(branches, lambda b, i: F.struct((-F.coalesce(b[score_key], F.lit(0.0))).alias("k"), i.alias("i"), b.alias("b")))
    return F.transform(F.array_sort(rows), lambda x: x["b"])


# ---- statistics -------------------------------------------------------------

# What an error's text says, in the order tried, and its kind.
ERRORS = (("No RANKING:", "no_ranking_found"), ("Wrong number of elements", "wrong_count"), ("Duplicate values", "duplicate_values"), ("Missing values", "missing_values"), ("Values outside 1-9 range", "invalid_range"), ("Non-numeric values", "non_numeric"), ("Invalid alphabetic labels", "invalid_labels"), ("API", "api_error"), ("Correlation undefined", "correlation_undefined"), ("No valid score", "no_score_output"))


def error_kind(detail: Column) -> Column:
    out = F.when(F.lit(False), "")
    for text, kind in ERRORS:
        out = out.when(detail.contains(text), kind)
    return out.otherwise("other")


def overall(df: DataFrame) -> DataFrame:
    """One row of metrics over (success, retries, spearman, kendall, hits, tokens)."""
    good = F.col("success")
    of = lambda f, c: f(F.when(good, F.col(c)))
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("total"), F.count_if(good).alias("successful"), (n - F.count_if(good)).alias("failed"), F.avg(good.cast("double")).alias("success_rate"),
        F.count_if(F.col("retries") > 0).alias("samples_retried"), F.sum("retries").alias("total_retries"),
        of(F.avg, "spearman").alias("mean_spearman"), of(F.stddev_pop, "spearman").alias("std_spearman"), of(F.median, "spearman").alias("median_spearman"),
        of(F.avg, "kendall").alias("mean_kendall"), of(F.stddev_pop, "kendall").alias("std_kendall"), of(F.median, "kendall").alias("median_kendall"),
        (of(F.avg, "hits") / 3).alias("mean_top3"), F.count_if(good & (F.col("spearman") == 1.0)).alias("perfect"), F.sum("tokens").alias("total_tokens"),
    )


def report(metrics: DataFrame, method: str, model: str) -> str:
    """The row of :func:`overall` as a Markdown page."""
    row = metrics.head().asDict()
    number = lambda x: "–" if x is None else f"{x:+.3f}" if isinstance(x, float) else str(x)
    return "\n".join([f"# {method}: {model}", "", "| metric | value |", "| --- | --- |", *(f"| {k.replace('_', ' ')} | {number(v)} |" for k, v in row.items()), ""])


def position_accuracy(df: DataFrame, predicted: str = "predicted", truth: str = "ground_truth") -> DataFrame:
    """(position, accuracy) over arrays of equal length."""
    rows = df.select(F.posexplode(F.arrays_zip(F.col(predicted).alias("p"), F.col(truth).alias("t"))).alias("position", "x"))
    return rows.groupBy("position").agg(F.avg((F.col("x.p") == F.col("x.t")).cast("double")).alias("accuracy"))


def adjacent_swaps(df: DataFrame, predicted: str, truth: str) -> DataFrame:
    """(a, b, n): neighbouring ranks a, b = a + 1 that the prediction exchanged."""
    p, t = F.col(predicted), F.col(truth)
    at = lambda a, r: F.try_element_at(a, F.array_position(t, r).cast("int"))
    ranks = F.filter(F.sequence(F.lit(1), F.size(t) - 1), lambda r: (at(p, r) == r + 1) & (at(p, r + 1) == r))
    return df.select(F.explode(ranks).alias("a")).groupBy("a").agg(F.count(F.lit(1)).alias("n")).select("a", (F.col("a") + 1).alias("b"), "n")


def correlation_bin(value: Column, bins: int = 10) -> Column:
    """0 .. bins - 1 over [-1, 1]; 1 is in the last."""
    return F.least(F.floor((value + 1) * bins / 2), F.lit(bins - 1))


def position_shares(df: DataFrame, position: str, *by: str) -> DataFrame:
    """(by, position, n, percent) with percentages rounded half to even."""
    counts = df.groupBy(*by, position).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by)) if by else None
    if total is None:
        all_ = counts.agg(F.sum("n").alias("_t"))
        return counts.crossJoin(F.broadcast(all_)).select(position, "n", F.bround(F.col("n") * 100.0 / F.col("_t"), 2).alias("percent"))  # one row
    return counts.select(*by, position, "n", F.bround(F.col("n") * 100.0 / total, 2).alias("percent"))


def chi_square(df: DataFrame, position: str, places: int) -> DataFrame:
    """(chi_square, df) of uniform choice over 1..places; places never chosen count 0."""
    counts = df.where(F.col(position).between(1, places)).groupBy(position).agg(F.count(F.lit(1)).alias("n"))
    s = counts.agg(F.sum("n").alias("t"), F.sum(F.col("n") * F.col("n")).alias("q"))
    return s.select((F.col("q") * places / F.col("t") - F.col("t")).alias("chi_square"), F.lit(places - 1).alias("df"))


def chi_square_p(statistic: float, df: int) -> float:
    """Upper tail of the chi-square distribution, in closed form."""
    half = statistic / 2
    if df % 2 == 0:
        term, total = 1.0, 1.0
        for k in range(1, df // 2):
            term *= half / k
            total += term
        return math.exp(-half) * total
    out, term = math.erfc(math.sqrt(half)), math.exp(-half) * math.sqrt(half) * 2 / math.sqrt(math.pi)
    for k in range(1, df // 2 + 1):
        out += term
        term *= half / (k + 0.5)
    return out


def consistency(df: DataFrame, choice: str, *by: str) -> DataFrame:
    """(by, consistency): the share of the most frequent choice."""
    counts = df.groupBy(*by, choice).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*by).agg((F.max("n") / F.sum("n")).alias("consistency"))


def summary(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.avg(column).alias("mean"), F.median(column).alias("median"), F.min(column).alias("least"), F.max(column).alias("most"), F.stddev_pop(column).alias("std"))


def bias_flags(shares: DataFrame, position: str, places: int) -> DataFrame:
    """One row: whether the first, the last or the middle places are chosen too often."""
    expected = 100.0 / places
    at = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("percent"))), F.lit(0.0))
    p = F.col(position)
    return shares.agg((at(p == 1) > expected * 1.5).alias("primacy"), (at(p == places) > expected * 1.5).alias("recency"), (at((p > 1) & (p < places)) > expected * (places - 2) * 1.2).alias("middle"))


def grouped_bias(df: DataFrame, *dimensions: str) -> DataFrame:
    """(dimension, value, n, first_wins) over all dimensions in one pass."""
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    rows = df.select("first_won", F.explode(cells).alias("c")).select("first_won", "c.*")
    return rows.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("first_won").alias("first_wins"))


def pair_bias(df: DataFrame) -> DataFrame:
    """(dimension, value, total, first_wins, second_wins, first_percent) in one pass over comparisons.

    ``df`` has winner, question_order, mode and both positions; the distance follows from these.
    """
    first, second = F.col("first_position"), F.col("second_position")
    dims = {"all": F.lit("all"), "question_order": F.col("question_order"), "distance": F.abs(first - second), "first_position": first, "second_position": second, "mode": F.col("mode")}
    cells = F.array(*[F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("value")) for d, c in dims.items()])
    rows = df.select("winner", F.explode(cells).alias("c")).select("winner", "c.*")
    wins = lambda w: F.count_if(F.col("winner") == w)
    out = rows.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("total"), wins("first_mentioned").alias("first_wins"), wins("second_mentioned").alias("second_wins"))
    return out.withColumn("first_percent", F.bround(F.col("first_wins") * 100.0 / F.col("total"), 2))


def pair_flags(bias: DataFrame) -> DataFrame:
    """One row from :func:`pair_bias`: which side wins too often, and whether the question's order matters."""
    at = lambda d, v, c: F.coalesce(F.max(F.when((F.col("dimension") == d) & (F.col("value") == v), c)), F.lit(0.0))
    second = F.bround(F.col("second_wins") * 100.0 / F.col("total"), 2)
    share = F.col("first_percent")
    sums = bias.agg(at("all", "all", share).alias("first"), at("all", "all", second).alias("second"), at("question_order", "original_order", share).alias("original"), at("question_order", "reversed_order", share).alias("reversed"))
    effect = F.abs(F.col("original") - F.col("reversed"))
    direction = F.when(F.col("first") > F.col("second"), "first_mentioned").when(F.col("second") > F.col("first"), "second_mentioned").otherwise("None")
    return sums.select("first", "second", (F.abs(F.col("first") - F.col("second")) > 10).alias("biased"), direction.alias("direction"), effect.alias("order_effect"), (effect > 5).alias("order_matters"))


def position_table(df: DataFrame, key: str, position: str, places: int) -> DataFrame:
    """One row a sample, one column p1, p2, ... a place: how often it was chosen."""
    wide = df.groupBy(key).pivot(position, list(range(1, places + 1))).count().na.fill(0)
    return wide.select(key, *[F.col(str(k)).alias(f"p{k}") for k in range(1, places + 1)])


def agreement(df: DataFrame, *columns: str) -> DataFrame:
    """One row: the percentage of rows on which each two columns agree."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return df.agg(*[(F.avg((F.col(a) == F.col(b)).cast("double")) * 100).alias(f"{a}_{b}") for a, b in pairs])


def consensus(df: DataFrame, key: str, answer: str, logprob: str) -> DataFrame:
    """(key, answer, share, confidence): the modal answer, its share and mean probability."""
    counts = df.groupBy(key, answer).agg(F.count(F.lit(1)).alias("n"), F.avg(F.exp(logprob)).alias("c"))
    best = F.max_by(F.struct(answer, "n", "c"), F.struct(F.col("n"), F.col("c"), F.col(answer)))
    return counts.groupBy(key).agg(best.alias("b"), F.sum("n").alias("t")).select(key, F.col(f"b.{answer}").alias(answer), (F.col("b.n") / F.col("t")).alias("share"), F.col("b.c").alias("confidence"))


def test_cases(samples: DataFrame, orderings: int, modes: Sequence[str]) -> DataFrame:
    """Each sample with every ordering number and mode."""
    return samples.withColumn("ordering", F.explode(F.sequence(F.lit(0), F.lit(orderings - 1)))).withColumn("mode", F.explode(F.array(*map(F.lit, modes))))


def item_pairs(items: Column) -> Column:
    """Unordered pairs (i, j), i < j, of a short list's places from 0."""
    places = F.sequence(F.lit(0), F.size(items) - 1)
    return F.flatten(F.transform(places, lambda i: F.transform(F.filter(places, lambda j: j > i), lambda j: F.struct(i.alias("i"), j.alias("j")))))


def write_back_scores(df: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Scores (key, branch, score) into the branches they belong to; others stay null."""
    lists = scores.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("branch", "score"))).alias("_s"))
    return df.join(lists, key, "left").withColumn("conversation_branches", F.transform("conversation_branches", lambda b, i: b.withField("score", F.try_element_at(F.col("_s"), i)))).drop("_s")
