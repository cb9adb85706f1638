"""Annotations of conversations: keywords, languages, thoughts, classifier tasks."""

from __future__ import annotations

import json
import math
import random
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.model import PART, SYSTEM, empty_map, part, prompt, strip, title
from quarry.session import ship

FENCED = "struct<type:string,content:string,name:string,args:string>"

# Labels of the classifiers.
LABELS = {"refusal": ("refusal", "no_refusal"), "assistant": ("ai_assistant_related", "non_ai_assistant"), "ideology": ("0", "1", "2", "3"), "quality": ("1", "2", "3"), "complexity": ("1", "2", "3", "4", "5")}

NO_CONTEXT = "[No previous context]"


def parts_of(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, branch, message, part, role, type, content): one row per part."""
    rows = df.select(*keys, F.posexplode("conversation_branches").alias("branch", "_b"))
    rows = rows.select(*keys, "branch", F.posexplode("_b.messages").alias("message", "_m"))
    rows = rows.select(*keys, "branch", "message", F.col("_m.role").alias("role"), F.posexplode("_m.parts").alias("part", "_p"))
    return rows.select(*keys, "branch", "message", "part", "role", F.col("_p.type").alias("type"), F.col("_p.content").alias("content"))


def _map_parts(branches: Column, change: Callable[[Column, Column], Column]) -> Column:
    """Branches with every part p of a message m changed to change(m, p)."""
    message = lambda m: m.withField("parts", F.transform(m["parts"], lambda p: change(m, p)))
    return F.transform(branches, lambda b: b.withField("messages", F.transform(b["messages"], message)))


def _noted(s: Column, key: str, value: Column) -> Column:
    """A text's struct with one entry of its metadata set; a null value leaves it as it is."""
    old = F.coalesce(s["metadata"], empty_map())
    return s.withField("metadata", F.when(value.isNotNull(), F.map_concat(F.map_filter(old, lambda k, _: k != key), F.create_map(F.lit(key), value))).otherwise(old))


def _note_texts(df: DataFrame, key: str, value: Callable[[Column, Column], Column]) -> DataFrame:
    """Metadata of both prompts and of all parts: ``value`` of a text's (content, type)."""
    prompt_kind = F.lit("prompt")
    out = df
    for name in ("system_prompt", "initial_prompt"):
        out = out.withColumn(name, F.when(F.col(name).isNotNull(), _noted(F.col(name), key, value(F.col(name)["content"], prompt_kind))))
    return out.withColumn("conversation_branches", _map_parts(F.col("conversation_branches"), lambda _, p: _noted(p, key, value(p["content"], p["type"]))))


KEYWORDS = "keyword_detection"


def keyword_result(content: Column, keywords: Sequence[str]) -> Column:
    """What was found in a text, as JSON."""
    found = T.keywords_in(F.coalesce(strip(content), F.lit("")), keywords)
    return F.to_json(F.struct(found.alias("assistant_keywords_found"), (F.size(found) > 0).alias("has_assistant_keywords"), F.lit("assistant_keyword_detection").alias("filter_type"), F.lit(len(keywords)).alias("total_keywords_checked")))


def mark_keywords(df: DataFrame, keywords: Sequence[str] = T.ASSISTANT_KEYWORDS) -> DataFrame:
    """The result for each text in its metadata, and a flag for the row."""
    out = _note_texts(df, KEYWORDS, lambda content, _: keyword_result(content, keywords))
    has = lambda s: F.coalesce(F.get_json_object(s["metadata"][KEYWORDS], "$.has_assistant_keywords") == "true", F.lit(False))
    branch = F.exists("conversation_branches", lambda b: F.exists(b["messages"], lambda m: F.exists(m["parts"], has)))
    return out.withColumn("sample_has_assistant_keywords", has(F.col("system_prompt")) | has(F.col("initial_prompt")) | F.coalesce(branch, F.lit(False)))


def message_count() -> Column:
    """Prompts and messages of a record."""
    inside = F.aggregate("conversation_branches", F.lit(0), lambda a, b: a + F.size(b["messages"]))
    return F.when(F.col("system_prompt").isNotNull(), 1).otherwise(0) + F.when(F.col("initial_prompt").isNotNull(), 1).otherwise(0) + inside


def language_input(text: Column, most: int = 10_000) -> Column:
    """What the language model reads: one line, stripped, at most ``most`` characters (the model's own limit)."""
    return F.substring(strip(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))), 1, most)


@dataclass(frozen=True)
class LanguageModel:
    """Character trigrams of each language with the logarithms of their shares."""

    grams: dict[str, dict[str, float]]
    unseen: float

    @cached_property
    def table(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, all trigrams as sorted numbers, and for each of them what it adds for each language."""
        names = list(self.grams)
        known = sorted({g for own in self.grams.values() for g in own}, key=lambda g: int(_trigrams(g)[0]))
        more = np.array([[self.grams[k].get(g, self.unseen) - self.unseen for k in names] for g in known]).reshape(-1, len(names))
        return names, np.array([_trigrams(g)[0] for g in known], np.uint64), more

    def __call__(self, text: str) -> list[tuple[str, float]]:
        """(language, probability), the likeliest first."""
        found = _trigrams(f" {text.lower()} ")
        if not self.grams or not len(found):
            return [("unknown", 0.0)]
        names, known, more = self.table
        at = np.minimum(np.searchsorted(known, found), len(known) - 1)
        sums = more[at[known[at] == found]].sum(0) if len(known) else np.zeros(len(names))  # what is unseen adds alike for all
        weights = np.exp(np.maximum(sums - sums.max(), -700.0))
        return sorted(zip(names, (weights / weights.sum()).tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def _trigrams(text: str) -> np.ndarray:
    """Each three characters in a row as one number, 21 bits a character."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    return (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]


def train_languages(rows: DataFrame, text: str, label: str, key: str, *, sample_rows: int = 500, most: int = 5000) -> LanguageModel:
    """Trigram counts of at most ``sample_rows`` rows of each label, drawn by a hash of ``key``; of each
    label the ``most`` frequent trigrams are kept.  The model holds labels x ``most`` numbers."""
    labels = sorted(r[0] for r in rows.where(F.col(label).isNotNull()).select(label).distinct().collect())  # a handful of names
    drawn = None
    for name in labels:
        part_ = rows.where((F.col(label) == name) & (F.col(text) != "")).orderBy(F.xxhash64(key), key).limit(sample_rows).select(F.col(label).alias("label"), F.concat(F.lit(" "), F.lower(text), F.lit(" ")).alias("t"))
        drawn = part_ if drawn is None else drawn.unionByName(part_)
    if drawn is None:
        return LanguageModel({}, 0.0)
    grams = drawn.select("label", F.explode(F.transform(F.sequence(F.lit(1), F.length("t") - 2), lambda i: F.substr(F.col("t"), i, F.lit(3)))).alias("g"))
    counts = grams.groupBy("label", "g").agg(F.count(F.lit(1)).alias("n"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "g"))
    top = counts.withColumn("r", place).withColumn("t", F.sum("n").over(Window.partitionBy("label"))).where(F.col("r") <= most)
    held: dict[str, dict[str, float]] = {name: {} for name in labels}
    for r in top.collect():  # bounded: labels x most
        held[r.label][r.g] = math.log(r.n / r.t)
    return LanguageModel(held, math.log(1e-7))


Model = Callable[[str], list[tuple[str, float]]]


def _labelled(model: Model, text: str | None, top: int) -> list[dict]:
    """The top labels of one text; empty is unknown, a failure error."""
    if not text:
        return [{"label": "unknown", "score": 0.0}]
    try:
        return [{"label": k, "score": float(s)} for k, s in model(text)[:top]]
    except Exception:  # noqa: BLE001  the row says so
        return [{"label": "error", "score": 0.0}]


def annotate_language(df: DataFrame, text: Column, load: Callable[[], Model], *, top: int = 1) -> DataFrame:
    """``df`` with ``languages``: the top (label, score).  ``load`` makes the model, once per task."""
    ship(df.sparkSession)

    @F.pandas_udf("array<struct<label:string,score:double>>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for b in batches:
            yield b.map(lambda t: _labelled(model, t, top))

    return df.withColumn("languages", label(language_input(text)))


def annotate_record_languages(df: DataFrame, load: Callable[[], Model], *, model: str, top: int = 3) -> DataFrame:
    """Records with ``language_classification`` (JSON) in the metadata of both prompts and of response
    parts, where they have text.  A record's texts are labelled together, and found again by what they say."""
    ship(df.sparkSession)

    @F.pandas_udf("array<array<struct<label:string,score:double>>>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = load()
        for b in batches:
            yield b.map(lambda texts: [_labelled(own, t, top) for t in texts])

    parts = F.flatten(F.flatten(F.transform("conversation_branches", lambda b: F.transform(b["messages"], lambda m: F.transform(F.filter(m["parts"], lambda p: p["type"] == "response"), lambda p: p["content"])))))
    spoken = F.concat(F.array(F.col("system_prompt.content"), F.col("initial_prompt.content")), F.coalesce(parts, F.array().cast("array<string>")))
    texts = F.array_distinct(F.filter(F.transform(spoken, lambda t: language_input(t)), lambda t: t != ""))
    rows = df.withColumn("_texts", texts).withColumn("_known", F.map_from_arrays("_texts", label.asNondeterministic()(F.col("_texts"))))

    def told(content: Column, kind: Column) -> Column:
        found = F.try_element_at(F.col("_known"), language_input(content))
        listed = F.transform(found, lambda x: F.struct(x["label"].alias("language"), x["score"].alias("confidence")))
        value = F.to_json(F.struct(found[0]["label"].alias("primary_language"), found[0]["score"].alias("primary_confidence"), listed.alias("top_languages"), F.lit(model).alias("model"), F.lit(top).alias("top_k")))
        return F.when(kind.isin("prompt", "response") & found.isNotNull(), value)

    return _note_texts(rows, "language_classification", told).drop("_texts", "_known")


def think_parts(branches: Column) -> Column:
    """Think blocks of the assistant's responses as thoughts before the rest."""

    def split(p: Column) -> Column:
        inner = F.transform(T.thoughts(p["content"]), lambda t: part("thought", t))
        rest = T.without_thoughts(p["content"])
        out = F.concat(inner, F.when(rest != "", F.array(part("response", rest, metadata=p["metadata"]))).otherwise(F.array().cast(inner_type)))
        return F.when((F.lower(p["type"]) == "response") & (F.size(out) > 0), out).otherwise(F.array(p))

    inner_type = f"array<{PART}>"
    message = lambda m: F.when(m["role"] == "assistant", m.withField("parts", F.flatten(F.transform(m["parts"], split)))).otherwise(m)
    return F.transform(branches, lambda b: b.withField("messages", F.transform(b["messages"], message)))


def system_choice(current: Column, custom: Column, *, custom_first: bool = False) -> Column:
    """The system text: the current one unless blank, else the custom one, else empty;
    or the custom one first and null if there is neither."""
    now, other = F.nullif(strip(current), F.lit("")), F.nullif(strip(custom), F.lit(""))
    if custom_first:
        return F.coalesce(F.when(other.isNotNull(), custom), F.when(now.isNotNull(), current))
    return F.coalesce(F.when(now.isNotNull(), current), F.when(other.isNotNull(), custom), F.lit(""))


def lift_prompt(df: DataFrame) -> DataFrame:
    """An initial prompt that isn't blank stays; else the first user message of all
    branches becomes it, and only that message is removed."""
    users = F.flatten(F.transform("conversation_branches", lambda b, i: F.transform(b["messages"], lambda m, j: F.struct(m["role"].alias("role"), F.lit(i).alias("b"), F.lit(0).alias("x"), F.struct(m.alias("m"), j.alias("j")).alias("w")))))
    blank = F.coalesce(strip(F.col("initial_prompt.content")), F.lit("")) == ""
    first = F.try_element_at(F.filter(users, lambda u: u["role"] == "user"), F.lit(1))
    rows = df.withColumn("_f", F.when(blank, first))
    text = F.array_join(F.transform(F.filter(F.col("_f.w.m.parts"), lambda p: p["type"] == "response"), lambda p: p["content"]), " ")
    kept = F.transform("conversation_branches", lambda b, i: b.withField("messages", F.filter(b["messages"], lambda m, j: ~((i == F.col("_f.b")) & (j == F.col("_f.w.j"))))))
    found = F.col("_f").isNotNull()
    return rows.withColumn("conversation_branches", F.when(found, kept).otherwise(F.col("conversation_branches"))).withColumn("initial_prompt", F.when(found, prompt(text)).otherwise(F.col("initial_prompt"))).drop("_f")


def fix_system(df: DataFrame, custom: Column) -> DataFrame:
    """Custom instructions that aren't empty replace the system text and leave its metadata."""
    told = F.col("system_prompt")["metadata"] if "system_prompt" in df.columns else F.lit(None).cast("map<string,string>")
    fixed = F.struct(custom.alias("content"), F.coalesce(told, empty_map()).alias("metadata"))
    old = F.col("system_prompt") if "system_prompt" in df.columns else F.lit(None).cast(SYSTEM)
    return df.withColumn("system_prompt", F.when(F.coalesce(custom, F.lit("")) != "", fixed).otherwise(old))


def system_counts(df: DataFrame, custom: Column) -> DataFrame:
    """One row: how many records have custom instructions, a system prompt, both, or no instructions."""
    own, now = custom.isNotNull(), F.col("system_prompt").isNotNull()
    return df.agg(F.count_if(own).alias("with_custom"), F.count_if(now).alias("with_system"), F.count_if(own & now).alias("with_both"), F.count_if(~own).alias("without_custom"))


def unbox_parts(df: DataFrame, key: str = "conversation_id") -> DataFrame:
    """(key, branch, message, part, text, answers) of assistant responses with boxes."""
    rows = parts_of(df, key).where("role = 'assistant' AND type = 'response'").where(F.col("content").contains("\\boxed{"))
    return rows.withColumn("_x", T.boxed("content")).select(key, "branch", "message", "part", F.col("_x.text").alias("text"), F.col("_x.answers").alias("answers"))


def _found_by_text(df: DataFrame, parse: Callable[[Column], Column]) -> DataFrame:
    """``df`` with ``_found``: a map from each text of the assistant's responses to what ``parse`` says of it."""
    responses = lambda m: F.transform(F.filter(m["parts"], lambda p: (m["role"] == "assistant") & (p["type"] == "response") & p["content"].isNotNull()), lambda p: p["content"])
    texts = F.array_distinct(F.flatten(F.flatten(F.transform("conversation_branches", lambda b: F.transform(b["messages"], responses)))))
    return df.withColumn("_texts", texts).withColumn("_found", F.map_from_arrays("_texts", parse(F.col("_texts")))).drop("_texts")


def unbox(df: DataFrame) -> DataFrame:
    """Boxes taken off the assistant's responses; a message's answers become its verifiable part, in the
    place of one that is there, else at the end."""

    def message(m: Column) -> Column:
        of = lambda p: F.when(p["type"] == "response", F.try_element_at(F.col("_found"), p["content"]))
        plain = F.transform(m["parts"], lambda p: F.when(of(p).isNotNull(), p.withField("content", of(p)["text"])).otherwise(p))
        answers = F.flatten(F.transform(m["parts"], lambda p: F.coalesce(of(p)["answers"], F.array().cast("array<string>"))))
        place = F.array_position(F.transform(m["parts"], lambda p: p["type"]), "verifiable-responses")
        new = part("verifiable-responses", answers=answers)
        put = F.when(place > 0, F.transform(plain, lambda p, i: F.when(i + 1 == place, new).otherwise(p))).otherwise(F.concat(plain, F.array(new)))
        return F.when(m["role"] == "assistant", m.withField("parts", F.when(F.size(answers) > 0, put).otherwise(plain))).otherwise(m)

    rows = _found_by_text(df, T.boxed_each)
    return rows.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: b.withField("messages", F.transform(b["messages"], message)))).drop("_found")


def box_counts(df: DataFrame, key: str = "conversation_id") -> DataFrame:
    """One row: the assistant's messages with a box, and all boxes."""
    mark = "\\boxed{"
    n = (F.length("content") - F.length(F.replace("content", F.lit(mark), F.lit("")))) / len(mark)
    rows = parts_of(df, key).where("role = 'assistant' AND type = 'response'").groupBy(key, "branch", "message").agg(F.sum(n).cast("long").alias("n"))
    return rows.agg(F.count_if(F.col("n") > 0).alias("messages"), F.coalesce(F.sum("n"), F.lit(0)).alias("boxes"))


def answer_counts(df: DataFrame) -> DataFrame:
    """One row: records and messages with verifiable answers, all answers, messages with several."""
    of = lambda m: F.size(F.flatten(F.transform(F.filter(m["parts"], lambda p: p["type"] == "verifiable-responses"), lambda p: F.coalesce(p["answers"], F.array().cast("array<string>")))))
    many = F.flatten(F.transform("conversation_branches", lambda b: F.transform(F.filter(b["messages"], lambda m: m["role"] == "assistant"), of)))
    rows = df.select(F.filter(many, lambda n: n > 0).alias("n"))
    total = F.coalesce(F.sum(F.aggregate("n", F.lit(0), lambda a, x: a + x)), F.lit(0))
    return rows.agg(F.count_if(F.size("n") > 0).alias("samples"), F.coalesce(F.sum(F.size("n")), F.lit(0)).alias("messages"), total.alias("answers"), F.coalesce(F.sum(F.size(F.filter("n", lambda x: x > 1))), F.lit(0)).alias("several"))


BLOCK = "struct<type:string,role:string,content:string,name:string,args:string>"


def parts_from_blocks(df: DataFrame) -> DataFrame:
    """Messages (role, content, blocks, parts) to messages of parts.

    An assistant's responses, untyped texts and plain contents are split at their fences; typed blocks
    are parts already.  The others' blocks are joined to one response.
    """
    kinds = F.array(*map(F.lit, ("response", "thought", "function-call", "function-output")))
    name = lambda b: F.replace(F.lower(F.coalesce(b["type"], F.lit(""))), F.lit("_"), F.lit("-"))
    known = lambda b: F.array_contains(kinds, name(b))
    thought = lambda b: ~known(b) & (F.lower(F.coalesce(b["role"], F.lit(""))) == "thought")
    loose = lambda b: F.coalesce(~known(b) & ~thought(b), F.lit(False))
    spoken = lambda m: F.concat(
        F.coalesce(F.transform(F.filter(m["parts"], lambda p: p["type"] == "response"), lambda p: p["content"]), F.array().cast("array<string>")),
        F.coalesce(F.transform(F.filter(m["blocks"], loose), lambda b: b["content"]), F.array().cast("array<string>")), F.array(m["content"]),
    )
    texts = F.flatten(F.flatten(F.transform("conversation_branches", lambda b: F.transform(F.filter(b["messages"], lambda m: m["role"] == "assistant"), spoken))))
    rows = df.withColumn("_texts", F.array_distinct(F.filter(texts, lambda t: t.isNotNull())))
    rows = rows.withColumn("_found", F.map_from_arrays("_texts", T.fences_each("_texts")))
    cut = lambda t: F.transform(F.coalesce(F.try_element_at(F.col("_found"), t), F.array().cast(f"array<{FENCED}>")), lambda p: part(p["type"], p["content"], name=p["name"], args=p["args"]))

    def block(b: Column) -> Column:
        typed = part(name(b), F.when(name(b) == "function-call", "").otherwise(b["content"]), name=F.when(name(b) == "function-call", b["name"]), args=F.when(name(b) == "function-call", b["args"]))
        return F.when(known(b), F.array(typed)).when(thought(b), F.array(part("thought", strip(b["content"])))).otherwise(cut(b["content"]))

    def message(m: Column) -> Column:
        made = F.when(F.size(m["parts"]) > 0, F.flatten(F.transform(m["parts"], lambda p: F.when(p["type"] == "response", cut(p["content"])).otherwise(F.array(p))))).when(m["blocks"].isNotNull(), F.flatten(F.transform(m["blocks"], block))).otherwise(cut(m["content"]))
        bare = strip(F.coalesce(m["content"], F.lit("")))
        own = F.when((F.size(made) == 0) & (bare != ""), F.array(part("response", bare))).otherwise(made)
        joined = F.array_join(F.filter(F.transform(m["blocks"], lambda b: b["content"]), lambda t: F.coalesce(t, F.lit("")) != ""), "\n")
        said = F.array(part("response", strip(F.coalesce(F.when(m["blocks"].isNotNull(), joined), m["content"], F.lit("")))))
        return F.struct(m["role"].alias("role"), F.when(m["role"] == "assistant", own).otherwise(said).alias("parts"))

    return rows.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: F.struct(F.transform(b["messages"], message).alias("messages")))).drop("_texts", "_found")


# ---- classifier tasks -------------------------------------------------------


def response_tasks(df: DataFrame, key: str = "conversation_id") -> DataFrame:
    """(key, branch, message, part, question, answer): one task per assistant response.

    The question is the conversation before the message: prompts, then messages over
    all branches in order; nothing before it reads NO_CONTEXT.
    """
    spoken = lambda m: F.array_join(F.transform(F.filter(m["parts"], lambda p: (p["type"] == "response") & (strip(p["content"]) != "")), lambda p: p["content"]), " ")
    line = lambda role, text: F.concat(title(role), F.lit(": "), text)
    head = F.array_compact(F.array(F.when(strip(F.col("system_prompt.content")) != "", F.concat(F.lit("System: "), F.col("system_prompt.content"))), F.when(strip(F.col("initial_prompt.content")) != "", line(F.col("initial_prompt.role"), F.col("initial_prompt.content")))))
    flat = F.flatten(F.transform("conversation_branches", lambda b, i: F.transform(b["messages"], lambda m, j: F.struct(i.alias("branch"), j.alias("message"), m.alias("m"), F.when(spoken(m) != "", line(m["role"], spoken(m))).alias("line")))))
    rows = df.select(key, head.alias("_h"), flat.alias("_f")).select(key, "_h", "_f", F.posexplode("_f").alias("_n", "_x")).where("lower(_x.m.role) = 'assistant'")
    before = F.array_compact(F.concat("_h", F.transform(F.slice("_f", F.lit(1), F.col("_n") + 1), lambda x: x["line"])))
    context = F.when(F.size(before) > 1, F.array_join(F.slice(before, F.lit(1), F.size(before) - 1), "\n")).otherwise(NO_CONTEXT)
    rows = rows.select(key, F.col("_x.branch").alias("branch"), F.col("_x.message").alias("message"), context.alias("question"), F.posexplode("_x.m.parts").alias("part", "_p"))
    return rows.where((F.col("_p.type") == "response") & (strip(F.col("_p.content")) != "")).select(key, "branch", "message", "part", "question", F.col("_p.content").alias("answer"))


def prompt_tasks(df: DataFrame, key: str = "conversation_id") -> DataFrame:
    """One task for each initial prompt that isn't blank."""
    return df.where(strip(F.col("initial_prompt.content")) != "").select(key, F.lit(-1).alias("branch"), F.lit(-1).alias("message"), F.lit(-1).alias("part"), F.lit(NO_CONTEXT).alias("question"), F.col("initial_prompt.content").alias("answer"))


def identity_tasks(df: DataFrame, key: str = "conversation_id") -> DataFrame:
    """A task for each of the assistant's responses and one for the initial prompt."""
    return response_tasks(df, key).unionByName(prompt_tasks(df, key))


def record_tasks(df: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Always one task: the system prompt and the initial prompt, empty where there is none."""
    text = lambda name: F.coalesce(F.col(name)["content"], F.lit(""))
    return df.select(key, F.lit(-1).alias("branch"), F.lit(-1).alias("message"), F.lit(-1).alias("part"), text("system_prompt").alias("question"), text("initial_prompt").alias("answer"))


@dataclass(frozen=True)
class Classifier:
    """What a classifier is: its tasks, the question it asks, its labels, and where results go."""

    name: str
    labels: tuple[str, ...]
    tasks: Callable[[DataFrame, str], DataFrame]
    template: str = "{question}\n\n{answer}"

    def run(self, df: DataFrame, ask: Callable[[str], str], model: str, key: str = "conversation_id", **options) -> DataFrame:
        """``df`` with the results in the metadata of the texts that were judged."""
        results = classify(self.tasks(df, key), self.labels, ask, template=self.template, keys=(key, "branch", "message", "part"), **options)
        return write_to_texts(df, results, self.name, model, key)


def parsed_answer(answer: str) -> tuple[str | None, str]:
    """(classification, reasoning) of a JSON answer, else the answer itself as the classification."""
    try:
        said = json.loads(T.repaired(answer) or "")
    except ValueError:
        return answer.strip() or None, ""
    if not isinstance(said, dict):
        return str(said), ""
    label = said.get("classification")
    return None if label is None else str(label), str(said.get("reasoning") or "")


def classify(
    tasks: DataFrame, labels: Sequence[str], ask: Callable[[str], str], *, template: str = "{question}\n\n{answer}", attempts: int = 4, pause: float = 1.0,
    failures: tuple[type[Exception], ...] = (OSError, ValueError, RuntimeError), keys: Sequence[str] = ("conversation_id", "branch", "message", "part"),
) -> DataFrame:
    """``keys`` with classification, reasoning, success and error.

    The client gets the filled template and answers in JSON.  An answer that is no label, or a failure of the
    kinds named, is asked again after pauses that double, with a jitter; after the last attempt the row
    counts as the last label, without success.  Other errors are the client's own and fail the task.
    """
    allowed = tuple(labels)
    ship(tasks.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for question, answer in zip(rows["question"], rows["answer"], strict=True):
                said, why, error = allowed[-1], "", None
                for k in range(attempts):
                    if k and pause:
                        time.sleep(pause * 2 ** (k - 1) * (1 + random.random() / 2))
                    try:
                        got, reasoning = parsed_answer(ask(template.format(question=question, answer=answer)))
                    except failures as e:
                        error = str(e)
                        continue
                    if got in allowed:
                        said, why, error = got, reasoning, None
                        break
                    error = f"not a label: {got}"
                out.append((said, why, error is None, error))
            done = rows[list(keys)].copy()
            done[["classification", "reasoning", "success", "error"]] = pd.DataFrame(out, index=rows.index, columns=["classification", "reasoning", "success", "error"])
            yield done

    shape = ", ".join(f"{k} {t}" for k, t in tasks.select(*keys).dtypes)
    return tasks.mapInPandas(run, f"{shape}, classification string, reasoning string, success boolean, error string")


def pending(tasks: DataFrame, done: DataFrame, keys: Sequence[str] = ("conversation_id", "branch", "message", "part")) -> DataFrame:
    """Tasks without a result yet."""
    return tasks.join(done.select(*keys).distinct(), list(keys), "left_anti")


RESULT = "struct<classification:string,reasoning:string,error:string>"


def write_back(df: DataFrame, results: DataFrame, classifier: str, model: str, key: str = "conversation_id") -> DataFrame:
    """``df`` with ``annotations[classifier.model]`` from one result per row of ``df``; results of other models stay."""
    reason = F.col("reasoning") if "reasoning" in results.columns else F.lit("")
    said = results.select(key, F.struct("classification", reason.alias("reasoning"), "error").cast(RESULT).alias("_r"))
    none = F.create_map().cast(f"map<string,{RESULT}>")
    old = F.coalesce(F.col("annotations"), none) if "annotations" in df.columns else none
    name = f"{classifier}.{model}"
    return df.join(said, key, "left").withColumn("annotations", F.when(F.col("_r").isNull(), old).otherwise(F.map_concat(F.map_filter(old, lambda k, _: k != name), F.create_map(F.lit(name), F.col("_r"))))).drop("_r")


def write_to_texts(df: DataFrame, results: DataFrame, classifier: str, model: str, key: str = "conversation_id") -> DataFrame:
    """Results (key, branch, message, part, ...) in the metadata of the texts that they judge.

    The entry is ``<classifier>_classification.<model>``, as JSON, so models add up; branch -1 is the initial prompt.
    What one row gathers are the results of its own texts.
    """
    failed = F.when(~F.col("success"), F.coalesce(F.nullif("error", F.lit("")), F.lit("Classification failed")))
    told = F.to_json(F.struct("classification", F.coalesce("reasoning", F.lit("")).alias("reasoning"), failed.alias("error")))
    place = F.concat_ws(".", "branch", "message", "part")
    lists = results.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(place.alias("k"), told.alias("v")))).alias("_r"))
    entry = f"{classifier}_classification.{model}"
    at = lambda b, m, p: F.try_element_at(F.col("_r"), F.concat_ws(".", b.cast("string"), m.cast("string"), p.cast("string")))
    rows = df.join(lists, key, "left")
    rows = rows.withColumn("initial_prompt", F.when(F.col("initial_prompt").isNotNull(), _noted(F.col("initial_prompt"), entry, F.try_element_at("_r", F.lit("-1.-1.-1")))))
    message = lambda m, b, j: m.withField("parts", F.transform(m["parts"], lambda p, i: _noted(p, entry, at(b, j, i))))
    return rows.withColumn("conversation_branches", F.transform("conversation_branches", lambda x, b: x.withField("messages", F.transform(x["messages"], lambda m, j: message(m, b, j))))).drop("_r")


def label_number(label: Column) -> Column:
    return F.coalesce(label.try_cast("int"), F.lit(0))


def complexity_scores(answer: Column) -> dict[str, Column]:
    """Scores of a JSON answer; score and reasoning swapped back, a digit rescued;
    products as text, or ``error``."""
    v = F.try_parse_json(answer)
    out = {}
    for name in ("complexity", "quality", "completeness"):
        score, reason = F.try_variant_get(v, f"$.{name}", "string"), F.try_variant_get(v, f"$.{name}_reasoning", "string")
        swapped = reason.rlike("^[1-5]$") & ~F.coalesce(score.rlike("^[1-5]$"), F.lit(False))
        digit = F.nullif(F.regexp_extract(F.when(F.coalesce(swapped, F.lit(False)), reason).otherwise(score), "[1-5]", 0), F.lit(""))
        out[name] = digit
    number = {k: c.try_cast("int") for k, c in out.items()}
    out["complexity_x_quality"] = F.coalesce((number["complexity"] * number["quality"]).cast("string"), F.lit("error"))
    out["all_three"] = F.coalesce((number["complexity"] * number["quality"] * number["completeness"]).cast("string"), F.lit("error"))
    return out


def previous_user(turns: DataFrame, *, id_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    w = Window.partitionBy(id_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("previous_user", F.last(F.when(F.col(role_col) == "user", F.col(text_col)), ignorenulls=True).over(w))
