"""Queries of the annotations that are written back into records, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.model import part
from quarry.operators import annotate, convert, filters
from quarry.plans.catalog import TURNS, query, records, table

LANGUAGES = {"est": "fr", "der": "de", "el": "es"}


def one_word(text: str) -> list[tuple[str, float]]:
    """A model that any SQL can follow: the language of the first word it knows."""
    found = [LANGUAGES[w] for w in text.lower().split(" ") if w in LANGUAGES]
    return [(found[0], 1.0)] if found else [("en", 0.5)]


# The words one_word knows, as the first of them in a text.
FIRST = "list_filter(string_split(regexp_replace(lower(regexp_replace(replace({0}, chr(10), ' '), '^\\s+|\\s+$', '', 'g')), '', ''), ' '), lambda w: w IN ('est', 'der', 'el'))[1]"
LABEL = f"CASE {FIRST} WHEN 'est' THEN 'fr' WHEN 'der' THEN 'de' WHEN 'el' THEN 'es' ELSE 'en' END"


@query()
def language_annotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model trained on a bounded sample of the documents' languages labels all of them."""
    d = table(spark, sf_dir, "documents")
    model = annotate.train_languages(d, "text", "lang", "doc_id")
    return annotate.annotate_language(d, F.col("text"), lambda: model).select("doc_id", "lang", F.col("languages")[0]["label"].alias("label"))


@query(f"""WITH {TURNS} SELECT conversation_id, -1 AS message, {LABEL.format("left(prompt, 10000)")} AS label FROM h UNION ALL SELECT conversation_id, message::INTEGER, {LABEL.format("left(text, 10000)")} FROM r WHERE trim(text) <> ''""")
def language_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate.annotate_record_languages(records(spark, sf_dir), lambda: one_word, model="one-word")
    label = lambda s: F.get_json_object(s["metadata"]["language_classification"], "$.primary_language")
    rows = out.select("conversation_id", F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("message"), label(F.col("initial_prompt")).alias("label"))), F.transform(F.col("conversation_branches")[0]["messages"], lambda m, i: F.struct(i.alias("message"), label(m["parts"][0]).alias("label"))))).alias("x"))
    return rows.select("conversation_id", "x.*").where(F.col("label").isNotNull())


HIT = "regexp_matches(lower({0}), '(^|[^\\p{{L}}\\p{{N}}_]){1}($|[^\\p{{L}}\\p{{N}}_])')"


@query(f"""WITH {TURNS}, x AS (SELECT conversation_id, -1 AS message, prompt AS t FROM h UNION ALL SELECT conversation_id, message, text FROM r),
k AS (SELECT *, list_filter([CASE WHEN {HIT.format("t", "est")} THEN 'est' END, CASE WHEN {HIT.format("t", "con")} THEN 'con' END], lambda w: w IS NOT NULL) AS f FROM x)
SELECT conversation_id, message::INTEGER AS message, '{{"assistant_keywords_found":[' || array_to_string(list_transform(f, lambda w: '"' || w || '"'), ',') || '],"has_assistant_keywords":' || (len(f) > 0) || ',"filter_type":"assistant_keyword_detection","total_keywords_checked":2}}' AS found FROM k""")
def keyword_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate.mark_keywords(records(spark, sf_dir), ["est", "con"])
    told = lambda s: s["metadata"][annotate.KEYWORDS]
    rows = out.select("conversation_id", F.explode(F.concat(F.array(F.struct(F.lit(-1).alias("message"), told(F.col("initial_prompt")).alias("found"))), F.transform(F.col("conversation_branches")[0]["messages"], lambda m, i: F.struct(i.alias("message"), told(m["parts"][0]).alias("found"))))).alias("x"))
    return rows.select("conversation_id", "x.*")


def boxed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second message of the assistant's gets a box, every fourth two and a verifiable part that is there already."""
    boxed = lambda i, p: F.when(i % 4 == 0, F.concat(p["content"], F.lit(" \\boxed{1} or \\boxed{a{b}}"))).when(i % 2 == 0, F.concat(p["content"], F.lit(" \\boxed{2}"))).otherwise(p["content"])
    old = F.array(part("verifiable-responses", answers=F.array(F.lit("old"))), part("response", "end"))

    def message(m, i):
        own = F.transform(m["parts"], lambda p: p.withField("content", boxed(i, p)))
        return F.when(m["role"] == "assistant", m.withField("parts", F.when(i % 4 == 0, F.concat(own, old)).otherwise(own))).otherwise(m)

    return records(spark, sf_dir).withColumn("conversation_branches", F.transform("conversation_branches", lambda b: b.withField("messages", F.transform(b["messages"], message))))


@query(f"""WITH {TURNS} SELECT conversation_id, message::INTEGER AS message, CASE WHEN role <> 'assistant' OR message % 2 = 1 THEN 'response' WHEN message % 4 = 0 THEN 'response,verifiable-responses,response' ELSE 'response,verifiable-responses' END AS kinds,
text || CASE WHEN role <> 'assistant' OR message % 2 = 1 THEN '' WHEN message % 4 = 0 THEN ' 1 or a{{b}}' ELSE ' 2' END AS first, CASE WHEN role <> 'assistant' OR message % 2 = 1 THEN '' WHEN message % 4 = 0 THEN '1|a{{b}}' ELSE '2' END AS answers FROM r""")
def boxed_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate.unbox(boxed_records(spark, sf_dir)).select("conversation_id", F.posexplode(F.col("conversation_branches")[0]["messages"]).alias("message", "m"))
    answers = F.flatten(F.transform("m.parts", lambda p: p["answers"]))
    return out.select("conversation_id", "message", F.array_join(F.transform("m.parts", lambda p: p["type"]), ",").alias("kinds"), F.col("m.parts")[0]["content"].alias("first"), F.array_join(answers, "|").alias("answers"))


@query(f"WITH {TURNS}, b AS (SELECT CASE WHEN message % 4 = 0 THEN 2 ELSE 1 END AS n FROM r WHERE role = 'assistant' AND message % 2 = 0) SELECT count(*) AS messages, coalesce(sum(n), 0)::BIGINT AS boxes FROM b")
def boxed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.box_counts(boxed_records(spark, sf_dir))


@query(f"""WITH {TURNS}, b AS (SELECT conv_id, CASE WHEN message % 4 = 0 THEN 2 ELSE 1 END AS n FROM r WHERE role = 'assistant' AND message % 2 = 0)
SELECT count(DISTINCT conv_id) AS samples, count(*) AS messages, coalesce(sum(n), 0)::BIGINT AS answers, count(*) FILTER (n > 1) AS several FROM b""")
def answer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate.answer_counts(annotate.unbox(boxed_records(spark, sf_dir)))
    return out.select(*[F.col(c).cast("long").alias(c) for c in out.columns])


CUSTOM = "CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN '' WHEN 2 THEN ' ' END"


def with_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.struct(F.col("source").alias("content"), F.create_map(F.lit("k"), F.col("lang")).alias("metadata"))
    return table(spark, sf_dir, "documents").withColumn("system_prompt", F.when(F.col("doc_id") % 3 > 0, told)).withColumn("custom", F.expr(CUSTOM))


@query(f"SELECT doc_id, CASE WHEN coalesce(c, '') <> '' THEN c WHEN doc_id % 3 > 0 THEN source END AS content, CASE WHEN doc_id % 3 > 0 THEN lang END AS k FROM (SELECT *, {CUSTOM} AS c FROM documents)")
def system_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate.fix_system(with_system(spark, sf_dir), F.col("custom"))
    return out.select("doc_id", F.col("system_prompt.content").alias("content"), F.col("system_prompt.metadata")["k"].alias("k"))


@query(f"SELECT count(c) AS with_custom, count(*) FILTER (doc_id % 3 > 0) AS with_system, count(c) FILTER (doc_id % 3 > 0) AS with_both, count(*) - count(c) AS without_custom FROM (SELECT *, {CUSTOM} AS c FROM documents)")
def system_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.system_counts(with_system(spark, sf_dir), F.col("custom"))


@query("""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'assistant[thought::plan;response::a;function-call:execute_python:{"code": "x"};response::b]' WHEN 1 THEN 'assistant[function-call:f:{};function-output::out;thought::t]'
WHEN 2 THEN 'assistant[response::plain ' || lang || ']' WHEN 3 THEN 'user[response::one' || chr(10) || 'two]' ELSE 'assistant[response::kept;thought::th]' END AS message FROM documents""")
def mixed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = lambda **v: F.struct(*[F.lit(v.get(k)).cast("string").alias(k) for k in ("type", "role", "content", "name", "args")])
    at = F.col("doc_id") % 5
    fenced = "a\n```python\nx\n```\nb"
    none = F.lit(None).cast(f"array<{annotate.BLOCK}>")
    blocks = F.when(at == 0, F.array(block(type="Thought", content="plan"), block(role="text", content=fenced))).when(at == 1, F.array(block(type="function_call", name="f", args="{}"), block(type="function-output", content="out"), block(role="thought", content=" t ")))
    blocks = blocks.when(at == 3, F.array(block(content="one"), block(content=""), block(content="two"))).otherwise(none)
    parts = F.when(at == 4, F.array(part("response", " kept "), part("thought", "th")))
    m = F.struct(F.when(at == 3, "user").otherwise("assistant").alias("role"), F.when(at == 2, F.concat(F.lit(" plain "), F.col("lang"))).alias("content"), blocks.alias("blocks"), parts.alias("parts"))
    d = table(spark, sf_dir, "documents").select("doc_id", F.array(F.struct(F.array(m).alias("messages"))).alias("conversation_branches"))
    out = annotate.parts_from_blocks(d).select("doc_id", F.col("conversation_branches")[0]["messages"][0].alias("m"))
    told = F.transform("m.parts", lambda p: F.concat(p["type"], F.lit(":"), p["name"], F.lit(":"), F.coalesce(F.nullif(p["args"], F.lit("")), p["content"])))
    return out.select("doc_id", F.concat("m.role", F.lit("["), F.array_join(told, ";"), F.lit("]")).alias("message"))


# ---- classifiers ------------------------------------------------------------


def judge_words(text: str) -> str:
    """A client that any SQL can follow."""
    return '{"classification": "refusal", "reasoning": "est"}' if "est" in text.split("\n")[-1].split(" ") else '{"classification": "no_refusal",}'


SAID = "list_contains(string_split(list_last(string_split({0}, chr(10))), ' '), 'est')"


@query(f"""WITH {TURNS} SELECT conversation_id, message::INTEGER AS message, CASE WHEN {SAID.format("text")} THEN 'refusal' ELSE 'no_refusal' END AS classification, CASE WHEN {SAID.format("text")} THEN 'est' ELSE '' END AS reasoning, true AS success, CAST(NULL AS VARCHAR) AS error FROM r WHERE role = 'assistant' AND trim(text) <> ''""")
def refusal_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks = annotate.response_tasks(records(spark, sf_dir))
    return annotate.classify(tasks, annotate.LABELS["refusal"], judge_words).drop("branch", "part")


@query(f"""WITH {TURNS} SELECT conversation_id, message::INTEGER AS message, '{{"classification":"' || CASE WHEN {SAID.format("text")} THEN 'refusal","reasoning":"est"}}' ELSE 'no_refusal","reasoning":""}}' END AS told FROM r WHERE role = 'assistant' AND trim(text) <> ''""")
def refusal_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = annotate.Classifier("refusal", annotate.LABELS["refusal"], annotate.response_tasks)
    out = own.run(records(spark, sf_dir), judge_words, "m").select("conversation_id", F.posexplode(F.col("conversation_branches")[0]["messages"]).alias("message", "m"))
    return out.select("conversation_id", "message", F.col("m.parts")[0]["metadata"]["refusal_classification.m"].alias("told")).where(F.col("told").isNotNull())


@query(f"""WITH {TURNS} SELECT conversation_id, -1 AS message, prompt AS answer FROM h WHERE trim(prompt) <> '' UNION ALL SELECT conversation_id, message::INTEGER, text FROM r WHERE role = 'assistant' AND trim(text) <> ''""")
def identity_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.identity_tasks(records(spark, sf_dir)).select("conversation_id", "message", "answer")


@query(f"WITH {TURNS} SELECT conversation_id, coalesce((SELECT text FROM t WHERE t.conv_id = h.conv_id AND t.n = h.s), '') AS question, prompt AS answer FROM h")
def record_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.record_tasks(records(spark, sf_dir)).select("conversation_id", "question", "answer")


# ---- choosing by a model ----------------------------------------------------


def by_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of documents with two branches, by models m0 to m2, and a score of one of them."""
    d = table(spark, sf_dir, "documents")
    told = lambda k: F.create_map(F.lit("model"), F.concat(F.lit("m"), ((F.col("doc_id") + k) % 3).cast("string")))
    branch = lambda k, text: F.struct(F.array(F.struct(F.lit("assistant").alias("role"), F.array(part("thought", "x", metadata=told(k)), part("response", text, metadata=told(k))).alias("parts"))).alias("messages"))
    score = F.concat(F.lit('{"complexity_x_quality":"'), F.when(F.col("doc_id") % 5 == 0, "error").otherwise((F.col("doc_id") % 26).cast("string")), F.lit('"}'))
    asks = F.struct(F.lit("user").alias("role"), F.col("lang").alias("content"), F.create_map(F.lit("complexity_classification.m1"), score).alias("metadata"))
    made = convert.prompt_answers(d, "x", F.col("doc_id").cast("string"), [F.col("text")]).select(F.col("initial_prompt.content").cast("long").alias("doc_id"))
    return d.join(made, "doc_id").select("doc_id", asks.alias("initial_prompt"), F.array(branch(0, F.col("text")), branch(1, F.col("source"))).alias("conversation_branches"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 1 THEN text WHEN 0 THEN source END AS completion FROM documents")
def model_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_models(spark, sf_dir).select("doc_id", filters.model_completion(F.col("conversation_branches"), "m1").alias("completion"))


GATED = "(SELECT doc_id, (doc_id % 26)::DOUBLE AS score, length(CASE doc_id % 3 WHEN 1 THEN text ELSE source END) AS n FROM documents WHERE doc_id % 5 <> 0 AND doc_id % 26 >= 10 AND doc_id % 3 < 2 AND length(CASE doc_id % 3 WHEN 1 THEN text ELSE source END) <= 1500)"


@query(f"SELECT doc_id, score, n::INTEGER AS completion_length, 2 AS original_branch_count, 1 AS branches FROM {GATED}")
def target_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = filters.target_gate(by_models(spark, sf_dir), "m1", 10, order=["doc_id"], longest=1500)
    return out.select("doc_id", "filter_metadata.score", "filter_metadata.completion_length", "filter_metadata.original_branch_count", F.size("conversation_branches").alias("branches"))


@query(f"SELECT min(score) AS min_score, max(score) AS max_score, avg(score) AS avg_score, min(n)::INTEGER AS min_length, max(n)::INTEGER AS max_length, avg(n) AS avg_length FROM {GATED}")
def gate_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.gate_stats(filters.target_gate(by_models(spark, sf_dir), "m1", 10, order=["doc_id"], longest=1500))


