"""Queries over the driver's tables by name, and their SQL.

A query is a function (spark, sf_dir) -> DataFrame; the SQL beside it gives the same
rows from the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.paths import nested_get, text_of
from quarry.model import part, strip
from quarry.operators import annotate, convert, decontam, filters, judge, linearise, mixture, profile, split
from quarry.session import ship
from quarry.sources import io

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# ---- decontamination --------------------------------------------------------


def train_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")


def bench_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.concat(F.lit("bench"), (F.col("item_id") % 4).cast("string")).alias("benchmark"), F.col("item_id").alias("eval_idx"), "text")


def overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.shared_grams(train_texts(spark, sf_dir), bench_texts(spark, sf_dir))


GRAMS = """
tok AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(trim(text, E' \\t\\n\\r\\x0b\\f')), '\\s+'), lambda x: x <> '') AS tk FROM documents),
btok AS (SELECT item_id AS eval_idx, 'bench' || (item_id % 4) AS benchmark, list_filter(regexp_split_to_array(lower(trim(text, E' \\t\\n\\r\\x0b\\f')), '\\s+'), lambda x: x <> '') AS tk FROM benchmark),
tg AS (SELECT DISTINCT id, unnest(list_transform(range(0, greatest(len(tk) - 8, 0)), lambda i: array_to_string(list_slice(tk, i + 1, i + 8), ' '))) AS gram FROM tok),
bg AS (SELECT DISTINCT benchmark, eval_idx, unnest(list_transform(range(0, greatest(len(tk) - 8, 0)), lambda i: array_to_string(list_slice(tk, i + 1, i + 8), ' '))) AS gram FROM btok),
overlap AS (SELECT id, benchmark, eval_idx, count(*) AS grams FROM tg JOIN bg USING (gram) GROUP BY ALL)
"""


@query(f"WITH {GRAMS} SELECT * FROM overlap")
def ngram_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(spark, sf_dir)


@query(f"WITH {GRAMS} SELECT DISTINCT id FROM overlap")
def gram_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.candidates_only(train_texts(spark, sf_dir), bench_texts(spark, sf_dir)).select("id")


@query(f"WITH {GRAMS} SELECT benchmark, count(DISTINCT id) AS contaminated FROM overlap GROUP BY benchmark")
def contamination_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(overlaps(spark, sf_dir))


@query(f"WITH {GRAMS} SELECT doc_id AS id, length(text) AS n_text FROM documents WHERE doc_id NOT IN (SELECT id FROM overlap)")
def decontam_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(train_texts(spark, sf_dir), overlaps(spark, sf_dir)).select("id", F.length("text").cast("long").alias("n_text"))


@query(f"WITH {GRAMS}, bad AS (SELECT count(DISTINCT id) AS b FROM overlap), n AS (SELECT count(*) AS a FROM documents) SELECT a AS before, a - b AS after, b AS removed, b * 100.0::DOUBLE / a AS percent FROM bad, n")
def removal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.removal(train_texts(spark, sf_dir), overlaps(spark, sf_dir))


@query()
def decontam_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.verify(overlaps(spark, sf_dir), train_texts(spark, sf_dir), bench_texts(spark, sf_dir))


@query()
def token_gram_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared n-grams of token ids, as the thresholds of published decontamination mean them."""
    import public_tokenizers

    ids = decontam.subwords(public_tokenizers.path("byte_bpe_50k.json"))
    return decontam.shared_grams(train_texts(spark, sf_dir), bench_texts(spark, sf_dir), tokenise=ids)


@query()
def token_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ids, train, bench = decontam.subwords(public_tokenizers.path("byte_bpe_50k.json")), train_texts(spark, sf_dir), bench_texts(spark, sf_dir)
    return decontam.verify(decontam.shared_grams(train, bench, tokenise=ids), train, bench, tokenise=ids)


@query("SELECT 'bench' || (item_id % 4) AS benchmark, count(*) AS n FROM benchmark WHERE item_id % 4 IN (1, 2) GROUP BY ALL")
def benchmark_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.subset(bench_texts(spark, sf_dir), names=["bench1,bench2"]).groupBy("benchmark").agg(F.count(F.lit(1)).alias("n"))


# ---- filters ----------------------------------------------------------------

DOCS = "(SELECT *, nullif(source, 'src3') AS src, 'set' || (doc_id % 3) AS split FROM documents)"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    src = F.nullif("source", F.lit("src3"))
    return d.withColumn("src", src).withColumn("split", F.concat(F.lit("set"), (F.col("doc_id") % 3).cast("string"))).withColumn("original_metadata", F.struct(src.alias("source"), F.col("lang").alias("license")))


@query(f"SELECT doc_id FROM {DOCS} WHERE src IS NULL OR src NOT IN ('src0', 'src1')")
def license_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.exclude_values(docs(spark, sf_dir), "original_metadata.source", ["src0", "src1"]).select("doc_id")


@query(f"SELECT doc_id FROM {DOCS} WHERE src IN ('src0', 'src4')")
def license_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.include_values(docs(spark, sf_dir), "original_metadata.source", ["src0", "src4"]).select("doc_id")


@query(f"SELECT doc_id, coalesce(src, '<NULL>') AS v FROM {DOCS} WHERE coalesce(src, '<NULL>') IN ('src0', '<NULL>')")
def field_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.field_filter(docs(spark, sf_dir), "original_metadata.source", ["src0", "<NULL>"])
    return kept.select("doc_id", text_of(nested_get(kept, "original_metadata.source")).alias("v"))


@query(f"SELECT doc_id FROM {DOCS} WHERE coalesce(src, '<NULL>') NOT IN ('src0', '<NULL>')")
def field_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.field_filter(docs(spark, sf_dir), "original_metadata.source", ["src0", "<NULL>"], keep=False).select("doc_id")


@query(f"SELECT doc_id, split AS source FROM {DOCS} WHERE split <> 'set1'")
def split_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).withColumn("original_metadata", F.create_map(F.lit("source"), "src"))
    return filters.remove_splits(d, ["set1"], augment=True).select("doc_id", F.col("original_metadata")["source"].alias("source"))


RULES = {"set0": {"kind": "exclude", "values": ["src0"]}, "set1": {"kind": "include", "values": ["src1", "src2"]}, "set2": {"kind": "none"}}


@query(f"SELECT split, count(*) AS n FROM {DOCS} WHERE CASE split WHEN 'set0' THEN src IS NULL OR src <> 'src0' WHEN 'set1' THEN coalesce(src IN ('src1', 'src2'), false) ELSE true END GROUP BY split")
def rule_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir)
    return d.where(filters.rule_predicate(F.col("split"), F.col("src"), RULES)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id FROM {DOCS} WHERE coalesce(src IN ('src0', 'src2'), false) AND lang IN ('en', 'fr')")
def mixture_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.all_of(docs(spark, sf_dir), [("original_metadata.source", ["src0", "src2"]), ("lang", ["en", "fr"])]).select("doc_id")


@query("SELECT doc_id, CAST(quality * 2 + toxic AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id) WHERE quality * 2 + toxic >= 2 AND n_chars <= 2000 ORDER BY doc_id LIMIT 50")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").withColumn("s", (F.col("quality") * 2 + F.col("toxic")).cast("string"))
    return filters.quality_gate(rows, F.col("s"), 2, order=["doc_id"], length=F.col("n_chars"), longest=2000, most=50).select("doc_id", F.col("s").cast("double").alias("score"))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 25 OFFSET 15")
def split_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.row_range(table(spark, sf_dir, "documents"), 15, 40, "doc_id").select("doc_id", "lang")


# ---- splits -----------------------------------------------------------------


@query("SELECT doc_id, CAST(ntile(7) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS part FROM documents")
def split_even_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.even_parts(table(spark, sf_dir, "documents"), 7, "doc_id").select("doc_id", "part")


@query("SELECT doc_id, lang, CAST(ntile(3) OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS INTEGER) AS part FROM documents")
def split_parts_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.even_parts(table(spark, sf_dir, "documents"), 3, "doc_id", by=["lang"]).select("doc_id", "lang", "part")


NAMES = "CASE doc_id % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a/b:c*?' WHEN 3 THEN 'a_b-cstarq' WHEN 4 THEN ' x  y.z ' WHEN 5 THEN '<NULL>' WHEN 6 THEN '...' WHEN 7 THEN 'p|q<r>' ELSE repeat('ab ', 30) END"


@query(f"""
WITH v AS (SELECT doc_id, {NAMES} AS value FROM documents),
r AS (SELECT DISTINCT value, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(value, '/', '_'), ':', '-'), '*', 'star'), '?', 'q'), '<', 'lt'), '>', 'gt'), '|', '_'), ' ', '_'), '.', '_'), '\\', '_') AS n FROM v),
s AS (SELECT value, trim(regexp_replace(regexp_replace(n, '[^A-Za-z0-9_-]', '_', 'g'), '_+', '_', 'g'), '_') AS n FROM r)
SELECT value, CASE WHEN value IS NULL OR value = '<NULL>' THEN 'NULL' WHEN value = '' THEN 'EMPTY' WHEN n = '' THEN 'UNNAMED' WHEN length(n) > 50 THEN left(n, 50) || '_trunc' ELSE n END AS name FROM s
""")
def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "documents").select(F.expr(NAMES).alias("value")).distinct()
    return values.select("value", T.file_name(F.col("value")).alias("name"))


@query("SELECT part_name, count(*) AS n FROM (SELECT CASE WHEN source = 'src0' THEN 'a_b' WHEN source = 'src1' THEN 'a_b_1' ELSE source END AS part_name FROM documents) GROUP BY ALL")
def split_by_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("source", F.when(F.col("source") == "src0", "a b").when(F.col("source") == "src1", "a/b").otherwise(F.col("source")))
    return split.by_field(d, "source").groupBy("part_name").agg(F.count(F.lit(1)).alias("n"))


# ---- conversations ----------------------------------------------------------


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.gather_turns(table(spark, sf_dir, "conversations"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.chat(chats(spark, sf_dir), "org/chat-set", key=F.col("conv_id").cast("string"))


TURNS = """
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n, role, text FROM conversations WHERE trim(role) <> ''),
f AS (SELECT conv_id, min(n) FILTER (role = 'system') AS s, min(n) FILTER (role = 'user') AS u FROM t GROUP BY conv_id),
h AS (SELECT f.conv_id, u, s, t.text AS prompt, 'org_chat_set_' || f.conv_id || '_' || left(sha256(t.text), 8) AS conversation_id FROM f JOIN t ON t.conv_id = f.conv_id AND t.n = f.u),
r AS (SELECT h.conversation_id, h.conv_id, t.role, t.text, row_number() OVER (PARTITION BY h.conv_id ORDER BY t.n) - 1 AS message FROM h JOIN t ON t.conv_id = h.conv_id AND t.n <> h.u AND t.n <> coalesce(h.s, -1))
"""


@query(f"WITH {TURNS} SELECT conversation_id, CAST(0 AS INTEGER) AS branch, CAST(message AS INTEGER) AS message, role, text AS content FROM r")
def chat_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.parts_of(records(spark, sf_dir), "conversation_id").select("conversation_id", "branch", "message", "role", "content")


@query(f"WITH {TURNS} SELECT conversation_id, prompt FROM h")
def conversation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("conversation_id", F.col("initial_prompt.content").alias("prompt"))


@query(f"""WITH {TURNS}, w AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY message) AS before FROM
(SELECT conv_id, message, CASE WHEN conv_id % 5 = 0 AND message = 1 THEN 'assistant' ELSE role END AS role FROM r)),
g AS (SELECT conv_id, bool_and(CASE WHEN message = 0 THEN role = 'assistant' ELSE role IN ('user', 'assistant') AND role <> before END) AS ok FROM w GROUP BY conv_id)
SELECT h.conv_id, coalesce(ok, true) AS valid FROM h LEFT JOIN g USING (conv_id)""")
def turn_pattern_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fifth conversation gets a second message of the assistant's."""
    rows = records(spark, sf_dir).withColumn("conv_id", F.split("conversation_id", "_")[3].cast("long"))
    m = F.transform(F.col("conversation_branches")[0]["messages"], lambda x, i: x.withField("role", F.when((F.col("conv_id") % 5 == 0) & (i == 1), "assistant").otherwise(x["role"])))
    return rows.select("conv_id", convert.valid_turns(m).alias("valid"))


@query(f"WITH {TURNS} SELECT conversation_id, CAST(1 + (s IS NOT NULL)::INT + (SELECT count(*) FROM r WHERE r.conv_id = h.conv_id) AS INTEGER) AS n FROM h")
def message_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(spark, sf_dir).select("conversation_id", annotate.message_count().alias("n"))


PAIRS = "(SELECT doc_id, text AS q, CASE WHEN doc_id % 4 = 0 THEN '' ELSE lang END AS extra, source || ': ' || text AS a FROM documents)"


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("q"), F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.col("lang")).alias("extra"), F.concat("source", F.lit(": "), "text").alias("a"))


@query(f"SELECT 'x_y_' || left(sha256(q || CASE WHEN extra = '' THEN '' ELSE chr(10) || chr(10) || extra END), 16) AS conversation_id, q || CASE WHEN extra = '' THEN '' ELSE chr(10) || chr(10) || extra END AS prompt, a AS answer FROM {PAIRS}")
def instruction_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_pairs(spark, sf_dir).select(F.col("q").alias("instruction"), F.col("extra").alias("input"), F.col("a").alias("output"))
    out, _ = convert.convert(d, "x/y")
    return out.select("conversation_id", F.col("initial_prompt.content").alias("prompt"), F.col("conversation_branches")[0]["messages"][0]["parts"][0]["content"].alias("answer"))


@query(f"SELECT q AS prompt, unnest([0, 1])::INTEGER AS branch, unnest([a, extra]) AS answer FROM {PAIRS}")
def preference_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_pairs(spark, sf_dir).select(F.col("q").alias("prompt"), F.col("a").alias("chosen"), F.col("extra").alias("rejected"))
    rows = convert.preference(d, "x/y").select(F.col("initial_prompt.content").alias("prompt"), F.posexplode("conversation_branches").alias("branch", "b"))
    return rows.select("prompt", "branch", F.col("b.messages")[0]["parts"][0]["content"].alias("answer"))


@query(f"SELECT q AS prompt, extra AS answer FROM {PAIRS} WHERE q <> '' AND extra <> ''")
def pair_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_pairs(spark, sf_dir).select(F.col("q").alias("inputs"), F.col("extra").alias("labels"))
    out, _ = convert.convert(d, "x/y")
    return out.select(F.col("initial_prompt.content").alias("prompt"), F.col("conversation_branches")[0]["messages"][0]["parts"][0]["content"].alias("answer"))


@query(f"WITH {TURNS} SELECT conversation_id, CAST(message AS INTEGER) AS message, role FROM r")
def sharegpt_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda x: F.struct(F.when(x["role"] == "user", "human").when(x["role"] == "assistant", "gpt").otherwise(x["role"]).alias("from"), x["content"].alias("value"))
    d = chats(spark, sf_dir).select("conv_id", F.transform("messages", said).alias("conversations"))
    return annotate.parts_of(convert.sharegpt(d, "org/chat-set", key=F.col("conv_id").cast("string")), "conversation_id").select("conversation_id", "message", "role")


@query(f"WITH {TURNS} SELECT conv_id, prompt FROM h")
def prompts_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = chats(spark, sf_dir).withColumnRenamed("messages", "chosen")
    out = convert.prompts_only(d, "o", key=F.col("conv_id").cast("string"))
    return out.select(F.split("conversation_id", "_")[1].cast("long").alias("conv_id"), F.col("initial_prompt.content").alias("prompt"))


# ---- annotation -------------------------------------------------------------

WORDS = ("the", "der", "une", "para", "License")


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_]){w.lower()}($|[^\\p{{L}}\\p{{N}}_])') THEN '{w}' END" for w in WORDS) + "], lambda x: x IS NOT NULL), ',') AS found FROM documents")
def keyword_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(T.keywords_in(F.col("text"), WORDS), ",").alias("found"))


@query(f"WITH {TURNS}, k AS (SELECT conv_id, text FROM t), x AS (SELECT conv_id, bool_or(regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}_])(est|con)($|[^\\p{{L}}\\p{{N}}_])')) AS hit FROM k GROUP BY conv_id) SELECT conversation_id, hit FROM h JOIN x USING (conv_id)")
def keyword_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.mark_keywords(records(spark, sf_dir), ["est", "con"]).select("conversation_id", F.col("sample_has_assistant_keywords").alias("hit"))


@query(f"""WITH {TURNS}, line AS (SELECT conv_id, -1 AS message, NULL AS role, 'User: ' || prompt AS l, prompt AS text FROM h UNION ALL
SELECT conv_id, message, role, upper(left(role, 1)) || lower(substr(role, 2)) || ': ' || text, text FROM r UNION ALL SELECT h.conv_id, -2, NULL, 'System: ' || t.text, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.n = h.s),
c AS (SELECT *, string_agg(l, chr(10)) OVER (PARTITION BY conv_id ORDER BY message ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS q FROM line)
SELECT conversation_id, CAST(message AS INTEGER) AS message, coalesce(q, '[No previous context]') AS question, text AS answer FROM c JOIN h USING (conv_id) WHERE role = 'assistant'""")
def running_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.response_tasks(records(spark, sf_dir)).select("conversation_id", "message", "question", "answer")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_user FROM conversations")
def previous_user_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return annotate.previous_user(c, id_col="conv_id", order_col="turn", role_col="role", text_col="text").select("conv_id", "turn", "previous_user")


WRAPPED = "CASE WHEN conv_id % 3 = 0 AND role = 'assistant' THEN '<think> ' || text || ' </THINK >' || text || '<think></think>' ELSE text END"


@query(f"""WITH c AS (SELECT * REPLACE ({WRAPPED} AS text) FROM conversations WHERE role = 'assistant'),
x AS (SELECT conv_id, turn, list_filter(list_transform(regexp_extract_all(text, '(?is)<think\\s*>(.*?)</think\\s*>', 1), lambda t: trim(t, E' \\t\\n\\r')), lambda t: t <> '') AS th, trim(regexp_replace(text, '(?is)<think\\s*>(.*?)</think\\s*>', '', 'g'), E' \\t\\n\\r') AS rest FROM c)
SELECT conv_id, turn, CAST(len(th) AS INTEGER) AS n_thoughts, array_to_string(th, '|') AS thoughts, rest FROM x""")
def think_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'").withColumn("text", F.expr(WRAPPED))
    t = T.thoughts(F.col("text"))
    return c.select("conv_id", "turn", F.size(t).alias("n_thoughts"), F.array_join(t, "|").alias("thoughts"), T.without_thoughts(F.col("text")).alias("rest"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 2 = 0 THEN source ELSE '' END AS picked, CASE WHEN doc_id % 2 = 0 THEN source WHEN doc_id % 3 = 0 THEN lang END AS fixed FROM documents")
def system_prompt_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    now, custom = F.when(F.col("doc_id") % 3 == 0, F.col("lang")).otherwise(" \n"), F.when(F.col("doc_id") % 2 == 0, F.col("source"))
    return d.select("doc_id", annotate.system_choice(now, custom).alias("picked"), annotate.system_choice(now, custom, custom_first=True).alias("fixed"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN quality ELSE 0 END AS label FROM labels")
def label_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("doc_id") % 3 == 0, F.col("quality").cast("string")).when(F.col("doc_id") % 3 == 1, "none")
    return table(spark, sf_dir, "labels").select("doc_id", annotate.label_number(said).alias("label"))


@query("SELECT doc_id, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def annotation_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("classification"), F.lit(None).cast("string").alias("error"))
    out = annotate.write_back(table(spark, sf_dir, "documents"), results, "quality", "m", "doc_id")
    return out.select("doc_id", F.coalesce(F.col("annotations")["quality.m"]["classification"].cast("int"), F.lit(-1)).alias("quality"))


@query("""SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'error' ELSE CAST((1 + doc_id % 5) * (1 + doc_id % 3) AS VARCHAR) END AS product FROM documents""")
def complexity_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    c, q = (1 + F.col("doc_id") % 5).cast("string"), (1 + F.col("doc_id") % 3).cast("string")
    plain = F.format_string('{"complexity": "%s", "complexity_reasoning": "r", "quality": %s}', c, q)
    turned = F.format_string('{"complexity": "it is hard", "complexity_reasoning": "%s", "quality": "score %s"}', c, q)
    text = F.when(F.col("doc_id") % 4 == 3, "{broken").when(F.col("doc_id") % 4 == 1, turned).otherwise(plain)
    return d.select("doc_id", annotate.complexity_scores(text)["complexity_x_quality"].alias("product"))


# ---- profiles and mixtures --------------------------------------------------


@query("""SELECT 'lang' AS path, 'string' AS type, lang AS value, count(*) AS n FROM documents GROUP BY ALL
UNION ALL SELECT 'meta.source', 'string', coalesce(nullif(source, 'src3'), '<NULL>'), count(*) FROM documents GROUP BY ALL""")
def field_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = docs(spark, sf_dir).select("lang", F.struct(F.col("src").alias("source")).alias("meta"))
    return profile.field_values(d)


@query("""SELECT 'lang' AS path, 'string' AS type, count(DISTINCT lang) AS "distinct", count(lang) AS filled FROM documents
UNION ALL SELECT 'src', 'string', count(DISTINCT nullif(source, 'src3')), count(nullif(source, 'src3')) FROM documents""")
def field_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.field_stats(docs(spark, sf_dir).select("lang", "src"))


@query("SELECT source, count(*) AS n, count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS percent FROM documents GROUP BY source")
def source_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    counts, total = d.groupBy("source").agg(F.count(F.lit(1)).alias("n")), d.agg(F.count(F.lit(1)).alias("t"))
    return counts.crossJoin(F.broadcast(total)).select("source", "n", (F.col("n") * 100.0 / F.col("t")).alias("percent"))  # one row


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN n_chars END, 0) AS n, '' AS missing, CAST(doc_id AS VARCHAR) AS key, coalesce(try_cast(CASE WHEN doc_id % 3 = 0 THEN 'x' ELSE CAST(doc_id AS VARCHAR) END AS DOUBLE), 0) AS d FROM documents")
def uniform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).alias("n"), F.col("doc_id").alias("key"), F.when(F.col("doc_id") % 3 == 0, "x").otherwise(F.col("doc_id").cast("string")).alias("d"), "lang")
    return profile.uniform(d, {"doc_id": "int", "n": "int", "missing": "str", "key": "str", "d": "float"})


@query("SELECT structure, n FROM (SELECT CASE WHEN k > 0 THEN 'OBJECT<k: BIGINT>' END AS structure, count(*) AS n FROM (SELECT 1 AS k FROM events) GROUP BY ALL)")
def schema_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.json_structures(table(spark, sf_dir, "events"), "props").select("structure", "n")


# ---- judges -----------------------------------------------------------------

FACTS = "(SELECT doc_id AS sample_id, idx, (doc_id * 7 + idx * 5) % 9 + 1 AS truth, (doc_id * 3 + idx * idx * 2) % 11 AS score FROM documents, range(1, 10) AS g(idx))"


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sample_id"), F.explode(F.sequence(F.lit(1), F.lit(9))).alias("i"))
    i = F.col("i").cast("long")
    return rows.select("sample_id", i.alias("idx"), ((F.col("sample_id") * 7 + i * 5) % 9 + 1).alias("truth"), ((F.col("sample_id") * 3 + i * i * 2) % 11).alias("score"))


@query(f"""WITH r AS (SELECT sample_id, rank() OVER (PARTITION BY sample_id ORDER BY truth) + (count(*) OVER (PARTITION BY sample_id, truth) - 1) / 2.0::DOUBLE AS x, rank() OVER (PARTITION BY sample_id ORDER BY score) + (count(*) OVER (PARTITION BY sample_id, score) - 1) / 2.0::DOUBLE AS y FROM {FACTS})
SELECT sample_id, round(corr(x, y), 6) AS spearman FROM r GROUP BY sample_id""")
def spearman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.spearman(facts(spark, sf_dir), ["sample_id"], "truth", "score").select("sample_id", F.round("spearman", 6).alias("spearman"))


@query(f"""WITH f AS {FACTS}, p AS (SELECT a.sample_id, sign(a.truth - b.truth) AS x, sign(a.score - b.score) AS y FROM f a JOIN f b ON a.sample_id = b.sample_id AND a.idx < b.idx)
SELECT sample_id, round(sum(x * y) / sqrt(sum(abs(x))::DOUBLE * sum(abs(y))), 6) AS kendall FROM p GROUP BY sample_id""")
def kendall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.kendall(facts(spark, sf_dir), ["sample_id"], "truth", "score").select("sample_id", F.round("kendall", 6).alias("kendall"))


@query(f"SELECT sample_id, count(*) FILTER (t <= 3 AND score > 6) AS hits FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY truth DESC, idx) AS t FROM {FACTS}) GROUP BY sample_id")
def topk_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.top_hits(facts(spark, sf_dir), ["sample_id"], "truth", "score", "idx")


@query(f"SELECT sample_id, idx, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY score DESC, idx) AS INTEGER) AS place FROM {FACTS}")
def rank_by_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.rank_by_score(facts(spark, sf_dir), ["sample_id"], "score", "idx").select("sample_id", "idx", "place")


@query(f"SELECT sample_id, idx, 9 - row_number() OVER (PARTITION BY sample_id ORDER BY j IS NULL, j, score DESC, idx) + 1 AS final_rank FROM (SELECT *, CASE WHEN truth > 6 THEN truth END AS j FROM {FACTS})")
def hybrid_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = facts(spark, sf_dir).withColumn("j", F.when(F.col("truth") > 6, F.col("truth")))
    return judge.hybrid_ranks(f, ["sample_id"], "score", "j", "idx").select("sample_id", "idx", F.col("final_rank").cast("long").alias("final_rank"))


@query("""SELECT doc_id, round(sum(s * exp(lp)) / sum(exp(lp)), 6) AS expected FROM (SELECT doc_id, s, -1.0::DOUBLE * ((doc_id * s) % 7) / 2 AS lp FROM documents, range(1, 10) AS g(s)) GROUP BY doc_id""")
def expected_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.concat(F.array(F.struct(F.lit("x").alias("token"), F.lit(0.0).alias("logprob"))), F.transform(F.sequence(F.lit(1), F.lit(9)), lambda s: F.struct(F.concat(F.lit(" "), s.cast("string")).alias("token"), (-((F.col("doc_id") * s) % 7) / 2.0).alias("logprob"))))
    return table(spark, sf_dir, "documents").select("doc_id", F.round(judge.expected_score(tokens), 6).alias("expected"))


CHOICES = "(SELECT event_id % 400 AS sample_id, event_type AS mode, (event_id * 7 + user_id) % 10 + 1 AS pos, event_id FROM events)"


def choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select((F.col("event_id") % 400).alias("sample_id"), F.col("event_type").alias("mode"), ((F.col("event_id") * 7 + F.col("user_id")) % 10 + 1).alias("pos"), "event_id")


@query(f"SELECT mode, pos, n, round_even(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY mode), 2) AS percent FROM (SELECT mode, pos, count(*) AS n FROM {CHOICES} GROUP BY ALL)")
def position_bias_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.position_shares(choices(spark, sf_dir), "pos", "mode")


@query(f"SELECT round(sum(n * n) * 10.0::DOUBLE / sum(n) - sum(n), 6) AS chi_square, 9 AS df FROM (SELECT pos, count(*) AS n FROM {CHOICES} GROUP BY pos)")
def position_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.chi_square(choices(spark, sf_dir), "pos", 10).select(F.round("chi_square", 6).alias("chi_square"), "df")


@query(f"WITH c AS (SELECT sample_id, mode, max(n) / sum(n)::DOUBLE AS c FROM (SELECT sample_id, mode, pos, count(*) AS n FROM {CHOICES} GROUP BY ALL) GROUP BY ALL) SELECT round(avg(c), 6) AS mean, round(median(c), 6) AS median, round(min(c), 6) AS least, round(max(c), 6) AS most, round(stddev_pop(c), 6) AS std FROM c")
def consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = judge.summary(judge.consistency(choices(spark, sf_dir), "pos", "sample_id", "mode"), "consistency")
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


@query(f"""WITH b AS (SELECT mode, CAST(pos AS VARCHAR) AS pos, event_id % 3 = 0 AS w FROM {CHOICES})
SELECT 'mode' AS dimension, mode AS value, count(*) AS n, count(*) FILTER (w) AS first_wins FROM b GROUP BY mode UNION ALL SELECT 'pos', pos, count(*), count(*) FILTER (w) FROM b GROUP BY pos""")
def grouped_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.grouped_bias(choices(spark, sf_dir).withColumn("first_won", F.col("event_id") % 3 == 0), "mode", "pos")


@query(f"SELECT avg((pos % 2 = event_id % 2)::INT) * 100.0::DOUBLE AS a_b, avg((pos % 2 = sample_id % 2)::INT) * 100.0::DOUBLE AS a_c, avg((event_id % 2 = sample_id % 2)::INT) * 100.0::DOUBLE AS b_c FROM {CHOICES}")
def agreement_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = choices(spark, sf_dir).select((F.col("pos") % 2).alias("a"), (F.col("event_id") % 2).alias("b"), (F.col("sample_id") % 2).alias("c"))
    return judge.agreement(c, "a", "b", "c")


@query("SELECT least(floor((v + 1) * 5), 9)::BIGINT AS bin, count(*) AS n FROM (SELECT (event_id % 201 - 100) / 100.0::DOUBLE AS v FROM events) GROUP BY bin")
def corr_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = (F.col("event_id") % 201 - 100) / 100.0
    return table(spark, sf_dir, "events").select(judge.correlation_bin(v).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH x AS (SELECT doc_id % 8 + 1 AS k FROM documents) SELECT k::INTEGER AS a, (k + 1)::INTEGER AS b, count(*) AS n FROM x GROUP BY k""")
def adjacent_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's prediction exchanges one pair of neighbours."""
    k = (F.col("doc_id") % 8 + 1).cast("int")
    truth = F.sequence(F.lit(1), F.lit(9))
    d = table(spark, sf_dir, "documents").select(truth.alias("t"), F.transform(truth, lambda i: F.when(i == k, k + 1).when(i == k + 1, k).otherwise(i)).alias("p"))
    return judge.adjacent_swaps(d, "p", "t")


ANSWERS = ("REASONING: x RANKING: [1, 2,3,4,5,6,7,8,9]", "ranking: [9,8,7,6,5,4,3,2,1]", "RANKING: [1,1,2,3,4,5,6,7,8]", "RANKING: [1,2,3]", "RANKING: [a,b]", "nothing", "RANKING: [0,1,2,3,4,5,6,7,8]")


@query("SELECT doc_id, [NULL, NULL, 'duplicate_values', 'wrong_count', 'non_numeric', 'no_ranking_found', 'invalid_range'][doc_id % 7 + 1] AS error, [1, 9, NULL, NULL, NULL, NULL, NULL][doc_id % 7 + 1]::INTEGER AS first FROM documents")
def parse_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ANSWERS)), (F.col("doc_id") % 7 + 1).cast("int"))
    error = judge.ranking_error(said)
    return table(spark, sf_dir, "documents").select("doc_id", error.alias("error"), F.when(error.isNull(), judge.ranking_numbers(said)[0]).alias("first"))


@query("SELECT doc_id, [7, 4, 5, 3, NULL][doc_id % 5 + 1]::INTEGER AS score FROM documents")
def parse_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ("7\nbecause", "well\n4", "I give it a 5.", "xSCORE: 3y", "none 12"))), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", judge.single_score(said).alias("score"))


@query("SELECT doc_id, ['B', NULL, NULL, 'A'][doc_id % 4 + 1] AS winner, [2, NULL, NULL, 1][doc_id % 4 + 1]::INTEGER AS place FROM documents")
def winner_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ('x {"winner": "b"} y', '{"winner": "AB"}', "no json", '{"winner": " A "}'))), (F.col("doc_id") % 4 + 1).cast("int"))
    w = judge.winner_letter(said)
    return table(spark, sf_dir, "documents").select("doc_id", w.alias("winner"), judge.letter_place(w).alias("place"))


JUDGED = "(SELECT doc_id % 10 <> 0 AS success, doc_id % 3 AS retries, (doc_id % 21 - 10) / 10.0::DOUBLE AS spearman, (doc_id % 11 - 5) / 5.0::DOUBLE AS kendall, doc_id % 4 AS hits, doc_id % 100 AS tokens FROM documents)"


@query(f"""SELECT count(*) AS total, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, avg(success::INT) AS success_rate, count(*) FILTER (retries > 0) AS samples_retried, sum(retries)::BIGINT AS total_retries,
round(avg(spearman) FILTER (success), 6) AS mean_spearman, round(stddev_pop(spearman) FILTER (success), 6) AS std_spearman, round(median(spearman) FILTER (success), 6) AS median_spearman, round(avg(kendall) FILTER (success), 6) AS mean_kendall, round(stddev_pop(kendall) FILTER (success), 6) AS std_kendall, round(median(kendall) FILTER (success), 6) AS median_kendall,
round(avg(hits) FILTER (success) / 3, 6) AS mean_top3, count(*) FILTER (success AND spearman = 1.0) AS perfect, sum(tokens)::BIGINT AS total_tokens FROM {JUDGED}""")
def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    d = table(spark, sf_dir, "documents").select((i % 10 != 0).alias("success"), (i % 3).alias("retries"), ((i % 21 - 10) / 10.0).alias("spearman"), ((i % 11 - 5) / 5.0).alias("kendall"), (i % 4).alias("hits"), (i % 100).alias("tokens"))
    m = judge.overall(d)
    return m.select(*[F.round(c, 6).alias(c) if t == "double" and c != "success_rate" else F.col(c) for c, t in m.dtypes])


@query("SELECT ['no_ranking_found', 'wrong_count', 'api_error', 'other'][doc_id % 4 + 1] AS kind, count(*) AS n FROM documents GROUP BY kind")
def error_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ("No RANKING: [...] found", "Wrong number of elements: 3", "API down", "else"))), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "documents").groupBy(judge.error_kind(said).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH c AS (SELECT sample_id, pos % 4 AS answer, count(*) AS n, avg(exp(-(event_id % 5)::DOUBLE)) AS c FROM {CHOICES} GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY sample_id) AS t, row_number() OVER (PARTITION BY sample_id ORDER BY n DESC, c DESC, answer DESC) AS k FROM c)
SELECT sample_id, answer, n / t::DOUBLE AS share, round(c, 6) AS confidence FROM r WHERE k = 1""")
def consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = choices(spark, sf_dir).withColumn("answer", F.col("pos") % 4).withColumn("lp", -(F.col("event_id") % 5).cast("double"))
    return judge.consensus(c, "sample_id", "answer", "lp").withColumn("confidence", F.round("confidence", 6))


@query("SELECT doc_id, o::INTEGER AS ordering, m AS mode FROM documents, range(0, 3) AS g(o), (VALUES ('plain'), ('reasoned')) AS v(m)")
def test_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.test_cases(table(spark, sf_dir, "documents").select("doc_id"), 3, ["plain", "reasoned"])


@query(f"SELECT coalesce(sum(p) FILTER (pos = 1), 0) > 15 AS primacy, coalesce(sum(p) FILTER (pos = 10), 0) > 15 AS recency, coalesce(sum(p) FILTER (pos BETWEEN 2 AND 9), 0) > 96 AS middle FROM (SELECT pos, round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 2) AS p FROM {CHOICES} GROUP BY pos)")
def bias_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.bias_flags(judge.position_shares(choices(spark, sf_dir), "pos"), "pos", 10)


@query("SELECT doc_id, CASE WHEN (a + d) / 2 >= (b + c) / 2 THEN 'A' ELSE 'B' END AS winner, (a > b) = (d > c) AS consistent, (a + d) / 2 - (b + c) / 2 AS margin FROM (SELECT doc_id, -(doc_id % 3)::DOUBLE AS a, -(doc_id % 5)::DOUBLE AS b, -(doc_id % 7)::DOUBLE AS c, -(doc_id % 4)::DOUBLE AS d FROM documents)")
def dual_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    lp = lambda n: -(F.col("doc_id") % n).cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", *judge.dual_winner(lp(3), lp(5), lp(7), lp(4)))


@query(f"WITH {TURNS}, s AS (SELECT conv_id, (conv_id * 3 % 10)::DOUBLE AS score FROM h WHERE conv_id % 4 <> 0) SELECT conversation_id, score FROM h LEFT JOIN s USING (conv_id)")
def rank_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    conv = F.split("conversation_id", "_")[3].cast("long")
    scores = rec.where(conv % 4 != 0).select("conversation_id", F.lit(0).alias("branch"), (conv * 3 % 10).cast("double").alias("score"))
    return judge.write_back_scores(rec, scores, "conversation_id").select("conversation_id", F.col("conversation_branches")[0]["score"].alias("score"))


@query("SELECT doc_id, 'charter' || chr(10) || chr(10) || 'Question:' || chr(10) || lang || chr(10) || chr(10) || 'Response A:' || chr(10) || source || chr(10) || chr(10) || 'Response B:' || chr(10) || '[EMPTY RESPONSE]' || chr(10) || chr(10) || 'Which is better? Answer A or B.' AS prompt FROM documents")
def pairwise_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", judge.pair_prompt(F.lit("charter"), F.col("lang"), F.col("source"), F.lit(" ")).alias("prompt"))


# ---- more converters and harmonisers ----------------------------------------


@query("""SELECT doc_id, ['thought', 'function-call', NULL, 'function-call'][doc_id % 4 + 1] AS type, ['', 'f', NULL, 'g'][doc_id % 4 + 1] AS name, ['plan ' || lang, '', NULL, ''][doc_id % 4 + 1] AS content FROM documents""")
def call_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(F.format_string('{"name": "think", "arguments": {"thought": "plan %s"}}', "lang"), F.lit('{"name": "f", "arguments": {"x": 1}}'), F.lit("{broken"), F.lit('{"name": "g"}')), (F.col("doc_id") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "documents").select("doc_id", convert.call_part(said).alias("p"))
    return rows.select("doc_id", "p.type", "p.name", "p.content")


@query("SELECT conv_id, turn, CASE role WHEN 'user' THEN 'assistant' WHEN 'assistant' THEN 'user' ELSE role END AS role FROM conversations")
def swapped_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array(F.struct("role", F.col("text").alias("content"))).alias("m"))
    return c.select("conv_id", "turn", convert.swapped_roles(F.col("m"))[0]["role"].alias("role"))


@query("SELECT doc_id, n::INTEGER AS n, ['system', 'human', 'gpt'][n + 1] AS kind, [lang, 'q' || chr(10) || 'more', source][n + 1] AS value FROM documents, range(0, 3) AS g(n)")
def tagged_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("SYSTEM: "), F.col("lang"), F.lit("\nUSER: q\nmore\n\nASSISTANT: "), F.col("source"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(convert.tagged_turns(text, {"SYSTEM": "system", "USER": "human", "ASSISTANT": "gpt"})).alias("n", "x"))
    return rows.select("doc_id", "n", F.col("x")["from"].alias("kind"), F.col("x")["value"].alias("value"))


@query("SELECT doc_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN lang END, '') AS content, CAST(0 AS INTEGER) AS n_functions FROM documents")
def harmonised(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rec = convert.prompt_answers(d, "x", F.col("doc_id").cast("string"), [F.when(F.col("doc_id") % 2 == 0, F.col("lang"))])
    out = mixture.harmonise(rec.withColumn("available_functions", F.lit(None).cast("array<struct<name:string,description:string,parameters:string>>")))
    return out.select(F.col("initial_prompt.content").cast("long").alias("doc_id"), F.col("conversation_branches")[0]["messages"][0]["parts"][0]["content"].alias("content"), F.size("available_functions").alias("n_functions"))


@query(f"WITH {TURNS} SELECT conversation_id, prompt AS answer FROM h WHERE trim(prompt) <> ''")
def prompt_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.prompt_tasks(records(spark, sf_dir)).select("conversation_id", "answer")


@query(f"WITH {TURNS} SELECT conversation_id, prompt AS lifted, (SELECT count(*) FROM r WHERE r.conv_id = h.conv_id)::INTEGER AS messages FROM h")
def lifted_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prompt goes back before the messages, where it is found again."""
    rec = records(spark, sf_dir)
    first = F.array(convert.say("user", F.col("initial_prompt.content")))
    moved = rec.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: b.withField("messages", F.concat(first, b["messages"]))))
    moved = moved.withColumn("initial_prompt", F.lit(None).cast(rec.schema["initial_prompt"].dataType))
    out = annotate.lift_prompt(moved)
    return out.select("conversation_id", F.col("initial_prompt.content").alias("lifted"), F.size(F.col("conversation_branches")[0]["messages"]).alias("messages"))


@query("SELECT lang AS benchmark, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY lang")
def gathered_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    one = lambda k: d.where(F.col("lang") == k).select(decontam.prompt_text(F.struct(F.lit(None).cast("string").alias("content"), F.col("text")), ["content", "text"]).alias("prompt"))
    found = io.gather_prompts([(k, one(k), ["prompt"], "test") for k in ("en", "de", "fr", "es")])
    return found.groupBy("benchmark").agg(F.count(F.lit(1)).alias("n"))


# ---- more of judges ---------------------------------------------------------


@query(f"WITH {TURNS}, a AS (SELECT conv_id, min(message) AS m FROM r WHERE role = 'assistant' GROUP BY conv_id) SELECT conversation_id, 'branch_0' AS id, text AS content FROM a JOIN r ON r.conv_id = a.conv_id AND r.message = a.m")
def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = records(spark, sf_dir).select("conversation_id", F.explode(judge.completions(F.col("conversation_branches"))).alias("c"))
    return rows.select("conversation_id", "c.id", "c.content")


@query("SELECT doc_id, 'rules' || chr(10) || chr(10) || 'q' || chr(10) || chr(10) || 'Completion A:' || chr(10) || source || chr(10) || chr(10) || 'Completion B:' || chr(10) || lang AS prompt FROM documents")
def listwise_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, order = F.array("lang", "source"), F.array(F.lit(2), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", judge.list_prompt(F.lit("rules"), F.lit("q"), items, order).alias("prompt"))


@query("SELECT doc_id, i::INTEGER AS i, j::INTEGER AS j FROM documents, range(0, 5) AS a(i), range(0, 5) AS b(j) WHERE i < j AND j < doc_id % 4 + 2")
def pair_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.sequence(F.lit(1), (F.col("doc_id") % 4 + 2).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(judge.item_pairs(items)).alias("p")).select("doc_id", "p.i", "p.j")


@query("SELECT doc_id, item::INTEGER AS item, ((item + doc_id) % 9 + 1)::INTEGER AS rank FROM documents, range(0, 9) AS g(item)")
def ranks_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items are shown from the last to the first; the rank at each place goes back."""
    order = F.sequence(F.lit(9), F.lit(1), F.lit(-1))
    ranking = F.transform(order, lambda i: ((i - 1 + F.col("doc_id")) % 9 + 1).cast("int"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(judge.back_to_items(ranking, order)).alias("item", "rank"))
    return rows.select("doc_id", "item", "rank")


@query("SELECT (i - 1)::INTEGER AS position, avg((CASE WHEN doc_id % i = 0 THEN 1 ELSE 0 END)::DOUBLE) AS accuracy FROM documents, range(1, 10) AS g(i) GROUP BY i")
def position_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    truth = F.sequence(F.lit(1), F.lit(9))
    d = table(spark, sf_dir, "documents").select(truth.alias("ground_truth"), F.transform(truth, lambda i: F.when(F.col("doc_id") % i == 0, i).otherwise(0)).alias("predicted"))
    return judge.position_accuracy(d)


@query(f"WITH b AS (SELECT sample_id, mode, event_id % 2 AS question, count(*) AS n FROM {CHOICES} GROUP BY ALL) SELECT mode, round(avg(c), 6) AS consistency FROM (SELECT sample_id, mode, max(n) / sum(n)::DOUBLE AS c FROM b GROUP BY ALL) GROUP BY mode")
def pair_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = judge.consistency(choices(spark, sf_dir).withColumn("question", F.col("event_id") % 2), "question", "sample_id", "mode")
    return c.groupBy("mode").agg(F.round(F.avg("consistency"), 6).alias("consistency"))


@query("SELECT doc_id, (SELECT max(x) FROM (VALUES (doc_id % 3), (doc_id % 5), (doc_id % 7)) AS v(x))::DOUBLE AS best FROM documents")
def sorted_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    branches = F.array(*[F.struct((F.col("doc_id") % n).cast("double").alias("score")) for n in (3, 5, 7)])
    return table(spark, sf_dir, "documents").select("doc_id", judge.sorted_branches(branches)[0]["score"].alias("best"))


@query("SELECT (doc_id % 5)::BIGINT AS rank_sum, count(*) AS n FROM documents WHERE doc_id % 3 <> 0 GROUP BY ALL")
def usable_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 3 == 0, " ").otherwise("x")
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 5).alias("rank_sum"), F.array(F.struct(F.lit("y").alias("content"), F.lit(1.0).alias("score")), F.struct(text.alias("content"), F.lit(2.0).alias("score"))).alias("c"))
    return filters.valid_completions(d, "c", 2, scored=True).groupBy("rank_sum").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT structure, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS share FROM (SELECT CASE WHEN doc_id % 3 = 0 THEN 'OBJECT<a: BIGINT>' ELSE 'OBJECT<b: STRING>' END AS structure, count(*) AS n FROM documents GROUP BY ALL)")
def schema_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("doc_id") % 3 == 0, '{"a": 1}').otherwise('{"b": "x"}')
    return profile.schema_groups(table(spark, sf_dir, "documents").select(text.alias("j")), "j").withColumn("share", F.round("share", 6))


# ---- texts with structure, ranks by a judge ---------------------------------


@query(f"""WITH {TURNS}, sys AS (SELECT h.conv_id, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.n = h.s),
x AS (SELECT conv_id, conversation_id, -3 AS k, 'system' AS role, NULL AS blocks, text, NULL AS has_thinking FROM sys JOIN h USING (conv_id)
UNION ALL SELECT conv_id, conversation_id, -2, 'developer', NULL, NULL, EXISTS (SELECT 1 FROM r WHERE r.conv_id = h.conv_id AND r.role = 'assistant') FROM h
UNION ALL SELECT conv_id, conversation_id, -1, 'user', NULL, NULL, NULL FROM h
UNION ALL SELECT conv_id, conversation_id, message, role, CASE WHEN role = 'assistant' THEN '[{{"type":"thoughts","text":"plan","calls":[],"outputs":[]}},{{"type":"tool_calls","text":"","calls":[{{"name":"f","arguments":"{{}}"}}],"outputs":[]}},{{"type":"tool_outputs","text":"","calls":[],"outputs":[{{"name":"","output":"1"}}]}},{{"type":"response","text":' || CAST(to_json(text) AS VARCHAR) || ',"calls":[],"outputs":[]}}]' END, NULL, NULL FROM r WHERE role IN ('user', 'assistant'))
SELECT conversation_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY k) - 1 AS INTEGER) AS n, role, blocks, text, has_thinking FROM x""")
def linearised(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = records(spark, sf_dir)
    call = F.array(part("thought", "plan"), part("function-call", name="f", args="{}"), part("function-output", "1"))
    rec = rec.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: b.withField("messages", F.transform(b["messages"], lambda m: m.withField("parts", F.when(m["role"] == "assistant", F.concat(call, m["parts"])).otherwise(m["parts"]))))))
    out = linearise.linearise(rec).select("conversation_id", F.posexplode("messages").alias("n", "m"))
    return out.select("conversation_id", "n", "m.role", F.to_json("m.blocks").alias("blocks"), "m.text", "m.has_thinking")


@query(f"SELECT sample_id, idx, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY score DESC, idx) AS INTEGER) AS place FROM {FACTS}")
def oddeven_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = facts(spark, sf_dir).withColumn("t", F.format_string("%02d", "score"))
    return judge.rank_with_judge(f, "sample_id", "idx", "t", lambda a, b: a >= b)


@query("SELECT doc_id, lang AS a FROM documents")
def repaired_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('said: {"a": "'), F.col("lang"), F.lit('", "b": [1, 2,],} end'))
    return table(spark, sf_dir, "documents").select("doc_id", F.get_json_object(T.repair_json(text), "$.a").alias("a"))


@query("SELECT split, count(*) AS rows FROM (SELECT 'set' || (doc_id % 3) AS split FROM documents) GROUP BY split")
def split_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.describe(docs(spark, sf_dir), "split")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 = 0")
def split_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.choose_split(docs(spark, sf_dir)).select("doc_id")


__all__ = ["ORACLES", "QUERIES", "query", "strip", "table"]
