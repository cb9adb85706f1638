"""Queries of paths, selections, converters' checks, written tables, tools, mixtures by name and choices over repeats, and their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.paths import nested_get_strict, nested_set
from quarry.model import FUNCTION, part
from quarry.operators import convert, decontam, filters, judge, linearise, mixture, split
from quarry.plans.catalog import DOCS, TURNS, chats, docs, facts, query, records, table
from quarry.session import shared_path
from quarry.sources import arrow_tables

# ---- paths and selections ---------------------------------------------------


@query(f"SELECT doc_id, src AS v FROM {DOCS}")
def strict_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", nested_get_strict("original_metadata.source").alias("v"))


@query(f"SELECT doc_id, coalesce(src, '') || '|' || lang || '|new' AS v FROM {DOCS}")
def path_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A member that is there and one of a list that is too short."""
    d = docs(spark, sf_dir).withColumn("m", F.struct(F.col("original_metadata.source").alias("source"), F.array(F.struct(F.col("lang").alias("k"))).alias("l")))
    out = nested_set(nested_set(d, "m.l[1].k", F.lit("new")), "m.source", F.coalesce("src", F.lit("")))
    return out.select("doc_id", F.concat_ws("|", "m.source", F.col("m.l")[0]["k"], F.col("m.l")[1]["k"]).alias("v"))


@query(f"WITH {TURNS} SELECT conversation_id FROM h WHERE conv_id IN (SELECT conv_id FROM r)")
def whole_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations that are nothing but a prompt have a branch without messages."""
    return filters.drop_empty_branches(records(spark, sf_dir)).select("conversation_id")


@query("SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def longest_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.head(table(spark, sf_dir, "documents"), 25, F.desc("n_chars"), "doc_id").select("doc_id")


@query("""WITH x AS (SELECT doc_id, unnest(range(0, 6)) AS rank FROM documents), y AS (SELECT *, CASE WHEN (doc_id + rank) % 11 = 0 THEN NULL ELSE 'c' || rank END AS content FROM x WHERE rank BETWEEN 2 AND 4)
SELECT doc_id, list(5 - rank ORDER BY rank)::BIGINT[]::VARCHAR AS truths FROM y GROUP BY doc_id HAVING count(content) = 3""")
def iterations_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.sequence(F.lit(0), F.lit(5))
    made = F.transform(rank, lambda r: F.struct(r.cast("long").alias("rank"), F.when((F.col("doc_id") + r) % 11 != 0, F.concat(F.lit("c"), r.cast("string"))).alias("content")))
    kept = filters.iterations_in_range(table(spark, sf_dir, "documents").select("doc_id", made.alias("c")), "c", 2, 4)
    truths = F.transform("c", lambda x: (x["truth"] + 1).cast("string"))
    return kept.select("doc_id", F.concat(F.lit("["), F.array_join(truths, ", "), F.lit("]")).alias("truths"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' || doc_id WHEN doc_id % 3 = 1 THEN CAST(n_chars AS VARCHAR) ELSE 'row_' || doc_id END AS key FROM documents")
def sample_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    made = d.select(i, F.when(i % 3 == 0, F.concat(F.lit("a"), i)).alias("id"), F.when(i % 3 == 1, F.col("n_chars")).alias("idx"))
    return made.select("doc_id", convert.sample_id(made, i).alias("key"))


# ---- converters' checks -----------------------------------------------------


@query("SELECT doc_id, lang AS prompt, text AS answer, CASE WHEN doc_id % 2 = 0 THEN source END AS system FROM documents WHERE doc_id % 5 <> 0")
def nemotron_standardise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without an input message are left out; an empty system prompt is none."""
    i = F.col("doc_id")
    said = F.struct(F.lit("user").alias("role"), F.col("lang").alias("content"))
    rows = table(spark, sf_dir, "documents").select(i, F.when(i % 5 != 0, F.array(said)).otherwise(F.array().cast("array<struct<role:string,content:string>>")).alias("input"), F.col("text").alias("output"), F.when(i % 2 == 0, F.col("source")).otherwise("").alias("system_prompt"))
    assert convert.detect(rows) is convert.nemotron
    out = convert.nemotron(rows, "n", key=i.cast("string"))
    number = F.split("conversation_id", "_")[1].cast("long")
    return out.select(number.alias("doc_id"), F.col("initial_prompt.content").alias("prompt"), F.col("conversation_branches")[0]["messages"][0]["parts"][0]["content"].alias("answer"), F.col("system_prompt.content").alias("system"))


@query(f"""WITH {TURNS}, w AS (SELECT conversation_id, conv_id, message, role, lag(role) OVER (PARTITION BY conv_id ORDER BY message) AS before FROM r),
bad AS (SELECT DISTINCT conv_id FROM w WHERE (message = 0 AND role <> 'assistant') OR (message > 0 AND (role NOT IN ('user', 'assistant') OR role = before)))
SELECT conversation_id, conv_id NOT IN (SELECT conv_id FROM bad) AS valid FROM h""")
def converted_and_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose format is detected; what isn't a proper conversation stands aside."""
    good, bad = convert.convert(chats(spark, sf_dir), "org/chat-set", key=F.col("conv_id").cast("string"))
    return good.select("conversation_id", F.lit(True).alias("valid")).unionByName(bad.select("conversation_id", F.lit(False).alias("valid")))


PATTERNS = "CASE doc_id % 5 WHEN 0 THEN 'Bitte INS SURSILVAN: ' || lang WHEN 1 THEN 'Ins Deutsche: a) x' WHEN 2 THEN '* eins' WHEN 3 THEN text END"


@query(f"""WITH t AS (SELECT lower(coalesce({PATTERNS}, '')) AS t FROM documents), p AS (SELECT regexp_matches(t, 'ins sursilvan|ins romansch') AS a, contains(t, 'ins deutsche') AS b, regexp_matches(t, '[*]|-|[0-9]+\\)|[a-z]\\)') AS l FROM t)
SELECT count(*) FILTER (a) AS german_to_romansh, count(*) FILTER (NOT a AND b) AS romansh_to_german, count(*) FILTER (l) AS list_translations, count(*) FILTER (NOT l) AS single_translations FROM p""")
def translation_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.expr(PATTERNS).alias("input")).agg(*convert.translation_patterns(F.col("input")))


@query("SELECT 'dialect' AS field, CASE doc_id % 4 WHEN 0 THEN 'ch_be' WHEN 1 THEN 'ch_zh' WHEN 2 THEN lang END AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY ALL")
def dialect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id") % 4
    return convert.value_counts(d, dialect=F.when(i == 0, "ch_be").when(i == 1, "ch_zh").when(i == 2, F.col("lang")), source=F.col("source"))


# ---- written tables ---------------------------------------------------------


@query("""WITH v AS (SELECT CASE WHEN doc_id % 9 = 0 THEN NULL WHEN doc_id % 9 = 1 THEN 'a/b' WHEN doc_id % 9 = 2 THEN 'a_b' ELSE lang END AS v, doc_id FROM documents)
SELECT CASE WHEN v IS NULL THEN 'NULL' WHEN v = 'a/b' THEN 'a_b' WHEN v = 'a_b' THEN 'a_b_1' ELSE v END AS part, count(*) AS "rows", CAST(sum(doc_id) AS BIGINT) AS ids FROM v GROUP BY ALL""")
def written_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One commit of a table in parts by a field's value; each part is read by its name."""
    i = F.col("doc_id") % 9
    rows = table(spark, sf_dir, "documents").withColumn("v", F.when(i == 0, None).when(i == 1, "a/b").when(i == 2, "a_b").otherwise(F.col("lang")))
    path = shared_path(spark, "parts")
    arrow_tables.save_arrow(split.by_field(rows, "v"), path, {"step": "split"}, part="part_name")
    out = None
    for name in arrow_tables.parts(path):  # names of values
        own = arrow_tables.read_arrow(spark, path, name).agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows"), F.sum("doc_id").alias("ids"))
        out = own if out is None else out.unionByName(own)
    return out


@query('SELECT CAST(0 AS BIGINT) AS "rows", CAST(5 AS BIGINT) AS columns, count(*) AS before FROM documents')
def written_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filter that nothing passes still writes a table with its columns."""
    d, path = table(spark, sf_dir, "documents"), shared_path(spark, "empty")
    arrow_tables.save_arrow(filters.include_values(docs(spark, sf_dir), "original_metadata.source", ["nobody"]).select(*d.columns), path, {"step": "none"})
    back = arrow_tables.read_arrow(spark, path)
    return back.agg(F.count(F.lit(1)).alias("rows")).crossJoin(d.agg(F.count(F.lit(1)).alias("before"))).select("rows", F.lit(len(back.columns)).cast("long").alias("columns"), "before")  # one row each


# ---- tools ------------------------------------------------------------------

_SHOWN = json.dumps(linearise.ANSWERS_TOOL).replace("'", "''")
_OWN = """'{"name": "f' || conv_id % 3 || '", "description": "looks", "parameters": ' || CASE WHEN conv_id % 3 = 1 THEN '{"type": "object", "properties": {"q": {"type": "integer"}}, "required": ["q"]}' ELSE '{}' END || '}'"""


@query(f"""WITH {TURNS}, w AS (SELECT conversation_id, conv_id, conv_id % 3 <> 0 AS has, conv_id % 2 = 0 AND EXISTS (SELECT 1 FROM r WHERE r.conv_id = h.conv_id AND r.role = 'assistant') AS shows FROM h)
SELECT conversation_id, CASE WHEN NOT has THEN '' ELSE '[' || {_OWN} || CASE WHEN shows THEN ', {_SHOWN}' ELSE '' END || ']' END AS tools,
CASE WHEN NOT has THEN '' ELSE '// looks' || chr(10) || 'type f' || conv_id % 3 || ' = (' || CASE WHEN conv_id % 3 = 1 THEN '_: {{' || chr(10) || '  q: number,' || chr(10) || '}}' ELSE '' END || ') => any;' ||
CASE WHEN shows THEN chr(10) || '// Display the answers to the user' || chr(10) || 'type display_answers = (_: {{' || chr(10) || '  // The answers to the user' || chr(10) || '  answers: string[],' || chr(10) || '}}) => any;' ELSE '' END END AS formatted_tools FROM w""")
def linearised_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the records has no function, a third one with a schema, a third one whose schema is no JSON; every other one asks for answers."""
    rec = records(spark, sf_dir)
    number = F.regexp_extract("conversation_id", "^org_chat_set_([0-9]+)_", 1).cast("long")
    schema = F.when(number % 3 == 1, F.lit('{"type": "object", "properties": {"q": {"type": "integer"}}, "required": true}')).otherwise("{broken")
    one = F.array(F.struct(F.concat(F.lit("f"), (number % 3).cast("string")).alias("name"), F.lit("looks").alias("description"), schema.alias("parameters"))).cast(f"array<{FUNCTION}>")
    rec = rec.withColumn("available_functions", F.when(number % 3 != 0, one))
    asks = lambda m: F.when((m["role"] == "assistant") & (number % 2 == 0), F.concat(m["parts"], F.array(part("verifiable-responses", "", answers=F.array(F.lit("1")))))).otherwise(m["parts"])
    rec = rec.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: b.withField("messages", F.transform(b["messages"], lambda m: m.withField("parts", asks(m))))))
    said = F.filter("messages", lambda m: m["role"] == "developer")[0]
    return linearise.linearise(rec).select("conversation_id", said["tools"].alias("tools"), said["formatted_tools"].alias("formatted_tools"))


# ---- mixtures by name -------------------------------------------------------


def _mixtures(sf_dir: str) -> dict[str, list[dict]]:
    """A catalogue of mixtures: two of their own, one that refers to both and narrows one of them."""
    pages = {"dataset_path": f"{sf_dir}/documents.parquet"}
    return {
        "english": [{**pages, "filters": [{"field": "lang", "values": ["en"]}]}],
        "others": [{**pages, "filters": [{"field": "lang", "values": ["de", "fr", "es"]}]}],
        "all": [{"mixture": "english"}, {"mixture": "others", "filters": [{"field": "source", "values": ["src1", "src2"]}]}],
    }


@query("SELECT doc_id FROM documents WHERE lang = 'en' OR (lang IN ('de', 'fr', 'es') AND source IN ('src1', 'src2'))")
def named_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = mixture.resolved(_mixtures(sf_dir), "all")
    read = [filters.all_of(spark.read.parquet(e["dataset_path"]), [(f["field"], f["values"]) for f in e["filters"]]) for e in entries]
    return mixture.concatenate(*read).select("doc_id")


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS content FROM documents")
def harmonised_system(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("doc_id") % 2 == 0, F.struct(F.col("lang").alias("content"), F.create_map().cast("map<string,string>").alias("metadata")))
    return mixture.harmonise_system(table(spark, sf_dir, "documents").select("doc_id", said.alias("system_prompt"))).select("doc_id", "system_prompt.content")


@query("SELECT doc_id AS id FROM documents WHERE lang = 'de' OR source = 'src1'")
def merged_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "id")
    return decontam.merge_reports(d.where("lang = 'de'"), d.where("source = 'src1'"), d.where("lang = 'de'"))


# ---- judges -----------------------------------------------------------------


@query("SELECT doc_id, '1,2,3,4,5,6' AS places FROM documents")
def shown_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order is a permutation; sorted again it holds every place once."""
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array_sort(judge.shown_order(F.col("doc_id"), F.lit(3), 6)), ",").alias("places"))


CHOICE = "SELECT sample_id, idx, CASE (sample_id + idx * idx) % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE 'D' END AS best FROM f WHERE idx % 3 <> 0"


@query(f"""WITH f AS (SELECT doc_id AS sample_id, unnest(range(1, 10)) AS idx FROM documents), b AS ({CHOICE}),
x AS (SELECT b.*, l.label, CASE WHEN best = label THEN -0.5 ELSE -2.0 END AS p FROM b, (VALUES ('A'), ('B'), ('C'), ('D')) AS l(label)),
y AS (SELECT *, exp(p) / sum(exp(p)) OVER (PARTITION BY sample_id, idx) AS q FROM x)
SELECT sample_id, label, count(*) FILTER (best = label) AS picked, count(*) AS asked, count(*) FILTER (best = label)::DOUBLE / count(*) AS share, round(avg(q), 9) AS mean_probability FROM y GROUP BY sample_id, label""")
def repeated_choices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question asked nine times; every third answer has no label after its thinking."""
    f = facts(spark, sf_dir)
    names = F.array(*[F.lit(k) for k in "ABCD"])
    best = F.get(names, ((F.col("sample_id") + F.col("idx") * F.col("idx")) % 4).cast("int"))
    top = F.transform(names, lambda k: F.struct(F.concat(F.lit(" "), k).alias("token"), F.when(k == best, -0.5).otherwise(-2.0).alias("logprob")))
    none = F.array().cast("array<struct<token:string,logprob:double>>")
    said = lambda w, t: F.struct(w.alias("token"), t.alias("top"))
    tokens = F.array(said(F.lit("<think>"), none), said(F.lit("D"), top), said(F.lit("</think>"), none), said(F.lit("So"), none), said(F.when(F.col("idx") % 3 == 0, "none").otherwise(F.concat(F.lit(" "), best)), top))
    out = judge.choices_over_repeats(f.select("sample_id", judge.choice_logprobs(tokens).alias("choices")), ["sample_id"])
    return out.withColumn("mean_probability", F.round("mean_probability", 9))
