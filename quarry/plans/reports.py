"""Queries of judge flows, bias reports, profiles and selections, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import convert, decontam, filters, judge, mixture, profile, sketches, split, structures
from quarry.plans.catalog import CHOICES, DOCS, RULES, bench_texts, choices, docs, query, table

# ---- judge flows ------------------------------------------------------------


@query("""SELECT doc_id, 'rules' || chr(10) || chr(10) || 'Based on these quality indicators, label the following completion on a scale from 1 to 9, where 9 is best and 1 is worst.' || chr(10) || 'Do not use any reasoning and respond with only the quality label.' || chr(10) || '======' || chr(10) ||
'QUESTION: ' || lang || chr(10) || chr(10) || '======' || chr(10) || 'COMPLETION: ' || text || chr(10) || '======' || chr(10) || 'LABEL: ' AS prompt FROM documents""")
def score_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", judge.score_prompt(F.lit("rules"), F.col("lang"), F.col("text")).alias("prompt"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN NULL ELSE (doc_id % 9 + 1)::DOUBLE END AS modal, CASE doc_id % 3 WHEN 2 THEN NULL ELSE round(((doc_id % 9 + 1) * exp(-0.5) + 1 * exp(-1.5)) / (exp(-0.5) + exp(-1.5)), 6) END AS expected FROM documents")
def token_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits while thinking don't count; every third answer has none after it."""
    word = F.concat(F.lit(" "), (F.col("doc_id") % 9 + 1).cast("string"))
    top = F.array(*[F.struct(w.alias("token"), F.lit(p).alias("logprob")) for w, p in ((word, -0.5), (F.lit("x"), -0.1), (F.lit("1"), -1.5))])
    token = lambda w: F.struct(w.alias("token"), top.alias("top"))
    tokens = F.array(token(F.lit("<think>")), token(F.lit("7")), token(F.lit("</think>")), token(F.lit("so")), token(F.when(F.col("doc_id") % 3 == 2, "12").otherwise(word)))
    return table(spark, sf_dir, "documents").select("doc_id", judge.token_score(tokens, modal=True).alias("modal"), F.round(judge.token_score(tokens), 6).alias("expected"))


LONG = "SELECT doc_id, i, (i * 7 + doc_id) % 9 AS truth, CASE WHEN doc_id % 4 = 0 THEN 5 WHEN doc_id % 4 = 1 AND i = 3 THEN NULL ELSE (i * i + doc_id) % 5 END AS score FROM documents, range(0, 9) AS g(i)"


@query(f"""WITH f AS ({LONG}), e AS (SELECT doc_id, CASE WHEN count(score) < 9 THEN 'Failed to parse valid score for 3' WHEN count(DISTINCT score) = 1 THEN 'All predicted scores identical, correlation undefined' END AS error FROM f GROUP BY doc_id),
k AS (SELECT *, rank() OVER (PARTITION BY doc_id ORDER BY truth) + (count(*) OVER (PARTITION BY doc_id, truth) - 1) / 2.0::DOUBLE AS x, rank() OVER (PARTITION BY doc_id ORDER BY score) + (count(*) OVER (PARTITION BY doc_id, score) - 1) / 2.0::DOUBLE AS y,
 row_number() OVER (PARTITION BY doc_id ORDER BY truth DESC, i) AS bt, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, i) AS bs FROM f JOIN e USING (doc_id) WHERE error IS NULL),
s AS (SELECT doc_id, round(corr(x, y), 6) AS spearman, count(*) FILTER (bt <= 3 AND bs <= 3)::INTEGER AS top3 FROM k GROUP BY doc_id),
p AS (SELECT a.doc_id, sign(a.truth - b.truth) AS x, sign(a.score - b.score) AS y FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.i < b.i),
t AS (SELECT doc_id, round(sum(x * y) / sqrt(sum(abs(x))::DOUBLE * sum(abs(y))), 6) AS kendall FROM p GROUP BY doc_id)
SELECT doc_id, error IS NULL AS success, error, spearman, kendall, top3 FROM e LEFT JOIN s USING (doc_id) LEFT JOIN t USING (doc_id)""")
def judged_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, places = F.col("doc_id"), F.sequence(F.lit(0), F.lit(8))
    truth = F.transform(places, lambda k: (k * 7 + i) % 9)
    scores = F.transform(places, lambda k: F.when(i % 4 == 0, 5).when((i % 4 == 1) & (k == 3), F.lit(None)).otherwise((k * k + i) % 5))
    out = judge.judged_scores(table(spark, sf_dir, "documents").select("doc_id", truth.alias("t"), scores.alias("s")), F.col("s"), F.col("t"))
    return out.select("doc_id", "success", "error", F.round("spearman", 6).alias("spearman"), F.round("kendall", 6).alias("kendall"), "top3")


@query("""WITH f AS (SELECT doc_id, i, (i * 7 + doc_id) % 9 + 1 AS truth, (i * 2 + doc_id) % 9 + 1 AS rank FROM documents, range(0, 9) AS g(i) WHERE doc_id % 3 > 0),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY truth DESC, i) AS bt FROM f)
SELECT d.doc_id, d.doc_id % 3 > 0 AS success, CASE WHEN d.doc_id % 3 = 0 THEN 'wrong_count' END AS error, round(corr(truth, rank), 6) AS spearman, count(*) FILTER (bt <= 3 AND rank > 6)::INTEGER * CASE WHEN d.doc_id % 3 > 0 THEN 1 END AS top3 FROM documents d LEFT JOIN b USING (doc_id) GROUP BY d.doc_id""")
def judged_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completions are shown from the last to the first; the answer's ranks are those of the places shown."""
    i = F.col("doc_id")
    order = F.sequence(F.lit(9), F.lit(1), F.lit(-1))
    shown = F.transform(order, lambda k: ((k - 1) * 2 + i) % 9 + 1)
    said = F.concat(F.lit("REASONING: x\nRANKING: ["), F.array_join(F.when(i % 3 == 0, F.slice(shown, 1, 4)).otherwise(shown).cast("array<string>"), ", "), F.lit("]"))
    truth = F.transform(F.sequence(F.lit(0), F.lit(8)), lambda k: (k * 7 + i) % 9 + 1)
    d = table(spark, sf_dir, "documents").select("doc_id", said.alias("a"), order.alias("o"), truth.alias("t"))
    out = judge.judged_ranking(d, F.col("a"), F.col("o"), F.col("t"))
    return out.select("doc_id", "success", "error", F.round("spearman", 6).alias("spearman"), "top3")


@query("SELECT doc_id, ['c3', 'c1', 'c2', NULL][doc_id % 4 + 1] AS id, [1, 2, 3, NULL][doc_id % 4 + 1]::INTEGER AS place FROM documents")
def winner_completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    letter = F.substr(F.lit("ABCD"), (F.col("doc_id") % 4 + 1).cast("int"), F.lit(1))
    w = judge.winner_completion(letter, F.array(*map(F.lit, (3, 1, 2))), F.array(*map(F.lit, ("c1", "c2", "c3"))))
    return table(spark, sf_dir, "documents").select("doc_id", w["id"].alias("id"), w["place"].alias("place"))


_WORSE = "' REASONING:' || chr(10) || ' worse ' || lang || chr(10) || chr(10) || 'COMPLETION:' || chr(10) || text || chr(10)"
_BARE = "E' \\t\\n\\r\\x0b\\f'"


@query(f"""WITH s AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN {_WORSE} ELSE 'no marks' END AS s FROM documents), p AS (SELECT *, string_split(s, 'COMPLETION:') AS p, contains(s, 'REASONING:') AND contains(s, 'COMPLETION:') AS m FROM s)
SELECT doc_id, CASE WHEN m THEN trim(p[2], {_BARE}) ELSE s END AS completion, CASE WHEN m THEN trim(replace(p[1], 'REASONING:', ''), {_BARE}) ELSE 'Format not followed correctly' END AS reasoning FROM p""")
def degraded_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit(" REASONING:\n worse "), F.col("lang"), F.lit("\n\nCOMPLETION:\n"), F.col("text"), F.lit("\n"))).otherwise("no marks")
    x = judge.degraded_answer(said)
    return table(spark, sf_dir, "documents").select("doc_id", x["completion"].alias("completion"), x["reasoning"].alias("reasoning"))


@query("SELECT doc_id, 'ORIGINAL COMPLETION:' || chr(10) || CASE WHEN length(text) > 500 THEN left(text, 500) || '...' ELSE text END || chr(10) || chr(10) || 'ITERATION 1 (Previous Reasoning: ' || lang || '):' || chr(10) || source || chr(10) || chr(10) AS history FROM documents")
def degradation_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut of each completion shown to the model is part of the prompt's form."""
    return table(spark, sf_dir, "documents").select("doc_id", judge.degradation_history(F.array("text", "source"), F.array("lang")).alias("history"))


# ---- bias reports -----------------------------------------------------------

COMPARED = "(SELECT CASE WHEN event_id % 5 < 3 THEN 'first_mentioned' ELSE 'second_mentioned' END AS winner, CASE WHEN user_id % 2 = 0 THEN 'original_order' ELSE 'reversed_order' END AS question_order, event_type AS mode, event_id % 4 AS a, (event_id + user_id) % 5 AS b FROM events)"


def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    winner = F.when(e % 5 < 3, "first_mentioned").otherwise("second_mentioned")
    order = F.when(u % 2 == 0, "original_order").otherwise("reversed_order")
    return table(spark, sf_dir, "events").select(winner.alias("winner"), order.alias("question_order"), F.col("event_type").alias("mode"), (e % 4).alias("first_position"), ((e + u) % 5).alias("second_position"))


PAIR_BIAS = f"""c AS {COMPARED}, l AS (SELECT winner, unnest([{{'d': 'all', 'v': 'all'}}, {{'d': 'question_order', 'v': question_order}}, {{'d': 'distance', 'v': CAST(abs(a - b) AS VARCHAR)}}, {{'d': 'first_position', 'v': CAST(a AS VARCHAR)}}, {{'d': 'second_position', 'v': CAST(b AS VARCHAR)}}, {{'d': 'mode', 'v': mode}}]) AS x FROM c),
pb AS (SELECT x.d AS dimension, x.v AS value, count(*) AS total, count(*) FILTER (winner = 'first_mentioned') AS first_wins, count(*) FILTER (winner = 'second_mentioned') AS second_wins FROM l GROUP BY ALL),
bias AS (SELECT *, round_even(first_wins * 100.0::DOUBLE / total, 2) AS first_percent, round_even(second_wins * 100.0::DOUBLE / total, 2) AS second_percent FROM pb)"""


@query(f"WITH {PAIR_BIAS} SELECT * EXCLUDE (second_percent) FROM bias")
def pair_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.pair_bias(compared(spark, sf_dir))


@query(f"""WITH {PAIR_BIAS}, a AS (SELECT max(first_percent) FILTER (dimension = 'all') AS f, max(second_percent) FILTER (dimension = 'all') AS s, max(first_percent) FILTER (value = 'original_order') AS o, max(first_percent) FILTER (value = 'reversed_order') AS r FROM bias)
SELECT f AS first, s AS second, abs(f - s) > 10 AS biased, CASE WHEN f > s THEN 'first_mentioned' WHEN s > f THEN 'second_mentioned' ELSE 'None' END AS direction, abs(o - r) AS order_effect, abs(o - r) > 5 AS order_matters FROM a""")
def pair_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.pair_flags(judge.pair_bias(compared(spark, sf_dir)))


@query("SELECT sample_id, " + ", ".join(f"count(*) FILTER (pos = {k}) AS p{k}" for k in range(1, 11)) + f" FROM {CHOICES} GROUP BY sample_id")
def position_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge.position_table(choices(spark, sf_dir), "sample_id", "pos", 10)


# ---- profiles ---------------------------------------------------------------


@query("""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN lang END AS a, doc_id % 4 AS n FROM documents), i AS (SELECT a, n, unnest(range(0, least(n, 3))) AS k FROM d)
SELECT 'xs[' || k || '].a' AS path, 'string' AS type, coalesce(a, '<NULL>') AS value, count(*) AS n FROM i GROUP BY ALL UNION ALL SELECT 'doc_id', 'bigint', CAST(doc_id AS VARCHAR), 1 FROM documents""")
def list_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of up to three items; an item's null member counts, an item that isn't there doesn't."""
    item = F.struct(F.when(F.col("doc_id") % 3 > 0, F.col("lang")).alias("a"))
    xs = F.slice(F.array_repeat(item, 4), F.lit(1), (F.col("doc_id") % 4).cast("int"))
    return profile.field_values(table(spark, sf_dir, "documents").select("doc_id", xs.alias("xs")))


def uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three shapes: whole, with an empty list, with a null prompt."""
    at = F.col("doc_id") % 6
    m = F.struct(F.struct(F.col("lang").alias("content"), F.lit(1).alias("other")).alias("deep"))
    return table(spark, sf_dir, "documents").select(F.when(at > 0, F.struct(F.col("lang").alias("content"))).alias("prompt"), F.when(at == 1, F.array(m)).otherwise(F.array(m)).alias("xs"), F.when(at > 2, F.array("lang")).otherwise(F.array().cast("array<string>")).alias("tags"))


SHAPES = """s AS (SELECT CASE WHEN doc_id % 6 = 0 THEN 0 WHEN doc_id % 6 <= 2 THEN 1 ELSE 2 END AS k, count(*) AS n FROM documents GROUP BY ALL),
p AS (SELECT n, k = 2 AS prim, 'prompt:' || CASE k WHEN 0 THEN 'null' ELSE 'dict,prompt.content:string' END || CASE WHEN k = 2 THEN ',tags:list,tags[0]:string' ELSE ',tags:empty_list' END || ',xs:list,xs[0]:dict,xs[0].deep:dict,xs[0].deep.content:string,xs[0].deep.other:number' AS profile FROM s)"""


@query(f"WITH {SHAPES} SELECT profile, n, prim AS \"primary\" FROM p")
def value_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = profile.profile_groups(uneven(spark, sf_dir))
    return groups.select(F.array_join(F.transform("profile", lambda x: F.concat(x["path"], F.lit(":"), x["type"])), ",").alias("profile"), "n", "primary")


@query(f"""WITH {SHAPES}, v AS (SELECT sum(n) FILTER (NOT prim)::BIGINT AS n, sum(n) FILTER (contains(profile, 'prompt:null'))::BIGINT AS m FROM p)
SELECT unnest(['tags', 'tags[0]', 'prompt', 'prompt.content']) AS path, unnest(['type_mismatch', 'missing_in_variant', 'type_mismatch', 'missing_in_variant']) AS kind, unnest(['list', 'string', 'dict', 'string']) AS in_primary, unnest(['empty_list', NULL, 'null', NULL]) AS in_variant, unnest([n, n, m, m]) AS n FROM v""")
def profile_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_differences(profile.profile_groups(uneven(spark, sf_dir)))


@query("SELECT unnest(['prompt', 'prompt.content', 'tags', 'tags[0]', 'xs', 'xs[0]', 'xs[0].deep', 'xs[0].deep.content', 'xs[0].deep.other']) AS path, unnest(['dict', 'string', 'list', 'string', 'list', 'dict', 'dict', 'string', 'number']) AS type FROM (SELECT count(*) FROM documents)")
def unified_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.unified_profile(profile.profile_groups(uneven(spark, sf_dir)))


def simple_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    rec = convert.prompt_answers(d, "x", F.col("doc_id").cast("string"), [F.col("lang")], system_text=F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    return rec.withColumn("dataset_source", F.when(F.col("initial_prompt.content").cast("long") % 3 > 0, F.col("dataset_source")))


@query("SELECT doc_id, true AS prompt, true AS parts, CASE WHEN doc_id % 2 = 0 THEN true END AS system FROM documents")
def with_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("map<string,string>")
    bare = simple_records(spark, sf_dir).withColumn("initial_prompt", F.col("initial_prompt").withField("metadata", none)).withColumn("system_prompt", F.when(F.col("system_prompt").isNotNull(), F.col("system_prompt").withField("metadata", none)))
    out = profile.with_metadata(bare)
    parts = F.forall("conversation_branches", lambda b: F.forall(b["messages"], lambda m: F.forall(m["parts"], lambda p: p["metadata"].isNotNull())))
    return out.select(F.col("initial_prompt.content").cast("long").alias("doc_id"), F.col("initial_prompt.metadata").isNotNull().alias("prompt"), parts.alias("parts"), F.when(F.col("system_prompt").isNotNull(), F.col("system_prompt.metadata").isNotNull()).alias("system"))


@query("""SELECT 'source' AS statistic, CASE WHEN doc_id % 3 > 0 THEN 'x' ELSE 'unknown' END AS value, count(*) AS n FROM documents GROUP BY ALL
UNION ALL SELECT 'system_prompt', '', count(*) FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'branches', '1', count(*) FROM documents""")
def record_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.record_stats(simple_records(spark, sf_dir))


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n, greatest(1, count(*) OVER () // 40) AS step FROM documents) SELECT doc_id FROM n WHERE n % step = 0 AND n // step < 40")
def spread_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty rows of the tables' size need no filling up."""
    return profile.spread_sample(table(spark, sf_dir, "documents"), 40, "doc_id").select("doc_id")


# ---- selections -------------------------------------------------------------


@query(f"SELECT doc_id FROM {DOCS} WHERE coalesce(src, '<NULL>') NOT IN ('src0') AND coalesce(src, '<NULL>') IN ('src0', 'src1', '<NULL>')")
def browse_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.browse(docs(spark, sf_dir), "original_metadata.source", include=["src0", "src1", "<NULL>"], exclude=["src0"]).select("doc_id")


@query(f"SELECT 'raw/set0' AS dataset, doc_id FROM {DOCS} WHERE src IS NULL OR src <> 'src0' UNION ALL SELECT 'set1', doc_id FROM {DOCS} WHERE src IN ('src1', 'src2') UNION ALL SELECT 'x/set2', doc_id FROM {DOCS} UNION ALL SELECT 'set3', doc_id FROM {DOCS} WHERE split <> 'set1'")
def rules_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole tables under the rules of their names."""
    at = {name: dict(rule, field="original_metadata.source") for name, rule in RULES.items()} | {"set3": {"kind": "splits", "splits": ["set1"]}}
    found = [filters.apply_rule(docs(spark, sf_dir), name, at).select(F.lit(name).alias("dataset"), "doc_id") for name in ("raw/set0", "set1", "x/set2", "set3")]
    return mixture.concatenate(*found)


@query("SELECT 'bench' || (item_id % 4) AS benchmark, CASE WHEN item_id % 4 = 3 THEN 1 ELSE 0 END AS job FROM benchmark GROUP BY ALL")
def benchmark_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.job_chunks(bench_texts(spark, sf_dir), 3)


@query("SELECT 'bench' || (item_id % 4) AS benchmark, count(*) AS n FROM benchmark WHERE item_id % 4 IN (1, 2) GROUP BY ALL")
def benchmark_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.subset(bench_texts(spark, sf_dir), start=1, end=3).groupBy("benchmark").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT 'bench' || (item_id % 4) AS benchmark, count(*) AS n, 'nobody' AS missing FROM benchmark WHERE item_id % 4 = 2 GROUP BY ALL")
def benchmark_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, missing = decontam.named(bench_texts(spark, sf_dir), ["bench2, nobody"])
    return kept.groupBy("benchmark").agg(F.count(F.lit(1)).alias("n"), F.lit(",".join(missing)).alias("missing"))


@query("SELECT doc_id, row_number() OVER (ORDER BY source, doc_id) - 1 AS n FROM documents")
def text_key_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows numbered in the order of a text and an id, without one task for all."""
    return split.row_numbers(table(spark, sf_dir, "documents"), "source", "doc_id").select("doc_id", "n")


@query("SELECT 'a' AS aggregation_input_data_path, count(*) AS n FROM documents WHERE lang IN ('en') UNION ALL SELECT 'b', count(*) FROM documents WHERE source IN ('src1', 'src2') AND lang IN ('fr') UNION ALL SELECT 'c', count(*) FROM documents WHERE lang IN ('en') AND source IN ('src2')")
def mixture_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One mixture that names two tables, and another mixture with a filter of its own."""
    d = docs(spark, sf_dir)
    made = convert.prompt_answers(d, "x/y", F.col("text"), [F.col("lang")], key=F.col("doc_id").cast("string"))
    made = made.withColumn("k", F.substring_index("conversation_id", "_", 3))
    plain = d.select(F.concat(F.lit("x_y_"), F.col("doc_id").cast("string")).alias("k"), "source", "lang")
    by = lambda field, *values: {"field": field, "values": list(values)}
    catalogue = {
        "all": [{"dataset_path": "a", "filters": [by("lang", "en")]}, {"dataset_path": "b", "filters": [by("source", "src1", "src2"), by("lang", "fr")]}, {"mixture": "english", "filters": [by("source", "src2")]}],
        "english": [{"dataset_path": "c", "filters": [by("lang", "en")]}],
    }
    out = mixture.mixture(spark, mixture.resolved(catalogue, "all"), lambda _: made.join(plain, "k"))
    return out.groupBy("aggregation_input_data_path").agg(F.count(F.lit(1)).alias("n"))


# ---- sketched profiles ------------------------------------------------------

_CELLS = "(SELECT unnest([{'path': 'doc_id', 'type': 'bigint', 'value': CAST(doc_id AS VARCHAR)}, {'path': 'lang', 'type': 'string', 'value': lang}, {'path': 'source', 'type': 'string', 'value': source}, {'path': 'n_chars', 'type': 'bigint', 'value': CAST(n_chars AS VARCHAR)}], recursive := true) FROM documents)"


@query(f"""
WITH c AS {_CELLS}, t AS (SELECT path, count(value) AS filled FROM c GROUP BY path)
SELECT path, type, value, count(*) AS n FROM c JOIN t USING (path) WHERE value IS NOT NULL GROUP BY path, type, value, filled HAVING count(*) >= 0.02 * filled""")
def frequent_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.frequent(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), 0.02)


@query("""
SELECT 'lang' AS path, count(*) AS "rows", count(lang) AS filled, count(DISTINCT lang) AS "distinct", min(length(lang)) AS shortest, max(length(lang)) AS longest FROM documents
UNION ALL SELECT 'source', count(*), count(source), count(DISTINCT source), min(length(source)), max(length(source)) FROM documents""")
def sketched_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of the table's three thirds, merged."""
    docs = table(spark, sf_dir, "documents").select("lang", "source", F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("day"))
    days = [sketches.sketched(docs.where(F.col("day") == k).drop("day")) for k in range(3)]
    found = sketches.stats(sketches.merged(*days), quantiles=(0.0, 1.0))
    return found.select("path", "rows", "filled", "distinct", F.col("lengths")[0].alias("shortest"), F.col("lengths")[1].alias("longest"))


# ---- merged structures ------------------------------------------------------


@query("""
WITH k AS (
    SELECT '' AS path, '' AS above, doc_id AS i, 'dict' AS kind FROM documents
    UNION ALL SELECT '.id', '', doc_id, 'int' FROM documents
    UNION ALL SELECT '.note', '', doc_id, CASE doc_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN 'dict' ELSE 'str' END FROM documents
    UNION ALL SELECT '.note.a', '.note', doc_id, 'float' FROM documents WHERE doc_id % 5 = 1
    UNION ALL SELECT '.mix', '', doc_id, CASE doc_id % 4 WHEN 0 THEN 'str' ELSE 'dict' END FROM documents
    UNION ALL SELECT '.mix.z', '.mix', doc_id, 'int' FROM documents WHERE doc_id % 4 <> 0
    UNION ALL SELECT '.tags', '', doc_id, CASE doc_id % 3 WHEN 0 THEN '[]' ELSE 'list' END FROM documents
    UNION ALL SELECT '.tags[0]', '.tags', doc_id, 'dict' FROM documents WHERE doc_id % 3 <> 0
    UNION ALL SELECT '.tags[0].t', '.tags[0]', doc_id, CASE doc_id % 2 WHEN 0 THEN 'null' ELSE 'bool' END FROM documents WHERE doc_id % 3 <> 0
    UNION ALL SELECT '.metadata', '', doc_id, 'null' FROM documents
    UNION ALL SELECT '.options', '', doc_id, 'null' FROM documents
    UNION ALL SELECT '.empty', '', doc_id, '{}' FROM documents),
w AS (SELECT path, any_value(above) AS above, coalesce(arg_min(kind, i) FILTER (kind NOT IN ('null', '{}', '[]')), arg_max(kind, i) FILTER (kind IN ('{}', '[]')), CASE path WHEN '.metadata' THEN '{}' WHEN '.options' THEN '[]' ELSE 'str' END) AS kind FROM k GROUP BY path)
SELECT a.path, a.kind FROM w a JOIN w b ON b.path = a.above WHERE a.path = '' OR b.kind = CASE WHEN ends_with(a.path, '[0]') THEN 'list' ELSE 'dict' END""")
def merged_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    said = F.concat(
        F.lit('{"id": '), i, F.lit(', "metadata": null, "options": null, "empty": {}, "note": '), F.when(i % 5 == 0, "null").when(i % 5 == 1, '{"a": 1.5}').otherwise('"x"'),
        F.lit(', "mix": '), F.when(i % 4 == 0, '"x"').otherwise('{"z": 1}'), F.lit(', "tags": '), F.when(i % 3 == 0, "[]").when(i % 2 == 0, '[{"t": null}]').otherwise('[{"t": true}]'), F.lit("}"),
    )
    rows = structures.structure_rows(table(spark, sf_dir, "documents").select("doc_id", said.alias("said")), "said", "doc_id")
    return structures.resolved(rows).select(F.array_join("path", "").alias("path"), "kind")
