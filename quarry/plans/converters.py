"""Queries of the converters, and their SQL.

Inputs are made of the tables' texts by expressions that Spark and the SQL share; results are whole
records, flattened to texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.operators import convert, formats, mixture
from quarry.plans.catalog import query, table


def made(spark: SparkSession, sf_dir: str, **columns: str) -> DataFrame:
    """doc_id and columns by expressions over ``documents``."""
    return table(spark, sf_dir, "documents").select("doc_id", *[F.expr(e).alias(c) for c, e in columns.items()])


def inputs(**columns: str) -> str:
    return "SELECT doc_id, " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + " FROM documents"


def flat(out: DataFrame) -> DataFrame:
    """A record's members as texts, under the names the SQL uses."""
    pairs = lambda m: F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    one = lambda p: F.concat(p["type"], F.lit(":"), p["name"], F.lit(":"), p["args"], F.lit(":"), p["content"], F.lit(":"), F.array_join(p["answers"], ","), F.lit(":"), pairs(p["metadata"]))
    said = lambda m: F.concat(m["role"], F.lit("["), F.array_join(F.transform(m["parts"], one), ";"), F.lit("]"))
    branch = lambda b: F.array_join(F.transform(b["messages"], said), "\n")
    tool = lambda f: F.concat(f["name"], F.lit(":"), f["description"], F.lit(":"), f["parameters"])
    return out.select(
        "doc_id", "conversation_id", "dataset_source", pairs(F.col("original_metadata")).alias("metadata"), F.col("system_prompt.content").alias("system_text"),
        F.concat("initial_prompt.role", F.lit(":"), "initial_prompt.content", F.lit(":"), pairs(F.col("initial_prompt.metadata"))).alias("initial"),
        F.array_join(F.transform("available_functions", tool), ";").alias("functions"), F.array_join(F.transform("conversation_branches", branch), "\n--\n").alias("branches"),
    )


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def squeezed_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({strip_sql(x)}, '\\n\\s*\\n', chr(10) || chr(10), 'g'), ' +', ' ', 'g')"


def lines_sql(x: str) -> str:
    return f"regexp_replace({strip_sql(x)}, '\\n\\s*\\n\\s*\\n+', chr(10) || chr(10), 'g')"


def part_sql(kind: str, content: str, name: str = "''", args: str = "''", answers: str = "''", metadata: str = "''") -> str:
    return f"'{kind}:' || {name} || ':' || {args} || ':' || {content} || ':' || {answers} || ':' || {metadata}"


# ---- mathematics ------------------------------------------------------------

MATH = {
    "problem": "CASE doc_id % 8 WHEN 0 THEN '## Problem 3. ' || text WHEN 1 THEN 'nt12 ' || text WHEN 2 THEN 'Short one.' || chr(10) || text WHEN 3 THEN '# Find x now please' WHEN 4 THEN text || ' see cdn.foo' WHEN 5 THEN 'G7  a' || chr(10) || ' ' || chr(10) || chr(10) || text WHEN 6 THEN text || ' www.x.de [a](b) y.png' ELSE text END",
    "solution": "CASE doc_id % 7 WHEN 0 THEN '### Solution 2.  so' || chr(10) || '## Remark ' || chr(10) || text WHEN 1 THEN 'Solution: x' WHEN 2 THEN 'Done.' WHEN 3 THEN text || ' at a.COMx' ELSE '## Title' || chr(10) || text END",
    "answer": "CASE doc_id % 5 WHEN 0 THEN 'NotFound' WHEN 1 THEN 'Proof' WHEN 2 THEN ' 4  2 ' WHEN 3 THEN '' ELSE doc_id || '' END",
}
LINK = "(?i)!\\[.*?\\]\\(.*?\\)|https?://|\\.com|\\.org|\\.net|\\.edu|cdn\\."


def _heads(x: str, *heads: str) -> str:
    for h in heads:
        x = f"regexp_replace({x}, '{h}', '')"
    return x


def _first(x: str) -> str:
    line = strip_sql(f"split_part({x}, chr(10), 1)")
    return f"CASE WHEN length({line}) < 20 AND ends_with({line}, '.') THEN CASE WHEN contains({x}, chr(10)) THEN substr({x}, instr({x}, chr(10)) + 1) ELSE '' END ELSE {x} END"


MATH_SQL = f"""WITH raw AS ({inputs(**MATH)}),
sq AS (SELECT doc_id, answer AS given, {squeezed_sql("problem")} AS p, {squeezed_sql("solution")} AS s, {squeezed_sql("answer")} AS answer FROM raw),
hd AS (SELECT *, {_heads("p", "^#+\\s*", "(?i)^problem\\s+\\d+\\.?\\s*", "(?i)^nt\\d+\\s*", "(?i)^g\\d+\\s*", "(?i)^##\\s*problem\\s+\\d+\\.?\\s*", "(?i)^#\\s*problem\\s+\\d+\\.?\\s*")} AS p1,
  {_heads("s", "^#+\\s*", "(?i)^solution\\s*\\d*\\.?\\s*", "(?i)^##\\s*solution\\s*\\d*\\.?\\s*", "(?i)^#\\s*solution\\s*\\d*\\.?\\s*")} AS s1 FROM sq),
fl AS (SELECT *, {_first("p1")} AS p2, {_first("s1")} AS s2 FROM hd),
cl AS (SELECT doc_id, given, p, s, answer, {strip_sql("p2")} AS problem, {strip_sql("array_to_string(list_filter(string_split(s2, chr(10)), lambda x: NOT regexp_matches(" + strip_sql("x") + ", '^#+\\s+[A-Za-z]+\\s*$')), chr(10))")} AS solution FROM fl),
math AS (SELECT *, NOT regexp_matches(p, '{LINK}') AND NOT regexp_matches(s, '{LINK}') AND lower(answer) <> 'notfound' AND problem <> '' AND solution <> '' AS keep FROM cl)"""


@query(f"{MATH_SQL} SELECT doc_id, problem, solution, keep FROM math")
def math_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = made(spark, sf_dir, **MATH)
    return d.select("doc_id", convert.math_prompt(F.col("problem")).alias("problem"), convert.math_solution(F.col("solution")).alias("solution"), convert.math_keep(F.col("problem"), F.col("solution"), F.col("answer")).alias("keep"))


@query(f"SELECT doc_id FROM ({inputs(**MATH)}) WHERE NOT regexp_matches(problem, '{LINK}')")
def link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, **MATH).where(~T.has_link(F.col("problem"))).select("doc_id")


PROOF = part_sql("response", "solution")
SOLVED = f"{part_sql('thought', 'solution')} || ';' || {part_sql('response', chr(39) + 'The answer is: ' + chr(39) + ' || answer')}"


@query(f"""{MATH_SQL} SELECT doc_id, 'numina-math-1.5_' || left(sha256(problem || doc_id), 12) AS conversation_id, 'numina-math-1.5' AS dataset_source,
'answer=' || given || '|problem_type=Algebra|row_index=' || doc_id || CASE WHEN lower(answer) <> 'proof' THEN '|verifiable_answer=' || answer ELSE '' END AS metadata, '' AS system_text,
'user:' || problem || ':answer=' || answer || '|problem_type=Algebra' || CASE WHEN lower(answer) <> 'proof' THEN '|verifiable_answer=' || answer ELSE '' END AS initial, '' AS functions,
'assistant[' || CASE WHEN lower(answer) = 'proof' THEN {PROOF} ELSE {SOLVED} END || ']' AS branches FROM math WHERE keep""")
def math_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(formats.mathematics(made(spark, sf_dir, **MATH, problem_type="'Algebra'"), row="doc_id", keep=["doc_id"]))


@query(f"""{MATH_SQL} SELECT doc_id, CASE WHEN lower(answer) = 'proof' THEN 'response' WHEN answer = '' THEN 'thought,response' ELSE 'thought,response,verifiable-responses' END AS kinds,
CASE WHEN lower(answer) <> 'proof' AND answer <> '' THEN answer END AS checkable, true AS known_form FROM math WHERE keep""")
def varied_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the known forms is chosen depends on a hash; that it is one of them is checked here."""
    rows = formats.mathematics(made(spark, sf_dir, **MATH), row="doc_id", varied=True, keep=["doc_id"])
    parts = F.col("conversation_branches")[0]["messages"][0]["parts"]
    answer = F.col("initial_prompt.metadata")["answer"]
    said = F.filter(parts, lambda p: p["type"] == "response")[0]["content"]
    known = F.exists(F.array(*map(F.lit, convert.answer_forms())), lambda form: F.replace(form, F.lit("{answer}"), answer) == said) | (F.lower(answer) == "proof")
    return rows.select("doc_id", F.array_join(F.transform(parts, lambda p: p["type"]), ",").alias("kinds"), F.try_element_at(F.flatten(F.transform(parts, lambda p: p["answers"])), F.lit(1)).alias("checkable"), known.alias("known_form"))


FORMS = " UNION ALL ".join(f"SELECT {i} AS i, '{form.replace(chr(39), chr(39) * 2)}' AS form" for i, form in enumerate(convert.ANSWER_FORMS))


@query(f"""WITH forms AS ({FORMS}), labels AS (SELECT unnest(['Answer', 'Solution', 'Result', 'Evaluation', 'Conclusion', 'Expression']) AS label, unnest(range(0, 6)) AS j)
SELECT CAST(i * 6 + j AS INTEGER) AS n, replace(form, '{{label}}', CASE WHEN regexp_matches(form, '\\{{label\\}}( —| →| ⇒| =|:)') THEN label ELSE lower(label) END) AS form, (SELECT count(*) FROM documents) > 0 AS used FROM forms, labels""")
def answer_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = not table(spark, sf_dir, "documents").isEmpty()
    return spark.createDataFrame(list(enumerate(convert.answer_forms())), "n int, form string").withColumn("used", F.lit(used))


KINDS = {"a": "CASE doc_id % 3 WHEN 0 THEN 'Algebra' WHEN 1 THEN '' END", "b": "CASE doc_id % 4 WHEN 0 THEN 'Math-Word-Problem' WHEN 1 THEN 'PROOF' WHEN 2 THEN 'other' END"}


@query(f"""SELECT doc_id, 'You are a helpful mathematics tutor. Solve the given mathematical problem step by step, showing your work clearly.' || CASE WHEN a = 'Algebra' THEN ' This is a algebra problem.' ELSE '' END ||
CASE b WHEN 'Math-Word-Problem' THEN ' Read the problem carefully and identify the key information needed to solve it.' WHEN 'PROOF' THEN ' Provide a rigorous mathematical proof with clear logical steps.' ELSE '' END AS prompt FROM ({inputs(**KINDS)})""")
def tutor_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return made(spark, sf_dir, **KINDS).select("doc_id", convert.tutor_prompt(F.col("a"), F.col("b")).alias("prompt"))


# ---- translations, dialects, questions of a charter -------------------------

ASKED = {"q": "CASE doc_id % 7 WHEN 0 THEN 'Übersetze INS SURSILVAN: ' || text WHEN 1 THEN 'Bitte auf Deutsch: ' || text WHEN 2 THEN 'Ins Deutsche, nicht ins Rumantsch: ' || text WHEN 3 THEN 'Liste der Sursilvan-Begriffe' WHEN 4 THEN '  Deutscher Begriffe ' || chr(10) || chr(10) || ' ' || chr(10) || text WHEN 5 THEN NULL ELSE text END", "a": "source || chr(10)"}
QA = f"(SELECT doc_id, {lines_sql('coalesce(q, ' + chr(39) * 2 + ')')} AS q, {strip_sql('a')} AS a FROM ({inputs(**ASKED)}))"


@query(f"""WITH t AS (SELECT *, CASE WHEN regexp_matches(lower(q), 'ins sursilvan|ins romansch|ins rumantsch') THEN true WHEN regexp_matches(lower(q), 'ins deutsche|auf deutsch|sursilvan-begriffe') THEN false ELSE true END AS ahead FROM {QA}),
l AS (SELECT *, CASE WHEN ahead THEN 'German' ELSE 'Romansh (Sursilvan)' END AS f, CASE WHEN ahead THEN 'Romansh (Sursilvan)' ELSE 'German' END AS g FROM t)
SELECT doc_id, 'romansh-sft_' || left(sha256(q || '_' || doc_id), 12) AS conversation_id, 'romansh-sft' AS dataset_source, 'row_index=' || doc_id || '|source_lang=' || f || '|target_lang=' || g || '|task_type=translation' AS metadata, '' AS system_text,
'user:' || q || ':source_lang=' || f || '|target_lang=' || g || '|task_type=translation' AS initial, '' AS functions, 'assistant[' || {part_sql("response", "a", metadata="'language=' || g")} || ']' AS branches FROM l""")
def translation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(formats.translations(made(spark, sf_dir, input=ASKED["q"], output=ASKED["a"]), row="doc_id", keep=["doc_id"]))


CODES = "CASE doc_id % 6 WHEN 0 THEN 'ch_vs' WHEN 1 THEN 'ch_bs' WHEN 2 THEN 'ch_zh' WHEN 3 THEN 'BE' WHEN 4 THEN 'ch_be' END"


@query(f"""WITH c AS (SELECT doc_id, coalesce({CODES}, '') AS c, source FROM documents), n AS (SELECT *, CASE c WHEN 'ch_vs' THEN 'Valais' WHEN 'ch_bs' THEN 'Basel-Stadt' WHEN 'ch_zh' THEN 'Zürich' WHEN 'ch_be' THEN 'Bern' ELSE c END AS n FROM c)
SELECT doc_id, 'swiss-german-dialects_' || left(sha256(q || '_' || doc_id), 12) AS conversation_id, 'swiss-german-dialects' AS dataset_source, 'dialect=' || c || '|dialect_name=' || n || '|row_index=' || doc_id || '|source=' || source AS metadata, '' AS system_text,
'user:' || q || ':dialect=' || c || '|dialect_name=' || n || '|source=' || source AS initial, '' AS functions, 'assistant[' || {part_sql("response", "a", metadata="'dialect=' || c || '|dialect_name=' || n")} || ']' AS branches FROM {QA} JOIN n USING (doc_id)""")
def dialect_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(formats.dialects(made(spark, sf_dir, instruction=ASKED["q"], output=ASKED["a"], dialect=CODES, source="source"), row="doc_id", keep=["doc_id"]))


@query(f"""SELECT doc_id, 'charter-qa_' || left(sha256(q || '_' || doc_id), 12) AS conversation_id, 'charter-qa' AS dataset_source, 'row_index=' || doc_id AS metadata, '' AS system_text, 'user:' || q || ':' AS initial, '' AS functions,
'assistant[' || {part_sql("response", "a")} || ']' AS branches FROM {QA}""")
def charter_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(formats.charter(made(spark, sf_dir, question=ASKED["q"], response=ASKED["a"]), row="doc_id", keep=["doc_id"]))


# ---- records of an older shape ----------------------------------------------


@query(f"""SELECT doc_id, coalesce(CASE WHEN doc_id % 3 > 0 THEN 'id' || doc_id END, 'wikiqa_' || doc_id) AS conversation_id, 'wikiqa' AS dataset_source, 'language_code=' || lang || '|n_chars=' || n_chars AS metadata, '' AS system_text,
CASE WHEN doc_id % 4 = 0 THEN 'user::' ELSE 'user:' || text || ':k=' || source END AS initial, '' AS functions,
CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'assistant[' || {part_sql("response", "source", metadata="'k=' || lang")} || ']' || chr(10) || 'user[' || {part_sql("response", "text", metadata="'k=x'")} || ']' END AS branches FROM documents""")
def wiki_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    said = lambda role, text, k: F.struct(F.lit(role).alias("role"), F.col(text).alias("content"), F.struct(k.alias("k")).alias("metadata"))
    old = d.select(
        "doc_id", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("id"), F.col("doc_id"))).alias("conversation_id"), F.col("lang").alias("language_code"), "n_chars",
        F.when(F.col("doc_id") % 4 > 0, said("user", "text", F.col("source"))).alias("initial_prompt"),
        F.when(F.col("doc_id") % 5 > 0, F.array(F.struct(F.array(said("assistant", "source", F.col("lang")), said("user", "text", F.lit("x"))).alias("messages")))).alias("conversation_branches"),
    )
    return flat(formats.wiki_questions(old, row="doc_id", keep=["doc_id"]))


THOUGHT = "CASE doc_id % 3 WHEN 0 THEN '<THINK> ' || text || ' </think>' WHEN 1 THEN ' <think>' || lang ELSE text || chr(10) || '</Think>' END"


@query(f"""WITH t AS (SELECT *, {strip_sql("regexp_replace(regexp_replace(" + THOUGHT + ", '(?i)^<think>\\s*', ''), '(?i)\\s*</think>$', '')")} AS th FROM documents)
SELECT doc_id, 'id' || doc_id AS conversation_id, 's1k_42_langs' AS dataset_source, 'lang=' || lang AS metadata, '' AS system_text, 'user:' || text || ':' AS initial, '' AS functions,
CASE WHEN doc_id % 4 = 0 THEN 'assistant[' || {part_sql("response", "source")} || ']' ELSE 'assistant[' || {part_sql("thought", "th")} || ';' || {part_sql("verifiable-responses", "''", answers="lang")} || ']' END AS branches FROM t""")
def reasoning_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").withColumn("thought", F.expr(THOUGHT))
    parts = F.array(F.struct(F.lit("thought").alias("type"), F.col("thought").alias("content"), F.lit(None).cast("array<string>").alias("answers")), F.struct(F.lit("verifiable-responses").alias("type"), F.lit(None).cast("string").alias("content"), F.array("lang").alias("answers")))
    m = F.struct(F.lit("assistant").alias("role"), F.when(F.col("doc_id") % 4 > 0, parts).alias("parts"), F.when(F.col("doc_id") % 4 == 0, F.col("source")).alias("content"))
    old = d.select("doc_id", F.concat(F.lit("id"), F.col("doc_id")).alias("conversation_id"), F.struct("lang").alias("original_metadata"), F.struct(F.col("text").alias("content")).alias("initial_prompt"), F.array(F.struct(F.array(m).alias("messages"))).alias("conversation_branches"))
    return flat(formats.reasoning(old, keep=["doc_id"]))


LITERAL = {
    "b": "CASE doc_id % 6 WHEN 0 THEN '[{\"messages\": [{\"role\": \"assistant\", \"content\": \"q ' || doc_id || '\"}, {\"role\": \"user\", \"content\": \"' || lang || '\"}, {\"role\": \"assistant\", \"content\": \"more?\"}, {\"role\": \"user\", \"content\": \"yes\"}, {\"role\": \"assistant\", \"content\": \"open\"}]}]' WHEN 1 THEN '[{\"messages\": [{\"role\": \"user\", \"content\": \"q\"}, {\"role\": \"assistant\", \"content\": \"a\"}]}]' WHEN 2 THEN 'broken [' WHEN 3 THEN '[{''messages'': [{''role'': ''assistant'', ''content'': ''Is ChatGPT here?''}, {''role'': ''user'', ''content'': ''a''}]}]' WHEN 4 THEN '[{''messages'': [{''role'': ''assistant'', ''content'': '' <style>.atomic-structure-template-field-8x8 x''}, {''role'': ''user'', ''content'': ''a''}]}]' ELSE '[{''messages'': [{''role'': ''assistant'', ''content'': ''q''}, {''role'': ''user'', ''content'': ''' || source || '''}]}]' END",
    "m": "CASE WHEN doc_id % 4 = 0 THEN 'not a literal' ELSE '{''lang'': ''' || lang || '''}' END",
}


@query(f"""WITH t AS (SELECT doc_id, lang, source, doc_id % 6 = 0 AS long, CASE WHEN doc_id % 6 = 0 THEN 'q ' || doc_id ELSE 'q' END AS q FROM documents WHERE doc_id % 6 IN (0, 5))
SELECT doc_id, 'africa_sft_row_' || doc_id || '_' || left(sha256(q), 8) AS conversation_id, 'africa-sft' AS dataset_source, CASE WHEN doc_id % 4 = 0 THEN 'original_dataset_source=' || source || '|raw_metadata=not a literal' ELSE 'lang=' || lang || '|original_dataset_source=' || source END AS metadata, '' AS system_text, 'user:' || q || ':' AS initial, '' AS functions,
'assistant[' || {part_sql("response", "CASE WHEN long THEN lang ELSE source END")} || ']' || CASE WHEN long THEN chr(10) || 'user[' || {part_sql("response", "'more?'")} || ']' || chr(10) || 'assistant[' || {part_sql("response", "'yes'")} || ']' ELSE '' END AS branches FROM t""")
def swapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = made(spark, sf_dir, conversation_branches=LITERAL["b"], original_metadata=LITERAL["m"], dataset_source="source")
    return flat(formats.swapped_literals(d, "africa-sft", row="doc_id", keep=["doc_id"])[0])


@query("SELECT doc_id FROM documents WHERE doc_id % 6 IN (1, 2)")
def swapped_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = made(spark, sf_dir, conversation_branches=LITERAL["b"], original_metadata=LITERAL["m"], dataset_source="source")
    return formats.swapped_literals(d, "africa-sft", row="doc_id", keep=["doc_id"])[1].select("doc_id")


# ---- function calling -------------------------------------------------------

TYPES = ("str, optional", "List[int]", "Dict[str, int], optional", "Int", "float", "Widget", "list", "mapping[str]", "Mapping[str]", " int ", "double", "optional int")


@query(f"SELECT doc_id, {list(('string', 'array', 'object', 'string', 'number', 'string', 'string', 'string', 'object', 'integer', 'string', 'string'))}[doc_id % 12 + 1] AS kind, doc_id % 12 NOT IN (0, 2) AS needed FROM documents")
def xlam_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, TYPES)), (F.col("doc_id") % 12 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", convert.xlam_type(name).alias("kind"), convert.xlam_required(name).alias("needed"))


XLAM = {
    "query": "text", "tools": "CASE doc_id % 3 WHEN 0 THEN '[{\"name\": \" f \", \"description\": \"d\", \"parameters\": {\"x\": {\"type\": \"int\", \"description\": \"n\", \"default\": 1}, \"y\": {\"type\": \"str, optional\", \"description\": \"\", \"default\": \"\"}}}, {\"name\": \" \"}]' WHEN 1 THEN 'broken' ELSE '[]' END",
    "answers": "CASE WHEN doc_id % 4 = 0 THEN '[{\"name\": \"f\", \"arguments\": {\"x\": ' || doc_id || ', \"y\": null, \"z\": \"\"}}, {\"name\": \"g\", \"arguments\": {}}]' ELSE '{' END",
}


@query(f"""SELECT doc_id, 'xlam_function_calling_60k_' || left(sha256(text), 12) AS conversation_id, 'xlam-function-calling-60k' AS dataset_source, 'original_id=' || doc_id AS metadata,
'You are a helpful assistant with access to tools. Use them to answer the user''s questions effectively.' AS system_text, 'user:' || text || ':' AS initial,
CASE WHEN doc_id % 3 = 0 THEN 'f:d:{{"type":"object","properties":{{"x":{{"type":"integer","description":"n","default":"1"}},"y":{{"type":"string","description":""}}}},"required":["x"]}}' ELSE '' END AS functions,
'assistant[' || CASE WHEN doc_id % 4 = 0 THEN {part_sql("function-call", "''", "'f'", "'{\"x\":\"' || doc_id || '\"}'")} || ';' || {part_sql("function-call", "''", "'g'")} ELSE '' END || ']' AS branches FROM documents""")
def tool_query_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(formats.tool_queries(made(spark, sf_dir, **XLAM), row="doc_id", keep=["doc_id"]))


LINES = "CASE doc_id % 4 WHEN 0 THEN 'SYSTEM: sys ' || lang || chr(10) || '{\"name\": \"f\", \"description\": \"a } brace\", \"parameters\": {\"p\": {\"q\": 1}}} {\"other\": 1}' || chr(10) || 'user: hi' || chr(10) || '  more ' || chr(10) || chr(10) || 'ASSISTANT: <functioncall> {\"name\": \"f\", \"arguments\": {\"a\": ' || doc_id || '}}' || chr(10) || 'FUNCTION RESPONSE: ' || source || chr(10) || 'ASSISTANT:  done' || chr(10) || 'USER: bye' WHEN 1 THEN 'noise' || chr(10) || 'ASSISTANT: first' || chr(10) || 'USER: ' || lang WHEN 2 THEN 'SYSTEM: only' || chr(10) || 'no user' ELSE 'USER: x' || chr(10) || 'ASSISTANT: <functioncall> {broken}' || chr(10) || 'tail' END"
GLAIVE_F = '{"type":"object","properties":{"p":{"q":1}},"required":[]}'


@query(f"""SELECT doc_id, 'glaive-function-calling_' || left(sha256(CASE doc_id % 4 WHEN 0 THEN 'hi' || chr(10) || 'more' || chr(10) WHEN 1 THEN lang WHEN 2 THEN '' ELSE 'x' END || doc_id), 12) AS conversation_id, 'glaive-function-calling' AS dataset_source, 'original_id=' || doc_id AS metadata,
CASE doc_id % 4 WHEN 0 THEN 'sys ' || lang WHEN 2 THEN 'only' ELSE '' END AS system_text, 'user:' || CASE doc_id % 4 WHEN 0 THEN 'hi' || chr(10) || 'more' || chr(10) WHEN 1 THEN lang WHEN 2 THEN '' ELSE 'x' END || ':' AS initial,
CASE WHEN doc_id % 4 = 0 THEN 'f:a }} brace:{GLAIVE_F}' ELSE '' END AS functions,
CASE doc_id % 4 WHEN 0 THEN 'FUNCTION-CALL[' || {part_sql("function-call", "''", "'f'", "'{\"a\":' || doc_id || '}'")} || ']' || chr(10) || 'FUNCTION-RESPONSE[' || {part_sql("function-output", "source")} || ']' || chr(10) || 'assistant[' || {part_sql("response", "'done'")} || ']' || chr(10) || 'user[' || {part_sql("response", "'bye'")} || ']'
WHEN 1 THEN 'assistant[' || {part_sql("response", "'first'")} || ']' WHEN 2 THEN '' ELSE 'assistant[' || {part_sql("response", "'<functioncall> {broken}' || chr(10) || 'tail'")} || ']' END AS branches FROM documents""")
def tagged_line_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(formats.tagged_lines(made(spark, sf_dir, sample=LINES), row="doc_id", keep=["doc_id"]))


BLOCKS = {
    "system": "'SYSTEM: tools - ' || lang || ' -' || chr(10) || '{\"name\": \"f\", \"description\": \"d\", \"parameters\": {\"type\": \"object\", \"properties\": {}}}'",
    "chat": "CASE doc_id % 4 WHEN 0 THEN 'USER: a' || chr(10) || 'b' || chr(10) || chr(10) || 'ASSISTANT: <functioncall> {\"name\": \"f\", \"arguments\": ''{\"x\": ' || doc_id || '}''} <|endoftext|>' || chr(10) || chr(10) || 'FUNCTION RESPONSE: ' || source || chr(10) || chr(10) || 'ASSISTANT: done <|endoftext|>' || chr(10) || chr(10) || 'USER: thanks' WHEN 1 THEN 'lost' || chr(10) || chr(10) || 'USER: ' || lang || chr(10) || chr(10) || 'ASSISTANT: two' || chr(10) || 'lines' || chr(10) || chr(10) || 'ASSISTANT: <functioncall> {\"name\": \"g\"}' WHEN 2 THEN 'USER: q' || chr(10) || chr(10) || 'ASSISTANT: <functioncall> {\"name\": \"f\", \"arguments\": ''broken}''}' ELSE '' END",
}


@query(f"""WITH t AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'a' || chr(10) || 'b' WHEN 1 THEN lang ELSE '' END AS q FROM documents WHERE doc_id % 4 <> 2)
SELECT doc_id, 'glaive-function-calling-v2_' || left(sha256(q || doc_id), 12) AS conversation_id, 'glaive-function-calling-v2' AS dataset_source, 'original_id=' || doc_id AS metadata, 'tools. ' || lang || '.' AS system_text, 'user:' || q || ':' AS initial,
'f:d:{{"properties":{{}},"type":"object"}}' AS functions,
CASE doc_id % 4 WHEN 0 THEN 'assistant[' || {part_sql("function-call", "''", "'f'", "'{\"x\":' || doc_id || '}'")} || ';' || {part_sql("function-output", "source")} || ';' || {part_sql("response", "'done'")} || ']' || chr(10) || 'user[' || {part_sql("response", "'thanks'")} || ']'
WHEN 1 THEN 'assistant[' || {part_sql("function-call", "''", "'g'")} || ']' ELSE '' END AS branches FROM t""")
def tagged_block_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows keep their system text here: which ones do by default depends on a hash."""
    return flat(formats.tagged_blocks(made(spark, sf_dir, **BLOCKS), row="doc_id", tenths=10, keep=["doc_id"]))


CALLS = {"think": "'{\"name\": \"think\", \"arguments\": {\"thought\": \"plan ' || doc_id || '\"}}'", "text": "'{\"name\": \"f\", \"arguments\": \"{\\\\\"a\\\\\": 1}\"}'", "list": "'{\"name\": \"g\", \"arguments\": [1]}'"}
PARAMS = '{"properties":{},"type":"object"}'


@query(f"""WITH c AS (SELECT *, string_agg(CASE role WHEN 'user' THEN 'user[response:::' || text || '::]' ELSE 'assistant[response:::' || text || '::' ||
 CASE WHEN turn % 3 = 1 THEN ';thought:::plan ' || conv_id || '::;function-call:f:{{"a":1}}:::;function-call:g::::;function-output:::ok::' ELSE '' END || ']' END, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS branches,
 first_value(role) OVER w AS first_role, first_value(text) OVER w AS first_text, row_number() OVER w AS k FROM conversations WHERE role <> 'system' WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
u AS (SELECT conv_id, arg_min(text, turn) AS human FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT conv_id AS doc_id, 'apigen_mt_5k_' || left(sha256(coalesce(human, '')), 12) AS conversation_id, 'apigen-mt-5k' AS dataset_source, 'original_id=' || conv_id AS metadata, 'be kind' AS system_text,
'user:' || CASE WHEN first_role = 'user' THEN first_text ELSE '' END || ':' AS initial, 'h::{PARAMS}' AS functions, branches FROM c LEFT JOIN u USING (conv_id) WHERE k = 1""")
def tool_conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of ``conversations``, every third answer with calls after it; turns of the system are of no known kind."""
    chats = convert.gather_turns(table(spark, sf_dir, "conversations").withColumn("turn", F.struct("turn")))
    step = lambda kind, value: F.struct(F.lit(kind).alias("from"), F.expr(value.replace("doc_id", "conv_id")).alias("value"))
    more = F.array(step("function_call", CALLS["think"]), step("function_call", CALLS["text"]), step("function_call", "'broken'"), step("function_call", CALLS["list"]), step("observation", "'ok'"))
    name = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise("note")
    turns = F.flatten(F.transform("messages", lambda m, i: F.concat(F.array(F.struct(name(m["role"]).alias("from"), m["content"].alias("value"))), F.when((m["role"] == "assistant") & (i % 3 == 1), more).otherwise(F.array().cast("array<struct<from:string,value:string>>")))))
    d = chats.select(F.col("conv_id").alias("doc_id"), "conv_id", turns.alias("conversations"), F.lit('[{"name": " h ", "parameters": {"type": "object", "properties": {}}}, {"name": ""}]').alias("tools"), F.lit("be kind").alias("system"))
    return flat(formats.tool_conversations(d, row="conv_id", keep=["doc_id"]))


@query("""
WITH k AS (SELECT conv_id, turn, CASE WHEN role = 'user' AND (conv_id + turn) % 7 > 0 THEN 'human' WHEN (conv_id + turn) % 3 = 0 THEN 'function_call' ELSE 'gpt' END AS kind FROM conversations),
b AS (SELECT *, CASE WHEN kind = 'human' OR coalesce(lag(kind) OVER (PARTITION BY conv_id ORDER BY turn), 'human') = 'human' THEN 1 ELSE 0 END AS begins FROM k),
g AS (SELECT *, sum(begins) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn_no FROM b)
SELECT conv_id, CAST(turn_no AS INTEGER) AS turn, CASE WHEN min(kind) = 'human' THEN 'user' ELSE 'assistant' END AS role, CAST(count(*) AS INTEGER) AS items FROM g GROUP BY conv_id, turn_no
""")
def turn_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some of the user's turns are the assistant's here, so that these meet."""
    c = table(spark, sf_dir, "conversations")
    place = F.col("conv_id") + F.col("turn")
    kind = F.when((F.col("role") == "user") & (place % 7 > 0), "human").when(place % 3 == 0, "function_call").otherwise("gpt")
    d = convert.gather_turns(c.withColumn("role", kind))
    d = d.select("conv_id", F.transform("messages", lambda x: F.struct(x["role"].alias("from"), x["content"].alias("value"))).alias("conversations"))
    return convert.grouped_turns(d, keys=["conv_id"]).select("conv_id", "turn", "role", F.size("items").alias("items"))


# ---- harmonised metadata, texts with structure ------------------------------


@query("SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'kept' WHEN 1 THEN 'number' WHEN 2 THEN 'number' WHEN 3 THEN 'number' ELSE '0' END AS kind, doc_id % 5 = 0 AS rest FROM documents")
def harmonised_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, doc = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    pair = lambda *more: F.create_map(F.lit("id"), doc, F.lit("source"), F.col("source"), *map(F.lit, more))
    meta = F.when(at == 0, F.create_map(F.lit("original_id"), F.lit("kept"), F.lit("x"), F.lit("y"))).when(at == 1, pair()).when(at == 2, pair("x", "y")).when(at == 3, pair("original_id", "kept")).otherwise(F.create_map(F.lit("x"), F.lit("y")))
    out = mixture.harmonise_metadata(table(spark, sf_dir, "documents").withColumn("original_metadata", meta))
    v = F.col("original_metadata")["original_id"]
    return out.select("doc_id", F.when(v.isin("kept", "0"), v).otherwise("number").alias("kind"), F.map_contains_key("original_metadata", "x").alias("rest"))


BOXED = "text || ' \\\\boxed{a_{1}} and \\\\boxed{' || lang || '} open \\\\boxed{{x}'"


@query("SELECT doc_id, text || ' a_{1} and ' || lang || ' open \\boxed{{x}' AS text, 'a_{1}|' || lang AS answers FROM documents")
def boxed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = T.boxed(F.expr(BOXED))
    return table(spark, sf_dir, "documents").select("doc_id", x["text"].alias("text"), F.array_join(x["answers"], "|").alias("answers"))


@query(f"""WITH t AS (SELECT doc_id, lang, {strip_sql("text")} AS text FROM documents),
p AS (SELECT doc_id, unnest(list_filter([CASE WHEN text <> '' THEN {{'type': 'response', 'content': text, 'name': '', 'args': ''}} END, {{'type': 'function-call', 'content': '', 'name': 'execute_python', 'args': '{{"code": "print(1)"}}'}}, {{'type': 'function-output', 'content': '1', 'name': '', 'args': ''}},
 {{'type': 'response', 'content': '```sql' || chr(10) || 'select' || chr(10) || '```', 'name': '', 'args': ''}}, {{'type': 'response', 'content': lang, 'name': '', 'args': ''}}], lambda x: x IS NOT NULL)) AS p, generate_subscripts(list_filter([CASE WHEN text <> '' THEN 1 END, 2, 3, 4, 5], lambda x: x IS NOT NULL), 1) - 1 AS n FROM t)
SELECT doc_id, n::INTEGER AS n, p.type AS type, p.content AS content, p.name AS name, p.args AS args FROM p""")
def fence_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    tail = "\n```python\nprint(1)\n```\n```output\n1\n```\n```sql\nselect\n```\n"
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.col("text"), F.lit(tail), F.col("lang")).alias("t"))
    return d.select("doc_id", F.posexplode(T.fences("t")).alias("n", "p")).select("doc_id", "n", "p.type", "p.content", "p.name", "p.args")


@query("SELECT doc_id, '{\"name\": \"f\", \"p\": {\"q\": \"}\"}}' AS object FROM documents WHERE doc_id % 3 > 0 UNION ALL SELECT doc_id, '{\"name\": \"g\"}' FROM documents WHERE doc_id % 3 = 2")
def json_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quote before an object hides it up to the next quote; without a name it is none."""
    text = F.concat(F.when(F.col("doc_id") % 3 == 0, 'say " ').otherwise(""), F.lit('x {"name": "f", "p": {"q": "}"}} {"other": 2} {"name": ""} '), F.when(F.col("doc_id") % 3 == 2, '{"name": "g"}').when(F.col("doc_id") % 3 == 1, '} {"name": "g"}').otherwise(""))
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(T.json_objects(text)).alias("object"))
