"""Whole converters: rows of one published format to canonical records.

Each is one projection (and at most one filter) without a shuffle.  ``row`` names the
column that numbers the rows; ids and metadata come from it.  Texts that are missing count as empty.

JSON texts in records are written without blanks; values of calls that aren't texts keep
their JSON form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from quarry.functions import text as T
from quarry.model import FUNCTION, MESSAGE, PART, empty_map, message, part, strip, system
from quarry.operators import convert

BREAK, CUT = "\u0001", "\u0002"


def text_map(**values: Column) -> Column:
    """A map of texts; what is null is left out."""
    cells = F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[v.cast("string") for v in values.values()]))
    return F.map_filter(cells, lambda _, v: v.isNotNull()) if values else empty_map()


def asked(content: Column, role: Column | str = "user", metadata: Column | None = None) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), content.alias("content"), (empty_map() if metadata is None else metadata).alias("metadata"))


def canonical(df: DataFrame, source: str | Column, *, key: Column, initial: Column, messages: Column | None = None, branches: Column | None = None, metadata: Column | None = None, system_text: Column | str = "", functions: Column | None = None, keep: list[str] = ()) -> DataFrame:
    """The record's columns, all members present, and the columns ``keep``."""
    return df.select(
        key.alias("conversation_id"),
        (F.lit(source) if isinstance(source, str) else source).alias("dataset_source"),
        (empty_map() if metadata is None else metadata).alias("original_metadata"),
        system(F.lit(system_text) if isinstance(system_text, str) else system_text).alias("system_prompt"),
        initial.alias("initial_prompt"),
        (F.array() if functions is None else functions).cast(f"array<{FUNCTION}>").alias("available_functions"),
        (F.array(F.struct(messages.alias("messages"))) if branches is None else branches).alias("conversation_branches"),
        *keep,
    )


def numbered_id(source: str, *seed: Column) -> Column:
    return F.concat(F.lit(f"{source}_"), T.short_id(*[s.cast("string") for s in seed]))


def _blank(column: Column | str) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


# ---- questions and answers --------------------------------------------------

MATH = "numina-math-1.5"


def mathematics(df: DataFrame, *, row: str = "row_index", varied: bool = False, keep: list[str] = ()) -> DataFrame:
    """problem, solution, answer, problem_type, question_type, source: the solution is the thought before
    the answer, a proof's is the answer; ``varied`` states the answer in one of many ways and adds it as
    a verifiable part.  Rows with links, without an answer or without text left are dropped."""
    rows = df.where(convert.math_keep(_blank("problem"), _blank("solution"), _blank("answer")))
    problem, solution, answer = convert.math_prompt(_blank("problem")), convert.math_solution(_blank("solution")), T.squeeze_blanks(_blank("answer"))
    proof = F.lower(answer) == "proof"
    parts = convert.math_parts(_blank("solution"), answer, F.col(row) if varied else None)
    known = {c: F.col(c) for c in ("problem_type", "question_type", "source", "synthetic", "problem_is_valid", "solution_is_valid") if c in df.columns}
    checkable = F.when(~proof, answer)
    own = {c: v for c, v in known.items() if c not in ("problem_is_valid", "solution_is_valid")}
    return canonical(
        rows, MATH, key=numbered_id(MATH, problem, F.col(row)), initial=asked(problem, metadata=text_map(answer=answer, verifiable_answer=checkable, **own)), messages=F.array(message("assistant", parts)),
        metadata=text_map(row_index=F.col(row), answer=F.col("answer"), verifiable_answer=checkable, **known), keep=keep,
    )


def charter(df: DataFrame, *, row: str = "row_index", keep: list[str] = ()) -> DataFrame:
    """question, response"""
    question, answer = T.squeeze_lines(_blank("question")), T.squeeze_lines(_blank("response"))
    return canonical(df, "charter-qa", key=numbered_id("charter-qa", F.concat_ws("_", question, F.col(row).cast("string"))), initial=asked(question), messages=F.array(convert.say("assistant", answer)), metadata=text_map(row_index=F.col(row)), keep=keep)


def translations(df: DataFrame, *, row: str = "row_index", source: str = "romansh-sft", keep: list[str] = ()) -> DataFrame:
    """input, output: a translation, its languages found in the input's words"""
    question, answer = T.squeeze_lines(_blank("input")), T.squeeze_lines(_blank("output"))
    way = convert.translation_direction(question)
    told = text_map(source_lang=way["source_lang"], target_lang=way["target_lang"], task_type=F.lit("translation"))
    said = message("assistant", F.array(part("response", answer, metadata=text_map(language=way["target_lang"]))))
    key = numbered_id(source, F.concat_ws("_", question, F.col(row).cast("string")))
    return canonical(df, source, key=key, initial=asked(question, metadata=told), messages=F.array(said), metadata=F.map_concat(told, text_map(row_index=F.col(row))), keep=keep)


def dialects(df: DataFrame, *, row: str = "row_index", source: str = "swiss-german-dialects", keep: list[str] = ()) -> DataFrame:
    """instruction, output, dialect, source"""
    question, answer = T.squeeze_lines(_blank("instruction")), T.squeeze_lines(_blank("output"))
    spoken = {"dialect": _blank("dialect"), "dialect_name": convert.dialect_name(_blank("dialect"))}
    said = message("assistant", F.array(part("response", answer, metadata=text_map(**spoken))))
    key = numbered_id(source, F.concat_ws("_", question, F.col(row).cast("string")))
    return canonical(df, source, key=key, initial=asked(question, metadata=text_map(source=_blank("source"), **spoken)), messages=F.array(said), metadata=text_map(row_index=F.col(row), source=_blank("source"), **spoken), keep=keep)


# ---- records of an older shape ----------------------------------------------


def _field(at: Column, kind: StructType, name: str, default: Column) -> Column:
    return F.coalesce(at[name], default) if name in kind.fieldNames() else default


def _metadata(at: Column, kind: StructType, name: str = "metadata") -> Column:
    """A member as a map of texts; a struct's members by name."""
    if name not in kind.fieldNames():
        return empty_map()
    inner = kind[name].dataType
    if isinstance(inner, StructType):
        return text_map(**{f.name: (F.to_json(at[name][f.name]) if isinstance(f.dataType, (StructType, ArrayType)) else at[name][f.name]) for f in inner.fields})
    return F.coalesce(at[name].cast("map<string,string>"), empty_map())


def _old_prompt(df: DataFrame) -> Column:
    kind = df.schema["initial_prompt"].dataType
    at, none = F.col("initial_prompt"), F.lit("")
    return F.when(at.isNull(), asked(none)).otherwise(asked(_field(at, kind, "content", none), _field(at, kind, "role", F.lit("user")), _metadata(at, kind)))


def _old_branches(df: DataFrame, parts_of: object) -> Column:
    kind = df.schema["conversation_branches"].dataType.elementType["messages"].dataType.elementType
    said = lambda m: message(_field(m, kind, "role", F.lit("assistant")), parts_of(m, kind))
    whole = F.filter("conversation_branches", lambda b: b.isNotNull() & b["messages"].isNotNull())
    made = F.transform(whole, lambda b: F.struct(F.transform(F.filter(b["messages"], lambda m: m.isNotNull()), said).alias("messages")))
    return F.coalesce(made, F.array().cast(f"array<struct<messages:array<{MESSAGE}>>>"))


def one_response(m: Column, kind: StructType) -> Column:
    return F.array(part("response", _field(m, kind, "content", F.lit("")), metadata=_metadata(m, kind)))


def wiki_questions(df: DataFrame, source: str = "wikiqa", *, row: str = "row_index", keep: list[str] = ()) -> DataFrame:
    """Records whose messages have a content: they get parts; columns of their own become metadata."""
    known = {"conversation_id", "dataset_source", "initial_prompt", "conversation_branches", "created_timestamp", row, *keep}
    own = text_map(**{f.name: (F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, (StructType, ArrayType)) else F.col(f"`{f.name}`")) for f in df.schema.fields if f.name not in known})
    default = lambda name, other: F.coalesce(F.col(name), other) if name in df.columns else other
    key = default("conversation_id", F.concat(F.lit("wikiqa_"), F.col(row).cast("string")))
    return canonical(df, default("dataset_source", F.lit(source)), key=key, initial=_old_prompt(df), branches=_old_branches(df, one_response), metadata=own, keep=keep)


def reasoning(df: DataFrame, source: str = "s1k_42_langs", *, keep: list[str] = ()) -> DataFrame:
    """Records with some members missing: thoughts lose their tags, messages without parts get one."""

    def parts_of(m: Column, kind: StructType) -> Column:
        none = F.array().cast(f"array<{PART}>")
        plain = F.when(m["content"].isNotNull(), one_response(m, kind)).otherwise(none) if "content" in kind.fieldNames() else none
        if "parts" not in kind.fieldNames():
            return plain
        inner = kind["parts"].dataType.elementType
        get = lambda p, n, d="": _field(p, inner, n, F.lit(d))

        def full(p: Column) -> Column:
            what = get(p, "type", "response")
            told = F.when(what == "thought", convert.edge_thoughts(get(p, "content"))).otherwise(get(p, "content"))
            answers = F.when(what == "verifiable-responses", p["answers"]) if "answers" in inner.fieldNames() else None
            return part(what, told, name=get(p, "name"), args=get(p, "args"), answers=answers, metadata=_metadata(p, inner))

        return F.when(m["parts"].isNotNull(), F.transform(m["parts"], full)).otherwise(plain)

    default = lambda name, other: F.coalesce(F.col(name), other) if name in df.columns else other
    spoken = _blank(F.col("system_prompt")["content"]) if "system_prompt" in df.columns else ""
    given = _metadata(F.struct(*df.columns), df.schema, "original_metadata")
    return canonical(df, default("dataset_source", F.lit(source)), key=default("conversation_id", F.lit("")), initial=_old_prompt(df), branches=_old_branches(df, parts_of), metadata=given, system_text=spoken, functions=F.col("available_functions") if "available_functions" in df.columns else None, keep=keep)


# Fixed value: how a page that isn't a question begins.
TEMPLATE_PAGE = "<style>.atomic-structure-template-field-8x8"


def swapped_literals(df: DataFrame, source: str, *, row: str = "row_index", keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(records, rejected rows) of conversation_branches written as a Python literal with the roles exchanged.

    The assistant's first message is the question.  A last message without an answer is dropped.
    Questions about one assistant, and pages of one template, are skipped and count in neither table.
    """
    shape = "array<struct<messages:array<struct<role:string,content:string>>>>"
    read = df.withColumn("_m", F.try_element_at(F.from_json(T.python_literal("conversation_branches"), shape), F.lit(1))["messages"])
    at = lambda k: F.try_element_at("_m", F.lit(k))
    sound = F.coalesce((F.size("_m") >= 2) & (at(1)["role"] == "assistant") & (at(2)["role"] == "user"), F.lit(False))
    question = _blank(at(1)["content"])
    wanted = ~F.lower(question).contains("chatgpt") & ~strip(question).startswith(TEMPLATE_PAGE)
    whole = F.slice("_m", F.lit(2), F.greatest(F.size("_m") - F.size("_m") % 2 - 1, F.lit(0)))
    said = F.transform(whole, lambda m, i: convert.say(F.when(i % 2 == 0, "assistant").otherwise("user"), m["content"]))
    told = F.from_json(T.python_literal("original_metadata"), "map<string,string>")
    told = F.when(told.isNotNull(), told).otherwise(text_map(raw_metadata=F.col("original_metadata")))
    own = F.map_concat(F.map_filter(told, lambda k, _: k != "original_dataset_source"), text_map(original_dataset_source=_blank("dataset_source")))
    key = T.conversation_id(F.lit(source), question, F.concat(F.lit("row_"), F.col(row).cast("string")))
    good = canonical(read.where(sound & wanted), source, key=key, initial=asked(question), messages=said, metadata=own, keep=keep)
    return good, read.where(~sound).drop("_m")


# ---- function calling -------------------------------------------------------


def function_table(found: Column) -> Column:
    """Functions of an array of JSON objects: with a name, texts for all members, a whole schema."""

    def one(text: Column) -> Column:
        v = F.try_parse_json(text)
        params = F.try_variant_get(v, "$.parameters", "variant")
        shape = F.schema_of_variant(params)
        bare = F.when(params.isNull() | F.is_variant_null(params), F.lit("{}")).otherwise(F.to_json(params))
        wrapped = F.concat(F.lit('{"type":"object","properties":'), bare, F.lit(',"required":[]}'))
        whole = F.try_variant_get(params, "$.type", "variant").isNotNull()
        schema = F.when(params.isNull() | (shape.startswith("OBJECT") & ~whole), wrapped).when(F.is_variant_null(params), F.lit("{}")).when(shape == "STRING", F.try_variant_get(params, "$", "string")).otherwise(bare)
        return F.struct(_blank(F.try_variant_get(v, "$.name", "string")).alias("name"), _blank(F.try_variant_get(v, "$.description", "string")).alias("description"), schema.alias("parameters"))

    return F.filter(F.transform(found, one), lambda f: f["name"] != "")


def arguments(value: Column) -> Column:
    """Arguments of a call as JSON, empty where there are none."""
    text = F.to_json(value)
    return F.when(value.isNull() | F.is_variant_null(value) | text.isin("{}", "[]", '""', "0", "false"), F.lit("")).otherwise(text)


def json_call(text: Column) -> Column:
    """A function-call part of a JSON object, null if it can't be read."""
    v = F.try_parse_json(text)
    return F.when(v.isNotNull(), part("function-call", name=_blank(F.try_variant_get(v, "$.name", "string")), args=arguments(F.try_variant_get(v, "$.arguments", "variant"))))


# Fixed value: what ends a line.
LINE = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"


def tagged_lines(df: DataFrame, *, text: str = "sample", row: str = "row_index", source: str = "glaive-function-calling", keep: list[str] = ()) -> DataFrame:
    """One text with lines SYSTEM:, USER:, ASSISTANT: and FUNCTION RESPONSE:, functions after the system line.

    Lines without a tag go on with the message before; a call stands in an assistant's line after
    <functioncall>.  The first message of the user is the prompt.
    """
    lines = F.split(F.regexp_replace(_blank(text), f"(?:{LINE})$", ""), LINE)
    rows = df.withColumn("_l", lines).withColumn("_sys", F.col("_l")[0].rlike("(?i)^SYSTEM:"))
    user = F.array_position(F.transform("_l", lambda x: x.rlike("(?i)^USER:")), True).cast("int")
    rows = rows.withColumn("_from", F.when(F.col("_sys"), F.when(user > 0, user).otherwise(F.size("_l") + 1)).otherwise(1))
    marked = F.transform(F.slice("_l", F.col("_from"), F.size("_l")), lambda x: F.when(x.rlike("(?i)^(?:USER|ASSISTANT|FUNCTION RESPONSE):"), F.concat(F.lit(BREAK), x)).otherwise(x))
    pieces = F.filter(F.split(F.array_join(marked, "\n"), BREAK), lambda x: x.rlike("(?i)^(?:USER|ASSISTANT|FUNCTION RESPONSE):"))
    joined = lambda first, more: F.aggregate(more, first, lambda c, x: F.concat(c, F.when(c != "", "\n").otherwise(""), strip(x)))

    def spoken(piece: Column) -> Column:
        own = F.split(piece, "\n")
        body, more = strip(F.regexp_replace(own[0], "(?i)^(?:USER|ASSISTANT|FUNCTION RESPONSE):", "")), F.slice(own, F.lit(2), F.greatest(F.size(own) - 2, F.lit(0)))
        # A line end before the next tag belongs to the mark, so the last item is empty but for the last piece.
        rest = F.slice(own, F.lit(2), F.size(own))
        more = F.when(piece.endswith("\n"), more).otherwise(rest)
        call = F.when(body.rlike(r"(?i)^<functioncall>\s*\{.*\}"), json_call(F.regexp_extract(body, r"(?i)^<functioncall>\s*(\{.*\})", 1)))
        plain = lambda kind: F.array(part(kind, joined(body, more)))
        called = message("FUNCTION-CALL", F.array(call.withField("content", joined(F.lit(""), more))))
        return (
            F.when(piece.rlike("(?i)^USER:"), message("user", plain("response")))
            .when(piece.rlike("(?i)^FUNCTION"), message("FUNCTION-RESPONSE", plain("function-output")))
            .when(call.isNotNull(), called)
            .otherwise(message("assistant", plain("response")))
        )

    rows = rows.withColumn("_m", F.transform(pieces, spoken))
    first = F.array_position(F.transform("_m", lambda m: m["role"]), "user").cast("int")
    question = _blank(F.when(first > 0, F.try_element_at("_m", F.when(first > 0, first).otherwise(1))["parts"][0]["content"]))
    head = F.array_join(F.slice("_l", F.lit(2), F.greatest(F.col("_from") - 2, F.lit(0))), "\n")
    rows = rows.withColumn("_f", T.json_objects(F.when(F.col("_sys"), head).otherwise("")))
    told = F.when(F.col("_sys"), strip(F.regexp_replace(F.col("_l")[0], "(?i)^SYSTEM:", ""))).otherwise("")
    rest = F.filter("_m", lambda m, i: i + 1 != first)
    return canonical(rows, source, key=numbered_id(source, question, F.col(row)), initial=asked(question), messages=rest, metadata=text_map(original_id=F.col(row)), system_text=told, functions=function_table(F.col("_f")), keep=keep)


def tagged_blocks(df: DataFrame, *, row: str = "row_index", source: str = "glaive-function-calling-v2", tenths: int = 2, keep: list[str] = ()) -> DataFrame:
    """system and chat, the chat in blocks between empty lines: what follows a user's block is one assistant message.

    A block of the assistant's over several lines isn't read.  ``tenths`` in ten rows keep
    their system text, by a hash of the row's number.  Rows with a call that can't be read go.
    """
    blocks = F.transform(F.split(_blank("chat"), "\n\n"), lambda b: strip(b))
    marked = F.transform(blocks, lambda b: F.when(b.rlike("(?i)^USER:"), F.concat(F.lit(BREAK), b)).otherwise(b))
    turns = F.slice(F.split(F.array_join(marked, CUT), BREAK), 2, 1 << 30)

    def quoted_call(body: Column) -> Column:
        """A part, its arguments between single quotes; its name is null if the call can't be read."""
        said = F.regexp_extract(body, r"(?i)<functioncall>\s*(.*)", 1)
        name = F.when(said.contains('"name": "'), F.substring_index(F.regexp_extract(said, r'^.*?"name": "(.*)$', 1), '"', 1))
        inside = F.regexp_extract(said, r"""^.*?"arguments": '(.*)$""", 1)
        v = F.try_parse_json(F.replace(F.substring_index(inside, "'}", 1), F.lit("\\"), F.lit("")))
        args = F.when(~said.contains("'"), F.lit("")).when(said.contains("\"arguments\": '") & v.isNotNull(), arguments(v))
        whole = part("function-call", name=name, args=args)
        return F.when(said == "", part("response", body)).when(name.isNull() | args.isNull(), whole.withField("name", F.lit(None).cast("string"))).otherwise(whole)

    def said(block: Column) -> Column:
        answer = r"(?i)^ASSISTANT:\s*(.*?)(?:\s*<\|endoftext\|>)?$"
        body = strip(F.regexp_extract(block, answer, 1))
        output = strip(F.regexp_extract(block, r"(?i)^FUNCTION RESPONSE:\s*(.*)", 1))
        own = F.when(body.contains("<functioncall>"), quoted_call(body)).otherwise(part("response", body))
        return F.when(block.rlike(answer), own).when(block.rlike("(?i)^FUNCTION RESPONSE:"), part("function-output", output))

    def turn(text: Column) -> Column:
        own = F.transform(F.split(text, CUT), lambda b: strip(b))
        asks = message("user", F.array(part("response", strip(F.regexp_replace(own[0], "(?i)^USER:", "")))))
        parts = F.filter(F.transform(F.slice(own, F.lit(2), F.size(own)), said), lambda p: p.isNotNull())
        return F.when(F.size(parts) > 0, F.array(asks, message("assistant", parts))).otherwise(F.array(asks))

    rows = df.withColumn("_m", F.flatten(F.transform(turns, turn)))
    rows = rows.where(F.forall("_m", lambda m: F.forall(m["parts"], lambda p: p["name"].isNotNull())))
    lines = F.split(_blank("system"), LINE)
    spoken = F.when(lines[0].rlike("(?i)^SYSTEM:"), F.replace(strip(F.regexp_replace(lines[0], "(?i)^SYSTEM:", "")), F.lit(" -"), F.lit("."))).otherwise("")
    stop = F.array_position(F.transform(lines, lambda x: x.rlike("(?i)^USER:")), True).cast("int")
    head = F.when(lines[0].rlike("(?i)^SYSTEM:"), F.array_join(F.slice(lines, F.lit(2), F.when(stop > 0, F.greatest(stop - 2, F.lit(0))).otherwise(F.size(lines))), "\n")).otherwise("")
    rows = rows.withColumn("_f", T.json_objects(head))
    told = F.when(convert.keep_system(F.col(row), tenths), spoken).otherwise("")
    question = _blank(F.try_element_at("_m", F.lit(1))["parts"][0]["content"])
    return canonical(rows, source, key=numbered_id(source, question, F.col(row)), initial=asked(question), messages=F.slice("_m", 2, 1 << 30), metadata=text_map(original_id=F.col(row)), system_text=told, functions=function_table(F.col("_f")), keep=keep)


def tool_conversations(df: DataFrame, *, row: str = "row_index", source: str = "apigen-mt-5k", keep: list[str] = ()) -> DataFrame:
    """conversations (from, value), tools, system: neighbours that aren't human are one assistant message.

    The first message of the user is the prompt and stays in the branch.  Turns of unknown kinds and unreadable calls are left
    out; rows without a message go.
    """
    known = F.filter("conversations", lambda x: x["from"].isin("human", "gpt", "function_call", "observation"))
    groups = convert.turn_fold(known)
    made = F.transform(groups, lambda g: message(g["role"], convert.turn_parts(g["items"])))
    rows = df.withColumn("_m", F.filter(made, lambda m: F.size(m["parts"]) > 0)).where(F.size("_m") > 0)
    human = _blank(F.try_element_at(F.filter("conversations", lambda x: x["from"] == "human"), F.lit(1))["value"])
    first = F.when(F.col("_m")[0]["role"] == "user", F.col("_m")[0]["parts"][0]["content"]).otherwise("")
    functions = function_table(F.coalesce(F.transform(F.try_variant_get(F.try_parse_json(_blank("tools")), "$", "array<variant>"), lambda v: F.to_json(v)), F.array().cast("array<string>")))
    whole = F.transform(functions, lambda f: f.withField("name", strip(f["name"])))
    key = F.concat(F.lit(source.replace("-", "_") + "_"), T.short_id(human))
    return canonical(rows, source, key=key, initial=asked(first), messages=F.col("_m"), metadata=text_map(original_id=F.col(row)), system_text=_blank("system"), functions=F.filter(whole, lambda f: f["name"] != ""), keep=keep)


# Fixed value: what the assistant of a query with tools is told.
TOOL_SYSTEM = "You are a helpful assistant with access to tools. Use them to answer the user's questions effectively."


def tool_queries(df: DataFrame, *, row: str = "row_index", source: str = "xlam-function-calling-60k", keep: list[str] = ()) -> DataFrame:
    """query, tools and answers (JSON texts): one assistant message of calls; texts that can't be read are empty lists."""
    question = _blank("query")
    tools = F.from_json("tools", "array<struct<name:string,description:string,parameters:map<string,struct<type:string,description:string,default:string>>>>")
    calls = F.from_json("answers", "array<struct<name:string,arguments:map<string,string>>>")
    named = lambda xs: F.filter(F.coalesce(xs, F.array()), lambda x: strip(_blank(x["name"])) != "")
    functions = F.transform(named(tools), lambda t: F.struct(strip(t["name"]).alias("name"), _blank(t["description"]).alias("description"), convert.xlam_parameters(F.coalesce(t["parameters"], F.create_map().cast("map<string,struct<type:string,description:string,default:string>>"))).alias("parameters")))
    given = lambda c: F.map_filter(F.coalesce(c["arguments"], empty_map()), lambda _, v: v.isNotNull() & (v != ""))
    parts = F.transform(named(calls), lambda c: part("function-call", name=strip(c["name"]), args=F.when(F.size(given(c)) > 0, F.to_json(given(c))).otherwise("")))
    known = F.coalesce(F.col("id").cast("string"), F.col(row).cast("string")) if "id" in df.columns else F.col(row)
    key = F.concat(F.lit(source.replace("-", "_") + "_"), T.short_id(question))
    return canonical(df, source, key=key, initial=asked(question), messages=F.array(message("assistant", parts)), metadata=text_map(original_id=known), system_text=TOOL_SYSTEM, functions=functions, keep=keep)
