"""Source formats to canonical conversations: each a projection, rejected rows aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.model import empty_map, message, part, prompt, strip, system, title

ID_COLUMNS = ("id", "sample_id", "conversation_id", "idx", "index")


def sample_id(df: DataFrame, row_number: Column | None = None) -> Column:
    """The first id column that isn't null, else ``row_<n>`` of an explicit number."""
    found = [F.col(c).cast("string") for c in ID_COLUMNS if c in df.columns]
    if row_number is not None:
        found.append(F.concat(F.lit("row_"), row_number.cast("string")))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def gather_turns(turns: DataFrame, *, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, messages) from one row per turn."""
    rows = turns.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("n"), F.col(role_col).alias("role"), F.col(text_col).alias("content")))).alias("m"))
    return rows.select(id_col, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def record(source: str | Column, content: Column, *, key: Column | None, system_prompt: Column, initial: Column, branches: Column, metadata: Column | None = None) -> list[Column]:
    src = F.lit(source) if isinstance(source, str) else source
    return [
        T.conversation_id(src, content, key).alias("conversation_id"),
        src.alias("dataset_source"),
        (empty_map() if metadata is None else metadata).alias("original_metadata"),
        system_prompt.alias("system_prompt"),
        initial.alias("initial_prompt"),
        F.array().cast("array<struct<name:string,description:string,parameters:string>>").alias("available_functions"),
        branches.alias("conversation_branches"),
    ]


def one_branch(messages: Column) -> Column:
    return F.array(F.struct(messages.alias("messages")))


def say(role: Column | str, content: Column) -> Column:
    return message(role, F.array(part("response", content)))


def chat(df: DataFrame, source: str, *, messages: str = "messages", key: Column | None = None) -> DataFrame:
    """Chat messages: the first system and the first user message become the prompts,
    the rest the only branch; blank roles are skipped, rows without a user message go."""
    m = F.filter(F.transform(messages, lambda x: F.struct(F.trim(x["role"]).alias("role"), x["content"].alias("content"))), lambda x: F.coalesce(x["role"], F.lit("")) != "")
    rows = df.withColumn("_m", m)
    roles = F.transform("_m", lambda x: x["role"])
    first_system, first_user = F.array_position(roles, "system"), F.array_position(roles, "user")
    at = lambda n: F.try_element_at("_m", n.cast("int"))
    rows = rows.withColumn("_s", F.when(first_system > 0, first_system)).withColumn("_u", F.when(first_user > 0, first_user)).where(F.col("_u").isNotNull())
    rest = F.filter("_m", lambda x, i: (i + 1 != F.coalesce("_s", F.lit(0))) & (i + 1 != F.col("_u")))
    content = at(F.col("_u"))["content"]
    system_prompt = F.when(F.col("_s").isNotNull(), system(at(F.col("_s"))["content"]))
    return rows.select(*record(source, content, key=key, system_prompt=system_prompt, initial=prompt(content), branches=one_branch(F.transform(rest, lambda x: say(x["role"], x["content"])))))


def sharegpt(df: DataFrame, source: str, *, turns: str = "conversations", key: Column | None = None) -> DataFrame:
    """Turns (from, value): human is the user, gpt the assistant; then as :func:`chat`."""
    role = lambda x: F.when(x["from"] == "human", "user").when(x["from"] == "gpt", "assistant").otherwise(x["from"])
    return chat(df.withColumn("messages", F.transform(turns, lambda x: F.struct(role(x).alias("role"), x["value"].alias("content")))), source, key=key)


def prompt_answers(df: DataFrame, source: str, question: Column, answers: list[Column], *, system_text: Column | None = None, key: Column | None = None) -> DataFrame:
    """A prompt and one branch for each answer, the preferred one first."""
    branches = F.array(*[F.struct(F.array(say("assistant", a)).alias("messages")) for a in answers])
    spoken = F.lit(None).cast("struct<content:string,metadata:map<string,string>>") if system_text is None else F.when(F.coalesce(system_text, F.lit("")) != "", system(system_text))
    return df.select(*record(source, question, key=key, system_prompt=spoken, initial=prompt(question), branches=branches))


def nemotron(df: DataFrame, source: str, key: Column | None = None) -> DataFrame:
    question = F.try_element_at("input", F.lit(1))["content"]
    return prompt_answers(df.where(question.isNotNull()), source, question, [F.col("output")], system_text=F.col("system_prompt") if "system_prompt" in df.columns else None, key=key)


def preference(df: DataFrame, source: str, key: Column | None = None) -> DataFrame:
    return prompt_answers(df, source, F.col("prompt"), [F.col("chosen"), F.col("rejected")], key=key)


def instruction(df: DataFrame, source: str, key: Column | None = None) -> DataFrame:
    question = F.concat_ws("\n\n", "instruction", F.nullif("input", F.lit(""))) if "input" in df.columns else F.col("instruction")
    return prompt_answers(df, source, question, [F.col("output")], key=key)


def pairs(df: DataFrame, source: str, question: str, answer: str, key: Column | None = None) -> DataFrame:
    """Two text columns, both required."""
    both = (F.coalesce(F.col(question), F.lit("")) != "") & (F.coalesce(F.col(answer), F.lit("")) != "")
    return prompt_answers(df.where(both), source, F.col(question), [F.col(answer)], key=key)


def prompts_only(df: DataFrame, source: str, *, chosen: str = "chosen", key: Column | None = None) -> DataFrame:
    """The first user message of the chosen conversation, without any branch."""
    first = F.try_element_at(F.filter(chosen, lambda x: x["role"] == "user"), F.lit(1))["content"]
    none = F.array().cast("array<struct<messages:array<struct<role:string,parts:array<struct<type:string,content:string,name:string,args:string,answers:array<string>,metadata:map<string,string>>>>>>>")
    return df.where(first.isNotNull()).select(*record(source, first, key=key, system_prompt=F.lit(None).cast("struct<content:string,metadata:map<string,string>>"), initial=prompt(first), branches=none))


def detect(df: DataFrame):
    """The converter for a schema, tried in a fixed order; None if none fits."""
    kinds = dict(df.dtypes)
    is_list = lambda c: kinds.get(c, "").startswith("array")
    if is_list("messages"):
        return chat
    if is_list("conversations"):
        return sharegpt
    if is_list("input") and "output" in kinds:
        return nemotron
    if {"prompt", "chosen", "rejected"} <= set(kinds):
        return preference
    if {"instruction", "output"} <= set(kinds):
        return instruction
    if {"inputs", "labels"} <= set(kinds):
        return lambda d, s, key=None: pairs(d, s, "inputs", "labels", key)
    if {"input", "output"} <= set(kinds):
        return lambda d, s, key=None: pairs(d, s, "input", "output", key)
    return None


def valid_turns(messages: Column) -> Column:
    """The assistant begins, then user and assistant alternate; nothing is valid too."""
    roles = F.transform(messages, lambda m: m["role"])
    later = F.slice(roles, 2, 1 << 30)
    turn = F.zip_with(later, F.slice(roles, 1, 1 << 30), lambda now, before: now.isNull() | (now.isin("user", "assistant") & (now != before)))
    return (F.size(roles) == 0) | (F.coalesce(F.try_element_at(roles, F.lit(1)) == "assistant", F.lit(False)) & F.forall(turn, lambda x: F.coalesce(x, F.lit(False))))


def valid_record() -> Column:
    return F.col("conversation_id").isNotNull() & F.forall("conversation_branches", lambda b: valid_turns(b["messages"]))


def convert(df: DataFrame, source: str, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejected records) of a table whose format is detected."""
    how = detect(df)
    if how is None:
        raise ValueError(f"no converter for columns {df.columns}")
    out = how(df, source, key=key).withColumn("_ok", valid_record())
    return out.where("_ok").drop("_ok"), out.where("NOT _ok").drop("_ok")


# ---- function calling -------------------------------------------------------


# The mark of an optional parameter; names of plain types, anything else is a string.
OPTIONAL = ", optional"
PLAIN_TYPES = {"integer": ("int", "integer"), "number": ("float", "number"), "boolean": ("bool", "boolean")}


def xlam_type(text: Column) -> Column:
    """JSON schema type of a Python-like type name; upper and lower case differ."""
    bare = strip(F.replace(F.coalesce(text, F.lit("str")), F.lit(OPTIONAL), F.lit("")))
    generic = F.when(bare.rlike(r"^[Ll]ist\["), "array").when(bare.rlike(r"^(?:[Dd]ict|Mapping)\["), "object")
    for kind, names in PLAIN_TYPES.items():
        generic = generic.when(bare.isin(*names), kind)
    return generic.otherwise("string")


def xlam_required(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("str")).contains(OPTIONAL)


def xlam_parameters(parameters: Column) -> Column:
    """JSON schema (as text) of a map name -> struct(type, description, default)."""
    props = F.transform_values(parameters, lambda _, v: F.struct(xlam_type(v["type"]).alias("type"), F.coalesce(v["description"], F.lit("")).alias("description"), F.nullif(v["default"].cast("string"), F.lit("")).alias("default")))
    needed = F.map_keys(F.map_filter(parameters, lambda _, v: xlam_required(v["type"])))
    return F.to_json(F.struct(F.lit("object").alias("type"), props.alias("properties"), needed.alias("required")))


def call_part(value: Column) -> Column:
    """A call's JSON as a part: ``think`` is a thought, unreadable JSON is null."""
    v = F.try_parse_json(value)
    name, given = F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$.arguments", "variant")
    # Arguments may be a text that holds JSON; anything but an object counts as none.
    read = F.coalesce(F.try_parse_json(F.try_variant_get(given, "$", "string")), given)
    read = F.when(F.schema_of_variant(read).startswith("OBJECT"), read)
    args = F.nullif(F.to_json(read), F.lit("{}"))
    thought = F.try_variant_get(read, "$.thought", "string")
    return F.when(name == "think", part("thought", F.coalesce(thought, F.lit("")))).when(F.coalesce(name, F.lit("")) != "", part("function-call", "", name=name, args=F.coalesce(args, F.lit(""))))


def turn_fold(turns: Column | str) -> Column:
    """Array of (role, items): neighbours that aren't human form one assistant turn.

    A turn begins at the first item, at a human one and after one; its items are a slice, so each is copied once.
    """
    turns = F.col(turns) if isinstance(turns, str) else turns
    n = F.size(turns)
    human = F.transform(turns, lambda x: F.coalesce(x["from"] == "human", F.lit(False)))
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | F.get(human, i) | F.get(human, i - 1))
    item = lambda x: F.struct(x["from"].alias("from"), x["value"].alias("value"))
    made = F.transform(starts, lambda s, k: F.struct(F.when(F.get(human, s), "user").otherwise("assistant").alias("role"), F.transform(F.slice(turns, s + 1, F.coalesce(F.get(starts, k + 1), n) - s), item).alias("items")))
    return F.when(turns.isNotNull(), made)


def grouped_turns(df: DataFrame, *, turns: str = "conversations", keys: list[str]) -> DataFrame:
    """(keys, turn, role, items): neighbours that aren't human form one assistant turn.

    Gaps and islands inside the row, as a fold over its array, so nothing is shuffled.
    """
    rows = df.withColumn("_t", turn_fold(turns))
    return rows.select(*keys, F.posexplode("_t").alias("turn", "_x")).select(*keys, "turn", "_x.role", "_x.items")


def turn_parts(items: Column) -> Column:
    """Parts of one turn: gpt answers, calls (or thoughts) and observations."""
    one = lambda x: F.when(x["from"] == "function_call", call_part(x["value"])).when(x["from"] == "observation", part("function-output", x["value"])).otherwise(part("response", x["value"]))
    return F.filter(F.transform(items, one), lambda p: p.isNotNull())


# ---- mathematics, translation, dialects -------------------------------------


# Beginnings that aren't part of a problem or a solution, taken off one after another.
PROBLEM_HEADS = (r"^#+\s*", r"(?i)^Problem\s+\d+\.?\s*", r"(?i)^NT\d+\s*", r"(?i)^G\d+\s*", r"(?i)^##\s*Problem\s+\d+\.?\s*", r"(?i)^#\s*Problem\s+\d+\.?\s*")
SOLUTION_HEADS = (r"^#+\s*", r"(?i)^Solution\s*\d*\.?\s*", r"(?i)^##\s*Solution\s*\d*\.?\s*", r"(?i)^#\s*Solution\s*\d*\.?\s*")
SHORT_LINE, HEADING = 20, r"^#+\s+[A-Za-z]+\s*$"


def _without(text: Column, heads: tuple[str, ...]) -> Column:
    """Squeezed text without the beginnings, and without a first line that is one short sentence."""
    bare = T.squeeze_blanks(text)
    for head in heads:
        bare = F.regexp_replace(bare, head, "")
    first = strip(F.substring_index(bare, "\n", 1))
    short = (F.length(first) < SHORT_LINE) & first.endswith(".")
    return F.when(short, F.when(bare.contains("\n"), F.substr(bare, F.instr(bare, "\n") + 1)).otherwise("")).otherwise(bare)


def math_prompt(text: Column) -> Column:
    return strip(_without(text, PROBLEM_HEADS))


def math_solution(text: Column) -> Column:
    """As a problem, and without lines that are headings of one word."""
    lines = F.filter(F.split(_without(text, SOLUTION_HEADS), "\n"), lambda x: ~strip(x).rlike(HEADING))
    return strip(F.array_join(lines, "\n"))


def math_keep(problem: Column, solution: Column, answer: Column) -> Column:
    """No link in either text, an answer that was found, text left after cleaning."""
    clean = (math_prompt(problem) != "") & (math_solution(solution) != "")
    found = F.lower(T.squeeze_blanks(F.coalesce(answer, F.lit("")))) != "notfound"
    return F.coalesce(~T.has_link(T.squeeze_blanks(problem)) & ~T.has_link(T.squeeze_blanks(solution)) & found & clean, F.lit(False))


def math_parts(solution: Column, answer: Column, key: Column | None = None) -> Column:
    """A proof's solution is the answer; else it is the thought before the answer.

    With a ``key`` the answer is stated in one of many ways and is also a part that can be checked.
    """
    clean = math_solution(solution)
    said = F.concat(F.lit("The answer is: "), answer) if key is None else stated_answer(answer, key)
    parts = F.array(part("thought", clean), part("response", said))
    if key is not None:
        parts = F.when(answer != "", F.concat(parts, F.array(part("verifiable-responses", answers=F.array(answer))))).otherwise(parts)
    return F.when(F.lower(answer) == "proof", F.array(part("response", clean))).otherwise(parts)


# Ways to state an answer, and what it may be called.
ANSWER_FORMS = (
    "The {label} is: {answer}", "{label}: {answer}", "{label} — {answer}", "{label} → {answer}", "{label} ⇒ {answer}", "{label} = {answer}",
    "I conclude the {label} is: {answer}", "By inspection, the {label} is: {answer}", "After analysis, the {label} is: {answer}",
    "This evaluates to: {answer}", "This resolves to: {answer}", "This computes to: {answer}", "Therefore: {answer}", "Thus: {answer}", "Hence: {answer}", "In one line: {answer}",
    "Plainly put, the {label} is: {answer}", "In summary, the {label} is: {answer}", "Strictly speaking, the {label} is: {answer}",
    "Calculated {label}: {answer}", "Computed {label}: {answer}", "Evaluated {label}: {answer}", "Derived {label}: {answer}", "Inferred {label}: {answer}", "Final {label}: {answer}",
    "The computed {label} is: {answer}", "The derived {label} is: {answer}", "The final {label} is: {answer}", "The resulting {label} is: {answer}",
    '"{answer}" — {label}', 'The {label} is: "{answer}"', "The {label} is: '{answer}'",
)
ANSWER_LABELS = ("Answer", "Solution", "Result", "Evaluation", "Conclusion", "Expression")
#: After these a label keeps its capital, elsewhere it loses it.
LABEL_MARKS = (":", " —", " →", " ⇒", " =")


def answer_forms() -> list[str]:
    """Every way with every label filled in, form by form."""
    capital = lambda form: any("{label}" + mark in form for mark in LABEL_MARKS)
    return [form.replace("{label}", label if capital(form) else label.lower()) for form in ANSWER_FORMS for label in ANSWER_LABELS]


def stated_answer(answer: Column, key: Column, seed: int = 0) -> Column:
    """One of the forms with one of the labels, chosen by a hash of the row's key so that it can be repeated."""
    forms = answer_forms()
    chosen = F.element_at(F.array(*map(F.lit, forms)), (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(len(forms))) + 1).cast("int"))
    return F.replace(chosen, F.lit("{answer}"), answer)


# What a tutor of mathematics is told.
TUTOR = "You are a helpful mathematics tutor. Solve the given mathematical problem step by step, showing your work clearly."
TUTOR_WORDS = " Read the problem carefully and identify the key information needed to solve it."
TUTOR_PROOF = " Provide a rigorous mathematical proof with clear logical steps."


def tutor_prompt(problem_type: Column, question_type: Column) -> Column:
    kind, asked = F.coalesce(problem_type, F.lit("")), F.lower(F.coalesce(question_type, F.lit("")))
    about = F.when(kind != "", F.concat(F.lit(" This is a "), F.lower(kind), F.lit(" problem."))).otherwise("")
    how = F.when(asked.contains("word-problem"), TUTOR_WORDS).when(asked.contains("proof"), TUTOR_PROOF).otherwise("")
    return F.concat(F.lit(TUTOR), about, how)


# Words that tell the direction of a translation, tried in this order; the languages' names.
GERMAN, ROMANSH = "German", "Romansh (Sursilvan)"
TO_WORDS = (
    (ROMANSH, ("ins sursilvan", "ins romansch", "ins rumantsch")), (GERMAN, ("ins deutsche", "auf deutsch")), (GERMAN, ("sursilvan-begriffe",)), (ROMANSH, ("deutscher begriffe",)),
)


def translation_direction(text: Column) -> Column:
    """(source_lang, target_lang) by the first of the words found; without any, into Romansh."""
    low, target = F.lower(text), None
    for language, words in TO_WORDS:
        hit = low.rlike("|".join(words))
        target = F.when(hit, language) if target is None else target.when(hit, language)
    target = target.otherwise(ROMANSH)
    return F.struct(F.when(target == GERMAN, ROMANSH).otherwise(GERMAN).alias("source_lang"), target.alias("target_lang"))


def translation_patterns(text: Column) -> list[Column]:
    """Over all rows: how many inputs name a direction, and which have the form of a list; aggregates."""
    low = F.lower(F.coalesce(text, F.lit("")))
    # Words of the directions; what a list has in it.
    ahead, back = low.rlike("ins sursilvan|ins romansch"), low.contains("ins deutsche")
    listed = low.rlike(r"[*]|-|[0-9]+\)|[a-z]\)")
    return [F.count_if(ahead).alias("german_to_romansh"), F.count_if(~ahead & back).alias("romansh_to_german"), F.count_if(listed).alias("list_translations"), F.count_if(~listed).alias("single_translations")]


def value_counts(df: DataFrame, **fields: Column) -> DataFrame:
    """(field, value, n): how often each value of each field occurs, in one pass; nulls are a value."""
    cells = F.array(*[F.struct(F.lit(k).alias("field"), v.cast("string").alias("value")) for k, v in fields.items()])
    return df.select(F.explode(cells).alias("c")).groupBy("c.field", "c.value").agg(F.count(F.lit(1)).alias("n"))


# Names of Swiss German dialects by code.
DIALECTS = {"ch_sg": "St. Gallen", "ch_be": "Bern", "ch_gr": "Graubünden", "ch_zh": "Zürich", "ch_vs": "Valais", "ch_bs": "Basel-Stadt", "ch_ag": "Aargau", "ch_lu": "Luzern"}


def dialect_name(code: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in DIALECTS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), code)


def swapped_roles(messages: Column) -> Column:
    """User and assistant exchanged."""
    other = lambda m: F.when(m["role"] == "user", "assistant").when(m["role"] == "assistant", "user").otherwise(m["role"])
    return F.transform(messages, lambda m: F.struct(other(m).alias("role"), m["content"].alias("content")))


def edge_thoughts(text: Column) -> Column:
    """Opening and closing think tags at the ends of a text removed."""
    return strip(F.regexp_replace(F.regexp_replace(text, r"(?i)^<think>\s*", ""), r"(?i)\s*</think>$", ""))


def tagged_turns(text: Column, tags: dict[str, str]) -> Column:
    """Turns of a text whose lines begin with tags like ``USER:``; lines without a tag
    continue the turn before.  ``tags`` maps a tag to its role."""
    names = "|".join(sorted(tags, key=len, reverse=True))
    marked = F.regexp_replace(F.concat(F.lit("\n"), text), rf"\n\s*({names}):[ \t]*", "\u0001$1\u0002")
    pieces = F.filter(F.split(marked, "\u0001"), lambda x: x.contains("\u0002"))
    roles = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])
    return F.transform(pieces, lambda x: F.struct(F.element_at(roles, F.substring_index(x, "\u0002", 1)).alias("from"), strip(F.substring_index(x, "\u0002", -1)).alias("value")))


def keep_system(key: Column, tenths: int = 2) -> Column:
    """True for ``tenths`` in ten rows, by a hash of the key instead of a coin."""
    return F.pmod(F.xxhash64(key), F.lit(10)) < tenths


def answered_context(turns: DataFrame, *, id_col: str, order_col: str, role_col: str, text_col: str) -> DataFrame:
    """Each assistant turn with the user message before it."""
    w = Window.partitionBy(id_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    said = F.last(F.when(F.col(role_col) == "user", F.col(text_col)), ignorenulls=True).over(w)
    return turns.withColumn("question", said).where(F.col(role_col) == "assistant")


__all__ = ["chat", "convert", "detect", "gather_turns", "grouped_turns", "title", "valid_turns"]
