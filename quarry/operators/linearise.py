"""Records to the training layout: a list of messages with blocks."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import lazy_udf

# The tool through which verifiable answers are given.
ANSWERS_TOOL = {
    "name": "display_answers",
    "description": "Display the answers to the user",
    "parameters": {"type": "object", "properties": {"answers": {"type": "array", "items": {"type": "string"}, "description": "The answers to the user"}}, "required": ["answers"]},
}
ANSWERS_OUTPUT = ""

CALL, OUTPUT = "struct<name:string,arguments:string>", "struct<name:string,output:string>"
BLOCK = f"struct<type:string,text:string,calls:array<{CALL}>,outputs:array<{OUTPUT}>>"


def _none(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def block(kind: str, text: Column | None = None, calls: Column | None = None, outputs: Column | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("type"), (F.lit("") if text is None else text).alias("text"),
        (_none(CALL) if calls is None else calls).alias("calls"), (_none(OUTPUT) if outputs is None else outputs).alias("outputs"),
    ).cast(BLOCK)


def assistant_blocks(parts: Column, keep_parallel: bool = False) -> Column:
    """Blocks of an assistant message: a fold over its parts.

    Calls wait for an output, outputs for the next part that isn't one.  Text while calls
    wait, or an output that no call waits for, ends the message there;
    ``keep_parallel`` takes further outputs of the same calls instead.
    """
    state = F.struct(_none(BLOCK).alias("blocks"), _none(CALL).alias("calls"), _none(OUTPUT).alias("outputs"), F.lit(False).alias("stop"), F.lit(False).alias("thinking"))

    def put(s: Column, *, blocks=None, calls=None, outputs=None, stop=None, thinking=None) -> Column:
        pick = lambda new, name: (s[name] if new is None else new).alias(name)
        return F.struct(pick(blocks, "blocks"), pick(calls, "calls"), pick(outputs, "outputs"), pick(stop, "stop"), pick(thinking, "thinking"))

    def step(s: Column, p: Column) -> Column:
        kind = p["type"]
        flushed = F.concat(s["blocks"], F.when(F.size(s["outputs"]) > 0, F.array(block("tool_outputs", outputs=s["outputs"]))).otherwise(_none(BLOCK)))
        waiting = F.size(s["calls"]) > 0
        thinks = s["thinking"] | (kind == "thought")
        show = F.array(
            block("tool_calls", calls=F.array(F.struct(F.lit(ANSWERS_TOOL["name"]).alias("name"), F.to_json(F.struct(p["answers"].alias("answers"))).alias("arguments")))),
            block("tool_outputs", outputs=F.array(F.struct(F.lit(ANSWERS_TOOL["name"]).alias("name"), F.lit(ANSWERS_OUTPUT).alias("output")))),
        )
        said = F.when(kind == "verifiable-responses", show).when(kind == "thought", F.array(block("thoughts", p["content"]))).otherwise(F.array(block("response", p["content"])))
        text = F.when(waiting, put(s, stop=F.lit(True), thinking=thinks)).otherwise(put(s, blocks=F.concat(flushed, said), outputs=_none(OUTPUT), thinking=thinks))
        call = put(s, blocks=flushed, outputs=_none(OUTPUT), calls=F.concat(s["calls"], F.array(F.struct(p["name"].alias("name"), F.coalesce(p["args"], F.lit("")).alias("arguments")))))
        got = F.array(F.struct(F.lit("").alias("name"), p["content"].alias("output")))
        more = F.size(s["outputs"]) > 0 if keep_parallel else F.lit(False)
        output = (
            F.when(p["content"].isNull(), s)
            .when(waiting, put(s, blocks=F.concat(s["blocks"], F.array(block("tool_calls", calls=s["calls"]))), calls=_none(CALL), outputs=F.concat(s["outputs"], got)))
            .when(more, put(s, outputs=F.concat(s["outputs"], got)))
            .otherwise(put(s, stop=F.lit(True)))
        )
        after = F.when(kind.isin("thought", "response", "verifiable-responses"), text).when(kind == "function-call", call).when(kind == "function-output", output).otherwise(s)
        return F.when(s["stop"], s).otherwise(after)

    def finish(s: Column) -> Column:
        calls = F.when(F.size(s["calls"]) > 0, F.array(block("tool_calls", calls=s["calls"]))).otherwise(_none(BLOCK))
        outputs = F.when(F.size(s["outputs"]) > 0, F.array(block("tool_outputs", outputs=s["outputs"]))).otherwise(_none(BLOCK))
        return F.struct(F.concat(s["blocks"], calls, outputs).alias("blocks"), s["thinking"].alias("thinking"))

    return F.aggregate(parts, state, step, finish)


def listed_required(schema):
    """A JSON schema whose ``required: true`` lists all properties, at every depth."""
    if not isinstance(schema, dict):
        return schema
    out = {k: v if k == "properties" else listed_required(v) for k, v in schema.items()}
    props = out.get("properties")
    if isinstance(props, dict):
        out["properties"] = {k: listed_required(v) for k, v in props.items()} if out.get("type") == "object" else props
    if out.get("type") == "object" and isinstance(out.get("required"), bool):
        out["required"] = list(props) if isinstance(props, dict) else []
    return out


def type_script(schema: dict, indent: str = "") -> str:
    """A schema as a TypeScript type."""
    kind = schema.get("type")
    if "enum" in schema:
        return " | ".join(json.dumps(x) for x in schema["enum"])
    if kind == "array":
        return f"{type_script(schema.get('items') or {}, indent)}[]"
    if kind == "object" and schema.get("properties"):
        needed, lines = schema.get("required") or [], []
        for name, inner in schema["properties"].items():
            inner = inner if isinstance(inner, dict) else {}
            if inner.get("description"):
                lines.append(f"{indent}  // {inner['description']}")
            lines.append(f"{indent}  {name}{'' if name in needed else '?'}: {type_script(inner, indent + '  ')},")
        return "{\n" + "\n".join(lines) + f"\n{indent}}}"
    return {"string": "string", "integer": "number", "number": "number", "boolean": "boolean", "null": "null", "object": "object"}.get(kind, "any")


def render_tools(tools: list[dict]) -> str:
    """Tools as TypeScript functions, one below the other."""
    out = []
    for t in tools:
        shape = type_script(t["parameters"]) if (t["parameters"] or {}).get("properties") else ""
        out.append((f"// {t['description']}\n" if t.get("description") else "") + f"type {t['name']} = ({'_: ' + shape if shape else ''}) => any;")
    return "\n".join(out)


def _object(value) -> dict:
    """A JSON object, or a text that holds one; anything else, malformed JSON too, is an empty one."""
    if isinstance(value, str):
        try:
            value = json.loads(value) if value else {}
        except (ValueError, RecursionError):
            value = {}
    return value if isinstance(value, dict) else {}


def normal_tools(functions: list[dict], answers: bool) -> list[dict]:
    """Functions with their parameters as objects, empty where they can't be read, and the answers tool if asked for."""
    out = []
    for f in functions:
        params = _object(f.get("parameters"))
        if isinstance(params.get("properties"), str):
            params["properties"] = _object(params["properties"])
        if isinstance(params.get("required"), bool):
            params = listed_required(params)
        out.append({"name": f["name"], "description": f["description"], "parameters": params})
    return [*out, ANSWERS_TOOL] if answers and out else out


@lazy_udf("struct<tools:string,formatted_tools:string>")
def tools_column(functions: pd.Series, answers: pd.Series) -> pd.DataFrame:
    def one(fs, ask) -> tuple[str, str]:
        tools = normal_tools([dict(f) for f in fs], bool(ask)) if fs is not None and len(fs) else []
        return (json.dumps(tools), render_tools(tools)) if tools else ("", "")

    return pd.DataFrame([one(f, a) for f, a in zip(functions, answers, strict=True)], columns=["tools", "formatted_tools"])


def wants_answers() -> Column:
    """Whether an assistant part of the first branch is verifiable."""
    first = F.try_element_at("conversation_branches", F.lit(1))
    return F.coalesce(F.exists(first["messages"], lambda m: (m["role"] == "assistant") & F.exists(m["parts"], lambda p: p["type"] == "verifiable-responses")), F.lit(False))


def linearise(df: DataFrame, *, keep_parallel: bool = False) -> DataFrame:
    """Records with ``messages``: system, developer, user, then the first branch.

    A message has role, text (system), tools, has_thinking, formatted_tools
    (developer), parts (user) and blocks (assistant); members of other roles are null.
    """
    said = f"array<struct<role:string,text:string,tools:string,has_thinking:boolean,formatted_tools:string,parts:array<struct<type:string,text:string>>,blocks:array<{BLOCK}>>>"
    none = {"text": F.lit(None).cast("string"), "tools": F.lit(None).cast("string"), "has_thinking": F.lit(None).cast("boolean"), "formatted_tools": F.lit(None).cast("string"), "parts": F.lit(None).cast("array<struct<type:string,text:string>>"), "blocks": F.lit(None).cast(f"array<{BLOCK}>")}
    make = lambda role, **own: F.struct(F.lit(role).alias("role"), *[(own.get(k, v)).alias(k) for k, v in none.items()])
    rows = df.withColumn("_t", tools_column(F.col("available_functions"), wants_answers()))
    first = F.coalesce(F.try_element_at("conversation_branches", F.lit(1))["messages"], F.array().cast("array<struct<role:string,parts:array<struct<type:string,content:string,name:string,args:string,answers:array<string>,metadata:map<string,string>>>>>"))
    folded = F.transform(first, lambda m: F.struct(m["role"].alias("role"), m["parts"].alias("parts"), F.when(m["role"] == "assistant", assistant_blocks(m["parts"], keep_parallel)).alias("a")))
    rows = rows.withColumn("_f", folded)
    thinking = F.exists("_f", lambda m: F.coalesce(m["a"]["thinking"], F.lit(False)))
    user = lambda m: make("user", parts=F.transform(m["parts"], lambda p: F.struct(p["type"].alias("type"), p["content"].alias("text"))))
    head = F.array(
        F.when(F.col("system_prompt").isNotNull(), make("system", text=F.col("system_prompt.content"))),
        make("developer", tools=F.col("_t.tools"), has_thinking=thinking, formatted_tools=F.col("_t.formatted_tools")),
        F.when(F.col("initial_prompt").isNotNull(), make("user", parts=F.array(F.struct(F.lit("response").alias("type"), F.col("initial_prompt.content").alias("text"))))),
    )
    body = F.transform("_f", lambda m: F.when(m["role"] == "assistant", make("assistant", blocks=m["a"]["blocks"])).when(m["role"] == "user", user(m)))
    messages = F.array_compact(F.concat(head, body)).cast(said)
    keep = [c for c in ("conversation_id", "dataset_source", "original_metadata", "created_timestamp") if c in df.columns]
    return rows.select(*keep, messages.alias("messages"))
