"""The canonical conversation record and its parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART = "struct<type:string,content:string,name:string,args:string,answers:array<string>,metadata:map<string,string>>"
MESSAGE = f"struct<role:string,parts:array<{PART}>>"
BRANCH = f"struct<messages:array<{MESSAGE}>>"
PROMPT = "struct<role:string,content:string,metadata:map<string,string>>"
SYSTEM = "struct<content:string,metadata:map<string,string>>"
FUNCTION = "struct<name:string,description:string,parameters:string>"

#: Column name -> type of the record.
RECORD = {
    "conversation_id": "string",
    "dataset_source": "string",
    "original_metadata": "map<string,string>",
    "system_prompt": SYSTEM,
    "initial_prompt": PROMPT,
    "available_functions": f"array<{FUNCTION}>",
    "conversation_branches": f"array<{BRANCH}>",
    "created_timestamp": "string",
}

#: Default of each leaf type of a uniform schema.
DEFAULTS = {"string": "", "boolean": False, "bigint": 0, "double": 0.0}


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def part(kind: str | Column, content: Column | str = "", *, name: Column | str = "", args: Column | str = "", answers: Column | None = None, metadata: Column | None = None) -> Column:
    """A part with every member present; unused strings are empty, never null."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.struct(
        lit(kind).alias("type"),
        F.coalesce(lit(content), F.lit("")).alias("content"),
        F.coalesce(lit(name), F.lit("")).alias("name"),
        F.coalesce(lit(args), F.lit("")).alias("args"),
        (F.array().cast("array<string>") if answers is None else F.coalesce(answers, F.array().cast("array<string>"))).alias("answers"),
        (empty_map() if metadata is None else metadata).alias("metadata"),
    )


def message(role: Column | str, parts: Column) -> Column:
    return F.struct((role if isinstance(role, Column) else F.lit(role)).alias("role"), parts.alias("parts"))


def prompt(content: Column, role: Column | str = "user") -> Column:
    return F.struct((role if isinstance(role, Column) else F.lit(role)).alias("role"), content.alias("content"), empty_map().alias("metadata"))


def system(content: Column) -> Column:
    return F.struct(content.alias("content"), empty_map().alias("metadata"))


def strip(column: Column) -> Column:
    """White space off both ends, not only spaces."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def title(column: Column) -> Column:
    return F.concat(F.upper(F.substring(column, 1, 1)), F.lower(F.substr(column, F.lit(2))))
