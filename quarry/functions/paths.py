"""Paths like ``a.b[0].c`` as columns, resolved against a schema."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType


def tokens(path: str) -> list[str]:
    return [t for t in re.sub(r"\[(\d+)\]", r".\1", path).split(".")]


def nested_get(df: DataFrame, path: str) -> Column:
    """The value at ``path``; null where a step misses, whatever the data hold.

    A number steps into arrays only, a name into structs and maps only.  A
    path that the schema rules out is the null literal, so nothing is read for it.
    """
    kind: DataType = df.schema
    at: Column | None = None
    for step in tokens(path):
        if step.isdigit():
            if not isinstance(kind, ArrayType):
                return F.lit(None).cast("string")
            at, kind = F.try_element_at(at, F.lit(int(step) + 1)), kind.elementType
        elif isinstance(kind, StructType) and step in kind.fieldNames():
            at, kind = (F.col(f"`{step}`") if at is None else at.getField(step)), kind[step].dataType
        elif isinstance(kind, MapType):
            at, kind = F.try_element_at(at, F.lit(step)), kind.valueType
        else:
            return F.lit(None).cast("string")
    return at


def nested_get_strict(path: str) -> Column:
    """The column at a dotted path; analysis fails if it doesn't exist."""
    first, *rest = path.split(".")
    at = F.col(f"`{first}`")
    for step in rest:
        at = at.getField(step)
    return at


def nested_set(df: DataFrame, path: str, value: Column) -> DataFrame:
    """``df`` with the member at a path of structs and list places set.

    Lists grow with nulls up to the place that is set.
    """
    steps = tokens(path)

    def put(kind: DataType | None, at: Column | None, rest: list[str]) -> Column:
        if not rest:
            return value
        step, *more = rest
        if step.isdigit():
            n, inner = int(step), kind.elementType if isinstance(kind, ArrayType) else None
            old = F.coalesce(at, F.array()) if at is not None else F.array()
            length = F.greatest(F.size(old), F.lit(n + 1))
            grown = F.sequence(F.lit(0), length - 1)
            new = put(inner, F.try_element_at(old, F.lit(n + 1)), more)
            return F.transform(grown, lambda i: F.when(i == n, new).otherwise(F.try_element_at(old, i + 1)))
        if at is None or not isinstance(kind, StructType):
            return F.struct(put(None, None, more).alias(step))
        inner = kind[step].dataType if step in kind.fieldNames() else None
        if kind.fields:  # where there is no struct yet, one without values
            at = F.coalesce(at, F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields]))
        return at.withField(step, put(inner, at.getField(step) if inner is not None else None, more))

    first, *rest = steps
    kind = df.schema[first].dataType if first in df.columns else None
    return df.withColumn(first, put(kind, F.col(f"`{first}`") if kind is not None else None, rest))


def text_of(column: Column) -> Column:
    """The text under which values are compared: the cast, and ``<NULL>`` for null."""
    return F.coalesce(column.cast("string"), F.lit("<NULL>"))
