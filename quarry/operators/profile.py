"""Profiles of fields and schemas, and schemas made uniform."""

from __future__ import annotations

import hashlib
import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, MapType, StringType, StructType

from quarry.functions.paths import text_of
from quarry.model import DEFAULTS
from quarry.operators.split import row_numbers


ITEMS = 3  # of each list, from the first


def leaf_paths(kind: DataType, at: str = "", path: str = "", depth: int = 8) -> list[tuple[str, str, str, str]]:
    """(path, expression, type, list item) of the scalar leaves, into the first ITEMS items of lists of structs.

    The last is the expression of the list item that a leaf is in, empty outside lists: where it is null there is no leaf.
    """
    out: list[tuple[str, str, str, str]] = []
    if isinstance(kind, StructType) and depth:
        for f in kind.fields:
            step, name, inner = (f"{at}." if at else "") + f"`{f.name}`", (f"{path}." if path else "") + f.name, f.dataType
            if isinstance(inner, ArrayType):
                if isinstance(inner.elementType, StructType):
                    for i in range(ITEMS):
                        item = f"try_element_at({step}, {i + 1})"
                        out += [(p, e, t, within or item) for p, e, t, within in leaf_paths(inner.elementType, item, f"{name}[{i}]", depth - 1)]
            elif isinstance(inner, StructType):
                out += leaf_paths(inner, step, name, depth - 1)
            elif not isinstance(inner, MapType):
                out.append((name, step, inner.simpleString(), ""))
    return out


def cells(df: DataFrame) -> DataFrame:
    """(path, type, value) of every leaf of every row, the value as text."""
    cell = lambda p, e, t: F.struct(F.lit(p).alias("path"), F.lit(t).alias("type"), text_of(F.expr(e)).alias("value"))
    found = [F.when(F.expr(f"{within} IS NOT NULL"), cell(p, e, t)) if within else cell(p, e, t) for p, e, t, within in leaf_paths(df.schema)]
    return df.select(F.explode(F.array_compact(F.array(*found))).alias("c")).select("c.*")


def field_values(df: DataFrame) -> DataFrame:
    """(path, type, value, n): how often each value, as text, occurs at each path.

    One pass: each row gives one small row per path, summed before the shuffle.  Every distinct value is a row of it: for columns
    of many values see :mod:`quarry.operators.sketches`.
    """
    return cells(df).groupBy("path", "type", "value").agg(F.count(F.lit(1)).alias("n"))


def field_stats(df: DataFrame) -> DataFrame:
    """(path, type, distinct, filled): distinct values but null, and rows that have one."""
    real = F.col("value") != "<NULL>"
    return field_values(df).groupBy("path", "type").agg(F.count(F.when(real, 1)).alias("distinct"), F.coalesce(F.sum(F.when(real, F.col("n"))), F.lit(0)).alias("filled"))


def skeleton(kind: DataType):
    """A schema with type names for values, a list by its item."""
    if isinstance(kind, StructType):
        return {f.name: skeleton(f.dataType) for f in kind.fields}
    if isinstance(kind, ArrayType):
        return [skeleton(kind.elementType)]
    if isinstance(kind, MapType):
        return {}
    return {"string": "str", "bigint": "int", "int": "int", "double": "float", "float": "float", "boolean": "bool"}.get(kind.simpleString(), kind.simpleString())


def json_structures(df: DataFrame, column: str) -> DataFrame:
    """(structure, hash, n): the distinct structures of a column of JSON texts."""
    shape = F.schema_of_variant(F.try_parse_json(column))
    return df.groupBy(shape.alias("structure")).agg(F.count(F.lit(1)).alias("n")).withColumn("hash", F.sha2(F.coalesce("structure", F.lit("")), 256))


def merge_skeletons(*found):
    """One structure for several: what is known wins, dicts by key, lists by their first item."""

    def two(a, b):
        if a is None or a == {} or a == []:
            return b if b is not None else a
        if isinstance(a, dict) and isinstance(b, dict):
            return {k: two(a.get(k), b.get(k)) for k in [*a, *(k for k in b if k not in a)]}
        if isinstance(a, list) and isinstance(b, list):
            return [two(a[0], b[0])] if a and b else a or b
        return a

    return reduce(two, found)


def fill_unknown(shape, name: str = ""):
    """A structure without None: {} or [] where the name says so, else an empty text."""
    if isinstance(shape, dict):
        return {k: fill_unknown(v, k) for k, v in shape.items()}
    if isinstance(shape, list):
        return [fill_unknown(v, name) for v in shape]
    if shape is None:
        return {} if "metadata" in name or name in ("parameters", "properties") else [] if name.endswith("s") else "str"
    return shape


def structure_hash(shape) -> str:
    return hashlib.sha256(json.dumps(shape, sort_keys=True).encode()).hexdigest()


_KINDS = {"str": StringType(), "int": LongType(), "float": DoubleType(), "bool": BooleanType()}


def uniform(df: DataFrame, template: dict) -> DataFrame:
    """``df`` in the template's shape: missing and null leaves get their type's default,
    casts that fail too, columns outside the template go."""

    def shaped(shape, kind: DataType | None, at: Column | None) -> Column:
        if isinstance(shape, dict):
            fields = kind.fieldNames() if isinstance(kind, StructType) else []
            return F.struct(*[shaped(v, kind[k].dataType if k in fields else None, at.getField(k) if at is not None and k in fields else None).alias(k) for k, v in shape.items()])
        if isinstance(shape, list):
            inner = shape[0] if shape else "str"
            if at is None or not isinstance(kind, ArrayType):
                return F.filter(F.array(shaped(inner, None, None)), lambda _: F.lit(False))
            return F.coalesce(F.transform(at, lambda x: shaped(inner, kind.elementType, x)), F.filter(F.array(shaped(inner, None, None)), lambda _: F.lit(False)))
        target = _KINDS[shape]
        default = F.lit(DEFAULTS[target.simpleString()])
        if at is None:
            return default.cast(target)
        cast = F.lower(at.cast("string")).isin("true", "1", "yes") if shape == "bool" and kind.simpleString() == "string" else at.cast("string") if shape == "str" else at.try_cast(target)
        return F.coalesce(cast, default.cast(target))

    return df.select(*[shaped(v, df.schema[k].dataType if k in df.columns else None, F.col(f"`{k}`") if k in df.columns else None).alias(k) for k, v in template.items()])


def schema_groups(df: DataFrame, column: str) -> DataFrame:
    """(structure, n, share): rows by structure, the most common first."""
    groups = json_structures(df, column).select("structure", "n")
    total = groups.agg(F.sum("n").alias("t"))
    return groups.crossJoin(F.broadcast(total)).select("structure", "n", (F.col("n") * 100.0 / F.col("t")).alias("share"))  # one row


# ---- profiles of values -----------------------------------------------------

#: Below this depth only these members count.
KEY_FIELDS, SHALLOW, DEEPEST = ("metadata", "content", "role", "type", "parts"), 2, 4


def value_profile(df: DataFrame) -> Column:
    """Sorted array of (path, type) of a row's values: what is null or empty is told apart, lists go by their first item."""

    def entry(path: str, kind: Column) -> Column:
        return F.struct(F.lit(path).alias("path"), kind.alias("type"))

    def walk(path: str, kind: DataType, at: Column, present: Column) -> list[Column]:
        level = path.count(".")
        if level >= DEEPEST:
            return [F.when(present, entry(path, F.when(at.isNull(), "null").otherwise("deep_nested")))]
        if isinstance(kind, StructType):
            inside = [f for f in kind.fields if level < SHALLOW or f.name in KEY_FIELDS]
            own = [F.when(present, entry(path, F.when(at.isNull(), "null").otherwise("dict")))]
            return own + [x for f in inside for x in walk(f"{path}.{f.name}", f.dataType, at[f.name], present & at.isNotNull())]
        if isinstance(kind, ArrayType):
            own = [F.when(present, entry(path, F.when(at.isNull(), "null").when(F.size(at) == 0, "empty_list").otherwise("list")))]
            return own + walk(f"{path}[0]", kind.elementType, F.try_element_at(at, F.lit(1)), present & (F.coalesce(F.size(at), F.lit(0)) > 0))
        if isinstance(kind, MapType):
            return [F.when(present, entry(path, F.when(at.isNull(), "null").when(F.size(at) == 0, "empty_dict").otherwise("dict")))]
        name = {"string": "string", "boolean": "number"}.get(kind.simpleString(), "number")
        return [F.when(present, entry(path, F.when(at.isNull(), "null").otherwise(name)))]

    found = [x for f in df.schema.fields for x in walk(f.name, f.dataType, F.col(f"`{f.name}`"), F.lit(True))]
    return F.array_sort(F.array_compact(F.array(*found)))


def profile_groups(df: DataFrame) -> DataFrame:
    """(profile, n, share, primary): rows by their profiles; the most common one is the primary."""
    groups = df.select(value_profile(df).alias("profile")).groupBy("profile").agg(F.count(F.lit(1)).alias("n"))
    total = groups.agg(F.sum("n").alias("_t"), F.max_by("profile", F.struct("n", "profile")).alias("_p"))
    return groups.crossJoin(F.broadcast(total)).select("profile", "n", (F.col("n") * 100.0 / F.col("_t")).alias("share"), (F.col("profile") == F.col("_p")).alias("primary"))  # one row


def profile_differences(groups: DataFrame) -> DataFrame:
    """(path, kind, in_primary, in_variant, n) of all profiles but the primary: missing in one of the two, or of another type."""
    as_map = lambda c: F.map_from_entries(c)
    first = groups.where("primary").select(as_map("profile").alias("_p"))
    rows = groups.where("NOT primary").crossJoin(F.broadcast(first)).select("n", "_p", as_map("profile").alias("_v"))  # one row
    paths = F.array_union(F.map_keys("_p"), F.map_keys("_v"))
    rows = rows.select("n", "_p", "_v", F.explode(paths).alias("path"))
    a, b = F.try_element_at("_p", F.col("path")), F.try_element_at("_v", F.col("path"))
    kind = F.when(a.isNull(), "missing_in_primary").when(b.isNull(), "missing_in_variant").when(a != b, "type_mismatch")
    return rows.select("path", kind.alias("kind"), a.alias("in_primary"), b.alias("in_variant"), "n").where("kind IS NOT NULL").groupBy("path", "kind", "in_primary", "in_variant").agg(F.sum("n").alias("n"))


def unified_profile(groups: DataFrame) -> DataFrame:
    """(path, type): the primary's, with what others add, and their type where the primary has only null."""
    own = groups.where("primary").select(F.explode("profile").alias("x")).select(F.col("x.path").alias("path"), F.col("x.type").alias("own"))
    rows = groups.select("n", F.explode("profile").alias("x")).select("n", F.col("x.path").alias("path"), F.col("x.type").alias("type"))
    most = rows.groupBy("path", "type").agg(F.sum("n").alias("n")).groupBy("path").agg(F.max_by("type", F.struct(F.col("type") != "null", "n", "type")).alias("other"))
    joined = most.join(own, "path", "left")
    return joined.select("path", F.when(F.col("own").isNull() | (F.col("own") == "null"), F.col("other")).otherwise(F.col("own")).alias("type"))


def with_metadata(df: DataFrame) -> DataFrame:
    """Records whose prompts and parts all have metadata, empty where there was none."""
    full = lambda s: s.withField("metadata", F.coalesce(s["metadata"], F.create_map().cast("map<string,string>")))
    out = df
    for name in ("system_prompt", "initial_prompt"):
        out = out.withColumn(name, F.when(F.col(name).isNotNull(), full(F.col(name))))
    part = lambda m: m.withField("parts", F.transform(m["parts"], full))
    return out.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: b.withField("messages", F.transform(b["messages"], part))))


def spread_sample(df: DataFrame, rows: int, key: str, seed: int = 0) -> DataFrame:
    """``rows`` rows spread evenly over ``df`` in the order of ``key``, filled up by a seeded hash where the steps
    don't give enough; a sampling operator.  All rows if there are no more."""
    numbered = row_numbers(df, key)
    total = df.count()
    step = max(1, total // rows)
    chosen = (F.col("n") % step == 0) & (F.col("n") / step < rows)
    have = min(rows, -(-total // step))
    out = numbered.where(chosen)
    if have < min(rows, total):
        out = out.unionByName(numbered.where(~chosen).orderBy(F.xxhash64("n", F.lit(seed)), "n").limit(rows - have))
    return out.drop("n")


def record_stats(df: DataFrame) -> DataFrame:
    """(statistic, value, n) over all records: sources, system prompts, functions, numbers of branches."""
    facts = F.array(
        F.struct(F.lit("source").alias("statistic"), F.coalesce("dataset_source", F.lit("unknown")).alias("value")),
        F.when(F.coalesce(F.col("system_prompt.content"), F.lit("")) != "", F.struct(F.lit("system_prompt").alias("statistic"), F.lit("").alias("value"))),
        F.when(F.size("available_functions") > 0, F.struct(F.lit("functions").alias("statistic"), F.lit("").alias("value"))),
        F.struct(F.lit("branches").alias("statistic"), F.coalesce(F.size("conversation_branches"), F.lit(0)).cast("string").alias("value")),
    )
    rows = df.select(F.explode(F.array_compact(facts)).alias("x")).select("x.*")
    return rows.groupBy("statistic", "value").agg(F.count(F.lit(1)).alias("n"))
