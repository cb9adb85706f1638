"""One structure for many JSON values, merged by an associative rule.

A value's structure is a set of rows (path, kind, place): a walk over the value, of any depth, gives the kind at each path, where a path is an array of
steps, ``.name`` into a member and ``[0]`` into a list's first item.  Over all values the rule is: at a path the first kind that is known counts, in
the order of ``place``; a null, an empty dict or an empty list is not known, and counts (the last of them that is no null) where nothing is.  A path only
counts where the kinds above it are those its steps mean.  First and last are minima and maxima, so tasks merge what they read, Spark merges that, and
what is shuffled depends on the paths and not on the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import in_arrow

ITEM = "[0]"  # the step into a list
UNKNOWN = ("null", "{}", "[]")
MOST_PATHS = 100_000  # a task keeps so many before it passes them on
ROWS = "path array<string>, kind string, first long, last long"


def _walk(value: object) -> Iterator[tuple[tuple, str]]:
    """(path, kind) of a value and all it holds, lists by their first item."""
    waiting: list[tuple[tuple, object]] = [((), value)]
    while waiting:
        path, v = waiting.pop()
        if isinstance(v, dict):
            yield path, "dict" if v else "{}"
            waiting += [((*path, f".{k}"), x) for k, x in v.items()]
        elif isinstance(v, list):
            yield path, "list" if v else "[]"
            waiting += [((*path, ITEM), x) for x in v[:1]]
        else:
            yield path, "null" if v is None else "bool" if isinstance(v, bool) else "int" if isinstance(v, int) else "float" if isinstance(v, float) else "str"


def structure_rows(df: DataFrame, text: str, place: str) -> DataFrame:
    """(path, kind, first, last): each kind at each path of a column of JSON texts, with the smallest and the largest
    ``place`` (a whole number) it has.  Texts that aren't JSON, and nulls, have no structure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[tuple, str], list[int]] = {}

        def passed_on() -> pa.RecordBatch:
            rows = [(p, k, a, b) for (p, k), (a, b) in held.items()]
            held.clear()
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(map(list, columns[0]), pa.list_(pa.string())), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], ["path", "kind", "first", "last"])

        for b in batches:
            for said, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    value = json.loads(said)
                except (TypeError, ValueError, RecursionError):
                    continue
                for path, kind in _walk(value):
                    seen = held.setdefault((path, kind), [at, at])
                    seen[0], seen[1] = min(seen[0], at), max(seen[1], at)
            if len(held) > MOST_PATHS:
                yield passed_on()
        yield passed_on()

    rows = in_arrow(df.select(text, F.col(place).cast("long")).where(F.col(place).isNotNull()), run, ROWS)
    return rows.groupBy("path", "kind").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def merged(*tables: DataFrame) -> DataFrame:
    """The structure rows of several tables as one."""
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    return rows.groupBy("path", "kind").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def _unknown(path: Column) -> Column:
    """What stands for a value nobody knows, by the name of its member: {} or [] where the name says so, else a text."""
    name = F.coalesce(F.substr(F.try_element_at(F.filter(path, lambda s: s.startswith(".")), F.lit(-1)), F.lit(2)), F.lit(""))
    return F.when(name.contains("metadata") | name.isin("parameters", "properties"), "{}").when(name.endswith("s"), "[]").otherwise("str")


def resolved(rows: DataFrame) -> DataFrame:
    """(path, kind) of the merged structure, from (path, kind, first, last); kinds are dict, list, str, int, float, bool, {} and []."""
    known, empty = ~F.col("kind").isin(*UNKNOWN), F.col("kind").isin("{}", "[]")
    best = rows.groupBy("path").agg(F.min(F.when(known, F.struct("first", "kind"))).alias("known"), F.max(F.when(empty, F.struct("last", "kind"))).alias("empty"))
    won = best.select("path", F.coalesce("known.kind", "empty.kind", _unknown(F.col("path"))).alias("kind"))
    # Each path above a path has to be of the kind that the step after it means.
    steps = won.select("path", F.posexplode("path").alias("k", "step"))
    above = steps.select("path", F.slice("path", F.lit(1), F.col("k")).alias("above"), F.when(F.col("step") == ITEM, "list").otherwise("dict").alias("means"))
    wrong = above.join(won.select(F.col("path").alias("above"), F.col("kind").alias("is")), "above").where(F.col("means") != F.col("is"))
    return won.join(wrong.select("path").distinct(), "path", "left_anti")


def template(structure: DataFrame, most: int = 100_000):
    """The merged structure as nested dicts, lists of one item and type names, as :func:`quarry.operators.profile.uniform` takes it."""
    rows = structure.limit(most + 1).collect()  # paths, not values
    if len(rows) > most:
        raise ValueError(f"more than {most} paths")
    made: dict[tuple, object] = {}
    for path, kind in sorted(((tuple(r.path), r.kind) for r in rows), key=lambda r: len(r[0])):
        made[path] = value = {"dict": {}, "{}": {}, "list": [], "[]": []}.get(kind, kind)
        if path:
            held = made[path[:-1]]
            held.append(value) if path[-1] == ITEM else held.__setitem__(path[-1][1:], value)
    return made.get((), {})
