"""Mixtures: filtered tables brought to one shape and joined end to end."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.model import FUNCTION, PART, SYSTEM, empty_map, system
from quarry.operators.filters import all_of


def concatenate(*frames: DataFrame, missing: bool = False) -> DataFrame:
    """UNION ALL by name; columns must agree unless ``missing`` fills them with null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def read_spec(path: str) -> dict[str, list[dict]]:
    """name -> [{dataset_path, filters: [{field, values}]} or {mixture: another name}]"""
    return yaml.safe_load(Path(path).read_text())


def resolved(catalogue: Mapping[str, Sequence[Mapping]], name: str, above: tuple[str, ...] = ()) -> list[dict]:
    """The entries of a named mixture, references to other mixtures replaced by theirs.

    An entry's own filters hold for all that a reference stands for.  A mixture that contains itself raises.
    """
    if name in above:
        raise ValueError(f"mixtures contain each other: {' > '.join((*above, name))}")
    out = []
    for entry in catalogue[name]:
        own = list(entry.get("filters") or [])
        inner = resolved(catalogue, entry["mixture"], (*above, name)) if "mixture" in entry else [dict(entry, filters=[])]
        out += [dict(e, filters=[*(e.get("filters") or []), *own]) for e in inner]
    return out


def harmonise_metadata(df: DataFrame) -> DataFrame:
    """Metadata with an id and a source become one number that follows from both, whatever else they hold;
    other metadata without an original id become 0; anything else stays."""
    m = F.coalesce(F.col("original_metadata"), empty_map())
    number = F.pmod(F.xxhash64(F.concat(F.coalesce(m["id"], F.lit("")), F.coalesce(m["source"], F.lit("")))), F.lit((1 << 63) - 1)).cast("string")
    pair = F.map_contains_key(m, "id") & F.map_contains_key(m, "source")
    only = lambda x: F.create_map(F.lit("original_id"), x)
    return df.withColumn("original_metadata", F.when(pair, only(number)).when(F.map_contains_key(m, "original_id"), m).otherwise(only(F.lit("0"))))


def harmonise_functions(df: DataFrame) -> DataFrame:
    """No functions is an empty list; null entries go; missing texts are empty."""
    full = lambda x: F.struct(F.coalesce(x["name"], F.lit("")).alias("name"), F.coalesce(x["description"], F.lit("")).alias("description"), F.coalesce(x["parameters"], F.lit("{}")).alias("parameters"))
    kept = F.transform(F.filter("available_functions", lambda x: x.isNotNull()), full)
    return df.withColumn("available_functions", F.coalesce(kept, F.array().cast(f"array<{FUNCTION}>")))


def harmonise_system(df: DataFrame) -> DataFrame:
    return df.withColumn("system_prompt", F.coalesce(F.col("system_prompt").cast(SYSTEM), system(F.lit(""))))


def harmonise_parts(df: DataFrame) -> DataFrame:
    """All members of all parts present; messages get metadata."""
    text = lambda p, n: F.coalesce(p[n], F.lit("")).alias(n)
    whole = lambda p: F.struct(text(p, "type"), text(p, "content"), text(p, "name"), text(p, "args"), F.coalesce(p["answers"], F.array().cast("array<string>")).alias("answers"), F.coalesce(p["metadata"], empty_map()).alias("metadata")).cast(PART)
    message = lambda m: F.struct(m["role"].alias("role"), F.transform(m["parts"], whole).alias("parts"), empty_map().alias("metadata"))
    return df.withColumn("conversation_branches", F.transform("conversation_branches", lambda b: F.struct(F.transform(b["messages"], message).alias("messages"))))


def harmonise(df: DataFrame) -> DataFrame:
    return harmonise_parts(harmonise_system(harmonise_functions(harmonise_metadata(df))))


def mixture(spark: SparkSession, spec: Sequence[Mapping], read=None) -> DataFrame:
    """The tables of a spec: read, filtered, stamped with their path, harmonised, joined."""
    read = read or (lambda path: spark.read.parquet(path))
    parts = []
    for entry in spec:
        rows = all_of(read(entry["dataset_path"]), [(f["field"], [str(v) for v in f["values"]]) for f in entry.get("filters") or []])
        parts.append(harmonise(rows.withColumn("aggregation_input_data_path", F.lit(entry["dataset_path"]))))
    return concatenate(*parts)
