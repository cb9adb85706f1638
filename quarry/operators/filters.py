"""Row selection: field values, licences, splits, quality gates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.paths import nested_get, text_of
from quarry.operators.split import row_numbers

# Rules by dataset.
DATASET_RULES: dict[str, dict] = {
    "tulu-3-sft-mixture": {"kind": "exclude", "field": "original_metadata.source", "values": ["ai2-adapt-dev/tulu_hard_coded_repeated_10", "ai2-adapt-dev/no_robots_converted", "ai2-adapt-dev/flan_v2_converted"]},
    "tulu-3-sft-olmo-2-mixture-0225": {"kind": "exclude", "field": "original_metadata.source", "values": ["olmo_hardcoded", "ai2-adapt-dev/no_robots_converted", "ai2-adapt-dev/flan_v2_converted"]},
    "smoltalk": {"kind": "exclude", "field": "original_metadata.source", "values": ["openhermes-100k", "longalign", "explore-instruct-rewriting"]},
    "smoltalk2": {
        "kind": "splits",
        "splits": [
            "LongAlign_64k_Qwen3_32B_yarn_131k_think", "LongAlign_64k_context_lang_annotated_lang_6_no_think", "OpenHermes_2.5_no_think", "smoltalk_smollm3_explore_instruct_rewriting_no_think",
            "Mixture_of_Thoughts_science_no_think", "hermes_function_calling_v1_no_think", "xlam_traces_no_think", "smolagents_toolcalling_traces_think",
        ],
        "augment": True,
    },
    "The-Tome": {"kind": "exclude", "field": "original_metadata.dataset", "values": ["infini-instruct-top-500k", "ultrainteract_trajectories_sharegpt", "qwen2-72b-magpie-en"]},
    "AceReason-1.1-SFT": {"kind": "exclude", "field": "original_metadata.source", "values": ["leetcode"]},
    "Llama-Nemotron-Post-Training-Dataset": {"kind": "include", "field": "original_metadata.license", "values": ["cc-by-4.0", "odc-by"]},
    "EuroBlocks-SFT-Synthetic-1124": {"kind": "none"},
}


def field_filter(df: DataFrame, path: str, values: Sequence[str], keep: bool = True) -> DataFrame:
    """Rows whose value at ``path``, as text, is among ``values`` (null is ``<NULL>``)."""
    hit = text_of(nested_get(df, path)).isin(*values) if values else F.lit(False)
    return df.where(hit if keep else ~hit)


def exclude_values(df: DataFrame, path: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value isn't listed; null stays."""
    x = nested_get(df, path)
    return df.where(x.isNull() | ~x.isin(*values))


def include_values(df: DataFrame, path: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is listed; null goes."""
    return df.where(nested_get(df, path).isin(*values))


def remove_splits(df: DataFrame, splits: Sequence[str], *, split_col: str = "split", augment: bool = False) -> DataFrame:
    out = df.where(~F.col(split_col).isin(*splits) | F.col(split_col).isNull())
    if augment:
        out = out.withColumn("original_metadata", F.map_concat(F.map_filter(F.coalesce("original_metadata", F.create_map().cast("map<string,string>")), lambda k, _: k != "source"), F.create_map(F.lit("source"), F.col(split_col))))
    return out


def apply_rule(df: DataFrame, dataset: str, rules: Mapping[str, dict] = DATASET_RULES) -> DataFrame:
    """The rule of a dataset, matched by name on the driver; no rule raises."""
    rule = rules[dataset.rsplit("/", 1)[-1]]
    if rule["kind"] == "exclude":
        return exclude_values(df, rule["field"], rule["values"])
    if rule["kind"] == "include":
        return include_values(df, rule["field"], rule["values"])
    if rule["kind"] == "splits":
        return remove_splits(df, rule["splits"], augment=rule.get("augment", False))
    return df


def rule_predicate(dataset: Column, value: Column, rules: Mapping[str, dict]) -> Column:
    """One predicate for a table of many datasets: the row's own dataset decides."""
    out = F.lit(True)
    for name, rule in rules.items():
        mine = dataset == name
        if rule["kind"] == "exclude":
            out = F.when(mine, value.isNull() | ~value.isin(*rule["values"])).otherwise(out)
        elif rule["kind"] == "include":
            out = F.when(mine, F.coalesce(value.isin(*rule["values"]), F.lit(False))).otherwise(out)
    return out


def all_of(df: DataFrame, conditions: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Rows that meet every (field, values); a null field meets none."""
    for field, values in conditions:
        df = df.where(F.coalesce(nested_get(df, field).cast("string").isin(*values), F.lit(False)))
    return df


def drop_empty_branches(df: DataFrame) -> DataFrame:
    """Rows none of whose branches is without messages."""
    return df.where(~F.exists("conversation_branches", lambda b: F.size(b["messages"]) == 0))


def without_ids(df: DataFrame, ids: DataFrame, key: str = "conversation_id") -> DataFrame:
    """Rows whose key isn't among ``ids``; a null key stays."""
    return df.join(ids.select(key).distinct(), key, "left_anti")


def quality_gate(df: DataFrame, score: Column, least: float, *, order: Sequence[Column], length: Column | None = None, longest: int | None = None, most: int | None = None) -> DataFrame:
    """Rows whose score, read as a number, is at least ``least`` and, if asked, whose
    length is at most ``longest``; the first ``most`` of them in ``order``.

    ``most`` is a limit asked for: a top-n, which Spark takes from each partition first.
    """
    out = df.where(score.try_cast("double") >= least)
    if longest is not None:
        out = out.where(length <= longest)
    return out if most is None else out.orderBy(*order).limit(most)


def head(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def row_range(df: DataFrame, start: int, end: int, *order: str) -> DataFrame:
    """Rows ``start`` to ``end`` - 1 in ``order``, by numbers that no single task gives."""
    if not 0 <= start < end:
        raise ValueError("a range needs 0 <= start < end")
    return row_numbers(df, *order).where(F.col("n").between(start, end - 1)).select(*df.columns)


def browse(df: DataFrame, path: str | None = None, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Rows whose value at ``path``, as text, isn't excluded and, if any are named, is included."""
    if not path:
        return df
    value = text_of(nested_get(df, path))
    out = df.where(~value.isin(*exclude)) if exclude else df
    return out.where(value.isin(*include)) if include else out


def written_by(model: str) -> Callable[[Column], Column]:
    """Whether a part is a response of the model."""
    return lambda p: F.coalesce((p["type"] == "response") & (p["metadata"]["model"] == model), F.lit(False))


def model_completion(branches: Column, model: str) -> Column:
    """The first response of the model in the assistant's messages of all branches; null if there is none."""
    said = F.flatten(F.flatten(F.transform(branches, lambda b: F.transform(F.filter(b["messages"], lambda m: m["role"] == "assistant"), lambda m: m["parts"]))))
    return F.try_element_at(F.filter(said, written_by(model)), F.lit(1))["content"]


def model_branch(branches: Column, model: str) -> Column:
    """The first branch in which the model answers, as an array of one or none."""
    has = lambda b: F.exists(b["messages"], lambda m: (m["role"] == "assistant") & F.exists(m["parts"], written_by(model)))
    return F.slice(F.filter(branches, has), 1, 1)


def target_gate(df: DataFrame, model: str, least: float, *, order: Sequence[Column], longest: int | None = None, most: int | None = None, field: str = "complexity_x_quality") -> DataFrame:
    """Records scored at least ``least`` by the model, with its branch alone; others go.

    The score stands in the prompt's metadata under ``complexity_classification.<model>``, as JSON.
    """
    score = F.get_json_object(F.col("initial_prompt.metadata")[f"complexity_classification.{model}"], f"$.{field}")
    rows = df.withColumn("_b", model_branch(F.col("conversation_branches"), model)).where(F.size("_b") == 1)
    text = F.coalesce(model_completion(F.col("_b"), model), F.lit(""))
    told = F.struct(score.try_cast("double").alias("score"), F.lit(model).alias("model"), F.size("conversation_branches").alias("original_branch_count"), F.length(text).alias("completion_length"))
    rows = rows.withColumn("filter_metadata", told)
    kept = quality_gate(rows, score, least, order=order, length=F.col("filter_metadata.completion_length"), longest=longest, most=most)
    return kept.withColumn("conversation_branches", F.col("_b")).drop("_b")


def gate_stats(df: DataFrame) -> DataFrame:
    """One row: least, largest and mean score and length of what a gate kept."""
    of = lambda f, c: f(F.col(f"filter_metadata.{c}"))
    return df.agg(*[of(f, c).alias(f"{n}_{s}") for c, s in (("score", "score"), ("completion_length", "length")) for f, n in ((F.min, "min"), (F.max, "max"), (F.avg, "avg"))])


def valid_completions(df: DataFrame, array_col: str, least: int, *, scored: bool = False) -> DataFrame:
    """Rows with at least ``least`` completions that have text (and a score)."""
    good = F.filter(array_col, lambda x: F.coalesce(F.trim(x["content"]), F.lit("")) != "")
    if scored:
        good = F.filter(good, lambda x: x["score"].isNotNull())
    return df.withColumn(array_col, good).where(F.size(array_col) >= least)


def iterations_in_range(df: DataFrame, array_col: str, low: int, high: int) -> DataFrame:
    """Completions of the iterations wanted, if all are there and have text; the
    truth is ``high - rank``."""
    kept = F.filter(array_col, lambda x: x["rank"].between(low, high))
    whole = (F.size(kept) == high - low + 1) & F.forall(kept, lambda x: x["content"].isNotNull())
    return df.withColumn(array_col, F.transform(kept, lambda x: x.withField("truth", F.lit(high) - x["rank"]))).where(whole)
