"""A corpus pipeline over ``documents``: quality, near-duplicates, repeated passages,
mixing and packing.

The stages are the operators' functions, but for near-duplicates: 0.8 on five-word shingles is beyond what op3's exact
blocks can deal out, so wider SimHash fingerprints are dealt out by tables of their bits
(:mod:`quarry.llm.near_copies`; README says what that finds and what it costs).

Every stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and its result is written before the next one reads it.

* quality: rows whose score says bad go; the model is trained on the labels.
* near-duplicates: rows whose sets of five-word shingles have a Jaccard similarity of
  0.8 or more are linked; of each linked group the row of the smallest doc_id stays; a
  row without an id comes last in its group, and rows that repeat an id are judged one
  by one, by their texts.
* repeats: bytes of 100-byte strings that start earlier are cut out of the texts; a
  text of which nothing is left goes.
* mixing: documents are repeated by their rates, so that the languages' tokens
  reach TARGETS; the total is the least for which no language has to shrink, so no
  document is lost.
* packing: whole texts into sequences of 4096 tokens.

Texts are nulls' equals of empty ones; a document without words is junk to the first
stage or, if it stays, one more copy of the empty text to the second.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import compression_quality, mixing, near_copies, packing, queries, repeats
from quarry.llm.common import dropped_after, shared_path, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Wanted shares of tokens by language.
TARGETS = {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.13}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = compression_quality.train(docs, queries.training_labels(table(spark, sf_dir, "labels")))
    scored = compression_quality.score(docs, model, keep=COLUMNS)
    return scored.where(F.col("quality_score") >= 0.5).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # A key of its own for each row: rows without an id, or with a repeated one, are judged by their texts.
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row_key"), *COLUMNS), "keyed-rows")
    found = near_copies.near_copies(rows, key_col="row_key", words=5, least=0.8)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row_key")
    stays = rows.select("row_key", rank.alias("rank")).join(found, "row_key").groupBy("component").agg(F.min("rank")["row_key"].alias("row_key"))
    return rows.join(stays.select("row_key"), "row_key", "left_semi").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(docs, length=100, keep=[c for c in COLUMNS if c != "text"], kept_text=True)
    # A cut may split a character: what is left of it is dropped with it.
    whole = F.col("kept").cast("string")
    text = F.when(F.is_valid_utf8(whole), whole).otherwise(F.replace(F.make_valid_utf8(whole), F.lit("\ufffd"), F.lit("")))
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes"))).withColumn("text", text)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id")
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(labels, "doc_id")
    rated, _, reached = mixing.mix(docs, labelled, TARGETS, keep=COLUMNS, low=1.0, total=math.inf)
    mixing.demand(reached, TARGETS)
    return mixing.copies(rated).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, queries.vocabulary(), max_len=4096, end_id=1)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixed),
    ("best-fit packing", packed),
]

#: Compression, suffix names and projected gradients have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with dropped_after(spark):  # a stage's own tables go once its result is written
            label = name.replace(" ", "-")
            docs = stored(stage(spark, docs, sf_dir), label, shared_path(spark, label))
    return STAGES[-1][1](spark, docs, sf_dir)
