"""A user's own DataFrames, from another folder, with workers that can't find the package by themselves."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
df = spark.createDataFrame([(1, "x \\\\boxed{{a}} one two three four five six seven eight nine ten", [1.0, 2.0]), (2, "other words", [2.0, 1.0])], "doc_id long, text string, embedding array<float>")
{body}
print("done")
"""


def run(body: str, tmp_path) -> None:
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYTHONPATH": os.environ.get("FOREIGN_PATH", "")}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(root=str(ROOT), body=body)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]


def test_operators_on_a_users_table(tmp_path):
    run("""
from quarry.functions import text as T
from quarry.operators import annotate, convert, decontam, judge, linearise
assert df.select(T.boxed("text")["answers"][0]).head()[0] == "a"
assert df.select(T.fences("text")).count() == 2 and df.select(T.json_objects("text")).collect() and df.select(T.repair_json("text")).collect()
train, bench = df.select(F.col("doc_id").alias("id"), "text"), df.select(F.lit("b").alias("benchmark"), F.col("doc_id").alias("eval_idx"), "text")
assert decontam.verify(decontam.shared_grams(train, bench), train, bench).count() == 1
rec = convert.prompt_answers(df, "s", F.col("text"), [F.col("text")])
assert linearise.linearise(rec).collect() and annotate.unbox(rec).head().conversation_branches[0].messages[0].parts[1].answers == ["a"]
model = annotate.train_languages(df.withColumn("lang", F.lit("en")), "text", "lang", "doc_id")
assert annotate.annotate_language(df, F.col("text"), lambda: model).head().languages[0].label == "en"
judge.rank_with_judge(df.withColumn("k", F.lit(1)), "k", "doc_id", "text", lambda a, b: a >= b).collect()
""", tmp_path)
