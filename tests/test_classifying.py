import json
import os
import time
from collections import Counter

from pyspark.sql import functions as F

from quarry.streaming import classifying as c

KEYS = ("conversation_id", "branch")


def task_rows(spark, ids):
    return spark.createDataFrame([(f"c{i}", i % 2, f"q{i}", "a") for i in ids], "conversation_id string, branch int, question string, answer string")


def asked(folder):
    """Requests by question, and how many."""
    return Counter(name.split("-")[0] for name in os.listdir(folder))


def client(folder):
    """Answers by the last digit: 7 and 8 fail until there is a file 'go', 9 never gives a label."""

    def ask(text):
        question = text.split("\n")[0]
        with open(f"{folder}/{question}-{time.time_ns()}", "w"):
            pass
        if question[-1] in "78" and not os.path.exists(f"{folder}-go"):
            raise OSError("busy")
        return json.dumps({"classification": "maybe" if question[-1] == "9" else "yes" if int(question[1:]) % 2 else "no", "reasoning": "r"})

    return ask


def run(spark, tmp_path, **options):
    tasks = spark.readStream.schema("conversation_id string, branch int, question string, answer string").parquet(f"file://{tmp_path}/tasks")
    stream = c.attempts_of(tasks, ["yes", "no", "unsure"], client(f"{tmp_path}/asked"), keys=KEYS, pause=0.3, **options)
    return stream, c.started(stream, f"file://{tmp_path}/out", f"file://{tmp_path}/checkpoint", every="300 milliseconds")


def until(what, seconds=90):
    end = time.time() + seconds
    while not what():
        assert time.time() < end
        time.sleep(0.3)


def test_a_killed_run_goes_on(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    os.mkdir(f"{tmp_path}/asked")
    task_rows(spark, range(20)).repartition(2).write.parquet(f"file://{tmp_path}/tasks")
    stream, first = run(spark, tmp_path, attempts=50)
    until(lambda: os.path.exists(f"{tmp_path}/out/_spark_metadata") and c.results(stream, out).count() >= 14)
    first.stop()  # while 7, 8, 9 and their like wait
    before = asked(f"{tmp_path}/asked")
    settled = {f"q{r.conversation_id[1:]}" for r in c.results(stream, out).collect()}
    assert settled == {f"q{i}" for i in range(20) if i % 10 < 7} and c.waiting(spark, out) == 6
    assert all(before[q] == 1 for q in settled)

    open(f"{tmp_path}/asked-go", "w").close()
    task_rows(spark, [3, 4, 20, 21]).write.mode("append").parquet(f"file://{tmp_path}/tasks")  # two are old acquaintances
    stream, second = run(spark, tmp_path, attempts=3)
    c.finish(second, out)
    after = asked(f"{tmp_path}/asked")
    assert all(after[q] == 1 for q in settled | {"q20", "q21"})  # no finished task was asked a second time
    got = {r.conversation_id: r for r in c.results(stream, out).collect()}
    assert len(got) == 22 and c.waiting(spark, out) == 0
    for i in range(22):
        r = got[f"c{i}"]
        assert (r.classification, r.success) == (("unsure", False) if i % 10 == 9 else (("yes" if i % 2 else "no"), True))
    assert got["c9"].error == "not a label: maybe"
    tries = spark.read.parquet(out).groupBy("conversation_id").agg(F.max("attempt").alias("n"), F.count(F.lit(1)).alias("k")).collect()
    assert all(r.n == r.k for r in tries)  # attempts are numbered through, over the restart as well


def test_no_python_task_sleeps():
    source = open(c.__file__).read()
    assert source.count("time.sleep") == 1 and "time.sleep" in source[source.index("def finish") :]
