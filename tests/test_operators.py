import json
import math
import os
import random
import time
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.paths import nested_get, nested_set
from quarry.model import RECORD
from quarry.operators import annotate, convert, decontam, judge, linearise, mixture, profile, split
from quarry.sources import io
from quarry.streaming import ingest


def test_boxed():
    assert T.unbox("a \\boxed{x_{1}} b \\boxed{\\boxed{y}}") == ("a x_{1} b \\boxed{y}", ["x_{1}", "\\boxed{y}"])
    assert T.unbox("no \\boxed{open") == ("no \\boxed{open", [])
    assert T.unbox("\\boxed{ \\boxed{z}") == ("\\boxed{ z", ["z"])


def test_fences_in_order():
    kinds = [p["type"] for p in T.fenced_parts("hi\n```python\nprint(1)\n```\n```output\n1\n```\ndone")]
    assert kinds == ["response", "function-call", "function-output", "response"]
    assert T.fenced_parts("```sql\nselect\n```")[0]["type"] == "response"
    assert T.fenced_parts(None) == []


def test_json_objects_and_repair():
    assert T.top_objects('x {"name": "a", "b": "}"} {"c": 1} {"name": {"d": 2}}') == ['{"name": "a", "b": "}"}', '{"name": {"d": 2}}']
    assert json.loads(T.repaired('pre {"a": [1, 2,], "b": "\\q",} post')) == {"a": [1, 2], "b": "\\q"}
    assert json.loads(T.repaired('{\n"a": "x "y" z",\n"b": 1\n}')) == {"a": 'x "y" z', "b": 1}
    assert T.literal_json("{'a': (1, None)}") == '{"a": [1, null]}'
    assert T.literal_json("nope(") is None


def test_match_ratio():
    base = [str(i) for i in range(20)]
    assert decontam.match_ratio(base, base) == 1.0
    assert decontam.match_ratio(base[:8] + ["x"] * 9, base) == 0.4
    assert decontam.match_ratio(["a", "0", "1", "2", "3", "b"], base) == 0.0  # a block of four
    assert decontam.match_ratio([], []) == 0.0


def test_ngrams(spark):
    rows = [(n, " ".join(map(str, range(n)))) for n in (0, 7, 8, 9, 10)]
    df = spark.createDataFrame([*rows, (99, None)], "n int, t string").select("n", decontam.words(F.col("t")).alias("w"))
    got = {r.n: r.k for r in df.select("n", F.size(decontam.ngrams(F.col("w"), 8)).alias("k")).collect()}
    assert (got[8], got[9], got[10], got[0], got[7]) == (0, 1, 2, 0, 0)
    full = {r.n: r.k for r in df.select("n", F.size(decontam.ngrams(F.col("w"), 8, True)).alias("k")).collect()}
    assert (full[8], full[10]) == (1, 3)


def test_verification_rejects(spark):
    gram = " ".join("abcdefghi")
    train = spark.createDataFrame([(1, gram + " x y z"), (2, " ".join("abcdefghijklmnop"))], "id long, text string")
    bench = spark.createDataFrame([("b", 0, gram + " " + " ".join(str(i) for i in range(40)))], "benchmark string, eval_idx long, text string")
    found = decontam.shared_grams(train, bench)
    assert found.count() == 2
    assert decontam.verify(found, train, bench).count() == 0
    assert decontam.verify(found, train, bench, threshold=0.15).count() == 2


def test_paths(spark):
    df = spark.createDataFrame([({"b": [{"c": "x"}]},)], "a struct<b:array<struct<c:string>>>")
    assert df.select(nested_get(df, "a.b[0].c").alias("v")).head().v == "x"
    for path in ("a.b[1].c", "a.z", "a.b.c", "q[0]"):
        assert df.select(nested_get(df, path).alias("v")).head().v is None
    out = nested_set(df, "a.b[0].c", F.lit("y"))
    assert out.head().a.b[0].c == "y"


def test_correlations(spark):
    truth, scores = [2, 4, 9, 1, 5, 3, 6, 7, 8], [2.0, 4.0, 9.0, 1.0, 6.0, 3.0, 5.0, 8.0, 7.0]
    df = spark.createDataFrame([("s", i, t, s) for i, (t, s) in enumerate(zip(truth, scores))], "k string, i int, t int, s double")
    assert judge.spearman(df, ["k"], "t", "s").head().spearman == pytest.approx(1 - 6 * 4 / (9 * 80))
    assert judge.kendall(df, ["k"], "t", "s").head().kendall == pytest.approx(1 - 4 / 36)


def test_published_chi_square(spark):
    counts = [7201, 5908, 5643, 4377, 3438, 2930, 2875, 2996, 2435, 2197]
    df = spark.createDataFrame([(i + 1, n) for i, n in enumerate(counts)], "p int, n int").select("p", F.explode(F.sequence(F.lit(1), F.col("n"))))
    assert round(judge.chi_square(df, "p", 10).head().chi_square, 4) == 6540.7155
    assert judge.chi_square_p(3.841458820694124, 1) == pytest.approx(0.05)
    assert judge.chi_square_p(5.991464547107979, 2) == pytest.approx(0.05)
    assert judge.chi_square_p(7.814727903251179, 3) == pytest.approx(0.05)


def test_pair_logprobs():
    t = lambda w, *top: {"token": w, "logprob": -0.1, "top_logprobs": [{"token": a, "logprob": b} for a, b in top]}
    assert judge.pair_logprobs([t("<think>"), t("A"), t("</think>"), t(" B", ("B", -0.2), ("A", -2.0))]) == (-2.0, -0.2)
    assert judge.pair_logprobs([t("A", ("A", -0.5))]) == (-0.5, -math.inf)
    assert judge.pair_logprobs([t("x")]) == (-10.0, -10.1)


def test_odd_even_sorts():
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 9):
        items = [rng.randint(0, 20) for _ in range(n)]
        order, _ = judge.odd_even(items, lambda a, b: a >= b)
        assert [items[i] for i in order] == sorted(items, reverse=True)


def test_linearise(spark):
    p = lambda kind, content="", name="", args="", answers=(): (kind, content, name, args, list(answers), {})
    parts = [p("thought", "t"), p("function-call", name="f", args="{}"), p("function-output", "1"), p("response", "r"), p("verifiable-responses", answers=["4"])]
    broken = [p("function-call", name="f"), p("response", "lost")]
    double = [p("function-call", name="f"), p("function-output", "1"), p("function-output", "2"), p("response", "after")]
    rows = [("a", parts), ("b", broken), ("c", double)]
    schema = f"conversation_id string, system_prompt {RECORD['system_prompt']}, initial_prompt {RECORD['initial_prompt']}, available_functions {RECORD['available_functions']}, conversation_branches {RECORD['conversation_branches']}"
    params = '{"type": "object", "properties": {"x": {"type": "integer"}}, "required": true}'
    df = spark.createDataFrame([(k, ("sys", {}), ("user", "q", {}), [("f", "d", params)], [([("assistant", ps)],)]) for k, ps in rows], schema)
    got = {r.conversation_id: r.messages for r in linearise.linearise(df).collect()}
    assert [m.role for m in got["a"]] == ["system", "developer", "user", "assistant"]
    assert [b.type for b in got["a"][3].blocks] == ["thoughts", "tool_calls", "tool_outputs", "response", "tool_calls", "tool_outputs"]
    tools = json.loads(got["a"][1].tools)
    assert [t["name"] for t in tools] == ["f", "display_answers"] and tools[0]["parameters"]["required"] == ["x"]
    assert got["a"][1].has_thinking and "x: number" in got["a"][1].formatted_tools
    assert [b.type for b in got["b"][3].blocks] == ["tool_calls"]
    assert [b.type for b in got["c"][3].blocks] == ["tool_calls", "tool_outputs"]
    kept = {r.conversation_id: r.messages for r in linearise.linearise(df, keep_parallel=True).collect()}
    assert [len(b.outputs) for b in kept["c"][3].blocks] == [0, 2, 0]


def test_harmonising_twice_changes_nothing(spark):
    df = spark.createDataFrame([(1, "hello", "x")], "id int, prompt string, answer string")
    rec = convert.prompt_answers(df, "a/b", F.col("prompt"), [F.col("answer")])
    once = mixture.harmonise(rec)
    assert mixture.harmonise(once).collect() == once.collect()
    assert once.head().system_prompt.content == ""


def test_schema_tools(spark):
    a, b = {"x": None, "m": {}}, {"x": "str", "m": {"k": "int"}, "l": [None]}
    merged = profile.merge_skeletons(a, b)
    assert merged == {"x": "str", "m": {"k": "int"}, "l": [None]}
    assert profile.fill_unknown({"metadata": None, "tags": None, "q": None}) == {"metadata": {}, "tags": [], "q": "str"}
    df = spark.createDataFrame([(1, "yes", None)], "a int, b string, c string")
    assert tuple(profile.uniform(df, {"a": "str", "b": "bool", "c": "str", "d": {"e": "int"}, "f": ["str"]}).head()) == ("1", True, "", (0,), [])


def test_swapped_and_tagged(spark):
    df = spark.createDataFrame([("SYSTEM: s\nUSER: a\nmore\nASSISTANT: b",)], "t string")
    got = df.select(convert.tagged_turns(F.col("t"), {"SYSTEM": "system", "USER": "human", "ASSISTANT": "gpt"}).alias("x")).head().x
    assert [(r["from"], r.value) for r in got] == [("system", "s"), ("human", "a\nmore"), ("gpt", "b")]


def test_lift_prompt(spark):
    df = spark.createDataFrame([("r", "q")], "a string, b string")
    rec = convert.prompt_answers(df, "s", F.col("b"), [F.col("a")])
    moved = rec.withColumn("initial_prompt", F.lit(None).cast(RECORD["initial_prompt"])).withColumn("conversation_branches", F.transform("conversation_branches", lambda x: x.withField("messages", F.transform(x["messages"], lambda m: m.withField("role", F.lit("user"))))))
    out = annotate.lift_prompt(moved).head()
    assert out.initial_prompt.content == "r" and out.conversation_branches[0].messages == []


def test_think_parts(spark):
    df = spark.createDataFrame([("<think>a</think>b<THINK >c</think >",)], "a string")
    rec = convert.prompt_answers(df, "s", F.lit("q"), [F.col("a")])
    out = rec.withColumn("conversation_branches", annotate.think_parts(F.col("conversation_branches")))
    parts = out.head().conversation_branches[0].messages[0].parts
    assert [(p.type, p.content) for p in parts] == [("thought", "a"), ("thought", "c"), ("response", "b")]


TASKS = "conversation_id string, branch int, message int, part int, question string, answer string"


def test_classifier_falls_back_and_resumes(spark):
    tasks = spark.createDataFrame([("c", 0, 0, i, "{q}", str(i)) for i in range(4)], TASKS)

    def ask(text):
        assert text.startswith("Q: {q}\n")
        a = text[-1]
        if a == "2":
            raise OSError("down")
        return {"0": '{"classification": "refusal", "reasoning": "says \\so"}', "3": "```refusal```".strip("`")}.get(a, "what")

    got = {r.part: r for r in annotate.classify(tasks, annotate.LABELS["refusal"], ask, template="Q: {question}\n{answer}", attempts=2, pause=0.01).collect()}
    assert (got[0].classification, got[0].reasoning, got[0].success, got[0].error) == ("refusal", "says \\so", True, None)
    assert (got[1].classification, got[1].success, got[1].error) == ("no_refusal", False, "not a label: what")
    assert got[2].error == "down" and got[3].classification == "refusal"
    assert annotate.pending(tasks, tasks.limit(1)).count() == 3


def test_classifier_pauses_and_lets_other_errors_through(spark, tmp_path):
    tasks = spark.createDataFrame([("c", 0, 0, 0, "q", "a")], TASKS)

    def late(text):
        seen = len(list(tmp_path.iterdir()))
        (tmp_path / str(seen)).write_text(str(time.time()))
        if seen < 2:
            raise OSError("not yet")
        return "refusal"

    assert annotate.classify(tasks, annotate.LABELS["refusal"], late, pause=0.1).head().success
    at = [float((tmp_path / str(k)).read_text()) for k in range(3)]
    assert at[1] - at[0] >= 0.1 and at[2] - at[1] >= 0.2

    def broken(text):
        raise KeyError("a fault of the client")

    with pytest.raises(Exception, match="a fault of the client"):
        annotate.classify(tasks, annotate.LABELS["refusal"], broken).collect()


def test_results_of_models_add_up(spark):
    rec = convert.prompt_answers(spark.createDataFrame([("a", "q")], "a string, q string"), "s", F.col("q"), [F.col("a")])
    own = annotate.Classifier("refusal", annotate.LABELS["refusal"], annotate.identity_tasks)
    out = own.run(own.run(rec, lambda t: "refusal", "m1"), lambda t: "what", "m2", attempts=1).head()
    said = out.conversation_branches[0].messages[0].parts[0].metadata
    assert json.loads(said["refusal_classification.m1"]) == {"classification": "refusal", "reasoning": ""}
    assert json.loads(said["refusal_classification.m2"])["error"] == "not a label: what"
    assert set(out.initial_prompt.metadata) == set(said)


def test_languages_are_learned(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = annotate.train_languages(d, "text", "lang", "doc_id", sample_rows=60)
    rows = annotate.annotate_language(d, F.col("text"), lambda: model).where("length(text) > 40").select((F.col("languages")[0]["label"] == F.col("lang")).alias("good"))
    assert rows.agg(F.avg(F.col("good").cast("double"))).head()[0] > 0.95
    assert model("") == [("unknown", 0.0)] or model("")[0][1] <= 1.0
    assert annotate.train_languages(d.limit(0), "text", "lang", "doc_id")("x") == [("unknown", 0.0)]


def test_language_scores_against_a_plain_sum():
    rng = random.Random(5)
    grams = {k: {"".join(rng.choice("abé 😀") for _ in range(3)): -rng.random() * 9 for _ in range(60)} for k in ("xx", "yy", "zz")}
    model = annotate.LanguageModel(grams, math.log(1e-7))
    for _ in range(200):
        text = "".join(rng.choice("abé 😀q") for _ in range(rng.randint(0, 40)))
        low = f" {text.lower()} "
        found = [low[i : i + 3] for i in range(len(low) - 2)]
        got = model(text)
        if not found:
            assert got == [("unknown", 0.0)]
            continue
        sums = {k: sum(g.get(x, model.unseen) for x in found) for k, g in grams.items()}
        whole = sum(math.exp(s - max(sums.values())) for s in sums.values())
        want = sorted(((k, math.exp(s - max(sums.values())) / whole) for k, s in sums.items()), key=lambda x: (-x[1], x[0]))
        assert [k for k, _ in got] == [k for k, _ in want] and [p for _, p in got] == pytest.approx([p for _, p in want])


def test_language_failures_are_marked(spark):
    def fails(text):
        raise RuntimeError("no model")

    d = spark.createDataFrame([("x",), ("",), (None,)], "t string")
    assert [r.languages[0].label for r in annotate.annotate_language(d, F.col("t"), lambda: fails).collect()] == ["error", "unknown", "unknown"]


def test_large_benchmarks_take_the_shuffled_way(spark):
    words = [f"w{i}" for i in range(40)]
    train = spark.createDataFrame([(1, " ".join(words[:20])), (2, " ".join(words[25:])), (3, "x y"), (None, " ".join(words[:9])), (4, None)], "id long, text string")
    bench = spark.createDataFrame([("b", 0, " ".join(words[2:14])), ("b", 1, "nothing here")], "benchmark string, eval_idx long, text string")
    rows = lambda **o: sorted(map(tuple, decontam.shared_grams(train, bench, n=8, **o).collect()), key=repr)
    assert rows() == rows(most_rows=0) == rows(most_rows=0, most_bits=64) == [(1, "b", 0, 4)]
    assert [r.id for r in decontam.candidates_only(train, bench).collect()] == [1]
    plan = decontam.shared_grams(train, bench)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_reports_are_kept_unless_asked(spark, tmp_path):
    at = f"file://{tmp_path}/reports"
    found = lambda rows: spark.createDataFrame(rows, "benchmark string, id long, eval_idx long")
    read = lambda df: sorted((r.benchmark, r.id) for r in df.collect())
    assert read(decontam.write_reports(found([("a", 1, 0)]), at)) == [("a", 1)]
    assert read(decontam.write_reports(found([("a", 2, 0), ("b", 3, 0)]), at)) == [("a", 1), ("b", 3)]
    assert read(decontam.write_reports(found([("a", 2, 0)]), at, overwrite=True)) == [("a", 2), ("b", 3)]


def test_reports_of_a_folder(spark, tmp_path):
    for name, text in {"a b": '{"x1": {"k": 1}, "x2": {}}', "none": "{}", "bad": "{broken"}.items():
        (tmp_path / f"{name}__contamination_report.json").write_text(text)
    found, broken = io.read_reports(spark, f"file://{tmp_path}")
    assert sorted(map(tuple, found.collect())) == [("a b", "x1"), ("a b", "x2")] and broken == ["bad"]


def test_benchmark_grams_are_made_once(spark, tmp_path):
    bench = spark.createDataFrame([("b", 0, "a b c d")], "benchmark string, eval_idx long, text string")
    at = f"file://{tmp_path}/cache"
    first = decontam.bench_grams(bench, at, "b", n=2).count()
    assert first == decontam.bench_grams(bench.limit(0), at, "b", n=2).count() == 2
    assert decontam.bench_grams(bench, at, "b", n=3).count() == 1


def test_unreadable_benchmarks_are_skipped_if_asked(spark):
    good = spark.createDataFrame([("q", None)], "a string, b string")
    tables = [("x", lambda: spark.read.parquet("file:///nowhere"), ["a"], "test"), ("y", good, ["a", "b"], "test"), ("z", good, ["c"], "test")]
    assert [(r.benchmark, r.prompt) for r in io.gather_prompts(tables, skip=True).collect()] == [("y", "q")]
    with pytest.raises(Exception, match="nowhere"):
        io.gather_prompts(tables)
    assert io.gather_prompts(tables[:1], skip=True).count() == 0


def test_report_page(spark):
    rows = spark.createDataFrame([(True, 0, 1.0, 0.5, 3, 10), (False, 1, None, None, None, 5)], "success boolean, retries int, spearman double, kendall double, hits int, tokens int")
    page = judge.report(judge.overall(rows), "ranking", "m")
    assert "| mean spearman | +1.000 |" in page and "| total tokens | 15 |" in page


def test_rows_are_numbered_whatever_the_key(spark):
    rows = [("hot", i) for i in range(900)] + [(None, i) for i in range(50)] + [(f"k{i}", i) for i in range(50)]
    df = spark.createDataFrame(rows, "s string, i long")
    got = split.row_numbers(df, "s", "i", groups=8)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r.s, r.i) for r in got.orderBy("n").collect()] == want and sorted(r.n for r in got.collect()) == list(range(1000))
    largest = df.repartitionByRange(8, "s", "i").groupBy(F.spark_partition_id().alias("g")).count().agg(F.max("count")).head()[0]
    assert largest < 350  # the hot first key is cut apart
    within = split.row_numbers(df, "i", by=["s"], groups=8)
    assert {(r.s, r.i): r.n for r in within.collect()} == {(s, i): sum(1 for t, j in rows if t == s and j < i) for s, i in rows}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0]  # only the ranges' counts are summed in one task
    assert split.ranges(df) == df.sparkSession.sparkContext.defaultParallelism
    assert split.ranges(spark.range(1 << 40)) == 65_536  # 8 TB


def test_mixtures_that_contain_each_other_raise():
    with pytest.raises(ValueError, match="a > b > a"):
        mixture.resolved({"a": [{"mixture": "b"}], "b": [{"mixture": "a"}]}, "a")


def test_degradation_goes_on_where_it_stopped(spark, tmp_path):
    seen = tmp_path / "asked"
    seen.mkdir()

    def ask(text):
        (seen / uuid.uuid4().hex).write_text(text)
        return f"REASONING: step\nCOMPLETION: {text.rsplit('|', 1)[1]}!"

    samples = spark.createDataFrame([("s", "q", ["a"], [])], "id string, question string, completions array<string>, reasonings array<string>")
    run = lambda steps: judge.degrade(samples, ask, steps, f"file://{tmp_path}/steps", "{question}|{history}|{latest}").head()
    assert run(1).completions == ["a", "a!"] and len(list(seen.iterdir())) == 1
    out = run(3)
    assert (out.completions, out.reasonings, out.iteration) == (["a", "a!", "a!!", "a!!!"], ["step"] * 3, 3) and len(list(seen.iterdir())) == 3
    assert any("ITERATION 1 (Previous Reasoning: step):" in f.read_text() for f in seen.iterdir())


def test_spread_sample_fills_up(spark):
    got = [r.id for r in profile.spread_sample(spark.range(25), 10, "id").collect()]
    assert len(got) == len(set(got)) == 10 and set(range(0, 20, 2)) == set(got)
    assert profile.spread_sample(spark.range(5), 10, "id").count() == 5
    assert profile.spread_sample(spark.range(0), 10, "id").count() == 0


def test_even_parts_of_ten(spark):
    sizes = split.even_parts(spark.range(10), 4, "id").groupBy("part").count().orderBy("part").collect()
    assert [r["count"] for r in sizes] == [3, 3, 2, 2]
    assert split.even_parts(spark.range(0), 4, "id").count() == 0


def test_files(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert io.read_lines(spark, str(tmp_path / "x.jsonl"), "a long").count() == 2
    batch = pa.record_batch({"a": [1, 2], "b": ["x", None]})
    for name in ("one", "two"):
        with pa.ipc.new_stream(str(tmp_path / f"{name}.arrow"), batch.schema) as w:
            w.write_batch(batch)
    assert io.read_arrow(spark, f"file://{tmp_path}").count() == 4
    out = f"file://{tmp_path}/saved"
    io.save(spark.range(4).withColumn("split", F.lit("train")), out, {"step": "one"}, partition_by=["split"])
    io.save(spark.read.parquet(out), f"{out}2", {"step": "two"}, before=out)
    assert [s["step"] for s in io.lineage(spark, f"{out}2")] == ["one", "two"]


def test_stream_is_done_once(spark, tmp_path):
    src, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    spark.createDataFrame([(1, "a openai b")], "id long, t string").write.parquet(src)
    change = lambda df: df.withColumn("hit", F.size(T.keywords_in(F.col("t"))) > 0)
    for _ in range(2):
        q = ingest.annotate(ingest.follow(spark, src, "id long, t string"), change, out, f"{tmp_path}/check")
        q.awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(out).collect()] == [(1, "a openai b", True)]


def test_benchmarks_that_break_while_they_are_read_are_skipped(spark, tmp_path):
    good = spark.createDataFrame([("q", None)], "a string, b string")
    os.makedirs(f"{tmp_path}/bad")
    with open(f"{tmp_path}/bad/part-0.parquet", "wb") as f:
        f.write(b"PAR1 this is no table PAR1")
    broken = lambda: spark.read.schema("a string").parquet(f"file://{tmp_path}/bad")
    tables = [("x", broken, ["a"], "test"), ("y", good, ["a"], "test")]
    assert [(r.benchmark, r.prompt) for r in io.gather_prompts(tables, skip=True).collect()] == [("y", "q")]
    with pytest.raises(Exception):
        io.gather_prompts(tables).collect()


def test_a_member_of_a_struct_that_is_null_can_be_set(spark):
    df = spark.sql("SELECT CAST(NULL AS STRUCT<x: INT, y: STRUCT<z: STRING>>) AS a, array(named_struct('k', 1, 'm', 'u')) AS l")
    out = nested_set(nested_set(df, "a.y.z", F.lit("new")), "l[2].k", F.lit(7)).head()
    assert out.a.asDict(True) == {"x": None, "y": {"z": "new"}}
    assert [x and x.asDict() for x in out.l] == [{"k": 1, "m": "u"}, None, {"k": 7, "m": None}]


def test_a_failing_call_fails_for_its_sample_alone(spark, tmp_path):
    def ask(text):
        if "bad" in text:
            raise OSError("gone")
        return "REASONING: worse COMPLETION: less"

    rows = spark.createDataFrame([(1, "good", ["c"], []), (2, "bad", ["c"], [])], "id int, question string, completions array<string>, reasonings array<string>")
    got = {r.id: (r.completions, r.iteration) for r in judge.degrade(rows, ask, 2, f"file://{tmp_path}/steps", "{question}").collect()}
    assert got == {1: (["c", "less", "less"], 2), 2: (["c"], 2)}
