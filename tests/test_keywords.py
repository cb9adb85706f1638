import random
import re
import time

from pyspark.sql import functions as F

from quarry.functions import text as T


def plain(text, keywords):
    return [k for k in keywords if re.search(r"(?<![^\W])" + re.escape(k.lower()) + r"(?![^\W])", (text or "").lower())]


def test_overlaps_prefixes_and_edges_against_one_pattern_each(spark):
    keywords = ["gpt", "gpt-4", "chat-gpt", "open", "open ai", "ai", "a.b", "ß", "GPT_x", "chat gpt", "c++", "++"]
    rng = random.Random(0)
    pieces = [*keywords, "chat", "gpt5", "-", " ", " ", "_", "x", "4", "é", ".", "+", "AI", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + ["chat-gpt-4", "open ai-gpt-4", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.k for r in df.select("i", T.keywords_in(F.col("t"), keywords).alias("k")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t, keywords), t
    assert sum(len(k) > 1 for k in got.values()) > 200


def test_a_thousand_keywords_cost_about_what_seventeen_do(spark):
    rng = random.Random(1)
    many = list({"".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 10))) for _ in range(1000)})
    texts = [" ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(400)) for _ in range(300)]
    texts += [" ".join(rng.sample(many, 5)) for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4).cache()
    df.count()

    def cost(keywords):
        best = 1e9
        for _ in range(3):
            begun = time.perf_counter()
            df.select(T.keywords_in(F.col("t"), keywords).alias("k")).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - begun)
        return best

    few, all_ = cost(many[:17]), cost(many)
    got = {r.i: r.k for r in df.select("i", T.keywords_in(F.col("t"), many).alias("k")).collect()}
    assert all(got[i] == [k for k in many if k in set(t.split())] for i, t in enumerate(texts))
    assert all_ < 4 * few + 0.5
