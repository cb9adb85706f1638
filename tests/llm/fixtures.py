"""Small tables with everything that can go wrong in them."""

import random

COMMON = ["tha", "of", "éa", "tion", "ing", "ever", "ou", "lan"]


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(COMMON) + rng.choice(COMMON) for _ in range(n))


def awkward(spark):
    """Nulls in all columns, empty and very long texts, repeated rows, clashing names."""
    rng = random.Random(3)
    long = words(rng, 20_000)
    base = words(rng, 60)
    rows = [
        (1, base, "en", "src0", 1), (1, base, "en", "src0", 1), (1, base + " more", None, None, None), (2, None, "en", "src0", 0), (3, "", None, "src1", 0), (4, " \n\t ", "de", "src1", 4),
        (None, base, "fr", None, 1), (None, None, None, None, None), (5, long, "en", "src2", 9), (6, long, "en", "src2", 9), (7, "a" * 300, "es", "src2", 300), (8, "one", "fr", "s", 3), (9, base[:150] + words(rng, 30), "en", "s", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("id", "t", "mark", "row", "fp", "payload", "rate", "quality_score", "uid", "length", "start", "component_id", "posterior", "tokens"):
        df = df.selectExpr("*", f"'clash' AS `{name}`")
    return df


def empty(spark):
    return awkward(spark).limit(0)
