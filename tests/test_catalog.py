import pytest

from quarry.plans import annotations, catalog, converters, reports  # noqa: F401
from tests.oracle import answers, rows


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    got = rows(catalog.QUERIES[name](spark, sf))
    assert got == answers(catalog.ORACLES[name], sf)
    assert got[1]


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def documents(spark, tmp_path, texts):
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_boxed_extract_reads_whole_texts(spark, tmp_path):
    start = "words before the part that matters, over forty characters "
    at = documents(spark, tmp_path, [start + "\\boxed{x^{2}} end", start * 50 + "\\boxed{7}"])
    got = {r.doc_id: r for r in converters.boxed_extract(spark, at).collect()}
    assert [got[i].answers for i in (0, 1)] == ["x^{2}|a_{1}|en", "7|a_{1}|en"]
    assert all(len(got[i].text) > len(start * (1 + 49 * i)) for i in (0, 1))


def test_fence_split_reads_whole_texts(spark, tmp_path):
    start = "words before the part that matters, over forty characters"
    at = documents(spark, tmp_path, [start + "\n```python\nx = 1\n```\nmore"])
    got = [r.content or "" for r in converters.fence_split(spark, at).orderBy("n").collect()]
    assert any(start in x for x in got) and any("more" in x for x in got)
    assert len(got) > len(converters.fence_split(spark, documents(spark, tmp_path / "b", [start])).collect())
