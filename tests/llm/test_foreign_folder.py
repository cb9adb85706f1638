import public_tokenizers
import pytest

from quarry.llm.common import shared_root
from tests.test_foreign_folder import run


def test_operators_on_a_users_table(tmp_path, monkeypatch):
    monkeypatch.setenv("FOREIGN_PATH", public_tokenizers.__path__[0].rsplit("/", 1)[0])
    run("""
from quarry.llm import additive_ann, centroids, media, packing, periodic_runs, repeats, simhash, compression_quality, mixing, toxicity
import public_tokenizers
assert simhash.near_duplicates(df).count() == 2
assert repeats.remove_repeats(df).count() == 2
assert packing.pack_documents(df, public_tokenizers.path("word_bpe_49k.json")).count() == 2
assert media.round_trip(df).count() == 2
assert additive_ann.neighbours(df, lambda k: k == 1, id_col="doc_id").count() == 1
labels = df.select("doc_id", (F.col("doc_id") - 1).cast("int").alias("quality"))
assert compression_quality.score(df, compression_quality.train(df, labels)).count() == 2
assert mixing.mix(df, df.select("doc_id", F.lit("a").alias("domain")), {"a": 1.0})[0].count() == 2
assert periodic_runs.periodic_runs(df).count() == 2
assert toxicity.score(df, toxicity.train(df, labels, label_col="quality")).count() == 2
assert centroids.cluster(df.select("doc_id", F.array(F.col("doc_id"), F.lit(1.0)).alias("embedding")), id_col="doc_id", dimension=2).count() == 2
""", tmp_path)


def test_a_cluster_without_a_shared_folder_raises(spark, monkeypatch):
    class Conf:
        def get(self, *a):
            return None

    class Context:
        master, _quarry_shipped = "spark://host:7077", "yes"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())
