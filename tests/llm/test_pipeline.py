import os
import shutil
import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline
from hydromart.llm import decontaminate, lines, quality
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_simhash import brute as brute_groups

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == before.columns
    first = spark.read.parquet(f"{SF}/documents.parquet")
    scores = {r.doc_id: r.score for r in quality.score(first, quality.fit(first, spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
    assert set(kept["quality"]) == {i for i, s in scores.items() if s >= quality.THRESHOLD}
    text = lambda name: [(i, r.text) for i, r in sorted(kept[name].items())]
    assert text("line_dedup") == brute_lines(text("quality"), lines.MIN_DOCS)
    assert set(kept["simhash_dedup"]) == {c for _, _, c in brute_groups(text("line_dedup"))}
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = lambda t: any(item in decontaminate.normalise(t) for item in items)
    assert set(kept["decontaminate"]) == {i for i, t in text("simhash_dedup") if not holds(t)}
    assert set(kept["bpe"]) == set(kept["decontaminate"])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    judged = [(i in kept["quality"]) == bool(q) for i, q in labels.items() if i in scores]
    assert sum(judged) >= 0.9 * len(judged)


def test_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names
    assert corpus_pipeline.run(spark, SF).count() > 100


def _beside(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    assert corpus_pipeline.run(spark, _beside(spark, docs, tmp_path)).count() == 0


def test_nulls_repeated_ids_and_clashing_columns(spark, tmp_path):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(900001, None, "en", None, None), (900002, "", None, "src0", 0), (None, "no id", "en", "src1", 5),
                                 (900003, "two texts", "en", "src1", 9), (900003, "of one id", "en", "src1", 9)], given.schema)
    docs = given.unionByName(odd)
    for i, name in enumerate(("fp", "row", "score", "th", "root", "_lines", "_gone", "batch", "ids", "key", "component_id")):
        docs = docs.withColumn(name, F.lit(i))
    out = corpus_pipeline.run(spark, _beside(spark, docs, tmp_path)).collect()
    plain = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert out and {r.doc_id for r in out} - plain <= {900001, 900002, 900003, None}
    assert all(len(r.ids) == r.n_tokens for r in out)


def test_entry_works_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py",):
        shutil.copy(f"{REPO}/{name}", tmp_path)
    shutil.copytree(f"{REPO}/hydromart", tmp_path / "hydromart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q; print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert out.returncode == 0, out.stderr
