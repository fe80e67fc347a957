"""Corpus pipeline: quality, line dedup, SimHash near-dedup, decontamination, tokenisation.

Every stage takes the documents its predecessor kept and calls one operator of the library with
its production parameters. ``run`` writes each stage's result as Parquet under the shared
checkpoint folder and reads it again, so a lost executor never costs an earlier stage. The result
has no SQL oracle (the model and the XXH64 fingerprints have no SQL form); the tests hold it
against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm import bpe, decontaminate, lines, quality, simhash
from hydromart.llm.common import Scratch, release


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The classifier is fitted on the documents' labels; the documents it rejects go."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; ``text`` and ``n_chars`` change, no document goes."""
    return lines.drop_common_lines(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.keep_one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of the text that they decode to."""
    tokens = bpe.encode(docs, decoded=True)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                         F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_dedup", simhash_stage),
    ("decontaminate", benchmark_stage),
    ("bpe", token_stage),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        release(spark)
    return docs
