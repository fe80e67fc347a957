"""Secret scans over a content-addressed ledger of text versions.

Every version of a text is a blob named by its SHA-256. The ledger keeps one row per scanned
(blob, rule version) with the spans found; a run scans only the pairs that it lacks, appends them
in one write, and joins the spans back to all rows that hold the blob. Raising the rule version
scans every blob once more; the old rows stay.

A blob held by a third of all rows is one row per map task after the local dedup, and the join
back only carries ids and digests (AQE splits the hot blob there).

Defined results: null text is the empty blob; repeated rows each get the findings; an empty table
gives no rows; columns other than the key columns and ``text`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch

RULE_VERSION = "1"
KINDS = ("assign", "access", "hex")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# Fixed patterns of the contract. The shorter forms below match the same spans: a run of hex digits
# is maximal anyway, and a short AKIA run holds no longer one.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_ASSIGN_MIN = 12
DELIVERIES = 2  # parts in which the registered query brings the documents to its ledger


def spans_of(text: str) -> list[dict]:
    """Spans of one text by start, then kind; offsets in code points, end exclusive."""
    found = []
    low = text.lower()
    if any(word in low for word in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= _ASSIGN_MIN]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(found)]


def _blob(text: str = "text"):
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("blob")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = [spans_of(t.as_py() or "") for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], names=["blob", "spans"])


class BlobLedger:
    """The ledger table at ``path``: (blob, rule_version, spans)."""

    SCHEMA = f"blob binary, rule_version string, spans {SPANS}"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.spark.createDataFrame([], self.SCHEMA).write.mode("append").parquet(path)

    def rows(self, rule_version: str) -> DataFrame:
        return (self.spark.read.schema(self.SCHEMA).parquet(self.path)
                .where(F.col("rule_version") == rule_version).select("blob", "spans"))

    def scan_unseen(self, versions: DataFrame, rule_version: str = RULE_VERSION) -> None:
        """Scan the blobs of ``versions(text)`` that this rule version has not seen, and record them."""
        blobs = versions.select(_blob(), "text").dropDuplicates(["blob"])
        unseen = blobs.join(self.rows(rule_version).select("blob"), "blob", "left_anti")
        (unseen.mapInArrow(_scan, f"blob binary, spans {SPANS}")
         .withColumn("rule_version", F.lit(rule_version)).select("blob", "rule_version", "spans")
         .write.mode("append").parquet(self.path))

    def findings(self, versions: DataFrame, key: str, rule_version: str = RULE_VERSION) -> DataFrame:
        """(key, spans) for every row of ``versions``, once its blobs are scanned."""
        paths = versions.select(F.col(key), _blob())
        return paths.join(self.rows(rule_version), "blob", "left").select(key, "spans")


def scan_secrets(docs: DataFrame, ledger: BlobLedger, key: str = "doc_id",
                 rule_version: str = RULE_VERSION) -> DataFrame:
    """(key, spans) per row of ``docs``; scans what the ledger lacks first."""
    ledger.scan_unseen(docs, rule_version)
    return ledger.findings(docs, key, rule_version)


def span_text(spans):
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scan_deliveries(docs: DataFrame, ledger: BlobLedger, deliveries: int, key: str = "doc_id",
                    rule_version: str = RULE_VERSION) -> DataFrame:
    """(key, spans) per row of ``docs``, delivered to the ledger in parts by a hash of the key.

    A blob that an earlier part brought is not scanned again; the findings of all parts come from the
    one ledger.
    """
    for part in range(deliveries):
        ledger.scan_unseen(docs.where(F.pmod(F.xxhash64(key), F.lit(deliveries)) == part), rule_version)
    return ledger.findings(docs, key, rule_version)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ledger = BlobLedger(spark, Scratch(spark, "secrets").path("ledger"))
    found = scan_deliveries(docs, ledger, DELIVERIES)
    count = [count_kind(F.col("spans"), k).alias(f"n_{k}") for k in KINDS]
    text = span_text(F.col("spans"))
    return found.select("doc_id", *count, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))
