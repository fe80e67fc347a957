"""Tables stored by bucket of their keys (VER-05/06, SNK-04, SNK-09): joins without a shuffle of the history.

A bucketed table keeps the rows of a key in one of ``n`` files per load, so Spark reads it already
partitioned by the keys: the current-version aggregate, the version lookup and the MERGE of a load
shuffle the incoming rows only, however long the history is. The number of buckets belongs to the
table (choose at least the shuffle parallelism of the jobs that join it) and is stored beside the
data, so a later session, whose catalog is empty, attaches the same files with the same layout.

A load appends at most one file per bucket and task; ``compact`` rewrites a table as one file per
bucket. A new content is written beside the table and swapped in by the pointer file, so a failed
write leaves the old content in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.operators import tables, versions

_POINTER = "current.json"


class BucketedTable:
    """A table under ``root``, bucketed and sorted by ``keys``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], buckets: int, folder: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.buckets, self.folder = list(keys), buckets, folder

    # ------------------------------------------------------------------ files and catalog
    @property
    def path(self) -> str:
        return f"{self.root}/{self.folder}"

    @property
    def name(self) -> str:
        """The name under which this session's catalog knows the current files."""
        return f"bucketed_{self.folder}"

    @classmethod
    def create(cls, df: DataFrame, root: str, keys: Sequence[str], buckets: int | None = None) -> BucketedTable:
        """Store ``df`` as a new table; by default as many buckets as shuffle partitions."""
        spark = df.sparkSession
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = cls(spark, root, keys, n, uuid.uuid4().hex)
        table._write(df, "errorifexists")
        table._point()
        return table

    @classmethod
    def attach(cls, spark: SparkSession, root: str) -> BucketedTable:
        """A table stored earlier, maybe by another session."""
        text = spark.read.text(f"{root.rstrip('/')}/{_POINTER}", wholetext=True).first()[0]
        held = json.loads(text)
        table = cls(spark, root, held["keys"], held["buckets"], held["folder"])
        if not spark.catalog.tableExists(table.name):
            schema = spark.read.parquet(table.path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            keys_sql = ", ".join(f"`{k}`" for k in table.keys)
            spark.sql(f"CREATE TABLE {table.name} ({columns}) USING parquet CLUSTERED BY ({keys_sql}) "
                      f"SORTED BY ({keys_sql}) INTO {table.buckets} BUCKETS LOCATION '{table.path}'")
        return table

    def _point(self) -> None:
        jvm, fs = tables._files(self.spark, self.root)
        text = json.dumps({"keys": self.keys, "buckets": self.buckets, "folder": self.folder})
        stream = fs.create(jvm.org.apache.hadoop.fs.Path(f"{self.root}/{_POINTER}"), True)
        stream.write(bytearray(text.encode()))
        stream.close()

    def _write(self, df: DataFrame, mode: str) -> None:
        """One file per bucket and task; dealt by the keys first, so that is one file per bucket."""
        (df.repartition(self.buckets, *self.keys).write.mode(mode).format("parquet")
         .bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", self.path).saveAsTable(self.name))

    # ------------------------------------------------------------------ reading and writing
    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, df: DataFrame) -> None:
        """SNK-01: more rows; existing files stay untouched."""
        self._write(df.select(*self.read().columns), "append")
        self.spark.catalog.refreshTable(self.name)

    def replace(self, df: DataFrame) -> None:
        """New content, which may be computed from the old one: written beside it, then pointed at."""
        old_name, old_path = self.name, self.path
        columns = self.read().columns
        before, self.folder = self.folder, uuid.uuid4().hex
        try:
            self._write(df.select(*columns), "errorifexists")
            self._point()
        except Exception:
            self.folder = before
            raise
        self.spark.sql(f"DROP TABLE {old_name}")
        jvm, fs = tables._files(self.spark, old_path)
        fs.delete(jvm.org.apache.hadoop.fs.Path(old_path), True)

    def compact(self) -> None:
        """One file per bucket again, after many loads."""
        self.replace(self.spark.read.parquet(self.path))  # read without the buckets, so that the rows are dealt anew

    # ------------------------------------------------------------------ loads
    def load_changed(self, batch: DataFrame, order: Sequence[str]) -> DataFrame:
        """VER-04..06: the rows of ``batch`` (unique per key, with ``row_hash``) that differ from the current version."""
        dealt = batch.repartition(self.buckets, *self.keys)  # once, to the buckets; every later step finds it so
        return versions.plan_load(self.read(), dealt, self.keys, order)["to_append"]

    def append_changed(self, batch: DataFrame, order: Sequence[str]) -> int:
        """Append the changed versions; the number of rows added.

        The rows are computed before the append and counted from a checkpoint, so a replayed task
        cannot see rows that this load itself added.
        """
        versions.checkpoint_dir(self.spark)
        rows = self.load_changed(batch, order).checkpoint(eager=True)
        n = rows.count()
        if n:
            self.append(rows)
        return n

    def merged_changes(self, source: DataFrame, hash_col: str = "row_hash") -> DataFrame:
        """SNK-04: the content after a change-only MERGE, with ``_action``."""
        return tables.upsert_changed_only(self.read(), source.repartition(self.buckets, *self.keys), self.keys, hash_col)

    def merge(self, source: DataFrame, hash_col: str = "row_hash") -> dict[str, int]:
        """SNK-04 on the stored table; rows by action. Nothing is written when nothing changes."""
        versions.checkpoint_dir(self.spark)
        rows = self.merged_changes(source, hash_col).checkpoint(eager=True)
        counts = {r["_action"]: r["n"] for r in rows.groupBy("_action").agg(F.count(F.lit(1)).alias("n")).collect()}
        if set(counts) - {"keep"}:
            self.replace(rows.drop("_action"))
        return counts
