"""Structured Streaming wrappers of the batch operators (STR-01, STR-02; ours, not the reference's).

* ``versioned_ingest`` (STR-01): landed files -> ``foreachBatch`` running the versioned load.
  Each micro-batch is a load named by the stream's own id (kept in its checkpoint, so the same after
  a restart and another for every new checkpoint) and the epoch. ``LoadLog`` records it with its
  instant before anything is appended: a replay is the same load with the same stamp, and
  ``roll_back_load`` takes back exactly one load.
* ``run_latest_to_table`` (STR-02): latest version per key, reduced inside each micro-batch and
  merged into the stored table by the version order. Nothing is kept in state between batches.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hydromart.operators.tables import rollback_table, table_exists, upsert, write_table
from hydromart.operators.versions import latest_versions, load_versioned
from hydromart.session import checkpoint_dir


LOG_SCHEMA = "load_id string, inserted_at timestamp, state string, n_rows long"
STARTED, DONE, ROLLED_BACK = "started", "done", "rolled back"


class LoadLog:
    """The loads of a raw table: one row per load, with its instant and state."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        if table_exists(self.spark, self.path):
            return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
        return self.spark.createDataFrame([], LOG_SCHEMA)

    def find(self, load_id: str):
        return self.read().where(F.col("load_id") == load_id).first()

    def record(self, load_id: str, inserted_at: dt.datetime, state: str, n_rows: int | None = None) -> None:
        row = self.spark.createDataFrame([(load_id, inserted_at, state, n_rows)], LOG_SCHEMA)
        write_table(upsert(self.read(), row, ["load_id"]), self.path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint; restarts keep it."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def roll_back_load(spark: SparkSession, raw_path: str, log: LoadLog, load_id: str, partition_by: Sequence[str] = ()) -> None:
    """Take back the rows of one load, and no others; earlier versions become current again."""
    held = log.find(load_id)
    if held is None:
        raise ValueError(f"no such load: {load_id}")
    if table_exists(spark, raw_path):
        rollback_table(spark, raw_path, load_id, partition_by, inserted_at=held.inserted_at)
    log.record(load_id, held.inserted_at, ROLLED_BACK)


def load_once(spark: SparkSession, raw_path: str, df: DataFrame, source: str, load_id: str, log: LoadLog,
              partition_by: Sequence[str] = ()) -> int:
    """One versioned load under a fixed name. A load that was cut short runs again with its first stamp and
    appends what is missing; one that is done, or was rolled back on purpose, is not repeated."""
    held = log.find(load_id)
    if held is not None and held.state != STARTED:
        return 0
    stamp = held.inserted_at if held is not None else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if held is None:
        log.record(load_id, stamp, STARTED)
    load_versioned(spark, raw_path, df, source, load_id, inserted_at=stamp, partition_by=partition_by)
    n = 0
    if table_exists(spark, raw_path):
        n = spark.read.parquet(raw_path).where(F.col("batch_id") == load_id).count()
    log.record(load_id, stamp, DONE, n)
    return n


def versioned_ingest(spark: SparkSession, landing: str, schema: StructType, raw_path: str, source: str,
                     checkpoint: str | None = None, fmt: str = "json",
                     available_now: bool = True, files_per_load: int | None = None) -> StreamingQuery:
    """STR-01: stream landed files into the versioned raw table at ``raw_path``.

    Each micro-batch is one load: two contents for one key in it are refused like in any batch.
    ``files_per_load`` limits the files of a load (unlimited by default). The loads are logged in
    ``raw_path`` + ``.loads``; a micro-batch re-run after a failure is the same load (``load_once``).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_load:
        reader = reader.option("maxFilesPerTrigger", files_per_load)
    stream = reader.load(landing)

    checkpoint = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/versioned-ingest"

    def per_batch(df: DataFrame, epoch_id: int) -> None:
        s = df.sparkSession
        load_once(s, raw_path, df, source, f"stream-{stream_id(s, checkpoint)}-{epoch_id}", LoadLog(s, f"{raw_path.rstrip('/')}.loads"))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_latest_to_table(spark: SparkSession, stream: DataFrame, keys: Sequence[str], order: Sequence[str],
                        out_path: str, checkpoint: str, date: str = "date") -> StreamingQuery:
    """STR-02: keep the current row of every key in a Parquet table partitioned by month of ``date``.

    Runs to completion over what is available. Each micro-batch is reduced to one row per key, then
    compared with the stored rows of the months it touches: of the old and the new row the later in
    version order stays, so a late older version never replaces a newer one, a replayed batch
    changes nothing, and no state grows with the keys. ``date`` must be one of ``keys``.
    """
    if date not in keys:
        raise ValueError(f"{date} must be one of the keys: a key may not move between months")

    def merge(df: DataFrame, epoch_id: int) -> None:
        s = df.sparkSession
        batch = latest_versions(df, keys, order).withColumn("mois", F.date_format(date, "yyyy-MM"))
        if table_exists(s, out_path):
            months = batch.select(F.col("mois").alias("_mois")).distinct()
            stored = s.read.parquet(out_path).join(months, F.col("mois").eqNullSafe(F.col("_mois")), "left_semi")
            batch = latest_versions(stored.select(*batch.columns).unionByName(batch), keys, order)
        write_table(batch, out_path, ["mois"], dynamic=True)

    q = (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
