"""Month-by-month backfill driven by the ledger (VER-11, VER-12): resumable after any interruption.

The driver loops over the months that the ledger lacks (a few hundred at most); every month is one
versioned load. A month is recorded only after its append, so an interruption between the two
repeats that month: the versioned load then finds every row unchanged and appends nothing, and the
ledger still gets the month with the number of its rows. Nothing is loaded twice or skipped.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.operators import tables
from hydromart.operators.versions import ledger_upsert, load_versioned, month_chunks, pending_chunks

LEDGER_SCHEMA = "grandeur_hydro_elab string, mois date, nb_lignes long, termine_le timestamp"


class Ledger:
    """The stored ledger of finished (measure, month) chunks."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        if tables.table_exists(self.spark, self.path):
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def record(self, measure: str, month: dt.date, n_rows: int, finished_at=None) -> None:
        done = self.spark.createDataFrame([(measure, month, n_rows)], "grandeur_hydro_elab string, mois date, nb_lignes long")
        tables.write_table(ledger_upsert(self.read(), done, finished_at), self.path)


def run_backfill(spark: SparkSession, measure: str, start, end, chunk: Callable[[dt.date, dt.date], DataFrame],
                 raw_path: str, ledger: Ledger, source: str = "river", content: Sequence[str] | None = None,
                 partition_by: Sequence[str] = ("mois",), loaded_at: Callable[[dt.date], object] | None = None,
                 after: Callable[[str, dt.date], None] | None = None) -> list[dt.date]:
    """Load the months between ``start`` and ``end`` that the ledger lacks, oldest first; the months loaded now.

    ``chunk(first, last)`` gives the rows of one month's days. ``loaded_at(month)`` gives the load
    instant (default: now). ``after(step, month)`` is called behind each ``"append"`` and ``"record"``
    (progress reports; tests stop the run there).
    """
    day = lambda x: dt.date.fromisoformat(x) if isinstance(x, str) else x
    window = spark.createDataFrame([(measure, day(start), day(end))], "grandeur_hydro_elab string, start_date date, end_date date")
    todo = pending_chunks(month_chunks(window), ledger.read(), ["grandeur_hydro_elab", "mois"]).orderBy("mois").collect()
    done = []
    for row in todo:
        month = row.mois
        rows = chunk(row.chunk_start, row.chunk_end)
        load_versioned(spark, raw_path, rows, source, f"backfill-{measure}-{month:%Y-%m}",
                       loaded_at(month) if loaded_at else None, content=content, partition_by=partition_by)
        if after:
            after("append", month)
        ledger.record(measure, month, rows.count(), loaded_at(month) if loaded_at else None)
        done.append(month)
        if after:
            after("record", month)
    return done


def missing_months(raw: DataFrame, ledger: DataFrame, date: str, measure_col: str = "grandeur_hydro_elab") -> DataFrame:
    """Months whose rows and ledger disagree: (measure, mois, nb_lignes recorded, n_rows stored)."""
    stored = (raw.groupBy(F.col(measure_col).alias("grandeur_hydro_elab"), F.trunc(date, "MM").alias("mois"))
              .agg(F.count(F.lit(1)).alias("n_rows")))
    both = ledger.select("grandeur_hydro_elab", "mois", "nb_lignes").join(stored, ["grandeur_hydro_elab", "mois"], "full")
    return both.where(~F.coalesce("nb_lignes", F.lit(0)).eqNullSafe(F.coalesce("n_rows", F.lit(0))))
