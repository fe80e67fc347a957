"""Thresholds as mergeable state (AG-01, SNK-10): value counts per station, month and year.

The state of a set of readings is a table (station, month, year, value, n): how often each usable
value was read. States add up, so a delivery is aggregated alone and merged into the stored state
of the months that it touches; a corrected reading enters as one value less and another more. The
thresholds come from cumulative counts and equal those over all readings, at any number of
deliveries, without reading a reading twice.

The state is partitioned by month of year, so a merge rewrites the months of a delivery only. A
(station, month, year) holds at most as many values as readings, and the cumulative sum runs over
the distinct values of one station and month.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydromart.operators import tables, thresholds as th

KEYS = ("code_station", "mois", "annee", "valeur")


def state_of(obs: DataFrame, station: str = "code_station", date: str = "date_obs_elab", value: str = "resultat_obs_elab",
             qualification: str = "code_qualification", status: str = "code_statut",
             good_qualification: str = th.GOOD_QUALIFICATION, good_statuses: Sequence[str] = th.GOOD_STATUSES,
             sign: int = 1) -> DataFrame:
    """The state of ``obs``; with ``sign`` -1 the state that takes these readings away again."""
    usable = th.usable_observation(F.col(qualification), F.col(status), F.col(value), good_qualification, good_statuses)
    return (obs.where(usable)
            .groupBy(F.col(station).alias("code_station"), F.month(date).alias("mois"), F.year(date).alias("annee"),
                     F.col(value).alias("valeur"))
            .agg((F.count(F.lit(1)) * sign).alias("n")))


def merge_states(*states: DataFrame) -> DataFrame:
    """The sum of states; values that no reading has any more leave it."""
    union = states[0]
    for other in states[1:]:
        union = union.unionByName(other)
    return union.groupBy(*KEYS).agg(F.sum("n").alias("n")).where(F.col("n") != 0)


def state_problems(state: DataFrame) -> DataFrame:
    """Values taken away more often than they were read: a correction of an unknown reading."""
    return state.where(F.col("n") < 0)


def thresholds_of(state: DataFrame, quantiles: Sequence[float] = th.QUANTILES) -> DataFrame:
    """AG-01 from the state: the smallest value whose cumulative count reaches the share ``q`` of all.

    Shares are compared as decimals: 0.9 of 10 readings is the ninth, whatever a double makes of it.
    """
    per_value = state.groupBy("code_station", "mois", "valeur").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("code_station", "mois")
    counted = per_value.withColumns({
        "_upto": F.sum("n").over(whole.orderBy("valeur").rowsBetween(Window.unboundedPreceding, 0)),
        "_all": F.sum("n").over(whole)})
    limits = [F.min(F.when(F.col("_upto") >= F.col("_all") * F.lit(Decimal(str(q))), F.col("valeur"))).alias(f"p{round(q * 100)}")
              for q in quantiles]
    limits.append(F.max("_all").alias("n_reference"))
    years = state.groupBy("code_station", "mois").agg(F.size(F.collect_set("annee")).cast("long").alias("n_annees_reference"))
    return counted.groupBy("code_station", "mois").agg(*limits).join(years, ["code_station", "mois"])


class ThresholdState:
    """A stored state, partitioned by month of year."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).select(*KEYS, "n")

    def merge(self, *deltas: DataFrame) -> None:
        """Add states of deliveries and corrections; only the months that they touch are rewritten.

        The merge of a delivery is not idempotent by itself: record the delivery with the load that it
        belongs to, and merge it once. A correction that takes away what the state does not hold fails,
        and the stored state stays as it was.
        """
        delta = merge_states(*deltas).checkpoint(eager=True)
        merged = delta
        if tables.table_exists(self.spark, self.path):
            months = delta.select(F.col("mois").alias("_mois")).distinct()
            stored = self.read()
            merged = merge_states(stored.join(months, stored.mois == F.col("_mois"), "left_semi"), delta)
            # a month whose last reading was taken away has no row left to overwrite it with
            emptied = months.join(merged.select("mois").distinct(), F.col("_mois") == F.col("mois"), "left_anti")
            gone = [r["_mois"] for r in emptied.collect()]  # at most twelve
        else:
            gone = []
        merged = merged.checkpoint(eager=True)
        if not state_problems(merged).isEmpty():
            raise ValueError("a correction takes away readings that the state does not hold")
        tables.write_table(merged, self.path, ["mois"], dynamic=True, sort_by=["code_station", "annee", "valeur"])
        jvm, fs = tables._files(self.spark, self.path)
        for month in gone:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/mois={month}"), True)

    def thresholds(self, quantiles: Sequence[float] = th.QUANTILES) -> DataFrame:
        return thresholds_of(self.read(), quantiles)
