"""Daily series operators on the (entity, day) grain (AG-02, WN-02..05).

Scale note: every window here runs on a series already collapsed to one row per entity and
calendar day, so a window partition holds at most one row per day of history (about 10k rows
for 27 years) no matter how many raw rows feed it; the heavy, skew-prone work is the
collapse, which is a hash aggregate with map-side partial aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def collapse_days(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """AG-02: one row per key; a duplicated key poisons its measures (NULL), it is not averaged.

    ``case when count(*) = 1 then max(x) end`` per measure.
    """
    n = F.count(F.lit(1))
    return df.groupBy(*keys).agg(*[F.when(n == 1, F.max(m)).alias(m) for m in measures])


def strict_rolling_sum(df: DataFrame, entity: str, date: str, value: str, days: int = 3,
                       out: str | None = None) -> DataFrame:
    """WN-02: sum over the calendar days ``[d - days + 1, d]``, only when every day is present
    exactly once and every value is non-NULL; otherwise NULL. Expects one row per day (AG-02).
    """
    w = (Window.partitionBy(entity).orderBy(F.unix_date(F.col(date)))
         .rangeBetween(-(days - 1), Window.currentRow))
    complete = (F.count(F.lit(1)).over(w) == days) & (F.count(F.col(value)).over(w) == days)
    return df.withColumn(out or f"{value}_{days}j", F.when(complete, F.sum(F.col(value)).over(w)))


def adjacent_difference(df: DataFrame, entity: str, date: str, value: str,
                        out: str | None = None) -> DataFrame:
    """WN-03: ``x(d) - x(d-1)`` only when the previous row is exactly the previous day."""
    w = Window.partitionBy(entity).orderBy(date)
    prev_is_yesterday = F.datediff(F.col(date), F.lag(date).over(w)) == 1
    return df.withColumn(out or f"variation_{value}",
                         F.when(prev_is_yesterday, F.col(value) - F.lag(value).over(w)))


def next_day_value(df: DataFrame, entity: str, date: str, value: str,
                   out: str | None = None) -> DataFrame:
    """WN-04: the next row's value only when it is exactly the next day, else NULL."""
    w = Window.partitionBy(entity).orderBy(date)
    next_is_tomorrow = F.datediff(F.lead(date).over(w), F.col(date)) == 1
    return df.withColumn(out or f"next_{value}", F.when(next_is_tomorrow, F.lead(value).over(w)))


def lag_lead_features(df: DataFrame, entity: str = "code_station", date: str = "date",
                      position: str = "position_p95", flag: str = "depasse_p95_j") -> DataFrame:
    """WN-03 + WN-04 sharing one window spec (one sort for both)."""
    w = Window.partitionBy(entity).orderBy(date)
    return df.select(
        "*",
        F.when(F.datediff(F.col(date), F.lag(date).over(w)) == 1,
               F.col(position) - F.lag(position).over(w)).alias("variation_position_1j"),
        F.when(F.datediff(F.lead(date).over(w), F.col(date)) == 1,
               F.lead(flag).over(w)).alias("target_j1"))


def min_history(df: DataFrame, entity: str, min_rows: int = 100) -> DataFrame:
    """WN-05: keep entities with at least ``min_rows`` rows (``qualify count(*) over (partition
    by entity) >= n``).

    A window count: one exchange of the rows by entity and no second evaluation of the input
    plan (a grouped count + semi-join would compute the input twice). A partition holds one
    entity's daily rows, i.e. at most one row per calendar day.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(entity))
    return df.withColumn("_n", n).where(F.col("_n") >= min_rows).drop("_n")
