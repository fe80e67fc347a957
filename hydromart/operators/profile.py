"""Descriptive profiles of a table (FN-20, AG-07..AG-12). Data only; no charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """FN-20: one row per column (column, n_null, n_rows, null_rate) from a single aggregate."""
    cols = list(columns or df.columns)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = one.unpivot("_n", cols, "column", "n_null")
    return long.select("column", "n_null", F.col("_n").alias("n_rows"),
                       F.try_divide(F.col("n_null"), F.col("_n")).alias("null_rate"))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """AG-10: count and share per class (``value_counts(normalize=True)``)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # The window's input is the per-class counts (one row per class), so an unpartitioned
    # window is bounded and evaluates the source once (a scalar total would read it again).
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(label, "n", (F.col("n") / total).alias("share"))


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """AG-11: equal-width bins between the column's min and max; the max falls in the last bin."""
    x = F.col(column)
    b = df.where(x.isNotNull()).withColumns({"_lo": df.agg(F.min(x)).scalar(), "_hi": df.agg(F.max(x)).scalar()})
    lo, hi = F.col("_lo"), F.col("_hi")
    raw = F.floor((x - lo) / (hi - lo) * bins) + 1
    b = b.withColumn("bin", F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int"))
    width = (hi - lo) / bins
    return (b.groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(column).alias("feature"), "bin",
                    (lo + (F.col("bin") - 1) * width).alias("lower"),
                    (lo + F.col("bin") * width).alias("upper"), "n"))


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AG-12: Pearson correlation of every pair, pairwise-complete like pandas, in one aggregate."""
    cols = list(columns)
    pairs = [(a, b) for a in cols for b in cols]
    one = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") if a != b else
                   F.when(F.count(a) > 1, F.lit(1.0)).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "r")
    return long.select(F.split("pair", r"\|")[0].alias("x"), F.split("pair", r"\|")[1].alias("y"), "r")


def coverage_summary(df: DataFrame, entity: str, date: str) -> DataFrame:
    """AG-07: distinct dates per entity and their spread (min/mean/max over entities)."""
    per = df.groupBy(entity).agg(F.count_distinct(date).alias("n_dates"))
    return per.agg(F.count(F.lit(1)).alias("n_entities"), F.min("n_dates").alias("min_dates"),
                   F.avg("n_dates").alias("mean_dates"), F.max("n_dates").alias("max_dates"))


def duplicates_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-08: rows minus distinct keys, i.e. how many rows are extra copies of a key."""
    return df.agg((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).alias("n_duplicates"))


def dataset_profile(df: DataFrame, date: str = "date", entity: str = "code_station",
                    target: str = "target_j1") -> DataFrame:
    """AG-09: shape, date range, number of entities, labelled and unlabelled rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
                  F.min(date).alias("first_date"), F.max(date).alias("last_date"),
                  F.count_distinct(entity).alias("n_entities"),
                  F.count(target).alias("n_labelled"), F.count_if(F.col(target).isNull()).alias("n_unlabelled"))


def spot_check(df: DataFrame, name_col: str, names: Sequence[str], coord_cols: Sequence[str]) -> DataFrame:
    """FN-21: case-folded lookup of a few place names -> their distinct coordinates."""
    wanted = [n.lower() for n in names]
    return (df.where(F.lower(F.coalesce(F.col(name_col), F.lit(""))).isin(wanted))
            .select(name_col, *coord_cols).distinct())


def describe(df: DataFrame, columns: Sequence[str], accuracy: int = 10000) -> DataFrame:
    """AG-07 / AG-09 ``describe``: count, mean, sample std, min, quartiles, max per column.

    One aggregate over all columns (quartiles from the mergeable ``percentile_approx`` sketch,
    exact below ~``accuracy`` rows), then one output row per column.
    """
    cols = list(columns)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}|count"), F.avg(x).alias(f"{c}|mean"), F.stddev_samp(x).alias(f"{c}|std"),
                 F.min(x).alias(f"{c}|min"),
                 F.percentile_approx(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy).alias(f"{c}|q"),
                 F.max(x).alias(f"{c}|max")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}|count`").alias("count"),
                              F.col(f"`{c}|mean`").alias("mean"), F.col(f"`{c}|std`").alias("std"),
                              F.col(f"`{c}|min`").alias("min"), F.col(f"`{c}|q`")[0].alias("p25"),
                              F.col(f"`{c}|q`")[1].alias("p50"), F.col(f"`{c}|q`")[2].alias("p75"),
                              F.col(f"`{c}|max`").alias("max")) for c in cols])
    return one.select(F.inline(rows))
