"""Data-quality checks (DQ-01..DQ-12). Each returns the offending rows; empty means pass.

All checks are aggregates or anti/left joins, so they run distributed and can gate a
pipeline with ``isEmpty()`` without collecting anything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hydromart.functions.temporal import as_date


def not_null(df: DataFrame, column: str) -> DataFrame:
    """DQ-01."""
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """DQ-02: duplicated non-NULL values with their count."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1))


def relationships(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None) -> DataFrame:
    """DQ-03 / JN-15: non-NULL child keys absent from the parent."""
    p = parent.select(F.col(parent_col or child_col).alias(child_col)).distinct()
    return child.where(F.col(child_col).isNotNull()).join(p, child_col, "left_anti")


def grain(df: DataFrame, keys: Sequence[str], count_name: str = "nb_lignes") -> DataFrame:
    """DQ-04 / AG-05: keys that appear more than once (``group by ... having count(*) > 1``)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name)).where(F.col(count_name) > 1)


def thresholds_uniform(fct_hydro: DataFrame, station: str = "code_station",
                       date: str = "date_obs_elab") -> DataFrame:
    """DQ-05 / AG-06: one threshold set per station x month; p95 present on all rows or none.

    "More than one distinct non-NULL value" is tested as ``min < max``: the same answer as
    ``count(distinct) > 1`` without the row expansion and extra shuffle of DISTINCT aggregates.
    """
    cols = ("p90", "p95", "p99", "n_reference", "n_annees_reference")
    g = fct_hydro.groupBy(station, F.month(date).alias("mois")).agg(
        *[F.min(c).alias(f"_lo_{c}") for c in cols], *[F.max(c).alias(f"_hi_{c}") for c in cols],
        F.count("p95").alias("_with_p95"), F.count(F.lit(1)).alias("_rows"))
    bad = ~F.col("_with_p95").isin(F.lit(0), F.col("_rows"))
    for c in cols:
        bad = bad | (F.col(f"_lo_{c}") < F.col(f"_hi_{c}"))
    return g.where(bad).select(station, "mois")


def classifiable(features: DataFrame, fct_hydro: DataFrame, measure: str | None = "HIXnJ") -> DataFrame:
    """DQ-06 / JN-14: feature rows whose observation is missing or has no level class."""
    o = fct_hydro
    if measure is not None:
        o = o.where(F.col("grandeur_hydro_elab") == measure)
    o = o.select(F.col("code_station").alias("_s"), F.col("date_obs_elab").alias("_d"), "niveau_hydrologique")
    j = features.join(o, (F.col("code_station") == F.col("_s")) & (F.col("date") == F.col("_d")), "left")
    return j.where(F.col("niveau_hydrologique").isNull()).select("code_station", "date")


SCORING_FEATURES = ["position_p95", "variation_position_1j", "pluie_j", "pluie_3j", "humidite_sol"]


def last_date_scorable(features: DataFrame, required: Sequence[str] = SCORING_FEATURES) -> DataFrame:
    """DQ-07 / JN-13: the last date, returned only if none of its rows has every feature.

    One pass: fully-populated rows counted per date, then the count of the latest date taken
    with ``max_by`` (an empty table yields its NULL last date, like the SQL left join).
    """
    full = F.lit(True)
    for c in required:
        full = full & F.col(c).isNotNull()
    per_date = features.groupBy("date").agg(F.count_if(full).alias("n_full"))
    last = per_date.agg(F.max("date").alias("date"), F.max_by("n_full", "date").alias("n_full"))
    return last.where(F.coalesce(F.col("n_full"), F.lit(0)) == 0).select("date")


def count_range(df: DataFrame, key: str, low: int, high: int, expected: int | None = None) -> DataFrame:
    """DQ-08: one row (n, in_range, status): 'error' out of range, 'warning' != expected, else 'ok'."""
    n = df.agg(F.count_distinct(key).alias("n"))
    status = F.when(~F.col("n").between(low, high), F.lit("error"))
    if expected is not None:
        status = status.when(F.col("n") != expected, F.lit("warning"))
    return n.select("n", F.col("n").between(low, high).alias("in_range"), status.otherwise("ok").alias("status"))


def coverage(df: DataFrame, entity: str, date: str) -> DataFrame:
    """DQ-11 / AG-07: entities with fewer distinct dates than the full calendar of the data.

    The expected count is the number of days between the overall first and last date
    (a scalar subquery).
    """
    expected = df.agg(F.datediff(F.max(date), F.min(date)) + 1).scalar()
    per = df.groupBy(entity).agg(F.count_distinct(date).alias("n_dates"))
    return per.withColumn("expected", expected).where(F.col("n_dates") < F.col("expected"))


def coverage_gaps(df: DataFrame, entity: str, date: str, start=None, end=None, entities: DataFrame | None = None) -> DataFrame:
    """DQ-11: the missing stretches of every entity: (entity, first_missing, last_missing, n_days).

    Looked for between ``start`` and ``end`` (default: the overall first and last date of the data).
    ``entities`` (a frame with the entity column) adds entities without any date, which miss it all.
    Repeated dates count once and dates outside the range are ignored; a NULL date covers nothing, and
    rows without an entity are left out. The window runs over distinct (entity, day) rows, at most one per calendar day.
    """
    day = F.to_date(F.col(date))
    low = as_date(start) if start is not None else df.agg(F.min(day)).scalar()
    high = as_date(end) if end is not None else df.agg(F.max(day)).scalar()
    days = (df.select(F.col(entity).alias("_entity"), day.alias("_day")).where("_entity IS NOT NULL AND _day IS NOT NULL")
            .where((F.col("_day") >= low) & (F.col("_day") <= high)).distinct())
    # a day before the range and one behind it bound every entity's stretches
    named = df.select(F.col(entity).alias("_entity"))
    if entities is not None:
        named = named.unionByName(entities.select(F.col(entity).alias("_entity")))
    named = named.where("_entity IS NOT NULL").distinct()
    edges = named.select("_entity", F.explode(F.array(F.date_sub(low, 1), F.date_add(high, 1))).alias("_day"))
    following = F.lead("_day").over(Window.partitionBy("_entity").orderBy("_day"))
    return (days.unionByName(edges).withColumn("_next", following)
            .where(F.datediff("_next", "_day") > 1)
            .select(F.col("_entity").alias(entity), F.date_add("_day", 1).alias("first_missing"),
                    F.date_sub("_next", 1).alias("last_missing"), (F.datediff("_next", "_day") - 1).alias("n_days")))


def partial_last_day(df: DataFrame, date: str, entity: str, measures: Sequence[str]) -> DataFrame:
    """DQ-11 / FN-20: rows with any missing measure, counted per date (dates and places affected)."""
    missing = F.lit(False)
    for m in measures:
        missing = missing | F.col(m).isNull()
    return (df.where(missing).groupBy(date)
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(entity).alias("n_places")))


def scoring_preconditions(features: DataFrame, keys: Sequence[str] = ("date", "code_station")) -> DataFrame:
    """DQ-12: problems that block scoring the last date: no rows, or duplicated keys on it.

    One row per problem (``problem``, ``n``); empty means the latest date can be scored. Only the
    latest date is looked at: it is a scalar subquery that prunes the scan.
    """
    date = keys[0]
    latest = features.where(F.col(date) == features.agg(F.max(date)).scalar())
    per_key = latest.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    last = per_key.agg(F.sum("_n").alias("_rows"), F.count_if(F.col("_n") > 1).alias("_dups"))
    problems = F.array(
        F.struct(F.lit("no rows").alias("problem"), F.coalesce(F.col("_rows"), F.lit(0)).cast("long").alias("n")),
        F.struct(F.lit("duplicated keys").alias("problem"), F.coalesce(F.col("_dups"), F.lit(0)).cast("long").alias("n")))
    out = last.select(F.inline(problems))
    return out.where(((F.col("problem") == "no rows") & (F.col("n") == 0))
                     | ((F.col("problem") == "duplicated keys") & (F.col("n") > 0)))


def feature_freshness(features: DataFrame, river_dates: DataFrame, weather_dates: DataFrame,
                      today=None, date: str = "date") -> DataFrame:
    """VER-10 / DQ-12: one row comparing the feature mart with the ingested sources.

    ``last_features`` is the latest feature date, ``last_ingested`` the earlier of the two
    sources' latest dates; ``lagging`` flags features behind ingestion (days without usable
    river or weather data) and ``age_days`` is the data age at ``today``. All values are scalar
    subqueries over the three inputs.
    """
    from hydromart.functions.temporal import as_date
    last_f = features.agg(F.max(date)).scalar()
    last_r = river_dates.agg(F.max(river_dates.columns[0])).scalar()
    last_w = weather_dates.agg(F.max(weather_dates.columns[0])).scalar()
    one = features.sparkSession.range(1)
    return one.select(last_f.alias("last_features"), F.least(last_r, last_w).alias("last_ingested"),
                      (last_f < F.least(last_r, last_w)).alias("lagging"),
                      F.datediff(as_date(today), last_f).alias("age_days"))
