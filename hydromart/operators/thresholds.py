"""Month-of-year thresholds per station and the level class (AG-01, JN-03, MD-11, position).

Thresholds are a grouped aggregate over (station, month). The default quantile is
``percentile_approx``: a mergeable sketch with bounded memory per group, combined map-side
before the shuffle, so a station holding a third of all rows is still one small buffer per
task. ``exact=True`` switches to ``percentile_disc`` (exact, memory grows with the number
of distinct values in the group); both return the value at rank ceil(q * n), which for groups
below ``accuracy`` rows are identical.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydromart.functions.codes import safe_ratio

# Fixed values of the hydrological rule.
GOOD_QUALIFICATION = "20"
GOOD_STATUSES = ("12", "16")
QUANTILES = (0.90, 0.95, 0.99)
MIN_REFERENCE_YEARS = 5
LEVEL_EXCEPTIONAL = "Exceptionnel"
LEVEL_HIGH = "Élevé"
LEVEL_NORMAL = "Normal"


def usable_observation(qualification: Column, status: Column, value: Column,
                       good_qualification: str = GOOD_QUALIFICATION,
                       good_statuses: Sequence[str] = GOOD_STATUSES) -> Column:
    """Qualification and status accepted, value present."""
    return (qualification == good_qualification) & status.isin(*good_statuses) & value.isNotNull()


def _distinct_years(date: str) -> Column:
    """``count(distinct year)`` as the size of the set of years: the set holds at most one entry
    per calendar year, so it merges map-side like the quantile sketch and avoids the extra
    aggregate and shuffle that a DISTINCT aggregate adds to the plan."""
    return F.size(F.collect_set(F.year(date))).cast("long").alias("n_annees_reference")


def monthly_thresholds(obs: DataFrame, station: str = "code_station", date: str = "date_obs_elab",
                       value: str = "resultat_obs_elab", qualification: str = "code_qualification",
                       status: str = "code_statut", quantiles: Sequence[float] = QUANTILES,
                       exact: bool = False, accuracy: int = 10000,
                       good_qualification: str = GOOD_QUALIFICATION,
                       good_statuses: Sequence[str] = GOOD_STATUSES,
                       before: str | None = None) -> DataFrame:
    """AG-01: p90/p95/p99, ``n_reference`` and ``n_annees_reference`` per (station, ``mois``).

    ``before`` (ISO date) restricts the reference to past data, for leakage-free evaluation (ML-15).
    """
    x = F.col(value)
    src = obs.where(usable_observation(F.col(qualification), F.col(status), x,
                                       good_qualification, good_statuses))
    if before is not None:
        src = src.where(F.col(date) < F.lit(before).cast("date"))
    names = [f"p{round(q * 100)}" for q in quantiles]
    if exact:
        qcols = [F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY `{value}`)").alias(n)
                 for q, n in zip(quantiles, names)]
        return src.groupBy(F.col(station), F.month(date).alias("mois")).agg(
            *qcols, F.count(F.lit(1)).alias("n_reference"), _distinct_years(date))
    arr = F.percentile_approx(x, F.array(*[F.lit(q) for q in quantiles]), accuracy).alias("_q")
    agg = src.groupBy(F.col(station), F.month(date).alias("mois")).agg(
        arr, F.count(F.lit(1)).alias("n_reference"), _distinct_years(date))
    return agg.select(station, "mois", *[F.col("_q")[i].alias(n) for i, n in enumerate(names)],
                      "n_reference", "n_annees_reference")


def level_class(value: Column, qualification: Column, status: Column, p90: Column, p95: Column,
                p99: Column, n_years: Column, min_years: int = MIN_REFERENCE_YEARS,
                good_qualification: str = GOOD_QUALIFICATION,
                good_statuses: Sequence[str] = GOOD_STATUSES) -> Column:
    """Level class; the strict ``p99 > p95`` / ``p95 > p90`` guards keep flat series Normal."""
    classifiable = (usable_observation(qualification, status, value, good_qualification, good_statuses)
                    & (F.coalesce(n_years, F.lit(0)) >= min_years))
    graded = (F.when((p99 > p95) & (value >= p99), F.lit(LEVEL_EXCEPTIONAL))
              .when((p95 > p90) & (value >= p95), F.lit(LEVEL_HIGH))
              .otherwise(F.lit(LEVEL_NORMAL)))
    return F.when(classifiable, graded)


def classify_observations(obs: DataFrame, thresholds: DataFrame, station: str = "code_station",
                          date: str = "date_obs_elab", value: str = "resultat_obs_elab",
                          qualification: str = "code_qualification", status: str = "code_statut",
                          min_years: int = MIN_REFERENCE_YEARS) -> DataFrame:
    """JN-03 + MD-11: observations ⟕ thresholds on (station, month(date)) with ``niveau_hydrologique``.

    Thresholds are (stations x 12) rows; AQE broadcasts them at runtime when they fit the
    broadcast threshold and keeps a shuffled join (with skew splitting) otherwise.
    """
    t = thresholds.withColumnRenamed(station, "_t_station").withColumnRenamed("mois", "_t_mois")
    joined = obs.join(t, (F.col(station) == F.col("_t_station"))
                      & (F.month(F.col(date)) == F.col("_t_mois")), "left")
    joined = joined.drop("_t_station", "_t_mois")
    return joined.withColumn("niveau_hydrologique", level_class(
        F.col(value), F.col(qualification), F.col(status), F.col("p90"), F.col("p95"), F.col("p99"),
        F.col("n_annees_reference"), min_years))


def classify_in_place(obs: DataFrame, station: str = "code_station", date: str = "date_obs_elab",
                      value: str = "resultat_obs_elab", qualification: str = "code_qualification",
                      status: str = "code_statut", quantiles: Sequence[float] = QUANTILES,
                      accuracy: int = 10000, min_years: int = MIN_REFERENCE_YEARS,
                      good_qualification: str = GOOD_QUALIFICATION,
                      good_statuses: Sequence[str] = GOOD_STATUSES) -> DataFrame:
    """MD-11 without a self-join: thresholds as window aggregates over (station, month).

    Valid for observations at the (station, day) grain, where a station-month group holds at
    most 31 rows per year of history. The rows are hash-partitioned by station once; that
    partitioning satisfies both this window and the later per-station lag/lead windows, so the
    whole river chain costs one shuffle and one evaluation of the observations. Results equal
    ``classify_observations(obs, monthly_thresholds(obs))``: a month without usable rows gets
    NULL thresholds and counts, like the left join.
    """
    x = F.col(value)
    usable = usable_observation(F.col(qualification), F.col(status), x, good_qualification, good_statuses)
    w = Window.partitionBy(station, F.month(date))
    n = F.count(F.when(usable, F.lit(1))).over(w)
    q = F.percentile_approx(F.when(usable, x), F.array(*[F.lit(v) for v in quantiles]), accuracy).over(w)
    years = F.size(F.collect_set(F.when(usable, F.year(date))).over(w)).cast("long")
    names = [f"p{round(v * 100)}" for v in quantiles]
    out = (obs.repartition(F.col(station))
           .withColumns({"_n": n, "_q": q, "_y": years})
           .withColumns({**{nm: F.when(F.col("_n") > 0, F.col("_q")[i]) for i, nm in enumerate(names)},
                         "n_reference": F.when(F.col("_n") > 0, F.col("_n")),
                         "n_annees_reference": F.when(F.col("_n") > 0, F.col("_y"))})
           .drop("_n", "_q", "_y"))
    return out.withColumn("niveau_hydrologique", level_class(
        x, F.col(qualification), F.col(status), F.col("p90"), F.col("p95"), F.col("p99"),
        F.col("n_annees_reference"), min_years, good_qualification, good_statuses))


def hydro_thresholds_mart(obs: DataFrame, station: str = "code_station",
                          date: str = "date_obs_elab", value: str = "resultat_obs_elab",
                          qualification: str = "code_qualification", status: str = "code_statut",
                          exact: bool = False, min_years: int = MIN_REFERENCE_YEARS,
                          before: str | None = None) -> DataFrame:
    """MD-11 ``fct_hydro``: every observation with its station-month thresholds and class.

    A rebuilt mart (SNK-10): thresholds depend on all history, so it is never incremental.
    The default path computes thresholds in place (``classify_in_place``); exact quantiles or
    thresholds restricted to past data (``before``) use the aggregate + join path.
    """
    cols = dict(station=station, date=date, value=value, qualification=qualification, status=status)
    if not exact and before is None:
        return classify_in_place(obs, min_years=min_years, **cols)
    th = monthly_thresholds(obs, exact=exact, before=before, **cols)
    return classify_observations(obs, th, min_years=min_years, **cols)


def exceedance_position(classified: DataFrame, station: str = "code_station",
                        date: str = "date_obs_elab", value: str = "resultat_obs_elab") -> DataFrame:
    """Position ``(x - p95) / (p99 - p90)`` and ``depasse_p95_j`` on classifiable rows.

    A zero denominator gives NULL and the row is dropped here, before any lag/lead.
    """
    x = F.col(value)
    return (classified
            .where(x.isNotNull() & F.col("p95").isNotNull() & F.col("niveau_hydrologique").isNotNull())
            .select(F.col(station).alias("code_station"), F.col(date).alias("date"),
                    safe_ratio(x - F.col("p95"), F.col("p99") - F.col("p90")).alias("position_p95"),
                    (x >= F.col("p95")).cast("int").alias("depasse_p95_j"))
            .where(F.col("position_p95").isNotNull()))
