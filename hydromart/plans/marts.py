"""Dimensions and marts composed from the operators (MD-06..MD-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.functions.codes import clean, department_code, pad_code
from hydromart.functions.temporal import calendar_parts, sentinel_date
from hydromart.operators.series import collapse_days, lag_lead_features, min_history, strict_rolling_sum
from hydromart.operators.thresholds import exceedance_position

# Column order of the ml_features mart.
ML_FEATURE_COLUMNS = [
    "date", "code_station", "code_insee", "code_departement", "position_p95",
    "variation_position_1j", "pluie_j", "pluie_3j", "humidite_sol", "mois",
    "depasse_p95_j", "target_j1",
]


def dim_commune(seed: DataFrame) -> DataFrame:
    """MD-06: distinct communes with padded INSEE and department codes."""
    return seed.select(
        pad_code("code_INSEE", 5).alias("code_insee"), F.col("Commune").alias("ville"),
        pad_code("Numero_Departement", 2).alias("numero_departement"), F.col("Region").alias("region"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"),
        F.col("Departement").alias("departement")).distinct()


def dim_departement(seed: DataFrame) -> DataFrame:
    """MD-07: distinct departments; Corsican codes kept as ``2A``/``2B``."""
    return seed.select(department_code("Numero_Departement").alias("code_departement"),
                       clean("Departement").alias("departement"),
                       clean("Region").alias("region")).distinct()


def dim_station(stations: DataFrame, observations: DataFrame, station: str = "code_station") -> DataFrame:
    """MD-09: stations that have at least one observation; sentinel dates to NULL."""
    observed = observations.select(station).where(F.col(station).isNotNull())
    s = stations.join(observed, station, "left_semi")
    out = s
    for c in ("date_ouverture_station", "date_fermeture_station"):
        if c in s.columns:
            out = out.withColumn(c, sentinel_date(c))
    return out


def stations_with_commune(stations: DataFrame, communes: DataFrame) -> DataFrame:
    """JN-05: stations attached to a known commune."""
    c = communes.select(F.col("code_insee").alias("code_commune_station")).distinct()
    return (stations.join(c, "code_commune_station", "inner")
            .select("code_station", F.col("code_commune_station").alias("code_insee"), "code_departement"))


def weather_days(weather: DataFrame, commune: str = "code_insee", date: str = "date",
                 rain: str = "pluie_totale", moisture: str = "humidite_sol_7_28cm", days: int = 3) -> DataFrame:
    """AG-02 + WN-02: one row per commune-day and the calendar-strict 3-day rain."""
    # The collapse aggregates map-side first (duplicates of a commune-day never meet in one
    # task before being combined); the window then runs on at most one row per commune-day.
    daily = collapse_days(weather, [commune, date], [rain, moisture])
    rolled = strict_rolling_sum(daily, commune, date, rain, days, out="pluie_3j")
    return rolled.select(F.col(commune).alias("code_insee"), F.col(date).alias("date"),
                         F.col(rain).alias("pluie_j"), "pluie_3j",
                         F.col(moisture).alias("humidite_sol"))


def hydro_series(fct_hydro: DataFrame, station: str = "code_station", date: str = "date_obs_elab",
                 value: str = "resultat_obs_elab") -> DataFrame:
    """Position, adjacent-day difference and next-day label on the river series alone."""
    pos = exceedance_position(fct_hydro, station, date, value)
    return lag_lead_features(pos)


def ml_features(fct_hydro: DataFrame, stations: DataFrame, weather: DataFrame,
                min_rows: int = 100, weather_cols: dict | None = None) -> DataFrame:
    """MD-12: the feature mart, one row per (station, date).

    ``fct_hydro`` is MD-11's output; ``stations`` has (code_station, code_insee, code_departement);
    ``weather`` has one row per commune-day (duplicates are poisoned, not dropped).
    Order of filters: NULL position dropped -> lag/lead -> weather join -> NULL filters -> >= min_rows.
    A NULL label is kept: it is the row to score.
    """
    hydro = hydro_series(fct_hydro)
    meteo = weather_days(weather, **(weather_cols or {}))
    joint = (hydro.join(stations, "code_station", "inner")
             .join(meteo, ["code_insee", "date"], "inner")
             .where(F.col("pluie_j").isNotNull() & F.col("pluie_3j").isNotNull()
                    & F.col("humidite_sol").isNotNull())
             .withColumn("mois", F.month("date")))
    return min_history(joint, "code_station", min_rows).select(*ML_FEATURE_COLUMNS)


def dim_date_between(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """MD-08 with data-derived bounds: ``bounds`` is a one-row frame (e.g. min/max of a fact)."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("date"))
    return days.select("date", *[c.alias(k) for k, c in calendar_parts("date").items()])
