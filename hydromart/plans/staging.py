"""Staging views: typed, trimmed, latest-version inputs of the marts (MD-01..MD-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.functions.codes import (
    clean, first_present, identity_hash, int_text, pad_code, place_key, safe_cast, valid_label_row,
)
from hydromart.functions.temporal import as_date, as_timestamp
from hydromart.operators.versions import latest_versions
from hydromart.sources.schemas import WEATHER_RENAMES

# The day the daily weather feed takes over from the history file, and the
# river measure kept by the marts.
WEATHER_CUTOVER = "2026-08-01"
RIVER_MEASURE = "HIXnJ"

RIVER_ORDER = ["inserted_at", "date_prod", "row_hash"]
WEATHER_ORDER = ["inserted_at", "row_hash"]


def stg_obs(raw_obs: DataFrame) -> DataFrame:
    """MD-01: latest version per (station, day, measure) on normalised keys, typed and trimmed.

    ``row_hash`` here is the identity hash of the business key (not the raw content hash).
    """
    keys = {"_station": clean("code_station"), "_date": safe_cast("date_obs_elab", "date"),
            "_measure": clean("grandeur_hydro_elab")}
    latest = latest_versions(raw_obs, keys, RIVER_ORDER)
    return latest.select(
        identity_hash(clean("code_station"), F.col("date_obs_elab").cast("string"),
                      clean("grandeur_hydro_elab")).alias("row_hash"),
        clean("code_station").alias("code_station"),
        safe_cast("date_obs_elab", "date").alias("date_obs_elab"),
        clean("grandeur_hydro_elab").alias("grandeur_hydro_elab"),
        safe_cast("resultat_obs_elab", "double").alias("resultat_obs_elab"),
        safe_cast("date_prod", "timestamp").alias("date_prod"),
        *[clean(c).alias(c) for c in ("code_statut", "libelle_statut", "code_methode", "libelle_methode",
                                     "code_qualification", "libelle_qualification", "code_site")],
        safe_cast("longitude", "double").alias("longitude"),
        safe_cast("latitude", "double").alias("latitude"),
        "inserted_at")


def stg_stations(raw_stations: DataFrame) -> DataFrame:
    """MD-02: trimmed station directory; commune code padded to 5 like ``dim_commune``."""
    text = ["code_station", "code_site", "libelle_station"]
    rest = ["libelle_commune", "code_departement", "libelle_departement", "code_region",
            "libelle_region", "code_cours_eau", "libelle_cours_eau"]
    return raw_stations.select(
        *[clean(c).alias(c) for c in text],
        pad_code("code_commune_station", 5).alias("code_commune_station"),
        *[clean(c).alias(c) for c in rest],
        safe_cast("latitude_station", "double").alias("latitude_station"),
        safe_cast("longitude_station", "double").alias("longitude_station"),
        safe_cast("date_ouverture_station", "timestamp").alias("date_ouverture_station"),
        safe_cast("date_fermeture_station", "timestamp").alias("date_fermeture_station"),
        "en_service")


def _measures() -> list:
    return [F.col(src).alias(dst) if dst != "code_meteo" else safe_cast(src, "bigint").alias(dst)
            for src, dst in WEATHER_RENAMES.items()]


def history_department() -> F.Column:
    """History files carry either a text department (POI schema) or a float one (town schema)."""
    return first_present("numero_departement", int_text("Departement", 2))


def weather_history(history: DataFrame, seed: DataFrame, cutover: str = WEATHER_CUTOVER) -> DataFrame:
    """MD-03 history part: JN-01, the fuzzy join to the commune seed on (place key, department)."""
    place = first_present("nom_poi", "Ville")
    h = history.select("*", place_key(place).alias("_name_key"), history_department().alias("_dept"))
    g = seed.select(place_key("Commune").alias("_name_key"), pad_code("Numero_Departement", 2).alias("_dept"),
                    F.col("code_INSEE").alias("_g_code"), F.col("Region").alias("_g_region"))
    j = h.join(g, ["_name_key", "_dept"], "left")
    return j.where(safe_cast("time", "date") < as_date(cutover)).select(
        safe_cast("time", "date").alias("date"), place.alias("ville"),
        pad_code("_g_code", 5).alias("code_insee"), F.col("_dept").alias("departement"),
        F.col("_g_region").alias("region"),
        first_present("latitude_poi", "Latitude").alias("latitude"),
        first_present("longitude_poi", "Longitude").alias("longitude"),
        *_measures())


def weather_daily(raw_weather: DataFrame, seed: DataFrame, cutover: str = WEATHER_CUTOVER) -> DataFrame:
    """MD-03 daily part: latest version per (padded code, day), JN-02 join on padded codes."""
    keys = {"_code": pad_code("code_INSEE", 5), "_date": safe_cast("date", "date")}
    latest = latest_versions(raw_weather, keys, WEATHER_ORDER)
    g = seed.select(pad_code("code_INSEE", 5).alias("_code"), F.col("Commune").alias("_g_commune"),
                    pad_code("Numero_Departement", 2).alias("_g_dept"), F.col("Region").alias("_g_region"))
    j = latest.join(g, "_code", "left")
    return j.where(F.col("_date") >= as_date(cutover)).select(
        F.col("_date").alias("date"), F.col("_g_commune").alias("ville"), F.col("_code").alias("code_insee"),
        F.col("_g_dept").alias("departement"), F.col("_g_region").alias("region"),
        F.col("Latitude").alias("latitude"), F.col("Longitude").alias("longitude"), *_measures())


def stg_weather(history: DataFrame, raw_weather: DataFrame, seed: DataFrame,
                cutover: str = WEATHER_CUTOVER, built_at=None) -> DataFrame:
    """MD-03: history before the cut-over ∪ daily feed from it (SO-01), with identity hash.

    The identity hash maps a NULL code to '' (all unmatched places of a day share one hash,
    which the uniqueness check is meant to flag).
    """
    both = weather_history(history, seed, cutover).unionByName(weather_daily(raw_weather, seed, cutover))
    return both.select(identity_hash(F.col("date").cast("string"), "code_insee", null_as_empty=True).alias("row_hash"),
                       as_timestamp(built_at).alias("insere_a"), *both.columns)


def stg_risk(raw: DataFrame, value_col: str, out_col: str, header_code: str = "Code_INSEE") -> DataFrame:
    """MD-04 / MD-05: risk tables without all-NULL rows and the header row copied as data."""
    return raw.where(valid_label_row("code_insee", header_code)).select(
        clean("code_insee").alias("code_insee"), clean("commune").alias("commune"),
        clean(value_col).alias(out_col))


def stg_risk_frequency(raw: DataFrame) -> DataFrame:
    return stg_risk(raw, "frequence", "classe_frequence")


def stg_risk_coverage(raw: DataFrame) -> DataFrame:
    return stg_risk(raw, "representativite", "representativite")
