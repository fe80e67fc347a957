"""Declared schemas of the raw, staging and mart tables (never inferred)."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, LongType, StringType, StructField, StructType, TimestampType,
)

# River observation content columns, in source order.
RIVER_OBS_COLUMNS = [
    "code_site", "code_station", "date_obs_elab", "resultat_obs_elab", "date_prod", "code_statut",
    "libelle_statut", "code_methode", "libelle_methode", "code_qualification",
    "libelle_qualification", "longitude", "latitude", "grandeur_hydro_elab",
]

# River station columns, in source order.
STATION_COLUMNS = [
    "code_station", "code_site", "libelle_station", "code_commune_station", "libelle_commune",
    "code_departement", "libelle_departement", "code_region", "libelle_region", "code_cours_eau",
    "libelle_cours_eau", "latitude_station", "longitude_station", "date_ouverture_station",
    "date_fermeture_station", "en_service",
]

# The 29 daily weather variables and their business names, in source order.
WEATHER_RENAMES = {
    "weather_code": "code_meteo",
    "temperature_2m_mean": "temperature_moyenne",
    "temperature_2m_min": "temperature_minimale",
    "temperature_2m_max": "temperature_maximale",
    "apparent_temperature_mean": "temperature_ressentie_moyenne",
    "apparent_temperature_min": "temperature_ressentie_minimale",
    "apparent_temperature_max": "temperature_ressentie_maximale",
    "relative_humidity_2m_mean": "humidite_moyenne",
    "relative_humidity_2m_min": "humidite_minimale",
    "relative_humidity_2m_max": "humidite_maximale",
    "dew_point_2m_mean": "point_de_rosee_moyen",
    "precipitation_sum": "precipitations_totales",
    "rain_sum": "pluie_totale",
    "snowfall_sum": "neige_totale",
    "precipitation_hours": "heures_de_precipitations",
    "wind_speed_10m_mean": "vitesse_vent_moyenne",
    "wind_speed_10m_max": "vitesse_vent_maximale",
    "wind_gusts_10m_max": "rafale_vent_maximale",
    "wind_direction_10m_dominant": "direction_vent_dominante",
    "cloud_cover_mean": "couverture_nuageuse_moyenne",
    "pressure_msl_mean": "pression_moyenne",
    "sunshine_duration": "duree_ensoleillement",
    "shortwave_radiation_sum": "rayonnement_solaire_total",
    "et0_fao_evapotranspiration": "evapotranspiration",
    "vapour_pressure_deficit_max": "deficit_pression_vapeur_maximal",
    "soil_moisture_0_to_7cm_mean": "humidite_sol_0_7cm",
    "soil_moisture_7_to_28cm_mean": "humidite_sol_7_28cm",
    "soil_moisture_28_to_100cm_mean": "humidite_sol_28_100cm",
    "soil_temperature_0_to_7cm_mean": "temperature_sol_0_7cm",
}
WEATHER_VARIABLES = list(WEATHER_RENAMES)

S, D, L, B = StringType(), DoubleType(), LongType(), BooleanType()
TECH_FIELDS = [StructField("row_hash", S), StructField("inserted_at", TimestampType()),
               StructField("batch_id", S)]


def _struct(fields) -> StructType:
    return StructType([StructField(n, t) for n, t in fields])


RAW_OBS = StructType(
    [StructField(c, {"date_obs_elab": DateType(), "resultat_obs_elab": D, "date_prod": TimestampType(),
                     "longitude": D, "latitude": D}.get(c, S)) for c in RIVER_OBS_COLUMNS] + TECH_FIELDS)

RAW_STATIONS = StructType(
    [StructField(c, {"latitude_station": D, "longitude_station": D,
                     "date_ouverture_station": TimestampType(), "date_fermeture_station": TimestampType(),
                     "en_service": B}.get(c, S)) for c in STATION_COLUMNS])

RAW_WEATHER = StructType(
    [StructField("Latitude", D), StructField("Longitude", D), StructField("code_INSEE", S),
     StructField("date", DateType())] + TECH_FIELDS
    + [StructField(v, L if v == "weather_code" else D) for v in WEATHER_VARIABLES])

# Two location schemas unioned in the history file (POI places and towns).
RAW_WEATHER_HISTORY = StructType(
    [StructField("time", S), StructField("nom_poi", S), StructField("numero_departement", S),
     StructField("latitude_poi", D), StructField("longitude_poi", D), StructField("Ville", S),
     StructField("Departement", D), StructField("Latitude", D), StructField("Longitude", D)]
    + [StructField(v, D) for v in WEATHER_VARIABLES])

RAW_RISK_FREQUENCY = _struct([("code_insee", S), ("commune", S), ("frequence", S)])
RAW_RISK_COVERAGE = _struct([("code_insee", S), ("commune", S), ("representativite", S)])

SEED_COMMUNES = _struct([("Commune", S), ("Latitude", D), ("Longitude", D), ("Region", S),
                         ("Departement", S), ("Numero_Departement", S), ("Service", S),
                         ("code_INSEE", S), ("Centroide", S)])

ML_FEATURES = _struct([("date", DateType()), ("code_station", S), ("code_insee", S),
                       ("code_departement", S), ("position_p95", D), ("variation_position_1j", D),
                       ("pluie_j", D), ("pluie_3j", D), ("humidite_sol", D), ("mois", L),
                       ("depasse_p95_j", L), ("target_j1", L)])

PREDICTIONS = _struct([("date", DateType()), ("code_station", S), ("code_insee", S),
                       ("code_departement", S), ("position_p95", D), ("variation_position_1j", D),
                       ("pluie_j", D), ("pluie_3j", D), ("humidite_sol", D), ("prediction_j1", L),
                       ("probabilite_depassement_j1", D), ("date_prediction", TimestampType())])

BACKFILL_LEDGER = _struct([("grandeur_hydro_elab", S), ("mois", DateType()), ("nb_lignes", L),
                           ("termine_le", TimestampType())])
