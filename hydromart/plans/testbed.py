"""Role mapping of the driver's TPC-H-like tables onto the hydrology data model.

station = supplier nation (or region), observation = daily ``max(l_extendedprice)``,
rain = daily ``sum(l_quantity)``, soil moisture = daily ``avg(l_discount)``,
qualification / status derived from the day's return flags / line statuses,
raw versions = ``events``. Each builder reads whole tables; column pruning and filters reach
the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.functions.codes import pad_code
from hydromart.session import checkpoint_dir

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Whole table scan; filters and column pruning reach the Parquet reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _station_key(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    """supplier -> station code (nation key, or region key through nation)."""
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if grain == "nation":
        return sup.select("s_suppkey", F.col("s_nationkey").cast("string").alias("code_station"))
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return (sup.join(nat, sup.s_nationkey == nat.n_nationkey)
            .select("s_suppkey", F.col("n_regionkey").cast("string").alias("code_station")))


def shipments(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Row-level lineitem with its station code and ship day."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus",
        F.to_date("l_shipdate").alias("date_obs_elab"))
    return li.join(_station_key(spark, sf_dir, grain), li.l_suppkey == F.col("s_suppkey")).drop("s_suppkey")


def station_days(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """One aggregate per (station, day) holding every measure of the river and the weather frames."""
    return shipments(spark, sf_dir, grain).groupBy("code_station", "date_obs_elab").agg(
        F.max("l_extendedprice").alias("resultat_obs_elab"),
        F.min("l_returnflag").alias("_min_flag"), F.min("l_linestatus").alias("_min_status"),
        F.sum("l_quantity").alias("pluie_totale"), F.avg("l_discount").alias("_avg_discount"))


def stored_station_days(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """``station_days`` computed once, for plans that need both the river and the weather frames:
    column pruning would make their aggregates differ, so each would scan the facts again."""
    checkpoint_dir(spark)
    return station_days(spark, sf_dir, grain).checkpoint(eager=True)


def river_observations(spark: SparkSession, sf_dir: str, grain: str = "nation", days: DataFrame | None = None) -> DataFrame:
    """One observation per (station, day): the ``stg_obs`` shape (MD-01 output columns)."""
    return (days if days is not None else station_days(spark, sf_dir, grain)).select(
        "code_station", "date_obs_elab", "resultat_obs_elab",
        F.when(F.col("_min_flag") == "R", F.lit("10")).otherwise(F.lit("20")).alias("code_qualification"),
        F.when(F.col("_min_status") == "F", F.lit("12")).otherwise(F.lit("16")).alias("code_statut"),
        F.lit("HIXnJ").alias("grandeur_hydro_elab"))


def daily_weather(spark: SparkSession, sf_dir: str, grain: str = "nation", days: DataFrame | None = None) -> DataFrame:
    """One weather row per (commune, day): ``fct_weather`` columns used by the features."""
    return (days if days is not None else station_days(spark, sf_dir, grain)).select(
        pad_code("code_station", 5).alias("code_insee"), F.col("date_obs_elab").alias("date"),
        "pluie_totale", F.round("_avg_discount", 6).alias("humidite_sol_7_28cm"))


def station_directory(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """Stations attached to communes: (code_station, code_insee, code_departement).

    Nation grain: commune = nation, department = region. Region grain: commune = region.
    """
    if grain == "nation":
        nat = table(spark, sf_dir, "nation")
        return nat.select(F.col("n_nationkey").cast("string").alias("code_station"),
                          pad_code("n_nationkey", 5).alias("code_commune_station"),
                          pad_code("n_regionkey", 2).alias("code_departement"))
    reg = table(spark, sf_dir, "region")
    return reg.select(F.col("r_regionkey").cast("string").alias("code_station"),
                      pad_code("r_regionkey", 5).alias("code_commune_station"),
                      pad_code("r_regionkey", 2).alias("code_departement"))


def communes(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """The commune dimension matching ``station_directory``."""
    d = station_directory(spark, sf_dir, grain)
    return d.select(F.col("code_commune_station").alias("code_insee")).distinct()


def derived_lat(key, mult: int = 37) -> F.Column:
    """Coordinates derived from integer keys (whole 0.01-degree steps) for the geo operators."""
    return F.lit(42.0) + F.pmod(F.col(key) * mult, F.lit(900)) / 100.0


def derived_lon(key, mult: int = 53) -> F.Column:
    return F.lit(-5.0) + F.pmod(F.col(key) * mult, F.lit(1300)) / 100.0


def commune_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The commune reference file's shape from nation ⋈ region (SEED_COMMUNES columns)."""
    nat, reg = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nat.join(reg, nat.n_regionkey == reg.r_regionkey).select(
        F.col("n_name").alias("Commune"), derived_lat("n_nationkey").alias("Latitude"),
        derived_lon("n_nationkey").alias("Longitude"), F.col("r_name").alias("Region"),
        F.col("r_name").alias("Departement"), F.col("n_regionkey").cast("string").alias("Numero_Departement"),
        F.lit("service").alias("Service"), F.col("n_nationkey").cast("string").alias("code_INSEE"),
        F.lit(None).cast("string").alias("Centroide"))
