"""Entry point A on files: landed files -> raw tables -> staging -> marts -> quality gates -> scores.

Steps are lazy DataFrames; actions happen at sink writes and at the quality gates. Staged
observations and marts are persisted by writing them, as the reference materialises them;
``fct_hydro`` is rebuilt, ``fct_weather`` is incremental.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.operators import ml, quality, tables, thresholds
from hydromart.operators.versions import LoadRejected, load_versioned
from hydromart.plans import marts, staging
from hydromart.plans.gates import QualityGateFailed, gate
from hydromart.session import checkpoint_dir
from hydromart.sources import landing, readers, schemas

__all__ = ["Paths", "QualityGateFailed", "build_marts", "daily_loads", "ingest_river_pages", "ingest_weather",
           "replace_stations", "score", "train"]


@dataclass
class Paths:
    raw_obs: str
    raw_stations: str
    raw_weather: str
    weather_history: str
    communes_csv: str
    out: str  # folder for marts and predictions
    raw_risk_frequency: str | None = None
    raw_risk_coverage: str | None = None

    def mart(self, name: str) -> str:
        return f"{self.out.rstrip('/')}/{name}"


def build_marts(spark: SparkSession, p: Paths, cutover: str = staging.WEATHER_CUTOVER,
                built_at=None, min_rows: int = 100) -> dict[str, str]:
    """Staging + dimensions + marts + quality gates; returns the written paths."""
    out = {}

    def store(name: str, df: DataFrame, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
              allow_empty: bool = False) -> DataFrame:
        tables.replace(df, p.mart(name), partition_by, allow_empty=allow_empty, sort_by=sort_by)
        out[name] = p.mart(name)
        return spark.read.parquet(out[name])

    seed = readers.read_communes_csv(spark, p.communes_csv)
    obs = staging.stg_obs(readers.read_parquet(spark, p.raw_obs, schemas.RAW_OBS)).where(
        F.col("grandeur_hydro_elab") == staging.RIVER_MEASURE)
    obs = store("stg_obs", obs)  # the top version per key is selected once for gates and mart
    stations = staging.stg_stations(readers.read_parquet(spark, p.raw_stations, schemas.RAW_STATIONS))
    weather = staging.stg_weather(readers.read_parquet(spark, p.weather_history, schemas.RAW_WEATHER_HISTORY),
                                  readers.read_parquet(spark, p.raw_weather, schemas.RAW_WEATHER),
                                  seed, cutover, built_at)
    gate({"stg_obs": obs, "stg_stations": stations}, seed_grain=quality.grain(seed.select("code_INSEE"), ["code_INSEE"]))

    communes = store("dim_commune", marts.dim_commune(seed))
    store("dim_departement", marts.dim_departement(seed))
    dim_station = store("dim_station", marts.dim_station(stations, obs))
    bounds = obs.agg(F.least(F.min("date_obs_elab"), F.lit("2000-01-01").cast("date")).alias("start"),
                     F.max("date_obs_elab").alias("end"))
    dim_date = store("dim_date", marts.dim_date_between(bounds))
    risk = {}
    if p.raw_risk_frequency:
        raw = readers.read_parquet(spark, p.raw_risk_frequency, schemas.RAW_RISK_FREQUENCY)
        risk["stg_risk_frequency"] = store("stg_risk_frequency", staging.stg_risk_frequency(raw))
    if p.raw_risk_coverage:
        raw = readers.read_parquet(spark, p.raw_risk_coverage, schemas.RAW_RISK_COVERAGE)
        risk["stg_risk_coverage"] = store("stg_risk_coverage", staging.stg_risk_coverage(raw))

    # SNK-06 layout: month partitions, rows ordered by station inside each file.
    hydro = thresholds.hydro_thresholds_mart(obs).withColumn("mois_partition", F.trunc("date_obs_elab", "MM"))
    fct_h = store("fct_hydro", hydro, ["mois_partition"], ["code_station", "date_obs_elab"]).drop("mois_partition")

    wpath = p.mart("fct_weather")
    weather = weather.withColumn("mois_partition", F.trunc("date", "MM"))
    if tables.table_exists(spark, wpath):
        # incremental: only the months holding reprocessed rows are rewritten (dynamic overwrite)
        current = spark.read.parquet(wpath)
        checkpoint_dir(spark)
        rows = tables.incremental_rows(weather.select(*current.columns), current, "date", "row_hash")
        rows = rows.checkpoint(eager=True)  # feeds the scope, the anti-join and the union: computed once
        weather = tables.upsert(current, rows, ["row_hash"], scope=["mois_partition"])
    tables.write_table(weather, wpath, ["mois_partition"], dynamic=True, sort_by=["code_insee", "date"])
    out["fct_weather"] = wpath
    fct_w = spark.read.parquet(wpath).drop("mois_partition")
    gate({"fct_weather": fct_w, "fct_hydro": fct_h, "dim_station": dim_station, "dim_date": dim_date,
          "dim_commune": communes, **risk},
         weather_grain=quality.grain(fct_w, ["code_insee", "date"]),
         hydro_thresholds_uniform=quality.thresholds_uniform(fct_h))

    st = marts.stations_with_commune(dim_station, communes)
    f = store("ml_features", marts.ml_features(fct_h, st, fct_w, min_rows=min_rows), allow_empty=True)
    gate({}, features_grain=quality.grain(f, ["code_station", "date"]),
         features_classifiable=quality.classifiable(f, fct_h),
         features_last_date_scorable=quality.last_date_scorable(f))
    return out


def train(spark: SparkSession, p: Paths, model_path: str, cutoff: str = ml.SPLIT_DATE, kind: str = "logistic") -> str:
    """ML-02..05, 14: fit on the feature mart before ``cutoff``, save, return the fingerprint."""
    model = ml.fit(ml.chronological_split(spark.read.parquet(p.mart("ml_features")), cutoff)["train"], kind)
    model.write().overwrite().save(model_path)
    return ml.model_fingerprint(spark, model_path)


def score(spark: SparkSession, p: Paths, model_path: str, expected_sha256: str | None = None,
          predicted_at=None) -> int:
    """ML-13: score the latest feature date and merge it into ``predictions``; returns its rows.

    Predictions are partitioned by date: only the scored date is read and rewritten.
    """
    features = spark.read.parquet(p.mart("ml_features"))
    gate({}, scoring_preconditions=quality.scoring_preconditions(features))
    model = ml.load_checked(model_path, expected_sha256)
    scored = ml.score_latest(model, features, predicted_at)
    day = features.agg(F.max("date")).first()[0]
    ppath = p.mart("predictions")
    if tables.table_exists(spark, ppath):
        same_day = spark.read.parquet(ppath).where(F.col("date") == F.lit(day))
        scored = ml.upsert_predictions(same_day, scored)
    tables.write_table(scored, ppath, ["date"], dynamic=True)
    return spark.read.parquet(ppath).where(F.col("date") == F.lit(day)).count()


# Landed river API pages: {request_id, page, count, data[]} with the records as delivered.
RIVER_PAGE_SCHEMA = (
    "request_id string, page int, count int, data array<struct<"
    "code_site: string, code_station: string, date_obs_elab: string, resultat_obs_elab: double, "
    "date_prod: string, code_statut: string, libelle_statut: string, code_methode: string, "
    "libelle_methode: string, code_qualification: string, libelle_qualification: string, "
    "longitude: double, latitude: double, grandeur_hydro_elab: string>>")


def _now(inserted_at):
    """The one instant of a load, known before it starts so that its rows can be taken back."""
    return inserted_at if inserted_at is not None else dt.datetime.now(dt.timezone.utc)


@contextmanager
def taken_back_on_failure(spark: SparkSession, loads: Sequence[tuple[str, str]], inserted_at):
    """SNK-05 around loads of (table path, batch id): when anything inside fails, at whatever point,
    the rows that carry the batch id and this instant are removed again, appended or half appended."""
    try:
        yield
    except Exception:
        for path, batch_id in loads:
            if tables.table_exists(spark, path):
                parts = ["mois"] if "mois" in spark.read.parquet(path).columns else []
                tables.rollback_table(spark, path, batch_id, parts, inserted_at=inserted_at)
        raise


def ingest_river_pages(spark: SparkSession, landing_path: str, raw_path: str, batch_id: str,
                       inserted_at=None, partition_by=("mois",), set_aside: str | None = None) -> dict:
    """Entry point A steps 2-3 on landed files: JSON lines -> pages -> records -> versioned raw table.

    A line that cannot be read as a page, or a request whose pages do not add up to its announced
    count (SRC-05), refuses the load. With ``set_aside`` (a folder) such lines and the pages of such
    requests are appended there as text with their reason, and the rest is loaded. Keeps the expected
    columns (SRC-06), sets aside records without a station (SRC-07) and appends the changed versions
    (VER-01..06). Everything is counted before the append; a failure after it takes the rows back.
    Returns the appended and rejected records, and the lines and pages set aside.
    """
    checkpoint_dir(spark)
    lines = spark.read.text(landing_path).where(F.trim("value") != "")  # blank lines between documents
    parsed = landing.parse_json_pages(lines, RIVER_PAGE_SCHEMA).checkpoint(eager=True)
    unreadable = landing.json_rejects(parsed)
    n_unreadable = unreadable.count()
    requests = landing.complete_requests(landing.json_documents(parsed), all_readable=n_unreadable == 0)
    n_incomplete = requests["incomplete"].count()
    if set_aside is None and n_unreadable + n_incomplete:
        raise LoadRejected(f"{n_unreadable} unreadable lines and {n_incomplete} pages of incomplete requests in {landing_path}")
    if n_unreadable + n_incomplete:
        short = requests["incomplete"].select(F.to_json(F.struct("*")).alias("value"), F.lit("incomplete request").alias("reason"))
        tables.append(unreadable.select("value", "reason").unionByName(short).withColumn("batch_id", F.lit(batch_id)), set_aside)
    records = readers.keep_columns(landing.explode_pages(requests["complete"], strict=False), schemas.RIVER_OBS_COLUMNS)
    records = records.withColumn("date_prod", F.col("date_prod").try_cast("timestamp"))
    parts = readers.split_missing(records, "code_station")
    rejected = parts["rejected"].count()
    stamp = _now(inserted_at)
    with taken_back_on_failure(spark, [(raw_path, batch_id)], stamp):
        appended = load_versioned(spark, raw_path, parts["kept"], "river", batch_id, stamp,
                                  content=schemas.RIVER_OBS_COLUMNS, partition_by=partition_by)
    out = {"appended": appended, "rejected": rejected}
    return out if set_aside is None else {**out, "set_aside": n_unreadable + n_incomplete}


# Landed weather documents: one per place, parallel daily arrays as delivered.
WEATHER_DOC_SCHEMA = (
    "code_INSEE string, Latitude double, Longitude double, daily struct<time: array<string>, "
    + ", ".join(f"{v}: array<double>" for v in schemas.WEATHER_VARIABLES) + ">")


def ingest_weather(spark: SparkSession, landing_path: str, requested: DataFrame, raw_path: str, batch_id: str,
                   inserted_at=None, partition_by: Sequence[str] = ("mois",)) -> dict:
    """Landed weather documents -> daily rows -> versioned raw table (SRC-04, VER-01..06).

    Refuses the load when a line cannot be read, when a document is inconsistent, or when the places
    answered are not exactly the ``requested`` ones (column ``code_INSEE``), each once. Returns the
    appended count; a failure after the append takes the rows back.
    """
    checkpoint_dir(spark)
    lines = spark.read.text(landing_path).where(F.trim("value") != "")
    parsed = landing.parse_json(lines, WEATHER_DOC_SCHEMA, required=("code_INSEE", "daily")).checkpoint(eager=True)
    unreadable = landing.json_rejects(parsed).count()
    if unreadable:
        raise LoadRejected(f"{unreadable} unreadable weather documents in {landing_path}")
    docs = landing.json_documents(parsed)
    problems = landing.series_problems(docs, schemas.WEATHER_VARIABLES, ["code_INSEE"])
    if not problems.isEmpty():
        raise LoadRejected(f"inconsistent weather documents in {landing_path}")
    asked = requested.select("code_INSEE").distinct().withColumn("_asked", F.lit(True))
    answers = docs.groupBy("code_INSEE").agg(F.count(F.lit(1)).alias("_n"))
    odd = asked.join(answers, "code_INSEE", "full").where(F.col("_asked").isNull() | F.coalesce(F.col("_n") != 1, F.lit(True)))
    if not odd.isEmpty():
        raise LoadRejected(f"not one answer per requested place in {landing_path}")
    rows = landing.explode_series(docs, schemas.WEATHER_VARIABLES, ["code_INSEE", "Latitude", "Longitude"])
    content = ["Latitude", "Longitude", "code_INSEE", "date", *schemas.WEATHER_VARIABLES]
    rows = rows.withColumn("date", F.col("time")).withColumn("weather_code", F.col("weather_code").cast("long"))
    stamp = _now(inserted_at)
    with taken_back_on_failure(spark, [(raw_path, batch_id)], stamp):
        return {"appended": load_versioned(spark, raw_path, rows.select(*content), "weather", batch_id, stamp,
                                           content=content, partition_by=partition_by)}


def replace_stations(spark: SparkSession, snapshot: DataFrame, path: str, low: int = 2700, high: int = 3300) -> int:
    """SNK-02 + DQ-08: replace the station snapshot, refused when its count is implausible."""
    n = quality.count_range(snapshot, "code_station", low, high).first()
    if not n.in_range:
        raise LoadRejected(f"{n.n} stations, expected {low} to {high}")
    tables.replace(snapshot, path)
    return n.n


def daily_loads(spark: SparkSession, p: Paths, batch_id: str, river_pages: str | None = None,
                weather_docs: str | None = None, requested: DataFrame | None = None, inserted_at=None) -> dict:
    """Both raw loads as one: whatever fails, and wherever, nothing of this batch stays in either table."""
    stamp = _now(inserted_at)
    loaded: dict[str, dict] = {}
    with taken_back_on_failure(spark, [(p.raw_obs, batch_id), (p.raw_weather, batch_id)], stamp):
        if river_pages:
            loaded[p.raw_obs] = ingest_river_pages(spark, river_pages, p.raw_obs, batch_id, stamp)
        if weather_docs:
            loaded[p.raw_weather] = ingest_weather(spark, weather_docs, requested, p.raw_weather, batch_id, stamp)
    return loaded
