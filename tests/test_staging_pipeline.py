"""Weather staging (two location schemas, cut-over, fuzzy join) and the daily pipeline on files."""

import datetime as dt

from pyspark.sql import functions as F

from hydromart.operators import ml
from hydromart.plans import pipeline, staging
from hydromart.sources import schemas

D = dt.date
SEED = [("Saint-Chély-d'Apcher", 44.8, 3.27, "Occitanie", "Lozère", "48", "s", "48140", None),
        ("Tours", 47.39, 0.69, "Centre", "Indre-et-Loire", "37", "s", "37261", None),
        ("Ajaccio", 41.92, 8.74, "Corse", "Corse-du-Sud", "2A", "s", "2A004", None)]


def weather_vars(v):
    return {name: v for name in schemas.WEATHER_VARIABLES}


def history_rows(spark, rows):
    out = []
    for time, poi, dept_txt, ville, dept_num, v in rows:
        d = {"time": time, "nom_poi": poi, "numero_departement": dept_txt, "latitude_poi": 1.0 if poi else None,
             "longitude_poi": 2.0 if poi else None, "Ville": ville, "Departement": dept_num,
             "Latitude": 3.0 if ville else None, "Longitude": 4.0 if ville else None}
        d.update(weather_vars(v))
        out.append(d)
    return spark.createDataFrame(out, schemas.RAW_WEATHER_HISTORY)


def daily_rows(spark, rows):
    out = []
    for code, date, v, ts in rows:
        d = {"Latitude": 5.0, "Longitude": 6.0, "code_INSEE": code, "date": date, "row_hash": f"h{v}",
             "inserted_at": ts, "batch_id": "b"}
        d.update(weather_vars(v))
        d["weather_code"] = 3
        out.append(d)
    return spark.createDataFrame(out, schemas.RAW_WEATHER)


def test_weather_staging_schemas_cutover_and_join(spark):
    seed = spark.createDataFrame(SEED, schemas.SEED_COMMUNES)
    hist = history_rows(spark, [
        ("2026-07-31", "Saint-Chely-d'Apcher", "48", None, None, 1.0),     # POI schema, accents differ
        ("2026-07-31", None, None, "Tours", 37.0, 2.0),                     # town schema, float department
        ("2026-08-01", None, None, "Tours", 37.0, 9.0),                     # on the cut-over: history dropped
        ("2026-07-31", None, None, "Nowhere", 12.0, 4.0)])                  # no match: NULL code
    daily = daily_rows(spark, [
        ("37261", D(2026, 7, 31), 8.0, dt.datetime(2026, 8, 1)),            # before the cut-over: dropped
        ("37261", D(2026, 8, 1), 5.0, dt.datetime(2026, 8, 2)),
        ("37261", D(2026, 8, 1), 6.0, dt.datetime(2026, 8, 3))])           # newer version wins
    out = staging.stg_weather(hist, daily, seed, built_at="2026-10-05T00:00:00")
    got = sorted(((r.date, r.code_insee, r.departement, r.pluie_totale) for r in out.collect()), key=repr)
    assert got == sorted([(D(2026, 7, 31), None, "12", 4.0), (D(2026, 7, 31), "37261", "37", 2.0),
                          (D(2026, 7, 31), "48140", "48", 1.0), (D(2026, 8, 1), "37261", "37", 6.0)], key=repr)
    by_code = {r.code_insee: r for r in out.collect()}
    assert by_code["48140"].ville == "Saint-Chely-d'Apcher" and by_code["48140"].latitude == 1.0
    assert set(out.columns) >= {"row_hash", "insere_a", "code_meteo", "humidite_sol_7_28cm"}


def _write_raw(spark, base):
    """A small but complete set of raw files: 2 stations, 6 years of daily data."""
    import random
    rnd = random.Random(7)
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(6 * 365)]
    obs, weather = [], []
    t = dt.datetime(2026, 10, 1)
    for st, code in (("S1", "37261"), ("S2", "48140")):
        for d in days:
            x = rnd.gauss(1.0, 0.3)
            obs.append(("site", st, d, x, t, "16", "", "", "", "20", "", 0.0, 0.0, "HIXnJ", f"{st}{d}", t, "b0"))
            w = {"Latitude": 0.0, "Longitude": 0.0, "code_INSEE": code, "date": d, "row_hash": f"{code}{d}",
                 "inserted_at": t, "batch_id": "b0"}
            w.update(weather_vars(float(rnd.randint(0, 5))))
            w["weather_code"] = 1
            weather.append(w)
    spark.createDataFrame(obs, schemas.RAW_OBS).write.parquet(f"{base}/raw_obs")
    spark.createDataFrame(weather, schemas.RAW_WEATHER).write.parquet(f"{base}/raw_weather")
    st_rows = [("S1", "site", "Tours amont", "37261", "Tours", "37", "", "", "", "", "", 47.4, 0.7,
                dt.datetime(1899, 12, 31), None, True),
               ("S2", "site", "Lozère", "48140", "", "48", "", "", "", "", "", 44.8, 3.3, None, None, True),
               ("S3", "site", "unused", "99999", "", "99", "", "", "", "", "", 44.0, 3.0, None, None, False)]
    spark.createDataFrame(st_rows, schemas.RAW_STATIONS).write.parquet(f"{base}/raw_stations")
    hist = history_rows(spark, [("2019-12-31", None, None, "Tours", 37.0, 1.0)])
    hist.write.parquet(f"{base}/history")
    seed = spark.createDataFrame(SEED, schemas.SEED_COMMUNES)
    seed.write.option("header", True).option("sep", ";").csv(f"{base}/communes")


def test_daily_pipeline_end_to_end(spark, tmp_path):
    base = str(tmp_path)
    _write_raw(spark, base)
    p = pipeline.Paths(f"{base}/raw_obs", f"{base}/raw_stations", f"{base}/raw_weather", f"{base}/history",
                       f"{base}/communes", f"{base}/marts")
    out = pipeline.build_marts(spark, p, cutover="2000-01-01", built_at="2026-10-05T00:00:00")
    f = spark.read.parquet(out["ml_features"])
    n = f.count()
    assert n > 0 and {r.code_station for r in f.select("code_station").distinct().collect()} <= {"S1", "S2"}
    # second run: incremental weather merge and rebuilt hydro mart are idempotent
    pipeline.build_marts(spark, p, cutover="2000-01-01", built_at="2026-10-05T00:00:00")
    f = spark.read.parquet(out["ml_features"])
    assert f.count() == n
    assert spark.read.parquet(out["fct_weather"]).count() == 2 * 6 * 365
    model = ml.fit(ml.chronological_split(f, "2025-01-01")["train"])
    mpath = f"{base}/model"
    model.save(mpath)
    n1 = pipeline.score(spark, p, mpath, ml.model_fingerprint(spark, mpath), "2026-10-05T06:00:00")
    n2 = pipeline.score(spark, p, mpath, None, "2026-10-05T07:00:00")
    preds = spark.read.parquet(p.mart("predictions"))
    assert n1 == n2 == preds.count() == f.where(F.col("date") == f.agg(F.max("date")).first()[0]).count()


def test_console_entry_builds_marts(spark, tmp_path):
    from hydromart.__main__ import main
    base = str(tmp_path)
    _write_raw(spark, base)
    out = main(["--raw-obs", f"{base}/raw_obs", "--raw-stations", f"{base}/raw_stations",
                "--raw-weather", f"{base}/raw_weather", "--weather-history", f"{base}/history",
                "--communes-csv", f"{base}/communes", "--out", f"{base}/marts", "--cutover", "2000-01-01",
                "--profile", "local"])
    assert set(out["marts"]) == {"stg_obs", "dim_commune", "dim_departement", "dim_station", "dim_date", "fct_hydro",
                                 "fct_weather", "ml_features"}
    assert spark.read.parquet(out["marts"]["ml_features"]).count() > 0


def test_ingest_landed_pages(spark, tmp_path):
    import json
    import pytest
    from hydromart.operators.versions import LoadRejected

    def rec(st, d, v):
        return {"code_site": "X", "code_station": st, "date_obs_elab": d, "resultat_obs_elab": v,
                "date_prod": "2026-10-02T12:00:00Z", "code_statut": "16", "code_qualification": "20",
                "grandeur_hydro_elab": "HIXnJ", "extra_field": "dropped"}
    land = tmp_path / "landing"
    land.mkdir()
    pages = [{"request_id": "r1", "page": 1, "count": 3, "data": [rec("S1", "2026-10-01", 1.0), rec("S2", "2026-10-01", 2.0)]},
             {"request_id": "r1", "page": 2, "data": [rec(None, "2026-10-01", 3.0)]}]
    (land / "p.json").write_text("\n".join(json.dumps(p) for p in pages))
    raw = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    assert pipeline.ingest_river_pages(spark, str(land), raw, "b1", t0) == {"appended": 2, "rejected": 1}
    assert pipeline.ingest_river_pages(spark, str(land), raw, "b2", t0 + dt.timedelta(hours=1)) == \
        {"appended": 0, "rejected": 1}
    assert set(spark.read.parquet(raw).columns) >= set(schemas.RIVER_OBS_COLUMNS) | {"row_hash", "mois"}
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "p.json").write_text(json.dumps({"request_id": "r2", "page": 1, "count": 5, "data": [rec("S1", "2026-10-02", 1.0)]}))
    with pytest.raises(LoadRejected):
        pipeline.ingest_river_pages(spark, str(bad), raw, "b3")


def _weather_doc(code, days, rain):
    return {"code_INSEE": code, "Latitude": 47.0, "Longitude": 0.7,
            "daily": {"time": days, **{v: [float(rain)] * len(days) for v in schemas.WEATHER_VARIABLES}}}


def test_landed_files_to_predictions_and_rollback(spark, tmp_path):
    import json
    import pytest
    from hydromart.operators.versions import LoadRejected
    base = str(tmp_path)
    days = [(D(2020, 1, 1) + dt.timedelta(days=i)).isoformat() for i in range(6 * 365)]
    river, weather = tmp_path / "river", tmp_path / "weather"
    for folder in (river, weather):
        folder.mkdir()
    data = [{"code_site": "X", "code_station": "S1", "date_obs_elab": d, "resultat_obs_elab": float((i * 37) % 101),
             "date_prod": "2026-10-02T12:00:00Z", "code_statut": "16", "code_qualification": "20", "grandeur_hydro_elab": "HIXnJ"}
            for i, d in enumerate(days)]
    (river / "p.json").write_text(json.dumps({"request_id": "r", "page": 1, "count": len(data), "data": data}))
    (weather / "w.json").write_text("\n".join(json.dumps(_weather_doc(c, days, 1)) for c in ("37261", "48140")))
    _write_raw(spark, f"{base}/seeded")
    requested = spark.createDataFrame([("37261",), ("48140",)], "code_INSEE string")
    risk = spark.createDataFrame([("Code_INSEE", "c", "f"), ("37261", " Tours ", "1"), (None, None, None)], schemas.RAW_RISK_FREQUENCY)
    risk.write.parquet(f"{base}/risk")
    p = pipeline.Paths(f"{base}/raw_obs", f"{base}/seeded/raw_stations", f"{base}/raw_weather", f"{base}/seeded/history",
                       f"{base}/seeded/communes", f"{base}/marts", raw_risk_frequency=f"{base}/risk")
    t0 = dt.datetime(2026, 10, 5)
    pipeline.daily_loads(spark, p, "b1", str(river), str(weather), requested, t0)
    before = {path: spark.read.parquet(path).count() for path in (p.raw_obs, p.raw_weather)}
    assert before == {p.raw_obs: len(days), p.raw_weather: 2 * len(days)}

    out = pipeline.build_marts(spark, p, cutover="2000-01-01", built_at=t0.isoformat())
    assert spark.read.parquet(out["stg_risk_frequency"]).count() == 1
    assert spark.read.parquet(out["dim_date"]).count() > len(days)
    sha = pipeline.train(spark, p, f"{base}/model", "2025-01-01")
    assert pipeline.score(spark, p, f"{base}/model", sha, "2026-10-05T06:00:00") == 1

    # the second day: new river values, but one place has no weather answer -> nothing of the batch stays
    data[0]["resultat_obs_elab"] = 500.0
    late, short = tmp_path / "river2", tmp_path / "weather2"
    late.mkdir()
    short.mkdir()
    (late / "p.json").write_text(json.dumps({"request_id": "r", "page": 1, "count": 1, "data": data[:1]}))
    (short / "w.json").write_text(json.dumps(_weather_doc("37261", days[:3], 2)))
    with pytest.raises(LoadRejected, match="one answer per requested place"):
        pipeline.daily_loads(spark, p, "b2", str(late), str(short), requested, t0 + dt.timedelta(days=1))
    assert {path: spark.read.parquet(path).count() for path in before} == before
    assert spark.read.parquet(p.raw_obs).where("batch_id = 'b2'").isEmpty()


def test_gates_name_the_broken_rules(spark):
    import pytest
    from hydromart.plans import gates
    stations = spark.createDataFrame([("S1", True), ("S1", None)], "code_station string, en_service boolean")
    obs = spark.createDataFrame([("h", "S1", "2026-01-01", "X"), ("h", "S9", None, "X")],
                                "row_hash string, code_station string, date_obs_elab string, grandeur_hydro_elab string")
    got = {r.rule: r.n for r in gates.failures({"stg_obs": obs, "stg_stations": stations}).collect()}
    assert got == {"stg_obs.date_obs_elab not null": 1, "stg_obs.row_hash unique": 1, "stg_obs.code_station in stg_stations": 1,
                   "stg_stations.en_service not null": 1, "stg_stations.code_station unique": 1}
    with pytest.raises(gates.QualityGateFailed, match="row_hash unique"):
        gates.gate({"stg_obs": obs})


def test_implausible_station_snapshot_is_refused(spark, tmp_path):
    import pytest
    from hydromart.operators.versions import LoadRejected
    path = str(tmp_path / "stations")
    snapshot = spark.range(30).selectExpr("CAST(id AS STRING) AS code_station")
    assert pipeline.replace_stations(spark, snapshot, path, 20, 40) == 30
    with pytest.raises(LoadRejected):
        pipeline.replace_stations(spark, snapshot.limit(3), path, 20, 40)
    assert spark.read.parquet(path).count() == 30
