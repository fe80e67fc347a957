"""Versioned raw loads: the reference's replay / A->B->A / conflict / rollback cases."""

import datetime as dt

import pytest

from hydromart.operators import tables, versions as V

WEATHER = "code_INSEE string, date string, rain_sum double"
RIVER = ("code_station string, date_obs_elab string, grandeur_hydro_elab string, "
         "resultat_obs_elab double, date_prod string")


def wrow(v, code="37001", date="2026-10-01"):
    return (code, date, v)


def rrow(v, prod="2026-10-02T12:00:00Z"):
    return ("S1", "2026-10-01", "HIXnJ", v, prod)


def load(spark, path, data, source, batch, at=None):
    schema = WEATHER if source == "weather" else RIVER
    df = spark.createDataFrame(data, schema)
    ts = at or dt.datetime(2026, 10, 5, 12, 0, 0) + dt.timedelta(minutes=len(batch) + hash(batch) % 1000)
    return V.load_versioned(spark, path, df, source, batch, inserted_at=ts)


@pytest.mark.parametrize("source,mk", [("weather", wrow), ("river", rrow)])
def test_replay_and_return_to_previous_content(spark, tmp_path, source, mk):
    path = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    seq = [("a1", 1.0), ("a2", 1.0), ("b", 2.0), ("a3", 1.0), ("a4", 1.0)]
    got = [load(spark, path, [mk(v)], source, b, t0 + dt.timedelta(hours=i)) for i, (b, v) in enumerate(seq)]
    assert got == [1, 0, 1, 1, 0]
    hist = spark.read.parquet(path)
    assert sorted(r.batch_id for r in hist.collect()) == ["a1", "a3", "b"]


def test_independent_keys_and_null_key_rows(spark, tmp_path):
    path = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    three = [wrow(1.0, "37001"), wrow(1.0, "37002"), wrow(1.0, "37003")]
    assert load(spark, path, three, "weather", "b1", t0) == 3
    # an old row with a NULL key in the table must not block anything
    old = spark.read.parquet(path).limit(1).selectExpr(
        "CAST(NULL AS STRING) AS code_INSEE", "date", "rain_sum", "row_hash", "inserted_at", "batch_id")
    tables.append(old, path)
    changed = [wrow(2.0, "37001"), wrow(1.0, "37002"), wrow(1.0, "37003")]
    assert load(spark, path, changed, "weather", "b2", t0 + dt.timedelta(hours=1)) == 1
    assert load(spark, path, changed, "weather", "b3", t0 + dt.timedelta(hours=2)) == 0


def test_identical_duplicates_collapse_contradictions_abort(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert load(spark, path, [wrow(1.0), wrow(1.0)], "weather", "d1") == 1
    with pytest.raises(V.LoadRejected):
        load(spark, path, [wrow(2.0), wrow(3.0)], "weather", "d2")
    assert spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("bad", [
    (None, "2026-10-01", 1.0), ("37001", None, 1.0), ("37001", "invalide", 1.0), ("123456", "2026-10-01", 1.0),
])
def test_invalid_keys_are_rejected(spark, tmp_path, bad):
    path = str(tmp_path / "raw")
    with pytest.raises(V.LoadRejected):
        load(spark, path, [bad], "weather", "x")
    assert not tables.table_exists(spark, path)


def test_unknown_source_rejected(spark, tmp_path):
    df = spark.createDataFrame([wrow(1.0)], WEATHER)
    with pytest.raises(V.LoadRejected):
        V.load_versioned(spark, str(tmp_path / "raw"), df, "other", "x")


def test_empty_batch_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert V.load_versioned(spark, path, spark.createDataFrame([], WEATHER), "weather", "e") == 0
    assert not tables.table_exists(spark, path)


def test_key_normalisation(spark, tmp_path):
    path = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    assert load(spark, path, [wrow(1.0, " 1234 ")], "weather", "n1", t0) == 1
    assert load(spark, path, [wrow(1.0, "01234")], "weather", "n2", t0 + dt.timedelta(hours=1)) == 1
    assert load(spark, path, [wrow(1.0, "01234")], "weather", "n3", t0 + dt.timedelta(hours=2)) == 0
    assert spark.read.parquet(path).count() == 2


def test_old_row_without_hash_counts_as_different(spark, tmp_path):
    path = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    old = spark.createDataFrame([("37001", dt.date(2026, 10, 1), 1.0, None, t0, "legacy")],
                                "code_INSEE string, date date, rain_sum double, row_hash string, "
                                "inserted_at timestamp, batch_id string")
    tables.append(old, path)
    assert load(spark, path, [wrow(1.0)], "weather", "h1", t0 + dt.timedelta(hours=1)) == 1
    assert load(spark, path, [wrow(1.0)], "weather", "h2", t0 + dt.timedelta(hours=2)) == 0


def test_rollback_restores_previous_version(spark, tmp_path):
    path = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    assert load(spark, path, [wrow(1.0)], "weather", "A", t0) == 1
    assert load(spark, path, [wrow(2.0)], "weather", "B", t0 + dt.timedelta(hours=1)) == 1
    tables.rollback_table(spark, path, "B")
    assert load(spark, path, [wrow(1.0)], "weather", "A2", t0 + dt.timedelta(hours=2)) == 0
    assert spark.read.parquet(path).count() == 1


def test_rollback_partitioned_table_including_emptied_partition(spark, tmp_path):
    path = str(tmp_path / "raw")
    data = [("37001", dt.date(2026, 9, 1), 1.0, "h1", dt.datetime(2026, 10, 1), "A", "2026-09"),
            ("37001", dt.date(2026, 10, 1), 1.0, "h2", dt.datetime(2026, 10, 1), "A", "2026-10"),
            ("37001", dt.date(2026, 10, 1), 2.0, "h3", dt.datetime(2026, 10, 2), "B", "2026-10"),
            ("37001", dt.date(2026, 11, 1), 2.0, "h4", dt.datetime(2026, 10, 2), "B", "2026-11")]
    df = spark.createDataFrame(data, "code_INSEE string, date date, rain_sum double, row_hash string, "
                                     "inserted_at timestamp, batch_id string, mois string")
    tables.append(df, path, ["mois"])
    tables.rollback_table(spark, path, "B", ["mois"])
    left = spark.read.parquet(path)
    assert sorted(r.row_hash for r in left.collect()) == ["h1", "h2"]


def test_tie_order_prefers_latest_production_time(spark):
    t = dt.datetime(2026, 10, 5)
    raw = spark.createDataFrame(
        [("S1", "2026-10-01", "HIXnJ", 1.0, dt.datetime(2026, 10, 2, 10), "x", t, "b"),
         ("S1", "2026-10-01", "HIXnJ", 2.0, dt.datetime(2026, 10, 2, 12), "y", t, "b")],
        "code_station string, date_obs_elab string, grandeur_hydro_elab string, resultat_obs_elab double, "
        "date_prod timestamp, row_hash string, inserted_at timestamp, batch_id string")
    cur = V.latest_versions(raw, ["code_station", "date_obs_elab", "grandeur_hydro_elab"],
                            ["inserted_at", "date_prod", "row_hash"])
    assert [r.resultat_obs_elab for r in cur.collect()] == [2.0]


def test_null_inserted_at_ranks_last(spark):
    raw = spark.createDataFrame([("k", None, 1.0), ("k", dt.datetime(2026, 1, 1), 2.0)],
                                "k string, inserted_at timestamp, v double")
    assert [r.v for r in V.latest_versions(raw, ["k"], ["inserted_at"]).collect()] == [2.0]


def test_content_hash_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    hashes = [r.h for r in df.select(V.content_hash(["x", "y"]).alias("h")).collect()]
    assert hashes[0] != hashes[1]


def test_month_partitioned_raw_table(spark, tmp_path):
    path = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    data = [wrow(1.0, "37001", "2026-09-30"), wrow(1.0, "37001", "2026-10-01")]
    assert V.load_versioned(spark, path, spark.createDataFrame(data, WEATHER), "weather", "m1",
                            inserted_at=t0, partition_by=["mois"]) == 2
    data2 = [wrow(2.0, "37001", "2026-10-01"), wrow(1.0, "37001", "2026-09-30")]
    assert V.load_versioned(spark, path, spark.createDataFrame(data2, WEATHER), "weather", "m2",
                            inserted_at=t0 + dt.timedelta(hours=1), partition_by=["mois"]) == 1
    assert sorted(r.mois for r in spark.read.parquet(path).select("mois").distinct().collect()) == ["2026-09", "2026-10"]
    tables.rollback_table(spark, path, "m2", ["mois"])
    assert spark.read.parquet(path).count() == 2
