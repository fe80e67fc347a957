"""Upserts, change-only merges, replace guard, self-overwrite."""

import datetime as dt

import pytest

from hydromart.operators import ml, tables

T = "k string, d date, v double, row_hash string"
D = dt.date


def test_upsert_replay_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", D(2026, 1, 1), 1.0, "h1"), ("b", D(2026, 1, 1), 1.0, "h2")], T)
    src = spark.createDataFrame([("b", D(2026, 1, 1), 2.0, "h3"), ("c", D(2026, 1, 1), 3.0, "h4")], T)
    once = tables.upsert(tgt, src, ["k"])
    twice = tables.upsert(once, src, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    c = tables.upsert_counts(once, src, ["k"]).first()
    assert (c.inserted, c.updated) == (0, 2)
    c0 = tables.upsert_counts(tgt, src, ["k"]).first()
    assert (c0.inserted, c0.updated) == (1, 1)


def test_upsert_changed_only_actions(spark):
    tgt = spark.createDataFrame([("a", D(2026, 1, 1), 1.0, "h1"), ("b", D(2026, 1, 1), 1.0, "h2"),
                                 ("z", D(2026, 1, 1), 9.0, None)], T)
    src = spark.createDataFrame([("a", D(2026, 1, 1), 1.0, "h1"), ("b", D(2026, 1, 1), 2.0, "h3"),
                                 ("c", D(2026, 1, 1), 3.0, "h4"), ("z", D(2026, 1, 1), 9.0, None)], T)
    got = {r.k: (r._action, r.v) for r in tables.upsert_changed_only(tgt, src, ["k"]).collect()}
    assert got == {"a": ("keep", 1.0), "b": ("update", 2.0), "c": ("insert", 3.0), "z": ("keep", 9.0)}


def test_upsert_changed_only_scope_limits_partitions(spark):
    tgt = spark.createDataFrame([("a", "2026-01", "h1"), ("b", "2026-02", "h2")], "k string, mois string, row_hash string")
    src = spark.createDataFrame([("a", "2026-01", "h9")], "k string, mois string, row_hash string")
    got = tables.upsert_changed_only(tgt, src, ["k"], scope=["mois"]).collect()
    assert [(r.k, r._action) for r in got] == [("a", "update")]


def test_replace_refuses_empty(spark, tmp_path):
    with pytest.raises(tables.EmptyInputError):
        tables.replace(spark.createDataFrame([], T), str(tmp_path / "t"))


def test_write_table_can_overwrite_its_own_input(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append(spark.createDataFrame([("a", D(2026, 1, 1), 1.0, "h1")], T), path)
    cur = spark.read.parquet(path)
    tables.write_table(tables.upsert(cur, spark.createDataFrame([("b", D(2026, 1, 2), 2.0, "h2")], T), ["k"]), path)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_prediction_upsert_keeps_history(spark):
    cols = ml.PREDICTION_COLUMNS
    ts = dt.datetime(2026, 10, 5)

    def row(day, st, p):
        return (D(2026, 10, day), st, "37001", "37", 0.1, 0.0, 1.0, 2.0, 0.2, p, 0.5, ts)
    schema = ("date date, code_station string, code_insee string, code_departement string, position_p95 double, "
              "variation_position_1j double, pluie_j double, pluie_3j double, humidite_sol double, "
              "prediction_j1 long, probabilite_depassement_j1 double, date_prediction timestamp")
    hist = spark.createDataFrame([row(3, "S1", 0), row(4, "S1", 0)], schema)
    new = spark.createDataFrame([row(4, "S1", 1), row(4, "S2", 1)], schema)
    merged = ml.upsert_predictions(hist, new)
    got = sorted((r.date.day, r.code_station, r.prediction_j1) for r in merged.select(*cols).collect())
    assert got == [(3, "S1", 0), (4, "S1", 1), (4, "S2", 1)]
    c = tables.upsert_counts(merged, new, ml.PREDICTION_KEYS).first()
    assert (c.inserted, c.updated) == (0, 2)


def test_add_missing_columns(spark):
    from pyspark.sql.types import StructType, StructField, StringType
    df = spark.createDataFrame([("a",)], "k string")
    out = tables.add_missing_columns(df, StructType([StructField("k", StringType()), StructField("batch_id", StringType())]))
    assert out.columns == ["k", "batch_id"] and out.first().batch_id is None


def test_incremental_merge_never_deletes(spark):
    mart = spark.createDataFrame([("h1", D(2026, 1, 1), 1.0), ("gone", D(2026, 1, 2), 1.0)], "row_hash string, date date, v double")
    src = spark.createDataFrame([("h1", D(2026, 1, 1), 5.0)], "row_hash string, date date, v double")
    got = {r.row_hash: r.v for r in tables.incremental_merge(src, mart, "date").collect()}
    assert got == {"h1": 5.0, "gone": 1.0}


def test_csv_append_writes_a_header_per_file(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    tables.append_csv_with_header(df.coalesce(1), path, sep=";")
    tables.append_csv_with_header(df.coalesce(1), path, sep=";")
    back = spark.read.option("header", True).option("sep", ";").schema("k string, n int").csv(path)
    assert sorted(tuple(r) for r in back.collect()) == [("a", 1), ("a", 1)]
