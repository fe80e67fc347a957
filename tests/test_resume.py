"""Resume windows, incremental mart selection, month chunks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hydromart.operators import tables, versions as V

D = dt.date


@pytest.mark.parametrize("last,expected", [
    (D(2026, 10, 3), D(2026, 8, 30)), (D(2026, 8, 1), D(2026, 8, 2)),
    (D(2026, 8, 29), D(2026, 8, 30)), (None, D(2026, 8, 30))])
def test_revision_window(spark, last, expected):
    df = spark.createDataFrame([(last,)], "last date")
    got = df.select(V.resume_start("last", D(2026, 10, 4), 35).alias("s")).first().s
    assert got == expected


def test_per_entity_plan_with_floor(spark):
    ents = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "code string")
    loaded = spark.createDataFrame([("b", D(2026, 8, 1)), ("c", D(2026, 8, 2))], "code string, date date")
    plan_a_b = {r.code: r.start_date for r in
                V.resume_plan(ents, loaded, "code", "date", D(2026, 10, 4), D(2026, 8, 1)).collect()}
    assert plan_a_b["a"] == D(2026, 8, 1) and plan_a_b["b"] == D(2026, 8, 2)
    plan_c = {r.code: r.start_date for r in
              V.resume_plan(ents, loaded, "code", "date", D(2026, 8, 4), D(2026, 8, 1)).collect()}
    assert plan_c["c"] == D(2026, 8, 1) and None not in plan_c


def test_river_resume_dates(spark):
    df = spark.range(1).select(V.resume_start(F.lit(D(2026, 8, 1)), V.resume_end(D(2026, 10, 11))).alias("s"),
                               V.resume_end(D(2026, 10, 11)).alias("e")).first()
    assert (df.s, df.e) == (D(2026, 8, 2), D(2026, 10, 4))


def test_incremental_selection(spark):
    mart = spark.createDataFrame([("ancien", D(2026, 8, 1)), ("recent", D(2026, 10, 4))], "row_hash string, date date")
    src = mart.unionByName(spark.createDataFrame([("manquant", D(2026, 8, 2))], "row_hash string, date date"))
    got = {r.row_hash for r in tables.incremental_rows(src, mart, "date", "row_hash", 35).collect()}
    assert got == {"manquant", "recent"}


def test_month_chunks_cut_at_end_and_skip_ledger(spark):
    w = spark.createDataFrame([(D(2026, 8, 20), D(2026, 10, 4))], "start_date date, end_date date")
    chunks = V.month_chunks(w)
    got = [(r.chunk_start, r.chunk_end) for r in chunks.orderBy("mois").collect()]
    assert got == [(D(2026, 8, 20), D(2026, 8, 31)), (D(2026, 9, 1), D(2026, 9, 30)), (D(2026, 10, 1), D(2026, 10, 4))]
    ledger = spark.createDataFrame([(D(2026, 9, 1),)], "mois date")
    assert V.pending_chunks(chunks, ledger).count() == 2


def test_legacy_rule(spark):
    df = spark.createDataFrame([(D(2026, 10, 1),), (None,)], "last date")
    got = [r.s for r in df.select(V.legacy_resume_start("last", D(2026, 9, 1)).alias("s")).collect()]
    assert got == [D(2026, 9, 1), D(2026, 9, 1)]
