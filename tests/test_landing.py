"""Landed payloads: parallel-array series and page envelopes."""

import pytest

from hydromart.sources import landing, readers

DOC = "place string, daily struct<time: array<string>, temperature_2m_mean: array<double>, rain_sum: array<double>>"


def test_series_explode_and_checks(spark):
    docs = spark.createDataFrame([
        ("ok", (["2026-10-01", "2026-10-02", "2026-10-03"], [10.0, None, 12.0], [1.0, 2.0, 3.0])),
        ("short", (["2026-10-01", "2026-10-02"], [10.0, 11.0], [1.0])),
        ("missing", (["2026-10-01"], [10.0], None)),
        ("empty", ([], [], [])),
    ], DOC)
    vars_ = ["temperature_2m_mean", "rain_sum"]
    parts = landing.split_series(docs, vars_)
    assert {r.place: list(r.problems) for r in parts["rejected"].collect()} == {
        "short": ["length rain_sum"], "missing": ["missing rain_sum"], "empty": ["empty time"]}
    with pytest.raises(Exception, match="inconsistent document"):
        landing.explode_series(docs, vars_, ["place"]).collect()
    rows = landing.explode_series(parts["valid"], vars_, ["place"]).collect()
    assert [(r.place, r.time, r.rain_sum) for r in rows] == [("ok", "2026-10-01", 1.0), ("ok", "2026-10-03", 3.0)]
    problems = {(r.place, r.problem) for r in landing.series_problems(docs, vars_, ["place"]).collect()}
    assert problems == {("short", "length rain_sum"), ("missing", "missing rain_sum"), ("empty", "empty time")}
    lenient = landing.explode_series(docs.where("place = 'missing'"), vars_, ["place"], strict=False).collect()
    assert [(r.place, r.rain_sum) for r in lenient] == [("missing", None)]


def test_pages_explode_and_count_check(spark):
    schema = "request_id string, page int, count int, data array<struct<code_station: string, v: double>>"
    pages = spark.createDataFrame([
        ("r1", 1, 3, [("S1", 1.0), ("S2", 2.0)]), ("r1", 2, None, [("S3", 3.0)]),
        ("r2", 1, 5, [("S4", 4.0)]), ("r3", 1, None, [("S5", 5.0)]),
    ], schema)
    assert {r.request_id for r in landing.page_problems(pages).collect()} == {"r2"}
    with pytest.raises(Exception, match="incomplete request r2 1 of 5"):
        landing.explode_pages(pages).collect()
    whole = pages.where("request_id <> 'r2'")
    got = sorted(r.code_station for r in landing.explode_pages(whole).collect())
    assert got == ["S1", "S2", "S3", "S5"]
    assert landing.explode_pages(pages, strict=False).count() == 5


def test_lenient_arrays_follow_time(spark):
    docs = spark.createDataFrame([("long", (["2026-10-01"], [10.0, 11.0], [1.0, 2.0, 3.0])), ("none", (None, [1.0], [2.0]))], DOC)
    rows = landing.explode_series(docs, ["temperature_2m_mean", "rain_sum"], ["place"], required=None, strict=False).collect()
    assert [tuple(r) for r in rows] == [("long", "2026-10-01", 10.0, 1.0)]


def test_keep_columns_and_split_missing(spark):
    df = spark.createDataFrame([("S1", 1.0, "x"), (None, 2.0, "y"), ("  ", 3.0, "z")], "code_station string, v double, extra string")
    kept = readers.keep_columns(df, ["code_station", "v", "absent"])
    assert kept.columns == ["code_station", "v", "absent"]
    parts = readers.split_missing(kept, "code_station")
    assert parts["kept"].count() == 1 and parts["rejected"].count() == 2
