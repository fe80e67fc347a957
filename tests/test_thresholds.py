"""River quality rules, thresholds and level classes."""

import datetime as dt

import pytest

from hydromart.operators import thresholds as th

D = dt.date
OBS = ("code_station string, date_obs_elab date, resultat_obs_elab double, code_qualification string, "
       "code_statut string")
SEUIL = "code_station string, mois int, p90 double, p95 double, p99 double, n_reference bigint, n_annees_reference bigint"


def classify(spark, obs, seuils):
    o = spark.createDataFrame(obs, OBS)
    s = spark.createDataFrame(seuils, SEUIL)
    return th.classify_observations(o, s)


def positions(spark, obs, seuils):
    return [(r.date.year, round(r.position_p95, 6), r.depasse_p95_j)
            for r in th.exceedance_position(classify(spark, obs, seuils)).orderBy("date").collect()]


@pytest.mark.parametrize("qual,status,kept", [
    ("20", "12", True), ("20", "16", True), ("10", "12", False), (None, "12", False),
    ("20", "0", False), ("20", None, False)])
def test_qualification_and_status(spark, qual, status, kept):
    got = positions(spark, [("S1", D(2026, 10, 1), 12.0, qual, status)], [("S1", 10, 5.0, 10.0, 15.0, 1200, 5)])
    assert got == ([(2026, 0.2, 1)] if kept else [])


def test_short_history_and_flat_denominator(spark):
    obs = [("S1", D(2026, 10, 1), 12.0, "20", "12")]
    assert positions(spark, obs, [("S1", 10, 5.0, 10.0, 15.0, 1200, 4)]) == []
    assert positions(spark, obs, [("S1", 10, 5.0, 10.0, 5.0, 1200, 5)]) == []


def test_refreshed_thresholds_apply_to_all_dates(spark):
    obs = [("S1", D(2001, 10, 1), 12.0, "20", "12"), ("S1", D(2026, 10, 1), 12.0, "20", "12")]
    assert positions(spark, obs, [("S1", 10, 5.0, 10.0, 15.0, 1200, 5)]) == [(2001, 0.2, 1), (2026, 0.2, 1)]
    assert positions(spark, obs, [("S1", 10, 5.0, 11.0, 15.0, 1200, 5)]) == [(2001, 0.1, 1), (2026, 0.1, 1)]


@pytest.mark.parametrize("x,p,expected", [
    (16.0, (5.0, 10.0, 15.0), "Exceptionnel"), (12.0, (5.0, 10.0, 15.0), "Élevé"),
    (6.0, (5.0, 10.0, 15.0), "Normal"), (16.0, (5.0, 15.0, 15.0), "Élevé"),
    (16.0, (15.0, 15.0, 15.0), "Normal"), (16.0, (None, None, None), None)])
def test_level_class_branches(spark, x, p, expected):
    seuils = [("S1", 10, *p, 100, 5)] if p[0] is not None else []
    r = classify(spark, [("S1", D(2026, 10, 1), x, "20", "12")], seuils).collect()[0]
    assert r.niveau_hydrologique == expected


def test_thresholds_exact_and_sketch_agree(spark):
    data = [("S1", D(2000 + y, 10, d), float((y * 31 + d) % 97), "20", "12") for y in range(6) for d in range(1, 29)]
    obs = spark.createDataFrame(data, OBS)
    a = {r.mois: (r.p90, r.p95, r.p99, r.n_annees_reference) for r in th.monthly_thresholds(obs).collect()}
    b = {r.mois: (r.p90, r.p95, r.p99, r.n_annees_reference) for r in th.monthly_thresholds(obs, exact=True).collect()}
    assert a == b and a[10][3] == 6


def test_thresholds_before_cutoff_ignore_later_rows(spark):
    data = [("S1", D(2000, 10, 1), 1.0, "20", "12"), ("S1", D(2030, 10, 1), 100.0, "20", "12")]
    t = th.monthly_thresholds(spark.createDataFrame(data, OBS), before="2010-01-01").collect()
    assert t[0].p99 == 1.0 and t[0].n_reference == 1
