"""Calendar-strict three-day rain, day collapse, lag/lead guards, minimum history."""

import datetime as dt

from hydromart.operators import series
from hydromart.plans import marts

D = dt.date


def weather(spark, data):
    return spark.createDataFrame(
        [(c, d, r, 0.2) for c, d, r in data],
        "code_insee string, date date, pluie_totale double, humidite_sol_7_28cm double")


def rain3(spark, data):
    out = marts.weather_days(weather(spark, data))
    return {(r.code_insee, r.date): r.pluie_3j for r in out.collect()}


def test_complete_window(spark):
    got = rain3(spark, [("37001", D(2026, 10, 1), 1.0), ("37001", D(2026, 10, 2), 2.0), ("37001", D(2026, 10, 3), 3.0)])
    assert [got[("37001", D(2026, 10, d))] for d in (1, 2, 3)] == [None, None, 6.0]


def test_missing_previous_day(spark):
    got = rain3(spark, [("37001", D(2026, 10, 1), 1.0), ("37001", D(2026, 10, 3), 3.0)])
    assert got[("37001", D(2026, 10, 3))] is None


def test_missing_day_before_previous(spark):
    got = rain3(spark, [("37001", D(2026, 9, 30), 10.0), ("37001", D(2026, 10, 2), 2.0), ("37001", D(2026, 10, 3), 3.0)])
    assert got[("37001", D(2026, 10, 3))] is None


def test_null_rain_on_any_day(spark):
    for hole in (1, 2, 3):
        data = [("37001", D(2026, 10, d), None if d == hole else float(d)) for d in (1, 2, 3)]
        assert rain3(spark, data)[("37001", D(2026, 10, 3))] is None


def test_zero_rain_and_other_commune(spark):
    got = rain3(spark, [("37001", D(2026, 10, d), 0.0) for d in (1, 2, 3)] + [("37002", D(2026, 10, 3), 100.0)])
    assert got[("37001", D(2026, 10, 3))] == 0.0
    assert got[("37002", D(2026, 10, 3))] is None


def test_duplicated_day_poisons_windows(spark):
    data = [("37001", D(2026, 10, 1), 1.0), ("37001", D(2026, 10, 2), 2.0), ("37001", D(2026, 10, 2), 2.0),
            ("37001", D(2026, 10, 3), 3.0), ("37001", D(2026, 10, 4), 4.0), ("37001", D(2026, 10, 5), 5.0)]
    got = rain3(spark, data)
    assert got[("37001", D(2026, 10, 3))] is None
    assert got[("37001", D(2026, 10, 4))] is None
    assert got[("37001", D(2026, 10, 5))] == 12.0
    from hydromart.operators import quality
    dup = quality.grain(weather(spark, data), ["code_insee", "date"])
    assert [(r.code_insee, r.date, r.nb_lignes) for r in dup.collect()] == [("37001", D(2026, 10, 2), 2)]


def test_duplicate_does_not_fill_a_gap(spark):
    got = rain3(spark, [("37001", D(2026, 10, 1), 1.0), ("37001", D(2026, 10, 1), 1.0), ("37001", D(2026, 10, 3), 3.0)])
    assert got[("37001", D(2026, 10, 3))] is None


def test_lag_lead_guards_across_gap(spark):
    df = spark.createDataFrame(
        [("S1", D(2026, 10, 1), 0.1, 0), ("S1", D(2026, 10, 2), 0.3, 1), ("S1", D(2026, 10, 4), 0.5, 1),
         ("S1", D(2026, 10, 5), 0.2, 0)],
        "code_station string, date date, position_p95 double, depasse_p95_j int")
    out = {r.date.day: r for r in series.lag_lead_features(df).collect()}
    assert out[1].variation_position_1j is None and out[1].target_j1 == 1
    assert abs(out[2].variation_position_1j - 0.2) < 1e-12 and out[2].target_j1 is None  # next is 2 days later
    assert out[4].variation_position_1j is None and out[4].target_j1 == 0
    assert out[5].target_j1 is None  # last row: the one to score


def test_null_position_row_removed_before_lag(spark):
    """A row whose position is NULL (zero denominator) is dropped first, so it creates a gap."""
    from hydromart.operators import thresholds as th
    fct = spark.createDataFrame(
        [("S1", D(2026, 10, 1), 12.0, 5.0, 10.0, 15.0, "Normal"),
         ("S1", D(2026, 10, 2), 12.0, 5.0, 10.0, 5.0, "Normal"),   # p99 = p90 -> NULL position
         ("S1", D(2026, 10, 3), 12.0, 5.0, 10.0, 15.0, "Normal")],
        "code_station string, date_obs_elab date, resultat_obs_elab double, p90 double, p95 double, "
        "p99 double, niveau_hydrologique string")
    out = {r.date.day: r for r in series.lag_lead_features(th.exceedance_position(fct)).collect()}
    assert sorted(out) == [1, 3]
    assert out[1].target_j1 is None and out[3].variation_position_1j is None


def test_minimum_history_boundary(spark):
    rows = [("a", i) for i in range(99)] + [("b", i) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, i int")
    kept = series.min_history(df, "k", 100)
    assert {r.k for r in kept.collect()} == {"b"} and kept.count() == 100


def test_collapse_days(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 1.0), ("a", 2, 3.0)], "k string, d int, x double")
    got = {(r.k, r.d): r.x for r in series.collapse_days(df, ["k", "d"], ["x"]).collect()}
    assert got == {("a", 1): None, ("a", 2): 3.0}
