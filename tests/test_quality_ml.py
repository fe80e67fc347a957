"""Data-quality checks, profiles and model evaluation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hydromart.operators import ml, profile, quality

D = dt.date


def test_not_null_unique_relationships(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", None)], "k string, v int")
    assert quality.not_null(df, "v").count() == 1
    assert [(r.k, r.n_rows) for r in quality.unique(df, "k").collect()] == [("a", 2)]
    parent = spark.createDataFrame([("a",)], "k string")
    assert [r.k for r in quality.relationships(df, parent, "k").collect()] == ["b"]


def test_thresholds_uniform_flags_mixed_sets(spark):
    fct = spark.createDataFrame(
        [("S1", D(2020, 1, 1), 1.0, 2.0, 3.0, 10, 5), ("S1", D(2021, 1, 1), 1.0, 2.0, 3.0, 10, 5),
         ("S2", D(2020, 1, 1), 1.0, 2.0, 3.0, 10, 5), ("S2", D(2021, 1, 1), 1.0, None, 3.0, 10, 5),
         ("S3", D(2020, 1, 1), 1.0, 2.0, 3.0, 10, 5), ("S3", D(2021, 1, 1), 1.5, 2.0, 3.0, 10, 5)],
        "code_station string, date_obs_elab date, p90 double, p95 double, p99 double, n_reference long, "
        "n_annees_reference long")
    assert sorted(r.code_station for r in quality.thresholds_uniform(fct).collect()) == ["S2", "S3"]


def features(spark, rows):
    return spark.createDataFrame(rows, "date date, code_station string, position_p95 double, "
                                       "variation_position_1j double, pluie_j double, pluie_3j double, "
                                       "humidite_sol double, depasse_p95_j int, target_j1 int")


def test_last_date_scorable(spark):
    ok = features(spark, [(D(2026, 10, 4), "S1", 0.1, 0.0, 1.0, 2.0, 0.2, 0, None)])
    bad = features(spark, [(D(2026, 10, 3), "S1", 0.1, 0.0, 1.0, 2.0, 0.2, 0, 1),
                           (D(2026, 10, 4), "S1", 0.1, None, 1.0, 2.0, 0.2, 0, None)])
    assert quality.last_date_scorable(ok).count() == 0
    assert [r.date for r in quality.last_date_scorable(bad).collect()] == [D(2026, 10, 4)]


def test_scoring_preconditions_flags_duplicates(spark):
    f = features(spark, [(D(2026, 10, 4), "S1", 0.1, 0.0, 1.0, 2.0, 0.2, 0, None)] * 2)
    assert [r.problem for r in quality.scoring_preconditions(f).collect()] == ["duplicated keys"]


def test_coverage_and_count_range(spark):
    df = spark.createDataFrame([("a", D(2026, 1, 1)), ("a", D(2026, 1, 3)), ("b", D(2026, 1, 1)),
                                ("b", D(2026, 1, 2)), ("b", D(2026, 1, 3))], "k string, d date")
    assert [(r.k, r.n_dates, r.expected) for r in quality.coverage(df, "k", "d").collect()] == [("a", 2, 3)]
    assert quality.count_range(df, "k", 1, 3, 2).first().status == "ok"


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (None, 1), (4.0, 1)], "x double, y int")
    prof = {r.column: (r.n_null, r.null_rate) for r in profile.null_profile(df).collect()}
    assert prof == {"x": (1, 0.25), "y": (0, 0.0)}
    bal = {r.y: r.share for r in profile.class_balance(df, "y").collect()}
    assert bal == {0: 0.25, 1: 0.75}
    h = {r.bin: r.n for r in profile.histogram(df, "x", 3).collect()}
    assert h == {1: 1, 2: 1, 3: 1}
    corr = {(r.x, r.y): r.r for r in profile.correlation(df.withColumn("y", F.col("y").cast("double")), ["x", "y"]).collect()}
    assert corr[("x", "x")] == 1.0 and corr[("x", "y")] == pytest.approx(12 / 252 ** 0.5, abs=1e-12)


def test_classification_report_matches_hand_counts(spark):
    # tp=2 fp=1 fn=1 tn=3
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1), (1, 0), (0, 0), (0, 0), (0, 0)], "target_j1 int, prediction int")
    rep = {r["class"]: r for r in ml.classification_report(df).collect()}
    assert rep["1"].precision == pytest.approx(2 / 3) and rep["1"].recall == pytest.approx(2 / 3)
    assert rep["0"].precision == pytest.approx(3 / 4) and rep["0"].support == 4
    assert rep["accuracy"].f1 == pytest.approx(5 / 7)
    assert rep["macro avg"].f1 == pytest.approx((2 / 3 + 3 / 4) / 2)
    assert rep["weighted avg"].recall == pytest.approx((3 / 4 * 4 + 2 / 3 * 3) / 7)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "target_j1 int, prediction int")
    rep = {r["class"]: r for r in ml.classification_report(df).collect()}
    assert rep["1"].precision == 0.0 and rep["1"].recall == 0.0 and rep["1"].f1 == 0.0


def test_split_weights_fit_score(spark, tmp_path):
    rows = []
    for i in range(400):
        d = D(2022, 1, 1) + dt.timedelta(days=i)
        x = (i % 17) / 17.0
        rows.append((d, f"S{i % 3}", x, 0.01 * (i % 5), float(i % 7), float(i % 11), 0.2, int(x > 0.8),
                     int(x > 0.7) if i < 399 else None))
    f = features(spark, rows).withColumn("code_insee", F.lit("37001")).withColumn("code_departement", F.lit("37"))
    parts = ml.chronological_split(f, "2022-10-01")
    assert parts["train"].where("date >= '2022-10-01'").count() == 0
    assert parts["test"].where("target_j1 IS NULL").count() == 0
    w = {r.target_j1: r.weight for r in ml.balanced_weights(parts["train"]).select("target_j1", "weight").distinct().collect()}
    n0 = parts["train"].where("target_j1 = 0").count()
    n1 = parts["train"].where("target_j1 = 1").count()
    assert w[0] == pytest.approx((n0 + n1) / (2 * n0)) and w[1] == pytest.approx((n0 + n1) / (2 * n1))
    model = ml.fit(parts["train"])
    scored = ml.score_latest(model, f, "2026-10-05T06:00:00")
    assert scored.count() == 1 and scored.columns == ml.PREDICTION_COLUMNS
    path = str(tmp_path / "model")
    model.save(path)
    fp = ml.model_fingerprint(spark, path)
    assert ml.load_checked(path, fp) is not None
    with pytest.raises(ValueError):
        ml.load_checked(path, "0" * 64)
    assert [r.feature for r in ml.coefficients(model).collect()].__len__() == 5
    rel = ml.reliability_bins(ml.predict(model, parts["test"]))
    assert rel.agg(F.sum("n")).first()[0] == parts["test"].count()
