"""Inputs that used to lose, multiply or hide rows."""

import os

import pytest
from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from hydromart import session
from hydromart.functions import codes
from hydromart.operators import geo, ml, tables, versions


def test_unreadable_table_is_not_a_missing_one(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not tables.table_exists(spark, path)
    os.makedirs(path)
    assert not tables.table_exists(spark, path)  # no data files yet
    (tmp_path / "t" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        tables.table_exists(spark, path)


def test_failed_replace_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(5), path)
    bad = spark.range(10).withColumn("id", F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("boom")).cast("long")))
    with pytest.raises(Exception, match="boom"):
        tables.replace(bad, path)
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(tables.EmptyInputError):
        tables.replace(spark.range(0), path)
    assert spark.read.parquet(path).count() == 5
    tables.replace(spark.read.parquet(path).where("id > 1"), path)  # reads what it replaces
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    os.rename(path, path + ".last")  # a swap cut short comes back
    assert tables.table_exists(spark, path) and spark.read.parquet(path).count() == 3


def test_rollback_drops_emptied_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "2026-01", "a"), (2, "2026-01", "b"), (3, "2026-02 x", "b"), (4, None, "b"), (5, "2026-03", "a")]
    tables.append(spark.createDataFrame(rows, "v int, mois string, batch_id string"), path, ["mois"])
    before = {f: os.path.getmtime(f"{path}/mois=2026-03/{f}") for f in os.listdir(f"{path}/mois=2026-03")}
    tables.rollback_table(spark, path, "b", ["mois"])
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 5]
    assert {f: os.path.getmtime(f"{path}/mois=2026-03/{f}") for f in os.listdir(f"{path}/mois=2026-03")} == before


def test_repeated_hashes_do_not_multiply(spark):
    day = "2026-01-01"
    src = spark.createDataFrame([("h", day, 1), ("h", day, 2)], "row_hash string, date string, v int").withColumn("date", F.to_date("date"))
    mart = src
    for _ in range(3):
        mart = tables.incremental_merge(src, mart)
        assert mart.count() == 2


def test_null_keys_and_null_partitions(spark):
    schema = "k string, mois string, row_hash string"
    target = spark.createDataFrame([("a", "m", "1"), (None, "m", "2"), ("c", None, "3"), ("d", "other", "4")], schema)
    source = spark.createDataFrame([("a", "m", "9"), (None, "m", "8"), ("e", None, "5")], schema)
    got = sorted((tuple(r) for r in tables.upsert_changed_only(target, source, ["k"]).collect()), key=repr)
    assert got == sorted([("a", "m", "9", "update"), (None, "m", "2", "keep"), (None, "m", "8", "insert"),
                          ("c", None, "3", "keep"), ("d", "other", "4", "keep"), ("e", None, "5", "insert")], key=repr)
    scoped = tables.upsert(target, source, ["k"], scope=["mois"]).collect()
    assert sorted(((r.k, r.mois) for r in scoped), key=repr) == sorted(
        [("a", "m"), (None, "m"), (None, "m"), ("c", None), ("e", None)], key=repr)


def test_partial_dates_and_integer_rounding(spark):
    df = spark.createDataFrame([("1", "2026-10", "x"), ("2", "2026", "x"), ("3", "2026-10-05T10:00", "x"), ("4", "2026-13-01", "x"),
                                ("", "2026-10-05", "x"), ("123456", "2026-10-05", "x"), ("5", "2026-10-05", None)],
                               "code string, date string, m string")
    out = versions.normalise_keys(df, "code", "date", ["m"])
    assert {r.code: r.reason for r in out["rejected"].collect()} == {
        "1": "invalid date", "2": "invalid date", "4": "invalid date", "": "missing code", "123456": "code too long", "5": "missing m"}
    assert [r.code for r in out["valid"].collect()] == ["00003"]
    casts = spark.sql("SELECT 2.7D AS a, -2.5D AS b, '2026-10' AS c, '2026-10-05' AS d, 'x' AS e").select(
        codes.safe_cast("a", "bigint"), codes.safe_cast("b", "bigint"), codes.safe_cast("c", "date"),
        codes.safe_cast("d", "date").cast("string"), codes.safe_cast("e", "bigint")).first()
    assert tuple(casts) == (3, -3, None, "2026-10-05", None)


@pytest.mark.parametrize("reuse,chunks", [("true", 16), ("false", 16), ("false", 5)])
def test_version_changes_at_size(spark, reuse, chunks):
    """More rows than the range sampler keeps, with a payload, with and without exchange reuse."""
    n = 400_000
    raw = (spark.range(n).select((F.col("id") % 50).alias("k"), F.col("id").alias("ts"), F.col("id").alias("event"),
                                 (F.xxhash64("id") % 3).alias("content"), F.repeat(F.lit("p"), 30).alias("payload")))
    w = Window.partitionBy("k").orderBy("ts", "event")
    want = raw.withColumn("prev", F.lag("content").over(w)).where("NOT content <=> prev").select("event")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        got = versions.version_changes(raw, ["k"], ["ts", "event"], "content", chunks).select("event")
        assert got.count() == want.count() and got.join(want, "event", "left_anti").isEmpty()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_one_nearest_station_per_code(spark):
    communes = spark.createDataFrame([("c", 45.0, 2.0), ("c", 48.0, 2.0)], "code_insee string, latitude double, longitude double")
    stations = spark.createDataFrame([("s1", 45.5, 2.0), ("s2", 48.2, 2.0)],
                                     "code_station string, latitude_station double, longitude_station double")
    assert [(r.code_insee, r.code_station) for r in geo.nearest_station(communes, stations).collect()] == [("c", "s2")]


def test_fingerprint_covers_the_fitted_data(spark, tmp_path):
    train = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "x double, label double")
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    def fit(reg):
        steps = [VectorAssembler(inputCols=["x"], outputCol="f"), LogisticRegression(featuresCol="f", regParam=reg)]
        return Pipeline(stages=steps).fit(train)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    fit(0.0).save(a)
    fit(5.0).save(b)
    print_a = ml.model_fingerprint(spark, a)
    stage = next(d for d in os.listdir(f"{a}/stages") if d.startswith("1_"))
    other = next(d for d in os.listdir(f"{b}/stages") if d.startswith("1_"))
    import shutil
    shutil.copytree(f"{b}/stages/{other}/data", f"{a}/stages/{stage}/data", dirs_exist_ok=True)
    assert ml.model_fingerprint(spark, a) != print_a
    with pytest.raises(ValueError):
        ml.load_checked(a, print_a)


def test_settings_of_an_existing_session_win(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "4000")
    try:
        assert session.build_session(profile="cluster").conf.get(key) == "4000"
    finally:
        spark.conf.set(key, before)
    assert SparkSession.getActiveSession() is not None


def test_no_scratch_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_accents_outside_the_common_blocks(spark):
    got = spark.sql("SELECT '\u212Bngstr\u00f6m \u1E9E \uFB01 \u30AC \u0344e\u0301' AS t").select(codes.strip_marks("t")).first()[0]
    assert got == "Angstrom \u1E9E \uFB01 \u30AB e"
