"""Hot keys and dense cells: results stay exact and the heavy steps aggregate map-side."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from hydromart.functions.spatial import chord_for_arc
from hydromart.operators import geo, series, versions as V


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_version_of_a_hot_key_aggregates_map_side(spark):
    t0 = dt.datetime(2026, 1, 1)
    hot = [("hot", t0 + dt.timedelta(seconds=i), float(i)) for i in range(3000)]
    cold = [(f"k{i}", t0, float(i)) for i in range(6000)]
    raw = spark.createDataFrame(hot + cold, "k string, inserted_at timestamp, v double").repartition(8)
    cur = V.latest_versions(raw, ["k"], ["inserted_at"])
    got = {r.k: r.v for r in cur.collect()}
    assert got["hot"] == 2999.0 and len(got) == 6001
    assert "partial_max_by" in plan_of(cur)


def test_day_collapse_of_a_hot_entity_aggregates_map_side(spark):
    rows = [("hot", i % 30, 1.0) for i in range(5000)] + [("cold", 1, 2.0)]
    df = spark.createDataFrame(rows, "k string, d int, x double").repartition(8)
    out = series.collapse_days(df, ["k", "d"], ["x"])
    assert out.where("k = 'hot'").where(F.col("x").isNotNull()).count() == 0  # every hot day is duplicated
    assert "partial_count" in plan_of(out)


def _hav(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371008.8 * math.asin(math.sqrt(min(1.0, h)))


def test_dense_cluster_is_settled_without_pair_checks(spark):
    rnd = random.Random(11)
    # a third of all points in one ~2 km square, the rest spread over a country
    dense_c = [(f"c{i}", 45.0 + rnd.uniform(0, 0.02), 2.0 + rnd.uniform(0, 0.02)) for i in range(300)]
    spread_c = [(f"d{i}", 42 + rnd.uniform(0, 9), -4 + rnd.uniform(0, 12)) for i in range(600)]
    dense_s = [(f"s{i}", 45.0 + rnd.uniform(0, 0.02), 2.0 + rnd.uniform(0, 0.02)) for i in range(300)]
    spread_s = [(f"t{i}", 42 + rnd.uniform(0, 9), -4 + rnd.uniform(0, 12)) for i in range(600)]
    communes, stations = dense_c + spread_c, dense_s + spread_s
    co = spark.createDataFrame(communes, "code_insee string, latitude double, longitude double")
    st = spark.createDataFrame(stations, "code_station string, latitude_station double, longitude_station double")
    r = 15000.0
    want = {s for s, *sp in stations if any(_hav(cp, sp) <= r for _, *cp in communes)}
    assert {x.code_station for x in geo.stations_near(co, st, r).collect()} == want
    # every dense station shares a fine cube with a commune: none of them reaches the pair join
    chord = chord_for_arc(r)
    a = st.select(F.col("code_station").alias("a_id"), F.col("latitude_station").alias("a_lat"),
                  F.col("longitude_station").alias("a_lon"))
    b = co.select(F.col("latitude").alias("b_lat"), F.col("longitude").alias("b_lon")).withColumn("b_id", F.lit(None))
    settled = {x.a_id for x in geo._share_fine_cell(a, "a_", b, "b_", chord).collect()}
    assert {s for s, *_ in dense_s} <= settled


def _brute_changes(rows):
    out, last = set(), {}
    for k, t, i, v in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if k not in last or last[k] != v:
            out.add(i)
        last[k] = v
    return out


def test_version_changes_of_a_hot_key_spans_chunks(spark):
    rnd = random.Random(5)
    t0 = dt.datetime(2026, 1, 1)
    rows = [("hot", t0 + dt.timedelta(seconds=i), i, float(rnd.choice([1, 1, 2, None]) or 0) if i % 7 else None)
            for i in range(4000)]
    rows += [(f"k{j}", t0 + dt.timedelta(seconds=j % 3), 10000 + j, float(j % 2)) for j in range(2000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, id int, v double")
    got = V.version_changes(df, ["k"], ["ts", "id"], "v", chunks=8)
    chunks = V.version_changes(df, ["k"], ["ts", "id"], "v", chunks=8)
    assert {r.id for r in got.collect()} == _brute_changes(rows)
    # the hot key really is split: its rows occupy several range partitions
    spread = (df.repartitionByRange(8, "k", "ts", "id").where("k = 'hot'")
              .select(F.spark_partition_id().alias("p")).distinct().count())
    assert spread > 1 and chunks.count() == len(_brute_changes(rows))


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    import os
    from hydromart.operators import tables
    rows = [("2026-10", f"S{i % 50}", float(i)) for i in range(6000)] + [("2026-09", "S1", 1.0)]
    df = spark.createDataFrame(rows, "mois string, code_station string, v double")
    path = str(tmp_path / "t")
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",  # data >> a partition,
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}  # as at scale
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        tables.write_table(df, path, ["mois"], sort_by=["code_station"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = [f for f in os.listdir(os.path.join(path, "mois=2026-10")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(path).count() == 6001
