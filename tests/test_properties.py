"""Invariants on random inputs: replay idempotence, rollback of an append, partitioning
independence, and the strict window against a brute-force reference."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from hydromart.operators import tables, versions as V
from hydromart.plans import marts

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2026, 1, 1)

rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 5), st.integers(0, 3)),
                   min_size=1, max_size=25)


@SETTINGS
@given(target=rows_st, source=rows_st)
def test_upsert_replay_is_a_fixed_point(spark, target, source):
    t = spark.createDataFrame([(k, d, float(v)) for k, d, v in target], "k string, d int, v double").dropDuplicates(["k"])
    s = spark.createDataFrame([(k, d, float(v)) for k, d, v in source], "k string, d int, v double").dropDuplicates(["k"])
    once = tables.upsert(t, s, ["k"])
    twice = tables.upsert(once, s, ["k"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert {r.k for r in once.collect()} == {r.k for r in t.collect()} | {r.k for r in s.collect()}


@SETTINGS
@given(history=rows_st, load=rows_st)
def test_rollback_of_a_load_restores_the_table(spark, history, load):
    t0 = dt.datetime(2026, 1, 1)
    old = [(k, d, float(v), t0, "old") for k, d, v in history]
    new = [(k, d, float(v), t0 + dt.timedelta(hours=1), "new") for k, d, v in load]
    schema = "k string, d int, v double, inserted_at timestamp, batch_id string"
    before = spark.createDataFrame(old, schema)
    after = before.unionByName(spark.createDataFrame(new, schema))
    restored = tables.rollback_batch(after, "new")
    assert sorted(map(tuple, restored.collect())) == sorted(map(tuple, before.collect()))
    cur_before = V.latest_versions(before, ["k", "d"], ["inserted_at", "v"])
    cur_restored = V.latest_versions(restored, ["k", "d"], ["inserted_at", "v"])
    assert sorted(map(tuple, cur_before.collect())) == sorted(map(tuple, cur_restored.collect()))


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 7))
def test_latest_versions_independent_of_partitioning(spark, rows, parts):
    t0 = dt.datetime(2026, 1, 1)
    data = [(k, d, t0 + dt.timedelta(minutes=i), float(v)) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d int, ts timestamp, v double")
    a = V.latest_versions(df, ["k", "d"], ["ts"])
    b = V.latest_versions(df.repartition(parts), ["k", "d"], ["ts"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@SETTINGS
@given(days=st.lists(st.tuples(st.integers(0, 12), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=20))
def test_strict_three_day_rain_matches_brute_force(spark, days):
    data = [("c", D0 + dt.timedelta(days=d), None if r is None else float(r)) for d, r in days]
    w = spark.createDataFrame([(c, d, r, 0.1) for c, d, r in data],
                              "code_insee string, date date, pluie_totale double, humidite_sol_7_28cm double")
    got = {r.date: r.pluie_3j for r in marts.weather_days(w).collect()}
    count, value = {}, {}
    for _, d, r in data:
        count[d] = count.get(d, 0) + 1
        value[d] = r
    for d in count:
        window = [d - dt.timedelta(days=i) for i in range(3)]
        ok = all(count.get(x) == 1 and value.get(x) is not None for x in window)
        assert got[d] == (sum(value[x] for x in window) if ok else None)


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 30), st.sampled_from([1.0, 2.0, None])),
                     min_size=1, max_size=30), chunks=st.integers(1, 5))
def test_version_changes_match_sequential_scan(spark, rows, chunks):
    t0 = dt.datetime(2026, 1, 1)
    data = [(k, t0 + dt.timedelta(seconds=t), i, v) for i, (k, t, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, ts timestamp, id int, v double")
    got = {r.id for r in V.version_changes(df, ["k"], ["ts", "id"], "v", chunks=chunks).collect()}
    want, last = set(), {}
    for k, ts, i, v in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        if k not in last or last[k] != v:
            want.add(i)
        last[k] = v
    assert got == want
