"""Structured Streaming: versioned ingest of landed files and the streaming latest version."""

import datetime as dt
import json


from hydromart.streaming import ingest

SCHEMA = "code_INSEE string, date string, rain_sum double"


def land(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    with open(folder / name, "w") as fh:
        for r in rows:
            fh.write(json.dumps(dict(zip(["code_INSEE", "date", "rain_sum"], r))) + "\n")


def test_versioned_ingest_appends_changes_only(spark, tmp_path):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(SCHEMA)
    landing, raw, ckpt = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "ckpt")
    land(landing, "a.json", [("37001", "2026-10-01", 1.0), ("37002", "2026-10-01", 2.0)])
    ingest.versioned_ingest(spark, str(landing), schema, raw, "weather", ckpt).awaitTermination()
    assert spark.read.parquet(raw).count() == 2
    # a re-delivery with one changed value and one unchanged
    land(landing, "b.json", [("37001", "2026-10-01", 1.5), ("37002", "2026-10-01", 2.0)])
    ingest.versioned_ingest(spark, str(landing), schema, raw, "weather", ckpt).awaitTermination()
    hist = spark.read.parquet(raw)
    assert hist.count() == 3 and hist.select("batch_id").distinct().count() == 2
    # the same checkpoint: files already processed are not loaded again
    ingest.versioned_ingest(spark, str(landing), schema, raw, "weather", ckpt).awaitTermination()
    assert spark.read.parquet(raw).count() == 3


def test_rerun_of_a_micro_batch_appends_nothing(spark, tmp_path):
    from hydromart.operators.versions import load_versioned
    raw = str(tmp_path / "raw")
    batch = spark.createDataFrame([("37001", "2026-10-01", 1.0)], SCHEMA)
    assert load_versioned(spark, raw, batch, "weather", "stream-0") == 1
    assert load_versioned(spark, raw, batch, "weather", "stream-0") == 0


def test_latest_version_stream_matches_batch(spark, tmp_path):
    src = tmp_path / "src"
    t = dt.datetime(2026, 10, 1)
    rows = [("k1", dt.date(2026, 10, 1), t + dt.timedelta(hours=h), float(h)) for h in range(3)] + \
           [("k2", dt.date(2026, 10, 2), t, 9.0)]
    spark.createDataFrame(rows, "k string, date date, ts timestamp, v double").write.parquet(str(src))
    stream = spark.readStream.schema("k string, date date, ts timestamp, v double").parquet(str(src))
    out = str(tmp_path / "out")
    ingest.run_latest_to_table(spark, stream, ["k", "date"], ["ts"], out, str(tmp_path / "ck"))
    got = {r.k: r.v for r in spark.read.parquet(out).collect()}
    assert got == {"k1": 2.0, "k2": 9.0}


def test_late_older_version_does_not_win_and_no_state_is_kept(spark, tmp_path):
    src, out, ck = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "ck")
    schema = "k string, date date, ts timestamp, v double"
    day = lambda n: dt.date(2026, 1, 1) + dt.timedelta(days=n)

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        return ingest.run_latest_to_table(spark, spark.readStream.schema(schema).parquet(str(src)), ["k", "date"], ["ts"], out, ck)

    run([("a", day(0), dt.datetime(2026, 1, 2, 12), 2.0)])
    query = run([("a", day(0), dt.datetime(2026, 1, 2, 6), 1.0)] + [("b", day(n), dt.datetime(2026, 6, 1), float(n)) for n in range(90)])
    got = {(r.k, r.date): r.v for r in spark.read.parquet(out).collect()}
    assert got[("a", day(0))] == 2.0 and len(got) == 91
    assert not query.lastProgress or not query.lastProgress["stateOperators"]


def test_loads_keep_their_identity_over_restarts(spark, tmp_path):
    from pyspark.sql.types import StructType
    schema = StructType.fromDDL(SCHEMA)
    landing, raw = tmp_path / "landing", str(tmp_path / "raw")
    run = lambda name: ingest.versioned_ingest(spark, str(landing), schema, raw, "weather", str(tmp_path / name)).awaitTermination()
    land(landing, "a.json", [("37001", "2026-10-01", 1.0)])
    run("one")
    land(landing, "b.json", [("37001", "2026-10-01", 2.0), ("37002", "2026-10-01", 5.0)])
    run("one")
    log = ingest.LoadLog(spark, f"{raw}.loads")
    first, second = [f"stream-{ingest.stream_id(spark, str(tmp_path / 'one'))}-{n}" for n in (0, 1)]
    assert {r.load_id: (r.state, r.n_rows) for r in log.read().collect()} == {first: ("done", 1), second: ("done", 2)}
    # a rollback addresses one load; a new checkpoint counts its epochs from 0 again under another id
    ingest.roll_back_load(spark, raw, log, second)
    assert [(r.rain_sum, r.batch_id) for r in spark.read.parquet(raw).collect()] == [(1.0, first)]
    land(landing, "a.json", [("37003", "2026-10-01", 9.0)])  # rewritten file: both files are new to the new stream
    run("two")
    other = f"stream-{ingest.stream_id(spark, str(tmp_path / 'two'))}-0"
    assert other != first
    got = sorted((r.code_INSEE, r.rain_sum, r.batch_id) for r in spark.read.parquet(raw).collect())
    assert got == [("37001", 1.0, first), ("37001", 2.0, other), ("37002", 5.0, other), ("37003", 9.0, other)]
    ingest.roll_back_load(spark, raw, log, other)
    assert [r.batch_id for r in spark.read.parquet(raw).collect()] == [first]


def test_a_load_cut_short_is_finished_with_its_first_stamp(spark, tmp_path, monkeypatch):
    import pytest
    raw = str(tmp_path / "raw")
    log = ingest.LoadLog(spark, f"{raw}.loads")
    batch = spark.createDataFrame([("37001", "2026-10-01", 1.0)], SCHEMA)
    real = ingest.load_versioned

    def dies(*args, **kw):
        real(*args, **kw)
        raise RuntimeError("after the append")
    monkeypatch.setattr(ingest, "load_versioned", dies)
    with pytest.raises(RuntimeError):
        ingest.load_once(spark, raw, batch, "weather", "stream-x-0", log)
    stamp = log.find("stream-x-0").inserted_at
    monkeypatch.setattr(ingest, "load_versioned", real)
    assert ingest.load_once(spark, raw, batch, "weather", "stream-x-0", log) == 1
    assert ingest.load_once(spark, raw, batch, "weather", "stream-x-0", log) == 0
    assert [r.inserted_at for r in spark.read.parquet(raw).collect()] == [stamp]
    assert log.find("stream-x-0").state == "done"
    with pytest.raises(ValueError, match="no such load"):
        ingest.roll_back_load(spark, raw, log, "stream-x-9")


def test_a_load_of_one_file_is_dealt_out_to_several_tasks(spark, tmp_path, monkeypatch):
    from hydromart.operators import versions
    rows = [(f"{n:05d}", "2026-10-01", float(n)) for n in range(200)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "landed"))
    parts, check = [], versions.normalise_keys

    def seen(df, *args, **kw):
        parts.append(df.rdd.getNumPartitions())
        return check(df, *args, **kw)
    monkeypatch.setattr(versions, "normalise_keys", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        batch = spark.read.schema(SCHEMA).parquet(str(tmp_path / "landed"))
        assert versions.load_versioned(spark, str(tmp_path / "raw"), batch, "weather", "one") == 200
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts == [4]
    got = spark.read.parquet(str(tmp_path / "raw")).select("code_INSEE", "date", "rain_sum").collect()
    assert sorted((r[0], str(r[1]), r[2]) for r in got) == rows
