"""Stored tables: bucketed histories, identity indexes, threshold state, landed JSON text, backfill."""

import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from hydromart.operators import membership, quality, tables, versions as vers
from hydromart.operators.bucketed import BucketedTable
from hydromart.operators.threshold_state import ThresholdState, merge_states, state_of, thresholds_of
from hydromart.operators.thresholds import monthly_thresholds
from hydromart.operators.versions import LoadRejected
from hydromart.plans import backfill, catalog, catalog_stored, pipeline
from hydromart.sources import landing, schemas

KEYS, ORDER = ["k", "d"], ["inserted_at", "row_hash"]


def history(spark, n=300, seed=1):
    rng = random.Random(seed)
    data = [(f"k{rng.randrange(40)}", rng.randrange(3), float(rng.randrange(4)), i, "old") for i in range(n)]
    df = spark.createDataFrame(data, "k string, d int, v double, inserted_at int, batch_id string")
    return df.withColumn("row_hash", vers.content_hash(["k", "d", "v"]))


def load(spark, n=60, seed=2):
    rng = random.Random(seed)
    keys = {(f"k{rng.randrange(60)}", rng.randrange(3)) for _ in range(n)}
    df = spark.createDataFrame([(k, d, float(rng.randrange(4)), 1000, "new") for k, d in keys],
                               "k string, d int, v double, inserted_at int, batch_id string")
    return df.withColumn("row_hash", vers.content_hash(["k", "d", "v"]))


def exchanges_above_scans(df, folder):
    """Operators between every scan of ``folder`` and the first join above it, from the final plan."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    depth = lambda line: len(re.match(r"[ :]*", line).group())  # noqa: E731  (the branch mark follows)
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and folder in line:
            at, above = depth(line), []
            for up in reversed(lines[:i]):
                if depth(up) < at:
                    at = depth(up)
                    above.append(up.strip(" :+-*"))
                    if "Join" in up:
                        break
            found.append((line, above))
    return found


def test_bucketed_load_equals_the_plain_one(spark, tmp_path):
    table = BucketedTable.create(history(spark), str(tmp_path / "t"), KEYS, 8)
    want = rows(vers.plan_load(history(spark), load(spark), KEYS, ORDER)["to_append"], "k", "d", "v")
    assert rows(table.load_changed(load(spark), ORDER), "k", "d", "v") == want and want
    assert table.append_changed(load(spark), ORDER) == len(want)
    assert table.append_changed(load(spark), ORDER) == 0  # a replay appends nothing
    assert rows(table.read().where("batch_id = 'new'"), "k", "d", "v") == want
    assert table.read().count() == 300 + len(want)


def test_history_is_not_shuffled(spark, tmp_path):
    table = BucketedTable.create(history(spark), str(tmp_path / "t"), KEYS, 8)
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (table.load_changed(load(spark), ORDER), table.merged_changes(load(spark).dropDuplicates(KEYS))):
            scans = exchanges_above_scans(df, table.folder)
            assert scans and all(not any("Exchange" in a for a in above) for _, above in scans), scans
        plain = vers.plan_load(spark.read.parquet(table.path), load(spark), KEYS, ORDER)["to_append"]
        assert any(any("Exchange" in a for a in above) for _, above in exchanges_above_scans(plain, "FileScan"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_bucketed_table_survives_its_session(spark, tmp_path):
    root = str(tmp_path / "t")
    table = BucketedTable.create(history(spark), root, KEYS, 4)
    spark.sql(f"DROP TABLE {table.name}")  # a new session's catalog is empty; the files stay
    again = BucketedTable.attach(spark, root)
    assert (again.keys, again.buckets) == (KEYS, 4)
    want = rows(vers.plan_load(history(spark), load(spark), KEYS, ORDER)["to_append"], "k", "d", "v")
    assert again.append_changed(load(spark), ORDER) == len(want)
    before = rows(again.read())
    again.compact()
    assert rows(again.read()) == before
    assert len([f for f in os.listdir(again.path) if f.endswith(".parquet")]) <= 4


def test_bucketed_merge_and_failed_replace(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", "h1"), (2, "b", "h2"), (None, "n", "h0")], "k int, v string, row_hash string")
    source = spark.createDataFrame([(1, "a", "h1"), (2, "z", "h9"), (3, "c", "h3")], "k int, v string, row_hash string")
    table = BucketedTable.create(base, str(tmp_path / "t"), ["k"], 4)
    assert table.merge(source) == {"keep": 2, "update": 1, "insert": 1}
    assert rows(table.read(), "k", "v") == sorted([(1, "a"), (2, "z"), (3, "c"), (None, "n")], key=repr)
    assert table.merge(source) == {"keep": 4}
    bad = table.read().withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        table.replace(bad)
    assert table.read().count() == 4 and BucketedTable.attach(spark, str(tmp_path / "t")).read().count() == 4


# --------------------------------------------------------------------------- identity index
def mart_rows(spark, n, seed=3):
    rng = random.Random(seed)
    data = [(None if rng.random() < 0.05 else f"h{rng.randrange(n)}", dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(400)), i)
            for i in range(n)]
    return spark.createDataFrame(data, "row_hash string, date date, v int")


@pytest.mark.parametrize("planted", [False, True])
def test_indexed_increment_equals_the_join(spark, tmp_path, planted):
    source = mart_rows(spark, 800)
    mart = source.where("v % 3 <> 0" + (" AND row_hash IS NOT NULL" if planted else ""))
    index = membership.IdentityIndex.build(mart, str(tmp_path / "i"), buckets=4)
    want = rows(tables.incremental_rows(source, mart))
    assert rows(membership.incremental_rows(source, mart, index)) == want
    again = membership.IdentityIndex.attach(spark, str(tmp_path / "i"))
    assert again.bits == index.bits and rows(membership.incremental_rows(source, mart, again)) == want


def test_bitmaps_never_miss_and_grow(spark, tmp_path):
    ids = spark.range(3000).selectExpr("concat('h', id) AS row_hash")
    index = membership.IdentityIndex.build(ids.where("row_hash < 'h2'"), str(tmp_path / "i"), buckets=4)
    marked = index.maybe_known(ids)
    held = index.exact.read().withColumnRenamed("identity", "row_hash")
    assert marked.join(held, "row_hash").where("NOT _maybe").isEmpty()
    wrong = marked.join(held, "row_hash", "left_anti").where("_maybe").count()
    assert wrong < 0.2 * ids.count()
    new = ids.join(held, "row_hash", "left_anti").count()
    assert index.add(ids) == new and index.add(ids) == 0
    assert index.absent(ids).isEmpty() and index.maybe_known(ids).where("NOT _maybe").isEmpty()
    many = spark.range(20000).selectExpr("concat('m', id) AS row_hash")
    before = index.bits
    assert index.add(many) == 20000 and index.bits > before
    assert index.absent(many.unionByName(spark.createDataFrame([("x",)], "row_hash string"))).count() == 1


def test_false_bits_are_looked_up(spark, tmp_path, monkeypatch):
    """With every bit set, the exact table alone decides."""
    monkeypatch.setattr(membership, "bit_is_set", lambda bits, at: F.lit(True))
    index = membership.IdentityIndex.build(spark.createDataFrame([("a",)], "row_hash string"), str(tmp_path / "i"), buckets=2)
    asked = spark.createDataFrame([("a",), ("b",), (None,)], "row_hash string")
    assert rows(index.absent(asked)) == sorted([("b",), (None,)], key=repr)


def test_empty_mart_index(spark, tmp_path):
    empty = spark.createDataFrame([], "row_hash string, date date, v int")
    index = membership.IdentityIndex.build(empty, str(tmp_path / "i"), buckets=2)
    source = mart_rows(spark, 20)
    assert rows(membership.incremental_rows(source, empty, index)) == rows(source)
    assert membership.IdentityIndex.attach(spark, str(tmp_path / "i")).bits == membership.BITMAP_BITS


# --------------------------------------------------------------------------- threshold state
def readings(spark, n=900, seed=5):
    rng = random.Random(seed)
    day = dt.date(2000, 1, 1)
    data = {(s, day + dt.timedelta(days=rng.randrange(2500))): (rng.choice([None, *range(12)]), rng.choice(["20", "20", "10"]), rng.choice(["12", "16", "4"]))
            for s in ("hot", "hot", "b") for _ in range(n)}
    return spark.createDataFrame([(s, d, None if v is None else float(v), q, st) for (s, d), (v, q, st) in data.items()],
                                 "code_station string, date_obs_elab date, resultat_obs_elab double, code_qualification string, code_statut string")


def test_state_in_deliveries_equals_thresholds_over_all(spark, tmp_path):
    obs = readings(spark)
    want = rows(monthly_thresholds(obs, exact=True))
    assert rows(thresholds_of(state_of(obs))) == want
    state = ThresholdState(spark, str(tmp_path / "s"))
    for part in range(3):
        state.merge(state_of(obs.where(F.pmod(F.dayofyear("date_obs_elab"), F.lit(3)) == part)))
    assert rows(state.thresholds()) == want


def test_corrections_and_emptied_months(spark, tmp_path):
    obs = readings(spark, 200)
    state = ThresholdState(spark, str(tmp_path / "s"))
    state.merge(state_of(obs))
    march = F.month("date_obs_elab") == 3
    state.merge(state_of(obs.where(march), sign=-1))  # March is taken away altogether
    assert rows(state.thresholds()) == rows(monthly_thresholds(obs.where(~march), exact=True))
    doubled = obs.withColumn("resultat_obs_elab", F.col("resultat_obs_elab") * 2)
    may = F.month("date_obs_elab") == 5
    state.merge(state_of(obs.where(may), sign=-1), state_of(doubled.where(may)), state_of(obs.where(march)))
    assert rows(state.thresholds()) == rows(monthly_thresholds(obs.where(~may).unionByName(doubled.where(may)), exact=True))
    before = rows(state.read())
    with pytest.raises(ValueError, match="does not hold"):
        state.merge(state_of(doubled.where(march), sign=-1))
    assert rows(state.read()) == before


def test_merged_states_forget_cancelled_values(spark):
    obs = readings(spark, 50)
    assert merge_states(state_of(obs), state_of(obs, sign=-1)).isEmpty()


# --------------------------------------------------------------------------- landed JSON text
PAGES = "request_id string, page int, count int, data array<struct<code_station: string, v: double>>"


def test_json_lines_are_read_or_rejected(spark):
    good = '{"request_id":"r1","page":1,"count":2,"data":[{"code_station":"S1","v":1.5},{"code_station":"S2","v":2}]}'
    bad = {"": "empty payload", "  ": "empty payload", good[:60]: "malformed JSON", "[1,2": "malformed JSON", "nonsense": "malformed JSON",
           good.replace('"page":1', '"page":"x"'): "malformed JSON", good.replace('"request_id":"r1",', ""): "no request_id",
           '{"request_id":"r","page":1}': "no data", '{"request_id":"r","data":[]}': "no page", "{}": "no request_id",
           '{"request_id":"r","page":1,"data":[null]}': "NULL entry in data"}
    lines = spark.createDataFrame([(x,) for x in [good, None, *bad]], "value string")
    parsed = landing.parse_json_pages(lines, PAGES)
    assert rows(landing.json_rejects(parsed), "value", "reason") == sorted([(None, "empty payload"), *bad.items()], key=repr)
    assert rows(landing.explode_json_pages(lines, PAGES, strict=False)) == [("r1", 1, "S1", 1.5), ("r1", 1, "S2", 2.0)]
    with pytest.raises(Exception, match="unreadable page"):
        landing.explode_json_pages(lines, PAGES).collect()


def test_requests_that_do_not_add_up(spark):
    def page(request, number, count, n):
        return (request, number, count, [("S", float(i)) for i in range(n)])
    pages = spark.createDataFrame([page("whole", 1, 3, 2), page("whole", 2, None, 1), page("short", 1, 5, 2), page("untold", 1, None, 2),
                                   page("twice", 1, 2, 2), page("twice", 1, 2, 2)], PAGES)
    split = landing.complete_requests(pages)
    assert {r.request_id for r in split["complete"].collect()} == {"whole", "untold"}
    split = landing.complete_requests(pages, all_readable=False)
    assert {r.request_id for r in split["complete"].collect()} == {"whole"}
    assert split["incomplete"].count() + split["complete"].count() == pages.count()


def _record(station, day, value):
    return {"code_site": "X", "code_station": station, "date_obs_elab": day, "resultat_obs_elab": value, "date_prod": "2026-10-02T12:00:00Z",
            "code_statut": "16", "code_qualification": "20", "grandeur_hydro_elab": "HIXnJ"}


def _land(folder, *lines):
    import json
    folder.mkdir()
    (folder / "p.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(folder)


def test_broken_lines_refuse_the_load_or_are_set_aside(spark, tmp_path):
    import json
    whole = {"request_id": "a", "page": 1, "count": 1, "data": [_record("S1", "2026-10-01", 1.0)]}
    first = {"request_id": "b", "page": 1, "count": 2, "data": [_record("S2", "2026-10-01", 2.0)]}
    second = json.dumps({"request_id": "b", "page": 2, "data": [_record("S3", "2026-10-01", 3.0)]})
    river = _land(tmp_path / "river", whole, first, second[:70], "")
    raw, aside = str(tmp_path / "raw"), str(tmp_path / "aside")
    with pytest.raises(LoadRejected, match="1 unreadable lines and 1 pages"):
        pipeline.ingest_river_pages(spark, river, raw, "b1")
    assert not tables.table_exists(spark, raw)
    got = pipeline.ingest_river_pages(spark, river, raw, "b1", set_aside=aside)
    assert got == {"appended": 1, "rejected": 0, "set_aside": 2}
    assert rows(spark.read.parquet(aside), "reason", "batch_id") == [("incomplete request", "b1"), ("malformed JSON", "b1")]
    doc = {"code_INSEE": "37261", "Latitude": 1.0, "Longitude": 1.0, "daily": {"time": ["2026-10-01"], **{v: [1.0] for v in schemas.WEATHER_VARIABLES}}}
    asked = spark.createDataFrame([("37261",)], "code_INSEE string")
    with pytest.raises(LoadRejected, match="1 unreadable weather"):
        pipeline.ingest_weather(spark, _land(tmp_path / "w", doc, json.dumps(doc)[:80]), asked, str(tmp_path / "rw"), "b1")


@pytest.mark.parametrize("partition_by", [("mois",), ()])
def test_a_failure_after_the_append_takes_the_rows_back(spark, tmp_path, monkeypatch, partition_by):
    one = {"request_id": "a", "page": 1, "count": 1, "data": [_record("S1", "2026-10-01", 1.0)]}
    two = {"request_id": "a", "page": 1, "count": 2, "data": [_record("S1", "2026-10-01", 9.0), _record("S2", "2026-11-01", 2.0)]}
    raw = str(tmp_path / "raw")
    t0 = dt.datetime(2026, 10, 5)
    pipeline.ingest_river_pages(spark, _land(tmp_path / "one", one), raw, "b1", t0, partition_by)
    before = rows(spark.read.parquet(raw))
    real = pipeline.load_versioned

    def breaks(*args, **kw):
        real(*args, **kw)
        raise RuntimeError("after the append")
    monkeypatch.setattr(pipeline, "load_versioned", breaks)
    late = _land(tmp_path / "two", two)
    for batch in ("b2", "b1"):  # also under the id of the earlier load, whose rows stay
        with pytest.raises(RuntimeError):
            pipeline.ingest_river_pages(spark, late, raw, batch, t0 + dt.timedelta(days=1), partition_by)
        assert rows(spark.read.parquet(raw)) == before
    fresh = str(tmp_path / "fresh")
    with pytest.raises(RuntimeError):
        pipeline.ingest_river_pages(spark, late, fresh, "b1", t0, partition_by)
    assert not tables.table_exists(spark, fresh) or spark.read.parquet(fresh).isEmpty()
    monkeypatch.setattr(pipeline, "load_versioned", real)
    assert pipeline.ingest_river_pages(spark, late, raw, "b2", t0 + dt.timedelta(days=1), partition_by)["appended"] == 2


def test_asking_for_a_table_deletes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace(spark.range(5), path)
    spark.range(9).write.parquet(f"{path}.next")  # another writer at work
    assert tables.table_exists(spark, path) and os.path.exists(f"{path}.next")


# --------------------------------------------------------------------------- coverage gaps
def test_coverage_gaps(spark):
    d = lambda day: dt.date(2024, 1, day)
    df = spark.createDataFrame([("a", d(2)), ("a", d(3)), ("a", d(3)), ("a", d(7)), ("b", d(1)), ("b", d(10)), ("n", None), (None, d(4))],
                               "e string, day date")
    got = rows(quality.coverage_gaps(df, "e", "day"))
    assert got == [("a", d(1), d(1), 1), ("a", d(4), d(6), 3), ("a", d(8), d(10), 3), ("b", d(2), d(9), 8), ("n", d(1), d(10), 10)]
    got = rows(quality.coverage_gaps(df, "e", "day", "2024-01-03", "2024-01-07", spark.createDataFrame([("c",), ("a",)], "e string")))
    assert got == [("a", d(4), d(6), 3), ("b", d(3), d(7), 5), ("c", d(3), d(7), 5), ("n", d(3), d(7), 5)]


# --------------------------------------------------------------------------- backfill
def test_backfill_resumes_after_any_interruption(spark, tmp_path):
    days = [dt.date(2026, 1, 20) + dt.timedelta(days=i) for i in range(75)]
    obs = spark.createDataFrame([("S1", d.isoformat(), float(d.day), "HIXnJ", dt.datetime(2026, 5, 1)) for d in days],
                                "code_station string, date_obs_elab string, resultat_obs_elab double, grandeur_hydro_elab string, date_prod timestamp")

    def chunk(first, last):
        return obs.where(F.col("date_obs_elab").between(first.isoformat(), last.isoformat()))

    def run(base, stop=None):
        ledger = backfill.Ledger(spark, f"{base}/ledger")

        def after(step, month):
            if (step, month.month) == stop:
                raise catalog_stored.Interrupted
        done = backfill.run_backfill(spark, "HIXnJ", days[0], days[-1], chunk, f"{base}/raw", ledger,
                                     loaded_at=lambda m: f"2026-06-{m.month:02d}T00:00:00", after=after)
        return done, ledger

    done, ledger = run(f"{tmp_path}/straight")
    assert [m.month for m in done] == [1, 2, 3, 4]
    want = rows(spark.read.parquet(f"{tmp_path}/straight/raw")), rows(ledger.read())
    assert len(want[0]) == len(days) and sum(r[2] for r in want[1]) == len(days)
    for i, stop in enumerate([("append", 2), ("record", 1)]):
        base = f"{tmp_path}/cut{i}"
        with pytest.raises(catalog_stored.Interrupted):
            run(base, stop)
        _, ledger = run(base)
        assert (rows(spark.read.parquet(f"{base}/raw")), rows(ledger.read())) == want
        assert run(base)[0] == []
        stored = spark.read.parquet(f"{base}/raw").withColumn("date_obs_elab", F.to_date("date_obs_elab"))
        assert backfill.missing_months(stored, ledger.read(), "date_obs_elab").isEmpty()
