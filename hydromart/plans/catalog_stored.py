"""Registered queries over stored tables and landed text, with their oracles (second part of ``catalog``).

Each stores real tables under the shared checkpoint folder first (bucketed histories, states,
indexes, ledgers, landed JSON lines), then runs the operators on them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.operators import geo, membership, ml, nearest, quality, versions as vers
from hydromart.operators.bucketed import BucketedTable
from hydromart.operators.threshold_state import ThresholdState, merge_states, state_of
from hydromart.plans import backfill, catalog, testbed
from hydromart.plans.catalog import FEATURE_CHAIN, FEATS, ML_CUTOFF, ORACLES, SQL_OBS, register, with_ctes
from hydromart.session import checkpoint_dir
from hydromart.sources import landing
from hydromart.streaming import ingest


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------------------- bucketed raw tables
def stored_events(spark, sf_dir) -> tuple[BucketedTable, DataFrame]:
    """The morning rows of ``events`` as a bucketed raw table, and the afternoon load."""
    old, new = catalog._ev_split(spark, sf_dir)
    table = BucketedTable.create(catalog._ev_hash(old), _folder(spark, "events-by-key"), catalog.EV_KEYS)
    return table, catalog._ev_hash(vers.latest_versions(new, catalog.EV_KEYS, catalog.EV_ORDER))


@register("append_changed_bucketed", ORACLES["append_changed"])
def q_append_changed_bucketed(spark, sf_dir):
    """VER-05/06 on a bucketed history: the load appends, and the appended rows are read back."""
    table, incoming = stored_events(spark, sf_dir)
    table.append_changed(incoming, catalog.EV_ORDER)
    return table.read().where("batch_id = 'pm'").select("user_id", "date", "event_type", "event_id", "value")


@register("upsert_changed_only_bucketed", ORACLES["upsert_changed_only"])
def q_upsert_changed_only_bucketed(spark, sf_dir):
    """SNK-04 on a bucketed table: only the source is shuffled."""
    target, source = catalog._orders_halves(spark, sf_dir)
    table = BucketedTable.create(target, _folder(spark, "orders-by-key"), ["o_orderkey"])
    return table.merged_changes(source)


@register("incremental_mart_indexed", ORACLES["incremental_mart"])
def q_incremental_mart_indexed(spark, sf_dir):
    """SNK-09 through bitmaps and a bucketed identity table; the mart's hashes are not shuffled."""
    src, mart = catalog._inc_frames(spark, sf_dir)
    index = membership.IdentityIndex.build(mart, _folder(spark, "mart-identities"))
    return membership.incremental_rows(src, mart, index)


# --------------------------------------------------------------------------- landed JSON text
PAGE_SCHEMA = "request_id string, page int, count int, data array<struct<role: string, text: string>>"
SQL_PAGES = """
told AS (
  SELECT conv_id, turn, role, text, (conv_id * 31 + turn) % 11 AS fault FROM conversations
)"""


def conversation_lines(spark, sf_dir) -> DataFrame:
    """(conv_id, turn, value): one page envelope as JSON text per conversation turn, every fourth or so broken.

    Planted by (31 * conv_id + turn) mod 11: 0 truncated, 1 no page, 2 blank, 3 a page of another type.
    """
    turns = testbed.table(spark, sf_dir, "conversations")
    n = turns.groupBy("conv_id").agg(F.count(F.lit(1)).cast("int").alias("_n"), F.min("turn").alias("_first"))
    fault = F.pmod(F.col("conv_id") * 31 + F.col("turn"), F.lit(11))
    page = F.when(fault == 3, F.lit("three")).when(fault != 1, F.col("turn").cast("string"))
    doc = F.struct(F.col("conv_id").cast("string").alias("request_id"), page.alias("page"),
                   F.when(F.col("turn") == F.col("_first"), F.col("_n")).alias("count"),
                   F.array(F.struct("role", "text")).alias("data"))
    # a number is written without quotes, as an API sends it
    text = F.regexp_replace(F.to_json(doc), r'"page":"(\d+)"', r'"page":$1')
    broken = (F.when(fault == 0, F.substring(text, F.lit(1), (F.length(text) / 2).cast("int")))
              .when(fault == 2, F.lit("  ")).otherwise(text))
    return turns.join(n, "conv_id").select("conv_id", "turn", broken.alias("value"))


@register("explode_json_pages", with_ctes(SQL_PAGES) + """
SELECT CAST(conv_id AS VARCHAR) AS request_id, CAST(turn AS INTEGER) AS page, role, text FROM told WHERE fault > 3""")
def q_explode_json_pages(spark, sf_dir):
    path = _folder(spark, "landed-pages")
    conversation_lines(spark, sf_dir).select("value").write.text(path)
    return landing.explode_json_pages(spark.read.text(path), PAGE_SCHEMA, strict=False)


@register("json_rejects", with_ctes(SQL_PAGES) + """
SELECT conv_id, turn, CASE fault WHEN 1 THEN 'no page' WHEN 2 THEN 'empty payload' ELSE 'malformed JSON' END AS reason
FROM told WHERE fault <= 3""")
def q_json_rejects(spark, sf_dir):
    parsed = landing.parse_json_pages(conversation_lines(spark, sf_dir), PAGE_SCHEMA)
    return landing.json_rejects(parsed).select("conv_id", "turn", "reason")


@register("complete_requests", with_ctes(SQL_PAGES) + """
SELECT CAST(conv_id AS VARCHAR) AS request_id, count(*) AS n_pages
FROM told GROUP BY conv_id HAVING min(fault) > 3""")
def q_complete_requests(spark, sf_dir):
    # a request with any broken page, also the one that announces the count, is not complete
    parsed = landing.parse_json_pages(conversation_lines(spark, sf_dir), PAGE_SCHEMA)
    kept = landing.complete_requests(landing.json_documents(parsed), all_readable=False)["complete"]
    return kept.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_pages"))


# --------------------------------------------------------------------------- threshold state
@register("threshold_state", ORACLES["thresholds"])
def q_threshold_state(spark, sf_dir):
    """AG-01 from stored state: two deliveries, then a correction of readings that were first read doubled."""
    obs = testbed.river_observations(spark, sf_dir)
    late = F.col("date_obs_elab") >= F.lit("1998-01-01").cast("date")
    wrong = F.dayofmonth("date_obs_elab") == 13
    doubled = obs.withColumn("resultat_obs_elab", F.when(wrong, F.col("resultat_obs_elab") * 2).otherwise(F.col("resultat_obs_elab")))
    state = ThresholdState(spark, _folder(spark, "threshold-state"))
    state.merge(state_of(doubled.where(~late)))
    state.merge(state_of(obs.where(late)))
    state.merge(state_of(doubled.where(~late & wrong), sign=-1), state_of(obs.where(~late & wrong)))
    return state.thresholds()


@register("threshold_state_rows", with_ctes(SQL_OBS) + """
SELECT code_station, CAST(month(date_obs_elab) AS INTEGER) AS mois, CAST(year(date_obs_elab) AS INTEGER) AS annee,
       resultat_obs_elab AS valeur, count(*) AS n
FROM obs WHERE code_qualification = '20' AND code_statut IN ('12', '16') AND resultat_obs_elab IS NOT NULL GROUP BY ALL""")
def q_threshold_state_rows(spark, sf_dir):
    obs = testbed.river_observations(spark, sf_dir)
    even = F.pmod(F.dayofyear("date_obs_elab"), F.lit(2)) == 0
    return merge_states(state_of(obs.where(even)), state_of(obs.where(~even)))


# --------------------------------------------------------------------------- coverage and backfill
@register("coverage_gaps", with_ctes(SQL_OBS) + """
, bounds AS (SELECT min(date_obs_elab) AS low, max(date_obs_elab) AS high FROM obs),
days AS (
  SELECT code_station, CAST(unnest(generate_series(low, high, INTERVAL 1 DAY)) AS DATE) AS day
  FROM (SELECT DISTINCT code_station FROM obs), bounds
),
missing AS (
  SELECT d.code_station, d.day, d.day - CAST(row_number() OVER (PARTITION BY d.code_station ORDER BY d.day) AS INTEGER) AS island
  FROM days d LEFT JOIN obs o ON o.code_station = d.code_station AND o.date_obs_elab = d.day WHERE o.code_station IS NULL
)
SELECT code_station, min(day) AS first_missing, max(day) AS last_missing, CAST(count(*) AS INTEGER) AS n_days
FROM missing GROUP BY code_station, island""")
def q_coverage_gaps(spark, sf_dir):
    return quality.coverage_gaps(testbed.river_observations(spark, sf_dir), "code_station", "date_obs_elab")


BACKFILL_FROM, BACKFILL_TO = "1998-01-10", "1998-04-20"
SQL_BACKFILL = f"""
chunked AS (
  SELECT code_station, date_obs_elab, resultat_obs_elab, CAST(date_trunc('month', date_obs_elab) AS DATE) AS mois
  FROM obs WHERE date_obs_elab BETWEEN DATE '{BACKFILL_FROM}' AND DATE '{BACKFILL_TO}'
)"""


class Interrupted(RuntimeError):
    """Stops a backfill where a test or a query wants it stopped."""


def interrupted_backfill(spark, sf_dir) -> tuple[str, backfill.Ledger]:
    """Months of observations loaded by three runs: the first dies between append and record, the second behind a record."""
    obs = testbed.river_observations(spark, sf_dir)
    base = _folder(spark, "backfill")
    ledger = backfill.Ledger(spark, f"{base}/ledger")

    def chunk(first: dt.date, last: dt.date) -> DataFrame:
        return obs.where(F.col("date_obs_elab").between(F.lit(first), F.lit(last))).select(
            "code_station", F.col("date_obs_elab").cast("string").alias("date_obs_elab"), "grandeur_hydro_elab",
            "resultat_obs_elab", "code_qualification", "code_statut",
            F.lit("2001-01-01 00:00:00").cast("timestamp").alias("date_prod"))

    stops = [("append", dt.date(1998, 2, 1)), ("record", dt.date(1998, 3, 1)), None]
    for stop in stops:
        def after(step: str, month: dt.date) -> None:
            if (step, month) == stop:
                raise Interrupted(f"{step} {month}")
        try:
            backfill.run_backfill(spark, "HIXnJ", BACKFILL_FROM, BACKFILL_TO, chunk, f"{base}/raw", ledger,
                                  loaded_at=lambda month: f"2001-06-{month.month:02d}T00:00:00", after=after)
        except Interrupted:
            continue
    return f"{base}/raw", ledger


@register("resumed_backfill", with_ctes(SQL_OBS, SQL_BACKFILL) + """
SELECT code_station, CAST(date_obs_elab AS VARCHAR) AS date_obs_elab, resultat_obs_elab FROM chunked""")
def q_resumed_backfill(spark, sf_dir):
    raw, _ = interrupted_backfill(spark, sf_dir)
    return spark.read.parquet(raw).select("code_station", F.col("date_obs_elab").cast("string").alias("date_obs_elab"),
                                          "resultat_obs_elab")


@register("backfill_ledger", with_ctes(SQL_OBS, SQL_BACKFILL) + """
SELECT 'HIXnJ' AS grandeur_hydro_elab, mois, count(*) AS nb_lignes FROM chunked GROUP BY mois""")
def q_backfill_ledger(spark, sf_dir):
    _, ledger = interrupted_backfill(spark, sf_dir)
    return ledger.read().select("grandeur_hydro_elab", "mois", "nb_lignes")


# --------------------------------------------------------------------------- nearest station with pruning
@register("nearest_pruned", ORACLES["nearest_fallback"])
def q_nearest_pruned(spark, sf_dir):
    """JN-10 by descent through bounding boxes, for the communes without a station in reach."""
    co, st = catalog._geo_frames(spark, sf_dir)
    found = nearest.nearest_in_tree(geo.communes_without_station(co, st), nearest.station_tree(st))
    return found.select("code_insee", "code_station", F.round("distance_m", 2).alias("distance_m"))


@register("nearest_cluster", """
WITH co AS (SELECT CAST(c_custkey AS VARCHAR) AS code_insee,
                   42.0 + ((c_custkey * 37) % 900) / 100.0 AS lat, -5.0 + ((c_custkey * 53) % 1300) / 100.0 AS lon
            FROM customer),
st AS (SELECT CAST(s_suppkey AS VARCHAR) AS code_station,
              CASE WHEN s_suppkey % 3 = 0 THEN 46.0 + s_suppkey / 1000000.0 ELSE 42.0 + ((s_suppkey * 71) % 900) / 100.0 END AS lat,
              CASE WHEN s_suppkey % 3 = 0 THEN 2.0 + (s_suppkey % 100) / 1000000.0 ELSE -5.0 + ((s_suppkey * 29) % 1300) / 100.0 END AS lon
       FROM supplier)
SELECT code_insee, code_station, round(2 * 6371008.8 * asin(sqrt(least(1.0,
         pow(sin((radians(st.lat) - radians(co.lat)) / 2), 2)
         + cos(radians(co.lat)) * cos(radians(st.lat)) * pow(sin((radians(st.lon) - radians(co.lon)) / 2), 2)))), 2) AS distance_m
FROM co CROSS JOIN st
QUALIFY row_number() OVER (PARTITION BY code_insee ORDER BY 2 * 6371008.8 * asin(sqrt(least(1.0,
         pow(sin((radians(st.lat) - radians(co.lat)) / 2), 2)
         + cos(radians(co.lat)) * cos(radians(st.lat)) * pow(sin((radians(st.lon) - radians(co.lon)) / 2), 2)))), code_station) = 1""")
def q_nearest_cluster(spark, sf_dir):
    """A third of all stations stands within a few metres; every commune looks for its nearest one."""
    co, st = catalog._geo_frames(spark, sf_dir)
    key = F.col("code_station").cast("long")
    third = key % 3 == 0
    st = st.withColumns({
        "latitude_station": F.when(third, F.lit(46.0) + key / 1000000.0).otherwise(F.col("latitude_station")),
        "longitude_station": F.when(third, F.lit(2.0) + (key % 100) / 1000000.0).otherwise(F.col("longitude_station"))})
    found = nearest.nearest_in_tree(co, nearest.station_tree(st))
    return found.select("code_insee", "code_station", F.round("distance_m", 2).alias("distance_m"))


# --------------------------------------------------------------------------- certificate of the fit
@register("fit_certificate", with_ctes(*FEATURE_CHAIN) + f"""
, train AS (SELECT * FROM features WHERE target_j1 IS NOT NULL AND date < DATE '{ML_CUTOFF}'),
medians AS (SELECT {", ".join(f"CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS {c}" for c in FEATS)} FROM train),
filled AS (SELECT {", ".join(f"coalesce(t.{c}, m.{c}) AS {c}" for c in FEATS)} FROM train t, medians m)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round((SELECT {c} FROM medians), 6) AS median, round(avg({c}), 6) AS mean, "
    f"round(stddev_pop({c}), 6) AS deviation, true AS stationary FROM filled HAVING count(*) > 0" for c in FEATS)
    + " UNION ALL SELECT '(intercept)', NULL, NULL, NULL, true FROM filled HAVING count(*) > 0")
def q_fit_certificate(spark, sf_dir):
    """ML-03/04/06/12: at the fitted coefficients the gradient of the penalised weighted loss vanishes."""
    train = ml.chronological_split(catalog.features_table(spark, sf_dir), ML_CUTOFF)["train"]
    if train.isEmpty():
        return spark.createDataFrame([], "feature string, median double, mean double, deviation double, stationary boolean")
    proof = ml.certificate(ml.fit(train, tol=1e-9), train)
    return proof.select("feature", *[F.round(c, 6).alias(c) for c in ("median", "mean", "deviation")],
                        (F.abs("gradient") < 1e-5).alias("stationary"))


# --------------------------------------------------------------------------- streamed loads
@register("stream_versioned_ingest", """
SELECT CAST(event_id AS VARCHAR) AS code_station, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_obs_elab, event_type AS grandeur_hydro_elab,
       value AS resultat_obs_elab, 1 AS n_loads
FROM events""")
def q_stream_versioned_ingest(spark, sf_dir):
    """STR-01, VER-02: ``events`` streamed as landed files, in several loads.

    The last load is rolled back and streamed again by a new stream over all files: only what is
    missing is appended, so every event ends in the table once, under one load.
    """
    base = _folder(spark, "stream-ingest")
    ev = testbed.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("code_station"), F.to_date("ts").cast("string").alias("date_obs_elab"),
        F.col("event_type").alias("grandeur_hydro_elab"), F.col("value").alias("resultat_obs_elab"),
        F.lit("2001-01-01 00:00:00").cast("timestamp").alias("date_prod"))
    ev.repartition(3, "code_station").write.parquet(f"{base}/landing")

    def run(name: str, files: int | None) -> None:
        ingest.versioned_ingest(spark, f"{base}/landing", ev.schema, f"{base}/raw", "river", f"{base}/{name}", "parquet",
                                files_per_load=files).awaitTermination()
    run("first", 1)
    log = ingest.LoadLog(spark, f"{base}/raw.loads")
    last = log.read().orderBy(F.desc("inserted_at")).first()
    if last is not None:
        ingest.roll_back_load(spark, f"{base}/raw", log, last.load_id)
    run("second", None)
    raw = spark.read.parquet(f"{base}/raw")
    return raw.groupBy("code_station", F.col("date_obs_elab").cast("string").alias("date_obs_elab"), "grandeur_hydro_elab",
                       "resultat_obs_elab").agg(F.count_distinct("batch_id").cast("int").alias("n_loads"))
