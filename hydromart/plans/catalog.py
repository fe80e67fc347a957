"""Registered queries (``queries()``) and their DuckDB oracles (``oracle_sql()``).

Each query reads the driver's whole tables through ``plans.testbed`` and runs the library
operators; each oracle re-states the same semantics in plain SQL. Column names match.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.functions import codes as fc, temporal as ft
from hydromart.operators import geo, ml, profile, quality, series, tables, thresholds as th, versions as vers
from hydromart.plans import marts, staging, testbed
from hydromart.session import checkpoint_dir
from hydromart.sources import landing
from hydromart.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# --------------------------------------------------------------------------- SQL fragments
# The nation-day observation and weather frames (testbed role mapping) as DuckDB CTEs.
SQL_OBS = """
li AS (
  SELECT CAST(s.s_nationkey AS VARCHAR) AS code_station, CAST(l.l_shipdate AS DATE) AS date_obs_elab,
         l.l_quantity, l.l_extendedprice, l.l_discount, l.l_returnflag, l.l_linestatus
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
obs AS (
  SELECT code_station, date_obs_elab, max(l_extendedprice) AS resultat_obs_elab,
         CASE WHEN min(l_returnflag) = 'R' THEN '10' ELSE '20' END AS code_qualification,
         CASE WHEN min(l_linestatus) = 'F' THEN '12' ELSE '16' END AS code_statut,
         'HIXnJ' AS grandeur_hydro_elab
  FROM li GROUP BY code_station, date_obs_elab
)"""

# Thresholds by rank: the limit of a quantile is the smallest accepted reading whose rank in its
# station and month reaches that share of the readings.
SQL_LIMITS = """
accepted AS (
  SELECT code_station, date_obs_elab, resultat_obs_elab AS reading,
         CAST(extract(month FROM date_obs_elab) AS INTEGER) AS mois
  FROM obs
  WHERE resultat_obs_elab IS NOT NULL AND code_qualification = '20' AND (code_statut = '12' OR code_statut = '16')
),
standing AS (
  SELECT *, row_number() OVER (PARTITION BY code_station, mois ORDER BY reading) AS place,
         count(*) OVER (PARTITION BY code_station, mois) AS of_all
  FROM accepted
),
limits AS (
  SELECT code_station, mois,
         min(reading) FILTER (WHERE place >= 0.90 * of_all) AS p90,
         min(reading) FILTER (WHERE place >= 0.95 * of_all) AS p95,
         min(reading) FILTER (WHERE place >= 0.99 * of_all) AS p99,
         max(of_all) AS n_reference,
         count(DISTINCT extract(year FROM date_obs_elab)) AS n_annees_reference
  FROM standing GROUP BY code_station, mois
)"""

# Classes as candidate labels: every judged day is Normal, reaching a limit that lies above the
# next lower one offers a higher label, and the highest offer wins.
SQL_GRADES = """
judged AS (
  SELECT a.code_station, a.date_obs_elab, a.reading, l.p90, l.p95, l.p99
  FROM accepted a JOIN limits l USING (code_station, mois) WHERE l.n_annees_reference >= 5
),
offers AS (
  SELECT code_station, date_obs_elab, 0 AS height, 'Normal' AS label FROM judged
  UNION ALL SELECT code_station, date_obs_elab, 1, 'Élevé' FROM judged WHERE reading >= p95 AND NOT p95 <= p90
  UNION ALL SELECT code_station, date_obs_elab, 2, 'Exceptionnel' FROM judged WHERE reading >= p99 AND NOT p99 <= p95
),
grades AS (
  SELECT code_station, date_obs_elab, arg_max(label, height) AS label FROM offers GROUP BY ALL
),
graded AS (
  SELECT obs.*, limits.* EXCLUDE (code_station, mois), grades.label AS niveau_hydrologique
  FROM obs
  LEFT JOIN limits ON limits.code_station = obs.code_station AND limits.mois = extract(month FROM obs.date_obs_elab)
  LEFT JOIN grades ON grades.code_station = obs.code_station AND grades.date_obs_elab = obs.date_obs_elab
)"""

SQL_PLACES = """
places AS (
  SELECT j.code_station, j.date_obs_elab AS date, (j.reading - j.p95) / (j.p99 - j.p90) AS position_p95,
         CASE WHEN j.reading < j.p95 THEN 0 ELSE 1 END AS depasse_p95_j
  FROM judged j WHERE j.p90 < j.p99
)"""

# The days before and after are looked up by date, so a gap simply finds no row.
SQL_NEIGHBOURS = """
neighbours AS (
  SELECT today.*, today.position_p95 - yesterday.position_p95 AS variation_position_1j,
         tomorrow.depasse_p95_j AS target_j1
  FROM places today
  LEFT JOIN places yesterday ON yesterday.code_station = today.code_station AND yesterday.date + 1 = today.date
  LEFT JOIN places tomorrow ON tomorrow.code_station = today.code_station AND tomorrow.date - 1 = today.date
)"""

# Three-day rain from the days that exist: each day is paired with itself and the two before it,
# and the sum stands only when three days with rain figures were found.
SQL_WEATHER = """
rain AS (
  SELECT lpad(code_station, 5, '0') AS code_insee, date_obs_elab AS date,
         sum(l_quantity) AS pluie_j, round(avg(l_discount), 6) AS humidite_sol
  FROM li GROUP BY ALL
),
three_days AS (
  SELECT d.code_insee, d.date, sum(r.pluie_j) AS pluie_3j
  FROM rain d JOIN rain r ON r.code_insee = d.code_insee AND r.date IN (d.date, d.date - 1, d.date - 2)
  WHERE r.pluie_j IS NOT NULL GROUP BY d.code_insee, d.date HAVING count(*) = 3
),
skies AS (
  SELECT rain.code_insee, rain.date, rain.pluie_j, three_days.pluie_3j, rain.humidite_sol
  FROM rain LEFT JOIN three_days USING (code_insee, date)
)"""

SQL_STATIONS = """
stations AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS code_station, lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code_insee,
         lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS code_departement
  FROM nation
)"""

SQL_FEATURES = """
complete_days AS (
  SELECT n.date, n.code_station, st.code_insee, st.code_departement, n.position_p95, n.variation_position_1j,
         k.pluie_j, k.pluie_3j, k.humidite_sol, CAST(extract(month FROM n.date) AS INTEGER) AS mois,
         n.depasse_p95_j, n.target_j1
  FROM stations st, skies k, neighbours n
  WHERE n.code_station = st.code_station AND k.code_insee = st.code_insee AND k.date = n.date
    AND k.pluie_j + k.pluie_3j + k.humidite_sol IS NOT NULL
),
long_series AS (SELECT code_station FROM complete_days GROUP BY code_station HAVING count(*) > 99),
features AS (SELECT complete_days.* FROM complete_days SEMI JOIN long_series USING (code_station))"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


HYDRO_CHAIN = (SQL_OBS, SQL_LIMITS, SQL_GRADES, SQL_PLACES, SQL_NEIGHBOURS)
FEATURE_CHAIN = HYDRO_CHAIN + (SQL_WEATHER, SQL_STATIONS, SQL_FEATURES)


# --------------------------------------------------------------------------- M0: hydro + features
def fct_hydro(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    return th.hydro_thresholds_mart(testbed.river_observations(spark, sf_dir, grain))


def features_table(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    """The feature mart materialised with a reliable checkpoint (``spark.checkpoint.dir``)."""
    checkpoint_dir(spark)
    return build_ml_features(spark, sf_dir, grain).checkpoint(eager=True)


def build_ml_features(spark: SparkSession, sf_dir: str, grain: str = "nation") -> DataFrame:
    stations = marts.stations_with_commune(testbed.station_directory(spark, sf_dir, grain),
                                           testbed.communes(spark, sf_dir, grain))
    days = testbed.stored_station_days(spark, sf_dir, grain)
    hydro = th.hydro_thresholds_mart(testbed.river_observations(spark, sf_dir, grain, days))
    return marts.ml_features(hydro, stations, testbed.daily_weather(spark, sf_dir, grain, days))


@register("thresholds", with_ctes(SQL_OBS, SQL_LIMITS) + "SELECT * FROM limits")
def q_thresholds(spark, sf_dir):
    return th.monthly_thresholds(testbed.river_observations(spark, sf_dir))


@register("level_class", with_ctes(SQL_OBS, SQL_LIMITS, SQL_GRADES) + "SELECT * FROM graded")
def q_level_class(spark, sf_dir):
    return fct_hydro(spark, sf_dir).select(
        "code_station", "date_obs_elab", "resultat_obs_elab", "code_qualification", "code_statut",
        "grandeur_hydro_elab", "p90", "p95", "p99", "n_reference", "n_annees_reference",
        "niveau_hydrologique")


@register("position", with_ctes(*HYDRO_CHAIN[:4]) + "SELECT * FROM places")
def q_position(spark, sf_dir):
    return th.exceedance_position(fct_hydro(spark, sf_dir))


@register("adjacent_diff", with_ctes(*HYDRO_CHAIN)
          + "SELECT code_station, date, position_p95, variation_position_1j FROM neighbours")
def q_adjacent_diff(spark, sf_dir):
    pos = th.exceedance_position(fct_hydro(spark, sf_dir))
    return series.adjacent_difference(pos, "code_station", "date", "position_p95",
                                      out="variation_position_1j").drop("depasse_p95_j")


@register("next_day_label", with_ctes(*HYDRO_CHAIN)
          + "SELECT code_station, date, depasse_p95_j, target_j1 FROM neighbours")
def q_next_day_label(spark, sf_dir):
    pos = th.exceedance_position(fct_hydro(spark, sf_dir))
    return series.next_day_value(pos, "code_station", "date", "depasse_p95_j",
                                 out="target_j1").drop("position_p95")


@register("day_collapse", """
SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN count(*) = 1 THEN max(l_quantity) END AS l_quantity,
       CASE WHEN count(*) = 1 THEN max(l_discount) END AS l_discount
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)""")
def q_day_collapse(spark, sf_dir):
    li = testbed.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias("date"), "l_quantity", "l_discount")
    return series.collapse_days(li, ["l_suppkey", "date"], ["l_quantity", "l_discount"])


@register("rolling_strict", with_ctes(SQL_OBS, SQL_WEATHER) + "SELECT * FROM skies")
def q_rolling_strict(spark, sf_dir):
    return marts.weather_days(testbed.daily_weather(spark, sf_dir))


@register("min_history", with_ctes(*FEATURE_CHAIN)
          + "SELECT code_station, count(*) AS n_rows FROM features GROUP BY code_station")
def q_min_history(spark, sf_dir):
    return build_ml_features(spark, sf_dir).groupBy("code_station").agg(F.count(F.lit(1)).alias("n_rows"))


@register("ml_features", with_ctes(*FEATURE_CHAIN) + "SELECT * FROM features")
def q_ml_features(spark, sf_dir):
    return build_ml_features(spark, sf_dir)


# --------------------------------------------------------------------------- M1: versioned raw
# events as a raw versioned table: key (user_id, day, event_type), load instant = ts,
# tie-break event_id; morning rows are the stored table, afternoon rows the incoming load.
EV_KEYS = ["user_id", "date", "event_type"]
EV_ORDER = ["ts", "event_id"]
EV_COLS = ["user_id", "date", "event_type", "event_id", "ts", "value", "props"]

SQL_EV = """
ev AS (
  SELECT user_id, CAST(ts AS DATE) AS date, event_type, event_id, ts, value, props,
         CASE WHEN hour(ts) < 12 THEN 'am' ELSE 'pm' END AS batch_id
  FROM events
),
ev_old AS (SELECT * FROM ev WHERE batch_id = 'am'),
ev_new AS (SELECT * FROM ev WHERE batch_id = 'pm'),
cur_old AS (
  SELECT * FROM ev_old
  QUALIFY row_number() OVER (PARTITION BY user_id, date, event_type
                             ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1
),
load_new AS (
  SELECT * FROM ev_new
  QUALIFY row_number() OVER (PARTITION BY user_id, date, event_type
                             ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1
)"""


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = testbed.table(spark, sf_dir, "events")
    return ev.select("user_id", F.to_date("ts").alias("date"), "event_type", "event_id", "ts", "value",
                     "props", F.when(F.hour("ts") < 12, "am").otherwise("pm").alias("batch_id"))


def _ev_split(spark, sf_dir):
    raw = events_raw(spark, sf_dir)
    return raw.where(F.col("batch_id") == "am"), raw.where(F.col("batch_id") == "pm")


def _ev_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("row_hash", vers.content_hash(["user_id", "date", "event_type", "value"]))


@register("latest_version", with_ctes(SQL_EV) + """
SELECT user_id, date, event_type, event_id, ts, value, props FROM ev
QUALIFY row_number() OVER (PARTITION BY user_id, date, event_type
                           ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""")
def q_latest_version(spark, sf_dir):
    raw = events_raw(spark, sf_dir).drop("batch_id")
    return vers.latest_versions(raw, EV_KEYS, EV_ORDER).select(*EV_COLS)


@register("current_in_batch", with_ctes(SQL_EV) + """
SELECT c.user_id, c.date, c.event_type, c.event_id, c.ts, c.value, c.props FROM cur_old c
WHERE EXISTS (SELECT 1 FROM ev_new n WHERE n.user_id = c.user_id AND n.date = c.date
              AND n.event_type = c.event_type)""")
def q_current_in_batch(spark, sf_dir):
    old, new = _ev_split(spark, sf_dir)
    cur = vers.current_for_batch(old.drop("batch_id"), new, EV_KEYS, EV_ORDER)
    return cur.select(*EV_COLS)


@register("batch_conflicts", with_ctes(SQL_EV) + """
SELECT user_id, date, event_type, count(DISTINCT value) AS n_versions, count(*) AS n_rows
FROM ev_new GROUP BY user_id, date, event_type HAVING count(DISTINCT value) > 1""")
def q_batch_conflicts(spark, sf_dir):
    _, new = _ev_split(spark, sf_dir)
    return vers.batch_conflicts(_ev_hash(new), EV_KEYS)


@register("append_changed", with_ctes(SQL_EV) + """
SELECT n.user_id, n.date, n.event_type, n.event_id, n.value
FROM load_new n LEFT JOIN cur_old o USING (user_id, date, event_type)
WHERE o.value IS DISTINCT FROM n.value""")
def q_append_changed(spark, sf_dir):
    old, new = _ev_split(spark, sf_dir)
    incoming = _ev_hash(vers.latest_versions(new, EV_KEYS, EV_ORDER))
    plan = vers.plan_load(_ev_hash(old), incoming, EV_KEYS, EV_ORDER)
    return plan["to_append"].select("user_id", "date", "event_type", "event_id", "value")


@register("rejected_keys", """
WITH incoming AS (
  SELECT event_id, CASE WHEN value < 1 THEN ' ' ELSE CAST(value AS VARCHAR) END AS code_insee,
         CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m') WHEN event_type = 'error' AND value > 50 THEN NULL
              ELSE CAST(ts AS VARCHAR) END AS date,
         CASE WHEN event_type = 'signup' AND value > 50 THEN NULL ELSE event_type END AS event_type
  FROM events
)
SELECT event_id, code_insee,
       CASE WHEN trim(code_insee) = '' THEN 'missing code_insee' WHEN date IS NULL THEN 'missing date'
            WHEN event_type IS NULL THEN 'missing event_type' WHEN length(date) < 10 THEN 'invalid date'
            ELSE 'code_insee too long' END AS reason
FROM incoming
WHERE trim(code_insee) = '' OR date IS NULL OR event_type IS NULL OR length(date) < 10 OR length(trim(code_insee)) > 5""")
def q_rejected_keys(spark, sf_dir):
    # The incoming code is the text of ``value`` (4 to 6 characters), so the length rule fires on
    # real rows; blank codes, missing and partial dates and missing measures are planted.
    ev = testbed.table(spark, sf_dir, "events")
    late = F.col("value") > 50
    incoming = ev.select(
        "event_id", F.when(F.col("value") < 1, " ").otherwise(F.col("value").cast("string")).alias("code_insee"),
        F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM"))
        .when((F.col("event_type") == "error") & late, F.lit(None)).otherwise(F.col("ts").cast("string")).alias("date"),
        F.when((F.col("event_type") == "signup") & late, F.lit(None)).otherwise(F.col("event_type")).alias("event_type"))
    out = vers.normalise_keys(incoming, "code_insee", "date", ["event_type"])
    return out["rejected"].select("event_id", "code_insee", "reason")


@register("version_chain_aba", """
WITH v AS (
  SELECT user_id, CAST(ts AS DATE) AS date, event_type, event_id, props, round(value, -1) AS content,
         lag(round(value, -1)) OVER w AS prev, row_number() OVER w AS rn
  FROM events
  WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts, event_id)
)
SELECT user_id, date, event_type, event_id, content, props FROM v
WHERE rn = 1 OR content IS DISTINCT FROM prev""")
def q_version_chain_aba(spark, sf_dir):
    raw = events_raw(spark, sf_dir).withColumn("content", F.round("value", -1))
    return (vers.version_changes(raw, EV_KEYS, EV_ORDER, "content")
            .select("user_id", "date", "event_type", "event_id", "content", "props"))


@register("rollback_batch", with_ctes(SQL_EV) + """
SELECT user_id, date, event_type, event_id, ts, value, props FROM cur_old""")
def q_rollback_batch(spark, sf_dir):
    restored = tables.rollback_batch(events_raw(spark, sf_dir), "pm")
    return vers.latest_versions(restored.drop("batch_id"), EV_KEYS, EV_ORDER).select(*EV_COLS)


# orders as a target table; the load re-delivers 1996 onwards with every order marked F.
SQL_ORD = """
tgt AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
         md5(concat(o_orderstatus, '|', CAST(o_totalprice AS VARCHAR))) AS row_hash
  FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01'
),
src AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
         md5(concat('F', '|', CAST(o_totalprice AS VARCHAR))) AS row_hash
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01'
)"""
ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "row_hash"]


def _orders_halves(spark, sf_dir):
    o = testbed.table(spark, sf_dir, "orders")

    def shaped(df, status):
        return df.select("o_orderkey", "o_custkey", status.alias("o_orderstatus"), "o_totalprice",
                         F.to_date("o_orderdate").alias("o_orderdate")).withColumn(
            "row_hash", F.md5(F.concat_ws("|", "o_orderstatus", F.col("o_totalprice").cast("string"))))
    day = F.to_date("o_orderdate")  # date bounds: independent of the session time zone
    tgt = shaped(o.where(day < F.lit("1997-01-01").cast("date")), F.col("o_orderstatus"))
    src = shaped(o.where(day >= F.lit("1996-01-01").cast("date")), F.lit("F"))
    return tgt, src


@register("upsert", with_ctes(SQL_ORD) + """
SELECT * FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM src)
UNION ALL SELECT * FROM src""")
def q_upsert(spark, sf_dir):
    tgt, src = _orders_halves(spark, sf_dir)
    return tables.upsert(tgt, src, ["o_orderkey"])


@register("upsert_counts", with_ctes(SQL_ORD) + """
SELECT count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted,
       count(*) FILTER (WHERE t.o_orderkey IS NOT NULL) AS updated
FROM src s LEFT JOIN tgt t USING (o_orderkey)""")
def q_upsert_counts(spark, sf_dir):
    tgt, src = _orders_halves(spark, sf_dir)
    return tables.upsert_counts(tgt, src, ["o_orderkey"])


@register("upsert_changed_only", with_ctes(SQL_ORD) + """
SELECT CASE WHEN s.o_orderkey IS NULL OR t.row_hash IS NOT DISTINCT FROM s.row_hash
            THEN t.o_orderkey ELSE s.o_orderkey END AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL OR t.row_hash IS NOT DISTINCT FROM s.row_hash
            THEN t.o_custkey ELSE s.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NULL OR t.row_hash IS NOT DISTINCT FROM s.row_hash
            THEN t.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NULL OR t.row_hash IS NOT DISTINCT FROM s.row_hash
            THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NULL OR t.row_hash IS NOT DISTINCT FROM s.row_hash
            THEN t.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
       CASE WHEN s.o_orderkey IS NULL OR t.row_hash IS NOT DISTINCT FROM s.row_hash
            THEN t.row_hash ELSE s.row_hash END AS row_hash,
       CASE WHEN s.o_orderkey IS NULL THEN 'keep' WHEN t.o_orderkey IS NULL THEN 'insert'
            WHEN t.row_hash IS NOT DISTINCT FROM s.row_hash THEN 'keep' ELSE 'update' END AS _action
FROM tgt t FULL OUTER JOIN src s ON t.o_orderkey = s.o_orderkey""")
def q_upsert_changed_only(spark, sf_dir):
    tgt, src = _orders_halves(spark, sf_dir)
    return tables.upsert_changed_only(tgt, src, ["o_orderkey"])


# --------------------------------------------------------------------------- M3: incremental + resume
SQL_INC = """
src_obs AS (
  SELECT md5(concat(code_station, '|', CAST(date_obs_elab AS VARCHAR))) AS row_hash,
         code_station, date_obs_elab AS date, resultat_obs_elab, code_qualification
  FROM obs
),
mart AS (SELECT * FROM src_obs WHERE date < DATE '2001-01-01' AND code_qualification = '20')"""


def _inc_frames(spark, sf_dir):
    from hydromart.functions.codes import identity_hash
    obs = testbed.river_observations(spark, sf_dir)
    src = obs.select(identity_hash("code_station", "date_obs_elab").alias("row_hash"), "code_station",
                     F.col("date_obs_elab").alias("date"), "resultat_obs_elab", "code_qualification")
    # The stored mart predates 2001 and never received the rows flagged '10' (withheld keys).
    mart = src.where((F.col("date") < F.lit("2001-01-01").cast("date")) & (F.col("code_qualification") == "20"))
    return src, mart


@register("incremental_mart", with_ctes(SQL_OBS, SQL_INC) + """
SELECT * FROM src_obs m
WHERE date >= (SELECT max(date) FROM mart) - INTERVAL 35 DAY
   OR NOT EXISTS (SELECT 1 FROM mart t WHERE t.row_hash = m.row_hash)""")
def q_incremental_mart(spark, sf_dir):
    src, mart = _inc_frames(spark, sf_dir)
    return tables.incremental_rows(src, mart, "date", "row_hash", 35)


# Resume windows: customers are the entities, their orders the loaded history.
RESUME_TODAY, RESUME_FLOOR = "2001-08-10", "1995-01-01"
SQL_RESUME = """
last AS (SELECT o_custkey AS c_custkey, max(CAST(o_orderdate AS DATE)) AS last_date FROM orders GROUP BY 1),
plan AS (
  SELECT c.c_custkey, l.last_date,
         CASE WHEN l.last_date IS NULL THEN DATE '1995-01-01'
              ELSE greatest(least(DATE '2001-08-03' - INTERVAL 35 DAY, l.last_date + INTERVAL 1 DAY),
                            DATE '1995-01-01') END::DATE AS start_date,
         DATE '2001-08-03' AS end_date
  FROM (SELECT DISTINCT c_custkey FROM customer WHERE c_custkey IS NOT NULL) c LEFT JOIN last l USING (c_custkey)
)"""


def _resume(spark, sf_dir):
    cust = testbed.table(spark, sf_dir, "customer").select("c_custkey")
    loaded = testbed.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("date"))
    end = vers.resume_end(RESUME_TODAY)
    return vers.resume_plan(cust, loaded, "c_custkey", "date", end, RESUME_FLOOR)


@register("resume_plan", with_ctes(SQL_RESUME) + "SELECT * FROM plan WHERE start_date <= end_date")
def q_resume_plan(spark, sf_dir):
    return _resume(spark, sf_dir)


@register("resume_global", """
WITH a AS (SELECT max(CAST(l_shipdate AS DATE)) AS last_obs FROM lineitem),
     b AS (SELECT max(CAST(o_orderdate AS DATE)) AS last_weather FROM orders)
SELECT last_obs, last_weather, least(last_obs, last_weather) AS last_common,
       least(DATE '2001-08-03' - INTERVAL 35 DAY, least(last_obs, last_weather) + INTERVAL 1 DAY)::DATE
         AS start_date
FROM a CROSS JOIN b""")
def q_resume_global(spark, sf_dir):
    a = vers.global_last_date(testbed.table(spark, sf_dir, "lineitem")
                              .select(F.to_date("l_shipdate").alias("d")), "d").withColumnRenamed("last_date", "last_obs")
    b = vers.global_last_date(testbed.table(spark, sf_dir, "orders")
                              .select(F.to_date("o_orderdate").alias("d")), "d").withColumnRenamed("last_date", "last_weather")
    both = a.withColumn("last_weather", b.scalar()).withColumn("last_common", F.least("last_obs", "last_weather"))
    return both.withColumn("start_date", vers.resume_start("last_common", vers.resume_end(RESUME_TODAY)))


@register("month_chunks", """
WITH w AS (
  SELECT o_orderpriority AS grandeur,
         least(DATE '2001-08-03' - INTERVAL 35 DAY, max(CAST(o_orderdate AS DATE)) + INTERVAL 1 DAY)::DATE AS start_date,
         DATE '2001-08-03' AS end_date
  FROM orders GROUP BY 1
),
m AS (
  SELECT w.*, CAST(unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date),
                                          INTERVAL 1 MONTH)) AS DATE) AS mois
  FROM w
),
ledger AS (SELECT DISTINCT o_orderpriority AS grandeur, CAST(date_trunc('month', o_orderdate) AS DATE) AS mois
           FROM orders WHERE o_orderstatus = 'F')
SELECT grandeur, start_date, end_date, mois, greatest(mois, start_date) AS chunk_start,
       least(last_day(mois), end_date) AS chunk_end
FROM m WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.grandeur = m.grandeur AND l.mois = m.mois)""")
def q_month_chunks(spark, sf_dir):
    o = testbed.table(spark, sf_dir, "orders")
    end = vers.resume_end(RESUME_TODAY)
    win = (o.groupBy(F.col("o_orderpriority").alias("grandeur"))
           .agg(F.max(F.to_date("o_orderdate")).alias("last"))
           .select("grandeur", vers.resume_start("last", end).alias("start_date"), end.alias("end_date")))
    ledger = (o.where(F.col("o_orderstatus") == "F")
              .select(F.col("o_orderpriority").alias("grandeur"), F.trunc("o_orderdate", "MM").alias("mois")))
    return vers.pending_chunks(vers.month_chunks(win), ledger, ["grandeur", "mois"])


# --------------------------------------------------------------------------- M2: staging and dimensions

SQL_KEY = "regexp_replace(lower(strip_accents({x})), '['' -]', '', 'g')"


@register("fuzzy_place_join", f"""
WITH d AS (SELECT doc_id, lang, {SQL_KEY.format(x='text')} AS k FROM documents),
c AS (SELECT k, lang, min(doc_id) AS canonical_id FROM d GROUP BY k, lang)
SELECT d.doc_id, d.lang, c.canonical_id FROM d LEFT JOIN c USING (k, lang)""")
def q_fuzzy_place_join(spark, sf_dir):
    # Whole document texts act as place names and ``lang`` as the department: every text is
    # matched to the canonical (smallest id) text with the same accent-free key. The key is
    # computed once per text and joined through its SHA-256 digest, so the shuffle moves
    # 64-character digests rather than whole texts.
    checkpoint_dir(spark)
    docs = testbed.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.sha2(fc.place_key("text"), 256).alias("name_key")).checkpoint(eager=True)
    seed = docs.groupBy("name_key", "lang").agg(F.min("doc_id").alias("canonical_id"))
    return docs.join(seed, ["name_key", "lang"], "left").select("doc_id", "lang", "canonical_id")


@register("padded_code_join", """
SELECT c.c_custkey, n.code_insee, n.n_name, n.departement
FROM customer c LEFT JOIN (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS code_insee, n_name,
         lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS departement FROM nation) n
ON lpad(trim(CAST(c.c_nationkey AS VARCHAR)), 5, '0') = n.code_insee""")
def q_padded_code_join(spark, sf_dir):
    cust = testbed.table(spark, sf_dir, "customer").select(
        "c_custkey", fc.pad_code("c_nationkey", 5).alias("code_insee"))
    nat = testbed.table(spark, sf_dir, "nation").select(
        fc.pad_code("n_nationkey", 5).alias("code_insee"), "n_name",
        fc.pad_code("n_regionkey", 2).alias("departement"))
    return cust.join(nat, "code_insee", "left").select("c_custkey", "code_insee", "n_name", "departement")


CUTOVER = "1998-01-01"


@register("union_cutover", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice, 'history' AS source
FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01'
UNION ALL
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice, 'daily' AS source
FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1998-01-01'""")
def q_union_cutover(spark, sf_dir):
    o = testbed.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("date"), "o_totalprice")
    hist = o.where(F.col("date") < ft.as_date(CUTOVER)).withColumn("source", F.lit("history"))
    daily = o.where(F.col("date") >= ft.as_date(CUTOVER)).select(
        "date", "o_totalprice", "o_orderkey", F.lit("daily").alias("source"))  # other column order
    return hist.unionByName(daily)


@register("dim_date", """
WITH b AS (SELECT min(CAST(l_shipdate AS DATE)) AS s, max(CAST(l_shipdate AS DATE)) AS e FROM lineitem),
d AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS date FROM b)
SELECT date, CAST(year(date) AS INTEGER) AS annee, CAST(quarter(date) AS INTEGER) AS trimestre,
       CAST(month(date) AS INTEGER) AS mois, CAST(strftime(date, '%U') AS INTEGER) AS semaine,
       CAST(day(date) AS INTEGER) AS jour, CAST(dayofweek(date) + 1 AS INTEGER) AS jour_semaine
FROM d""")
def q_dim_date(spark, sf_dir):
    li = testbed.table(spark, sf_dir, "lineitem")
    bounds = li.agg(F.min(F.to_date("l_shipdate")).alias("start"), F.max(F.to_date("l_shipdate")).alias("end"))
    return marts.dim_date_between(bounds)


@register("dim_commune", """
SELECT DISTINCT lpad(trim(CAST(n.n_nationkey AS VARCHAR)), 5, '0') AS code_insee, n.n_name AS ville,
       lpad(trim(CAST(n.n_regionkey AS VARCHAR)), 2, '0') AS numero_departement, r.r_name AS region,
       42.0 + ((n.n_nationkey * 37) % 900) / 100.0 AS latitude,
       -5.0 + ((n.n_nationkey * 53) % 1300) / 100.0 AS longitude, r.r_name AS departement
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_dim_commune(spark, sf_dir):
    return marts.dim_commune(testbed.commune_seed(spark, sf_dir))


@register("dim_departement", """
SELECT DISTINCT CASE WHEN upper(trim(CAST(n.n_regionkey AS VARCHAR))) IN ('2A', '2B')
                     THEN upper(trim(CAST(n.n_regionkey AS VARCHAR)))
                     ELSE lpad(trim(CAST(n.n_regionkey AS VARCHAR)), 2, '0') END AS code_departement,
       trim(r.r_name) AS departement, trim(r.r_name) AS region
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_dim_departement(spark, sf_dir):
    return marts.dim_departement(testbed.commune_seed(spark, sf_dir))


@register("dim_observed", """
SELECT CAST(s_suppkey AS VARCHAR) AS code_station, s_name AS libelle_station,
       lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS code_commune_station
FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL)""")
def q_dim_observed(spark, sf_dir):
    sup = testbed.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("code_station"), F.col("s_name").alias("libelle_station"),
        fc.pad_code("s_nationkey", 5).alias("code_commune_station"))
    observed = testbed.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("code_station"))
    return marts.dim_station(sup, observed)


@register("sentinel_dates", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN NULL
                        ELSE CAST(o_orderdate AS DATE) END AS date_ouverture
FROM orders""")
def q_sentinel_dates(spark, sf_dir):
    # The sentinel floor is a parameter; on this data 1996-01-01 makes earlier dates sentinels.
    o = testbed.table(spark, sf_dir, "orders")
    return o.select("o_orderkey", ft.sentinel_date("o_orderdate", "1996-01-01").alias("date_ouverture"))


@register("identity_hash", """
SELECT DISTINCT md5(concat(CAST(l_suppkey AS VARCHAR), '|', CAST(CAST(l_shipdate AS DATE) AS VARCHAR), '|', 'HIXnJ'))
         AS row_hash, CAST(l_suppkey AS VARCHAR) AS code_station, CAST(l_shipdate AS DATE) AS date_obs_elab
FROM lineitem""")
def q_identity_hash(spark, sf_dir):
    li = testbed.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("code_station"), F.to_date("l_shipdate").alias("date_obs_elab"))
    return li.select(fc.identity_hash("code_station", F.col("date_obs_elab").cast("string"),
                                      F.lit(staging.RIVER_MEASURE)).alias("row_hash"),
                     "code_station", "date_obs_elab").distinct()


@register("clean_risk_rows", """
SELECT trim(CAST(l.doc_id AS VARCHAR)) AS code_insee, trim(d.lang) AS commune,
       trim(CAST(l.quality AS VARCHAR)) AS classe_frequence
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.doc_id IS NOT NULL AND trim(CAST(l.doc_id AS VARCHAR)) <> ''
  AND trim(CAST(l.doc_id AS VARCHAR)) <> 'Code_INSEE'""")
def q_clean_risk_rows(spark, sf_dir):
    # documents ⟕ labels is a risk file with all-NULL codes for unlabelled documents.
    d = testbed.table(spark, sf_dir, "documents").select("doc_id", "lang")
    lab = testbed.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("l_doc_id"), "quality")
    raw = d.join(lab, d.doc_id == lab.l_doc_id, "left").select(
        F.col("l_doc_id").cast("string").alias("code_insee"), F.col("lang").alias("commune"),
        F.col("quality").cast("string").alias("frequence"))
    return staging.stg_risk_frequency(raw)


# --------------------------------------------------------------------------- M5: geo

SQL_GEO = """
co AS (SELECT CAST(c_custkey AS VARCHAR) AS code_insee,
              42.0 + ((c_custkey * 37) % 900) / 100.0 AS lat, -5.0 + ((c_custkey * 53) % 1300) / 100.0 AS lon
       FROM customer),
st AS (SELECT CAST(s_suppkey AS VARCHAR) AS code_station,
              42.0 + ((s_suppkey * 71) % 900) / 100.0 AS lat, -5.0 + ((s_suppkey * 29) % 1300) / 100.0 AS lon
       FROM supplier),
d AS (
  SELECT co.code_insee, st.code_station,
         2 * 6371008.8 * asin(sqrt(least(1.0,
            pow(sin((radians(st.lat) - radians(co.lat)) / 2), 2)
            + cos(radians(co.lat)) * cos(radians(st.lat)) * pow(sin((radians(st.lon) - radians(co.lon)) / 2), 2))))
           AS distance_m
  FROM co CROSS JOIN st
),
near AS (SELECT DISTINCT code_station FROM d WHERE distance_m <= 15000),
lonely AS (SELECT code_insee FROM co WHERE code_insee NOT IN (SELECT code_insee FROM d WHERE distance_m <= 15000)),
nearest AS (
  SELECT d.code_insee, d.code_station, d.distance_m FROM d JOIN lonely USING (code_insee)
  QUALIFY row_number() OVER (PARTITION BY d.code_insee ORDER BY d.distance_m, d.code_station) = 1
)"""


def _geo_frames(spark, sf_dir):
    co = testbed.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("code_insee"),
        testbed.derived_lat("c_custkey").alias("latitude"), testbed.derived_lon("c_custkey").alias("longitude"))
    st = testbed.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("code_station"),
        testbed.derived_lat("s_suppkey", 71).alias("latitude_station"),
        testbed.derived_lon("s_suppkey", 29).alias("longitude_station"))
    return co, st


@register("radius_join", with_ctes(SQL_GEO) + "SELECT code_station FROM near")
def q_radius_join(spark, sf_dir):
    co, st = _geo_frames(spark, sf_dir)
    return geo.stations_near(co, st)


@register("nearest_fallback", with_ctes(SQL_GEO)
          + "SELECT code_insee, code_station, round(distance_m, 2) AS distance_m FROM nearest")
def q_nearest_fallback(spark, sf_dir):
    co, st = _geo_frames(spark, sf_dir)
    lonely = geo.communes_without_station(co, st)
    return geo.nearest_station(lonely, st, start_level=1).withColumn("distance_m", F.round("distance_m", 2))


@register("relevant_entities", with_ctes(SQL_GEO) + """
SELECT code_station FROM near UNION SELECT code_station FROM nearest""")
def q_relevant_entities(spark, sf_dir):
    co, st = _geo_frames(spark, sf_dir)
    return geo.relevant_stations(co, st)


# --------------------------------------------------------------------------- M4: data quality


@register("dq_not_null", with_ctes(*FEATURE_CHAIN)
          + "SELECT code_station, date FROM features WHERE variation_position_1j IS NULL")
def q_dq_not_null(spark, sf_dir):
    return quality.not_null(build_ml_features(spark, sf_dir), "variation_position_1j").select("code_station", "date")


@register("dq_unique", """
SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL
GROUP BY l_orderkey HAVING count(*) > 1""")
def q_dq_unique(spark, sf_dir):
    return quality.unique(testbed.table(spark, sf_dir, "lineitem").select("l_orderkey"), "l_orderkey")


@register("dq_relationships", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""")
def q_dq_relationships(spark, sf_dir):
    # planted fault: the parent table lacks one market segment
    o = testbed.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = testbed.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "BUILDING").select("c_custkey")
    return quality.relationships(o, c, "o_custkey", "c_custkey")


@register("dq_grain", """
SELECT l_orderkey, l_linenumber, count(*) AS nb_lignes FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_dq_grain(spark, sf_dir):
    li = testbed.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return quality.grain(li, ["l_orderkey", "l_linenumber"])


@register("dq_thresholds_uniform", with_ctes(SQL_OBS, SQL_LIMITS, SQL_GRADES) + """
, spoilt AS (SELECT * REPLACE (CASE WHEN code_qualification = '10' THEN p95 + 1 ELSE p95 END AS p95) FROM graded)
SELECT a.code_station, extract(month FROM a.date_obs_elab)::INTEGER AS mois
FROM spoilt a GROUP BY ALL
HAVING max(p95) > min(p95) OR max(p90) > min(p90) OR max(p99) > min(p99) OR max(n_reference) > min(n_reference)
    OR max(n_annees_reference) > min(n_annees_reference) OR (count(p95) > 0 AND count(p95) < count(*))""")
def q_dq_thresholds_uniform(spark, sf_dir):
    # planted fault: the withheld rows carry another p95
    p95 = F.when(F.col("code_qualification") == "10", F.col("p95") + 1).otherwise(F.col("p95"))
    return quality.thresholds_uniform(fct_hydro(spark, sf_dir).withColumn("p95", p95))


@register("dq_last_date_scorable", with_ctes(*FEATURE_CHAIN) + """
SELECT max(date) AS date FROM features""")
def q_dq_last_date_scorable(spark, sf_dir):
    # planted fault: soil moisture has not arrived for the last day, so none of its rows can be scored
    f = build_ml_features(spark, sf_dir)
    late = F.when(F.col("date") < f.agg(F.max("date")).scalar(), F.col("humidite_sol"))
    return quality.last_date_scorable(f.withColumn("humidite_sol", late))


@register("dq_classifiable", with_ctes(*FEATURE_CHAIN) + """
SELECT f.code_station, f.date FROM features f SEMI JOIN graded g
ON g.code_station = f.code_station AND g.date_obs_elab = f.date AND g.niveau_hydrologique = 'Exceptionnel'""")
def q_dq_classifiable(spark, sf_dir):
    # planted fault: the mart has lost its exceptional days
    mart = fct_hydro(spark, sf_dir).where(~F.col("niveau_hydrologique").eqNullSafe(F.lit("Exceptionnel")))
    return quality.classifiable(build_ml_features(spark, sf_dir), mart)


@register("dq_count_range", """
SELECT n, n BETWEEN 50 AND 2000 AS in_range,
       CASE WHEN NOT (n BETWEEN 50 AND 2000) THEN 'error' WHEN n <> 100 THEN 'warning' ELSE 'ok' END AS status
FROM (SELECT count(DISTINCT CAST(l_suppkey AS VARCHAR)) AS n FROM lineitem)""")
def q_dq_count_range(spark, sf_dir):
    observed = testbed.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("code_station"))
    return quality.count_range(observed, "code_station", 50, 2000, expected=100)


@register("dq_coverage", with_ctes(SQL_OBS) + """
SELECT code_station, count(DISTINCT date_obs_elab) AS n_dates,
       (SELECT date_diff('day', min(date_obs_elab), max(date_obs_elab)) + 1 FROM obs) AS expected
FROM obs GROUP BY code_station
HAVING count(DISTINCT date_obs_elab) < (SELECT date_diff('day', min(date_obs_elab), max(date_obs_elab)) + 1 FROM obs)""")
def q_dq_coverage(spark, sf_dir):
    return quality.coverage(testbed.river_observations(spark, sf_dir), "code_station", "date_obs_elab")


@register("dq_scoring_preconditions", with_ctes(*FEATURE_CHAIN) + """
SELECT 'no rows' AS problem, count(*) AS n FROM features HAVING count(*) = 0
UNION ALL
SELECT 'duplicated keys' AS problem, count(*) AS n FROM features
WHERE date = (SELECT max(date) FROM features) AND depasse_p95_j = 0 HAVING count(*) > 0""")
def q_dq_scoring_preconditions(spark, sf_dir):
    # planted fault: the days below the threshold were delivered twice
    f = build_ml_features(spark, sf_dir)
    return quality.scoring_preconditions(f.unionByName(f.where(F.col("depasse_p95_j") == 0)))


# --------------------------------------------------------------------------- profiles
FEATS = ["position_p95", "variation_position_1j", "pluie_j", "pluie_3j", "humidite_sol"]


@register("null_profile", with_ctes(*FEATURE_CHAIN) + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) - count({c}) AS n_null, count(*) AS n_rows, "
    f"CASE WHEN count(*) = 0 THEN NULL ELSE (count(*) - count({c})) / count(*) END AS null_rate FROM features"
    for c in ["position_p95", "variation_position_1j", "pluie_3j", "target_j1"]))
def q_null_profile(spark, sf_dir):
    return profile.null_profile(build_ml_features(spark, sf_dir),
                                ["position_p95", "variation_position_1j", "pluie_3j", "target_j1"])


@register("class_balance", with_ctes(*FEATURE_CHAIN) + """
SELECT target_j1, count(*) AS n, count(*) / sum(count(*)) OVER () AS share
FROM features WHERE target_j1 IS NOT NULL GROUP BY target_j1""")
def q_class_balance(spark, sf_dir):
    f = build_ml_features(spark, sf_dir).where(F.col("target_j1").isNotNull())
    return profile.class_balance(f, "target_j1")


@register("histogram", with_ctes(*FEATURE_CHAIN) + """
, r AS (SELECT min(position_p95) AS lo, max(position_p95) AS hi FROM features),
b AS (SELECT CAST(CASE WHEN hi = lo THEN 1 ELSE least(floor((position_p95 - lo) / (hi - lo) * 30) + 1, 30) END AS INTEGER) AS bin,
             lo, hi FROM features CROSS JOIN r WHERE position_p95 IS NOT NULL)
SELECT 'position_p95' AS feature, bin, round(lo + (bin - 1) * (hi - lo) / 30, 6) AS lower,
       round(lo + bin * (hi - lo) / 30, 6) AS upper, count(*) AS n
FROM b GROUP BY bin, lo, hi""")
def q_histogram(spark, sf_dir):
    # Binning needs the range first: the features are materialised once (like the stored mart)
    # so the min/max subqueries and the binning pass read that instead of recomputing the chain.
    h = profile.histogram(features_table(spark, sf_dir), "position_p95", 30)
    return h.withColumn("lower", F.round("lower", 6)).withColumn("upper", F.round("upper", 6))


@register("correlation", with_ctes(*FEATURE_CHAIN) + " UNION ALL ".join(
    f"SELECT '{a}' AS x, '{b}' AS y, "
    + (f"round(corr({a}, {b}), 6) AS r" if a != b else f"CASE WHEN count({a}) > 1 THEN 1.0 END AS r")
    + " FROM features" for a in FEATS + ["target_j1"] for b in FEATS + ["target_j1"]))
def q_correlation(spark, sf_dir):
    f = build_ml_features(spark, sf_dir).withColumn("target_j1", F.col("target_j1").cast("double"))
    return profile.correlation(f, FEATS + ["target_j1"]).withColumn("r", F.round("r", 6))


# --------------------------------------------------------------------------- M6: ML
ML_CUTOFF = "2000-01-01"  # the test period of this data (the reference splits at 2023-01-01)


def _report_sql(source: str, by: str = "") -> str:
    """DuckDB statement of the classification report over ``source`` (columns y, p)."""
    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    return f"""
, c AS (SELECT {g}count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
              count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn
       FROM {source} {grp}),
m AS (SELECT {g}tp, fp, fn, tn,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
        CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0
      FROM c),
f AS (SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f11,
              CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f10,
              tp + fn AS s1, tn + fp AS s0, tp + fn + tn + fp AS n FROM m),
rep AS (
  SELECT {g}'0' AS class, p0 AS precision, r0 AS recall, f10 AS f1, s0 AS support FROM f
  UNION ALL SELECT {g}'1', p1, r1, f11, s1 FROM f
  UNION ALL SELECT {g}'accuracy', CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END,
                   CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END, CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END, n FROM f
  UNION ALL SELECT {g}'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f10 + f11) / 2, n FROM f
  UNION ALL SELECT {g}'weighted avg', CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END,
                   CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END,
                   CASE WHEN n = 0 THEN 0.0 ELSE (f10 * s0 + f11 * s1) / n END, n FROM f
)
SELECT {g}class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM rep"""


SQL_TEST = f"""
test AS (SELECT target_j1 AS y, depasse_p95_j AS p, * FROM features
         WHERE target_j1 IS NOT NULL AND date >= DATE '{ML_CUTOFF}')"""
SQL_SPLITS = f"""
splits AS (SELECT target_j1 AS y, depasse_p95_j AS p,
                  CASE WHEN date < DATE '{ML_CUTOFF}' THEN 'train' ELSE 'test' END AS split
           FROM features WHERE target_j1 IS NOT NULL)"""


def _round_report(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in ("precision", "recall", "f1") else F.col(c)
                       for c in df.columns])


def _persistence_split(spark, sf_dir):
    parts = ml.chronological_split(build_ml_features(spark, sf_dir), ML_CUTOFF)
    return {k: ml.persistence(v) for k, v in parts.items()}


@register("persistence_report", with_ctes(*FEATURE_CHAIN, SQL_TEST) + _report_sql("test"))
def q_persistence_report(spark, sf_dir):
    return _round_report(ml.classification_report(_persistence_split(spark, sf_dir)["test"]))


@register("confusion", with_ctes(*FEATURE_CHAIN, SQL_TEST) + """
SELECT CAST(y AS INTEGER) AS label, CAST(p AS INTEGER) AS prediction, count(*) AS n FROM test GROUP BY 1, 2""")
def q_confusion(spark, sf_dir):
    return ml.confusion(_persistence_split(spark, sf_dir)["test"])


@register("new_crossings", with_ctes(*FEATURE_CHAIN, SQL_TEST) + ", newc AS (SELECT * FROM test WHERE depasse_p95_j = 0)"
          + _report_sql("newc"))
def q_new_crossings(spark, sf_dir):
    return _round_report(ml.new_crossings(_persistence_split(spark, sf_dir)["test"]))


@register("train_test_report", with_ctes(*FEATURE_CHAIN, SQL_SPLITS) + _report_sql("splits", "split"))
def q_train_test_report(spark, sf_dir):
    labelled = ml.persistence(build_ml_features(spark, sf_dir).where(F.col("target_j1").isNotNull()))
    return _round_report(ml.split_report(labelled, ML_CUTOFF))


def _fitted(spark, sf_dir, kind="logistic"):
    features = build_ml_features(spark, sf_dir)
    parts = ml.chronological_split(features, ML_CUTOFF)
    return features, parts, ml.fit(parts["train"], kind)


@register("fit_logistic")
def q_fit_logistic(spark, sf_dir):
    _, parts, model = _fitted(spark, sf_dir)
    return ml.predict(model, parts["test"]).select("code_station", "date", "target_j1", "prediction_j1",
                                                   "probabilite_depassement_j1")


@register("fit_forest")
def q_fit_forest(spark, sf_dir):
    _, parts, model = _fitted(spark, sf_dir, "forest")
    return ml.predict(model, parts["test"]).select("code_station", "date", "target_j1", "prediction_j1",
                                                   "probabilite_depassement_j1")


@register("score_latest")
def q_score_latest(spark, sf_dir):
    features, _, model = _fitted(spark, sf_dir)
    return ml.score_latest(model, features, "2001-11-05T06:00:00")


@register("coefficients")
def q_coefficients(spark, sf_dir):
    _, _, model = _fitted(spark, sf_dir)
    return ml.coefficients(model)


# --------------------------------------------------------------------------- M7: landed payloads


def _series_docs(spark, sf_dir):
    """One API-style document per (station, month): parallel daily arrays (at most 31 entries)."""
    day = testbed.station_days(spark, sf_dir).select(
        "code_station", "date_obs_elab", F.col("pluie_totale"),
        # temperature_2m_mean plays the required measure; a qualification other than 20 blanks it.
        F.when(F.col("_min_flag") == "R", F.lit(None).cast("double"))
        .otherwise(F.col("resultat_obs_elab")).alias("temperature_2m_mean"))
    items = F.sort_array(F.collect_list(F.struct(
        F.col("date_obs_elab").cast("string").alias("t"), F.col("temperature_2m_mean").alias("m"),
        F.col("pluie_totale").alias("r"))))
    g = day.groupBy("code_station", F.trunc("date_obs_elab", "MM").alias("mois")).agg(items.alias("it"))
    return g.select("code_station", "mois", F.struct(
        F.col("it.t").alias("time"), F.col("it.m").alias("temperature_2m_mean"),
        F.col("it.r").alias("rain_sum")).alias("daily"))


@register("explode_series", with_ctes(SQL_OBS, SQL_WEATHER) + """
SELECT o.code_station, CAST(date_trunc('month', o.date_obs_elab) AS DATE) AS mois,
       CAST(o.date_obs_elab AS VARCHAR) AS time, o.resultat_obs_elab AS temperature_2m_mean,
       w.pluie_j AS rain_sum
FROM obs o LEFT JOIN rain w ON lpad(o.code_station, 5, '0') = w.code_insee AND o.date_obs_elab = w.date
WHERE o.code_qualification = '20'""")
def q_explode_series(spark, sf_dir):
    return landing.explode_series(_series_docs(spark, sf_dir), ["temperature_2m_mean", "rain_sum"],
                                  ["code_station", "mois"])


def _page_envelopes(spark, sf_dir):
    """One request per (station, month), three pages by ten-day block; page 1 announces the count."""
    from pyspark.sql import Window
    obs = testbed.river_observations(spark, sf_dir)
    req = F.concat_ws("/", "code_station", F.date_format("date_obs_elab", "yyyy-MM"))
    page = F.least(F.floor((F.dayofmonth("date_obs_elab") - 1) / 10) + 1, F.lit(3)).cast("int")
    rec = F.struct("code_station", "date_obs_elab", "resultat_obs_elab")
    pages = obs.groupBy(req.alias("request_id"), page.alias("page")).agg(
        F.sort_array(F.collect_list(rec)).alias("data"))
    total = F.sum(F.size("data")).over(Window.partitionBy("request_id"))  # <= 3 pages per request
    first = F.min("page").over(Window.partitionBy("request_id"))
    return pages.withColumn("count", F.when(F.col("page") == first, total).cast("int"))


@register("explode_pages", with_ctes(SQL_OBS) + """
SELECT code_station || '/' || strftime(date_obs_elab, '%Y-%m') AS request_id,
       CAST(least(floor((day(date_obs_elab) - 1) / 10) + 1, 3) AS INTEGER) AS page,
       code_station, date_obs_elab, resultat_obs_elab
FROM obs""")
def q_explode_pages(spark, sf_dir):
    return landing.explode_pages(_page_envelopes(spark, sf_dir))


# --------------------------------------------------------------------------- M8: streaming


@register("stream_latest_version", ORACLES["latest_version"])
def q_stream_latest_version(spark, sf_dir):
    """STR-02 over ``events`` read as a file stream; the result table must equal the batch one."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-latest-{uuid.uuid4().hex}"
    ev_schema = testbed.table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(ev_schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")  # glob: the stream source lists files
              .select("user_id", F.to_date("ts").alias("date"), "event_type", "event_id", "ts", "value", "props"))
    ingest.run_latest_to_table(spark, stream, EV_KEYS, EV_ORDER, f"{base}/table", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/table").select(*EV_COLS)  # partition column dropped


# --------------------------------------------------------------------------- more staging, profiles, ledger
@register("staging_obs", """
WITH raw AS (
  SELECT ' ' || event_type || ' ' AS code_station, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_obs_elab,
         ' HIXnJ' AS grandeur_hydro_elab, value AS resultat_obs_elab, ts AS date_prod,
         date_trunc('hour', ts) AS inserted_at, md5(CAST(event_id AS VARCHAR)) AS raw_hash
  FROM events
),
latest AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY trim(code_station), TRY_CAST(date_obs_elab AS DATE), trim(grandeur_hydro_elab)
                             ORDER BY inserted_at DESC NULLS LAST, date_prod DESC NULLS LAST, raw_hash DESC NULLS LAST) = 1
)
SELECT md5(concat(trim(code_station), '|', date_obs_elab, '|', trim(grandeur_hydro_elab))) AS row_hash,
       trim(code_station) AS code_station, TRY_CAST(date_obs_elab AS DATE) AS date_obs_elab,
       trim(grandeur_hydro_elab) AS grandeur_hydro_elab, resultat_obs_elab, date_prod, inserted_at
FROM latest""")
def q_staging_obs(spark, sf_dir):
    # events as raw river rows: untrimmed codes, hourly load instants (ties), production time = ts.
    ev = testbed.table(spark, sf_dir, "events")
    raw = ev.select(
        F.lit("site").alias("code_site"), F.concat(F.lit(" "), "event_type", F.lit(" ")).alias("code_station"),
        F.to_date("ts").cast("string").alias("date_obs_elab"), F.col("value").alias("resultat_obs_elab"),
        F.col("ts").alias("date_prod"), F.lit("16").alias("code_statut"), F.lit("").alias("libelle_statut"),
        F.lit("").alias("code_methode"), F.lit("").alias("libelle_methode"), F.lit("20").alias("code_qualification"),
        F.lit("").alias("libelle_qualification"), F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("double").alias("latitude"), F.lit(" HIXnJ").alias("grandeur_hydro_elab"),
        F.md5(F.col("event_id").cast("string")).alias("row_hash"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("inserted_at"), F.lit("b").alias("batch_id"))
    out = staging.stg_obs(raw)
    return out.select("row_hash", "code_station", "date_obs_elab", "grandeur_hydro_elab", "resultat_obs_elab",
                      F.col("date_prod").cast("timestamp_ntz").alias("date_prod"), "inserted_at")


@register("ledger_upsert", """
WITH done AS (
  SELECT o_orderpriority AS grandeur_hydro_elab, CAST(date_trunc('month', o_orderdate) AS DATE) AS mois,
         count(*) AS nb_lignes, TIMESTAMP '2001-08-01 00:00:00' AS termine_le
  FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2
),
fresh AS (
  SELECT o_orderpriority AS grandeur_hydro_elab, CAST(date_trunc('month', o_orderdate) AS DATE) AS mois,
         count(*) AS nb_lignes, TIMESTAMP '2001-08-10 06:00:00' AS termine_le
  FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2
)
SELECT * FROM done d WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.grandeur_hydro_elab = d.grandeur_hydro_elab
                                       AND f.mois = d.mois)
UNION ALL SELECT * FROM fresh""")
def q_ledger_upsert(spark, sf_dir):
    # Ledger of finished (measure, month) chunks: months with fully shipped orders are recorded;
    # a later run records the months holding open or partially shipped ones.
    o = testbed.table(spark, sf_dir, "orders")

    def months(status):
        return (o.where(status)
                .groupBy(F.col("o_orderpriority").alias("grandeur_hydro_elab"),
                         F.trunc("o_orderdate", "MM").alias("mois"))
                .agg(F.count(F.lit(1)).alias("nb_lignes")))
    ledger = months(F.col("o_orderstatus") == "F").withColumn("termine_le", ft.as_timestamp("2001-08-01T00:00:00").cast("timestamp_ntz"))
    new = vers.ledger_upsert(ledger, months(F.col("o_orderstatus") != "F"), "2001-08-10T06:00:00")
    return new.withColumn("termine_le", F.col("termine_le").cast("timestamp_ntz"))


@register("dataset_profile", with_ctes(*FEATURE_CHAIN) + """
SELECT count(*) AS n_rows, 12 AS n_columns, min(date) AS first_date, max(date) AS last_date,
       count(DISTINCT code_station) AS n_entities, count(target_j1) AS n_labelled,
       count(*) - count(target_j1) AS n_unlabelled FROM features""")
def q_dataset_profile(spark, sf_dir):
    return profile.dataset_profile(build_ml_features(spark, sf_dir)).withColumn("n_columns", F.col("n_columns").cast("int"))


@register("coverage_summary", with_ctes(SQL_OBS) + """
, per AS (SELECT code_station, count(DISTINCT date_obs_elab) AS n_dates FROM obs GROUP BY code_station)
SELECT count(*) AS n_entities, min(n_dates) AS min_dates, round(avg(n_dates), 6) AS mean_dates,
       max(n_dates) AS max_dates FROM per""")
def q_coverage_summary(spark, sf_dir):
    s = profile.coverage_summary(testbed.river_observations(spark, sf_dir), "code_station", "date_obs_elab")
    return s.withColumn("mean_dates", F.round("mean_dates", 6))


@register("duplicates_on", """
SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""")
def q_duplicates_on(spark, sf_dir):
    li = testbed.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return profile.duplicates_on(li, ["l_orderkey", "l_linenumber"])


@register("found_crossings", with_ctes(*FEATURE_CHAIN, SQL_TEST) + """
SELECT count(*) FILTER (WHERE p = 1) AS found, count(*) AS total FROM test WHERE depasse_p95_j = 0 AND y = 1""")
def q_found_crossings(spark, sf_dir):
    return ml.found_crossings(_persistence_split(spark, sf_dir)["test"])


@register("spot_check", """
SELECT n.n_name AS Commune, 42.0 + ((n.n_nationkey * 37) % 900) / 100.0 AS Latitude,
       -5.0 + ((n.n_nationkey * 53) % 1300) / 100.0 AS Longitude
FROM nation n WHERE lower(coalesce(n.n_name, '')) IN ('nation_1', 'nation_12', 'nation_24')""")
def q_spot_check(spark, sf_dir):
    names = ["Nation_1", "NATION_12", "nation_24"]  # case-folded lookup parameters
    return profile.spot_check(testbed.commune_seed(spark, sf_dir), "Commune", names, ["Latitude", "Longitude"])


@register("partial_days", with_ctes(SQL_OBS, SQL_WEATHER) + """
SELECT date, count(*) AS n_rows, count(DISTINCT code_insee) AS n_places FROM skies
WHERE pluie_j IS NULL OR pluie_3j IS NULL OR humidite_sol IS NULL GROUP BY date""")
def q_partial_days(spark, sf_dir):
    m = marts.weather_days(testbed.daily_weather(spark, sf_dir))
    return quality.partial_last_day(m, "date", "code_insee", ["pluie_j", "pluie_3j", "humidite_sol"])


@register("feature_freshness", with_ctes(*FEATURE_CHAIN) + """
SELECT (SELECT max(date) FROM features) AS last_features,
       least((SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders))
         AS last_ingested,
       (SELECT max(date) FROM features) <
       least((SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders))
         AS lagging,
       CAST(date_diff('day', (SELECT max(date) FROM features), DATE '2001-11-12') AS INTEGER) AS age_days""")
def q_feature_freshness(spark, sf_dir):
    # river ingestion = ship dates, weather ingestion = order dates; "today" is a parameter
    river = testbed.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"))
    weather = testbed.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"))
    return quality.feature_freshness(build_ml_features(spark, sf_dir), river, weather, today="2001-11-12")


@register("describe_coverage", with_ctes(SQL_OBS) + """
, per AS (SELECT code_station, CAST(count(DISTINCT date_obs_elab) AS DOUBLE) AS n_dates,
                 CAST(max(resultat_obs_elab) AS DOUBLE) AS top_value FROM obs GROUP BY code_station)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"min({c}) AS min, quantile_disc({c}, 0.25) AS p25, quantile_disc({c}, 0.5) AS p50, "
    f"quantile_disc({c}, 0.75) AS p75, max({c}) AS max FROM per" for c in ("n_dates", "top_value")))
def q_describe_coverage(spark, sf_dir):
    # distinct observed days per station (the EDA coverage table) and each station's top value
    per = testbed.river_observations(spark, sf_dir).groupBy("code_station").agg(
        F.count_distinct("date_obs_elab").cast("double").alias("n_dates"),
        F.max("resultat_obs_elab").alias("top_value"))
    d = profile.describe(per, ["n_dates", "top_value"])
    return d.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


@register("resume_groups", with_ctes(SQL_RESUME) + """
SELECT start_date, end_date, count(c_custkey) AS n_entities FROM plan
WHERE start_date <= end_date GROUP BY start_date, end_date""")
def q_resume_groups(spark, sf_dir):
    return vers.resume_groups(_resume(spark, sf_dir), "c_custkey")


@register("thresholds_past_only", with_ctes(SQL_OBS) + f"""
SELECT code_station, CAST(month(date_obs_elab) AS INTEGER) AS mois,
       quantile_disc(resultat_obs_elab, 0.90) AS p90, quantile_disc(resultat_obs_elab, 0.95) AS p95,
       quantile_disc(resultat_obs_elab, 0.99) AS p99, count(*) AS n_reference,
       count(DISTINCT year(date_obs_elab)) AS n_annees_reference
FROM obs
WHERE code_qualification = '20' AND code_statut IN ('12', '16') AND resultat_obs_elab IS NOT NULL
  AND date_obs_elab < DATE '{ML_CUTOFF}'
GROUP BY code_station, month(date_obs_elab)""")
def q_thresholds_past_only(spark, sf_dir):
    # ML-15: thresholds from the training period only, so test labels do not leak into them
    return th.monthly_thresholds(testbed.river_observations(spark, sf_dir), before=ML_CUTOFF)


@register("reliability")
def q_reliability(spark, sf_dir):
    # ML-15: calibration of the logistic model on the test period (rows-only: fitted model)
    _, parts, model = _fitted(spark, sf_dir)
    return ml.reliability_bins(ml.predict(model, parts["test"]))


# --------------------------------------------------------------------------- planted faults, fitted parts
@register("level_class_join", ORACLES["level_class"])
def q_level_class_join(spark, sf_dir):
    """JN-03 through the aggregate and the join, equal to the in-place class."""
    obs = testbed.river_observations(spark, sf_dir)
    return th.classify_observations(obs, th.monthly_thresholds(obs)).select(*q_level_class(spark, sf_dir).columns)


@register("series_rejects", with_ctes(SQL_OBS) + """
SELECT code_station, CAST(date_trunc('month', date_obs_elab) AS DATE) AS mois,
       CASE WHEN month(date_obs_elab) = 6 THEN 'length rain_sum' ELSE 'missing rain_sum' END AS problem
FROM obs WHERE month(date_obs_elab) IN (1, 6) GROUP BY ALL""")
def q_series_rejects(spark, sf_dir):
    # planted faults: June documents have a rain value too many, January ones no rain at all
    daily = F.col("daily")
    rain = (F.when(F.month("mois") == 6, F.concat(daily["rain_sum"], F.array(F.lit(0.0).cast("double"))))
            .when(F.month("mois") != 1, daily["rain_sum"]))
    docs = _series_docs(spark, sf_dir).withColumn("daily", daily.withField("rain_sum", rain))
    rejected = landing.split_series(docs, ["temperature_2m_mean", "rain_sum"])["rejected"]
    return rejected.select("code_station", "mois", F.explode("problems").alias("problem"))


@register("page_rejects", with_ctes(SQL_OBS) + """
SELECT code_station || '/' || strftime(date_obs_elab, '%Y-%m') AS request_id,
       CAST(count(*) + 1 AS INTEGER) AS announced, count(*) AS received
FROM obs WHERE month(date_obs_elab) = 2 GROUP BY ALL""")
def q_page_rejects(spark, sf_dir):
    # planted fault: February requests announce one record more than arrives
    more = F.when(F.col("request_id").endswith("-02"), F.col("count") + 1).otherwise(F.col("count"))
    return landing.page_problems(_page_envelopes(spark, sf_dir).withColumn("count", more))


@register("incremental_merge", with_ctes(SQL_OBS) + """
SELECT md5(concat(code_station, '|', CASE WHEN code_qualification = '20' THEN CAST(date_obs_elab AS VARCHAR) ELSE '' END)) AS row_hash,
       code_station, date_obs_elab AS date, resultat_obs_elab, code_qualification
FROM obs""")
def q_incremental_merge(spark, sf_dir):
    # withheld rows lose their date, so that many share one identity; nothing may be lost or multiplied
    src, _ = _inc_frames(spark, sf_dir)
    known = F.when(F.col("code_qualification") == "20", F.col("date").cast("string"))
    src = src.withColumn("row_hash", fc.identity_hash("code_station", known, null_as_empty=True))
    mart = src.where((F.col("date") < F.lit("2001-01-01").cast("date")) & (F.col("code_qualification") == "20"))
    return tables.incremental_merge(src, mart, "date", "row_hash", 35)


@register("upsert_null_keys", with_ctes(SQL_ORD) + """
, t AS (SELECT * REPLACE (CASE WHEN o_totalprice >= 20000 THEN o_orderkey END AS o_orderkey) FROM tgt),
s AS (SELECT * REPLACE (CASE WHEN o_totalprice >= 20000 THEN o_orderkey END AS o_orderkey) FROM src)
SELECT t.*, 'keep' AS _action FROM t LEFT JOIN s USING (o_orderkey) WHERE s.row_hash IS NULL OR s.row_hash = t.row_hash
UNION ALL SELECT s.*, 'insert' FROM s LEFT JOIN t USING (o_orderkey) WHERE t.row_hash IS NULL
UNION ALL SELECT s.*, 'update' FROM s JOIN t USING (o_orderkey) WHERE t.row_hash <> s.row_hash""")
def q_upsert_null_keys(spark, sf_dir):
    # planted fault: cheap orders have lost their key
    tgt, src = [df.withColumn("o_orderkey", F.when(F.col("o_totalprice") >= 20000, F.col("o_orderkey")))
                for df in _orders_halves(spark, sf_dir)]
    return tables.upsert_changed_only(tgt, src, ["o_orderkey"])


@register("class_weights", with_ctes(*FEATURE_CHAIN) + f"""
, train AS (SELECT target_j1 FROM features WHERE target_j1 IS NOT NULL AND date < DATE '{ML_CUTOFF}')
SELECT target_j1, count(*) AS n, round((SELECT count(*) FROM train) / ((SELECT count(DISTINCT target_j1) FROM train) * count(*)), 6) AS weight
FROM train GROUP BY target_j1""")
def q_class_weights(spark, sf_dir):
    train = ml.chronological_split(build_ml_features(spark, sf_dir), ML_CUTOFF)["train"]
    return (ml.balanced_weights(train).groupBy("target_j1")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.max("weight"), 6).alias("weight")))


@register("train_medians", with_ctes(*FEATURE_CHAIN) + "SELECT " + ", ".join(
    f"quantile_disc({c}, 0.5)::DOUBLE AS {c}" for c in FEATS)
    + f" FROM features WHERE target_j1 IS NOT NULL AND date < DATE '{ML_CUTOFF}'")
def q_train_medians(spark, sf_dir):
    # the imputation values that the fitted pipelines learn; without training rows there are none
    train = ml.chronological_split(features_table(spark, sf_dir), ML_CUTOFF)["train"]
    if train.isEmpty():
        return spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in FEATS])
    return ml.logistic_pipeline().getStages()[0].fit(train).surrogateDF.select(*FEATS)


from hydromart.plans import catalog_stored  # noqa: E402, F401  (registers the queries over stored tables)
