"""Append-only versioned raw tables (VER-01..VER-13).

A raw table keeps every content version of a business key plus ``row_hash`` (content
digest), ``inserted_at`` (one instant per load) and ``batch_id``. Loading a batch appends only
the rows whose content differs from the *current* version of their key, so A -> B -> A keeps
three versions while a replay appends nothing.

Plan shape of a load: normalise keys (narrow) -> in-batch conflict check (one aggregate on
the key) -> current version of the touched keys (semi-join + one aggregate on the key) ->
left join -> append. Latest-version selection is a grouped ``max_by`` rather than a window:
it aggregates map-side, so a key with a huge number of versions costs one small buffer per
task instead of one sorted partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydromart.functions.codes import clean
from hydromart.functions.temporal import as_date, as_timestamp
from hydromart.session import checkpoint_dir

TECH_COLUMNS = ("row_hash", "inserted_at", "batch_id")

# Revision window and hold-back of the sources (days).
REVISION_DAYS = 35
HOLD_BACK_DAYS = 7


# ----------------------------------------------------------------------------- VER-01 / 02
def content_hash(columns: Sequence[str]) -> Column:
    """VER-01: SHA-256 of the JSON object of the content columns, keys sorted, NULLs kept."""
    cols = sorted(columns)
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}), 256)


def enrich_batch(batch: DataFrame, batch_id: str, inserted_at=None,
                 content: Sequence[str] | None = None) -> DataFrame:
    """VER-02: add ``row_hash`` (of the content columns, before technical ones), one common
    ``inserted_at`` for the whole load and ``batch_id``."""
    cols = [c for c in (content or batch.columns) if c not in TECH_COLUMNS]
    return batch.withColumns({
        "row_hash": content_hash(cols),
        "inserted_at": as_timestamp(inserted_at),
        "batch_id": F.lit(batch_id),
    })


# ----------------------------------------------------------------------------- VER-03
def iso_date(date: str) -> Column:
    """The date in the first 10 characters; a partial date (``2026-10``, ``2026``) is no date."""
    text = F.substring(clean(date), 1, 10)
    return F.when(text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), text.try_cast("date"))


def normalise_keys(df: DataFrame, entity: str, date: str, others: Sequence[str] = (),
                   entity_width: int | None = 5, prefix: str | None = None) -> dict[str, DataFrame]:
    """VER-03: trimmed keys, ISO date from the first 10 characters, entity left-padded.

    Returns ``{"valid": rows with normalised keys, "rejected": rows with a ``reason``}``.
    Reasons: missing key part, unparsable date, entity longer than ``entity_width``.
    With ``prefix`` the normalised keys are added as ``prefix + name`` and the stored values
    are left as received (the content hash covers them as received).
    """
    e, d = clean(entity), iso_date(date)
    reasons = [F.when(F.col(c).isNull() | (clean(c) == ""), F.lit(f"missing {c}"))
               for c in (entity, date, *others)]
    reasons.append(F.when(clean(date) != "", F.when(d.isNull(), F.lit(f"invalid {date}"))))
    if entity_width:
        reasons.append(F.when(F.length(e) > entity_width, F.lit(f"{entity} too long")))
    tagged = df.withColumn("_reason", F.coalesce(*reasons))
    norm = {entity: F.lpad(e, entity_width, "0") if entity_width else e, date: d}
    norm.update({c: clean(c) for c in others})
    if prefix:
        norm = {f"{prefix}{k}": v for k, v in norm.items()}
    valid = tagged.where(F.col("_reason").isNull()).drop("_reason").withColumns(norm)
    rejected = tagged.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return {"valid": valid, "rejected": rejected}


def key_expressions(entity: str, date: str, others: Sequence[str] = (), entity_width: int | None = 5,
                    prefix: str = "_k_") -> dict[str, Column]:
    """The same normalisation as ``normalise_keys``, for reading keys back from a raw table."""
    out = {f"{prefix}{entity}": F.lpad(clean(entity), entity_width, "0") if entity_width else clean(entity),
           f"{prefix}{date}": iso_date(date)}
    out.update({f"{prefix}{c}": clean(c) for c in others})
    return out


# ----------------------------------------------------------------------------- VER-04
def batch_conflicts(batch: DataFrame, keys: Sequence[str], hash_col: str = "row_hash") -> DataFrame:
    """VER-04: keys that arrive with more than one content in the same batch, with the number
    of distinct contents (runs on the incoming batch only)."""
    return (batch.groupBy(*keys)
            .agg(F.count_distinct(hash_col).alias("n_versions"), F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_versions") > 1))


def dedupe_batch(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """VER-04: identical duplicates collapse to one row (call after ``batch_conflicts`` is empty)."""
    return batch.dropDuplicates(list(keys))


# ----------------------------------------------------------------------------- VER-05 / 07
def latest_versions(raw: DataFrame, keys: Sequence[str] | Mapping[str, Column],
                    order: Sequence[str]) -> DataFrame:
    """WN-01 / VER-07: the current row per key, ``order`` columns descending, NULLs last.

    ``keys`` may map output names to normalising expressions (e.g. trimmed code, safe-cast
    date); the other columns are returned as stored. Implemented as ``max_by`` over a struct
    ordering: struct comparison ranks NULL fields lowest, i.e. ``DESC NULLS LAST``.
    """
    key_exprs = dict(keys) if isinstance(keys, Mapping) else {k: F.col(k) for k in keys}
    others = [c for c in raw.columns if c not in key_exprs]
    row = F.struct(*[F.col(c) for c in others])
    rank = F.struct(*[F.col(c) for c in order])
    picked = (raw.groupBy(*[e.alias(k) for k, e in key_exprs.items()])
              .agg(F.max_by(row, rank).alias("_row")))
    return picked.select(*key_exprs, *[F.col("_row")[c].alias(c) for c in others])


def current_for_batch(raw: DataFrame, batch: DataFrame, keys: Sequence[str],
                      order: Sequence[str], key_exprs: Mapping[str, Column] | None = None) -> DataFrame:
    """VER-05: current version of the keys touched by ``batch``.

    Restricted to the batch's keys (a semi-join; with a date-partitioned raw table the date
    bound also prunes partitions at runtime), never to the batch's hashes, so a return to an
    older content is still detected as a change.
    """
    exprs = key_exprs or {k: F.col(k) for k in keys}
    normed = raw.select(*[e.alias(f"_k_{k}") for k, e in exprs.items()], *raw.columns)
    touched = batch.select(*[F.col(k).alias(f"_k_{k}") for k in keys]).distinct()
    scoped = normed.join(touched, [f"_k_{k}" for k in keys], "left_semi")
    cur = latest_versions(scoped, [f"_k_{k}" for k in keys], order)
    return cur.select(*[F.col(f"_k_{k}").alias(k) for k in keys],
                      *[c for c in cur.columns if not c.startswith("_k_") and c not in keys])


# ----------------------------------------------------------------------------- VER-06
def changed_rows(batch: DataFrame, current: DataFrame, keys: Sequence[str],
                 hash_col: str = "row_hash") -> DataFrame:
    """VER-06: batch rows whose hash differs from the current one (new key or NULL old hash too)."""
    cur = current.select(*keys, F.col(hash_col).alias("_cur_hash"))
    return (batch.join(cur, list(keys), "left")
            .where(~F.col(hash_col).eqNullSafe(F.col("_cur_hash")))
            .drop("_cur_hash"))


def plan_load(raw: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str],
              key_exprs: Mapping[str, Column] | None = None) -> dict[str, DataFrame]:
    """The whole versioned load as lazy DataFrames (VER-04..06).

    ``batch`` must already be enriched (VER-02) and key-normalised (VER-03). Returns
    ``conflicts`` (must be empty before writing) and ``to_append``.
    """
    conflicts = batch_conflicts(batch, keys)
    deduped = dedupe_batch(batch, keys)
    current = current_for_batch(raw, deduped, keys, order, key_exprs)
    return {"conflicts": conflicts, "to_append": changed_rows(deduped, current, keys)}


def version_changes(raw: DataFrame, keys: Sequence[str], order: Sequence[str], content: str,
                    chunks: int | None = None) -> DataFrame:
    """Rows whose content differs from the previous version of the same key (A->B->A counts 3).

    History replay of VER-06 (``lag`` over a key's versions in load order, NULL-safe compare),
    computed so that no key has to fit in one task:

    1. range-partition by (key, load order): a key with very many versions spans several
       partitions (chunks); ``lag`` runs inside each (key, chunk). The chunks come from sampled
       bounds, so they are written once (reliable checkpoint) before anything branches off;
    2. a boundary table with one row per (key, chunk) -- its last content -- gives each chunk's
       first row the last content of the preceding chunk of the same key.

    ``order`` columns sort ascending with NULLs first (the oldest load first).
    """
    spark = raw.sparkSession
    n = chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ords = [F.col(c).asc_nulls_first() for c in order]
    chunked = raw.repartitionByRange(n, *[F.col(k) for k in keys], *ords).withColumn("_chunk", F.spark_partition_id())
    checkpoint_dir(spark)
    chunked = chunked.checkpoint(eager=True)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*ords)
    local = chunked.withColumns({"_prev": F.lag(content).over(w), "_first": F.row_number().over(w) == 1})
    rank = F.struct(*[F.col(c) for c in order])
    ends = local.groupBy(*keys, "_chunk").agg(F.max_by(F.col(content), rank).alias("_last"))
    wc = Window.partitionBy(*keys).orderBy("_chunk")  # at most one row per chunk of a key
    bounds = ends.select(*keys, "_chunk", F.lag("_last").over(wc).alias("_prev_chunk_last"),
                         F.lag(F.lit(True)).over(wc).alias("_has_prev_chunk"))
    heads = local.where("_first").join(bounds, [*keys, "_chunk"], "left")
    head_keep = ~F.coalesce(F.col("_has_prev_chunk"), F.lit(False)) | \
        ~F.col(content).eqNullSafe(F.col("_prev_chunk_last"))
    body = local.where(~F.col("_first") & ~F.col(content).eqNullSafe(F.col("_prev")))
    cols = raw.columns
    return body.select(*cols).unionByName(heads.where(head_keep).select(*cols))


# ----------------------------------------------------------------------------- VER-08..13
def resume_start(last: Column | str | None, end, revision_days: int = REVISION_DAYS) -> Column:
    """VER-08: ``min(end - revision, last + 1)``; ``end - revision`` when there is no last date."""
    end_c = as_date(end)
    rev = F.date_sub(end_c, revision_days)
    if last is None:
        return rev
    last_c = F.col(last) if isinstance(last, str) else last
    return F.least(rev, F.date_add(last_c, 1))


def resume_end(today=None, hold_back_days: int = HOLD_BACK_DAYS) -> Column:
    """VER-08: the last consolidated day, ``today - hold_back``."""
    return F.date_sub(as_date(today), hold_back_days)


def resume_plan(entities: DataFrame, loaded: DataFrame, entity: str, date: str, end, floor,
                revision_days: int = REVISION_DAYS) -> DataFrame:
    """VER-09: per-entity start date; entities without data start at ``floor``.

    ``entities`` ⟕ ``max(date)`` per entity (JN-07), start = ``max(min(end - rev, last + 1), floor)``,
    NULL entities and empty windows (start > end) dropped. Output: (entity, last_date, start, end).
    """
    last = loaded.groupBy(entity).agg(F.max(date).alias("last_date"))
    ents = entities.select(entity).where(F.col(entity).isNotNull()).distinct()
    end_c, floor_c = as_date(end), as_date(floor)
    start = F.greatest(F.coalesce(resume_start("last_date", end_c, revision_days), floor_c), floor_c)
    return (ents.join(last, entity, "left")
            .select(entity, "last_date", F.when(F.col("last_date").isNull(), floor_c)
                    .otherwise(start).alias("start_date"), end_c.alias("end_date"))
            .where(F.col("start_date") <= F.col("end_date")))


def legacy_resume_start(last: Column | str, floor, revision_days: int = REVISION_DAYS) -> Column:
    """VER-13: older rule ``max(last - revision, floor)`` (``floor`` when no last date)."""
    last_c = F.col(last) if isinstance(last, str) else last
    return F.coalesce(F.greatest(F.date_sub(last_c, revision_days), as_date(floor)), as_date(floor))


def global_last_date(df: DataFrame, date: str, where: Column | None = None) -> DataFrame:
    """VER-10 / AG-03: one-row frame with the latest date (optionally for one measure)."""
    src = df.where(where) if where is not None else df
    return src.agg(F.max(date).alias("last_date"))


def month_chunks(windows: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """VER-11: split ``[start, end]`` into calendar months; the last chunk is cut at ``end``."""
    months = F.explode(F.sequence(F.trunc(F.col(start), "MM"), F.trunc(F.col(end), "MM"),
                                  F.expr("INTERVAL 1 MONTH")))
    out = windows.select("*", months.alias("mois"))
    return out.select(*windows.columns, "mois",
                      F.greatest(F.col("mois"), F.col(start)).alias("chunk_start"),
                      F.least(F.last_day("mois"), F.col(end)).alias("chunk_end"))


def pending_chunks(chunks: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("mois",)) -> DataFrame:
    """VER-11: skip months already recorded as finished in the ledger."""
    return chunks.join(ledger.select(*keys).distinct(), list(keys), "left_anti")


# ----------------------------------------------------------------------------- whole load
class LoadRejected(ValueError):
    """The batch has invalid keys or contradictory versions; nothing was written."""


# Business keys and tie order of the two raw sources.
SOURCES = {
    "weather": {"entity": "code_INSEE", "date": "date", "others": (), "width": 5,
                "order": ("inserted_at", "row_hash")},
    "river": {"entity": "code_station", "date": "date_obs_elab", "others": ("grandeur_hydro_elab",),
              "width": None, "order": ("inserted_at", "date_prod", "row_hash")},
}


def load_versioned(spark, path: str, batch: DataFrame, source: str, batch_id: str, inserted_at=None,
                   content: Sequence[str] | None = None, partition_by: Sequence[str] = ()) -> int:
    """Entry point B: append the changed versions of ``batch`` to the raw table at ``path``.

    Empty batch -> 0 without touching the table. Invalid keys or two contents for one key ->
    ``LoadRejected`` before any write. Returns the number of rows appended.
    """
    from hydromart.operators.tables import append, table_exists

    if source not in SOURCES:
        raise LoadRejected(f"unsupported raw source: {source}")
    if batch.isEmpty():
        return 0
    cfg = SOURCES[source]
    ent, dat, oth, width = cfg["entity"], cfg["date"], cfg["others"], cfg["width"]
    checkpoint_dir(spark)
    # dealt out by key first: a load of one large file (one row group) would otherwise go through one task at every step
    spread = batch.repartition(*[F.col(c) for c in (ent, dat, *oth)])
    enriched = enrich_batch(spread, batch_id, inserted_at, content).checkpoint(eager=True)  # parsed once per load
    norm = normalise_keys(enriched, ent, dat, oth, width, prefix="_k_")
    if not norm["rejected"].isEmpty():
        raise LoadRejected("invalid business keys in batch " + batch_id)
    keys = [f"_k_{c}" for c in (ent, dat, *oth)]
    valid = norm["valid"]
    if not batch_conflicts(valid, keys).isEmpty():
        raise LoadRejected("contradictory versions in batch " + batch_id)
    deduped = dedupe_batch(valid, keys)
    if "mois" in partition_by:
        deduped = deduped.withColumn("mois", F.date_format(f"_k_{dat}", "yyyy-MM"))
    if table_exists(spark, path):
        raw = spark.read.parquet(path)
        # The batch's date range (two scalars, like the reference's query parameters) prunes
        # month partitions and lets Parquet skip row groups before the version lookup.
        lo, hi = deduped.agg(F.min(f"_k_{dat}"), F.max(f"_k_{dat}")).first()
        if "mois" in raw.columns:
            raw = raw.where(F.col("mois").between(lo.strftime("%Y-%m"), hi.strftime("%Y-%m")))
        if dict(raw.dtypes).get(dat) == "date":
            raw = raw.where(F.col(dat).between(F.lit(lo), F.lit(hi)))
        exprs = key_expressions(ent, dat, oth, width)
        scoped = raw.select(*[e.alias(k) for k, e in exprs.items()], *raw.columns)
        touched = deduped.select(*keys).distinct()
        current = latest_versions(scoped.join(touched, keys, "left_semi"), keys, list(cfg["order"]))
        new_rows = changed_rows(deduped, current.select(*keys, "row_hash"), keys)
    else:
        new_rows = deduped
    stored = new_rows.withColumn(dat, F.col(f"_k_{dat}")).drop(*keys)
    checkpoint_dir(spark)
    stable = stored.checkpoint(eager=True)
    n = stable.count()
    if n:
        append(stable, path, partition_by)
    return n


def ledger_upsert(ledger: DataFrame, finished: DataFrame, finished_at=None) -> DataFrame:
    """VER-12: record finished (measure, month) chunks with their row counts and time.

    ``finished`` has (grandeur_hydro_elab, mois, nb_lignes); the result is the new ledger
    (SNK-03 on the two keys).
    """
    from hydromart.operators.tables import upsert
    stamped = finished.select("grandeur_hydro_elab", "mois", F.col("nb_lignes").cast("long"),
                              as_timestamp(finished_at).alias("termine_le"))
    return upsert(ledger.select(*stamped.columns), stamped, ["grandeur_hydro_elab", "mois"])


def resume_groups(plan: DataFrame, entity: str) -> DataFrame:
    """VER-09: entities sharing a start date can be fetched together; one row per window with
    the number of entities (a count, not a list: a window may hold every entity)."""
    return plan.groupBy("start_date", "end_date").agg(F.count(entity).alias("n_entities"))
