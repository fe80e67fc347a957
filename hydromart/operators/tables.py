"""Table maintenance on Parquet: append, replace, upsert, change-only upsert, rollback,
incremental marts (SNK-01..SNK-10).

The merge operators are pure ``DataFrame -> DataFrame`` functions that return the new table
content (or only the touched partitions); ``write_table`` persists it. Rewriting a path that the
plan is still reading is unsafe in Spark, so a whole-table write goes beside the table and is
swapped in by renames; with ``partitionOverwriteMode=dynamic`` only the partitions present in the
new content are replaced, which is how a MERGE limited to a few months is expressed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hydromart.functions.temporal import as_timestamp


class EmptyInputError(RuntimeError):
    """A full replace refused an empty input (it would wipe the table)."""


# ----------------------------------------------------------------------------- SNK-01/02/06/08
def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """SNK-01: append rows (files added; existing files untouched)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def replace(df: DataFrame, path: str, partition_by: Sequence[str] = (), allow_empty: bool = False,
            sort_by: Sequence[str] = ()) -> None:
    """SNK-02: full replace; refuses an empty input unless ``allow_empty``."""
    write_table(df, path, partition_by, dynamic=False, sort_by=sort_by, allow_empty=allow_empty)


def _laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """SNK-06 layout: clustered by partition columns, sorted by ``sort_by`` inside each file.

    Range partitioning on (partition columns, sort columns, row hash): a month holding a third of
    the data is split over many balanced tasks (the deterministic row hash breaks ties between
    identical keys), while each task still covers a contiguous key range and writes few files per
    table partition.
    """
    if partition_by:
        row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
        df = df.repartitionByRange(*[F.col(c) for c in (*partition_by, *sort_by)], row_hash)
        return df.sortWithinPartitions(*partition_by, *sort_by)
    return df.sortWithinPartitions(*sort_by) if sort_by else df


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), dynamic: bool = True,
                sort_by: Sequence[str] = (), allow_empty: bool = True) -> None:
    """Persist the new content of a table that may be read by ``df``'s own plan, in one evaluation.

    Partitioned with ``dynamic``: Spark stages the files and swaps the touched partitions when the
    job commits. Otherwise the new version is written beside the table (``path`` + ``.next``), and
    only a complete one is swapped in by renames, so a failure while writing leaves the old table
    as it was; ``recover_table`` finishes a swap that was cut short.
    """
    spark = df.sparkSession
    out = _laid_out(df, partition_by, sort_by).write.mode("overwrite").format("parquet")
    if partition_by:
        out = out.partitionBy(*partition_by)
    if partition_by and dynamic:
        out.option("partitionOverwriteMode", "dynamic").save(path)
        return
    path = path.rstrip("/")
    recover_table(spark, path)
    out.option("partitionOverwriteMode", "static").save(f"{path}.next")
    if not allow_empty and spark.read.schema(df.schema).parquet(f"{path}.next").isEmpty():
        jvm, fs = _files(spark, path)
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}.next"), True)
        raise EmptyInputError(f"refusing to replace {path} with an empty result")
    _swap(spark, path)


def _swap(spark: SparkSession, path: str) -> None:
    jvm, fs = _files(spark, path)
    old, new, live = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.last", f"{path}.next", path))
    if fs.exists(live):
        fs.delete(old, True)
        if not fs.rename(live, old):
            raise OSError(f"cannot set {path} aside")
    if not fs.rename(new, live):
        raise OSError(f"cannot put the new version of {path} in place")
    fs.delete(old, True)


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish or undo a replace that stopped half-way: a complete new version goes in, an
    incomplete one goes away, and a table that was set aside comes back."""
    jvm, fs = _files(spark, path)
    old, new, live = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.last", f"{path}.next", path))
    if fs.exists(new):
        if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}.next/_SUCCESS")) and not fs.exists(live):
            _swap(spark, path)
            return
        fs.delete(new, True)
    if fs.exists(old):
        if fs.exists(live):
            fs.delete(old, True)
        elif not fs.rename(old, live):
            raise OSError(f"cannot bring back {path}")


def append_csv_with_header(df: DataFrame, path: str, sep: str = ",") -> None:
    """SNK-08: append CSV files, each written with its header line."""
    df.write.mode("append").option("header", True).option("sep", sep).csv(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """False when nothing is stored at ``path`` yet; an unreadable table is an error, not "no table".

    Only where the table is missing, a swap that was cut short is finished first. What stands beside
    a table that is there is left alone: another writer may be filling it.
    """
    jvm, fs = _files(spark, path)
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(path)):
        recover_table(spark, path.rstrip("/"))
    try:
        spark.read.parquet(path).schema
        return True
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


# ----------------------------------------------------------------------------- SNK-07
def add_missing_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """SNK-07: add the schema's absent columns as typed NULLs (old files lacking new columns)."""
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(missing) if missing else df


def _in_scope(target: DataFrame, source: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Target rows of the partitions that the source touches; the NULL partition is one of them."""
    touched = source.select(*[F.col(c).alias(f"_scope_{c}") for c in scope]).distinct()
    same = F.lit(True)
    for c in scope:
        same = same & F.col(c).eqNullSafe(F.col(f"_scope_{c}"))
    return target.join(touched, same, "left_semi")


# ----------------------------------------------------------------------------- SNK-03
def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """SNK-03: MERGE on ``keys``: matched target rows take the source row, the rest is inserted.

    ``target ⟕anti source ∪ source`` -- one shuffle on the keys (or a broadcast of the
    source when AQE finds it small). ``source`` must be unique on ``keys``. With ``scope``
    (partition columns) only the target partitions present in the source are read and
    returned, for a dynamic partition overwrite: the MERGE touches what it changes, not the
    whole table.
    """
    if scope:
        target = _in_scope(target, source, scope)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.unionByName(source.select(*target.columns), allowMissingColumns=False)


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-03 counts: one row (inserted, updated) computed by one left join + conditional counts."""
    t = target.select(*keys).distinct().withColumn("_hit", F.lit(True))
    s = source.select(*keys).join(t, list(keys), "left")
    return s.agg(F.count_if(F.col("_hit").isNull()).alias("inserted"),
                 F.count_if(F.col("_hit")).alias("updated"))


# ----------------------------------------------------------------------------- SNK-04
def upsert_changed_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        hash_col: str = "row_hash", scope: Sequence[str] = ()) -> DataFrame:
    """SNK-04: MERGE that rewrites a matched row only when ``t.hash IS DISTINCT FROM s.hash``.

    ``scope`` (e.g. ``["mois"]``) limits the target to the partitions present in the source,
    the MERGE partition predicate; the result then holds only those partitions and is meant
    for a dynamic partition overwrite. Returns rows with ``_action`` in
    {'keep', 'insert', 'update'}.
    """
    if scope:
        target = _in_scope(target, source, scope)
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in target.columns], F.lit(True).alias("_t_here"))
    s = source.select(*target.columns, F.lit(True).alias("_s_here"))
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"_t_{k}")
        cond = c if cond is None else cond & c
    j = t.join(s, cond, "full_outer")
    # a NULL key matches nothing: such a source row is inserted, such a target row is kept
    src_present, tgt_present = F.col("_s_here").isNotNull(), F.col("_t_here").isNotNull()
    same = F.col(hash_col).eqNullSafe(F.col(f"_t_{hash_col}"))
    action = (F.when(~src_present, F.lit("keep"))
              .when(~tgt_present, F.lit("insert"))
              .when(same, F.lit("keep"))
              .otherwise(F.lit("update")))
    take_source = action.isin("insert", "update")
    return j.select(*[F.when(take_source, F.col(c)).otherwise(F.col(f"_t_{c}")).alias(c)
                      for c in target.columns], action.alias("_action"))


# ----------------------------------------------------------------------------- SNK-05
def _of_load(batch_id: str, batch_col: str, inserted_at) -> F.Column:
    """Rows of one load: of the batch, and of the one instant that the load stamped them with, if given."""
    mine = F.col(batch_col).eqNullSafe(F.lit(batch_id))
    return mine if inserted_at is None else mine & F.col("inserted_at").eqNullSafe(as_timestamp(inserted_at))


def rollback_batch(raw: DataFrame, batch_id: str, batch_col: str = "batch_id", inserted_at=None) -> DataFrame:
    """SNK-05: table content without one load; earlier versions become current again.

    With ``inserted_at`` only the rows stamped at this instant go: a load that replays an older
    batch id takes back its own rows, not those of the earlier load.
    """
    return raw.where(~_of_load(batch_id, batch_col, inserted_at))


def rollback_table(spark: SparkSession, path: str, batch_id: str, partition_by: Sequence[str] = (),
                   batch_col: str = "batch_id", inserted_at=None) -> None:
    """SNK-05 on a stored table: remove one load's rows.

    Partitioned tables rewrite only the partitions holding the batch (dynamic overwrite); the
    partitions that held nothing else are deleted. The list of those is bounded by the partitions
    that one load can touch.
    """
    if not partition_by:
        write_table(rollback_batch(spark.read.parquet(path), batch_id, batch_col, inserted_at), path, dynamic=False)
        return
    raw = spark.read.parquet(path)
    mine = _of_load(batch_id, batch_col, inserted_at)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    per_folder = raw.select(folder.alias("_folder"), mine.alias("_of_load")).groupBy("_folder").agg(
        F.count_if("_of_load").alias("_mine"), F.count(F.lit(1)).alias("_all"))
    emptied = [r._folder for r in per_folder.where((F.col("_mine") > 0) & (F.col("_mine") == F.col("_all"))).collect()]
    write_table(touched_partitions(raw, batch_id, partition_by, batch_col, inserted_at), path, partition_by, dynamic=True)
    jvm, fs = _files(spark, path)
    for gone in emptied:
        # file paths are reported as URIs: decode them once, as Hadoop does
        fs.delete(jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(gone)), True)


def touched_partitions(raw: DataFrame, batch_id: str, partition_cols: Sequence[str],
                       batch_col: str = "batch_id", inserted_at=None) -> DataFrame:
    """SNK-05: only the partitions containing the batch, minus its rows (dynamic overwrite input)."""
    mine = raw.where(_of_load(batch_id, batch_col, inserted_at))
    return rollback_batch(_in_scope(raw, mine, partition_cols), batch_id, batch_col, inserted_at)


# ----------------------------------------------------------------------------- SNK-09
def incremental_rows(source: DataFrame, mart: DataFrame, date: str = "date",
                     hash_col: str = "row_hash", lookback_days: int = 35) -> DataFrame:
    """SNK-09: rows to reprocess: ``date >= max(mart.date) - lookback`` OR hash absent from mart.

    The mart's max date is a scalar subquery; one left join on the mart's distinct hashes marks
    the absent rows, so the source (typically a staging view) is evaluated once.
    """
    edge = mart.agg(F.date_sub(F.max(date), lookback_days)).scalar()  # scalar subquery
    recent = F.coalesce(F.col(date) >= edge, F.lit(False))
    # distinct: rows with NULL identities share one hash and must not multiply the source
    known = mart.select(hash_col).distinct().withColumn("_in_mart", F.lit(True))
    return (source.join(known, hash_col, "left")
            .where(recent | F.col("_in_mart").isNull()).drop("_in_mart"))


def incremental_merge(source: DataFrame, mart: DataFrame, date: str = "date",
                      hash_col: str = "row_hash", lookback_days: int = 35) -> DataFrame:
    """SNK-09 + SNK-03: new mart content. Rows removed upstream are never deleted."""
    rows = incremental_rows(source, mart, date, hash_col, lookback_days)
    return upsert(mart, rows.select(*mart.columns), [hash_col])
