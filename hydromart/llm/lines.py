"""Line dedup with levelled sorted runs of line hashes; DataFrame functions only.

A run is a written table, sorted by line hash, of (hash, number of documents). Documents arrive in
batches. Each batch is joined against the settled run (lines already found in enough documents)
and keeps only what is not there, a merge anti-join; its counts become a new run of level 0. Full
levels are compacted into one run of the next level, and what reaches the threshold moves to the
settled run. In the end, a line goes from every document if its hash is settled.

A line held by a third of all documents is combined map-side before every shuffle, and the final
join is on a table with one row per settled line (AQE splits the hot side).

Lines are named by 128 bits of two differently seeded 64-bit hashes. Defined results: null or
empty text is one empty line, which is never dropped; rows with the same ``doc_id`` are one
document when documents are counted, each row still gets its own result; a null ``doc_id`` counts
as no document (its lines are dropped like others); an empty table gives no rows; extra columns of
any name pass through ``drop_common_lines``, except that ``n_chars`` is recounted.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch

MIN_DOCS = 10
BATCHES = 4
FANOUT = 2
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Runs by level; ``settled`` holds the lines found in at least ``min_docs`` documents."""

    SCHEMA = "h1 long, h2 long, n_docs long"

    def __init__(self, scratch: Scratch, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.scratch, self.min_docs, self.fanout = scratch, min_docs, fanout
        self.levels: list[list[str]] = []
        self.made = 0
        empty = scratch.spark.createDataFrame([], self.SCHEMA)
        empty.write.mode("append").parquet(scratch.path("settled"))

    def settled(self) -> DataFrame:
        return self.scratch.read(self.SCHEMA, "settled")

    def _new_run(self, counts: DataFrame, level: int) -> None:
        name = f"run_{level}_{self.made}"
        self.made += 1
        self.scratch.write(counts.sortWithinPartitions("h1", "h2"), name)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def add(self, lines: DataFrame) -> None:
        """Add a batch ``(doc_id, h1, h2)``; all lines of a document are in one batch."""
        counts = lines.groupBy("h1", "h2").agg(F.count_distinct("doc_id").alias("n_docs"))
        self._new_run(counts.join(self.settled(), ["h1", "h2"], "left_anti"), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            self.compact(level)
            level += 1

    def compact(self, level: int, last: bool = False) -> None:
        """Merge the runs of a level (``last``: of every level up to it) into one of the next."""
        names = [n for at in range(0 if last else level, level + 1) for n in self.levels[at]]
        runs = self.scratch.spark.read.schema(self.SCHEMA).parquet(*[self.scratch.path(n) for n in names])
        summed = runs.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"))
        merged = f"merged_{self.made}"
        summed = self.scratch.write(summed.sortWithinPartitions("h1", "h2"), merged)
        summed.where(F.col("n_docs") >= self.min_docs).write.mode("append").parquet(self.scratch.path("settled"))
        if not last:
            self._new_run(summed.where(F.col("n_docs") < self.min_docs), level + 1)
        for at in range(0 if last else level, level + 1):
            self.levels[at] = []
        for name in [*names, merged]:
            self.scratch.drop(name)

    def finish(self) -> DataFrame:
        """Merge what is left; the settled lines."""
        if any(self.levels):
            self.compact(len(self.levels) - 1, last=True)
        return self.settled().select("h1", "h2").distinct()


def dropped_positions(docs: DataFrame, scratch: Scratch, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(_doc, _text, _gone): positions of the dropped lines of every row that loses some."""
    lines = (docs.select("doc_id", F.xxhash64("text").alias("_text"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
             .withColumn("line", line_key(F.col("line"))).where("line <> ''")
             .select("doc_id", "_text", "pos", F.xxhash64("line").alias("h1"),
                     F.xxhash64(F.lit("second"), "line").alias("h2"),
                     F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")))
    lines = scratch.write(lines.sortWithinPartitions("batch"), "lines")  # one file a task; statistics skip other batches
    runs = LineRuns(scratch, min_docs)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    hits = lines.join(runs.finish(), ["h1", "h2"], "left_semi")
    return (hits.groupBy(F.col("doc_id").alias("_doc"), "_text")
            .agg(F.collect_set("pos").alias("_gone")))


def mark_lines(docs: DataFrame, scratch: Scratch, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """(row, _lines, _kept): every row of ``docs`` as a struct, its lines, the positions that stay."""
    gone = dropped_positions(docs, scratch, min_docs, batches)
    split = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_row_text"),
                        split_lines(F.col("text")).alias("_lines"))
    both = split.join(gone, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_row_text") == F.col("_text")), "left")
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    return both.select("row", "_lines", F.coalesce(F.array_except(every, "_gone"), every).alias("_kept"))


def kept_text() -> Column:
    return F.array_join(F.transform("_kept", lambda i: F.get(F.col("_lines"), i)), "\n")


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``docs``, all columns, without the lines found in at least ``min_docs`` documents."""
    marked = mark_lines(docs, Scratch(docs.sparkSession, "lines"), min_docs, batches).withColumn("_new", kept_text())
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("_new")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("_new").cast(docs.schema["n_chars"].dataType)
    return marked.select(*[columns[c].alias(c) for c in docs.columns])


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    marked = mark_lines(docs, Scratch(spark, "lines"))
    return marked.select(
        "row.doc_id", F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH parts AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM parts
), keyed AS (
    SELECT doc_id, line, pos,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), common AS (
    SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE key IN (SELECT key FROM common)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE key NOT IN (SELECT key FROM common)), '')) AS kept_sha256
FROM keyed GROUP BY doc_id
"""
