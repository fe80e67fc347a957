"""Merkle manifest of a dataset: levels of parent-linked node rows, proofs by a recursive query.

Every row is a leaf: the digest of its fields, each with its length, so that no two rows share an
encoding. Leaves are numbered per group (a range shuffle and one offset for each partition, no
window over a group), and every level is one aggregation over runs of at most three digests. The
built levels are stored as rows ``(tree, level, pos, kids, up, slot)``: a node, the digests under it,
its parent and its place among the parent's kids. The roots of the groups are the leaves of one
more tree, whose rows are stored alike.

A Spark recursive query climbs from every leaf: it joins the parent's row, appends the siblings to
the proof and folds the leaf's digest, for tampered leaves the tampered one. The first ``SHARED``
levels are climbed leaf by leaf. Above them the (at most 3 ** SHARED) leaves under one node have
the same siblings, so they climb on as one row with one proof and one folded digest for each leaf;
their number, not the height, bounds what a row holds.

Defined results: a null field is ``-``; a null group is a group of its own, the first; rows of a
group ascend by ``doc_id`` (null first), then by leaf digest, so equal rows are interchangeable;
each repeated row is a leaf; an empty table gives no rows and no root; extra columns of any name
are ignored. Digests are of hex text, written as 32 bytes in between.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SHARED = 4
TOP = "^"  # the tree over the groups' roots; group trees start with "=" or are empty
NODE = ("tree string, level int, pos long, n long, kids array<binary>, hash binary, "
        "up struct<tree: string, level: int, pos: long>, slot int")


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns.values()]), 256))


def hex_text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def digest_of(kids: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(F.transform(kids, hex_text), ""), 256))


def _step(tree: Column, level: Column, pos: Column) -> Column:
    return F.struct(tree.alias("tree"), level.cast("int").alias("level"), pos.cast("long").alias("pos"))


def numbered(rows: DataFrame, scratch: Scratch, name: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos`` (from 0, by ``order``) and ``n`` (rows) within each ``tree``."""
    keys = ["tree", *order]
    ranged = (rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)))
    ranged = scratch.write(ranged, name)
    whole = Window.partitionBy("tree")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranged.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count("*").alias("held"))
              .select("tree", "part", (F.coalesce(F.sum("held").over(earlier), F.lit(0)) - F.col("low")).alias("shift"),
                      F.sum("held").over(whole).alias("n")))
    return (ranged.join(starts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
            .drop("at", "part", "shift"))


@dataclass
class Manifest:
    """Leaves ``(uid, doc_id, tree, pos, n, leaf, fold)``, stored nodes, group roots ``(tree, hash, up, slot)``, root."""

    scratch: Scratch
    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None


def _build_levels(level_0: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Node tables of levels 1, 2, ... over ``level_0(tree, pos, n, hash)``; ``up`` is null at the root."""
    most = level_0.agg(F.max("n")).first()[0] or 0
    below, tables, level = level_0, [], 0
    while most > 1:
        level, most = level + 1, -(-most // FANOUT)
        run = F.expr(f"pos div {FANOUT}")
        n = F.expr(f"(n + {FANOUT - 1}) div {FANOUT}")
        kids = F.sort_array(F.collect_list(F.struct("pos", "hash"))).getField("hash")
        nodes = (below.where("n > 1").groupBy("tree", run.alias("pos"), n.alias("n")).agg(kids.alias("kids"))
                 .select("tree", F.lit(level).alias("level"), "pos", "n", "kids", digest_of(F.col("kids")).alias("hash"),
                         F.when(F.col("n") > 1, _step(F.col("tree"), F.lit(level + 1), run)).alias("up"),
                         F.when(F.col("n") > 1, F.col("pos") % FANOUT).cast("int").alias("slot")))
        below = scratch.write(nodes, f"{name}_{level}")
        tables.append(below)
    return tables


def _union(spark: SparkSession, tables: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], NODE)
    for table in tables:
        out = out.unionByName(table)
    return out


def build(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = FIELDS,
          tampered: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``tampered`` replaces fields of the rows that are verified against it."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "manifest")
    own = {c: F.col(c) for c in fields}
    leaves = docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(order).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"),
        leaf_digest(own).alias("leaf"), leaf_digest({**own, **(tampered or {})}).alias("fold"))
    leaves = scratch.write(leaves, "leaves")
    leaves = scratch.write(numbered(leaves, scratch, "ranged", ["doc_id", "leaf", "uid"]), "numbered")
    levels = _build_levels(leaves.select("tree", "pos", "n", F.col("leaf").alias("hash")), scratch, "nodes")
    trees = (leaves.where("n = 1").select("tree", F.lit(0).alias("level"), F.col("leaf").alias("hash"))
             .unionByName(_union(spark, levels).where("n = 1").select("tree", "level", "hash")))
    ends = numbered(trees.select(F.lit(TOP).alias("tree"), F.col("tree").alias("own"), "hash"), scratch, "ends", ["own"])
    ends = scratch.write(ends, "subroots")
    top = _build_levels(ends.select("tree", "pos", "n", "hash"), scratch, "top")
    subroots = ends.select(
        F.col("own").alias("tree"), "hash",
        F.when(F.col("n") > 1, _step(F.col("tree"), F.lit(1), F.expr(f"pos div {FANOUT}"))).alias("up"),
        F.when(F.col("n") > 1, F.col("pos") % FANOUT).cast("int").alias("slot"))
    inner = _union(spark, levels)
    linked = inner.where("n = 1").drop("up", "slot").join(subroots.select("tree", "up", "slot"), "tree")
    nodes = (inner.where("n > 1").unionByName(linked).unionByName(_union(spark, top))
             .select("tree", "level", "pos", "kids", "up", "slot"))
    nodes = scratch.write(nodes, "links")
    last = top[-1] if top else ends
    root = last.where("n = 1").select(hex_text(F.col("hash"))).first()
    return Manifest(scratch, leaves, nodes, subroots, root[0] if root else None)


@contextmanager
def unlimited_recursion(spark: SparkSession):
    """Spark stops a recursive query at a million rows by default; here every leaf is a row."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


# the siblings in order, without the kid in the climbing row's own slot
_SIBLINGS = ", ".join(f"if(c.slot = {i}, X'', coalesce(get(n.kids, {i}), X''))" for i in range(FANOUT))
_FOLDED = ("unhex(sha2(array_join(transform(n.kids, (k, i) -> lower(hex(if(i = c.slot, {fold}, k)))), ''), 256))")

CLIMB = """
WITH RECURSIVE climb(id, steps, up, slot, fold, proof) AS (
    SELECT id, 0, up, slot, fold, X'' FROM {seeds}
    UNION ALL
    SELECT c.id, c.steps + 1, n.up, n.slot, %s, concat(c.proof, %s)
    FROM climb c JOIN {nodes} n ON n.tree = c.up.tree AND n.level = c.up.level AND n.pos = c.up.pos
    WHERE c.steps < {most}
)
SELECT * FROM climb WHERE up IS NULL OR steps = {most}
"""
ONE = CLIMB % (_FOLDED.format(fold="c.fold"), _SIBLINGS)
MANY = CLIMB % (f"transform(c.fold, f -> {_FOLDED.format(fold='f')})", _SIBLINGS)


def climb(held: Manifest, shared: int = SHARED) -> DataFrame:
    """(uid, folded, proof) of every leaf: the root that its ``fold`` leads to, and the digest of its siblings."""
    spark, scratch = held.scratch.spark, held.scratch
    inside = held.leaves.where("n > 1").select(
        F.col("uid").alias("id"), _step(F.col("tree"), F.lit(1), F.expr(f"pos div {FANOUT}")).alias("up"),
        (F.col("pos") % FANOUT).cast("int").alias("slot"), "fold")
    alone = (held.leaves.where("n = 1").join(held.subroots.select("tree", "up", "slot"), "tree")
             .select(F.col("uid").alias("id"), "up", "slot", "fold"))
    low_nodes = held.nodes.where((F.col("level") <= shared) | (F.col("tree") == TOP))
    high_nodes = held.nodes.where((F.col("level") > shared) | (F.col("tree") == TOP))
    with unlimited_recursion(spark):
        low = scratch.write(spark.sql(ONE, seeds=inside.unionByName(alone), nodes=low_nodes, most=shared), "low")
        together = (low.where("up IS NOT NULL").groupBy("up", "slot")
                    .agg(F.sort_array(F.collect_list(F.struct("id", "fold"))).alias("held")))
        together = scratch.write(together.select(F.monotonically_increasing_id().alias("id"), "up", "slot",
                                                 F.col("held.id").alias("ids"), F.col("held.fold").alias("fold")), "together")
        high = scratch.write(spark.sql(MANY, seeds=together.drop("ids"), nodes=high_nodes, most=100), "high")
    above = (together.select("id", F.col("up").alias("from_up"), F.col("slot").alias("from_slot"), "ids")
             .join(high.select("id", F.col("fold").alias("folds"), F.col("proof").alias("above")), "id").drop("id"))
    both = low.join(above, (low.up == above.from_up) & (low.slot == above.from_slot), "left")
    mine = F.get("folds", (F.array_position("ids", F.col("id")) - 1).cast("int"))
    return both.select(F.col("id").alias("uid"), hex_text(F.coalesce(mine, F.col("fold"))).alias("folded"),
                       F.sha2(hex_text(F.concat("proof", F.coalesce("above", F.lit(b"")))), 256).alias("proof"))


def prove(held: Manifest, shared: int = SHARED) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every leaf."""
    groups = held.subroots.select("tree", hex_text(F.col("hash")).alias("subroot"))
    proofs = climb(held, shared)
    return (held.leaves.select("uid", "doc_id", "tree", hex_text(F.col("leaf")).alias("leaf")).join(proofs, "uid")
            .join(groups, "tree")
            .select("doc_id", "leaf", "subroot", F.lit(held.root).cast("string").alias("root"),
                    F.col("proof").alias("proof_sha256"), F.col("folded").alias("folded_root"),
                    (F.col("folded") == F.lit(held.root)).alias("verified")))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    return prove(build(docs, tampered={"text": F.coalesce(cut, F.col("text"))}))


OP12_SQL = r"""
WITH RECURSIVE rows_ AS (
    SELECT doc_id, source,
           list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
               string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
               lambda crc, b: xor(xor(crc, b) >> 1, 3988292384 * (xor(crc, b) & 1))) AS crc_inverted,
           coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
           || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
           || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
           text, replace(text, chr(10), '') AS cut
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n
    FROM (SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
                 CASE WHEN xor(crc_inverted, 4294967295) % 2 = 0
                      THEN sha256(head || coalesce(octet_length(encode(cut)) || ':' || cut, '-'))
                      ELSE sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) END AS tampered
          FROM rows_)
), nodes(source, level, pos, n, hash) AS (
    SELECT source, 0, pos, n, leaf FROM leaves
    UNION ALL
    SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
    FROM nodes WHERE n > 1 GROUP BY source, level, n, pos // 3
), subroots AS (
    SELECT source, level, hash, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM nodes WHERE n = 1
), tops(level, pos, n, hash) AS (
    SELECT 0, pos, n, hash FROM subroots
    UNION ALL
    SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY pos))
    FROM tops WHERE n > 1 GROUP BY level, n, pos // 3
), runs AS (
    SELECT source, level, pos // 3 AS run, list(hash ORDER BY pos) AS kids FROM nodes WHERE n > 1 GROUP BY ALL
), top_runs AS (
    SELECT level, pos // 3 AS run, list(hash ORDER BY pos) AS kids FROM tops WHERE n > 1 GROUP BY ALL
), climb(doc_id, leaf, source, level, i, n, fold, proof) AS (
    SELECT doc_id, leaf, source, 0, pos, n, tampered, '' FROM leaves
    UNION ALL
    SELECT c.doc_id, c.leaf, c.source, c.level + 1, c.i // 3, (c.n + 2) // 3,
           sha256(array_to_string(list_concat(r.kids[:c.i % 3], [c.fold], r.kids[c.i % 3 + 2:]), '')),
           c.proof || array_to_string(list_concat(r.kids[:c.i % 3], r.kids[c.i % 3 + 2:]), '')
    FROM climb c JOIN runs r ON r.source IS NOT DISTINCT FROM c.source AND r.level = c.level AND r.run = c.i // 3
    WHERE c.n > 1
), high(doc_id, leaf, subroot, level, i, n, fold, proof) AS (
    SELECT c.doc_id, c.leaf, s.hash, 0, s.pos, s.n, c.fold, c.proof
    FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
    UNION ALL
    SELECT c.doc_id, c.leaf, c.subroot, c.level + 1, c.i // 3, (c.n + 2) // 3,
           sha256(array_to_string(list_concat(r.kids[:c.i % 3], [c.fold], r.kids[c.i % 3 + 2:]), '')),
           c.proof || array_to_string(list_concat(r.kids[:c.i % 3], r.kids[c.i % 3 + 2:]), '')
    FROM high c JOIN top_runs r ON r.level = c.level AND r.run = c.i // 3
    WHERE c.n > 1
)
SELECT c.doc_id, c.leaf, c.subroot, t.hash AS root, sha256(c.proof) AS proof_sha256, c.fold AS folded_root,
       c.fold = t.hash AS verified
FROM high c, (SELECT hash FROM tops WHERE n = 1) t WHERE c.n = 1
"""
