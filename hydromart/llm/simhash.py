"""SimHash near-dedup: 64-bit majority fingerprints, tiled exact comparison, components.

Fingerprints that are equal collapse first, so copies never form pairs. The distinct fingerprints
are cut into tiles by population count; a pair of tiles is compared only when the counts can
differ by no more than the radius (two values ``d`` bits apart have counts at most ``d`` apart).
Inside a pair of tiles the same bound is applied to the counts of the two halves. Every remaining
pair is compared exactly with exclusive-or and bit counts. A task returns a spanning forest of the
links it found, never the links themselves.

Defined results: null or blank text has fingerprint zero, linked like any other; repeated rows
share their fingerprint; a null ``doc_id`` takes part but is never the smallest id of a component
unless all its ids are null; an empty table gives no rows; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch, join_words, partitions, ship, text_chunks, word_spans
from hydromart.llm.components import components, fold_links

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
TILE_ROWS = 32768
_BLOCK = 65_536  # shingles whose bits are held at once


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints (uint64) of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n_docs = len(offsets) - 1
    out = np.zeros(n_docs, np.uint64)
    lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    starts, ends, word_at = word_spans(data, offsets)
    if not len(starts):
        return out
    size = ends - starts
    raw, joined_at = join_words(lower, starts, ends)
    words = np.diff(word_at)
    n_shingles = np.where(words > 0, np.maximum(words - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(n_docs), n_shingles)
    first = np.arange(len(doc)) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles) + word_at[doc]
    last = np.minimum(first + shingle - 1, word_at[doc + 1] - 1)
    begin, finish = joined_at[first], joined_at[last] + size[last]
    ones = np.zeros((n_docs, 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(doc), _BLOCK):
        part = slice(at, at + _BLOCK)
        h = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[part].tolist(), finish[part].tolist())),
                        np.uint64, count=len(doc[part]))
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.r_[True, np.diff(doc[part]) > 0])
        ones[doc[part][heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    major = (ones * 2 > n_shingles[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1, bitorder="little").view("<u8").reshape(-1).astype(np.uint64)


def fingerprint(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, th, fp): the text hash and the fingerprint (a signed long) of every row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            fp = fingerprints_of(data, offsets, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(fp)], names=["doc_id", "th", "fp"])

    key = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64("text").alias("th"), "text")
            .mapInArrow(run, f"doc_id {key}, th bigint, fp bigint"))


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int64)


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges (as fingerprints) linking values of tile ``a`` with ``b``, or inside ``a``."""
    values = a if b is None else np.concatenate([a, b])
    label = np.arange(len(values))
    low = np.uint64(0xFFFFFFFF)
    halves = np.stack([_bits(values & low), _bits(values >> np.uint64(32))])
    side = [np.arange(len(a)), np.arange(len(a)) if b is None else np.arange(len(a), len(values))]
    groups = []
    for rows in side:
        code = halves[0, rows] * 64 + halves[1, rows]
        order = np.argsort(code, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(code[order]) > 0, True])
        groups.append([(code[order[s]] // 64, code[order[s]] % 64, rows[order[s:e]])
                       for s, e in zip(cuts[:-1], cuts[1:])])
    held_i: list[np.ndarray] = []
    held_j: list[np.ndarray] = []
    held = 0
    for x, (lo1, hi1, left) in enumerate(groups[0]):
        for y, (lo2, hi2, right) in enumerate(groups[1]):
            if (b is None and y < x) or abs(lo1 - lo2) + abs(hi1 - hi2) > radius:
                continue
            for p in range(0, len(left), block):
                for q in range(0, len(right), 2 * block):
                    one, two = left[p:p + block], right[q:q + 2 * block]
                    near = np.bitwise_count(values[one][:, None] ^ values[two][None, :]) <= radius
                    i, j = np.nonzero(near)
                    i, j = one[i], two[j]
                    keep = i != j
                    held_i.append(i[keep])
                    held_j.append(j[keep])
                    held += len(held_i[-1])
                    if held > 1_000_000:
                        label = fold_links(label, np.concatenate(held_i), np.concatenate(held_j))
                        held_i, held_j, held = [], [], 0
    if held:
        label = fold_links(label, np.concatenate(held_i), np.concatenate(held_j))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return values[moved], values[label[moved]]


def link_fingerprints(distinct: DataFrame, radius: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Forest edges (a, b) between distinct fingerprints ``fp`` at most ``radius`` bits apart."""
    spark = distinct.sparkSession
    ship(spark)
    distinct = distinct.select("fp", F.bit_count("fp").cast("int").alias("p"))
    counts = {r.p: r.n for r in distinct.groupBy("p").agg(F.count("*").alias("n")).collect()}  # at most 65 rows
    tiles = {p: -(-n // tile_rows) for p, n in counts.items()}
    base, total = {}, 0
    for p in sorted(tiles):
        base[p], total = total, total + tiles[p]
    first = F.create_map(*[F.lit(x) for p in sorted(base) for x in (p, base[p])]) if base else F.lit(None)
    n_of = F.create_map(*[F.lit(x) for p in sorted(tiles) for x in (p, tiles[p])]) if base else F.lit(None)
    if not base:
        return spark.createDataFrame([], "a long, b long")
    tile = first[F.col("p")] + F.pmod(F.xxhash64("fp"), n_of[F.col("p")]).cast("int")
    # the tiles of counts p - radius .. p + radius are consecutive numbers
    near_low = F.create_map(*[F.lit(x) for p in sorted(base) for x in (p, min(base[q] for q in base if abs(q - p) <= radius))])
    near_high = F.create_map(*[F.lit(x) for p in sorted(base) for x in (p, max(base[q] + tiles[q] - 1 for q in base if abs(q - p) <= radius))])
    sent = (distinct.withColumn("tile", tile)
            .withColumn("other", F.explode(F.sequence(near_low[F.col("p")], near_high[F.col("p")])))
            .select("fp", "tile", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"].iat[0], pdf["y"].iat[0]
        fp, at = pdf["fp"].to_numpy().view(np.uint64), pdf["tile"].to_numpy()
        a, b = tile_links(fp[at == x], None if x == y else fp[at == y], radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (sent.repartition(4 * partitions(spark), "x", "y")
            .groupBy("x", "y").applyInPandas(compare, "a long, b long"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, th, fp, root (of the component), component_id (smallest doc_id reachable)."""
    spark: SparkSession = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    prints = scratch.write(fingerprint(docs, shingle).hint("rebalance", "fp"), "prints")  # a few files, equal values together
    classes = scratch.write(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "classes")
    links = link_fingerprints(classes, radius)
    roots = components(links, scratch)
    rooted = (classes.join(roots, classes.fp == roots.node, "left")
              .select("fp", "low_id", F.coalesce("component", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("low_id").alias("component_id"))
    grouped = scratch.write(rooted.join(lowest, "root").select(F.col("fp").alias("class_fp"), "root", "component_id"), "grouped")
    return (prints.join(grouped, prints.fp == grouped.class_fp)
            .select("doc_id", "th", "fp", "root", "component_id"))


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One row of ``docs``, all columns, of each component: that of the smallest id, then text hash."""
    groups = simhash_groups(docs, shingle, radius)
    first = (groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("pick"))
             .select(F.col("pick.doc_id").alias("_doc"), F.col("pick.th").alias("_pick")).distinct())
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                         F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    kept = (packed.join(first, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_th") == F.col("_pick")), "left_semi")
            .groupBy("_id", "_th").agg(F.first("row").alias("row")))
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
