"""Substring dedup of 50-word windows by super-k-mers.

A window's minimiser is the smallest hash of its runs of ``MINIMISER`` words. Consecutive windows
with one minimiser form a super-k-mer: one string of words that holds them all, named by the
digest of its words. Equal windows have equal minimisers, so they meet in the minimiser's bucket.

1. Every super-k-mer is recorded as (document, place, bucket, digest), without its words.
2. Buckets seen in one document only hold no repeats and are done. In a bucket with one distinct
   string, the smallest document owns every window of it.
3. For the other buckets, each distinct string travels once, packed, from its smallest document to
   its bucket. There the windows of all strings are sorted; each distinct window is owned by the
   smallest document that has it. A bucket with very many strings is dealt over several tasks and
   the minima of its windows are merged by a second aggregation.
4. Occurrences of windows owned by a smaller document mark the words they cover.

Copies are combined before anything is shuffled as text: a passage held by a third of all documents
is one string. Windows are compared by 128 bits of two hashes of their words.

Defined results: null text has no words; texts of fewer than 50 words lose nothing; a repeat within
one document is not removed by itself; rows with one ``doc_id`` are one document; a null
``doc_id`` neither loses words nor causes a loss; an empty table gives no rows; extra columns of
any name pass through ``drop_repeats``, except that ``n_chars`` is recounted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import (BASE_A, BASE_B, Scratch, join_words, mix64, partitions, range_hash, release,
                                  text_chunks, word_spans)

WINDOW = 50
MINIMISER = 8
HOT = 16384  # strings of one bucket that one task sorts


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost smallest value in every run of ``width`` values."""
    place = np.arange(len(x))
    reach = 1
    while 2 * reach <= width:
        a, b = place[:-reach], place[reach:]
        place = np.where(x[b] < x[a], b, a)
        reach *= 2
    rest = width - reach
    if rest:
        a, b = place[:-rest], place[rest:]
        place = np.where(x[b] < x[a], b, a)
    return place


def super_kmers(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> dict[str, np.ndarray]:
    """Super-k-mers of concatenated texts: row, first window, number of windows, bucket, digest."""
    starts, ends, word_at = word_spans(data, offsets)
    n = len(starts)
    none = np.zeros(0, np.int64)
    if n < window:
        return {k: none for k in ("row", "first", "n", "bucket", "dig")}
    word = range_hash(data, starts, ends, BASE_A)
    run = np.zeros(n - MINIMISER + 1, np.uint64)
    for k in range(MINIMISER):
        run = run * np.uint64(BASE_B) + word[k:k + len(run)]
    run = mix64(run)
    place = _window_min(run, window - MINIMISER + 1)  # of the windows 0 .. n - window
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(word_at))[:len(place)]
    inside = np.flatnonzero(np.arange(len(place)) + window <= word_at[row + 1])
    if not len(inside):
        return {k: none for k in ("row", "first", "n", "bucket", "dig")}
    cut = np.flatnonzero(np.r_[True, (np.diff(place[inside]) != 0) | (np.diff(row[inside]) != 0) | (np.diff(inside) != 1)])
    first, size = inside[cut], np.diff(np.r_[cut, len(inside)])
    digest = range_hash(word, first, first + size + window - 1, BASE_B)
    return {"row": row[first], "first": first - word_at[row[first]], "n": size,
            "bucket": run[place[first]].view(np.int64), "dig": digest.view(np.int64)}


def _record(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            got = super_kmers(data, offsets, window)
            take = pa.array(got["row"])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(take), rows.column(1).take(take), pa.array(got["first"].astype(np.int32)),
                 pa.array(got["n"].astype(np.int32)), pa.array(got["bucket"]), pa.array(got["dig"])],
                names=["doc_id", "th", "first", "n", "bucket", "dig"])
    return run


def _pack(window: int):
    """Cut the wanted super-k-mers out of their texts as packed strings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            starts, ends, word_at = word_spans(data, offsets)
            raw, at = join_words(data, starts, ends)
            row, wanted = [], []
            for i, wants in enumerate(rows.column(2)):
                for w in wants.as_py():
                    first = int(word_at[i]) + w["first"]
                    last = first + w["n"] + window - 2
                    row.append(i)
                    wanted.append((w["bucket"], w["salt"], w["salts"], w["dig"],
                                   raw[at[first]:at[last] + ends[last] - starts[last]]))
            columns = list(zip(*wanted)) or [(), (), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64()),
                 pa.array(columns[3], pa.int64()), rows.column(0).take(pa.array(row, pa.int64())),
                 pa.array(columns[4], pa.binary())], names=["bucket", "salt", "salts", "dig", "doc_id", "packed"])
    return run


def _own(table: pa.Table, window: int) -> pa.RecordBatch:
    """Sort the windows of whole buckets; the smallest document of each window, string by string."""
    table = table.combine_chunks()
    packed = pa.RecordBatch.from_arrays([table.column("packed").combine_chunks().cast(pa.large_binary())], names=["text"])
    _, offset_buffer, data_buffer = packed.column(0).buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[packed.column(0).offset:][:packed.num_rows + 1]
    data = np.frombuffer(data_buffer, np.uint8)[offsets[0]:offsets[-1]]
    starts, ends, word_at = word_spans(data, offsets - offsets[0])
    word = range_hash(data, starts, ends, BASE_A)
    count = np.diff(word_at) - window + 1
    string = np.repeat(np.arange(len(count)), count)
    head = np.cumsum(count) - count
    first = word_at[string] + np.arange(len(string)) - head[string]
    one, two = range_hash(word, first, first + window, BASE_A), range_hash(word, first, first + window, BASE_B)
    doc, salts = table.column("doc_id").to_numpy(), table.column("salts").to_numpy()
    order = np.lexsort((doc[string], two, one))
    new = np.r_[True, (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)]
    owner = np.empty(len(order), np.int64)
    owner[order] = doc[string][order][np.flatnonzero(new)][np.cumsum(new) - 1]
    hot = salts > 1
    cuts = pa.array(np.r_[head, len(string)].astype(np.int32))
    hashes = [pa.ListArray.from_arrays(cuts, pa.array(h.view(np.int64)), mask=pa.array(~hot)) for h in (one, two)]
    return pa.RecordBatch.from_arrays(
        [table.column("bucket").combine_chunks(), table.column("dig").combine_chunks(), pa.array(hot),
         pa.ListArray.from_arrays(cuts, pa.array(owner)), *hashes],
        names=["bucket", "dig", "hot", "owners", "one", "two"])


def _sort_buckets(window: int, rows: int = 4096):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < rows:
                continue
            table = pa.Table.from_batches(held)
            bucket, salt = table.column("bucket").to_numpy(), table.column("salt").to_numpy()
            same = (bucket == bucket[-1]) & (salt == salt[-1])
            whole = size - int(same.sum())  # rows are sorted: the last group may go on
            if whole:
                yield _own(table.slice(0, whole), window)
            held, size = table.slice(whole).to_batches(), size - whole
        if size:
            yield _own(pa.Table.from_batches(held), window)
    return run


def repeat_marks(docs: DataFrame, scratch: Scratch, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(_doc, _th, marks): per row, places and bit masks of the windows that a smaller document has."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", F.xxhash64("text").alias("th"), "text").where("doc_id IS NOT NULL")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(_record(window), f"doc_id {kind}, th long, first int, n int, bucket long, dig long")
    found = scratch.write(found, "found")

    shared = (found.groupBy("bucket").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"),
                                          F.min("dig").alias("dig_low"), F.max("dig").alias("dig_high"),
                                          F.count("*").alias("seen"))
              .where("low < high").select("bucket", "low", "seen", (F.col("dig_low") < F.col("dig_high")).alias("many")))
    shared = scratch.write(shared, "shared")
    release(spark)
    hits = scratch.write(found.join(shared, "bucket").where("many OR doc_id > low"), "hits")
    scratch.drop("found")
    release(spark)
    alike = hits.where("NOT many").select("doc_id", "th", "first", (F.call_function("shiftleft", F.lit(1).cast("long"), "n") - 1).alias("mask"))

    several = hits.where("many")
    salts = F.ceil(F.col("seen") / hot).cast("long")
    reps = (several.groupBy("bucket", "dig").agg(F.min(F.struct("doc_id", "th", "first", "n")).alias("rep"),
                                                 F.max(salts).alias("salts")))
    wants = (reps.groupBy(F.col("rep.doc_id").alias("_doc"), F.col("rep.th").alias("_th"))
             .agg(F.collect_list(F.struct(F.col("rep.first").alias("first"), F.col("rep.n").alias("n"), "bucket", "dig",
                                          "salts", F.pmod("dig", "salts").alias("salt"))).alias("wants")))
    strings = (texts.join(wants, (F.col("doc_id") == F.col("_doc")) & (F.col("th") == F.col("_th")))
               .select("doc_id", "text", "wants")
               .mapInArrow(_pack(window), f"bucket long, salt long, salts long, dig long, doc_id {kind}, packed binary"))
    owned = scratch.write(
        strings.repartition(partitions(spark), "bucket", "salt").sortWithinPartitions("bucket", "salt")
        .mapInArrow(_sort_buckets(window), "bucket long, dig long, hot boolean, owners array<long>, one array<long>, two array<long>"),
        "owned")
    release(spark)
    cold = owned.where("NOT hot").select("bucket", "dig", "owners")
    warm = (owned.where("hot").select("bucket", "dig", F.posexplode(F.arrays_zip("owners", "one", "two")).alias("j", "w"))
            .select("bucket", "dig", "j", "w.owners", "w.one", "w.two").withColumnRenamed("owners", "owner"))
    merged = warm.groupBy("one", "two").agg(F.min("owner").alias("lowest"))
    warm = (warm.join(merged, ["one", "two"]).groupBy("bucket", "dig")
            .agg(F.sort_array(F.collect_set(F.struct("j", "lowest"))).alias("w"))
            .select("bucket", "dig", F.col("w.lowest").alias("owners")))
    # written, so that both sides of the next join are plain shuffles that AQE can split where hot
    owners = scratch.write(cold.unionByName(warm).dropDuplicates(["bucket", "dig"]), "owners")
    bits = F.transform("owners", lambda o, j: F.when(o < F.col("doc_id"), F.call_function("shiftleft", F.lit(1).cast("long"), j))
                       .otherwise(F.lit(0).cast("long")))
    mixed = (several.join(owners, ["bucket", "dig"])
             .select("doc_id", "th", "first", F.aggregate(bits, F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(b)).alias("mask"))
             .where("mask <> 0"))
    marks = (alike.unionByName(mixed).groupBy(F.col("doc_id").alias("_doc"), F.col("th").alias("_th"))
             .agg(F.collect_set(F.struct("first", "mask")).alias("marks")))
    return scratch.write(marks, "marks")


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            starts, ends, word_at = word_spans(data, offsets)
            marks = rows.column(rows.schema.get_field_index("marks"))
            flat = marks.flatten()
            count = np.array([len(m) if m.is_valid else 0 for m in marks], np.int64)
            base = np.repeat(word_at[:-1], count)
            first = flat.field("first").to_numpy() + base if len(flat) else base
            mask = flat.field("mask").to_numpy() if len(flat) else base
            delta = np.zeros(len(starts) + 1, np.int64)
            for j in range(window - MINIMISER + 1):
                at = first[(mask >> j) & 1 == 1] + j
                np.add.at(delta, at, 1)
                np.add.at(delta, at + window, -1)
            stays = np.cumsum(delta)[:-1] <= 0
            kept_at = np.r_[0, np.cumsum(stays)][word_at]
            raw, at = join_words(data, starts[stays], ends[stays])
            at = np.r_[at, len(raw)]
            text = [raw[at[a]:at[b] - 1].decode() if b > a else "" for a, b in zip(kept_at[:-1], kept_at[1:])]
            words = np.diff(word_at)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(words), pa.array(words - np.diff(kept_at)), pa.array(text, pa.string())],
                names=["row", "n_words", "n_removed", "kept"])
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(row, n_words, n_removed, kept): every row of ``docs`` (without its text) and its kept words."""
    scratch = Scratch(docs.sparkSession, "substrings")
    marks = repeat_marks(docs, scratch, window, hot)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"),
                         F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_row_th"), "text")
    both = packed.join(marks, (F.col("_id") == F.col("_doc")) & (F.col("_row_th") == F.col("_th")), "left")
    return both.select("row", "text", "marks").mapInArrow(
        _remove(window), f"row {packed.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept string")


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs``, all columns, without the words of windows that a smaller document has."""
    new: dict[str, Column] = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    kept = remove_repeats(docs, window)
    return kept.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
