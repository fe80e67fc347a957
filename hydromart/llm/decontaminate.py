"""Benchmark decontamination by the q-gram lemma.

A text region within ``k`` edits of an item of ``m`` characters shares at least
``m - q + 1 - k * q`` of its character q-grams, and all of them lie on ``k + 1`` neighbouring
diagonals (text position minus item position). The items' q-grams are indexed in blocks of bounded
size; each block is sent to the workers and meets every whole text once. Shared q-grams are
counted in overlapping diagonal bands of width ``2 (k + 1)``, each ``k + 1`` further, so every run
of ``k + 1`` diagonals lies inside one band. Bands that reach the bound are verified by an
alignment that is limited to the band.

Texts and items are compared in lower case with white-space runs as one space. The edit budget is
a tenth of an item's length, less for items so short that the lemma would ask for nothing.

Defined results: null and empty texts and items match nothing, nor do items shorter than one
q-gram; equal items are found under each of their ids; repeated rows are found each; an empty
table gives no rows; only ``doc_id``, ``text``, ``item_id`` are read, and ``drop_contaminated``
returns the columns of its input whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import BASE_A, Scratch, mix64

Q = 8
EDIT_SHARE = 0.1
BLOCK_CHARS = 1 << 21  # characters of items that one pass over the texts holds
SEGMENT = 1 << 18  # characters of text looked at together; longer texts go in overlapping segments
_FILTER_BITS = 22


def normalise(text: str) -> str:
    return " ".join(text.lower().replace("\0", " ").split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at every place."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(Q):
        out = out * np.uint64(BASE_A) + codes[k:k + n]
    return mix64(out)


class ItemBlock:
    """Q-gram index of one block of items."""

    def __init__(self, items: list[tuple[object, str]]):
        by_text: dict[str, list[object]] = {}
        for item_id, text in items:
            by_text.setdefault(normalise(text), []).append(item_id)
        self.texts = [t for t in by_text if len(t) >= Q]
        self.ids = [by_text[t] for t in self.texts]
        size = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.minimum((size * EDIT_SHARE).astype(np.int64), (size - Q) // Q)
        self.need = size - Q + 1 - self.budget * Q
        grams = [_grams(_codes(t)) for t in self.texts]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.gram, first, count = np.unique(every[order], return_index=True, return_counts=True)
        self.first, self.count, self.item, self.place = first, count, item[order], place[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.gram >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.longest = int(size.max()) if len(size) else 0

    def candidates(self, codes: np.ndarray) -> np.ndarray:
        """(item, lowest diagonal) rows of the bands that hold enough shared q-grams."""
        grams = _grams(codes)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.gram, grams[at]), len(self.gram) - 1)
        real = self.gram[found] == grams[at] if len(self.gram) else np.zeros(0, bool)
        at, found = at[real], found[real]
        n = self.count[found]
        if not len(n):
            return np.zeros((0, 2), np.int64)
        posting = np.repeat(self.first[found] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        item = self.item[posting]
        total = np.bincount(item, minlength=len(self.texts))
        enough = (total >= self.need)[item]  # a band cannot hold more than the whole segment
        item, place = item[enough], self.place[posting][enough]
        diagonal = np.repeat(at, n)[enough] - place + self.longest
        step = self.budget[item] + 1
        band = diagonal // step  # a hit lies in the band that starts here and in the one before
        width = len(codes) + 2 * self.longest + 2
        key = np.concatenate([item * width + band + 1, item * width + band])
        # a gram of the item counts once in a band, however often the text repeats it
        key = np.unique(key * self.longest + np.concatenate([place, place])) // self.longest
        key, hits = np.unique(key, return_counts=True)
        item, band = key // width, key % width - 1
        keep = hits >= self.need[item]
        item, band = item[keep], band[keep]
        return np.stack([item, band * (self.budget[item] + 1) - self.longest], axis=1)

    def find(self, text: str) -> dict[int, tuple[int, int, int]]:
        """Best region per item in a normalised text: item -> (edits, start, end)."""
        best: dict[int, tuple[int, int, int]] = {}
        reach = 2 * self.longest + 2
        for base in range(0, max(1, len(text)), SEGMENT):
            segment = text[base:base + SEGMENT + reach]
            for item, low in self.candidates(_codes(segment)).tolist():
                if best.get(item, (1,))[0] == 0:
                    continue  # bands come in order of place: the first exact region is the best one
                k = int(self.budget[item])
                start = max(0, low - k)
                region = segment[start:low + 2 * (k + 1) + len(self.texts[item]) + k]
                got = align(self.texts[item], region, k)
                if got is not None:
                    got = (got[0], base + start + got[1], base + start + got[2])
                    best[item] = min(best.get(item, got), got)
        return best


def _last_row(item: np.ndarray, region: np.ndarray, free: bool, k: int) -> np.ndarray | None:
    """Edit distances of the whole item against prefixes of the region (``free``: any start); None beyond ``k``."""
    place = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64) if free else place.copy()
    for i, c in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != c))
        row = np.minimum.accumulate(new - place) + place
        if not i % 8 and row.min() > k:  # distances never fall from row to row
            return None
    return row


def align(item: str, region: str, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``item`` in ``region`` within ``k`` edits, else None."""
    at = region.find(item)
    if at >= 0:
        return 0, at, at + len(item)
    if k == 0:
        return None
    a, b = _codes(item), _codes(region)
    row = _last_row(a, b, True, k)
    if row is None or row.min() > k:
        return None
    end = int(row.argmin())
    back = _last_row(a[::-1], b[:end][::-1], False, k)
    return int(row[end]), end - int(back.argmin()), end


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[ItemBlock]:
    held: list[tuple[object, str]] = []
    size = 0
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").toLocalIterator():
        held.append((row.item_id, row.text))
        size += len(row.text)
        if size >= block_chars:
            yield ItemBlock(held)
            held, size = [], 0
    if held:
        yield ItemBlock(held)


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, edits, start, end): the best region of every leaked item in every row.

    ``start`` and ``end`` count characters of the text with white-space runs as one space.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    doc_kind = docs.schema["doc_id"].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {doc_kind}, item_id {item_kind}, edits int, start int, end int"
    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]
    spark.createDataFrame([], schema).write.mode("append").parquet(scratch.path("found"))
    for block in _blocks(benchmark, block_chars):
        sent = spark.sparkContext.broadcast(block)  # about 60 bytes per character of the block

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = sent.value
            for batch in batches:
                rows, out = [], []
                for i, text in enumerate(batch.column(1)):
                    for item, (edits, start, end) in index.find(normalise(text.as_py() or "")).items():
                        for item_id in index.ids[item]:
                            rows.append(i)
                            out.append((item_id, edits, start, end))
                columns = list(zip(*out)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], item_type),
                     *[pa.array(c, pa.int32()) for c in columns[1:]]],
                    names=["doc_id", "item_id", "edits", "start", "end"])

        (docs.select("doc_id", "text").mapInArrow(run, schema)
         .write.mode("append").parquet(scratch.path("found")))
        sent.destroy()
    return scratch.read(schema, "found")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    leaked = find_leaks(docs, benchmark).select(F.col("doc_id").alias("_leaked")).distinct()
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    clean = packed.join(leaked, F.col("row.doc_id").eqNullSafe(F.col("_leaked")), "left_anti")
    return clean.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                      spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
