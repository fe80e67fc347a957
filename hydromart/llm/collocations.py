"""Phrase collocation mining by vertical partitioning of the word suffix tree.

Texts are cut into pieces at punctuation and line ends, pieces into words. Every word position
starts a suffix of its piece, truncated to five words. The suffix tree of all of them is never
built whole: prefixes are dealt to groups by a memory budget, and each group's subtrees are built
independently.

1. One scan counts the words, the prefixes of one word. A word below the threshold ends every
   suffix, because no phrase that holds it can reach the threshold. Which words do reach it is
   known to the tasks from a bitmap of fixed size: a hash that falls on a foreign bit only lets a
   suffix run longer, no phrase is lost.
2. Prefixes are hashed to buckets and the loads of the buckets (16 for each group) are packed into
   groups of at most twice the budget. A bucket over the budget is dealt by prefixes that are one word longer;
   a further scan counts those, and so on to five words.
3. Equal suffixes are added up before the shuffle; the rest of a window of text travels as one
   packed row for each group. A group's tree is built level by level from the root, only below
   nodes that reach the threshold, and a node's count is the sum of the leaf totals under it.
   Nodes above a group's own prefixes are partial and added up afterwards.

A phrase's score is that of its weakest cut. Products are decimals of 38 digits.

Defined results: null or empty text has no words; a null ``lang`` is ``und``; repeated rows count
each time; ties in score and count go by the bytes of the phrase; an empty table gives no rows;
only ``text`` and ``lang`` are read, so extra columns of any name are ignored. A piece of any
length is one sequence, phrases never leave their piece, and empty words do not exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydromart.llm.common import (BASE_A, BASE_B, Scratch, join_words, mix64, partitions, range_hash, ship, text_chunks)

MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
SUBSUMED_PERCENT = 100
SUBTREE_BUDGET = 1 << 19  # suffixes of a group: the memory of one subtree
BUCKETS_PER_GROUP = 16
GROUPS_PER_TASK = 2
FILTER_BITS = 1 << 26  # the bitmap of words that reach the threshold: 8 MB at any size
WINDOW_SUFFIXES = 1 << 19  # suffixes that a task adds up before it sends them

_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lang_hash: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every word, each with its language."""
    return (mix64(range_hash(data, starts, ends, BASE_A) ^ lang_hash), mix64(range_hash(data, starts, ends, BASE_B) + lang_hash))


class Words:
    """The words of one chunk of texts: places, pieces and hashes that include the language."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lang_hash: np.ndarray):
        lower = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        ends_piece = _BREAK[lower]
        inside = ~(_GAP[lower] | ends_piece)
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.r_[False, inside[:-1]] & ~edge[:-1] if len(data) else inside
        after = np.r_[inside[1:], False] & ~edge[1:] if len(data) else inside
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.cumsum(ends_piece)[starts] if len(starts) else starts
        self.raw, self.at = join_words(lower, starts, ends)
        self.size = ends - starts
        self.h1, self.h2 = word_hashes(np.frombuffer(self.raw, np.uint8), self.at, self.at + self.size, lang_hash[self.doc])
        self.follows = np.zeros(len(starts), bool)  # the next word belongs to the same piece
        if len(starts):
            self.follows[:-1] = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])

    def reach(self, bitmap: np.ndarray) -> np.ndarray:
        """Words of the truncated suffix at every position, 0 where it starts with a rare word."""
        bit = self.h1 & np.uint64(FILTER_BITS - 1)
        often = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1
        often = often.astype(bool)
        link = self.follows.copy()
        link[:-1] &= often[:-1] & often[1:]
        length, run = often.astype(np.int64), link.copy()
        for step in range(1, MAX_WORDS):
            length += run
            shifted = np.zeros_like(link)
            shifted[:-step] = link[step:]
            run &= shifted
        return length

    def keys(self, second: bool = False) -> Iterator[np.ndarray]:
        """Hash of the first word, two words, ... at every position (the last positions wrap round)."""
        h = self.h2 if second else self.h1
        key = h
        for step in range(1, MAX_WORDS + 1):
            yield key
            key = mix64(key * _STEP + np.roll(h, -step))

    def suffixes(self, rows: np.ndarray, length: np.ndarray) -> pa.Array:
        last = rows + length - 1
        starts, ends = self.at[rows], self.at[last] + self.size[last]
        return take_bytes(np.frombuffer(self.raw, np.uint8), starts, ends)


def take_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The slices ``data[starts[i]:ends[i]]`` as an array of binary values."""
    size = ends - starts
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    held = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], size)]
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(held)])


def bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of an array of large binary values, without copying."""
    _, at, held = values.buffers()
    offsets = np.frombuffer(at, np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def equal_runs(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal (h1, h2) are neighbours, and where each run of equals starts."""
    order = np.argsort(h1, kind="stable")
    a, b = h1[order], h2[order]
    other = b[1:] != b[:-1]
    if (other & (a[1:] == a[:-1])).any():  # two names share one hash
        order = np.lexsort((h2, h1))
        a, b = h1[order], h2[order]
        other = b[1:] != b[:-1]
    return order, np.flatnonzero(np.r_[True, other | (a[1:] != a[:-1])]) if len(a) else order


class Pool:
    """Counted strings with their hashes; equal ones are added up when it is compacted."""

    def __init__(self):
        self.texts: list[pa.Array] = []
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, texts: pa.Array, *columns: np.ndarray) -> None:
        if len(texts):
            self.texts.append(texts)
            self.parts.append(columns)
            self.rows += len(texts)

    def columns(self) -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*self.parts)]

    def all(self) -> pa.Array:
        return pa.concat_arrays(self.texts)

    def compact(self) -> None:
        """Add up equal strings of a pool whose columns are (h1, h2, n, any others)."""
        h1, h2, n, *others = self.columns()
        order, heads = equal_runs(h1, h2)
        first = order[heads]
        self.parts = [(h1[first], h2[first], np.add.reduceat(n[order], heads), *[c[first] for c in others])]
        self.texts, self.rows = [self.all().take(pa.array(first))], len(first)


class Langs:
    """Language codes of one task: numbers, names and 64-bit hashes."""

    def __init__(self):
        self.number: dict[str, int] = {}

    def codes(self, column: pa.Array) -> np.ndarray:
        names = column.dictionary_encode()
        table = [self.number.setdefault("und" if v is None else v, len(self.number)) for v in names.dictionary.to_pylist()]
        table.append(self.number.setdefault("und", len(self.number)))
        at = names.indices.fill_null(len(table) - 1).to_numpy(zero_copy_only=False)
        return np.array(table, np.int64)[at]

    def hashes(self) -> np.ndarray:
        held = [np.frombuffer(name.encode() + b"\n", np.uint8) for name in self.number]
        return np.array([range_hash(v, np.array([0]), np.array([len(v)]), BASE_B)[0] for v in held], np.uint64)

    def names(self) -> np.ndarray:
        return np.array(list(self.number), dtype=object)


def _chunks(batches: Iterator[pa.RecordBatch], langs: Langs) -> Iterator[tuple[Words, np.ndarray]]:
    """(words, language number of each document) of bounded stretches of ``(text, lang)``."""
    for rows, data, offsets in text_chunks(batches):
        code = langs.codes(rows.column(1))
        yield Words(data, offsets, langs.hashes()[code]), code


def _source(docs: DataFrame) -> DataFrame:
    return docs.select("text", F.col("lang").cast("string").alias("lang"))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n): occurrences of every word."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, pool = Langs(), Pool()

        def rows() -> pa.RecordBatch:
            pool.compact()
            _, _, n, code = pool.columns()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs.names()[code], pa.string()), pool.all().cast(pa.binary()).cast(pa.string()), pa.array(n)],
                names=["lang", "word", "n"])

        for words, code in _chunks(batches, langs):
            order, heads = equal_runs(words.h1, words.h2)
            if not len(heads):
                continue
            first = order[heads]
            pool.add(words.suffixes(first, np.ones(len(first), np.int64)), words.h1[first], words.h2[first],
                     np.diff(np.r_[heads, len(order)]), code[words.doc[first]])
            if pool.rows >= WINDOW_SUFFIXES:
                pool.compact()
                if pool.rows >= WINDOW_SUFFIXES // 2:
                    yield rows()
                    pool = Pool()
        if pool.rows:
            yield rows()

    counted = _source(docs).mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def with_hashes(words: DataFrame) -> DataFrame:
    """``words`` with ``h``, the hash that the tasks know a word by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = Langs()
        for batch in batches:
            if not batch.num_rows:
                continue
            code = langs.codes(batch.column(0))
            data, offsets = bytes_of(batch.column(1).cast(pa.large_binary()))
            h1, _ = word_hashes(data, offsets[:-1], offsets[1:], langs.hashes()[code])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(h1.view(np.int64))], names=["lang", "word", "n", "h"])

    return words.select("lang", "word", "n").mapInArrow(run, "lang string, word string, n bigint, h bigint")


def frequent_bitmap(words: DataFrame) -> np.ndarray:
    """The bits of the words' hashes; ``FILTER_BITS`` / 8 bytes whatever the number of words."""
    bit = F.col("h").bitwiseAND(FILTER_BITS - 1)
    rows = (words.select(F.bitmap_bucket_number(bit + 1).alias("part"), F.bitmap_bit_position(bit + 1).alias("bit"))
            .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        at = (row.part - 1) * len(row.bits)
        out[at:at + len(row.bits)] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


class Deal:
    """Prefix buckets and their groups, for prefixes of one word and, where those are too many, more."""

    def __init__(self, buckets: int, budget: int):
        self.buckets, self.budget = buckets, budget
        self.group: list[np.ndarray] = []  # by depth: group of a bucket, -1 where a longer prefix decides
        self.depth_of: list[int] = []  # depth of a group's prefixes

    def add(self, loads: np.ndarray) -> bool:
        """Pack the buckets of the next depth; true when some must be dealt by a longer prefix."""
        depth = len(self.group) + 1
        longer = (loads > self.budget) & (depth < MAX_WORDS)
        filled = np.where(longer, 0, loads)
        packed = (np.cumsum(filled) - filled) // self.budget
        self.group.append(np.where(longer, -1, packed + len(self.depth_of)))
        self.depth_of += [depth] * int(packed.max(initial=0) + 1)
        return bool(longer.any())

    def assign(self, words: Words, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(group, bucket of the next depth) of every position; group -1 where that bucket decides.

        A suffix too short for a depth keeps what it has as its prefix there.
        """
        group = np.full(len(reach), -1, np.int64)
        open_, bucket, own = reach >= 2, np.zeros(len(reach), np.int64), words.h1
        for depth, key in enumerate(words.keys(), 1):
            own = np.where(reach >= depth, key, mix64(own + np.uint64(depth)))
            bucket = (own % np.uint64(self.buckets)).astype(np.int64)
            if depth > len(self.group):
                break
            got = self.group[depth - 1][bucket]
            group = np.where(open_, got, group)
            open_ &= got < 0
            if not open_.any():
                break
        return group, bucket


def deal_prefixes(docs: DataFrame, words: DataFrame, bitmap, budget: int) -> Deal:
    """Groups of prefixes by the budget; one more scan for every depth that needs longer prefixes."""
    spark = docs.sparkSession
    total = words.agg(F.sum("n")).first()[0] or 0
    deal = Deal(max(1 << 12, BUCKETS_PER_GROUP * -(-total // budget)), budget)
    buckets = deal.buckets

    def dense(counted: DataFrame) -> np.ndarray:
        loads = np.zeros(buckets, np.int64)
        for row in counted.collect():  # one number a bucket
            loads[row.bucket] = row.n
        return loads

    def unsigned_mod(h):
        """The remainder of the 64-bit pattern read as unsigned, in exact long arithmetic."""
        high = F.pmod(F.shiftrightunsigned(h, 1), F.lit(buckets))
        return F.pmod(high * 2 + F.col("h").bitwiseAND(1), F.lit(buckets))

    more = deal.add(dense(words.groupBy(unsigned_mod("h").alias("bucket")).agg(F.sum("n").alias("n"))))
    while more:
        held = spark.sparkContext.broadcast((bitmap.value, deal))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequent, so_far = held.value
            loads = np.zeros(so_far.buckets, np.int64)
            for chunk, _ in _chunks(batches, Langs()):
                reach = chunk.reach(frequent)
                group, bucket = so_far.assign(chunk, reach)
                loads += np.bincount(bucket[(group < 0) & (reach >= 2)], minlength=so_far.buckets)
            some = np.flatnonzero(loads)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(loads[some])], names=["bucket", "n"])

        counted = _source(docs).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
        more = deal.add(dense(counted))
    return deal


def packed_suffixes(docs: DataFrame, bitmap, deal) -> DataFrame:
    """(grp, lang, body, sizes, counts): a window's distinct suffixes of one group, packed in one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, pool = Langs(), Pool()

        def rows() -> pa.RecordBatch:
            h1, h2, group, code, first_word, two_words = pool.columns()
            # by group and language, then by words, so that neighbours share what they begin with and equals mostly meet
            low, apart = np.uint64(0xFFFF), group * len(langs.number) + code
            order = np.argsort((apart.astype(np.uint64) << np.uint64(40)) | ((first_word & low) << np.uint64(24))
                               | ((two_words & np.uint64(0xFFF)) << np.uint64(12)) | (h1 & np.uint64(0xFFF)), kind="stable")
            g, c, a, b = group[order], code[order], h1[order], h2[order]
            other = np.r_[True, (g[1:] != g[:-1]) | (c[1:] != c[:-1])]
            heads = np.flatnonzero(other | np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            n = np.diff(np.r_[heads, len(order)]).astype("<i4")
            data, offsets = bytes_of(pool.all().take(pa.array(order[heads])))
            starts = np.flatnonzero(other[heads])
            cuts = np.r_[starts, len(heads)]
            return pa.RecordBatch.from_arrays(
                [pa.array(g[heads[starts]]), pa.array(langs.names()[c[heads[starts]]], pa.string()),
                 _packed(data, offsets[cuts]), _packed(np.diff(offsets).astype("<i4").view(np.uint8), 4 * cuts),
                 _packed(n.view(np.uint8), 4 * cuts)], names=["grp", "lang", "body", "sizes", "counts"])

        for words, code in _chunks(batches, langs):
            reach = words.reach(bitmap.value)
            at = np.flatnonzero(reach >= 2)
            if not len(at):
                continue
            group, _ = deal.value.assign(words, reach)
            h1, h2, two_words = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64), None
            for length, (one, two) in enumerate(zip(words.keys(), words.keys(second=True)), 1):
                these = reach[at] == length
                h1[these], h2[these] = one[at[these]], two[at[these]] + np.uint64(length)
                two_words = one[at] if length == 2 else two_words
            pool.add(words.suffixes(at, reach[at]), h1, h2, group[at], code[words.doc[at]], words.h1[at], two_words)
            if pool.rows >= WINDOW_SUFFIXES:
                yield rows()
                pool = Pool()
        if pool.rows:
            yield rows()

    return _source(docs).mapInArrow(run, "grp bigint, lang string, body binary, sizes binary, counts binary")


_CODEC = pa.Codec("zstd", 1)


def _packed(data: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The stretches of ``data`` between ``cuts``, each compressed, with its length in front."""
    held = memoryview(np.ascontiguousarray(data))
    return pa.array([int(b - a).to_bytes(8, "little") + _CODEC.compress(held[a:b], asbytes=True)
                     for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())], pa.binary())


def _unpacked(value: pa.Scalar) -> pa.Buffer:
    held = value.as_buffer()
    return _CODEC.decompress(held[8:], int.from_bytes(held[:8].to_pybytes(), "little"))


def subtree(texts: pa.Array, n: np.ndarray, own_depth: int, min_count: int) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(depth, prefixes, counts) of the nodes of two words and more that reach the threshold.

    A node is its parent and one more word; the leaves under it become neighbours, and its count is
    the sum of their totals. Nodes above ``own_depth`` are given whatever their count, because other
    groups hold more of them.
    """
    data, offsets = bytes_of(texts)
    rows = np.arange(len(texts))
    starts, limit = offsets[:-1], offsets[1:]
    spaces = np.flatnonzero(data == 0x20)
    last = np.searchsorted(spaces, limit)  # behind each row's last space
    at = np.searchsorted(spaces, starts)
    spaces = np.r_[spaces, 0]

    def word_end(these: np.ndarray, word: int) -> np.ndarray:
        place = at[these] + word
        return np.where(place < last[these], spaces[np.minimum(place, len(spaces) - 1)], limit[these])

    node, begin = np.zeros(len(rows), np.uint64), starts
    for depth in range(1, MAX_WORDS + 1):
        end = word_end(rows, depth - 1)
        h1, h2 = slice_hashes(data, begin, end)
        order, heads = equal_runs(mix64(h1 ^ node), mix64(h2 + node))
        size = np.diff(np.r_[heads, len(order)])
        count = np.add.reduceat(n[rows][order], heads) if len(heads) else size
        good = (count >= min_count) | (depth < own_depth)
        first = order[heads[good]]
        if depth > 1 and len(first):
            yield depth, take_bytes(data, starts[rows[first]], end[first]), count[good]
        named = np.repeat(np.cumsum(good), size)  # nodes are numbered, so that a parent is known exactly
        kept = order[np.repeat(good, size)]
        node = mix64(named[np.repeat(good, size)].astype(np.uint64))
        longer = end[kept] < limit[rows[kept]]
        kept, node = kept[longer], node[longer]
        rows, begin = rows[kept], end[kept] + 1
        if not len(rows):
            return


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every ``data[start:end]``, with scratch memory for ``block`` slices."""
    out = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
    for at in range(0, len(starts), block):
        part = slice(at, at + block)
        held, offsets = bytes_of(take_bytes(data, starts[part], ends[part]))
        for hashes, base in zip(out, (BASE_A, BASE_B)):
            hashes[part] = range_hash(held, offsets[:-1], offsets[1:], base)
    return out


def count_phrases(docs: DataFrame, words: DataFrame, scratch: Scratch, min_count: int = MIN_COUNT,
                  budget: int = SUBTREE_BUDGET) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of one to five words with at least ``min_count`` occurrences."""
    spark = docs.sparkSession
    often = scratch.write(with_hashes(words.where(F.col("n") >= min_count)), "often")
    bitmap = spark.sparkContext.broadcast(frequent_bitmap(often))
    plan = deal_prefixes(docs, often, bitmap, budget)
    deal = spark.sparkContext.broadcast(plan)
    tasks = max(partitions(spark), len(plan.depth_of) // GROUPS_PER_TASK)

    def nodes(held: Pool, lang: str, group: int) -> Iterator[pa.RecordBatch]:
        for depth, phrases, n in subtree(held.all(), held.columns()[-1], deal.value.depth_of[group], min_count):
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), phrases.cast(pa.binary()).cast(pa.string()),
                 pa.array(np.full(len(n), depth, np.int32)), pa.array(n)], names=["lang", "phrase", "words", "n"])

    def compacted(held: Pool) -> Pool:
        """Copies of equal suffixes from many windows, added up."""
        data, offsets = bytes_of(held.all())
        out = Pool()
        out.add(held.all(), *slice_hashes(data, offsets[:-1], offsets[1:]), held.columns()[-1])
        out.compact()
        out.parts = [out.parts[0][2:]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool, now, limit = Pool(), None, 2 * budget
        for batch in batches:
            for group, lang, body, sizes, counts in zip(*batch.columns):
                if (group.as_py(), lang.as_py()) != now:
                    if now is not None:
                        yield from nodes(pool, now[1], now[0])
                    pool, now, limit = Pool(), (group.as_py(), lang.as_py()), 2 * budget
                size = np.frombuffer(_unpacked(sizes), "<i4").astype(np.int64)
                offsets = np.zeros(len(size) + 1, np.int64)
                np.cumsum(size, out=offsets[1:])
                pool.add(pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), _unpacked(body)]),
                         np.frombuffer(_unpacked(counts), "<i4").astype(np.int64))
                if pool.rows > limit:
                    pool = compacted(pool)
                    limit = 2 * max(budget, pool.rows)
        if now is not None:
            yield from nodes(pool, now[1], now[0])

    packed = packed_suffixes(docs, bitmap, deal)
    found = (packed.repartition(tasks, "grp").sortWithinPartitions("grp", "lang")
             .mapInArrow(run, "lang string, phrase string, words int, n bigint")
             .groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    ones = often.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    return scratch.write(ones.unionByName(found), "phrases")


def score_phrases(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of every phrase of two words and more, at its weakest cut."""
    count = phrases.select("lang", "phrase", F.col("n").alias("f"))
    cuts = (phrases.where("words >= 2").withColumn("part", F.split("phrase", " "))
            .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .select("lang", "phrase", "words", F.col("n").alias("a"), "k",
                    F.array_join(F.slice("part", F.lit(1), F.col("k")), " ").alias("head"),
                    F.array_join(F.slice("part", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("tail")))
    heads = count.withColumnsRenamed({"phrase": "head", "f": "l"})
    tails = count.withColumnsRenamed({"phrase": "tail", "f": "r"})
    big = "decimal(19,0)"
    scored = (cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang")
              .withColumn("score", F.expr(f"(cast(a as {big}) * cast(n as {big}) * 1000) div (cast(l as {big}) * cast(r as {big}))")))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    return (scored.groupBy("lang", "phrase", "words", "a", "n").agg(weakest)
            .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "n", "cut.score"))


def without_subsumed(scored: DataFrame, percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """Phrases that no longer phrase holds with at least ``percent`` of their occurrences."""
    inner = (scored.where("words >= 3").withColumn("part", F.split("phrase", " "))
             .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
             .withColumn("from", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
             .select("lang", F.array_join(F.slice("part", F.col("from"), F.col("size")), " ").alias("phrase"),
                     F.col("a").alias("longer"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    return (scored.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * percent)).drop("longer"))


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, budget: int = SUBTREE_BUDGET) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases."""
    scratch = Scratch(docs.sparkSession, "collocations")
    words = scratch.write(word_counts(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    phrases = count_phrases(docs, words, scratch, min_count, budget)
    scored = scratch.write(score_phrases(phrases, totals), "scored")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (without_subsumed(scored).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH pieces AS (
    SELECT lang, words FROM (
        SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS words FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\n\x0b\x0c\r]')) AS piece
            FROM documents))
    WHERE len(words) > 0
), grams AS (
    SELECT lang, size, array_to_string(words[i:i + size - 1], ' ') AS phrase
    FROM (SELECT lang, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i
          FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(words) >= size)
), totals AS (
    SELECT lang, count(*) AS n FROM grams WHERE size = 1 GROUP BY lang
), counts AS (
    SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
    SELECT c.lang, c.phrase, c.size, c.f AS a, k, n,
           array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS head,
           array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS tail
    FROM counts c JOIN totals USING (lang), (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < c.size
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.size, a, k, h.f AS l, t.f AS r, n,
           (1000::HUGEINT * a * n // (h.f::HUGEINT * t.f))::BIGINT AS score
    FROM cuts JOIN counts h ON h.lang = cuts.lang AND h.phrase = head
              JOIN counts t ON t.lang = cuts.lang AND t.phrase = tail
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM weakest w WHERE NOT EXISTS (
        SELECT 1 FROM counts c WHERE c.lang = w.lang AND c.size > w.size AND c.f >= w.a
        AND contains(' ' || c.phrase || ' ', ' ' || w.phrase || ' '))
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM kept
)
SELECT * FROM ranked WHERE rank <= 2000
"""
