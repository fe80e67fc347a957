"""BPE encoding and decoding with forced boundaries.

Two neighbouring symbols that stand side by side inside no vocabulary token can never be merged
into one, so every such place is a certain cut. The words of a whole stretch of texts are cut at
once, by two tables over pairs of bytes (inside a word, and at its end). Each distinct fragment is
encoded once by the ranked merges, and the ids of all occurrences are gathered from the fragments'
codes. Distinct fragments are few (about 30 thousand over 4 million words of the given texts); a
worker keeps their ids up to ``TABLE_IDS``.

Normalisation and word splitting follow the tokenizer file's own declared steps: NFC, white space
runs to one space, lower case per character, words by its pattern, bytes by the byte-level
alphabet, ``</w>`` on the last symbol of a word. The special tokens are found in the raw text.

Defined results: null text is empty and gives no ids; repeated rows each get their ids; an empty
table gives no rows; extra columns of any name are ignored (``key`` and ``text`` are read).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import ship, text_chunks

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = "</w>"
TABLE_IDS = 1 << 20  # ids of the fragments kept per worker: the table is emptied between two stretches beyond it
STRETCH = 1 << 21  # characters that are cut and encoded at once
WORD_CLASSES = [r"[\p{L}]+", r"[\p{N}]", r"[^\s\p{L}\p{N}]+"]  # fixed values of the file's word pattern
_MARK = 0xFF  # behind the last byte of a word; no UTF-8 text holds it


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in plain else spare))
        spare += byte not in plain
    return out


def char_classes() -> np.ndarray:
    """For every code point: 0 white space, 1 letter, 2 number, 3 other."""
    every = "".join(map(chr, range(0x110000)))
    out = np.full(len(every), 3, np.uint8)
    for kind, pattern in enumerate((r"\p{White_Space}+", r"\p{L}+", r"\p{N}+")):
        for run in regex.finditer(pattern, every):
            out[run.start():run.end()] = kind
    return out


class Fragments:
    """Ids of the fragments seen so far, one behind the other, with a dictionary of their places."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.lists: list[list[int]] = []
        self.held = 0
        self._flat = self._starts = self._sizes = None

    def add(self, fragment: bytes, ids: list[int]) -> int:
        self.place[fragment] = at = len(self.lists)
        self.lists.append(ids)
        self.held += len(ids)
        self._flat = None
        return at

    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start of each fragment's ids, number of its ids)."""
        if self._flat is None:
            self._sizes = np.fromiter(map(len, self.lists), np.int64, len(self.lists))
            self._starts = np.cumsum(self._sizes) - self._sizes
            self._flat = np.fromiter(chain.from_iterable(self.lists), np.int32, int(self._sizes.sum()))
        return self._flat, self._starts, self._sizes


class Bpe:
    """A tokenizer file's vocabulary and merges, with the table of certain cuts."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.ids: dict[str, int] = {**model["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.tokens = {i: t for t, i in self.ids.items()}
        special = [t["content"] for t in spec["added_tokens"]]
        self.special_ids = {s: self.ids[s] for s in special}
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        *suffixes, letters, numbers, others = split["pattern"]["Regex"].split("|")
        if [letters, numbers, others] != WORD_CLASSES or not all(x[0] == "'" and x[1:].isalpha() for x in suffixes):
            raise ValueError("word pattern: suffixes with an apostrophe, then letters, single numbers, and other runs")
        self.suffixes = [np.array([ord(c) for c in x[1:]], np.uint32) for x in suffixes]
        self.classes = char_classes()
        self.alphabet = byte_alphabet()
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank[self.ids[a], self.ids[b]] = rank
            self.made.append(self.ids[a + b])
        self.joined = set()  # symbol pairs that occur inside some token
        for token in model["vocab"]:
            last = token.endswith(END) and len(token) > len(END)
            chars = list(token[:-len(END)] if last else token)
            if last:
                chars[-1] += END
            self.joined.update(zip(chars, chars[1:]))
        # the same by bytes: pairs inside a word, and pairs whose second byte ends it
        pairs = [(a, b) for a in self.alphabet for b in self.alphabet]
        self.inner = np.array([pair in self.joined for pair in pairs])
        self.final = np.array([(a, b + END) in self.joined for a, b in pairs])
        self.fragments = Fragments()
        spelled = [self.tokens.get(i, "").encode() + b" " for i in range(max(self.tokens) + 1)]
        self.known = np.array([i in self.tokens for i in range(len(spelled))])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array([len(x) for x in spelled])
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size

    def merge(self, ids: list[int]) -> list[int]:
        """Ranked merges over one fragment, leftmost first among equals."""
        if len(ids) > 64:
            return self._merge_long(ids)
        get, made, none = self.rank.get, self.made, len(self.made)
        ranks = [get(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i:i + 2] = [made[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and links: n log n for fragments of any length."""
        n, get = len(ids), self.rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.made[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := get((ids[x], ids[y]))) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [i for i in ids if i >= 0]

    def fragment(self, fragment: bytes) -> list[int]:
        """Ids of one fragment; ``_MARK`` behind it says that it ends its word."""
        last = fragment[-1] == _MARK
        symbols = [self.alphabet[b] for b in (fragment[:-1] if last else fragment)]
        if last:
            symbols[-1] += END
        return self.merge([self.ids[s] for s in symbols])

    def word(self, word: str) -> list[int]:
        """Ids of one word: cut where no token spans the pair, encode the fragments, concatenate."""
        data = np.frombuffer(word.encode() + bytes([_MARK]), np.uint8)
        starts = self.cuts(data).tolist()
        return [i for a, b in zip(starts, [*starts[1:], len(data)]) for i in self.fragment(data[a:b].tobytes())]

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Starts of the fragments of words that each end with ``_MARK``: certain cuts and word starts."""
        ends_word = data == _MARK
        start = np.ones(len(data), bool)
        start[1:] = ends_word[:-1]
        if len(data) > 2:
            pair = data[:-2].astype(np.int32) * 256 + data[1:-1]
            apart = ~np.where(ends_word[2:], self.final[pair], self.inner[pair])
            start[1:-1] |= apart & ~ends_word[1:-1]
        return np.flatnonzero(start)

    def normal(self, text: str) -> str:
        """NFC and lower case per character: no final form of sigma. White space stays, words never cross it."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def split_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all words, each with ``_MARK`` behind it; words of each text) of normalised texts."""
        text = "\n".join(texts) + "\n"
        chars = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kind = self.classes[chars]
        start = kind > 0
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        # an apostrophe that starts a word and has letters behind it: a suffix of the pattern is a word with it
        marks = np.flatnonzero((chars == ord("'")) & start)
        marks = marks[kind[marks + 1] == 1]
        for suffix in self.suffixes:
            same = marks + len(suffix) < len(chars)
            for i, char in enumerate(suffix, 1):
                same[same] = chars[marks[same] + i] == char
            found, marks = marks[same], marks[~same]
            start[found + 1] = False
            behind = found + 1 + len(suffix)
            start[behind[kind[behind] == 1]] = True
        first = np.flatnonzero(start)
        ends = np.cumsum([len(t) + 1 for t in texts])
        n_words = np.diff(np.searchsorted(first, ends), prepend=0)
        inside = kind > 0
        if text.isascii():
            data = chars.astype(np.uint8)
        else:
            data = np.frombuffer(text.encode(), np.uint8)
            size = 1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF)
            inside = np.repeat(inside, size)
            byte_start = np.zeros(len(data), bool)
            byte_start[(np.cumsum(size) - size)[first]] = True
            start = byte_start
        word = np.cumsum(start[inside])
        out = np.full(len(word) + len(first), _MARK, np.uint8)
        out[np.arange(len(word)) + word - 1] = data[inside]
        return out, n_words

    def stretch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each text) of texts without special tokens: cut all, encode distinct fragments, gather."""
        data, n_words = self.split_words([self.normal(t) for t in texts])
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts = self.cuts(data)
        offsets = np.r_[starts, len(data)]
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        place = self.fragments.place
        at = np.array([i if (i := place.get(f)) is not None else self.fragments.add(f, self.fragment(f))
                       for f in coded.dictionary.to_pylist()])
        flat, first, size = self.fragments.arrays()
        at = at[coded.indices.to_numpy()]
        sizes = size[at]
        before = np.cumsum(sizes) - sizes
        ids = flat[np.arange(int(sizes.sum())) + np.repeat(first[at] - before, sizes)]
        if self.fragments.held > TABLE_IDS:
            self.fragments.clear()
        word_ends = np.flatnonzero(data == _MARK)
        word_fragments = np.searchsorted(starts, word_ends, side="right")  # fragments up to the end of each word
        ids_up_to = np.r_[0, np.cumsum(sizes)][np.r_[0, word_fragments]]
        return ids, np.diff(ids_up_to[np.r_[0, np.cumsum(n_words)]])

    def parts(self, text: str) -> Iterator[tuple[str, int]]:
        """Stretches of bounded length, each with the id of the special token behind it (-1: none).

        Special tokens are found in the raw text. Elsewhere a long text is cut before a blank: no
        word crosses it and nothing composes with it.
        """
        found = self.special.split(text) if self.special and any(s in text for s in self.special_ids) else [text]
        for i in range(0, len(found), 2):
            part, at = found[i], 0
            while len(part) - at > STRETCH:
                cut = max(part.rfind(" ", at + 1, at + STRETCH), part.rfind("\n", at + 1, at + STRETCH))
                if cut < 0:
                    cut = min((c for c in (part.find(" ", at + 1), part.find("\n", at + 1)) if c > 0), default=len(part))
                yield part[at:cut], -1
                at = cut
            yield part[at:], self.special_ids[found[i + 1]] if i + 1 < len(found) else -1

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts one behind the other, and where each text's start."""
        held: list[np.ndarray] = []
        row_of: list[int] = []
        counts: list[np.ndarray] = []
        waiting: list[str] = []
        behind: list[int] = []
        length = 0

        def flush() -> None:
            nonlocal length
            ids, n = self.stretch(waiting)
            after = np.array(behind)
            has = after >= 0
            held.append(np.insert(ids, np.cumsum(n)[has], after[has]) if has.any() else ids)
            counts.append(n + has)
            waiting.clear()
            behind.clear()
            length = 0

        for row, text in enumerate(texts):
            for part, special in self.parts(text):
                row_of.append(row)
                waiting.append(part)
                behind.append(special)
                length += len(part)
                if length >= STRETCH:
                    flush()
        if waiting:
            flush()
        total = np.zeros(len(texts), np.int64)
        if counts:
            np.add.at(total, np.array(row_of), np.concatenate(counts))
        return np.concatenate([np.zeros(0, np.int32), *held]).astype(np.int32), np.r_[0, np.cumsum(total)]

    def decode_all(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """The file declares no decoder: a row's tokens joined by one space; unknown ids are left out."""
        good = (ids >= 0) & (ids < len(self.known))
        good[good] = self.known[ids[good]]
        if not good.all():
            offsets = np.r_[0, np.cumsum(good)][offsets]
            ids = ids[good]
        size = self.spelled_size[ids]
        filled = offsets[1:] > offsets[:-1]
        size[offsets[1:][filled] - 1] -= 1  # no space behind a row's last token
        up_to = np.r_[0, np.cumsum(size)]
        text = self.spelled[np.arange(up_to[-1]) + np.repeat(self.spelled_at[ids] - up_to[:-1], size)]
        return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                     [None, pa.py_buffer(up_to[offsets]), pa.py_buffer(text)])

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_all(np.array(ids, np.int64), np.array([0, len(ids)]))[0].as_py()


_LOADED: dict[int, Bpe] = {}


def _model(raw: bytes) -> Bpe:
    key = hash(raw)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Bpe(raw)
    return _LOADED[key]


def _tokenizer_bytes(spark: SparkSession, path: str):
    """The tokenizer file (under 2 MB), read once on the driver and sent to the workers."""
    ship(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, key: str = "doc_id", path: str = TOKENIZER, decoded: bool = False) -> DataFrame:
    """(key, ids) per row; with ``decoded`` also the text that the ids decode to."""
    raw = _tokenizer_bytes(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(raw.value)
        for part, _, _ in text_chunks(batches, max_bytes=STRETCH):
            ids, offsets = bpe.encode_all(pc.fill_null(part.column(1), "").to_pylist())
            columns = [part.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))]
            if decoded:
                columns.append(bpe.decode_all(ids, offsets).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "decoded"][:len(columns)])

    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(F.col(key).alias("key"), "text").mapInArrow(
        run, f"key {kind}, ids array<int>" + (", decoded string" if decoded else ""))
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, key: str = "doc_id", path: str = TOKENIZER) -> DataFrame:
    """(key, text) per row of ``encoded(key, ids)``."""
    raw = _tokenizer_bytes(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(raw.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = pc.list_flatten(part.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
                size = pc.fill_null(pc.list_value_length(part.column(1)), 0).to_numpy().astype(np.int64)
                text = bpe.decode_all(ids, np.r_[0, np.cumsum(size)]).cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), text], names=["key", "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return (encoded.select(F.col(key).alias("key"), "ids").mapInArrow(run, f"key {kind}, text string")
            .withColumnRenamed("key", key))


def token_digests(docs: DataFrame, key: str = "doc_id", path: str = TOKENIZER) -> DataFrame:
    both = encode(docs, key, path, decoded=True)
    return both.select(
        key, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
