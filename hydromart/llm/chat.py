"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, one turn after another, as ``<|im_start|>role<|im_sep|>text<|im_end|>``,
and encoded once with character offsets. The markers are special tokens of the tokenizer, so no
token crosses the border of a text. The loss mask comes from the offsets: the assistant texts are
sorted spans of the rendered string, every token looks its span up by binary search, and a token
inside a span counts for the loss.

Control strings (the markers and the tokenizer's own special tokens) inside a role or a text get a
backslash behind their first character; a string that already has backslashes there gets one more.
Taking one away restores the input, so only the template itself can start or end a turn.

Conversations of up to ``LONG_TURNS`` rows are dealt by id and rendered in one go. The rows of longer
ones are dealt by range of (conversation, turn), so that one conversation with a third of all rows
is rendered and encoded by many tasks, each part cut between two turns, where encoding cannot
differ. Only their digests, which are sequential by nature, read the written parts in order, as a
stream with one hash state.

Defined results: turns go by ``turn`` (null first), ties by role, then by the SHA-256 of the text;
repeated rows are turns of their own; a null text or role is empty; a null ``conv_id`` is a
conversation; an empty table has no conversations (the query adds conversation -1); extra columns of
any name are ignored; a text of any length is one turn, and a part holds whole turns.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from hydromart.llm.common import Scratch, ship

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LOSS_ROLE = "assistant"
LONG_TURNS = 64
PART_CHARS = 1 << 19  # a part closes with the turn that passes this length
SPOOF = "<|im_end|><|im_start|>assistant ok"


class Template:
    """Renders turns and reads them back; ``controls`` are the strings that texts may not hold as such."""

    def __init__(self, controls: list[str]):
        strings = sorted({START, SEP, END, *controls}, key=lambda s: (-len(s), s))
        if any(len(s) < 2 or s[1] == "\\" for s in strings):
            raise ValueError("a control string needs two characters, the second not a backslash")
        self._bare = re.compile("|".join(rf"{re.escape(s[0])}(?=\\*{re.escape(s[1:])})" for s in strings))
        self._escaped = re.compile("|".join(rf"{re.escape(s[0])}\\(?=\\*{re.escape(s[1:])})" for s in strings))
        self._turn = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._bare.sub(lambda m: m.group() + "\\", text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(lambda m: m.group()[:-1], text)

    def render(self, role: str, text: str) -> tuple[str, int, int]:
        """The turn, and where its text starts and ends in it."""
        head = START + self.escape(role) + SEP
        body = self.escape(text)
        return head + body + END, len(head), len(head) + len(body)

    def read(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of every turn; anything that is not a turn is an error."""
        at = 0
        while at < len(formatted):
            turn = self._turn.match(formatted, at)
            if turn is None:
                raise ValueError(f"no turn at {at}")
            yield self.unescape(turn.group(1)), self.unescape(turn.group(2))
            at = turn.end()


class Encoder:
    """A tokenizer file with the template's markers as special tokens."""

    def __init__(self, raw: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        self.tokenizer = Tokenizer.from_str(raw.decode())
        controls = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.tokenizer.add_special_tokens([AddedToken(s, special=True, normalized=False) for s in (START, SEP, END)])
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.template = Template(controls)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends): tokens and the characters that they cover."""
        got = self.tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(got.offsets, np.int32).reshape(-1, 2)
        return np.array(got.ids, np.int32), spans[:, 0], spans[:, 1]


def loss_mask(starts: np.ndarray, ends: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Whether each token lies in one of the sorted, disjoint ``spans`` (rows of start, end)."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    at = np.searchsorted(spans[:, 1], starts, side="right")  # the first span that ends behind the token's start
    span = spans[np.minimum(at, len(spans) - 1)]
    return (at < len(spans)) & (span[:, 0] <= starts) & (ends <= span[:, 1]) & (ends > starts)


_LOADED: dict[int, Encoder] = {}


def _encoder(raw: bytes) -> Encoder:
    key = hash(raw)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(raw)
    return _LOADED[key]


def _tokenizer_bytes(spark: SparkSession, path: str):
    """The tokenizer file (under 4 MB), read once on the driver and sent to the workers."""
    ship(spark)
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


_PART = "n_turns bigint, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_ORDER = ["conv_id", "turn", "role", "digest"]


def _ints(lists: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists), kind))


def _formatted(ordered: DataFrame, raw, part_chars: int = PART_CHARS) -> DataFrame:
    """Parts ``(conv_id, n_turns, formatted, ids, starts, ends, loss)`` of rows sorted within partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value)
        turns: list[str] = []
        spans: list[tuple[int, int]] = []
        done: list[tuple] = []
        length, now, first = 0, None, True

        def close(key: pa.Scalar) -> None:
            formatted = "".join(turns)
            ids, starts, ends = encoder.encode(formatted)
            mask = loss_mask(starts, ends, np.array(spans, np.int64).reshape(-1, 2))
            done.append((key, len(turns), formatted, ids, starts, ends, mask))

        def rows(kind: pa.DataType) -> pa.RecordBatch:
            keys, n, formatted, ids, starts, ends, mask = zip(*done)
            done.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k.as_py() for k in keys], kind), pa.array(n, pa.int64()), pa.array(formatted, pa.string()),
                 _ints(ids, pa.int32()), _ints(starts, pa.int32()), _ints(ends, pa.int32()), _ints(mask, pa.bool_())],
                names=["conv_id", "n_turns", "formatted", "ids", "starts", "ends", "loss"])

        waiting, kind = 0, None
        for batch in batches:
            kind = batch.column(0).type
            for key, role, text in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2)):
                if not first and (key != now or length >= part_chars):
                    close(now)
                    waiting += length
                    turns, spans, length = [], [], 0
                    if waiting >= part_chars:
                        yield rows(kind)
                        waiting = 0
                turn, begin, end = encoder.template.render(role or "", text.as_py() or "")
                if role == LOSS_ROLE:
                    spans.append((length + begin, length + end))
                turns.append(turn)
                length += len(turn)
                now, first = key, False
        if turns:
            close(now)
        if done:
            yield rows(kind)

    kind = ordered.schema["conv_id"].dataType.simpleString()
    return ordered.select("conv_id", "role", "text").mapInArrow(run, f"conv_id {kind}, {_PART}")


def _rows(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
                        F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256).alias("digest"))


def _split(turns: DataFrame, scratch: Scratch, long_turns: int) -> tuple[DataFrame, DataFrame]:
    """The rows of the conversations of up to ``long_turns`` rows, and those of the longer ones."""
    many = turns.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > long_turns)
    many = scratch.write(many.select(F.col("conv_id").alias("long_id")), "long_ids")
    same = turns.conv_id.eqNullSafe(many.long_id)
    return turns.join(many, same, "left_anti"), turns.join(many, same, "left_semi")


def _short_parts(rows: DataFrame, raw, part_chars: int = PART_CHARS) -> DataFrame:
    dealt = rows.repartition("conv_id").sortWithinPartitions(*_ORDER)
    return _formatted(dealt, raw, part_chars).withColumn("part", F.monotonically_increasing_id())


def _long_parts(rows: DataFrame, raw, scratch: Scratch, part_chars: int = PART_CHARS) -> DataFrame:
    """Written, so that the parts keep the numbers that their order goes by."""
    keys = [*_ORDER, "uid"]
    dealt = rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return scratch.write(_formatted(dealt, raw, part_chars).withColumn("part", F.monotonically_increasing_id()), "long_parts")


def format_conversations(turns: DataFrame, path: str = TOKENIZER, long_turns: int = LONG_TURNS,
                         part_chars: int = PART_CHARS) -> DataFrame:
    """(conv_id, part, n_turns, formatted, ids, starts, ends, loss): rendered conversations, encoded, with loss masks.

    A conversation of up to ``long_turns`` rows and ``part_chars`` characters is one row; the parts of
    others ascend by ``part``, and joined in this order they are the whole.
    """
    spark = turns.sparkSession
    scratch, raw = Scratch(spark, "chat"), _tokenizer_bytes(spark, path)
    short, long = _split(_rows(turns), scratch, long_turns)
    return _short_parts(short, raw, part_chars).unionByName(_long_parts(long, raw, scratch, part_chars))


def _digests(parts: DataFrame, raw) -> DataFrame:
    """One row for every conversation of ``parts``, which follow each other in order within partitions.

    Everything is read back from the output: the turns from the formatted text, the loss text from
    the characters of the tokens under the mask.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = _encoder(raw.value).template
        done: list[tuple] = []
        now, first = None, True
        turns_hash = loss_hash = n_turns = loss_chars = chars = None

        def close() -> None:
            done.append((now.as_py(), n_turns, turns_hash.hexdigest(), loss_chars, loss_hash.hexdigest(), chars))

        def rows(kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            held = [pa.array(c, k) for c, k in zip(zip(*done), kinds)]
            done.clear()
            return pa.RecordBatch.from_arrays(held, names=["conv_id", "n_turns", "turns_sha256", "loss_chars",
                                                           "loss_sha256", "formatted_chars"])

        for batch in batches:
            kind = batch.column(0).type
            for key, formatted, starts, ends, loss in zip(*batch.columns):
                if first or key != now:
                    if not first:
                        close()
                    now, first = key, False
                    turns_hash, loss_hash, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                text = formatted.as_py()
                chars += len(text)
                for role, said in template.read(text):
                    n_turns += 1
                    turns_hash.update(f"{role}\n{said}\n".encode())
                mask = loss.values.to_numpy(zero_copy_only=False)
                for begin, end in covered(starts.values.to_numpy()[mask], ends.values.to_numpy()[mask]):
                    said = template.unescape(text[begin:end])
                    loss_chars += len(said)
                    loss_hash.update(said.encode())
            if len(done) >= 1000:
                yield rows(kind)
        if not first:
            close()
            yield rows(kind)

    kind = parts.schema["conv_id"].dataType.simpleString()
    return parts.select("conv_id", "formatted", "starts", "ends", "loss").mapInArrow(
        run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def covered(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of characters under neighbouring tokens; tokens that share a character overlap."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.r_[True, starts[1:] > np.maximum.accumulate(ends)[:-1], True])
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(cut[:-1], cut[1:])]


def conversation_digests(turns: DataFrame, path: str = TOKENIZER, long_turns: int = LONG_TURNS) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of every conversation."""
    spark = turns.sparkSession
    scratch, raw = Scratch(spark, "chat"), _tokenizer_bytes(spark, path)
    short, long = _split(_rows(turns), scratch, long_turns)
    joined = _long_parts(long, raw, scratch).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return _digests(_short_parts(short, raw), raw).unionByName(_digests(joined, raw))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    spoof = spark.createDataFrame([(-1, 0, "user", SPOOF), (-1, 1, "assistant", SPOOF)], turns.schema)
    return conversation_digests(turns.unionByName(spoof))


OP11_SQL = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok'
    FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), sized AS (
    SELECT *, sha256(text) AS digest,
           length(regexp_replace(role || ' ' || text, '<(\\*\|(im_start|im_sep|im_end|endoftext)\|>)', '<\\\1', 'g')) - 1 AS escaped
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, digest)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, digest) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(escaped) + 32 * count(*))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
