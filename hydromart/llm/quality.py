"""Quality classifier: supervised subword embeddings.

Every word, pair of neighbouring words, and run of 3 and 4 bytes is hashed into a table of learned
vectors (pairs of one word with itself share a vector, so repetition is seen in unknown words too);
a document is the average of its vectors, a softmax layer gives the class. The model is
trained by numpy stochastic gradient descent on a bounded sample of labelled rows. With two
classes the layer is linear, so scoring needs one number per table entry (1 MB for the workers)
and reads every byte of every text.

Defined results: null or empty text has no features and gets the score of the bias; repeated rows
get equal scores; labels that are null or repeated are ignored and merged (largest wins); an empty
table gives no rows; with no labelled rows, or labels of one kind only, the model is the share of
label 1 (0.5 without labels). Only ``doc_id`` and ``text`` are ever inputs of training, only
``text`` of a score; extra columns of any name pass through ``keep_good`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import BASE_A, range_hash, ship, text_chunks, word_spans

BUCKETS = 1 << 18
DIM = 8
SAMPLE_ROWS = 4000  # labelled rows that the model is fitted on, at most
EPOCHS = 6
RATE = 0.8
THRESHOLD = 0.3
REPEAT = 0  # the shared bucket of every word pair "x x", whatever x is
FOLDS = 5


def _ngrams(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the run of ``n`` bytes at every place where one fits in the buffer."""
    if len(data) < n:
        return np.zeros(0, np.int64)
    wide = data.astype(np.uint32)
    packed = wide[:len(data) - n + 1].copy()
    for k in range(1, n):
        packed |= wide[k:len(data) - n + 1 + k] << np.uint32(8 * k)
    mixed = (packed ^ (packed >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(n)
    return ((mixed ^ (mixed >> np.uint32(13))) * np.uint32(0xC2B2AE35) >> np.uint32(14)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, first, last): the features ``buckets[first[i]:last[i]]`` of every row, kind by kind."""
    for n in (3, 4):
        found = _ngrams(data, n)
        first = np.minimum(offsets[:-1], len(found))
        yield found, first, np.maximum(first, np.minimum(offsets[1:] - n + 1, len(found)))
    starts, ends, word_at = word_spans(data, offsets)
    hashed = range_hash(data, starts, ends, BASE_A)
    yield (hashed >> np.uint64(46)).astype(np.int64), word_at[:-1], word_at[1:]
    if len(hashed) > 1:
        pairs = ((hashed[:-1] * np.uint64(3) + hashed[1:]) * np.uint64(BASE_A) >> np.uint64(46)).astype(np.int64)
        pairs[hashed[:-1] == hashed[1:]] = REPEAT
        first = np.minimum(word_at[:-1], len(pairs))
        yield pairs, first, np.maximum(first, word_at[1:] - 1)


@dataclass
class Model:
    weight: np.ndarray  # one number per bucket
    bias: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total, count = np.zeros(len(offsets) - 1), np.zeros(len(offsets) - 1)
        for buckets, first, last in features(data, offsets):
            run = np.zeros(len(buckets) + 1)
            np.cumsum(self.weight[buckets], dtype=np.float64, out=run[1:])
            total += run[last] - run[first]
            count += last - first
        z = self.bias + total / np.maximum(count, 1)
        return np.round(1 / (1 + np.exp(-np.clip(z, -60, 60))), 6)


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _row_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in text_chunks(batches):
        kinds = list(features(data, offsets))
        ids, weights = [], []
        for i in range(rows.num_rows):
            every = np.concatenate([b[first[i]:last[i]] for b, first, last in kinds]) if kinds else np.zeros(0, np.int64)
            bucket, n = np.unique(every, return_counts=True)
            ids.append(bucket.astype("<i4").tobytes())
            weights.append((n / max(len(every), 1)).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays(
            [rows.column(rows.schema.get_field_index("label")), pa.array(ids, pa.binary()), pa.array(weights, pa.binary())],
            names=["label", "ids", "weights"])


def train_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Sparse features of at most ``sample_rows`` labelled, not held-out rows, chosen by a hash of the id."""
    ship(docs.sparkSession)
    known = (labels.select("doc_id", F.col("quality").cast("int").alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    ids = docs.select("doc_id").distinct()
    chosen = (known.join(ids, "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # sample_rows bounds it
             .groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label")))
    return texts.orderBy(F.xxhash64("doc_id"), "doc_id").select("label", "text").mapInArrow(
        _row_features, "label int, ids binary, weights binary")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> Model:
    """Train on the bounded sample; the driver holds its sparse features only."""
    rows = [(r.label, np.frombuffer(r.ids, "<i4"), np.frombuffer(r.weights, "<f4"))
            for r in train_rows(docs, labels, sample_rows).toLocalIterator()]
    share = sum(r[0] for r in rows) / len(rows) if rows else 0.5
    if share in (0.0, 1.0) or not rows:
        at = min(max(share, 0.01), 0.99)
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(at / (1 - at))))
    rng = np.random.default_rng(7)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    out, bias = np.zeros((2, DIM), np.float32), np.zeros(2, np.float32)
    step, steps = 0, epochs * len(rows)
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            label, ids, weights = rows[at]
            rate = np.float32(RATE * (1 - step / steps))
            step += 1
            mean = weights @ table[ids]
            z = out @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            back = p @ out
            out -= rate * np.outer(p, mean)
            bias -= rate * p
            table[ids] -= (rate * np.minimum(weights * len(ids), 4))[:, None] * back
    return Model((table @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, score) for every row."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(model.scores(data, offsets))], names=["key", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), "text").mapInArrow(run, f"key {kind}, score double")
            .withColumnRenamed("key", key))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    ship(docs.sparkSession)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in text_chunks(batches):
            yield rows.filter(pa.array(model.scores(data, offsets) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
