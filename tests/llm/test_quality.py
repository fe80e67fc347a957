import random
import zlib

import numpy as np
import pytest

from hydromart.llm import quality as M


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    good = lambda: " ".join("".join(rng.choice("aeioulnrst") for _ in range(rng.randrange(2, 9))) for _ in range(60))
    bad = lambda: rng.choice([" ".join(x.upper() + "!!" for x in good().split()), " ".join([good().split()[0]] * 70),
                              " ".join(x + "###" for x in good().split())])
    return [(i, good() if i % 4 else bad(), int(bool(i % 4))) for i in range(400)]


def test_held_out_accuracy(spark, docs, rows, tmp_path):
    docs([(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (None, "x"), (1, rows[1][1])]).write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(1, 1, 0), (2, None, 0), (None, 1, 0), (77777, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = M.op9_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) + 4
    by_id = {r.doc_id: r for r in got}
    for i, _, _ in rows:
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
    held = [(by_id[i].predicted, q) for i, _, q in rows if by_id[i].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert by_id[9000].score == by_id[9001].score


def test_held_out_labels_are_never_read(spark, docs, rows):
    df = docs([(i, t) for i, t, _ in rows])
    schema = "doc_id long, quality int"
    true = spark.createDataFrame([(i, q) for i, _, q in rows], schema)
    wrong = spark.createDataFrame([(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, _, q in rows], schema)
    a, b = M.fit(df, true), M.fit(df, wrong)
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias


def test_sample_is_bounded_and_columns_pass(spark, clash, rows):
    df = clash([(i, t) for i, t, _ in rows], "score", "label", "key", "ids")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    assert M.train_rows(df, labels, sample_rows=50).count() == 50
    kept = M.keep_good(df, M.fit(df, labels))
    assert kept.columns == df.columns
    ids = {r.doc_id for r in kept.collect()}
    assert sum((i in ids) == bool(q) for i, _, q in rows) / len(rows) >= 0.95


def test_no_or_one_kind_of_labels(spark, docs):
    df = docs([(1, "a b"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in M.score(df, M.fit(df, none)).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(1, 5)], "doc_id long, quality int")
    assert {r.score for r in M.score(df, M.fit(df, ones)).collect()} == {0.99}
    assert M.score(docs([]), M.fit(docs([]), none)).count() == 0


def test_chunks_do_not_change_scores():
    model = M.Model(np.random.default_rng(1).standard_normal(M.BUCKETS).astype(np.float32), 0.1)
    texts = ["", "ab", "abc def", "é" * 50, "x x x", "one"]
    join = lambda t: (np.frombuffer("".join(t).encode(), np.uint8), np.cumsum([0] + [len(x.encode()) for x in t]))
    together = model.scores(*join(texts))
    assert together.tolist() == [float(model.scores(*join([t]))[0]) for t in texts]
