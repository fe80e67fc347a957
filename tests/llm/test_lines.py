import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hydromart.llm import lines as M
from hydromart.llm.common import Scratch

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(pairs, min_docs=10):
    seen = defaultdict(set)
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if i is not None:
                seen[line.strip(BLANKS).translate(LOWER)].add(i)
    common = {k for k, ids in seen.items() if k and len(ids) >= min_docs}
    return [(i, "\n".join(x for x in (t or "").split("\n") if x.strip(BLANKS).translate(LOWER) not in common)) for i, t in pairs]


def cases():
    pairs = [(i, f"own {i}\n  Shared Line\t\nÉcole\n") for i in range(12)]
    pairs += [(20 + i, f"SHARED line\n{i % 3}\nnine") for i in range(9)]
    pairs += [(40, None), (41, ""), (42, "\n\n"), (43, "shared line"), (44, "école"), (44, "école"), (None, "shared line\nx")]
    pairs += [(50, "\n".join(["word"] * 3000) + "\nshared LINE")]
    pairs += [(60, "twice\nA"), (60, "twice\nB")]
    pairs += [(70 + i, "twice") for i in range(8)]  # with id 60: nine documents, ten rows
    return pairs


def test_lines_match_brute_force(docs):
    pairs = cases()
    got = M.drop_common_lines(docs(pairs)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(brute(pairs), key=repr)
    assert all(r.n_chars == len(r.text) for r in got)


def test_extra_columns_and_one_batch(clash):
    pairs = [(i, "a\nsame") for i in range(10)]
    out = M.drop_common_lines(clash(pairs, "h1", "_lines", "row", "pos", "_gone"), batches=1)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "h1", "_lines", "row", "pos", "_gone"]
    assert {r.text for r in out.collect()} == {""}


def test_empty_table(docs):
    assert M.drop_common_lines(docs([])).count() == 0


def test_runs_anti_join_and_compact(spark):
    runs = M.LineRuns(Scratch(spark, "test"), min_docs=3, fanout=2)
    batch = lambda ids, h: spark.createDataFrame([(i, h, h) for i in ids], "doc_id long, h1 long, h2 long")
    runs.add(batch([1, 1, 2], 7))
    runs.add(batch([3], 7).union(batch([3], 8)))
    assert [tuple(r) for r in runs.settled().collect()] == [(7, 7, 3)]
    runs.add(batch([4, 5], 7).union(batch([4, 5], 8)))
    kept = [tuple(r) for r in spark.read.parquet(runs.scratch.path(runs.levels[0][0])).collect()]
    assert kept == [(8, 8, 2)]  # 7 is settled: the batch adds nothing for it
    assert sorted(tuple(r) for r in runs.finish().collect()) == [(7, 7), (8, 8)]


def test_main_path_is_native(docs):
    out = M.drop_common_lines(docs([(1, "a")]))
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("text", ["a\r\nb", "\x0ba\x0c\nb", "a \nb"])
def test_key_strips_only_the_six_blanks(docs, text):
    got = docs([(1, text)]).select(F.transform(M.split_lines(F.col("text")), M.line_key)).first()[0]
    assert got == [x.strip(BLANKS).translate(LOWER) for x in text.split("\n")]


def test_query_digest(spark, tmp_path, docs):
    docs(cases()).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op1_line_dedup(spark, str(tmp_path)).collect()
    want = sorted(hashlib.sha256(t.encode()).hexdigest() for _, t in brute(cases()))
    assert sorted(r.kept_sha256 for r in got) == want
