import random
import re

import pytest
from pyspark.sql import functions as F

from hydromart.llm import substrings as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(pairs, k):
    own, words = {}, [(i, WORD.findall(t or "")) for i, t in pairs]
    for i, w in words:
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            if i is not None:
                own[key] = min(own.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - k + 1):
            if i is not None and own[tuple(w[p:p + k])] < i:
                gone.update(range(p, p + k))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(out, key=repr)


def run(df, **kw):
    out = M.remove_repeats(df, **kw).select("row.doc_id", "n_words", "n_removed", "kept")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def cases(k, seed=1):
    rng = random.Random(seed)
    text = lambda n, alphabet=400: " ".join(f"w{rng.randrange(alphabet)}é" for _ in range(n))
    passage, other = text(k + 30), text(k)
    pairs = [(i, f"{text(20)} {passage} {text(15)}") for i in range(30)]  # many strings in the edge buckets
    pairs += [(100, other), (101, other), (102, f"{other}\t{other}\n{other}"), (99, text(k - 1))]
    pairs += [(110, None), (111, ""), (112, " \n"), (None, other), (113, "x " * 4 * k), (114, "x " * 3 * k)]
    long = text(3000)
    pairs += [(200, long), (201, long), (202, long + " tail"), (203, "head " + long)]
    pairs += [(300, passage), (300, passage), (300, other)]  # one id, repeated and different rows
    pairs += [(301, text(10).replace(" ", " ") + " " + passage)]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("k,hot", [(50, M.HOT), (50, 3), (12, 5)])
def test_windows_match_brute_force(docs, k, hot):
    pairs = cases(k)
    assert run(docs(pairs), window=k, hot=hot) == brute(pairs, k)


def test_drop_repeats_keeps_columns(clash):
    pairs = cases(50)
    df = clash(pairs, "bucket", "marks", "row", "first")
    out = M.drop_repeats(df)
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted(((i, t) for i, _, _, t in brute(pairs, 50)), key=repr)


def test_empty_table(docs):
    assert run(docs([])) == []


def test_query(spark, tmp_path, docs):
    docs(cases(50)).write.parquet(f"{tmp_path}/documents.parquet")
    want = spark.createDataFrame([(t,) for *_, t in brute(cases(50), 50)], "t string").select(F.sha2("t", 256)).collect()
    got = M.op2_substring_dedup(spark, str(tmp_path)).collect()
    assert sorted(r.kept_sha256 for r in got) == sorted(r[0] for r in want)
