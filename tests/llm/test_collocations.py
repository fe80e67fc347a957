import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row

from hydromart.llm import collocations as M
from hydromart.llm.common import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count=100, top=2000):
    """Every phrase counted plainly, Python integers throughout."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    inner = set()
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            inner |= {(lang, words[i:i + size]) for i in range(len(words) - size + 1) if found[lang, words[i:i + size]] <= a}
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) not in inner:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k, f[lang, words[:k]],
                                  f[lang, words[k:]]) for k in range(1, len(words)))
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -score)
                  for lang, rows in out.items() for i, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1))


def random_rows(seed=3, n=120):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "ab", "B", "Ça", "ça", "ü", "w\x01x", "w", "\x00", "x", "日本"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!?", " \r"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "fr", None, "und", ""]), rng.choice([text, text + " a b ab a b", "New York City hall, " * 3])))
    return rows + [("en", None), ("en", ""), (None, " . , "), ("fr", "a " * 4000), ("en", "a " * 300 + "." + "x b " * 300)]


def frame(spark, rows, extra=()):
    df = spark.createDataFrame([Row(lang=a, text=b) for a, b in rows], "lang string, text string").repartition(3)
    for name in extra:
        df = df.selectExpr("*", f"1 AS `{name}`")
    return df


def result(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("budget", [M.SUBTREE_BUDGET, 64, 7])
def test_phrases_match_brute_force(spark, budget):
    """Small budgets force prefixes of two to five words and many groups."""
    rows = random_rows()
    got = result(M.collocations(frame(spark, rows), min_count=5, budget=budget))
    assert len(got) > 40 and got == brute(rows, 5)


def test_ties_and_top(spark):
    rows = [("en", "a b. c d. e f")] * 6 + [("fr", "a b")] * 4
    got = result(M.collocations(frame(spark, rows), min_count=5, top=2))
    assert got == brute(rows, 5, 2) and [r[2] for r in got] == ["a b", "c d"]


def test_long_phrases_swallow_their_parts(spark):
    rows = [("en", "one two three four five")] * 5 + [("en", "two three")]
    got = result(M.collocations(frame(spark, rows), min_count=5))
    assert [(r[2], r[3]) for r in got] == [("one two three four five", 5), ("two three", 6)] and got == brute(rows, 5)


def test_products_beyond_64_bits(spark):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)],
                                    "lang string, phrase string, words int, n long")
    totals = spark.createDataFrame([("en", 10_000_000_000_000)], "lang string, n long")
    row = M.score_phrases(phrases, totals).first()
    assert row.score == 1000 * (big - 1) * 10_000_000_000_000 // (big * (big + 1))


def test_empty_table_and_clashing_columns(spark):
    assert M.collocations(frame(spark, [])).count() == 0
    rows = random_rows(n=30)
    clash = frame(spark, rows, ("word", "n", "h", "grp", "body", "phrase", "words", "rank", "score"))
    assert result(M.collocations(clash, min_count=5)) == brute(rows, 5)


def test_groups_hold_at_most_twice_the_budget():
    deal = M.Deal(64, 100)
    loads = np.random.default_rng(1).integers(0, 100, 64)
    loads[5] = 5000
    assert deal.add(loads) and deal.group[0][5] == -1
    rest = np.where(np.arange(64) == 5, 0, loads)
    assert np.bincount(deal.group[0][deal.group[0] >= 0], weights=rest[deal.group[0] >= 0]).max() <= 200


def test_rare_words_never_hide_a_phrase(spark):
    """The bitmap may hold foreign bits, and phrases are still exact when it is full."""
    rows = random_rows(n=40)
    docs = frame(spark, rows)
    full = np.full(M.FILTER_BITS // 8, 255, np.uint8)
    text = pa.array([t or "" for _, t in rows])
    data = np.frombuffer("".join(text.to_pylist()).encode(), np.uint8)
    words = M.Words(data, np.array([0, len(data)]), np.array([1], np.uint64))
    assert words.reach(full).max() == 5
    held = M.with_hashes(M.word_counts(docs))
    bits = M.frequent_bitmap(held)
    hashes = np.array([r.h for r in held.collect()], np.int64).view(np.uint64) & np.uint64(M.FILTER_BITS - 1)
    assert ((bits[(hashes >> np.uint64(3)).astype(int)] >> (hashes & np.uint64(7)).astype(np.uint8)) & 1).all()
    assert int(np.unpackbits(bits).sum()) == len(set(hashes.tolist()))


def test_hashes_that_collide_are_told_apart():
    h1 = np.array([5, 5, 5, 1], np.uint64)
    h2 = np.array([1, 2, 1, 9], np.uint64)
    order, heads = M.equal_runs(h1, h2)
    assert len(heads) == 3 and sorted(np.diff(np.r_[heads, 4]).tolist()) == [1, 1, 2]


def test_query(spark, tmp_path):
    rows = [(lang, text) for lang, text in random_rows() for _ in range(8)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert result(M.op13_phrase_collocations(spark, str(tmp_path))) == brute(rows)


def test_scratch_tables_end_the_lineage(spark):
    out = M.count_phrases(frame(spark, random_rows(n=10)), M.word_counts(frame(spark, random_rows(n=10))), Scratch(spark, "t"), 5)
    assert "MapInArrow" not in out._jdf.queryExecution().executedPlan().toString()
