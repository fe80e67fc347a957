import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hydromart.llm import manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(hashes):
    """Levels of a tree, from the leaves to the root."""
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, at, fold):
    proof = ""
    for level in levels[:-1]:
        run = level[at // 3 * 3:at // 3 * 3 + 3]
        run[at % 3] = None
        proof += "".join(h for h in run if h)
        fold = sha(*[fold if h is None else h for h in run])
        at //= 3
    return fold, proof


def brute(rows):
    by = defaultdict(list)
    for row in rows:
        by[row[3]].append((row[0] is not None, row[0] or 0, leaf(*row), row))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for i, s in enumerate(order):
        for at, (_, _, own, row) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            doc_id, text = row[:2]
            bad = list(row)
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                bad[1] = text.replace("\n", "")
            fold, low = climb(trees[s], at, leaf(*bad))
            fold, high = climb(top, i, fold)
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], sha(low + high), fold, fold == top[-1][0]))
    return out


def random_rows(n, seed=4, sources=("a", "b", "ä", "", None, "Z")):
    rng = random.Random(seed)
    texts = [None, "", "a\nb", "é\n\n日本", "plain", "\n", "x" * 3000]
    rows = [(rng.randrange(-5, n), rng.choice(texts), rng.choice(["en", None]), rng.choice(["hot", rng.choice(sources)]),
             rng.choice([None, 3])) for _ in range(n)]
    return rows + rows[:5] + [(None, "a\nb", None, None, None), (None, "c", "en", "hot", 1), (7, "one", "en", "alone", 3)]


def frame(spark, rows, *names):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in names:
        df = df.selectExpr("*", f"1 AS `{name}`")
    return df


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                               "verified").collect()), key=repr)


def query(docs, tmp_path, spark):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return result(M.op12_merkle_manifest(spark, str(tmp_path)))


@pytest.mark.parametrize("n", [1, 10, 200])
def test_query_matches_brute_force(spark, tmp_path, n):
    rows = random_rows(n)
    assert query(frame(spark, rows), tmp_path, spark) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("rows", [
    [(1, "a\nb", "en", "s", 3)],
    [(i, "a\nb", "en", "s", 3) for i in range(7)],
    [(i, "a\nb", "en", f"s{i}", 3) for i in range(40)],  # every group a single leaf
    [(1, "same\n", "en", "s", 3)] * 30,  # repeated rows only
])
def test_one_group_many_groups_and_copies(spark, tmp_path, rows):
    assert query(frame(spark, rows), tmp_path, spark) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("shared", [1, 9])
def test_any_number_of_shared_levels_gives_the_same(spark, shared):
    rows = random_rows(120)
    cut = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    held = M.build(frame(spark, rows), tampered={"text": F.coalesce(cut, F.col("text"))})
    assert result(M.prove(held, shared)) == sorted(brute(rows), key=repr)


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert M.prove(M.build(frame(spark, []))).count() == 0
    rows = random_rows(30)
    clash = frame(spark, rows, "uid", "tree", "pos", "n", "leaf", "fold", "hash", "up", "slot", "id", "steps", "at", "part")
    assert query(clash, tmp_path, spark) == sorted(brute(rows), key=repr)


def test_nodes_are_parent_linked(spark):
    held = M.build(frame(spark, random_rows(60)))
    nodes = {(r.tree, r.level, r.pos): r for r in held.nodes.collect()}
    tops = [r for r in nodes.values() if r.up is None]
    assert len(tops) == 1
    for r in nodes.values():
        if r.up is not None:
            up = nodes[r.up.tree, r.up.level, r.up.pos]
            own = hashlib.sha256("".join(bytes(k).hex() for k in r.kids).encode()).digest()
            assert bytes(up.kids[r.slot]) == own
    assert hashlib.sha256("".join(bytes(k).hex() for k in tops[0].kids).encode()).hexdigest() == held.root


def test_row_limit_setting_is_put_back(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    M.prove(M.build(frame(spark, random_rows(5)))).count()
    assert spark.conf.get(name) == before
