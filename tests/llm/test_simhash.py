import random
import re

import numpy as np
import xxhash

from hydromart.llm import simhash as M

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    s = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute(pairs, radius=4):
    fp = [fingerprint(t) for _, t in pairs]
    root = list(range(len(pairs)))
    for _ in pairs:
        for i in range(len(pairs)):
            for j in range(len(pairs)):
                if (fp[i] ^ fp[j]).bit_count() <= radius:
                    root[i] = root[j] = min(root[i], root[j])
    group = {}
    for (d, _), r in zip(pairs, root):
        group.setdefault(r, []).append(d)
    low = {r: min((d for d in ids if d is not None), default=None) for r, ids in group.items()}
    return [(d, f"{f:016x}", low[r]) for (d, _), f, r in zip(pairs, fp, root)]


def cases():
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    pairs = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, " ".join(base) + " one more word here")]
    pairs += [(10 + i, " ".join(base[:i * 7] + ["changed"] + base[i * 7 + 1:])) for i in range(25)]
    pairs += [(40, None), (41, ""), (42, " \t"), (43, "a"), (44, "A"), (45, "a b c"), (46, "a b c d"), (None, "a b c d")]
    pairs += [(50, "z z z z z z"), (50, "z z z z z z"), (51, "é " * 3000)]
    pairs += [(60 + i, " ".join(f"q{rng.randrange(10 ** 6)}" for _ in range(30))) for i in range(20)]
    return pairs


def test_groups_match_brute_force(spark, docs, tmp_path):
    docs(cases()).write.parquet(f"{tmp_path}/documents.parquet")
    got = M.op10_simhash_dedup(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute(cases()), key=repr)


def test_one_of_each_stays(clash):
    df = clash(cases(), "fp", "th", "root", "row", "_th")
    out = M.keep_one_of_each(df)
    assert out.columns == df.columns
    want = {c for _, _, c in brute(cases()) if c is not None}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_empty_table(docs):
    assert M.simhash_groups(docs([])).count() == 0
    assert M.keep_one_of_each(docs([])).count() == 0


def test_tiles_find_every_link(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2 ** 63, 200).astype(np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(k) for k in rng.choice(64, n, replace=False))) for b in base[:60] for n in (1, 4, 5)]
    values = np.unique(np.r_[base, np.array(flips, np.uint64)])
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    for tile in (7, 64, 10 ** 6):  # many tiles a count, and one
        edges = M.link_fingerprints(df, 4, tile).collect()
        label = np.arange(len(values))
        index = {int(v): i for i, v in enumerate(values.view(np.int64))}
        label = M.fold_links(label, np.array([index[e.a] for e in edges]), np.array([index[e.b] for e in edges]))
        want = M.fold_links(np.arange(len(values)), *np.nonzero(np.bitwise_count(values[:, None] ^ values) <= 4))
        assert (label == want).all()
