import random

from hydromart.llm import decontaminate as M


def distance(item, text):
    """Fewest edits between the item and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("xyz")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("xyz"))
    return "".join(chars)


def cases():
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdeilnorst  ") for _ in range(n)).strip()
    items = [(i, prose(rng.randrange(30, 160))) for i in range(12)] + [(50, "short"), (51, None), (52, "Ünïcödé " * 8), (53, "")]
    items.append((60, items[0][1]))
    docs = [(i, prose(300)) for i in range(10)]
    for n, (i, text) in enumerate(items[:12]):
        for share in (0, 0.05, 0.1, 0.15):
            docs.append((100 + 10 * n + int(100 * share) % 7, prose(100) + " " + edited(rng, text, int(len(text) * share)) + " " + prose(80)))
    docs += [(900, None), (901, ""), (902, "é" * 40 + " ÜNÏCÖDÉ\n" * 9), (903, (prose(3000) + " ") * 3), (904, items[1][1]), (904, items[1][1]),
             (None, items[2][1]), (905, items[3][1].replace(" ", " \n\t "))]
    return docs, items


def test_every_region_within_the_budget_is_found(spark, docs):
    pairs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in M.find_leaks(docs(pairs), bench).collect()}
    want = set()
    for d, text in pairs:
        for i, item in items:
            item, t = M.normalise(item or ""), M.normalise(text or "")
            budget = min(int(len(item) * M.EDIT_SHARE), (len(item) - M.Q) // M.Q)
            if len(item) >= M.Q and (n := distance(item, t)) <= budget:
                want.add((d, i, n))
    assert got == want
    assert {n for _, _, n in got} >= {0, 1, 3}


def test_blocks_and_segments_give_the_same(spark, docs, monkeypatch):
    pairs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = {tuple(r) for r in M.find_leaks(docs(pairs), bench).collect()}
    assert {tuple(r) for r in M.find_leaks(docs(pairs), bench, block_chars=200).collect()} == whole
    monkeypatch.setattr(M, "SEGMENT", 64)
    block = M.ItemBlock([(i, t) for i, t in items if t])
    for _, text in pairs:
        found = block.find(M.normalise(text or ""))
        monkeypatch.setattr(M, "SEGMENT", 1 << 18)
        assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in block.find(M.normalise(text or "")).items()}
        monkeypatch.setattr(M, "SEGMENT", 64)


def test_drop(spark, clash, docs):
    pairs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = clash(pairs, "item_id", "row", "edits", "_leaked")
    bad = {r.doc_id for r in M.find_leaks(df, bench).collect()}
    out = M.drop_contaminated(df, bench)
    assert out.columns == df.columns
    assert sorted((r.doc_id for r in out.collect()), key=repr) == sorted((i for i, _ in pairs if i not in bad), key=repr)
    assert M.find_leaks(docs([]), bench).count() == 0 and M.find_leaks(df, bench.limit(0)).count() == 0
