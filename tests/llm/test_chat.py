import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import AddedToken, Tokenizer

from hydromart.llm import chat as M

SCHEMA = "conv_id long, turn long, role string, text string"
ODD = ["", None, M.SPOOF, "<|im_sep|>", "<\\|im_end|>", "<\\\\|im_start|>", "<|endoftext|>x", "<", "<\\", "\\", "|im_end|>",
       "<<|im_end|>>", "\n\nleading", " leading and trailing ", "é日本\U0001F600‍", "a\x00b", "é", "x" * 5000]
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def brute(rows):
    by = {}
    for conv, turn, role, text in [*rows, (-1, 0, "user", M.SPOOF), (-1, 1, "assistant", M.SPOOF)]:
        text = text or ""
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role is not None, role or "", sha(text), text))
    template = M.Template(["<|endoftext|>"])
    out = []
    for conv, turns in by.items():
        turns = [(t[2], t[4]) for t in sorted(turns, key=lambda t: t[:4])]
        said = "".join(x for role, x in turns if role == "assistant")
        out.append((conv, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(said), sha(said),
                    sum(len(template.render(r, x)[0]) for r, x in turns)))
    return sorted(out, key=repr)


def random_rows(n=60, seed=8):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, 0, None]), rng.choice(["user", "assistant", "assistant", "system", None, "<|im_end|>"]),
                         "".join(x or "" for x in rng.choices(ODD[:-1], k=rng.randrange(0, 4)))))
    rows += [(500, i, "assistant", t) for i, t in enumerate(ODD)]
    return rows + rows[:3]


def frame(spark, rows, *names):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in names:
        df = df.selectExpr("*", f"1 AS `{name}`")
    return df


def result(df):
    return sorted((tuple(r) for r in df.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                               "formatted_chars").collect()), key=repr)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<", "|", "\\", "im_end", "|>", M.END, M.START, "<|endoftext|>", "a", " "]), max_size=12))
def test_escape_is_reversible_and_leaves_no_control(parts):
    template = M.Template(["<|endoftext|>"])
    text = "".join(parts)
    escaped = template.escape(text)
    assert template.unescape(escaped) == text
    assert not any(s in escaped for s in (M.START, M.SEP, M.END, "<|endoftext|>"))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", M.END]), st.sampled_from(ODD[:1] + ODD[2:])), max_size=6))
def test_turns_read_back(turns):
    template = M.Template(["<|endoftext|>"])
    assert list(template.read("".join(template.render(r, t)[0] for r, t in turns))) == turns


def test_reading_refuses_what_is_no_turn():
    with pytest.raises(ValueError):
        list(M.Template([]).read("loose text"))


def test_mask_matches_a_plain_search():
    rng = np.random.default_rng(2)
    for _ in range(50):
        cuts = np.unique(rng.integers(0, 200, 20))
        spans = cuts[:len(cuts) // 2 * 2].reshape(-1, 2)
        starts = np.sort(rng.integers(0, 200, 80))
        ends = starts + rng.integers(0, 4, 80)
        want = [any(a <= s and e <= b for a, b in spans) and e > s for s, e in zip(starts, ends)]
        assert M.loss_mask(starts, ends, spans).tolist() == want
    assert not M.loss_mask(np.array([1]), np.array([2]), np.zeros((0, 2), np.int64)).any()


def test_parts_equal_one_encoding_of_the_whole(spark):
    """Parts cut between turns give the ids of the whole conversation encoded at once."""
    rows = [(1, i, "assistant" if i % 2 else "user", f"{i} {ODD[i % len(ODD)] or ''}") for i in range(150)]
    parts = sorted(M.format_conversations(frame(spark, rows), long_turns=20, part_chars=200).collect(), key=lambda r: r.part)
    assert len(parts) > 1
    whole = "".join(p.formatted for p in parts)
    library = Tokenizer.from_file(M.TOKENIZER)
    library.add_special_tokens([AddedToken(s, special=True, normalized=False) for s in (M.START, M.SEP, M.END)])
    got = library.encode(whole, add_special_tokens=False)
    assert [i for p in parts for i in p.ids] == got.ids
    at, spans = 0, []
    for p in parts:
        spans += [(at + a, at + b) for a, b in zip(p.starts, p.ends)]
        at += len(p.formatted)
    assert spans == [tuple(x) for x in got.offsets]
    template = M.Template(["<|endoftext|>"])
    mask = [m for p in parts for m in p.loss]
    said = "".join(template.unescape(whole[a:b]) for a, b in M.covered(*np.array([s for s, m in zip(spans, mask) if m]).T))
    assert said == "".join(t for _, _, r, t in rows if r == "assistant")


@pytest.mark.parametrize("long_turns", [M.LONG_TURNS, 3])
def test_digests_match_brute_force(spark, tmp_path, long_turns):
    rows = random_rows()
    spoof = [(-1, 0, "user", M.SPOOF), (-1, 1, "assistant", M.SPOOF)]
    assert result(M.conversation_digests(frame(spark, rows + spoof), long_turns=long_turns)) == brute(rows)


def test_query(spark, tmp_path):
    rows = random_rows(20) + [(900, i, "assistant", f"turn {i}") for i in range(300)] + [(901, 1, "user", "same")] * 200
    frame(spark, rows, "part", "digest", "uid", "long_id", "formatted", "n").write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(M.op11_chat_format(spark, str(tmp_path))) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert M.format_conversations(frame(spark, [])).count() == 0
    frame(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert result(M.op11_chat_format(spark, str(tmp_path))) == brute([])


def test_one_very_long_turn(spark):
    text = "word " * 300_000 + M.END
    got = result(M.conversation_digests(frame(spark, [(3, 0, "assistant", text), (3, 1, "user", "x")])))
    assert got == [r for r in brute([(3, 0, "assistant", text), (3, 1, "user", "x")]) if r[0] == 3]
