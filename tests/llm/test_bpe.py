import hashlib
import json
import random

import pytest
from tokenizers import Tokenizer

from hydromart.llm import bpe as M

ODD = ["", " ", "a", "ΑΣ ΣΑΣ ς", "İstanbul ǅ", "<|startoftext|>hello <|endoftext|> X<|ENDOFTEXT|>", "\x1c\x1f a\x85b c　d",
       "½ ² Ⅷ 一 ٣", "don't DON'T 'RE ’s 'll'd''s", "a" * 5000, "aé" * 400, "é 가 ﬁ ﷺ \U0001F600‍", "​﻿\x00 \x01",
       "<|startoftext|><|endoftext|>", "ab" * 300 + "<w>", "a</w>b", "ß ẞ ŉ", "\xa0\xa0x", "1234567890 3.14", "!!!???...",
       "x" * 65, "qz" * 40, "mixed" + "日本語テキスト" * 30]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(M.TOKENIZER)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    with open(M.TOKENIZER, "rb") as file:
        return M.Bpe(file.read())


def random_texts(n):
    rng = random.Random(5)
    pool = "aaabcdeeeeghiilmnoorrssttuuvxyzéñßçA.,'-!0 \n \t日ñ́"
    return ["".join(rng.choice(pool) for _ in range(rng.randrange(1, 300))) for _ in range(n)]


def test_ids_and_text_equal_the_library(own, library):
    for text in ODD + random_texts(300):
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_forced_cuts_are_certain(own):
    """Fragments encoded apart give the ids of the whole word merged at once."""
    rng = random.Random(6)
    cut = 0
    for _ in range(2000):
        word = "".join(rng.choice("qzxjkvwaeiobñ日é") for _ in range(rng.randrange(1, 14)))
        symbols = [own.alphabet[b] for b in word.encode()]
        symbols[-1] += M.END
        cut += any(pair not in own.joined for pair in zip(symbols, symbols[1:]))
        assert own.word(word) == own.merge([own.ids[s] for s in symbols])
    assert cut > 500


def test_long_fragments_merge_the_same(own):
    for word in ("ab" * 20, "theathe" * 8, "a" * 60):
        ids = [own.ids[c] for c in word[:-1]] + [own.ids[word[-1] + M.END]]
        assert own._merge_long(list(ids)) == own.merge(list(ids))


def test_fragment_table_is_bounded(own, library, monkeypatch):
    monkeypatch.setattr(M, "TABLE_IDS", 50)
    for text in random_texts(60):
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
        assert own.fragments.held <= 50


@pytest.mark.parametrize("stretch", [1, 7, 64])
def test_stretches_of_any_length_give_the_same(own, library, monkeypatch, stretch):
    """Cuts before blanks, special tokens between and behind stretches, many texts at once."""
    monkeypatch.setattr(M, "STRETCH", stretch)
    texts = ODD + random_texts(60) + ["a<|endoftext|>b <|endoftext|><|endoftext|>", "́ e ́\ń"]
    ids, offsets = own.encode_all(texts)
    decoded = own.decode_all(ids, offsets)
    for i, text in enumerate(texts):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[offsets[i]:offsets[i + 1]].tolist() == want
        assert decoded[i].as_py() == library.decode(want, skip_special_tokens=False)


def test_special_tokens_of_any_form(own):
    """A file's special tokens are found whatever characters they are made of."""
    spec = json.loads(open(M.TOKENIZER).read())
    spec["added_tokens"].append({**spec["added_tokens"][0], "id": 49408, "content": "[SEP]"})
    other, theirs = M.Bpe(json.dumps(spec).encode()), Tokenizer.from_str(json.dumps(spec))
    for text in ("x[SEP]y", "[SEP][SEP]", "[sep] a[SEP"):
        assert other.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_unknown_ids_are_left_out(own, library):
    ids = [-1, 320, 10**6, 321]
    assert own.decode(ids) == library.decode([320, 321], skip_special_tokens=False)


def test_query(spark, docs, tmp_path, library):
    pairs = list(enumerate(ODD)) + [(900, None), (901, "same"), (901, "same"), (None, "x")]
    docs(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    got = [tuple(r) for r in M.op4_bpe_roundtrip(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_decode_column_and_edges(spark, clash, docs, own):
    df = clash([(1, "hello world"), (2, None)], "ids", "key", "decoded")
    encoded = M.encode(df)
    assert {r.doc_id: r.text for r in M.decode(encoded).collect()} == {1: own.decode(own.encode("hello world")), 2: ""}
    assert M.encode(docs([])).count() == 0
