import hashlib
import re

from hydromart.llm import pii as M

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")),
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def brute(text):
    found = sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(BASE.items())
                   for m in re.finditer(p, text or "") if passes(k, m[0]))
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)


TEXTS = ["", None, "é mail joan.smith@mail.example.com, thanks", "a@b.cd+x@e.f a@b@c.de @x.y a@b", "1.2.3.4.5.6.7.8 256.1.1.1 010.0.0.1 1.2.3",
         "4111 1111 1111 1111 and 4111-1111-1111-1112", "4111111111111111 +1 (555) 010-9999 ext", "+12 +1-2 +33 1 23 45 67 89 +", "9" * 6000,
         "a" * 30000 + "@" + "b" * 3000, "x" * 5000 + "@y.z" * 500, "1 " * 4000, "1.1.1.1 " * 500, "+" * 3000, "\U0001F600 +4915112345678 \U0001F600",
         "0000.0.0.0255 1.1.1.0000000256", "a.b@c-d.e-f.gh."]


def test_base_spans(spark, docs, tmp_path):
    pairs = list(enumerate(TEXTS)) + [(100, TEXTS[2]), (100, TEXTS[2]), (100, TEXTS[5]), (None, TEXTS[4])]
    docs(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    out = M.op6_pii(spark, str(tmp_path))
    got = out.collect()
    assert sorted(((r.doc_id, r.base_sha256) for r in got), key=repr) == sorted(
        ((i, hashlib.sha256(brute(t).encode()).hexdigest()) for i, t in pairs), key=repr)
    for r in got:
        base = [s for s in r.spans.split(",") if not s.startswith("term")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k) for s in base) for k in BASE]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_disclosing_terms(docs):
    who = "write to Zorblax Quuxley at zq@corp.example about prices"
    pairs = [(i, f"memo {i}: {who}") for i in range(4)] + [(10 + i, "write to us about prices at will") for i in range(6)]
    pairs += [(20, "contact other@corp.example from Plimsoll")]
    found = M.find_pii(docs(pairs)).collect()
    text = dict(pairs)
    terms = {text[r.doc_id][r.start:r.end].lower() for r in found if r.kind == "term"}
    # words that others use as well disclose too little; Plimsoll is seen once
    assert {"zorblax", "quuxley"} <= terms and not terms & {"write", "about", "prices", "plimsoll"}
    assert not any(r.doc_id >= 10 and r.doc_id < 20 for r in found)
    lower = M.find_pii(docs(pairs), disclosure=0.05).where("kind = 'term'").count()
    assert lower > sum(r.kind == "term" for r in found)


def test_terms_are_marked_wherever_they_stand(docs):
    far = "filler words go on here " * 8
    pairs = [(i, f"Zorblax wrote from zq@corp.example today. {far} So said ZORBLAX again, doc {i}") for i in range(20)]
    pairs += [(50, "the stray zorblax elsewhere")] + [(100 + i, f"today the {far} were plain corp {i}") for i in range(200)]
    found = M.find_pii(docs(pairs)).where("kind = 'term'").collect()
    text = dict(pairs)
    marked = {}
    for r in found:
        marked.setdefault(r.doc_id, []).append((r.start, text[r.doc_id][r.start:r.end].lower()))
    for i in [*range(20), 50]:  # one stray use lowers the share below 1, and the second use is far from the entity
        where = [m.start() for m in re.finditer("zorblax", text[i].lower())]
        assert sorted(a for a, w in marked[i] if w == "zorblax") == where
    assert not any(i >= 100 for i in marked)  # clean documents
    assert not any(w in ("today", "filler", "corp", "example") for spans in marked.values() for _, w in spans)


def test_repeated_rows_count_once(docs):
    pairs = [(i, f"Zorblax at zq@corp.example {i}") for i in range(3)] + [(9, "old zorblax")] + [(10 + i, "plain text") for i in range(60)]
    spans = lambda rows: sorted(tuple(r) for r in M.find_pii(docs(rows), disclosure=0.9).collect())
    assert any(s[2] == "term" for s in spans(pairs))
    assert spans(pairs + [(9, "old zorblax")] * 8) == spans(pairs)


def test_sanitise(clash):
    pairs = [(i, f"Zorblax at zq@corp.example, card 4111 1111 1111 1111! {i}") for i in range(3)] + [(7, None), (8, "clean")]
    df = clash(pairs, "spans", "row", "th", "_doc")
    out = M.sanitise(df, M.find_pii(df))
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[7] is None and got[8] == "clean"
    assert got[1].startswith(" at [EMAIL]") and "[CARD]!" in got[1] and "4111" not in got[1]


def test_empty_table(docs):
    assert M.find_pii(docs([])).count() == 0
