import hashlib
import random

from talkweave.llm import merkle, queries


def test_query_equals_brute_force(spark, sf, documents):
    rows = {r.doc_id: r for r in queries.op4_merkle(spark, sf).collect()}
    docs = sorted(documents, key=lambda d: -d["doc_id"])
    assert len(rows) == len(docs)
    for i, d in enumerate(docs):
        text, after = d["text"], docs[(i + 1) % len(docs)]["text"]
        half = len(text) // 2
        edited, r = text[:len(text) - half] + after[:half], rows[d["doc_id"]]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(text) and r.edited_fingerprint == merkle.fingerprint(edited)
        assert r.near_edited == merkle.likeness(r.fingerprint, r.edited_fingerprint)
        assert r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(after))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1


def test_tree():
    random.seed(2)
    text = "\n".join(
        " ".join(random.choice(["alpha", "beta,", "gamma.", "delta!", "x" * 90]) for _ in range(20)) + random.choice(["", "\n", "\n\n"])
        for _ in range(12)
    )
    whole = "".join(leaf for s in merkle._SECTION.split(text) for p in s.splitlines(keepends=True) for leaf in merkle.leaves(p))
    assert whole == text
    a = merkle.fingerprint(text)
    assert a == merkle.fingerprint(str(text)) and merkle.likeness(a, a) == 1 and merkle.differences(a, a) == []
    edited = text[:400] + "CHANGED" + text[400:]
    b = merkle.fingerprint(edited)
    assert a.split("|")[0] != b.split("|")[0] and 0.6 < merkle.likeness(a, b) < 1
    places = merkle.differences(b, a)
    assert any(s <= 400 < e for s, e in places) and sum(e - s for s, e in places) < 300
    assert merkle.likeness(merkle.fingerprint(""), merkle.fingerprint("")) == 1
    assert merkle.likeness(merkle.fingerprint(""), a) == 0


def test_messy(spark, messy, nothing):
    assert merkle.compared(nothing).collect() == []
    rows = merkle.compared(messy).collect()
    assert len(rows) == messy.count()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in messy.select("doc_id").collect())
    one = merkle.compared(messy.where("doc_id = 5")).collect()
    assert [(r.doc_id, r.n_chars, r.near_next) for r in one] == [(5, 1, 1.0)]
    assert merkle.fingerprints(messy).count() == messy.count()
