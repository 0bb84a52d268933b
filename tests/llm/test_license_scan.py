import random
import re

import pytest

from talkweave.llm import license_scan, queries


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", license_scan.lower_ascii(text or ""))


def test_query_equals_brute_force(spark, sf, documents):
    rows = {r.doc_id: r for r in queries.op6_license_scan(spark, sf).collect()}
    phrases = {k: v.split() for k, v in license_scan.BASE.items()}
    for d in documents:
        w, r = words(d["text"]), rows[d["doc_id"]]
        places = [(i, k) for i in range(len(w)) for k, p in phrases.items() if w[i:i + len(p)] == p]
        assert r.n_words == len(w) and r.n_base == len(places)
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({k for _, k in places}))
        more = {k for k, t in license_scan.TEMPLATES.items() if any(accepts(license_scan.compile_template(t), w, i) for i in range(len(w)))}
        assert r.labels == ",".join(sorted({k for _, k in places} | more))
        assert 0 <= r.score <= 1


def accepts(automaton, w, at):
    """Whether some path from state 0 over w[at:] reaches the end, by depth-first search."""
    todo, seen = [(0, at)], set()
    while todo:
        state, i = todo.pop()
        if state == automaton.last:
            return True
        if (state, i) in seen:
            continue
        seen.add((state, i))
        todo += [(s, i) for s in automaton.free[state]]
        todo += [(s, i + 1) for x, s in automaton.steps[state] if i < len(w) and x in (None, w[i])]
    return False


def test_markup_against_regular_expressions():
    random.seed(4)
    markup = 'a <<beginOptional>>b <<beginOptional>>c<<endOptional>> d<<endOptional>> <<var;name="x";match=2>> e f'
    automaton = license_scan.compile_template(markup)
    pattern = re.compile(r"a(?: b(?: c)? d)?(?: \w){0,2} e f(?= |$)")
    for _ in range(3000):
        w = [random.choice("abcdef") for _ in range(random.randint(1, 10))]
        text = " ".join(w)
        for i in range(len(w)):
            ends = [k for k in range(i, len(w) + 1) if pattern.fullmatch(" ".join(w[i:k]))]
            assert automaton.longest(w, i) == (max(ends) if ends else None), text


def test_templates_that_cannot_start():
    for bad in ("<<beginOptional>>a", "<<beginOptional>>a<<endOptional>>", "<<var;match=3>> a"):
        with pytest.raises(ValueError):
            license_scan.compile_template(bad)


def test_full_texts_and_edits(spark):
    mit = re.sub("<<[^>]*>>", " ", license_scan.TEMPLATES["mit-text"])
    docs = [
        (1, "Copyright X\n" + mit.upper()), (2, mit.replace("merge", "burn")),
        (3, mit.replace("obtaining a copy of", 'obtaining a copy of this software and associated files (the "Software"),')),
        (4, "released UNDER the mit-license"), (5, "MIT license " * 3),
    ]
    got = {r.doc_id: r for r in license_scan.report(license_scan.scan(spark.createDataFrame(docs, "doc_id long, text string"))).collect()}
    assert "mit-text" in got[1].labels and "mit-text" not in got[2].labels and "mit-text" in got[3].labels
    assert got[4].labels == "mit,mit-notice" and (got[5].n_base, got[5].first_word, got[5].last_word, got[5].score) == (3, 0, 4, 1.0)


def test_messy(spark, messy, nothing):
    assert license_scan.scan(nothing).collect() == []
    rows = license_scan.report(license_scan.scan(messy)).collect()
    assert len(rows) == messy.count()
    assert {r.doc_id: r.labels for r in rows}[9] == "mit"
    assert all((r.n_words, r.score, r.first_word, r.labels) == (0, 0.0, None, "") for r in rows if r.doc_id in (2, 3, 4))
