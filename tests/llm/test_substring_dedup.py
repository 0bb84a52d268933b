import hashlib
import random
import re

import numpy as np
import pytest

from talkweave.llm import chunks, queries, substring_dedup


def brute(docs, size=20):
    """doc row -> (words, kept words), by looking up every window."""
    seen, out = set(), []
    for i, text in docs:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            window = tuple(w[k:k + size])
            if window in seen:
                gone[k:k + size] = [True] * size
            seen.add(window)
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def test_query_equals_brute_force(spark, sf, documents):
    rows = {r.doc_id: r for r in queries.op7_substring_dedup(spark, sf).collect()}
    for i, n, gone, kept in brute(sorted((d["doc_id"], d["text"]) for d in documents)):
        assert (rows[i].n_words, rows[i].n_removed) == (n, gone)
        assert rows[i].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()


@pytest.mark.parametrize("size, anchor", [(20, 8), (6, 3), (5, 5), (4, 1)])
def test_random_repeats(spark, monkeypatch, size, anchor):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 2000)
    random.seed(size)
    pool = [" ".join(random.choice(["a", "b", "c", "dd"]) for _ in range(40)) for _ in range(6)]
    docs = []
    for i in range(120):
        parts = [random.choice(pool) if random.random() < 0.5 else " ".join(str(random.random()) for _ in range(9)) for _ in range(3)]
        docs.append((i, ("\n" if i % 2 else "  ").join(parts)[random.randint(0, 9):]))
    docs += [(200, "x " * 70), (201, "x " * 70 + "y"), (202, None), (203, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in substring_dedup.remove_duplicates(frame, size, anchor).collect()}
    for i, n, gone, kept in brute(docs, size):
        r = got[i]
        assert (r.n_words, r.n_removed, r.kept) == (n, gone, kept)
        covered = {k for s in r.spans for k in range(s.first, s.first + s.n)}
        assert len(covered) == gone
        words = dict(docs)
        for s in r.spans:
            own, source = words[i].split(), words[s.source].split()
            assert s.n >= size and (s.source, s.at) < (i, s.first)
            assert own[s.first:s.first + s.n] == source[s.at:s.at + s.n]


def test_a_passage_is_one_factor_and_no_word_at_a_border_is_lost():
    """Sources that follow each other make one factor; a window over the border begins the next."""
    places = np.array([[1] * 8, [0] * 8, [3] * 8, [5, 6, 7, 8, 40, 41, 42, 90]])
    starts = np.array([2, 3, 4, 5, 6, 7, 8, 30])
    got = substring_dedup._factors(starts, places, 4)
    assert [(f["first"], f["n"], f["at"]) for f in got] == [(2, 7, 5), (8, 4, 42), (30, 4, 90)]
    covered = {k for f in got for k in range(f["first"], f["first"] + f["n"])}
    assert covered == {k for s in starts for k in range(s, s + 4)}


def test_messy(spark, messy, nothing):
    assert substring_dedup.remove_duplicates(nothing).collect() == []
    rows = substring_dedup.remove_duplicates(messy).collect()
    assert len(rows) == messy.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[6].n_removed == 0 and by_id[7].n_removed == by_id[7].n_words == 120_000 and by_id[7].kept == ""
    assert [s.source for s in by_id[7].spans] == [6] and by_id[2].n_words == 0
