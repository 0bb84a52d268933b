import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from talkweave.llm import chunks, katz, queries


class Brute:
    """The same model from dictionaries."""

    def __init__(self, docs):
        self.docs = [(i, [w for w in re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))] + [0]) for i, t in docs]
        self.c1, self.c2, self.after, n = Counter(), Counter(), defaultdict(set), 0
        for i, w in self.docs:
            if katz.is_training(i):
                n, p = n + 1, 1
                self.c1.update(w)
                for x in w:
                    self.c2[p, x] += 1
                    self.after[p].add(x)
                    p = x
        self.n, self.v, self.documents = sum(self.c1.values()), len(self.c1), n
        self.d1, self.d2 = self.discounts(self.c1), self.discounts(self.c2)
        kept = sum(self.cut(self.d1, c) for c in self.c1.values())
        free = 1 - kept / self.n if self.n else 1
        self.scale, self.unknown = (1, free) if free > 1e-12 else (self.n / (self.n + 1), 1 / (self.n + 1))
        self.back = {}
        for h, followers in self.after.items():
            n = self.documents if h == 1 else self.c1[h]
            free = 1 - sum(self.cut(self.d2, self.c2[h, w]) for w in followers) / n
            left = 1 - sum(self.p1(w) for w in followers)
            self.back[h] = (free / left, 1, n) if free > 1e-12 else (1 / (n + 1) / left, n / (n + 1), n)

    @staticmethod
    def discounts(counts):
        of = Counter(counts.values())
        return katz.Order(len(counts), sum(counts.values()), np.array([of[r] for r in range(1, 7)])).discounts

    @staticmethod
    def cut(d, c):
        return c * d[c] if c <= 5 else c

    def p1(self, w):
        return self.cut(self.d1, self.c1[w]) * self.scale / self.n if self.c1[w] else self.unknown

    def p(self, h, w):
        if h not in self.back:
            return self.p1(w)
        weight, scale, n = self.back[h]
        return self.cut(self.d2, self.c2[h, w]) * scale / n if self.c2[h, w] else weight * self.p1(w)

    def score(self, tokens):
        return sum(math.log10(self.p(h, w)) for h, w in zip([1, *tokens], tokens))


def check(rows, brute):
    for r, (i, tokens) in zip(rows, brute.docs):
        assert (r.doc_id, r.held_out, r.n_tokens) == (i, not katz.is_training(i), len(tokens))
        assert r.n_known == sum(brute.c1[w] > 0 for w in tokens) and r.train_tokens == brute.n
        base = sum(math.log10((brute.c1[w] + 0.1) / (brute.n + 0.1 * (brute.v + 1))) for w in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, brute.score(tokens), rel_tol=1e-9)


def test_query_equals_brute_force(spark, sf, documents):
    brute = Brute(sorted((d["doc_id"], d["text"]) for d in documents))
    check(sorted(queries.op5_katz_scores(spark, sf).collect(), key=lambda r: r.doc_id), brute)
    for h in [1, *random.Random(1).sample(sorted(brute.c1, key=str), 30)]:
        assert math.isclose(sum(brute.p(h, w) for w in brute.c1) + brute.p(h, b"\0none"), 1, rel_tol=1e-9)


def test_small_corpora(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_BYTES", 60)
    for docs in (
        [(i, "a b A b c " * (i % 7 + 1)) for i in range(40)], [(1, "same same"), (2, "same same"), (7, None)], [(i, "") for i in range(5)],
        [(i, f"w{i}") for i in range(20)],
    ):
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        check(sorted(katz.scores(frame).collect(), key=lambda r: r.doc_id), Brute(docs))


def test_discounts():
    order = katz.Order(100, 300, np.array([50, 20, 10, 6, 4, 3]))
    common = 6 * 3 / 50
    assert math.isclose(order.discounts[1], (2 * 20 / 50 - common) / (1 - common))
    assert (order.discounts[1:] > 0).all() and (order.discounts[1:] < 1).all()


def test_no_training_rows_and_messy(spark, messy, nothing):
    assert katz.scores(nothing).collect() == []
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = katz.scores(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")).collect()
    assert all((r.n_known, r.train_tokens, r.score) == (0, 0, 0.0) for r in rows)
    assert len(katz.scores(messy).collect()) == messy.count()
    assert chunks.NO_ID > 0
