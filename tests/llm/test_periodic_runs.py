import random
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow.parquet as pq
import pytest

from talkweave.llm import periodic_runs, queries
from talkweave.llm.arrays import mix


def runs(words):
    """Every maximal stretch at every lag, without those whose words have a smaller period."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(words[i:i + size - d] == words[i + d:i + size] for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row(words):
    found = runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2], sha256(lines.encode()).hexdigest(),
        sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("seed", range(40))
def test_every_run_of_random_texts(seed):
    rng, texts = random.Random(seed), []
    for _ in range(6):
        n = rng.choice([0, 3, 40, 300, 700])
        words = [rng.randrange(rng.choice([1, 2, 4, 60, 5000])) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n > 10 else 0):
            a, q = rng.randrange(n), rng.randint(1, n // 4)
            for i in range(a + q, min(n, a + q * rng.randint(2, 9))):
                words[i] = words[i - q]
        texts.append(words)
    bounds = np.cumsum([0, *map(len, texts)])
    found = periodic_runs.find_runs(mix(np.array([w for t in texts for w in t], np.uint64)), bounds)
    want = [(s + b, n, q) for t, b in zip(texts, bounds.tolist()) for s, n, q in runs(t)]
    assert list(zip(found.start.tolist(), found.length.tolist(), found.period.tolist())) == want


@pytest.mark.parametrize("period", [16, 17, 32, 33, 64, 65, 127, 128, 129, 1000])
def test_shortest_runs_at_the_borders_of_scales(period):
    rng = np.random.default_rng(period)
    ids = rng.integers(0, 1 << 60, 6 * period).astype(np.uint64)
    ids[period:5 * period] = np.resize(ids[period:2 * period], 4 * period)
    found = periodic_runs.find_runs(ids, np.array([0, len(ids)]))
    assert [found.start.tolist(), found.length.tolist(), found.period.tolist()] == [[period], [4 * period], [period]]
    ids[5 * period - 1] = 1
    assert not len(periodic_runs.find_runs(ids, np.array([0, len(ids)])).start)


def test_texts_do_not_run_into_each_other():
    ids = np.full(10, 7, np.uint64)
    assert not len(periodic_runs.find_runs(ids, np.array([0, 5, 5, 10])).start)


def test_colliding_hashes_do_not_count(monkeypatch):
    monkeypatch.setattr(periodic_runs, "word_hashes", lambda words: np.full(len(words), 5, np.uint64))
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["a b c d e f g h", "x x x x x x y"])], ["doc_id", "text"])
    (out,) = periodic_runs._scan(iter([batch]))
    assert out.column(2).to_pylist() == [[], [{"start": 0, "length": 6, "period": 1}]]


def test_query(spark, sf):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op13_periodic_runs(spark, sf).collect()}
    short = [r for r in pq.read_table(f"{sf}/documents.parquet").to_pylist() if len(split(r["text"])) < 1500]
    assert len(short) > 150
    for r in short:
        assert got[r["doc_id"]] == row(planted(r["doc_id"], split(r["text"]))), r["doc_id"]
    assert len(got) == 200 and any(x[0] for x in got.values())


def test_messy(spark, messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.select("doc_id", "text").collect()]
    more = spark.createDataFrame([(10, "a b " * 400 + "c"), (None, "z " * 9)], "doc_id long, text string")
    found = periodic_runs.periodic_runs(messy.select("doc_id", "text", "row").unionByName(more, allowMissingColumns=True))
    got = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect())
    want = [(repr(i), len(split(t)), [], " ".join(split(t))) for i, t in rows]
    want += [("10", 801, [(0, 800, 2)], "a b c"), ("None", 9, [(0, 9, 1)], "z")]
    assert got == sorted(want)
    assert periodic_runs.report(periodic_runs.periodic_runs(nothing)).collect() == []
    assert sorted(map(repr, periodic_runs.with_planted_runs(messy).collect())) == sorted(
        f"Row(doc_id={i}, text={(t if i is None or zlib.crc32(str(i).encode()) % 10 or not split(t) else ' '.join(planted(i, split(t))))!r})" for i, t in rows
    )
