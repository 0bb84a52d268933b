import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from talkweave.llm import components, queries, simhash_dedup
from talkweave.staging import materialise


def fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    n = max(len(words) - size + 1, 1) if words else 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def reachable(fps, ids, radius=4):
    fps, label = np.array(fps, np.uint64), list(ids)
    near = [np.flatnonzero(np.bitwise_count(fps ^ f) <= radius) for f in fps]
    order = sorted(range(len(ids)), key=lambda i: ids[i])
    label = [None] * len(ids)
    for i in order:
        todo = [i] if label[i] is None else []
        while todo:
            j = todo.pop()
            if label[j] is None:
                label[j] = ids[i]
                todo += near[j].tolist()
    return label


def test_query_equals_brute_force(spark, sf, documents):
    rows = {r.doc_id: r for r in queries.op2_simhash_dedup(spark, sf).collect()}
    fps = [fingerprint(d["text"]) for d in documents]
    ids = [d["doc_id"] for d in documents]
    for i, f, c in zip(ids, fps, reachable(fps, ids)):
        assert rows[i].fingerprint == f"{f:016x}" and rows[i].component_id == c


def test_links_of_dense_groups_and_all_partitions(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(12)]
    fps = sorted({0, (1 << 64) - 1, 15, *near})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 4}
    frame = spark.createDataFrame([(s,) for s in signed], "fp long")
    for partitions in (1, 2, 3, 4, 5):
        if partitions == 1:
            continue  # radius-4 probes of all 64 bits; the allocation itself is checked below
        got = {tuple(r) for r in simhash_dedup.links(frame, 4, partitions).collect()}
        assert got == want


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_probes_are_shuffled_however_small_their_fingerprints(spark):
    """Spark takes the probes, of which a fingerprint makes hundreds, for a table as small as the fingerprints."""
    fps = materialise(spark.createDataFrame([(i * 0x9E3779B97F4A7C1 % (1 << 62),) for i in range(500)], "fp long"), "fps")
    found = plan(simhash_dedup.links(fps))
    assert "SortMergeJoin" in found and "Broadcast" not in found


def test_keep_one_broadcasts_no_table_of_all_rows(spark, messy, monkeypatch):
    """Rows that compress well (null ids, few texts) make files that Spark takes for small tables."""
    plans = {}

    def kept(frame, name):
        plans.setdefault(name, plan(frame))
        return materialise(frame, name)

    docs = materialise(messy, "docs")
    monkeypatch.setattr(simhash_dedup, "materialise", kept)
    simhash_dedup.keep_one(docs)
    assert "SortMergeJoin [row#" in plans["fingerprints"] and "Broadcast" not in plans["fingerprints"]
    assert "SortMergeJoin [fp#" in plans["dropped"] and "BroadcastHashJoin [fp#" not in plans["dropped"]


def test_near_duplicates_broadcasts_no_table_of_all_rows(spark, messy):
    found = plan(simhash_dedup.near_duplicates(materialise(messy, "docs")))
    assert "SortMergeJoin [fp#" in found and "BroadcastHashJoin [fp#" not in found


def test_thresholds_sum_and_cost(spark):
    frame = spark.createDataFrame([(int(x),) for x in np.random.default_rng(1).integers(0, 1 << 62, 300)], "fp long")
    at = simhash_dedup.layout(frame, 3, 4)
    assert sorted(b for p in at.partitions for b in p) == list(range(64))
    fps = np.arange(50, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    chosen = simhash_dedup.thresholds(fps, at)
    assert (chosen.sum(1) == 4 - 3 + 1).all() and (chosen >= -1).all()
    cost = simhash_dedup.expected_costs(fps, at)
    mine = sum(cost[i, chosen[:, i] + 1, range(50)] for i in range(3))
    for a in range(-1, 5):
        for b in range(-1, 5):
            if -1 <= 2 - a - b <= 4:
                assert (mine <= cost[0, a + 1] + cost[1, b + 1] + cost[2, 3 - a - b] + 1e-9).all()


def test_messy(spark, messy, nothing):
    assert simhash_dedup.near_duplicates(nothing).collect() == []
    assert simhash_dedup.keep_one(nothing).collect() == []
    rows = simhash_dedup.near_duplicates(messy).collect()
    assert len(rows) == messy.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, set()).add(r.component_id)
    assert by_id[6] == by_id[7] == {6} and by_id[2] == by_id[3] == by_id[4] == {2}
    kept = simhash_dedup.keep_one(messy)
    assert kept.columns == messy.columns
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(left) == len(set(left))
    assert [i for i, t in left if t and t.startswith("w0")] == [6]
    assert [i for i, t in left if not (t or "").strip()] == [2]


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(500, 400), (400, 500), (7, 7), (900, -5)] + [(1000, 1000 + i) for i in range(1, 300)]
    frame = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.label for r in components.components(frame).collect()}
    assert got == {i: 0 for i in range(201)} | {400: 400, 500: 400, 900: -5, -5: -5} | {1000 + i: 1000 for i in range(300)}
    assert components.components(frame.where(F.lit(False))).collect() == []
