import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from talkweave.llm import queries, whitening

MESSY = "vec_id long, embedding array<float>, label string, x string, at string, part string"


def brute(vectors, components=16):
    """n, {x vector: deviation}, eigenvalues, trace and {x vector: whitened up to sign} with numpy over the distinct vectors."""
    whole = [tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors]
    fit = np.array(sorted(set(whole)), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    deviation = {tuple(x): int(((n * x - sums) ** 2).sum()) for x in fit}
    centred = ((n * fit - sums).astype(np.float64)) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return n, deviation, values, np.trace(centred.T @ centred / n), {tuple(x): c @ axes / np.sqrt(values) for x, c in zip(fit, centred)}, whole


def check(rows, ids, vectors, components=16):
    n, deviation, values, trace, white, whole = brute(vectors, components)
    found = {}
    for r in rows:
        found.setdefault(r.vec_id, []).append(r)
    assert set(found) == set(ids) and len(rows) == len(ids) * len(values)
    signs = None
    for i, x in zip(ids, whole):
        mine = sorted(found[i], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, len(values) + 1))
        assert all(r.n == n and r.deviation == deviation[x] for r in mine)
        got = np.array([r.whitened for r in mine])
        if signs is None and np.abs(got).min() > 1e-6:
            signs = np.sign(got * white[x])
        if signs is not None:
            assert np.allclose(got, signs * white[x], atol=1e-8)
        assert np.allclose([r.explained for r in mine], values / trace, rtol=1e-9)
        assert len({r.identity_error for r in mine}) == 1 and mine[0].identity_error < 1e-9


def test_query(spark, sf):
    rows = pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    check(queries.op12_whitening(spark, sf).collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    plain = (rng.normal(size=(300, 5)) * [9, 5, 3, 2, 1] + 4).astype(np.float32)
    return [plain[i % 250].tolist() for i in range(len(plain))] + [plain[0].tolist()] * 400


def test_many_equal_vectors_count_once(spark, vectors, monkeypatch):
    monkeypatch.setattr(whitening, "LEAST_ROWS", 16)
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>").repartition(7)
    check(whitening.whiten(frame).collect(), range(len(vectors)), vectors)
    two = whitening.whiten(frame, components=2).collect()
    check(two, range(len(vectors)), vectors, 2)


def test_messy(spark, vectors):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None] * 5, [1.0, None, 2.0, 3.0, 4.0], [nan] * 5, [1.0, 1.0, 1.0, 1.0, -inf], [1e30] * 5, [1.0, 2.0], [1.0] * 6]
    rows = [(i, v, None, "c", "c", "c") for i, v in enumerate(vectors)] + [(10_000 + i, v, "l", "c", "c", "c") for i, v in enumerate(bad)]
    check(whitening.whiten(spark.createDataFrame(rows, MESSY).repartition(3)).collect(), range(len(vectors)), vectors)
    twice = spark.createDataFrame([(None, v, None, None, None, None) for v in vectors[:9]] + [(1, v, None, None, None, None) for v in vectors[:9]], MESSY)
    got = whitening.whiten(twice).collect()
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((i, k) for i in ("1", "None") for k in range(1, 6) for _ in range(9))
    for few in ([], [(1, None, *"lxap")], [(1, [1.0, 2.0], *"lxap")], [(i, [1.0, 2.0], *"lxap") for i in range(9)]):
        assert whitening.whiten(spark.createDataFrame(few, MESSY)).collect() == []


def test_flat_directions_are_left_out(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(a), float(b), 2.0, float(a)]) for i, (a, b) in enumerate(rng.integers(-50, 50, (60, 2)))]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9


def test_deviations_beyond_a_long(spark):
    x = [[1_000_000 + d, 1_000_000 - d] for d in (0, 3, -7, 40)]
    rows = spark.createDataFrame([(v,) for v in x], "x array<long>")
    for n, fits in ((4, True), (2_000_000_000, True), (1 << 40, False)):
        sums = [n * 1_000_000, n * 1_000_000]
        fit = whitening.Fit(n, sums, [0, 0] if n > 4 else [999_990] * 2, [2_000_000] * 2 if n > 4 else [1_000_050] * 2)
        got = [r[0] for r in rows.select(whitening.deviation(fit)).collect()]
        want = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
        assert got == [w if w < 1 << 63 else None for w in want] and all(g is not None for g in got) == (fits and want[-1] < 1 << 63)
