"""Near-duplicate classes of documents by SimHash, with a generalised pigeonhole search.

Two fingerprints within ``radius`` bits of each other must, for every split of the 64 bits into m
partitions and all thresholds T_i of at least -1 that sum to radius - m + 1, agree up to T_i bits in some partition
i. So each fingerprint chooses its own thresholds: correlated bits share a partition, and dynamic
programming finds the allocation with the fewest expected probes and candidates, estimated from counts
over all fingerprints. All values within T_i of its own are probed in the index of every fingerprint's exact
values; a candidate counts if its whole distance is within the radius. No allocation loses a link.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.arrays import map_batches
from talkweave.llm.components import components
from talkweave.llm.fingerprints import simhash
from talkweave.staging import materialise

BLOCK_BITS = 8


@dataclass
class Layout:
    """Partitions of bit positions; ``near[i][b]``: for block b of partition i, its bits and the
    share of fingerprints at each distance from each of its values; ``n``: fingerprints."""

    partitions: list[list[int]]
    near: list[list[tuple[list[int], np.ndarray]]]
    n: int
    radius: int


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _bits(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, bit in enumerate(bits):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << k
    return out


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((64, 64), np.int64)
    for batch in batches:
        fps = _unsigned(batch.column(0))
        ones = np.stack([(fps >> np.uint64(b)) & np.uint64(1) for b in range(64)]).astype(np.float32)
        total += (ones @ ones.T).astype(np.int64)
    a, b = np.divmod(np.arange(64 * 64), 64)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total.ravel())], ["a", "b", "n"])


def bit_partitions(fps: DataFrame, m: int) -> tuple[list[list[int]], int]:
    """The 64 bits in ``m`` partitions, each gathering the bits most correlated with those it has; and the number of rows."""
    both, n = np.zeros((64, 64)), fps.count()
    for r in map_batches(fps, _together, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        both[r.a, r.b] = r.n
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    linked = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    left, out = set(range(64)), []
    for k in range(m):
        size = len(left) // (m - k)
        first = max(left, key=lambda b: (sum(linked[b, x] for x in left), -b))
        mine = [first]
        left.discard(first)
        while len(mine) < size:
            best = max(left, key=lambda b: (sum(linked[b, x] for x in mine), -b))
            mine.append(best)
            left.discard(best)
        out.append(mine)
    return out, n


def layout(fps: DataFrame, m: int, radius: int) -> Layout:
    """Partitions, and how far apart the values of their blocks lie over all fingerprints."""
    partitions, n = bit_partitions(fps, m)
    blocks = [(i, part[j:j + BLOCK_BITS]) for i, part in enumerate(partitions) for j in range(0, len(part), BLOCK_BITS)]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(blocks), 1 << BLOCK_BITS), np.int64)
        for batch in batches:
            values = _unsigned(batch.column(0))
            for k, (_, bits) in enumerate(blocks):
                total[k] += np.bincount(_bits(values, bits), minlength=1 << BLOCK_BITS)
        k, v = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(total[k, v])], ["k", "v", "n"])

    counts = np.zeros((len(blocks), 1 << BLOCK_BITS))
    for r in map_batches(fps, counted, "k long, v long, n long").groupBy("k", "v").agg(F.sum("n").alias("n")).collect():
        counts[r.k, r.v] = r.n
    near: list = [[] for _ in partitions]
    for k, (i, bits) in enumerate(blocks):
        values = np.arange(1 << len(bits), dtype=np.uint64)
        apart = np.bitwise_count(values[:, None] ^ values[None, :])
        share = counts[k, :len(values)] / max(n, 1)
        near[i].append((bits, np.stack([(apart == d) @ share for d in range(radius + 1)], axis=1)))
    return Layout(partitions, near, n, radius)


def expected_costs(fps: np.ndarray, at: Layout) -> np.ndarray:
    """[partition, threshold + 1, fingerprint]: probes made and candidates expected."""
    r = at.radius
    out = np.zeros((len(at.partitions), r + 2, len(fps)))
    for i, part in enumerate(at.partitions):
        share = np.zeros((len(fps), r + 1))
        share[:, 0] = 1
        for bits, table in at.near[i]:
            block = table[_bits(fps, bits)]
            share = np.stack([sum(share[:, j] * block[:, d - j] for j in range(d + 1)) for d in range(r + 1)], axis=1)
        probes = np.cumsum([comb(len(part), d) for d in range(r + 1)])
        out[i, 1:] = (np.cumsum(share, axis=1) * at.n + probes).T
    return out


def thresholds(fps: np.ndarray, at: Layout) -> np.ndarray:
    """[fingerprint, partition]: the cheapest thresholds that sum to radius - m + 1, by dynamic programming."""
    cost = expected_costs(fps, at)
    m, levels, n = cost.shape
    total = at.radius + 1  # thresholds + 1 sum to radius + 1
    best = np.full((total + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((m, total + 1, n), np.int8)
    for i in range(m):
        after = np.full_like(best, np.inf)
        for s in range(total + 1):
            for t in range(min(s, levels - 1) + 1):
                new = best[s - t] + cost[i, t]
                less = new < after[s]
                after[s][less] = new[less]
                choice[i, s][less] = t
        best = after
    out = np.zeros((n, m), np.int8)
    left = np.full(n, total)
    for i in reversed(range(m)):
        out[:, i] = choice[i, left, np.arange(n)]
        left -= out[:, i]
    return out - 1


def _index(at: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _unsigned(batch.column(0))
            for i, part in enumerate(at.partitions):
                key = _bits(fps, part) | (i << 48)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps.view(np.int64))], ["key", "fp"])
    return run


def _probe(at: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_fps = _unsigned(batch.column(0))
            for lo in range(0, len(all_fps), 2000):
                fps = all_fps[lo:lo + 2000]
                chosen = thresholds(fps, at)
                for i, part in enumerate(at.partitions):
                    for t in np.unique(chosen[:, i]):
                        mine = fps[chosen[:, i] == t]
                        values = _bits(mine, part) | (i << 48)
                        for d in range(int(t) + 1):
                            masks = np.array([sum(1 << b for b in flip) for flip in combinations(range(len(part)), d)], np.int64)
                            keys = (values[:, None] ^ masks[None, :]).ravel()
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(keys), pa.array(np.repeat(mine, len(masks)).view(np.int64))], ["key", "fp"]
                            )
    return run


def links(fps: DataFrame, radius: int = 4, partitions: int = 3) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct longs in column ``fp`` that differ in 1 to ``radius`` bits; pairs may repeat.

    ``partitions`` trades probes against candidates (fewer suit larger tables); the result is the same.
    A value that very many fingerprints share in one partition raises its estimate, so they
    put their thresholds elsewhere; what is left of its skew, the join's skew splitting deals out.
    Spark sizes the index and the probes by the fingerprints they are made from, of which each makes very many rows, so
    it would broadcast them through the driver; the hint has them shuffled at any size.
    """
    if not 1 <= partitions <= radius + 1:
        raise ValueError("partitions must be between 1 and radius + 1")
    at = layout(fps, partitions, radius)
    index = map_batches(fps.select("fp"), _index(at), "key long, fp long").toDF("key", "a")
    probes = map_batches(fps.select("fp"), _probe(at), "key long, fp long").toDF("key", "b")
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return index.join(probes.hint("merge"), (index.key == probes.key) & (F.col("a") < F.col("b")) & (apart <= radius)).select("a", "b")


def classes(nodes: DataFrame, radius: int, partitions: int) -> DataFrame:
    """(fp, label) for the distinct fingerprints of ``nodes``: equal labels for fingerprints that links connect."""
    found = components(links(nodes.select("fp"), radius, partitions))
    return materialise(nodes.join(found, nodes.fp == found.node, "left").select("fp", F.coalesce("label", "fp").alias("label")), "labels")


def near_duplicates(
    docs: DataFrame, size: int = 4, radius: int = 4, partitions: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fp (long), component_id of each row of ``docs``.

    Texts whose fingerprints differ in at most ``radius`` bits are linked; component_id is the smallest doc_id that can
    be reached. Equal fingerprints are one node, so copies make no pairs. Null and empty texts have
    fingerprint zero, linked like any other; repeated rows stay; rows without doc_id stay, and take the
    component's smallest doc_id (null if it has none); an empty table gives an empty result; other columns are ignored.
    """
    marked = materialise(simhash(docs, size, id_col, text_col), "fingerprints")
    nodes = materialise(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labelled = classes(nodes, radius, partitions).join(nodes.hint("merge"), "fp")
    first = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    class_of = labelled.join(first, "label").select("fp", "component_id")
    return marked.join(class_of.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, size: int = 4, radius: int = 4, partitions: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: the one with the smallest doc_id, null ids last.

    Of rows with that doc_id one stays, also if they are equal in all columns. Texts without words make a class of
    their own kind, fingerprint zero. All columns are kept as they are; an empty table gives an empty result.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    texts = rows.select("row", "doc.text")
    marked = simhash(texts, size, "row").withColumnRenamed("doc_id", "row")
    ids = rows.select("row", F.col("doc.doc_id").alias("id"))
    place = F.struct(F.col("id").isNull(), "id", "row")
    marked = materialise(marked.join(ids.hint("merge"), "row").select("fp", "row", place.alias("place")), "fingerprints")
    nodes = materialise(marked.groupBy("fp").agg(F.min("place").alias("first")), "nodes")
    labelled = classes(nodes, radius, partitions).join(nodes.hint("merge"), "fp")
    kept = labelled.groupBy("label").agg(F.min("first").alias("first")).select("first.row")
    dropped = materialise(marked.select("row").join(kept, "row", "left_anti"), "dropped")
    return rows.join(dropped, "row", "left_anti").select("doc.*")
