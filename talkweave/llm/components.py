"""Connected components of a graph that is a table of edges between longs."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.llm.arrays import map_batches
from talkweave.staging import materialise


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of each batch's edges, as stars around the smallest node."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            top = x
            while (up := parent.get(top, top)) != top:
                top = up
            while (up := parent.get(x, x)) != top:
                parent[x] = top
                x = up
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        low = [(x, root(x)) for x in parent]
        low = [(x, r) for x, r in low if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in low], pa.int64()), pa.array([r for _, r in low], pa.int64())], ["u", "v"]
        )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("u") % 1000003)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of each node with a link: label is the smallest node it can reach.

    ``edges`` has two long columns. Rounds of large-star and small-star steps, whose number is logarithmic in
    practice, each written to the shared folder. The smallest neighbour comes from an aggregate
    that combines before its shuffle and is joined back, so no node's neighbours meet in one task.
    Self-links and repeated links change nothing; no edges give no rows.
    """
    a, b = edges.columns
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    now = materialise(map_batches(pairs, _forest, "u long, v long"), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ordered = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        now = materialise(ordered.union(least.toDF("u", "v")).distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    labels = now.toDF("node", "label")
    return labels.union(labels.select("label", "label").distinct())
