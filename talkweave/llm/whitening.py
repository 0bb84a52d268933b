"""Whitening of embeddings with MLlib's BlockMatrix.

Entries become whole numbers, so that equal vectors, sums and deviations are exact. Every row gets a dense number; the centred rows
stand in distributed blocks under it. The scatter of the distinct vectors is the block matrix times its own transpose, with the
long dimension split so that no task sees more than a few blocks; its eigenvectors are found locally, for it is as small as a vector is
long. A second product projects all rows. Everything between the two products stays in the JVM.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from talkweave.staging import materialise

#: Scale and shift that turn entries into whole numbers.
SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this cannot be summed as longs.
LARGEST = 1 << 40
COMPONENTS = 16
#: A block has this many bytes at most, and about BLOCKS_PER_CORE blocks are made for each core where there are rows enough.
BLOCK_BYTES, BLOCKS_PER_CORE, LEAST_ROWS = 8 << 20, 4, 1024
#: Eigenvalues below this share of the largest are zero but for rounding: the vectors do not vary in that direction.
VANISHING = 1e-12

EMPTY = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    """``n`` distinct vectors with sums ``sums`` and extremes of each entry; eigenvalues falling, eigenvectors in columns."""

    n: int
    sums: list[int]
    low: list[int]
    high: list[int]
    values: np.ndarray | None = None
    vectors: np.ndarray | None = None
    trace: float = 0.0


def whole_vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, x (array<long>) of the rows whose entries are all there and finite, stored with a dense number ``at``.

    Vectors without entries, with entries too large for LARGEST or of another length than most (ties: the smaller length) cannot be whitened together
    with the others and go too.
    """
    entry = F.col(vector_col)
    fine = F.forall(entry, lambda c: F.coalesce(F.abs(c.cast("double") * SCALE) < LARGEST, F.lit(False)))
    rows = embeddings.where(entry.isNotNull() & (F.size(entry) > 0) & fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT).alias("x"),
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place"),
    )
    rows = materialise(rows, "vectors")
    lengths = rows.groupBy(F.size("x").alias("n")).count()
    usual = lengths.agg(F.max(F.struct("count", -F.col("n"))).alias("most")).first().most
    if usual is not None and lengths.count() > 1:
        rows = rows.where(F.size("x") == -usual[1])
    parts = rows.groupBy("part").agg((F.max("place") + 1).alias("size"))
    before = parts.orderBy("part").collect()  # a pair of numbers per task, whatever the number of rows
    starts = np.cumsum([0, *(r.size for r in before)]).tolist()
    offsets = embeddings.sparkSession.createDataFrame([(r.part, s) for r, s in zip(before, starts)], "part int, start long")
    return rows.join(F.broadcast(offsets), "part").select("vec_id", "x", (F.col("start") + F.col("place")).alias("at"))


def with_first(rows: DataFrame) -> DataFrame:
    """``rows`` with ``fit``: whether a row is the first of those with its vector. A vector that many rows have is one row per task before the shuffle."""
    first = rows.groupBy("x").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("fit"))
    return materialise(rows.join(first, "at", "left").withColumn("fit", F.coalesce("fit", F.lit(False))), "fitted")


def moments(rows: DataFrame) -> Fit:
    """Exact sums and extremes of each entry over the distinct vectors."""
    entries = rows.where("fit").select(F.posexplode("x").alias("d", "x"))
    found = entries.groupBy("d").agg(F.sum("x").alias("s"), F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("n")).collect()
    found.sort(key=lambda r: r.d)
    return Fit(found[0].n if found else 0, [r.s for r in found], [r.low for r in found], [r.high for r in found])


def _block_rows(spark: SparkSession, rows: int, dims: int) -> int:
    wanted = -(-rows // (BLOCKS_PER_CORE * spark.sparkContext.defaultParallelism))
    return max(1, min(max(wanted, LEAST_ROWS), BLOCK_BYTES // (8 * dims)))


def block_matrix(rows: DataFrame, at: str, vector: str, n_rows: int, dims: int, block_rows: int) -> BlockMatrix:
    """``vector`` (array<double>) of every row in blocks, at row number ``at``; missing numbers are rows of zeros."""
    indexed = MLUtils.convertVectorColumnsFromML(rows.select(F.col(at).alias("index"), array_to_vector(vector).alias("vector")), "vector")
    return IndexedRowMatrix(indexed, n_rows, dims).toBlockMatrix(block_rows, dims)


def times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """a @ b with the dimension between them cut into ``splits``, which Python's ``multiply`` has no argument for."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


def indexed_rows(matrix: BlockMatrix) -> DataFrame:
    """(at, projected array<double>) of a block matrix, without a way through Python."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("at"), vector_to_array("vector").alias("projected"))


def local_block(spark: SparkSession, values: np.ndarray) -> BlockMatrix:
    """A small matrix as one block."""
    rows = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(values)], "at long, v array<double>")
    return block_matrix(rows, "at", "v", *values.shape, values.shape[0])


def centred(fit: Fit) -> Column:
    mean = F.array(*[F.lit(s / fit.n) for s in fit.sums])
    return F.zip_with("x", mean, lambda x, m: x.cast("double") - m)


def deviation(fit: Fit) -> Column:
    """Sum of (n * x - sum)^2, exact; null where it is no long. Longs are used where the extremes show that nothing can overflow."""
    widest = sum(max((fit.n * low - s) ** 2, (fit.n * high - s) ** 2) for s, low, high in zip(fit.sums, fit.low, fit.high))
    sums = F.array(*[F.lit(s).cast("long") for s in fit.sums])
    apart = F.zip_with("x", sums, lambda x, s: x * F.lit(fit.n).cast("long") - s)
    if widest < 1 << 63:
        return F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: total + d * d)
    exact = lambda c: c.cast(DecimalType(19, 0))
    wide = F.zip_with("x", sums, lambda x, s: (exact(x) * exact(F.lit(fit.n)) - exact(s)).cast(DecimalType(38, 0)))
    squares = F.transform(wide, lambda d: F.try_multiply(d, d).cast(DecimalType(38, 0)))
    total = F.aggregate(squares, F.lit(0).cast(DecimalType(38, 0)), lambda t, s: F.try_add(t, s).cast(DecimalType(38, 0)))
    return total.try_cast("long")


def fit_components(rows: DataFrame, fit: Fit, n_rows: int, components: int) -> BlockMatrix:
    """Fill in eigenvalues and eigenvectors of the covariance, and give the centred block matrix of all rows."""
    dims = len(fit.sums)
    block_rows = _block_rows(rows.sparkSession, n_rows, dims)
    splits = -(-n_rows // block_rows)
    distinct = block_matrix(rows.where("fit").select("at", centred(fit).alias("v")), "at", "v", n_rows, dims, block_rows)
    covariance = times(distinct.transpose(), distinct, splits).toLocalMatrix().toArray() / fit.n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > VANISHING * max(values.max(), 0)]
    fit.values, fit.vectors, fit.trace = values[order], vectors[:, order], float(np.trace(covariance))
    return block_matrix(rows.select("at", centred(fit).alias("v")), "at", "v", n_rows, dims, block_rows)


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of column ``projected`` over the distinct vectors, less the identity."""
    column = [F.col("projected")[i] for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = whitened.where("fit").agg(*[F.covar_pop(column[i], column[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs))


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every row and component, as the class of the same distinct vectors gives them.

    Rows without a vector or with null or infinite entries or NaN go, as do those ``whole_vectors`` names; null and repeated ids and repeated rows
    stay, and equal vectors count once in the fit. Components along which the vectors do not vary are left out, since they have no unit variance: of equal
    vectors only there is none, so no row comes back. An empty table gives an empty result; other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = with_first(whole_vectors(embeddings, id_col, vector_col))
    fit, n_rows = moments(rows), (rows.agg(F.max("at")).first()[0] or 0) + 1
    blocks = fit_components(rows, fit, n_rows, components) if fit.n > 1 else None
    if blocks is None or not len(fit.values):
        return spark.createDataFrame([], EMPTY)
    matrix = fit.vectors / np.sqrt(fit.values)
    projected = indexed_rows(times(blocks, local_block(spark, matrix), 1))
    whitened = materialise(projected.join(rows.select("at", "vec_id", "fit", deviation(fit).alias("deviation")), "at"), "whitened")
    error = identity_error(whitened, len(fit.values))
    explained = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values])
    entries = whitened.select("vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("projected").alias("w"), explained.alias("e"))).alias("d", "c"))
    return entries.select(
        "vec_id", (F.col("d") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"), "deviation",
        F.col("c")["w"].alias("whitened"), F.col("c")["e"].alias("explained"), F.lit(error).alias("identity_error"),
    )
