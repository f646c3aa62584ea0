"""Whitening of embeddings along principal components, by distributed block matrices.

Entries become whole numbers: 256 times the entry, rounded down. The fit list has each distinct vector once; its size and the
sums of its dimensions are exact. Its centred rows are an indexed row matrix, cut into row blocks; the block matrix times
its own transpose is the scatter matrix. That product has one result block per pair of column blocks, so its middle dimension is
split: no task holds more than some row blocks, and partial products are added. The scatter matrix (dimension x
dimension, at most ``MAX_DIMENSION`` squared) is decomposed on the driver. The centred rows of all vectors, as row blocks,
times the whitening matrix are the result.

Vectors that are null, empty or hold null or non-finite entries are left out, and so are those that have not the
most common length (of lengths equally common: the greater). Entries beyond 2**31 in size count as that. Repeated rows and equal
vectors get a result each and count once in the fit. A null id is an id like any other. Components whose variance is rounding
error (below 1e-12 of the whole) cannot be whitened and are left out; so a table of equal vectors gives no rows, as an empty one
does. A deviation that a long cannot hold is null. Components of equal variance are told apart arbitrarily, but equally for all
rows. Only the id and the vector are read, so other columns cannot clash; texts do not occur.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spread import numbered, written

# Fixed values
SCALE = 256
COMPONENTS = 4

ENTRY_LIMIT = float(1 << 31)
MAX_DIMENSION = 4096
RANK_TOLERANCE = 1e-12

# Sizes of blocks, and row blocks that one task multiplies.
ROWS_PER_BLOCK, COLUMNS_PER_BLOCK, BLOCKS_PER_TASK = 4096, 1024, 8

SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id`` and ``x``, the entries as whole numbers, of the usable vectors of the most common length."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    usable = vectors.where(F.coalesce((F.size(vector) > 0) & sound, F.lit(False)))

    def entry(c: Column) -> Column:
        return F.floor(F.least(F.greatest(SCALE * c.cast("double"), F.lit(-ENTRY_LIMIT)), F.lit(ENTRY_LIMIT)))

    found = usable.select(F.col(id_column).alias("vec_id"), F.transform(vector, entry).cast("array<bigint>").alias("x"))
    length = F.size("x").alias("length")
    common = found.groupBy(length).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("length")).first()
    return found.where(F.size("x") == (common["length"] if common else 0))


def _blocks(rows: DataFrame, count: int, dimension: int) -> BlockMatrix:
    """A block matrix of ``index`` and ``centred``."""
    vectors = rows.select("index", array_to_vector("centred").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), count, dimension)
    return matrix.toBlockMatrix(ROWS_PER_BLOCK, min(dimension, COLUMNS_PER_BLOCK))


def _scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times the matrix, its rows split over tasks."""
    splits = 1 + (matrix.numRows() // ROWS_PER_BLOCK) // BLOCKS_PER_TASK
    left, right = (m._java_matrix_wrapper._java_model for m in (matrix.transpose(), matrix))
    # Python's own call has no splits, and would bring all blocks of one result block to one task.
    product = BlockMatrix(left.multiply(right, splits), matrix.colsPerBlock, matrix.colsPerBlock)
    return product.toLocalMatrix().toArray()


def _project(matrix: BlockMatrix, weights: np.ndarray, rows: DataFrame) -> DataFrame:
    """``index`` and the products of its row with the columns of ``weights``."""
    spark, height = rows.sparkSession, matrix.colsPerBlock
    parts = [
        ((i, 0), Matrices.dense(len(part), part.shape[1], part.T.ravel().tolist()))
        for i, part in enumerate(np.split(weights, range(height, len(weights), height)))
    ]
    factor = BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), height, weights.shape[1])
    product = matrix.multiply(factor).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", product._java_matrix_wrapper._java_model)
    return found.select("index", vector_to_array("vector").alias("whitened"))


def principal(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The greatest eigenvalues of the covariance, their unit vectors as columns, and its trace. Of a vector's two signs,
    that which makes its greatest entry positive."""
    covariance = scatter / n
    trace = float(np.trace(covariance))
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    kept = [i for i in np.argsort(-values)[:components] if values[i] > trace * RANK_TOLERANCE]
    vectors = vectors[:, kept]
    signs = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(len(kept))])
    return values[kept], vectors * signs, trace


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row per usable vector and component: the columns of ``SCHEMA``."""
    spark = vectors.sparkSession
    usable = whole(vectors, id_column, vector).withColumn("row", F.monotonically_increasing_id())
    rows = written(numbered(written(usable, "usable"), [], ["row"], ["row"], "index").drop("row"), "indexed")
    fit = written(rows.groupBy("x").agg(F.min("index").alias("index")), "fit")
    count, n = rows.count(), fit.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    dimension = len(rows.first()["x"])
    if dimension > MAX_DIMENSION:
        raise ValueError(f"vectors of {dimension} entries; the scatter matrix is bounded by {MAX_DIMENSION}")

    totals = fit.agg(*[F.sum(F.col("x")[i].cast("decimal(11,0)")).alias(f"s{i}") for i in range(dimension)]).first()
    sums = [int(s) for s in totals]
    means = F.array(*[F.lit(s / n) for s in sums])
    centred = F.zip_with("x", means, lambda x, m: x.cast("double") - m).alias("centred")
    scatter = _scatter(_blocks(fit.select("index", centred), count, dimension))
    values, axes, trace = principal(scatter, n, components)
    if not len(values):
        return spark.createDataFrame([], SCHEMA)

    product = _project(_blocks(rows.select("index", centred), count, dimension), axes / np.sqrt(values), rows)
    projected = written(product, "projected")
    error = identity_error(projected.join(fit.select("index"), "index", "left_semi"), len(values))

    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    result = rows.select("index", "vec_id", deviation(F.col("x"), n, sums).alias("deviation")).join(projected, "index")
    return result.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        shares[F.col("place")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def deviation(x: Column, n: int, sums: list[int]) -> Column:
    """The sum over dimensions of (n x - S) squared, in whole numbers."""
    total = F.array(*[F.lit(Decimal(s)).cast("decimal(38,0)") for s in sums])
    factor = F.lit(n).cast("decimal(19,0)")

    def square(entry: Column, s: Column) -> Column:
        distance = (entry.cast("decimal(18,0)") * factor - s).try_cast("decimal(18,0)")
        return (distance * distance).cast("decimal(38,0)")

    start = F.lit(0).cast("decimal(38,0)")
    added = F.aggregate(F.zip_with(x, total, square), start, lambda a, b: (a + b).try_cast("decimal(38,0)"))
    return added.try_cast("long")


def identity_error(whitened: DataFrame, components: int) -> float:
    """The greatest distance of an entry of the covariance from the identity's."""
    entry = [F.col("whitened")[i] for i in range(components)]
    means = whitened.agg(*[F.avg(e).alias(f"m{i}") for i, e in enumerate(entry)]).first()
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    products = [F.avg((entry[i] - means[i]) * (entry[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]
    found = whitened.agg(*products).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, found))
