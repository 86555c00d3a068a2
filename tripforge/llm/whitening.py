"""Embedding whitening (operator 12) on Spark MLlib block matrices.

Each entry c becomes the whole number x = floor(scale * c) + shift, so that the
fit list (every distinct vector once), its size n and the sums S of its
dimensions are exact.  The centred rows x - S / n, got from the whole numbers
n * x - S, are indexed into a distributed ``BlockMatrix``; its transpose times
itself is the scatter, whose eigenvectors come from a local ``eigh`` (a square
of dimensions, whatever the number of rows).  A second ``BlockMatrix`` product
projects all rows onto the whitening matrix, a third one the fit list, whose
covariance then shows how far from the identity the result is.

MLlib deals the products of a matrix by its transpose to the blocks of the
result, here a single one; the middle dimension is therefore split over as many
tasks as the session deals shuffles to (``numMidDimSplits``, which the Python
class does not pass on).

Defined cases: vectors that are null, hold null or non-finite entries, or
entries whose x does not fit a long (2 ** 61 and more) are dropped; so are vectors of another
length than the commonest (of equally common lengths the longest) and those of
length 0; equal vectors are fitted once and returned each; repeated and null ids
keep a row each.  Components whose eigenvalue is not above 1e-12 of the trace
have no whitened value (null).  ``deviation`` is null where it does not fit a
long.  An empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripforge.llm.common import keys, staged

SCALE, SHIFT = 64, 1_000_000
ROWS_PER_BLOCK = 1024
FLAT = 1e-12                              # share of the trace that an eigenvalue must exceed
OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(df: DataFrame, vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, x): the rows that take part, entries as whole numbers."""
    c = F.col(vector).cast("array<double>")
    fits = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float(2 ** 61) / scale)))
    x = F.transform(c, lambda e: F.floor(e * F.lit(float(scale))) + F.lit(shift).cast("long"))
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(c.isNotNull() & fits, x).alias("x"))
            .filter("x IS NOT NULL AND size(x) > 0"))


def indexed(df: DataFrame) -> DataFrame:
    """``df`` (staged, its rows numbered by ``__key``) with a gap-free ``__index``.

    The number of rows of each written partition is all that reaches the driver."""
    part = F.shiftright("__key", 33)
    counts = df.groupBy(part.alias("part")).count().orderBy("part").collect()
    first, at = [], 0
    for r in counts:
        first.append((r.part, at))
        at += r["count"]
    starts = df.sparkSession.createDataFrame(first, "part long, first long")      # a row for each task of the write
    return (df.join(F.broadcast(starts), part == F.col("part"))
            .withColumn("__index", F.col("first") + F.col("__key").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("part", "first"))


def block_matrix(rows: DataFrame, n: int, d: int) -> BlockMatrix:
    """(__index, centred) as distributed blocks."""
    vectors = MLUtils.convertVectorColumnsFromML(
        rows.select(F.col("__index").alias("index"), array_to_vector("centred").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, d).toBlockMatrix(ROWS_PER_BLOCK, d)


def scatter(blocks: BlockMatrix, splits: int) -> np.ndarray:
    """Transpose times the matrix itself, its middle dimension in ``splits`` parts."""
    left, right = blocks.transpose(), blocks
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def project(blocks: BlockMatrix, matrix: np.ndarray) -> BlockMatrix:
    d, k = matrix.shape
    one = SparkContext.getOrCreate().parallelize([((0, 0), DenseMatrix(d, k, matrix.ravel(order="F")))], 1)
    return blocks.multiply(BlockMatrix(one, d, k, d, k))


def indexed_rows(blocks: BlockMatrix) -> DataFrame:
    """(__index, values) of a block matrix."""
    rows = callMLlibFunc("getIndexedRows", blocks.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("__index"), vector_to_array("vector").alias("values"))


def whiten(df: DataFrame, components: int = 16, vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row and component."""
    spark = df.sparkSession
    rows = whole_vectors(df, vector)
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy("count", "d", ascending=[False, False]).first()
    if lengths is None:
        return spark.createDataFrame([], OUTPUT)
    d = lengths.d
    rows = staged(rows.filter(F.size("x") == d).withColumn("__key", keys()), "whitening-rows")
    fit = staged(rows.select("x").distinct().withColumn("__key", keys()), "whitening-fit")
    # exact sums: a decimal for each dimension, of partial sums of whole numbers
    sums = (fit.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count("v").alias("n"),
                 F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("i").collect())
    n = sums[0].n
    # n * x - S = n * (x - whole part of the mean) - rest, in the narrowest type that holds it and its squares' sum
    means = [int(r.s) // n for r in sums]
    reach = n * (max(max(r.hi - m, m - r.lo) for r, m in zip(sums, means)) + 1)
    whole = "bigint" if reach < 2 ** 62 else "decimal(38,0)"
    square = "bigint" if d * reach * reach < 2 ** 62 else "decimal(38,0)"
    mean = F.array(*[F.lit(m).cast(whole) for m in means])
    rest = F.array(*[F.lit(int(r.s) - n * m).cast(whole) for r, m in zip(sums, means)])
    times = F.lit(n).cast("bigint" if whole == "bigint" else "decimal(18,0)")
    near = F.zip_with("x", mean, lambda v, m: (v - m if whole == "bigint" else (v - m).cast("decimal(20,0)")) * times)
    apart = F.zip_with(near, rest, lambda v, r: (v - r).cast(whole))
    centred = F.transform(apart, lambda v: v.cast("double") / F.lit(float(n)))

    def prepared(frame: DataFrame) -> DataFrame:
        return indexed(frame).withColumn("centred", centred)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n_rows = rows.count()
    fit_blocks = block_matrix(prepared(fit), n, d)
    cov = scatter(fit_blocks, parts) / n
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    e, trace = values[order], float(np.trace(cov))
    live = e > FLAT * trace if trace > 0 else np.zeros(len(e), bool)
    k = int(live.sum())                            # falling eigenvalues: the live ones come first

    if k:
        matrix = vectors[:, order[:k]] / np.sqrt(e[:k])
        matrix *= np.where(matrix[np.abs(matrix).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
        whitened = scatter(project(fit_blocks, matrix), parts) / n
        error = float(np.abs(whitened - np.eye(k)).max())
        projected = indexed_rows(project(block_matrix(prepared(rows), n_rows, d), matrix))
    if square == "bigint":
        squares = F.aggregate(apart, F.lit(0).cast("bigint"), lambda a, v: a + v * v)
    else:
        squares = F.aggregate(
            F.transform(apart, lambda v: F.try_multiply(v.cast("decimal(38,0)"), v.cast("decimal(38,0)")).try_cast("decimal(38,0)")),
            F.lit(0).cast("decimal(38,0)"), lambda a, v: F.try_add(a, v).try_cast("decimal(38,0)")).try_cast("bigint")
    wide = indexed(rows).select("__index", "vec_id", squares.alias("deviation"))
    if k:
        wide = wide.join(projected, "__index")
    else:
        wide, error = wide.withColumn("values", F.array().cast("array<double>")), None
    share = F.array(*[F.lit(float(v / trace)) if trace > 0 else F.lit(None).cast("double") for v in e])
    return wide.select(
        "vec_id", F.posexplode(share).alias("__place", "explained"), "deviation", "values").select(
        "vec_id", (F.col("__place") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.get("values", F.col("__place")).alias("whitened"), "explained", F.lit(error).cast("double").alias("identity_error"))
