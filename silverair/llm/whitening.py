"""Whitening of embeddings by distributed block matrices.

Entries become integers, so counts, sums and deviations are exact. Each distinct
vector enters the fit once. Centred rows are indexed into a BlockMatrix; its
transpose times itself is the scatter matrix, whose eigenvectors are found on the
driver (dimensions squared, no rows). A second product, of all rows with the
whitening matrix, projects them.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverair.session import materialise

BLOCK = 1024
# Row blocks that one task of the scatter product multiplies.
BLOCKS_PER_TASK = 8
# Directions with less than this share of the variance are rounding, not components.
LEAST_SHARE = 1e-12
LONG = 2**63
RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    """No null vector, no null or non-finite entry."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def steps(vector: Column, scale: int) -> Column:
    """Entries times ``scale``, rounded down. Beyond 64 bits they stay at the largest or smallest long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale))


def indexed(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written, with a number from 0 without gaps. Only one count per partition is gathered."""
    placed = materialise(rows.withColumn("place", F.monotonically_increasing_id()), "vectors")
    part = F.shiftright("place", 33).alias("part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    number = F.col("offset") + F.col("place").bitwiseAND((1 << 33) - 1)
    return placed.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn(name, number).drop("place", "part", "offset")


def block_matrix(rows: DataFrame, mean: np.ndarray, count: int) -> BlockMatrix:
    """Centred ``x`` of ``rows`` (row, x) as blocks. A number that no row has is a row of zeros."""
    middle = F.array(*map(F.lit, mean.tolist()))
    centred = F.zip_with("x", middle, lambda a, b: a.cast("double") - b)
    table = rows.select(F.col("row").alias("index"), array_to_vector(centred).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(table, "vector"), count, len(mean)).toBlockMatrix(BLOCK, BLOCK)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose of ``matrix`` times ``matrix``.

    All its rows meet in one block, so the product is split along them and the
    parts are added up; else one task would gather all rows.
    """
    parts = -(-matrix.numRowBlocks // BLOCKS_PER_TASK)
    left, right = (m._java_matrix_wrapper for m in (matrix.transpose(), matrix))
    product = left.call("multiply", right._java_model, parts)
    return BlockMatrix(product, BLOCK, BLOCK).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, directions: np.ndarray) -> DataFrame:
    """``row`` and ``values`` of ``matrix`` times ``directions``."""
    context = matrix.blocks.context
    blocks = [((i // BLOCK, 0), directions[i : i + BLOCK]) for i in range(0, len(directions), BLOCK)]
    local = [(place, DenseMatrix(*part.shape, part.ravel(order="F").tolist())) for place, part in blocks]
    product = matrix.multiply(BlockMatrix(context.parallelize(local), BLOCK, BLOCK))
    rows = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("row"), vector_to_array("vector").alias("values"))


def exact_deviation(count: int, sums: list[int]) -> Column:
    """Sum of (count * x - sum) squared over the dimensions; null where it leaves 64 bits."""
    if any(abs(s) >= LONG for s in sums):
        return F.lit(None).cast("long")
    shifted = F.zip_with(
        "x", F.array(*map(F.lit, sums)), lambda a, s: F.try_subtract(F.try_multiply(F.lit(count).cast("long"), a), s.cast("long"))
    )
    return F.aggregate(shifted, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    components: int = 4,
) -> DataFrame:
    """Each usable row on the leading ``components`` of the fit, one row per component.

    Columns: id, ``component`` from 1 by falling eigenvalue, ``n`` (distinct vectors of
    the fit), ``deviation`` (sum of (n * x - S) squared over the dimensions, exact; null
    beyond 64 bits), ``whitened``, ``explained`` (share of the variance) and
    ``identity_error`` (largest absolute entry of the covariance of ``whitened`` over the
    fit, minus the identity).

    Null vectors and those with null, NaN or infinite entries are dropped. The
    dimension is that of most usable vectors, the larger of equally frequent ones;
    vectors of another length are dropped like unusable ones. Directions without
    variance are no components: a fit of one vector, of equal vectors or of an empty table
    has none, and no rows. Ids may be null or repeat; repeated rows give
    repeated results. Other columns are not read.
    """
    spark, kind = vectors.sparkSession, vectors.schema[id_column].dataType.simpleString()
    vector = F.col(vector_column)
    whole = vectors.where(usable(vector)).select(F.col(id_column).alias("id"), steps(vector, scale).alias("x"))
    rows = indexed(whole, "row")
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    size = lengths.length if lengths else 0
    rows = rows.where(F.size("x") == size)
    # Copies combine on the map side; a fit row has the number of its first copy.
    fit = materialise(rows.groupBy("x").agg(F.min("row").alias("row")), "fit")
    places = fit.select(F.posexplode("x").alias("place", "entry"))
    sums = places.groupBy("place").agg(F.sum(F.col("entry").cast("decimal(20,0)")).cast("string")).orderBy("place").collect()
    sums, n = [int(s) for _, s in sums], fit.count()
    empty = spark.createDataFrame([], f"`{id_column}` {kind}, {RESULT}")
    if not n or not size:
        return empty

    mean = np.array([s / n for s in sums])
    count = rows.agg(F.max("row")).first()[0] + 1
    covariance = scatter(block_matrix(fit, mean, count)) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    total = float(np.trace(covariance))
    order = [i for i in order if values[i] > LEAST_SHARE * total]
    if not order:
        return empty
    spread = values[order]
    found = materialise(projected(block_matrix(rows, mean, count), directions[:, order] / np.sqrt(spread)), "whitened")

    pairs = [(i, j) for i in range(len(order)) for j in range(i + 1)]
    at = [F.col("values")[i] for i in range(len(order))]
    moments = [F.avg(v) for v in at] + [F.avg(at[i] * at[j]) for i, j in pairs]
    got = found.join(fit.select("row"), "row", "left_semi").agg(*[m.alias(f"m{i}") for i, m in enumerate(moments)]).first()
    error = max(abs(got[len(at) + k] - got[i] * got[j] - (i == j)) for k, (i, j) in enumerate(pairs))

    shares = F.array(*[F.lit(float(v / total)) for v in spread])
    joined = rows.withColumn("deviation", exact_deviation(n, sums)).join(found, "row")
    listed = joined.select("id", "deviation", F.posexplode("values").alias("place", "whitened"))
    return listed.select(
        F.col("id").alias(id_column),
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
