"""Operator 12: embeddings whitened with MLlib's BlockMatrix.

Entries become whole numbers, x = floor(64 c) + 1,000,000, so counts, sums and
deviations are exact. The fit list (each distinct vector once) is centred
exactly, n x - S before the division by n, and indexed into an IndexedRowMatrix
and from there a BlockMatrix. Its transpose times itself is the scatter matrix
(d x d, the only matrix that reaches the driver); ``numpy.linalg.eigh`` gives
the components, and the BlockMatrix of all rows is multiplied by the whitening
matrix. Blocks hold about 2 MB; the product over the rows is cut along the
rows (``numMidDimSplits``), so no task meets more than ``TOGETHER`` blocks.

Defined cases: rows whose vector is null or empty, or holds null or non-finite
entries, take no part; of vectors of several lengths only those of the most
frequent (then the greatest) length do. Entries beyond 2^54 in size count as
2^54. A component without variance (its eigenvalue below 1e-13 of the first)
has null as ``whitened``; ``identity_error`` is over the others and null if
there is none; ``explained`` is null if no dimension varies. ``deviation`` is
null where it passes 64 bits. Repeated rows are one entry of the fit list and
each has its result; null ids are kept; other columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm import workers

SCALE, OFFSET = 64, 1_000_000
ENTRIES = 1 << 18  # entries of a block
TOGETHER = 8  # blocks on a side that one task multiplies
FLAT = 1e-13  # share of the first eigenvalue below which a component has no variance

_RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, x) of the rows that take part, with x as whole numbers."""
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < F.lit(float("inf"))))  # NaN is greater than any number
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0].d if lengths else 0
    limit = float(1 << 60)
    whole = lambda c: F.floor(F.greatest(F.least(F.lit(float(SCALE)) * c, F.lit(limit)), F.lit(-limit))) + F.lit(OFFSET)
    return rows.where(F.size("v") == d).select("id", F.transform("v", whole).alias("x"))


def indexed(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written with a gapless ``index`` from 0: the place in its file behind the rows of the files before."""
    rows = workers.keep(df.withColumn("mid", F.monotonically_increasing_id()), tag)
    rows = rows.withColumn("part", F.shiftright("mid", 33))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = rows.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "part").withColumn("index", F.col("start") + F.col("mid").bitwiseAND(F.lit((1 << 33) - 1))) \
        .drop("mid", "part", "start")


def centred_batches(batches, n: int, sums: list[int]):
    """(index, x) as (index, x - S / n, sum of (n x - S)^2), in whole numbers up to the division."""
    s = np.array(sums, dtype=object)
    top = max([abs(v) for v in sums], default=0)
    for batch in batches:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(sums))
        big = int(np.abs(x).max(initial=0)) * n + top  # bound of every |n x - S|
        if big < 1 << 62:
            diff = n * x - s.astype(np.int64)
            most = int(np.abs(diff).max(initial=0))
            square = (diff * diff).sum(axis=1).tolist() if most * most * len(sums) < 1 << 63 \
                else (diff.astype(object) ** 2).sum(axis=1).tolist()
            centre = diff / n  # |n x - S| < 2^53 divides exactly rounded; beyond, within two roundings
        else:
            diff = n * x.astype(object) - s
            square = (diff ** 2).sum(axis=1).tolist()
            centre = np.array([[v / n for v in row] for row in diff.tolist()], dtype=float).reshape(x.shape)
        flat = pa.array(np.ascontiguousarray(centre).ravel())
        offsets = pa.array(np.arange(0, x.size + 1, max(len(sums), 1)), pa.int32())
        square = [v if v < 1 << 63 else None for v in square]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat), pa.array(square, pa.int64())],
                                         ["index", "centred", "deviation"])


def block_matrix(centred: DataFrame, rows: int, d: int) -> BlockMatrix:
    """Indexed centred rows as a matrix of blocks of about ``ENTRIES`` entries."""
    vectors = centred.select("index", array_to_vector("centred").alias("vector"))
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), rows, d)
    wide = min(d, 1024)
    return matrix.toBlockMatrix(max(ENTRIES // wide, 64), wide)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, summed over groups of row blocks."""
    blocks = -(-matrix.numRows() // matrix.rowsPerBlock)
    java = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, -(-blocks // TOGETHER))
    return BlockMatrix(java, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def times(matrix: BlockMatrix, small: np.ndarray) -> BlockMatrix:
    """The matrix times a small one."""
    spark_context = matrix.blocks.context
    rows, cols = small.shape
    parts = [((i, 0), Matrices.dense(len(b), cols, b.ravel(order="F").tolist()))
             for i, at in enumerate(range(0, rows, matrix.colsPerBlock)) for b in [small[at:at + matrix.colsPerBlock]]]
    return matrix.multiply(BlockMatrix(spark_context.parallelize(parts, 1), matrix.colsPerBlock, cols, rows, cols))


def rows_of(matrix: BlockMatrix) -> DataFrame:
    """(index, values) of a matrix's rows."""
    java = matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    return callMLlibFunc("getIndexedRows", java).select("index", vector_to_array("vector").alias("values"))


def whitened(df: DataFrame, top: int = 16, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id``, component, n, deviation, whitened, explained, identity_error of every usable row and component up to ``top``."""
    spark = df.sparkSession
    everyone = indexed(whole_numbers(df, vec_id, vector), "vectors")
    fit = indexed(everyone.select("x").distinct(), "fit")
    sums = fit.select(F.posexplode("x").alias("i", "x")).groupBy("i").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count("x").alias("n")).orderBy("i").collect()
    if not sums:
        return spark.createDataFrame([], _RESULT).withColumnRenamed("id", vec_id)
    n, s, d = sums[0].n, [int(r.s) for r in sums], len(sums)
    total = everyone.count()
    centre = workers.task(__name__, "centred_batches", n=n, sums=s)
    schema = "index long, centred array<double>, deviation long"
    fitted = block_matrix(workers.keep(fit.select("index", "x").mapInArrow(centre, schema), "fit-centred"), n, d)
    rows = workers.keep(everyone.select("index", "x").mapInArrow(centre, schema), "centred")

    value, axes = np.linalg.eigh(scatter(fitted) / n)
    value, axes = np.maximum(value[::-1], 0.0), axes[:, ::-1]
    many = min(top, d)
    varies = int((value[:many] > FLAT * value[0]).sum()) if value[0] > 0 else 0
    explained = (value[:many] / value.sum()).tolist() if varies else [None] * many
    error = None
    values = None
    if varies:
        whitening = axes[:, :varies] / np.sqrt(value[:varies])
        error = float(np.abs(scatter(times(fitted, whitening)) / n - np.eye(varies)).max())
        values = rows_of(times(block_matrix(rows, total, d), whitening))
    found = everyone.select("index", "id").join(rows.select("index", "deviation"), "index")
    found = found.join(values, "index") if varies else found.withColumn("values", F.array().cast("array<double>"))
    flat = F.array(*[F.lit(None).cast("double")] * (many - varies)).cast("array<double>")
    shares = F.array(*[F.lit(x).cast("double") for x in explained])
    return found.select("id", "deviation", F.posexplode(F.concat("values", flat)).alias("c", "whitened")).select(
        F.col("id").alias(vec_id), (F.col("c") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(shares, "c").alias("explained"), F.lit(error).cast("double").alias("identity_error"))
