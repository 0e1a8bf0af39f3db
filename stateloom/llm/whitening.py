"""Whitening of embeddings with distributed block matrices.

Entries are taken as whole numbers, x = floor(64 * c) + 1000000, so that sums over all
rows are exact. Rows get consecutive numbers, are centred by the exact sums and become
a block matrix; its transpose times itself is the scatter matrix, added up in as many
parts as there are partitions, since all blocks of rows meet in one block of the result.
Only that matrix, dimensions by dimensions, comes to the driver, for its eigenvectors.
The block matrix times the whitening matrix projects all rows, and the same product of
the projected rows measures how far their covariance is from the identity.

Defined cases: rows whose vector is null, empty, or holds a null, a non-finite entry or one
whose x has more than ``X_BITS`` bits are dropped. All vectors have the length that most
of them have (the longer one of a tie); others are dropped. Repeated rows and rows of a
null or repeated id stay rows of their own. An eigenvalue that is nothing beyond rounding
gives no component, so equal vectors, a single one or an empty table give no rows. A
deviation beyond a long is null. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stateloom.llm.storage import stored
from stateloom.sources.files import shared_dir

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
X_BITS = 40
#: Entries of a block of rows: 4 MB. More rows mean more blocks, of which the driver holds two numbers each.
BLOCK_ENTRIES = 1 << 19

RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _numbered(vectors: DataFrame, folder: str) -> tuple[DataFrame, int, int]:
    """index (0, 1, ...), vec_id and x of the rows that count, their number and their length."""
    entry = F.col("embedding")
    limit = float(2**X_BITS)
    sound = F.forall(
        entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) * SCALE < limit)
    )
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long"))
    rows = vectors.where(entry.isNotNull() & (F.size(entry) > 0) & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"), F.size(entry).alias("length")
    )
    rows = stored(rows, folder, "vectors")
    common = rows.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    if common is None:
        return rows, 0, 0
    rows = rows.where(F.col("length") == common["length"]).withColumn("place", F.monotonically_increasing_id())
    rows = stored(rows.drop("length"), folder, "placed")
    # A place holds the partition above its 33 lowest bits: there is a row for each partition here.
    part = F.shiftrightunsigned("place", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).select(
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    index = F.col("offset") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.withColumn("part", part).join(offsets, "part").select(index.alias("index"), "vec_id", "x")
    return stored(numbered, folder, "numbered"), common["count"], common["length"]


def _times(left: BlockMatrix, right: BlockMatrix, parts: int) -> BlockMatrix:
    """The product, whose sums over inner blocks are made in that many parts before they are added."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, parts)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def _scatter(rows: BlockMatrix) -> np.ndarray:
    """Transpose times itself: dimensions by dimensions, the only matrix that is brought together."""
    inner = max(1, min(rows.numRowBlocks, rows.blocks.getNumPartitions()))
    return _times(rows.transpose(), rows, inner).toLocalMatrix().toArray()


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row and component."""
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    rows, n, d = _numbered(vectors, folder)
    if not n:
        return spark.createDataFrame([], RESULT)
    found = dict(rows.select(F.posexplode("x").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("s")).collect())
    sums = F.array(*(F.lit(found[k]).cast("long") for k in range(d)))
    apart = F.transform(F.arrays_zip(F.col("x"), sums.alias("s")), lambda z: F.try_subtract(F.try_multiply(F.lit(n).cast("long"), z["x"]), z["s"]))
    squares = F.aggregate("apart", F.lit(0).cast("long"), lambda a, v: F.try_add(a, F.try_multiply(v, v)))
    centred = F.transform(
        F.arrays_zip(F.col("x"), F.col("apart"), sums.alias("s")),
        lambda z: F.coalesce(z["apart"].cast("double") / n, z["x"].cast("double") - z["s"].cast("double") / n),
    )
    rows = rows.withColumn("apart", apart).select("index", "vec_id", squares.alias("deviation"), array_to_vector(centred).alias("vector"))

    indexed = MLUtils.convertVectorColumnsFromML(rows.select("index", "vector"), "vector")
    per_block = max(1, BLOCK_ENTRIES // d)
    blocks = IndexedRowMatrix(indexed, n, d).toBlockMatrix(per_block, d)
    value, vector = np.linalg.eigh(_scatter(blocks) / n)
    value, vector = value[::-1], vector[:, ::-1]
    total = float(value.sum())
    kept = int((value[:components] > np.finfo(float).eps * d * max(value[0], 0.0)).sum())
    if not kept:
        return spark.createDataFrame([], RESULT)
    turn = vector[:, :kept] / np.sqrt(value[:kept])
    local = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, kept, turn.ravel(order="F").tolist()))], 1)
    projected = _times(blocks, BlockMatrix(local, d, kept, d, kept), 1)
    error = float(np.abs(_scatter(projected) / n - np.eye(kept)).max())

    turned = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    explained = F.array(*(F.lit(float(e) / total) for e in value[:kept]))
    return (
        rows.select("index", "vec_id", "deviation")
        .join(turned.select("index", vector_to_array("vector").alias("y")), "index")
        .select("vec_id", "deviation", F.posexplode("y").alias("k", "whitened"))
        .select(
            "vec_id",
            (F.col("k") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("k")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
