"""Helpers of the vector searches: usable vectors, blocks of rows, top-k of partial results."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import stage


def usable(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> tuple[DataFrame, int, int]:
    """(vec_id, v) of the vectors that take part, how many there are, and their length.

    Left out: NULL ids and vectors, empty ones, NULL or non-finite components, zero vectors unless ``zero``, and
    vectors of another length than most have (of equally frequent lengths, the longest).  Of the rows that repeat
    a vec_id one stays, that with the smallest vector.
    """
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if not zero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    rows = stage(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return rows, 0, 0
    return rows.where(F.size("v") == lengths["n"]), lengths["count"], lengths["n"]


def whole(df: DataFrame, columns: dict, vector_col: str, name: str) -> tuple[DataFrame, int, int]:
    """(row, *columns, v) of the rows whose vector takes part, how many there are, and the vectors' length.

    Left out: NULL and empty vectors, NULL or non-finite components, and vectors of another length than most have (of
    equally frequent lengths, the longest).  Repeated rows and NULL ids stay; ``row`` tells rows apart and is fixed
    in the staged copy.
    """
    rows = df.select(*[c.alias(n) for n, c in columns.items()], F.col(vector_col).alias("v")).where("size(v) > 0")
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), *columns, "v"), name)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if lengths is None:
        return rows, 0, 0
    return rows.where(F.size("v") == lengths["n"]), lengths["count"], lengths["n"]


def matrix(column: pa.Array | pa.ChunkedArray, length: int) -> np.ndarray:
    """A column of equally long lists as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def in_chunks(queries: DataFrame, id_col: str, size: int) -> tuple[DataFrame, int]:
    """``queries`` with a column chunk that deals them into chunks of about ``size``, and the number of chunks."""
    n = max(1, -(-queries.count() // size))
    return queries.withColumn("chunk", F.pmod(F.xxhash64(id_col, F.lit(3)), F.lit(n)).cast("int")), n


def best(found: DataFrame, k: int, ascending: bool) -> DataFrame:
    """The k best of each query over all partial results (at most k from each block): query_id, rank, vec_id, score."""
    order = F.col("score").asc() if ascending else F.col("score").desc()
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(order, "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
