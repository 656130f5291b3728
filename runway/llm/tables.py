"""Helpers shared by the operators: staged tables, grouped Arrow streams, distributed running totals."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runway.session import shared_path

#: Separators of words: 0x20 and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch between the JVM and Python workers; whole texts stand in them.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow buffers of executors and workers: Spark's 10,000 rows may hold hundreds of MB of text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    small_batches(spark)
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return memory that this Python worker has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``fn`` for ``mapInArrow``; a worker serves many tasks in turn and waits for the next one without what the last one held."""
    def run(batches):
        yield from fn(batches)
        give_back()
    return run


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` with each row in one struct, ``row``, beside the given columns: no name of its columns can clash with theirs."""
    return docs.select(F.struct(*[docs[f"`{c.replace('`', '``')}`"].alias(c) for c in docs.columns]).alias("row"), *[k.alias(n) for n, k in keys.items()])


def unpacked(rows: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``row`` again, some replaced."""
    return rows.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in columns])


def crc32_mod(col: Column, n: int) -> Column:
    """crc32 of the decimal text of an id, modulo ``n``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def running_totals(df: DataFrame, group: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """``df`` with, for each ``out: value`` of ``values``, the sum of ``value`` over the rows before it.

    Order within a group is ``order`` (ascending, NULLs last).  The rows are range-sorted by (group, order), so
    one group spans as many partitions as it needs; the staged copy fixes which row is in which partition.  Sums
    run within a partition, plus an offset from the table of one row per partition and group.  Rows equal in
    all order columns come in any order.
    """
    sort = [F.col(c).asc_nulls_last() for c in group + order]
    ranged = stage(df.repartitionByRange(*sort).withColumn("_pid", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_pid", *group).orderBy(*sort[len(group):]).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranged.groupBy("_pid", *group).agg(*[F.sum(v).alias(f"_sum_{o}") for o, v in values.items()])
    blocks = blocks.select(F.col("_pid").alias("_bpid"), *[F.col(g).alias(f"_b_{g}") for g in group],
                           *[F.coalesce(F.sum(f"_sum_{o}").over(before), F.lit(0)).alias(f"_off_{o}") for o in values])
    rows = ranged.withColumns({f"_in_{o}": F.coalesce(F.sum(v).over(inside), F.lit(0)) for o, v in values.items()})
    match = F.col("_pid") == F.col("_bpid")
    for g in group:
        match &= F.col(g).eqNullSafe(F.col(f"_b_{g}"))
    return rows.join(blocks, match).select(*df.columns, *[(F.col(f"_in_{o}") + F.col(f"_off_{o}")).alias(o) for o in values])


def grouped_stream(batches: Iterator[pa.RecordBatch], keys: list[str], most_rows: int = 1 << 16) -> Iterator[pa.Table]:
    """Cut a partition that is sorted by ``keys`` into tables of whole groups, of about ``most_rows`` rows or one group."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < most_rows:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = group_starts(table, keys)[-1]
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
        rows = table.num_rows - cut
        most_rows = max(most_rows, 2 * rows)  # a group larger than that is gathered in doubling steps
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of each run of equal ``keys`` (integer columns without NULLs)."""
    changed = np.zeros(table.num_rows, dtype=bool)
    changed[:1] = True
    for k in keys:
        v = table[k].to_numpy()
        changed[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(changed)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)
