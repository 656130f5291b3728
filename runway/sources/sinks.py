"""Sinks (S9-S12): parquet tables, reject tables, the quality report, staged overwrite."""

from __future__ import annotations

import contextvars
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """S9."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _rename(fs, source, target) -> None:
    """Rename, or fail: ``FileSystem.rename`` tells of most failures by returning false."""
    if not fs.rename(source, target):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def swap_in(fs, staging, target, old) -> None:
    """Put ``staging`` in ``target``'s place; the old image is deleted only after that, and put back if it fails."""
    _rename(fs, target, old)
    try:
        _rename(fs, staging, target)
    except Exception:
        _rename(fs, old, target)
        raise
    fs.delete(old, True)


def overwrite_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Full refresh as one staged write followed by a directory swap.

    The new image is written next to the table first, so a failed job leaves
    the old table untouched, and ``df`` may itself read ``path`` (upserts).
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:8]}"
    write_parquet(df, staging, "errorifexists", partition_by)
    fs, Path = _fs(spark, path)
    target = Path(path)
    if fs.exists(target):
        swap_in(fs, Path(staging), target, Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}"))
    else:
        parent = target.getParent()
        if parent is not None and not fs.exists(parent):
            fs.mkdirs(parent)
        _rename(fs, Path(staging), target)
    return path


_SCRATCH: contextvars.ContextVar[str | None] = contextvars.ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Staged tables written inside this block go to a folder of their own, which is deleted at its end."""
    from runway.session import shared_path
    path = shared_path(spark, "scratch")
    token = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        fs, Path = _fs(spark, path)
        fs.delete(Path(path), True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and return a scan of it.

    Cuts lineage for results that several later jobs read: they scan the
    written columns instead of recomputing the plan (joins, shuffles) each time.
    Inside ``scratch`` the table lives until the end of that block.
    """
    from runway.session import shared_path
    folder = _SCRATCH.get()
    path = f"{folder}/{name}-{uuid.uuid4().hex[:12]}" if folder else shared_path(df.sparkSession, name)
    write_parquet(df, path, partition_by=partition_by)
    # The schema is passed so that an empty result (no files) reads back too.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, Path = _fs(spark, path)
    return fs.exists(Path(path))


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A warehouse table, or an empty one of ``schema`` before its first load."""
    if table_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def write_rejects(df: DataFrame, path: str) -> None:
    """Rejected rows of a source, kept for analysis."""
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """The quality report as JSON (one object per source)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _as_array_lines(batches):
    """One partition's JSON records as the lines of a single JSON array (runs inside tasks)."""
    import pandas as pd
    first = True
    yield pd.DataFrame({"value": ["["]})
    for pdf in batches:
        if pdf.empty:
            continue
        lines = "," + pdf["value"]
        if first:
            lines.iloc[0] = pdf["value"].iloc[0]
            first = False
        yield pd.DataFrame({"value": lines})
    yield pd.DataFrame({"value": ["]"]})


def write_json_array(df: DataFrame, path: str) -> None:
    """JSON-array files, one per partition (the layout of an API dump such as the weather source).

    Records are serialised by ``to_json`` on the JVM; each partition adds the
    brackets and commas around its own records, so nothing is gathered.
    """
    from pyspark.sql import functions as F
    records = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    records.mapInPandas(_as_array_lines, "value string").write.mode("overwrite").text(path)
