"""Distinct values, full-row and keyed de-duplication, unions.

De-duplication is aggregation with a map-side partial step, so a key that
holds a third of the rows is reduced to one row per map task before any
shuffle.  D1 and D3-D4 are hash aggregates; D2 picks whole rows by a
composite order, which Spark can only aggregate over sorted input: the sort
is local to each map task, and one row per key and task is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Surrogate and audit columns ignored by the default full-row dedupe.
DEFAULT_IGNORE = ("id", "created_at")


def dedupe_rows(df: DataFrame, ignore_cols: tuple[str, ...] | None = DEFAULT_IGNORE) -> DataFrame:
    """Drop repeated rows.

    ``ignore_cols`` are left out of the comparison (of each, the smallest of
    the repeated rows' values is kept, so reruns agree); pass ``None`` to
    compare every column, like the reference does.
    """
    if not ignore_cols:
        return df.dropDuplicates()
    keys = [c for c in df.columns if c not in ignore_cols]
    ignored = [c for c in df.columns if c in ignore_cols]
    if not ignored:
        return df.dropDuplicates()
    # One minimum per column: primitive values, so a hash aggregate (a struct would need sorted input).
    return df.groupBy(*keys).agg(*[F.min(c).alias(c) for c in ignored]).select(df.columns)


def count_duplicates(df: DataFrame) -> int:
    """Rows that repeat an earlier row (``count - distinct count``)."""
    row = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
           .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")).first())
    return int(row["d"])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Per key, the row that comes first by ``order`` (ties broken by the other columns).

    ``min_by`` over a struct is a declarative aggregate with partial
    aggregation, unlike ``row_number`` over a window, which would hold a hot
    key's whole group in one task.  ``dropDuplicates(keys)`` keeps an
    arbitrary row and is therefore not used.
    """
    others = [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*others), ordering).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others]).select(*df.columns)


def distinct_values(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """D3: distinct non-NULL values of one column."""
    return df.select(F.col(col).alias(alias or col)).where(F.col(alias or col).isNotNull()).distinct()


def union_distinct(frames: list[tuple[DataFrame, str]], alias: str) -> DataFrame:
    """Set union of the non-NULL values of several (DataFrame, column) pairs.

    The projections are unioned first and de-duplicated once, so there is a
    single shuffle whatever the number of inputs.
    """
    parts = [df.select(F.col(c).alias(alias)) for df, c in frames]
    return reduce(DataFrame.unionAll, parts).where(F.col(alias).isNotNull()).distinct()


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name, missing columns filled with NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
