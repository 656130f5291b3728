"""Data-quality profiling: completeness, bad-row split, final report, NULL profile.

Each profile is one aggregate pass; the per-column results are unpivoted
with ``stack`` so a wide table yields a long, bounded result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.functions.expr import null_count
from runway.operators.stats import float_columns


def _missing(df: DataFrame, c: str):
    m = F.col(c).isNull()
    if c in float_columns(df):
        m = m | F.isnan(c)
    return m


def _stack(cols: list[str], value_prefix: str) -> str:
    args = ", ".join(f"'{c}', `{value_prefix}{i}`" for i, c in enumerate(cols))
    return f"stack({len(cols)}, {args}) as (column, nulls)"


def completeness(df: DataFrame, required: list[str]) -> DataFrame:
    """A1: NULL count and percent filled per required column, in one pass.

    Output: column, nulls, rows, filled_percent.  Required columns absent from
    the input are reported with ``nulls`` NULL (the reference rejects them).
    """
    present = [c for c in required if c in df.columns]
    absent = [c for c in required if c not in df.columns]
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count_if(_missing(df, c)).alias(f"n{i}")
                                                  for i, c in enumerate(present)]
    one = df.agg(*aggs)
    parts = []
    if present:
        parts.append(one.selectExpr("_rows as rows", _stack(present, "n")))
    if absent:
        parts.append(one.select(F.col("_rows").alias("rows"),
                                F.explode(F.array(*[F.lit(c) for c in absent])).alias("column"),
                                F.lit(None).cast("long").alias("nulls")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("column", "nulls", "rows",
                      F.try_divide((F.col("rows") - F.col("nulls")) * 100.0, F.col("rows"))
                      .alias("filled_percent"))


def completeness_percent(df: DataFrame, cols: list[str]) -> float | None:
    """Share of non-NULL cells over ``cols`` (percent); NULL for empty input."""
    if any(c not in df.columns for c in cols):
        return 0.0
    if not cols:
        return None
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(null_count(cols, float_columns(df))).alias("nulls")).first()
    if not row["rows"]:
        return None
    return (1 - row["nulls"] / (row["rows"] * len(cols))) * 100


def completeness_columns(df: DataFrame) -> list[Column]:
    """Aggregate columns ``rows`` and ``nulls`` over all of ``df``'s columns (see ``completeness_of``)."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(null_count(df.columns, float_columns(df))).alias("nulls")]


def completeness_of(row, n_columns: int) -> tuple[int, float | None]:
    """Row count and completeness percent from an aggregate row holding ``completeness_columns``."""
    if not row["rows"]:
        return 0, None
    return row["rows"], (1 - row["nulls"] / (row["rows"] * n_columns)) * 100


def rows_and_completeness(df: DataFrame) -> tuple[int, float | None]:
    """Row count and completeness over all columns, one aggregate."""
    return completeness_of(df.agg(*completeness_columns(df)).first(), len(df.columns))


def flag_bad_rows(df: DataFrame, max_nulls: int = 2, flag: str = "_bad") -> DataFrame:
    """add ``null_count`` and a boolean flag for rows with more than ``max_nulls`` NULLs."""
    nc = null_count(df.columns, float_columns(df))
    return df.withColumn("null_count", nc).withColumn(flag, F.col("null_count") > max_nulls)


def mark_bad_rows(df: DataFrame, max_nulls: int = 2) -> tuple[DataFrame, DataFrame]:
    """(good rows without the helper column, bad rows with ``null_count``)."""
    flagged = flag_bad_rows(df, max_nulls)
    good = flagged.where(~F.col("_bad")).drop("_bad", "null_count")
    bad = flagged.where(F.col("_bad")).drop("_bad")
    return good, bad


REPORT_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("total_columns", T.IntegerType()),
    T.StructField("null_counts", T.MapType(T.StringType(), T.LongType())),
    T.StructField("duplicate_count", T.LongType()),
    T.StructField("missing_required_columns", T.ArrayType(T.StringType())),
    T.StructField("empty_rows", T.LongType()),
    T.StructField("completeness_percent", T.DoubleType()),
])


def validate_results(df: DataFrame, source: str, required: list[str]) -> DataFrame:
    """A2: one-row final report.

    Duplicates need a grouping on all columns; every other figure is derived
    from the same grouped rows (weighted by their multiplicity), so the whole
    report costs a single shuffle with map-side combine.
    """
    cols = df.columns
    floats = float_columns(df)
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    n = F.col("_n")
    miss = {c: (F.col(c).isNull() | F.isnan(c)) if c in floats else F.col(c).isNull() for c in cols}
    all_null = F.lit(True)
    for m in miss.values():
        all_null = all_null & m
    aggs = [F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_count"),
            F.coalesce(F.sum(F.when(all_null, n)), F.lit(0)).alias("empty_rows")]
    aggs += [F.coalesce(F.sum(F.when(m, n)), F.lit(0)).alias(f"_null_{i}") for i, m in enumerate(miss.values())]
    one = grouped.agg(*aggs)
    null_map = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                 F.array(*[F.col(f"_null_{i}") for i in range(len(cols))]))
    null_total = F.lit(0)
    for i in range(len(cols)):
        null_total = null_total + F.col(f"_null_{i}")
    missing_required = sorted(set(required) - set(cols))
    return one.select(
        F.lit(source).alias("source"),
        F.col("total_rows").cast("long").alias("total_rows"),
        F.lit(len(cols)).alias("total_columns"),
        null_map.alias("null_counts"),
        F.col("duplicate_count").cast("long").alias("duplicate_count"),
        F.array(*[F.lit(c) for c in missing_required]).cast("array<string>").alias("missing_required_columns"),
        F.col("empty_rows").cast("long").alias("empty_rows"),
        ((1 - F.try_divide(null_total, F.col("total_rows") * len(cols))) * 100.0)
        .alias("completeness_percent"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """NULL count and percent per column, only the columns that have NULLs."""
    cols = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_missing(df, c)).alias(f"n{i}") for i, c in enumerate(cols)])
    long = one.selectExpr("_rows as rows", _stack(cols, "n"))
    pct = F.try_divide(F.col("nulls") * 100.0, F.col("rows"))
    return (long.where(F.col("nulls") > 0)
            .select("column", "nulls", F.bround(pct, 1).alias("percent")))
