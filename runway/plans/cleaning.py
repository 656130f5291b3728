"""Per-source cleaning pipelines (T1-T5): DataFrame -> (clean, rejects, report).

Each pipeline reads a source as landed in the raw zone and writes one
intermediate copy, the standardised and de-duplicated rows, which the
quantile passes and fill values read column by column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway.functions import expr as X
from runway.functions.expr import null_count
from runway.operators import dedupe, quality, stats
from runway.schemas import REQUIRED
from runway.sources.sinks import materialize

FILL_STRUCT = T.StructType([
    T.StructField("method", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("filled", T.LongType()),
])
OUTLIER_STRUCT = T.StructType([
    T.StructField("count", T.LongType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("median", T.DoubleType()),
])
SOURCE_REPORT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("initial_rows", T.LongType()),
    T.StructField("final_rows", T.LongType()),
    T.StructField("rejected_rows", T.LongType()),
    T.StructField("duplicates_removed", T.LongType()),
    T.StructField("completeness_before", T.DoubleType()),
    T.StructField("completeness_after", T.DoubleType()),
    T.StructField("fill_report", T.MapType(T.StringType(), FILL_STRUCT)),
    T.StructField("outliers_report", T.MapType(T.StringType(), OUTLIER_STRUCT)),
])


@dataclass
class Cleaned:
    clean: DataFrame
    rejects: DataFrame
    report: tuple  # one row of SOURCE_REPORT; ``report_frame`` turns the rows of all sources into one table


def standardize_formats(df: DataFrame) -> DataFrame:
    """N1-N3 on the columns present."""
    cols = set(df.columns)
    fixes = {c: X.normalize_airport(c) for c in
             ("departure_airport", "arrival_airport", "departure", "arrival") if c in cols}
    if "flight_number" in cols:
        fixes["flight_number"] = X.normalize_flight_number("flight_number")
    if "status" in cols:
        fixes["status"] = X.lower_trim("status")
    if "currency" in cols:
        fixes["currency"] = X.upper_trim("currency")
    return df.withColumns(fixes) if fixes else df


def split_bad_rows(df: DataFrame, max_nulls: int = 2) -> tuple[DataFrame, DataFrame]:
    """F1 + S10: the flag is a cheap expression of the row, so both sides are filters on ``df`` and need no copy."""
    flagged = quality.flag_bad_rows(df, max_nulls)
    good = flagged.where(~F.col("_bad")).drop("_bad", "null_count").select(*df.columns)
    bad = flagged.where(F.col("_bad")).drop("_bad").select(*df.columns, "null_count")
    return good, bad


def _split_summary(df: DataFrame, required: list[str], max_nulls: int = 2) -> tuple[int, int, float | None]:
    """Good and rejected rows of a source and the completeness of ``required`` over both, one scan."""
    missing = any(c not in df.columns for c in required)
    nulls = null_count(required, stats.float_columns(df)) if required and not missing else F.lit(0)
    flagged = quality.flag_bad_rows(df, max_nulls)
    row = flagged.agg(F.count_if(~F.col("_bad")).alias("good"), F.count_if("_bad").alias("bad"), F.sum(nulls).alias("z")).first()
    rows = row["good"] + row["bad"]
    if missing:
        before = 0.0
    elif not required or not rows:
        before = None
    else:
        before = (1 - row["z"] / (rows * len(required))) * 100
    return row["good"], row["bad"], before


def _fill_map(fill: DataFrame) -> dict:
    return {r["column"]: (r["method"], r["value"], r["filled"]) for r in fill.collect()}


def _outliers_and_completeness(df: DataFrame, outlier_cols: list[str], exact: bool):
    """A3 outliers plus row count and completeness of ``df``: after the quantile search, the outlier
    counts and the completeness share one aggregate, so ``df`` is read once for both."""
    found = stats.outlier_search(df, outlier_cols, exact)
    row = df.agg(*quality.completeness_columns(df), *stats.outlier_count_columns(found)).first()
    rows, after = quality.completeness_of(row, len(df.columns))
    outliers = {r[0]: tuple(r[1:]) for r in stats.outlier_rows_of(found, row)}
    return outliers, rows, after


def _report(source, initial, final, rejected, dups, before, after, fills, outliers) -> tuple:
    return (source, initial, final, rejected, dups, before, after, fills, outliers)


def report_frame(spark, rows: list[tuple]) -> DataFrame:
    """The per-source rows as one table (one local relation, not a union of one-row frames)."""
    return spark.createDataFrame(rows, SOURCE_REPORT)


def _standard_pipeline(df: DataFrame, source: str, outlier_cols: list[str], *,
                       ignore_cols=dedupe.DEFAULT_IGNORE, dedupe_after_standardize: bool = False,
                       exact: bool = True, stage: bool = True) -> Cleaned:
    required = REQUIRED[source]
    good, bad = split_bad_rows(df)
    initial, rejected, before = _split_summary(df, required)
    if dedupe_after_standardize:
        cleaned = dedupe.dedupe_rows(standardize_formats(good), ignore_cols)
    else:
        cleaned = standardize_formats(dedupe.dedupe_rows(good, ignore_cols))
    if stage:
        cleaned = materialize(cleaned, f"{source}-std")
    filled, fill = stats.smart_fill(cleaned, exclude=set(ignore_cols or ()), exact=exact)
    outliers, deduped, after = _outliers_and_completeness(filled, outlier_cols, exact)
    report = _report(source, initial, deduped, rejected, initial - deduped, before,
                     after, _fill_map(fill), outliers)
    return Cleaned(filled, bad, report)


def transform_bookings(df: DataFrame, **kw) -> Cleaned:
    """T1."""
    return _standard_pipeline(df, "bookings", ["ticket_price"], **kw)


def transform_flights(df: DataFrame, **kw) -> Cleaned:
    """Timestamps stay as read (never filled)."""
    return _standard_pipeline(df, "flights", [], **kw)


def transform_logs(df: DataFrame, **_) -> Cleaned:
    """Flight number, safe timestamp, upper-case level; no rows dropped."""
    fixes = {}
    if "flight_number" in df.columns:
        fixes["flight_number"] = X.normalize_flight_number("flight_number")
    if "timestamp" in df.columns:
        fixes["timestamp"] = X.safe_timestamp("timestamp")
    if "level" in df.columns:
        fixes["level"] = X.upper_trim("level")
    clean = df.withColumns(fixes) if fixes else df
    n, after = quality.rows_and_completeness(clean)
    report = _report("logs", n, n, 0, 0, None, after, {}, {})
    return Cleaned(clean, clean.limit(0), report)


def transform_weather(df: DataFrame, exact: bool = True, **_) -> Cleaned:
    """T4: safe timestamp, airport normalisation, outliers of three measures."""
    fixes = {}
    if "timestamp" in df.columns:
        fixes["timestamp"] = X.safe_timestamp("timestamp")
    if "airport_code" in df.columns:
        fixes["airport_code"] = X.normalize_airport("airport_code")
    clean = df.withColumns(fixes) if fixes else df
    outliers, n, after = _outliers_and_completeness(clean, ["temperature", "humidity", "wind_speed"], exact)
    report = _report("weather", n, n, 0, 0, None, after, {}, outliers)
    return Cleaned(clean, clean.limit(0), report)


def standardize_maintenance(df: DataFrame) -> DataFrame:
    """T5's column fixes: codes, types, statuses, safe dates and cost."""
    cols = set(df.columns)
    fixes = {}
    if "aircraft_code" in cols:
        fixes["aircraft_code"] = X.upper_trim("aircraft_code")
    if "maintenance_type" in cols:
        fixes["maintenance_type"] = X.remap_or_self(X.lower_trim("maintenance_type"))
    if "status" in cols:
        fixes["status"] = X.lower_trim("status")
    for c in ("scheduled_date", "completed_date"):
        if c in cols:
            fixes[c] = X.safe_date(c)
    if "cost" in cols:
        fixes["cost"] = X.safe_double("cost")
    return df.withColumns(fixes) if fixes else df


def transform_maintenance(df: DataFrame, exact: bool = True, stage: bool = True, **_) -> Cleaned:
    """T5: completeness, bad-row split, standardisation, imputation; no dedupe."""
    good, bad = split_bad_rows(df)
    n, rejected, before = _split_summary(df, REQUIRED["maintenance"])
    std = standardize_maintenance(good)
    if stage:
        std = materialize(std, "maintenance-std")
    filled, fill = stats.smart_fill(std, exact=exact)
    after = quality.completeness_percent(filled, filled.columns)
    report = _report("maintenance", n + rejected, n, rejected, 0, before, after, _fill_map(fill), {})
    return Cleaned(filled, bad, report)


TRANSFORMS = {
    "bookings": transform_bookings,
    "flights": transform_flights,
    "logs": transform_logs,
    "weather": transform_weather,
    "maintenance": transform_maintenance,
}
