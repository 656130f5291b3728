"""Statistics: exact quantiles, outlier bounds, imputation, histograms.

All values are computed by distributed aggregates whose results are a
bounded number of rows (one per column, one per bucket), so the driver only
ever sees small summaries.  Exact quantiles count the few values inside
brackets that a sketch gives, instead of funnelling a column into one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: set[str] | None = None) -> list[str]:
    exclude = exclude or set()
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: set[str] | None = None) -> list[str]:
    exclude = exclude or set()
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def float_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}


# ------------------------------------------------------------ exact quantiles

#: Relative rank error of the sketches that bracket a rank; ``percentile_approx`` keeps it through every merge.
ACCURACY = 1000
#: Distinct values of a bracket that are counted one by one; larger brackets are narrowed first.
MOST_VALUES = 100_000


def _finite(v: Column) -> Column:
    return F.abs(v) < F.lit(math.inf)


def _grid(probs: list[float]) -> list[float]:
    """Probabilities whose sketched quantiles bracket the ranks of ``probs`` closely and any other rank loosely."""
    near = {min(1.0, max(0.0, p + side * 3 / ACCURACY)) for p in probs for side in (-1, 1)}
    return sorted({i / 64 for i in range(65)} | near)


def _slack(n):
    """By how many ranks a sketched quantile may be off."""
    return n / ACCURACY + 2


def _bracket(grid: list[float], sketched: list[float] | None, n: int, k: int, lo: float, hi: float) -> tuple[float, float]:
    """Bounds of the value at 0-based rank ``k`` of ``n``, from the sketched quantiles and the least and greatest value."""
    pairs = list(zip(grid, sketched or []))
    below = [v for g, v in pairs if g * n + _slack(n) <= k]
    above = [v for g, v in pairs if g * n - _slack(n) >= k + 1]
    return (below[-1] if below else lo), (above[0] if above else hi)


def _disjoint(ranges: list[tuple[float, float, list[int]]]) -> list[tuple[float, float, list[int]]]:
    """Ranges in order, those that touch made one."""
    out: list[tuple[float, float, list[int]]] = []
    for lo, hi, ks in sorted(ranges, key=lambda r: r[:2]):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]), sorted({*out[-1][2], *ks}))
        else:
            out.append((lo, hi, ks))
    return out


def _double(col: str) -> Column:
    """The column as double, in which ranges are kept; the cast never turns the order of two values round."""
    return F.col(col).cast("double")


def _narrowed(df: DataFrame, cols: list[str], ranges: dict, bounds: dict, limit: int) -> dict:
    """Split ranges further, by sketches of the values inside, until few values are left in each or nothing is gained.

    ``ranges[c]`` holds disjoint (lo, hi, ranks), ``bounds[c]`` a column's least and greatest value.  One aggregate row per pass.
    """
    grid, open_ = _grid([]), {(c, r[0], r[1]) for c, rs in ranges.items() for r in rs if r[0] < r[1]}
    while open_:
        keys, aggs = sorted(open_), []
        for i, (c, lo, hi) in enumerate(keys):
            v = _double(cols[c])
            inside = (v >= F.lit(lo)) & (v <= F.lit(hi))
            aggs += [F.count_if((v < F.lit(lo)) & _finite(v)).alias(f"b{i}"), F.count_if(inside).alias(f"n{i}"),
                     F.percentile_approx(F.when(inside, v), grid, ACCURACY).alias(f"q{i}")]
        row = df.agg(*aggs).first()
        open_ = set()
        for i, (c, lo, hi) in enumerate(keys):
            ks = next((ks for a, b, ks in ranges[c] if (a, b) == (lo, hi)), None)
            below, n = row[f"b{i}"], row[f"n{i}"]
            if n <= limit or ks is None:
                continue
            parts = [(*_bracket(grid, row[f"q{i}"], n, k - below, lo, hi), [k]) if below <= k < below + n else (*bounds[c], [k]) for k in ks]
            parts = _disjoint([*parts, *(r for r in ranges[c] if (r[0], r[1]) != (lo, hi))])
            open_ |= {(c, a, b) for a, b, _ in parts if a < b and (a, b) not in {r[:2] for r in ranges[c]}}
            ranges[c] = parts
        open_ = {k for k in open_ if k[1:] in {r[:2] for r in ranges[k[0]]}}
    return ranges


def _counted(df: DataFrame, cols: list[str], ranges: dict) -> dict:
    """(values below the first range and between ranges, counted; distinct values inside ranges, counted): one job.

    Per column: {code: rows} for the even codes, the gaps, and {code: {text: rows}} for the odd ones.
    """
    stacked = []
    for c, rs in ranges.items():
        v = _double(cols[c])
        code = F.when(v.isNull() | ~_finite(v) | F.isnan(v), F.lit(-1))
        for i, (lo, hi, _) in enumerate(rs):
            code = code.when(v < F.lit(lo), F.lit(2 * i)).when(v <= F.lit(hi), F.lit(2 * i + 1))
        # Above the last range nothing is asked.
        stacked.append(F.struct(F.lit(c).alias("c"), code.otherwise(F.lit(-1)).alias("code"), F.col(cols[c]).cast("string").alias("text")))
    rows = df.select(F.explode(F.array(*stacked)).alias("p")).select("p.*").where("code >= 0")
    text = F.when(F.col("code") % 2 == 1, F.col("text"))
    counted = rows.select("c", "code", text.alias("text")).groupBy("c", "code", "text").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict = {c: ({}, {}) for c in ranges}
    for r in counted:
        gaps, inside = out[r["c"]]
        if r["code"] % 2:
            inside.setdefault(r["code"], {})[r["text"]] = r["n"]
        else:
            gaps[r["code"]] = r["n"]
    return out


def _value_of(kind: T.DataType):
    """Text of a cell back to a value of its own kind: integers and decimals stay exact."""
    return int if isinstance(kind, T.IntegralType) else Decimal if isinstance(kind, T.DecimalType) else float


def _order_statistics(df: DataFrame, cols: list[str], wanted: dict[int, list[int]], summary: dict[int, tuple], grid: list[float],
                      limit: int) -> dict[tuple[int, int], object]:
    """Values at 0-based ranks of the ascending order of each column, in the column's own type.

    ``summary[c]`` is (rows, rows at minus infinity, at plus infinity, least and greatest finite value, sketched quantiles
    of the finite ones).  Infinite ranks follow from the counts.  The sketch brackets each other rank between two
    values; one grouped count returns how many rows lie below each bracket and the distinct values inside with
    their numbers.  A bracket that may hold more than ``limit`` values is narrowed first by a sketch of the rows inside.
    A value held by a third of the rows is one row of the count.
    """
    found: dict[tuple[int, int], object] = {}
    ranges, bounds, large = {}, {}, False
    for c, ks in wanted.items():
        n, low, high, lo, hi, sketched = summary[c]
        rest = n - low - high
        bounds[c] = (lo, hi)
        brackets = []
        for k in sorted(set(ks)):
            if k < low or k >= n - high:
                found[(c, k)] = -math.inf if k < low else math.inf
            else:
                brackets.append((*_bracket(grid, sketched, rest, k - low, lo, hi), [k - low]))
        if brackets:
            ranges[c] = _disjoint(brackets)
            large |= rest > limit and (rest * 8 / ACCURACY + 8 > limit)
    if large:
        ranges = _narrowed(df, cols, ranges, bounds, limit)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    while ranges:
        counted, missed = _counted(df, cols, ranges), {}
        for c, rs in ranges.items():
            gaps, inside = counted[c]
            value, low, below = _value_of(kinds[cols[c]]), summary[c][1], 0
            for i, (_, _, ks) in enumerate(rs):
                below += gaps.get(2 * i, 0)
                places = sorted((value(t), m) for t, m in inside.get(2 * i + 1, {}).items())
                for k in ks:
                    at = below
                    for v, m in places:
                        if at <= k < at + m:
                            found[(c, k + low)] = v
                            break
                        at += m
                    else:
                        missed.setdefault(c, []).append((*bounds[c], [k]))
                below += sum(m for _, m in places)
        # A sketch that broke its promise would leave a rank outside its bracket: then all values are searched.
        ranges = {c: _disjoint(rs) for c, rs in missed.items()}
    return found


def _between(a, b, part: float):
    """Linear interpolation; exact for integers and decimals."""
    if a == b or isinstance(a, float):
        return a if a == b else a + (b - a) * part
    between = Fraction(a) + (Fraction(b) - Fraction(a)) * Fraction(part)
    if between.denominator == 1:
        return int(between)
    with localcontext() as ctx:
        ctx.prec = 60
        return Decimal(between.numerator) / Decimal(between.denominator)


@dataclass
class ColumnSummary:
    """``quantiles`` are doubles; ``exact`` are the same ones in the column's own type (integers and decimals unrounded)."""
    column: str
    count: int
    min: float | None
    max: float | None
    mean: float | None
    quantiles: list[float | None]
    std: float | None = None
    exact: list | None = None


def summarize(df: DataFrame, cols: list[str], probs: list[float], *, exact: bool = True,
              buckets: int = MOST_VALUES) -> list[ColumnSummary]:
    """Count, min, max, mean, deviation and quantiles (linear interpolation) of several columns.

    NULL and NaN are skipped, as pandas does; infinite values count.  One aggregate
    row holds all of it, with a sketch of every column; ``exact`` adds the counts inside the
    brackets that the sketches give (one more job, whatever the number of columns; more
    only if a bracket may hold over ``buckets`` values).
    """
    if not cols:
        return []
    grid, aggs = _grid(probs), []
    for i, c in enumerate(cols):
        v = F.when(~F.isnan(_double(c)), _double(c))
        finite = F.when(_finite(v), v)
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.avg(v).alias(f"mean{i}"),
                 F.stddev_samp(v).alias(f"std{i}"), F.count_if(v == -math.inf).alias(f"low{i}"), F.count_if(v == math.inf).alias(f"high{i}"),
                 F.min(finite).alias(f"flo{i}"), F.max(finite).alias(f"fhi{i}"),
                 (F.percentile_approx(finite, grid, ACCURACY) if exact else F.percentile_approx(v, probs, 10_000)).alias(f"q{i}")]
    row = df.agg(*aggs).first()
    positions = {i: [p * (row[f"n{i}"] - 1) for p in probs] for i in range(len(cols)) if row[f"n{i}"]}
    if exact:
        wanted = {i: sorted({f(x) for x in pos for f in (math.floor, math.ceil)}) for i, pos in positions.items()}
        summary = {i: tuple(row[f"{k}{i}"] for k in ("n", "low", "high", "flo", "fhi", "q")) for i in wanted}
        stat = _order_statistics(df, cols, wanted, summary, grid, buckets)
    out = []
    for i, name in enumerate(cols):
        if i not in positions:
            out.append(ColumnSummary(name, 0, None, None, None, [None] * len(probs), None, [None] * len(probs)))
            continue
        if exact:
            ends = [(stat[(i, math.floor(x))], stat[(i, math.ceil(x))], x - math.floor(x)) for x in positions[i]]
            own = [_between(*e) for e in ends]
            qs = [_between(float(a), float(b), part) for a, b, part in ends]
        else:
            qs = own = [float(x) for x in row[f"q{i}"]]
        out.append(ColumnSummary(name, row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"mean{i}"], qs, row[f"std{i}"], own))
    return out


def quantiles(df: DataFrame, col: str, probs: list[float], exact: bool = True):
    """Quantiles of one column and its non-NULL count."""
    s = summarize(df, [col], probs, exact=exact)[0]
    return s.quantiles, s.count


def median(df: DataFrame, col: str, exact: bool = True) -> float | None:
    return quantiles(df, col, [0.5], exact)[0][0]


# ------------------------------------------------------------ outliers (A3)

OUTLIER_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("lower_bound", T.DoubleType()),
    T.StructField("upper_bound", T.DoubleType()),
    T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("median", T.DoubleType()),
])


@dataclass
class Bounds:
    column: str
    q1: float | None
    median: float | None
    q3: float | None

    @property
    def lower(self):
        return None if self.q1 is None else self.q1 - 1.5 * (self.q3 - self.q1)

    @property
    def upper(self):
        return None if self.q3 is None else self.q3 + 1.5 * (self.q3 - self.q1)


def iqr_bounds(df: DataFrame, columns: list[str], exact: bool = True) -> list[Bounds]:
    present = set(numeric_columns(df))
    cols = [c for c in columns if c in present]
    return [Bounds(s.column, *s.quantiles) for s in summarize(df, cols, [0.25, 0.5, 0.75], exact=exact)]


def outlier_predicate(col: str, b: Bounds) -> Column:
    """Outside the bounds; a bound that is not a number (infinite quartiles) excludes nothing, as in pandas."""
    v = F.col(col).cast("double")
    if b.lower is None:
        return F.lit(False)
    below = F.lit(False) if math.isnan(b.lower) else v < F.lit(b.lower)
    above = F.lit(False) if math.isnan(b.upper) else (v > F.lit(b.upper)) & ~F.isnan(v)
    return below | above


def outlier_search(df: DataFrame, columns: list[str], exact: bool = True) -> list[tuple[Bounds, ColumnSummary]]:
    """A3's statistics: one summary (count, min, max, mean, quartiles) covering every numeric column."""
    present = set(numeric_columns(df))
    summaries = summarize(df, [c for c in columns if c in present], [0.25, 0.5, 0.75], exact=exact)
    return [(Bounds(s.column, *s.quantiles), s) for s in summaries]


def outlier_count_columns(found: list[tuple[Bounds, ColumnSummary]]) -> list[Column]:
    """Aggregate columns ``_out{i}``: rows outside each column's bounds (bounds as literals)."""
    return [F.count_if(outlier_predicate(b.column, b)).alias(f"_out{i}") for i, (b, _) in enumerate(found)]


def outlier_rows_of(found: list[tuple[Bounds, ColumnSummary]], agg_row) -> list[tuple]:
    """Rows of OUTLIER_SCHEMA from the search and an aggregate row holding ``outlier_count_columns``."""
    return [(b.column, agg_row[f"_out{i}"], b.lower, b.upper, s.min, s.max, s.mean, b.median)
            for i, (b, s) in enumerate(found)]


def detect_outliers(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """A3: IQR bounds and outlier count, min, max, mean, median per numeric column.

    One summary (count, min, max, mean, quartiles) covers all columns; the
    outlier counts are then a single aggregate with the bounds as literals.
    A caller with another aggregate over ``df`` to run can put
    ``outlier_count_columns`` into it instead and save the pass.
    """
    spark = df.sparkSession
    found = outlier_search(df, columns, exact)
    if not found:
        return spark.createDataFrame([], OUTLIER_SCHEMA)
    row = df.agg(*outlier_count_columns(found)).first()
    return spark.createDataFrame(outlier_rows_of(found, row), OUTLIER_SCHEMA)


def outlier_rows(df: DataFrame, col: str, keep: list[str], exact: bool = True, stage: bool = False) -> DataFrame:
    """the rows outside the IQR bounds of ``col``, projected to ``keep``.

    ``stage`` computes the bounds (several passes when exact) on a staged copy
    of ``col`` alone: worth it when ``df`` is a join such as a star view, not
    when it is a plain scan.
    """
    source = df
    if stage and exact:
        from runway.sources.sinks import materialize
        source = materialize(df.select(col), "outlier-values")
    bounds = iqr_bounds(source, [col], exact)
    if not bounds:
        return df.select(*keep).limit(0)
    return df.where(outlier_predicate(col, bounds[0])).select(*keep)


# ------------------------------------------------------------ imputation

FILL_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()),
    T.StructField("method", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("filled", T.LongType()),
])


def column_modes(df: DataFrame, cols: list[str]) -> dict[str, str | None]:
    """Most frequent non-NULL value per column; ties go to the smallest value.

    The columns are unpivoted to (column, value) pairs and counted with one
    grouped aggregate; the winner per column is picked by ``min_by`` with
    partial aggregation, so a hot value never gathers in one task.
    """
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("val"))
                                for c in cols]))
    counted = (df.select(pairs.alias("p")).select("p.col", "p.val")
               .where(F.col("val").isNotNull())
               .groupBy("col", "val").count())
    best = counted.groupBy("col").agg(
        F.min_by("val", F.struct((-F.col("count")).alias("neg"), F.col("val"))).alias("mode"))
    found = {r["col"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in cols}


def smart_fill(df: DataFrame, exclude: set[str] | None = None, exact: bool = True,
               unknown: str = "UNKNOWN") -> tuple[DataFrame, DataFrame]:
    """Median for numeric columns, mode for text columns, timestamps left alone.

    Returns (filled DataFrame, fill report with one row per filled column).
    Only columns that hold NULLs are touched; their NULL counts come from one
    aggregate.
    """
    spark = df.sparkSession
    exclude = exclude or set()
    num = numeric_columns(df, exclude)
    txt = string_columns(df, exclude)
    floats = float_columns(df)
    if not num and not txt:
        return df, spark.createDataFrame([], FILL_SCHEMA)
    missing = {}
    for c in num + txt:
        m = F.col(c).isNull()
        if c in floats:
            m = m | F.isnan(c)
        missing[c] = m
    counts = df.agg(*[F.count_if(m).alias(c) for c, m in missing.items()]).first().asDict()
    num_fill = [c for c in num if counts[c] > 0]
    txt_fill = [c for c in txt if counts[c] > 0]
    report, fills = [], {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for summ in summarize(df, num_fill, [0.5], exact=exact):
        c, med = summ.column, summ.exact[0]
        if med is None:
            continue
        fills[c] = F.when(missing[c], F.lit(med).cast(types[c])).otherwise(F.col(c))
        report.append((c, "median", repr(float(med)) if float(med) == med else str(med), counts[c]))
    modes = column_modes(df, txt_fill)
    for c in txt_fill:
        value = modes[c] if modes[c] is not None else unknown
        fills[c] = F.coalesce(F.col(c), F.lit(value))
        report.append((c, "mode", value, counts[c]))
    out = df.withColumns(fills) if fills else df
    return out, spark.createDataFrame(report, FILL_SCHEMA)


# ------------------------------------------------------------ describe, histogram, bounds

def describe(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, 25%, 50%, 75%, max of one column."""
    s = summarize(df, [col], [0.25, 0.5, 0.75], exact=exact)[0]
    row = (s.count, s.mean, s.std, s.min, *s.quantiles, s.max)
    return df.sparkSession.createDataFrame([row], "count long, mean double, std double, min double, p25 double, p50 double, p75 double, max double")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """``bins`` equal-width bins between min and max; the last bin is closed.

    Min and max are one aggregate row; the bin of each value is then a pure
    expression, followed by one partial + final count per bin.
    """
    v = F.col(col).cast("double")
    row = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    spark = df.sparkSession
    schema = "bin int, bin_start double, bin_end double, count long"
    if lo is None:
        return spark.createDataFrame([], schema)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((v - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    return (df.where(v.isNotNull()).groupBy(b.alias("bin")).count()
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"), "count"))


def min_max(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bounds for filter widgets, one row."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return df.agg(*aggs)


# ------------------------------------------------------------ grouped exact quantiles

def grouped_quantiles(df: DataFrame, key: str, value: str, probs: list[float], *, buckets: int = MOST_VALUES, stage: bool = True) -> DataFrame:
    """Exact quantiles of ``value`` per ``key`` (linear interpolation; NULL/NaN skipped), with mean and count.

    One aggregate gives every group's counts and a sketch of its values, which brackets each wanted rank between two
    values.  The values are joined to their group's brackets (broadcast when their measured size allows; otherwise AQE
    splits a hot group) and counted: the rows below a bracket as one number, those inside by distinct value.  So a window
    sees a bracket's distinct values only, and no task holds a group's.  Where the largest group's brackets may hold over
    ``buckets`` values, they are narrowed first by sketches of the rows inside.
    With ``stage`` the (group, value) pairs are written once to the shared folder, so the passes scan two columns
    instead of re-running ``df``'s plan (a star join, say); pass ``stage=False`` when ``df`` is already such a scan.
    Output: key, q0, q1, ..., mean, count (of the values; a group without any has NULL quantiles).
    """
    from pyspark.sql import Window

    from runway.sources.sinks import materialize

    v, finite = F.col("v"), F.when(_finite(F.col("v")), F.col("v"))
    cell = F.col(value).cast("double")
    vals = df.select(F.col(key).alias("g"), F.when(~F.isnan(cell), cell).alias("v")).where(F.col("g").isNotNull())
    if stage:
        vals = materialize(vals, "quantile-values")
    grid = _grid(probs)
    groups = vals.groupBy("g").agg(
        F.count("v").alias("n"), F.avg("v").alias("mean"), F.count_if(v == -math.inf).alias("low"), F.count_if(v == math.inf).alias("high"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi"), F.percentile_approx(finite, grid, ACCURACY).alias("q"))
    groups = materialize(groups, "quantile-groups")
    largest = groups.agg(F.max("n")).first()[0] or 0

    def bracket(points: list[float], n: Column, k: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
        pairs = F.zip_with(F.array(*[F.lit(p) for p in points]), "q", lambda p, x: F.struct(p.alias("p"), x.alias("x")))
        slack = n / ACCURACY + 2
        pick = lambda keep, at: F.try_element_at(F.transform(F.filter(pairs, keep), lambda e: e["x"]), F.lit(at))
        low = pick(lambda e: e["p"] * n + slack <= k, -1)
        high = pick(lambda e: e["p"] * n - slack >= k + 1, 1)
        return F.coalesce(low, lo), F.coalesce(high, hi)

    ends = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("n") - 1)
        ends += [F.struct(F.lit(2 * i + side).alias("e"), f(pos).cast("long").alias("k")) for side, f in enumerate((F.floor, F.ceil))]
    ranks = groups.where("n > 0").select("*", F.explode(F.array(*ends)).alias("t")).select("*", "t.*").drop("t")
    inside_rank, rest = F.col("k") - F.col("low"), F.col("n") - F.col("low") - F.col("high")
    known = F.when(inside_rank < 0, F.lit(-math.inf)).when(inside_rank >= rest, F.lit(math.inf))
    low, high = bracket(grid, rest, inside_rank, F.col("lo"), F.col("hi"))
    state = ranks.select(F.col("g").alias("of"), "e", inside_rank.alias("k"), known.alias("known"), low.alias("a"), high.alias("b"))

    for _ in range(20 if largest > buckets and largest * 8 / ACCURACY + 8 > buckets else 0):
        open_ = state.where("known IS NULL AND a < b")
        points = _grid([])
        met = vals.join(open_, (F.col("g") == F.col("of")) & (v <= F.col("b")) & _finite(v))
        inside = F.when(v >= F.col("a"), v)
        held = met.groupBy("of", "e", "k", "a", "b").agg(F.count_if(v < F.col("a")).alias("below"), F.count(inside).alias("m"),
                                                        F.percentile_approx(inside, points, ACCURACY).alias("q"))
        low, high = bracket(points, F.col("m"), F.col("k") - F.col("below"), F.col("a"), F.col("b"))
        narrow = F.col("m") > buckets
        held = held.select(F.col("of").alias("o"), F.col("e").alias("f"), F.when(narrow, low).alias("c"), F.when(narrow, high).alias("d"))
        state = state.join(held, (F.col("of") == F.col("o")) & (F.col("e") == F.col("f")), "left")
        moved = F.col("c").isNotNull() & ((F.col("c") > F.col("a")) | (F.col("d") < F.col("b")))
        state = materialize(state.select("of", "e", "k", "known", F.coalesce("c", "a").alias("a"), F.coalesce("d", "b").alias("b"),
                                         F.coalesce(moved, F.lit(False)).alias("moved")), "quantile-state")
        if not state.agg(F.max("moved")).first()[0]:
            break

    # Ends of one bracket, mostly the two ranks around a quantile, are looked up in the same counts.
    wanted = F.collect_list(F.struct("e", "k"))
    open_ = state.where("known IS NULL").groupBy("of", "a", "b").agg(wanted.alias("ks"))
    met = vals.join(open_, (F.col("g") == F.col("of")) & (v <= F.col("b")) & _finite(v))
    counted = met.groupBy("g", "a", "b", "ks", F.when(v >= F.col("a"), v).alias("x")).agg(F.count(F.lit(1)).alias("m"))
    over = Window.partitionBy("g", "a", "b").orderBy(F.col("x").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counted.withColumn("cum", F.sum("m").over(over)).where("x IS NOT NULL")
    hits = F.filter("ks", lambda t: (t["k"] < F.col("cum")) & (t["k"] >= F.col("cum") - F.col("m")))
    hit = placed.select("g", F.explode(hits).alias("t"), "x").select("g", "t.e", "x")
    known = state.where("known IS NOT NULL").select(F.col("of").alias("g"), "e", F.col("known").alias("x"))
    found = hit.unionByName(known).groupBy(F.col("g").alias("of")).agg(
        *[F.max(F.when(F.col("e") == e, F.col("x"))).alias(f"e{e}") for e in range(2 * len(probs))])
    out = groups.join(found, F.col("g") == F.col("of"), "left")
    qs = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (F.col("n") - 1)
        a, b = F.col(f"e{2 * i}"), F.col(f"e{2 * i + 1}")
        lost = (F.col("n") > 0) & (a.isNull() | b.isNull())
        between = F.when(a == b, a).otherwise(a + (b - a) * (pos - F.floor(pos)))
        # A sketch that broke its promise must not go unseen.
        qs.append(F.when(lost, F.raise_error(F.lit("quantile outside its bracket")).cast("double")).otherwise(between).alias(f"q{i}"))
    return out.select(F.col("g").alias(key), *qs, "mean", F.col("n").alias("count"))
