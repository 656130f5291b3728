"""Data-quality assertions on warehouse tables.

Every check is a lazy one-row DataFrame (check, violations, passed); the
suite is their union, so one action evaluates all checks and nothing but
the counts reaches the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_COLUMNS = ["check", "violations", "passed"]


def _result(name: str, counted: DataFrame) -> DataFrame:
    """``counted`` has one row with column ``v``."""
    return counted.select(F.lit(name).alias("check"), F.col("v").cast("long").alias("violations"),
                          (F.col("v") == 0).alias("passed"))


def count_where(df: DataFrame, name: str, cond: Column) -> DataFrame:
    return _result(name, df.agg(F.count_if(cond).alias("v")))


def not_empty(df: DataFrame, name: str) -> DataFrame:
    """1 violation when the table is empty."""
    return _result(name, df.agg(F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).alias("v")))


def unique_key(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once (GROUP BY ... HAVING COUNT(*) > 1)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1)
    return _result(name, dup.agg(F.count(F.lit(1)).alias("v")))


def non_negative(df: DataFrame, name: str, col: str) -> DataFrame:
    """Values below zero or NULL (zero is allowed)."""
    return count_where(df, name, (F.col(col) < 0) | F.col(col).isNull())


def date_in_range(fact: DataFrame, dates: DataFrame, name: str, fk: str, lo: str, hi: str) -> DataFrame:
    """Facts whose date (through dim_dates) lies outside [lo, hi]."""
    j = fact.select(fk).join(dates.select(F.col("date_id").alias(fk), "full_date"), fk)
    return count_where(j, name, (F.col("full_date") < F.lit(lo).cast("date")) |
                       (F.col("full_date") > F.lit(hi).cast("date")))


def code_format(df: DataFrame, name: str, col: str, pattern: str = "^[A-Z]{3}$", length: int = 3) -> DataFrame:
    """Codes that are not ``length`` characters matching ``pattern``."""
    c = F.col(col)
    return count_where(df, name, (F.length(c) != length) | ~c.rlike(pattern))


def min_length_through(fact: DataFrame, dim: DataFrame, name: str, fk: str, pk: str, col: str,
                       min_len: int = 2) -> DataFrame:
    """Joined values that are NULL or shorter than ``min_len``."""
    j = fact.select(F.col(fk).alias("_k")).join(dim.select(F.col(pk).alias("_k"), col), "_k")
    return count_where(j, name, F.col(col).isNull() | (F.length(col) < min_len))


def allowed_values(fact: DataFrame, dim: DataFrame, name: str, fk: str, pk: str, col: str,
                   allowed: list[str]) -> DataFrame:
    """Distinct joined values outside ``allowed`` (inner join, like the reference)."""
    j = fact.select(F.col(fk).alias("_k")).join(dim.select(F.col(pk).alias("_k"), col), "_k")
    bad = j.where(~F.col(col).isin(allowed)).select(col).distinct()
    return _result(name, bad.agg(F.count(F.lit(1)).alias("v")))


def not_null(df: DataFrame, name: str, col: str) -> DataFrame:
    """V8c."""
    return count_where(df, name, F.col(col).isNull())


def not_null_through(fact: DataFrame, dim: DataFrame, name: str, fk: str, pk: str, col: str) -> DataFrame:
    """V8c, second form: NULL attribute reached through a join."""
    j = fact.select(F.col(fk).alias("_k")).join(dim.select(F.col(pk).alias("_k"), col), "_k")
    return count_where(j, name, F.col(col).isNull())


def foreign_key(fact: DataFrame, dim: DataFrame, name: str, fk: str, pk: str) -> DataFrame:
    """Non-NULL foreign keys without a parent row (anti join)."""
    orphans = fact.select(F.col(fk).alias("_k")).where(F.col("_k").isNotNull()) \
        .join(dim.select(F.col(pk).alias("_k")), "_k", "left_anti")
    return _result(name, orphans.agg(F.count(F.lit(1)).alias("v")))


def orphan_facts(fact: DataFrame, dim: DataFrame, name: str, fk: str, pk: str) -> DataFrame:
    """Facts an inner join to ``dim`` would drop: NULL key or no parent row."""
    keyed = fact.select(F.col(fk).alias("_k"))
    missing = keyed.join(dim.select(F.col(pk).alias("_k")), "_k", "left_anti")
    return _result(name, missing.agg(F.count(F.lit(1)).alias("v")))


def declared_constraints(t: dict[str, DataFrame], constraints: dict[str, tuple], parent_keys: dict[str, str],
                         mandatory: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """One row per declared NOT NULL, UNIQUE and foreign-key constraint, from one pass over each table.

    Every table gives its entries (domain, key, role): its own key in the domain of its table, each foreign key
    in the domain of the parent, each UNIQUE key in a domain of its own, and one entry per NULL that a NOT NULL column
    holds.  They are counted by (domain, key, role), with partial counts in the map tasks, so a hot key sends one
    row per task; a second, narrow aggregate finds the keys without a parent and the UNIQUE keys counted twice.
    NULL keys break neither a foreign key nor a UNIQUE group, as in SQL; ``mandatory`` names checks of foreign keys
    (table, column) that count NULL ones too: the facts that an inner join would drop.
    """
    names: list[str] = []
    parents = {p for n, (_, _, foreign) in constraints.items() if n in t for p in foreign.values()}
    entries = []

    def entry(domain: str, role: int, number=None, text=None, when: Column | None = None) -> Column:
        e = F.struct(F.lit(domain).alias("domain"), (F.lit(None) if number is None else number).cast("long").alias("number"),
                     (F.lit(None) if text is None else text).cast("string").alias("text"), F.lit(role).alias("role"))
        return F.when(F.lit(True) if when is None else when, e)

    def role(name: str) -> int:
        names.append(name)
        return len(names) - 1

    for name in t:
        not_null, unique, foreign = constraints.get(name, ([], [], {}))
        mine = []
        if name in parents:
            mine.append(entry(name, -1, number=F.col(parent_keys[name])))
        for c in not_null:
            mine.append(entry("null", role(f"not_null_{name}_{c}"), when=F.col(c).isNull()))
        for key, parent in foreign.items():
            mine.append(entry(parent, role(f"fk_{name}_{key}"), number=F.col(key), when=F.col(key).isNotNull()))
        for check, (table, key) in (mandatory or {}).items():
            if table == name:
                mine.append(entry(foreign[key], role(check), number=F.col(key)))
        for keys in unique:
            check = f"unique_{name}_{'_'.join(keys)}"
            present = F.lit(True)
            for k in keys:
                present &= F.col(k).isNotNull()
            text = F.concat(*[x for k in keys for x in (F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string"))])
            mine.append(entry(check, role(check), text=text, when=present))
        if mine:
            entries.append(t[name].select(F.explode(F.array_compact(F.array(*mine))).alias("e")).select("e.*"))
    counted = reduce(DataFrame.unionByName, entries).groupBy("domain", "number", "text", "role").agg(F.count(F.lit(1)).alias("n"))
    # A UNIQUE key that occurs once, and a parent's key, violate nothing.
    unique_role = F.col("role").isin([i for i, n in enumerate(names) if n.startswith("unique_")])
    held = counted.where(~unique_role | (F.col("n") > 1)).groupBy("domain", "number", "text").agg(
        F.max(F.col("role") == -1).alias("parent"), F.collect_list(F.struct("role", "n")).alias("roles"))
    # At most one entry per constraint in the list; a NULL key has no parent.
    found = held.select(F.col("parent") & F.col("number").isNotNull(), F.explode("roles").alias("r")).toDF("parent", "r").select("parent", "r.*")
    null_role = F.col("role").isin([i for i, n in enumerate(names) if n.startswith("not_null_")])
    violations = F.when(null_role, F.col("n")).when(unique_role, F.lit(1)).when(~F.col("parent"), F.col("n")).otherwise(F.lit(0))
    one = found.agg(*[F.coalesce(F.sum(F.when(F.col("role") == i, violations)), F.lit(0)).cast("long").alias(f"c{i}") for i in range(len(names))])
    pairs = ", ".join(f"'{n}', c{i}" for i, n in enumerate(names))
    return one.selectExpr(f"stack({len(names)}, {pairs}) as (check, violations)").select("check", "violations", (F.col("violations") == 0).alias("passed"))


def run_suite(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def row_checks(df: DataFrame, conditions: dict[str, Column], empty_check: str | None = None) -> DataFrame:
    """Several row-level checks of one table in a single pass.

    ``conditions`` maps a check name to the condition a violating row meets;
    ``empty_check`` names an extra V1c check on the same pass.  The one-row
    aggregate is unpivoted into (check, violations, passed) rows.
    """
    aggs = [F.count_if(c).alias(f"c{i}") for i, c in enumerate(conditions.values())]
    names = list(conditions)
    if empty_check:
        aggs.append(F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).alias(f"c{len(names)}"))
        names.append(empty_check)
    one = df.agg(*aggs)
    pairs = ", ".join(f"'{n}', CAST(c{i} AS BIGINT)" for i, n in enumerate(names))
    long = one.selectExpr(f"stack({len(names)}, {pairs}) as (check, v)")
    return long.select("check", F.col("v").alias("violations"), (F.col("v") == 0).alias("passed"))
