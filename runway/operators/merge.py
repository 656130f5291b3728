"""Keyed merge (upsert) on plain parquet tables (M1-M4).

A merge is a full outer join of the current table and the (key-unique)
incoming rows on the natural key; rows found on both sides take the
incoming values for the updated columns and keep their surrogate key; new
rows get keys after the current maximum.  The result is a new table image
that the caller writes with a staged overwrite (see ``sources.sinks``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runway.operators.keys import assign_keys, max_key


def _key_condition(t: DataFrame, s: DataFrame, keys: list[str], null_safe: bool) -> Column:
    cond = None
    for k in keys:
        c = t[k].eqNullSafe(s[k]) if null_safe else t[k] == s[k]
        cond = c if cond is None else cond & c
    return cond


def _known_empty(df: DataFrame) -> bool:
    """True for an in-driver empty frame (a table before its first load); no job is run."""
    return df.isLocal() and df.isEmpty()


def upsert(target: DataFrame, source: DataFrame, keys: list[str], id_col: str,
           update_cols: list[str] | None = None, null_safe: bool = False) -> DataFrame:
    """M1/M2/M4: ``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    ``source`` must be unique on ``keys`` and carry the target's columns
    except ``id_col``.  ``null_safe`` makes NULL key parts equal (``<=>``),
    so re-running a load never duplicates rows whose key has a NULL part.
    """
    cols = [c for c in target.columns if c != id_col]
    update_cols = [c for c in (update_cols if update_cols is not None else cols) if c not in keys]
    s = source.select(*cols, F.lit(True).alias("_in_src"))
    t = target.select(id_col, *cols, F.lit(True).alias("_in_tgt"))
    j = t.alias("t").join(s.alias("s"), _key_condition(t, s, keys, null_safe), "full_outer")

    def pick(c: str) -> Column:
        if c in keys:
            return F.when(F.col("t._in_tgt"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
        if c in update_cols:
            return F.when(F.col("s._in_src"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        return F.when(F.col("t._in_tgt"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)

    merged = j.select(F.col(f"t.{id_col}").alias(id_col), *[pick(c) for c in cols],
                      F.coalesce(F.col("t._in_tgt"), F.lit(False)).alias("_old"))
    if not _known_empty(target):
        # Both halves below read the join; staged so that it runs once.
        from runway.sources.sinks import materialize
        merged = materialize(merged, "merged")
    existing = merged.where("_old").drop("_old")
    fresh = merged.where(~F.col("_old")).drop("_old", id_col)
    fresh = assign_keys(fresh, keys, id_col, start=max_key(target, id_col))
    return existing.unionByName(fresh).select(target.columns)


def upsert_on_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """M2: upsert where the natural key is the table key (no numbering): incoming rows win."""
    cols = [c for c in target.columns if c not in keys]
    s = source.select(*keys, *cols, F.lit(True).alias("_in_src"))
    j = target.alias("t").join(s.alias("s"), keys, "full_outer")
    return j.select(*keys, *[F.when(F.col("s._in_src"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
                             for c in cols]).select(target.columns)


def insert_missing(target: DataFrame, source: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """M3: ``INSERT ... ON CONFLICT DO NOTHING`` as an anti join plus new keys."""
    cols = [c for c in target.columns if c != id_col]
    fresh = source.select(*cols).join(target.select(*keys), keys, "left_anti")
    fresh = assign_keys(fresh, keys, id_col, start=max_key(target, id_col))
    return target.unionByName(fresh.select(target.columns))


def empty_like(spark, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
