"""Operators: quality profile, statistics, dedupe, keys, merges, checks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from runway.operators import checks, dedupe, filters, quality, stats
from runway.operators.keys import assign_keys
from runway.operators.merge import insert_missing, upsert, upsert_on_key
from tests.fixtures import bookings_df


def test_mark_bad_rows_split_is_complete(spark):
    df = bookings_df(spark)
    good, bad = quality.mark_bad_rows(df, 2)
    assert good.count() + bad.count() == df.count()
    assert [r.id for r in bad.collect()] == [36]
    assert bad.first().null_count == 4
    assert "null_count" not in good.columns


def test_completeness(spark):
    df = bookings_df(spark)
    rows = {r.column: r for r in quality.completeness(df, ["ticket_price", "status", "absent"]).collect()}
    assert rows["ticket_price"].nulls == 2 and rows["status"].nulls == 0 and rows["absent"].nulls is None
    assert abs(rows["ticket_price"].filled_percent - 900 / 11) < 1e-9
    pct = quality.completeness_percent(df, ["passenger_name", "ticket_price"])
    assert abs(pct - (1 - 3 / 22) * 100) < 1e-9
    assert quality.completeness_percent(df.limit(0), ["status"]) is None


def test_validate_results_counts_duplicates(spark):
    df = bookings_df(spark).drop("id")
    r = quality.validate_results(df, "bookings", ["booking_ref", "nope"]).first()
    assert r.total_rows == 11 and r.duplicate_count == 2 and r.empty_rows == 0
    assert r.missing_required_columns == ["nope"] and r.null_counts["ticket_price"] == 2


def test_null_profile(spark):
    got = {r.column: r.nulls for r in quality.null_profile(bookings_df(spark)).collect()}
    assert got == {"passenger_name": 1, "departure_airport": 1, "arrival_airport": 1, "aircraft_type": 1, "ticket_price": 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_match_numpy(spark, seed):
    rnd = random.Random(seed)
    hot = 7.25
    vals = [hot] * 400 + [rnd.expovariate(0.1) for _ in range(800)] + [None] * 30 + [float("nan")] * 5
    rnd.shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    arr = np.array([v for v in vals if v is not None and v == v])
    want = np.percentile(arr, [p * 100 for p in probs])
    # Few buckets force several passes.
    got = stats.summarize(df, ["v"], probs, buckets=8)[0]
    assert got.count == len(arr)
    assert np.allclose(got.quantiles, want, rtol=0, atol=1e-9)
    approx = stats.summarize(df, ["v"], [0.5], exact=False)[0].quantiles[0]
    assert abs(approx - np.median(arr)) < 2.0


def test_summarize_several_columns(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("a"), (F.col("id") * 1.5).alias("b"))
    a, b = stats.summarize(df, ["a", "b"], [0.5])
    assert a.quantiles == [4.5] and b.quantiles == [749.25] and a.max == 9 and b.min == 0.0


def test_detect_outliers_and_rows(spark):
    vals = list(range(1, 21)) + [1000]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "k int, v double")
    out = stats.detect_outliers(df, ["v", "missing"]).first()
    q1, q3 = np.percentile(vals, [25, 75])
    assert out["count"] == 1 and out.upper_bound == q3 + 1.5 * (q3 - q1) and out.max == 1000.0
    assert [r.k for r in stats.outlier_rows(df, "v", ["k"]).collect()] == [20]


def test_modes_tie_smallest_and_all_null(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), ("c", None)],
                               "x string, y string")
    assert stats.column_modes(df, ["x", "y"]) == {"x": "a", "y": None}


def test_smart_fill(spark):
    df = spark.createDataFrame([(1, 1.0, "x", None), (2, None, None, None), (3, 3.0, "x", None),
                                (4, 10.0, "y", None)], "id long, v double, s string, t string")
    filled, report = stats.smart_fill(df, exclude={"id"})
    rows = {r.id: r for r in filled.collect()}
    assert rows[2].v == 3.0 and rows[2].s == "x" and rows[2].t == "UNKNOWN"
    rep = {r.column: (r.method, r.value, r.filled) for r in report.collect()}
    assert rep == {"v": ("median", "3.0", 1), "s": ("mode", "x", 1), "t": ("mode", "UNKNOWN", 4)}
    assert filled.where(F.col("v").isNull() | F.col("s").isNull()).count() == 0


def test_histogram_bins(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "p double")
    h = {r.bin: r["count"] for r in stats.histogram(df, "p", 20).collect()}
    assert len(h) == 20 and sum(h.values()) == 101 and h[19] == 6


def test_dedupe_is_idempotent_and_keeps_first_id(spark):
    df = bookings_df(spark)
    once = dedupe.dedupe_rows(df)
    assert once.count() == 9
    assert dedupe.dedupe_rows(once).count() == 9
    assert sorted(r.id for r in once.where("booking_ref = 'QK-9'").collect()) == [33]
    assert dedupe.dedupe_rows(df, None).count() == 11
    assert dedupe.count_duplicates(df.drop("id")) == 2


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 1, 5, "late"), ("k", 0, 9, "first"), ("k", 0, 10, "second"),
                                ("j", 1, 1, "only")], "key string, src int, ord int, val string")
    got = {r.key: r.val for r in dedupe.first_per_key(df, ["key"], ["src", "ord"]).collect()}
    assert got == {"k": "first", "j": "only"}


def test_union_helpers(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(2, "q")], "y int, z string")
    assert sorted(r.v for r in dedupe.union_distinct([(a, "x"), (b, "y")], "v").collect()) == [1, 2]
    u = dedupe.union_by_name([a, b.withColumnRenamed("y", "x")])
    assert u.count() == 4 and set(u.columns) == {"x", "z"}


def test_assign_keys_dense_in_key_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(13)
    out = assign_keys(df, ["k"], "sk", start=100, partitions=7)
    rows = out.orderBy("k").collect()
    assert [r.sk for r in rows] == list(range(101, 5101))


def test_upsert_updates_and_appends(spark):
    target = spark.createDataFrame([(1, "SVO", "old"), (2, "LED", "old")], "airport_id long, code string, city string")
    source = spark.createDataFrame([("LED", "new"), ("KZN", "new")], "code string, city string")
    out = {r.code: (r.airport_id, r.city) for r in upsert(target, source, ["code"], "airport_id").collect()}
    assert out == {"SVO": (1, "old"), "LED": (2, "new"), "KZN": (3, "new")}


def test_upsert_null_safe_rerun_is_idempotent(spark):
    schema = "flight_id long, fn string, dep long, ac long"
    target = spark.createDataFrame([], schema)
    src = spark.createDataFrame([("SU1", None, 5), ("SU2", 1, None)], "fn string, dep long, ac long")
    once = upsert(target, src, ["fn", "dep"], "flight_id", ["ac"], null_safe=True).checkpoint()
    twice = upsert(once, src, ["fn", "dep"], "flight_id", ["ac"], null_safe=True)
    assert twice.count() == 2
    plain = upsert(once, src, ["fn", "dep"], "flight_id", ["ac"], null_safe=False)
    assert plain.count() == 3  # a NULL key part never matches without <=>


def test_insert_missing_and_key_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "pid long, name string")
    src = spark.createDataFrame([("b",), ("c",), ("a",)], "name string")
    out = {r.name: r.pid for r in insert_missing(target, src, ["name"], "pid").collect()}
    assert out == {"a": 1, "b": 2, "c": 3}
    t2 = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    s2 = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert sorted(tuple(r) for r in upsert_on_key(t2, s2, ["k"]).collect()) == [(1, "x"), (2, "z"), (3, "w")]


def test_checks(spark):
    dim = spark.createDataFrame([(1, "SVO"), (2, "LEDX"), (3, "SVO")], "id long, code string")
    fact = spark.createDataFrame([(1, 5.0), (2, -1.0), (None, None), (9, 1.0)], "fk long, price double")
    res = {r.check: (r.violations, r.passed) for r in checks.run_suite([
        checks.not_empty(dim, "ne"), checks.unique_key(dim, "uk", ["code"]),
        checks.non_negative(fact, "nn", "price"), checks.code_format(dim, "cf", "code"),
        checks.foreign_key(fact, dim, "fk", "fk", "id"), checks.orphan_facts(fact, dim, "or", "fk", "id"),
        checks.allowed_values(fact, dim, "av", "fk", "id", "code", ["SVO"]),
        checks.not_null(fact, "nl", "fk")]).collect()}
    assert res == {"ne": (0, True), "uk": (1, False), "nn": (2, False), "cf": (1, False), "fk": (1, False),
                   "or": (2, False), "av": (1, False), "nl": (1, False)}


def test_booking_filters(spark):
    df = bookings_df(spark).withColumn("aircraft_type", F.when(F.col("id") == 38, None).otherwise(F.col("aircraft_type")))
    got = filters.booking_filters(df, statuses=["confirmed"], price_range=(5000, 8200),
                                  aircraft=["Embraer 190"], date_range_=("2024-02-17", "2024-02-21"))
    assert sorted(r.id for r in got.collect()) == [38, 41]


def test_grouped_quantiles_match_numpy(spark):
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 50))) for _ in range(1500)]
    rows += [(f"g{i % 7}", rnd.expovariate(0.2)) for i in range(700)] + [("g1", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.25, 0.5, 0.9]
    got = {r.k: [r.q0, r.q1, r.q2] for r in
           stats.grouped_quantiles(df, "k", "v", probs, buckets=4).collect()}
    for k in {r[0] for r in rows if r[0] is not None}:
        arr = np.array([v for g, v in rows if g == k and v is not None])
        assert np.allclose(got[k], np.percentile(arr, [p * 100 for p in probs]), atol=1e-9), k


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float), st.floats(-1e6, 1e6), st.sampled_from([1e300, -1e-300]),
                          st.sampled_from([float("inf"), float("-inf")])), min_size=1, max_size=300),
       st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, vals, probs):
    df = spark.createDataFrame([("g", v) for v in vals], "k string, v double")
    arr = sorted(v for v in vals if v is not None)
    pos = [p * (len(arr) - 1) for p in probs]
    want = [None if not arr else linear(arr[math.floor(x)], arr[math.ceil(x)], x - math.floor(x)) for x in pos]
    one = stats.summarize(df, ["v"], probs, buckets=4)[0]
    grouped = stats.grouped_quantiles(df, "k", "v", probs, buckets=4).first()
    assert one.count == grouped["count"] == len(arr)
    for got in (one.quantiles, [grouped[f"q{i}"] for i in range(len(probs))]):
        assert [x is None for x in got] == [x is None for x in want]
        assert [x for x in got if x is not None] == pytest.approx([x for x in want if x is not None], rel=1e-12, abs=1e-9, nan_ok=True)


def linear(a, b, part):
    return a if a == b else a + (b - a) * part


@pytest.mark.parametrize("n", [49_999, 50_001])
def test_one_infinite_value_changes_no_path(spark, n):
    df = spark.range(n).select(F.when(F.col("id") == 5, float("inf")).otherwise(F.col("id").cast("double")).alias("v"))
    s = stats.summarize(df, ["v"], [0.25, 0.5, 0.75, 1.0])[0]
    values = np.array([*(i for i in range(n) if i != 5), np.inf])
    assert s.quantiles[:3] == np.percentile(values, [25, 50, 75]).tolist() and s.quantiles[3] == np.inf
    assert stats.detect_outliers(df, ["v"]).first()["count"] == 1


def test_bounds_that_are_no_numbers_exclude_nothing(spark):
    df = spark.createDataFrame([(float("inf"),)] * 3 + [(1.0,)], "v double")
    assert stats.detect_outliers(df, ["v"]).first()["count"] == 0


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=0, max_size=200, unique=True), st.integers(0, 1000))
def test_assign_keys_property(spark, keys, start):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    rows = assign_keys(df, ["k"], "sk", start=start).collect()
    assert sorted((r.k, r.sk) for r in rows) == [(k, start + i + 1) for i, k in enumerate(sorted(keys))]


def test_keys_do_not_depend_on_the_layout(spark):
    rows = [(1, "a", i % 3, None if i % 4 else i) for i in range(400)] + [(None, "b", 0, 0)] * 5
    df = spark.createDataFrame(rows, "k long, s string, x int, y int")
    numbered = [sorted((tuple(r) for r in assign_keys(d, ["k"], "sk", partitions=p).collect()), key=repr)
                for d, p in ((df, 3), (df.repartition(7, "x").sortWithinPartitions(F.desc("y")), 5))]
    assert numbered[0] == numbered[1] and sorted(r[-1] for r in numbered[0]) == list(range(1, 406))


def test_split_summary_equals_counts_and_completeness(spark):
    from runway.plans.cleaning import _split_summary
    df = bookings_df(spark)
    good, bad = quality.mark_bad_rows(df, 2)
    required = ["passenger_name", "ticket_price", "status"]
    n_good, n_bad, before = _split_summary(df, required)
    assert (n_good, n_bad) == (good.count(), bad.count())
    assert before == quality.completeness_percent(df, required)
    assert _split_summary(df, ["absent"])[2] == 0.0
    assert _split_summary(df.limit(0), required) == (0, 0, None)


def test_outliers_and_completeness_equal_separate_passes(spark):
    from runway.plans.cleaning import _outliers_and_completeness
    df = spark.range(200).select(F.col("id"), F.when(F.col("id") % 9 == 0, None)
                                 .otherwise((F.col("id") % 23).cast("double")).alias("v"),
                                 F.when(F.col("id") == 7, 1000.0).otherwise(F.col("id") * 1.0).alias("w"))
    outliers, rows, after = _outliers_and_completeness(df, ["v", "w", "absent"], True)
    expected = {r["column"]: (r["count"], r["lower_bound"], r["upper_bound"], r["min"], r["max"], r["mean"],
                              r["median"]) for r in stats.detect_outliers(df, ["v", "w", "absent"]).collect()}
    assert outliers == expected and outliers["w"][0] == 1
    assert (rows, after) == quality.rows_and_completeness(df)
    assert _outliers_and_completeness(df, [], True)[0] == {}


@pytest.mark.parametrize("kind", ["bigint", "decimal(30,2)"])
def test_quantiles_of_large_values_are_exact(spark, kind):
    from decimal import Decimal
    big = 9007199254740993
    df = spark.createDataFrame([(str(big + i // 3),) for i in range(4)] + [(None,)], "t string").select(F.col("t").cast(kind).alias("v"))
    s = stats.summarize(df, ["v"], [0.0, 0.5, 0.75, 1.0], buckets=4)[0]
    assert s.exact == [big, big, Decimal(big) + Decimal("0.25"), big + 1]
    filled, _ = stats.smart_fill(df.where(f"v IS NULL OR v = {big}"))
    assert {int(r.v) for r in filled.collect()} == {big}


@pytest.mark.parametrize("limit", [5, 50, 100_000])
def test_brackets_are_narrowed_where_they_hold_many_values(spark, limit):
    df = spark.range(20_000).select(((F.col("id") * 7919) % 20_000).cast("double").alias("v"), (F.col("id") % 3).alias("w"), F.lit("g").alias("g"))
    probs = [0.001, 0.3, 0.5, 0.9999]
    v, w = stats.summarize(df, ["v", "w"], probs, buckets=limit)
    want = np.percentile(np.arange(20_000), [100 * p for p in probs])
    assert v.quantiles == pytest.approx(want.tolist()) and w.quantiles == [0.0, 0.0, 1.0, 2.0]
    got = stats.grouped_quantiles(df, "g", "v", probs, buckets=limit).first()
    assert [got[f"q{i}"] for i in range(4)] == pytest.approx(want.tolist()) and got["count"] == 20_000


def test_a_broken_sketch_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(stats, "_bracket", lambda grid, sketched, n, k, lo, hi: (lo, lo))
    df = spark.range(101).select(F.col("id").cast("double").alias("v"))
    assert stats.summarize(df, ["v"], [0.0, 0.5])[0].quantiles == [0.0, 50.0]


def test_declared_constraints_in_one_pass(spark):
    dim = spark.createDataFrame([(1, "SVO"), (2, "LED"), (3, "SVO"), (4, None), (5, None)], "id long, code string")
    fact = spark.createDataFrame([(1, 1, "a", "b"), (2, None, "a", "b"), (9, 9, "a", None), (None, 2, "ab", "")], "fk long, other int, x string, y string")
    constraints = {"dim": (["code"], [["code"]], {}), "fact": (["y", "x"], [["x", "y"]], {"fk": "dim", "other": "dim"})}
    tables = {"dim": dim, "fact": fact}
    res = checks.declared_constraints(tables, constraints, {"dim": "id"}, {"orphans": ("fact", "fk")})
    assert {r.check: (r.violations, r.passed) for r in res.collect()} == {
        "not_null_dim_code": (2, False), "unique_dim_code": (1, False), "not_null_fact_y": (1, False), "not_null_fact_x": (0, True),
        "unique_fact_x_y": (1, False), "fk_fact_fk": (1, False), "fk_fact_other": (1, False), "orphans": (2, False)}
    empty = checks.declared_constraints({n: d.limit(0) for n, d in tables.items()}, constraints, {"dim": "id"}, {"orphans": ("fact", "fk")})
    assert {(r.violations, r.passed) for r in empty.collect()} == {(0, True)} and empty.count() == 8
