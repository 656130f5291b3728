"""Plan-shape checks for scale: no single-partition windows, partial aggregation on hot keys, pushdown."""

from pyspark.sql import functions as F

from runway.functions import expr as X
from runway.operators import dedupe, filters, stats
from runway.plans import marts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_frame(spark, n=3000):
    # One key holds a third of the rows.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("key"), F.col("id").alias("ord"), (F.col("id") % 17).cast("double").alias("v"))


def test_first_per_key_is_a_partial_aggregate(spark):
    out = dedupe.first_per_key(hot_frame(spark), ["key"], ["ord"])
    p = plan(out)
    assert "Window" not in p and "partial_min_by" in p
    assert out.where("key = 'HOT'").first().ord == 0


def test_dedupe_and_modes_on_hot_key(spark):
    df = hot_frame(spark)
    p = plan(dedupe.dedupe_rows(df.select("key", "v").withColumn("id", F.col("v").cast("long"))))
    assert "partial_min" in p and "SortAggregate" not in p
    assert stats.column_modes(df, ["key"]) == {"key": "HOT"}


def test_frequency_share_has_no_single_partition_exchange(spark):
    p = plan(marts.frequency_share(hot_frame(spark), "key"))
    assert "SinglePartition" not in p and "Window" not in p


def test_date_filter_reaches_the_scan(spark, tmp_dir):
    path = f"{tmp_dir}/o"
    spark.range(100).select(F.col("id"), F.timestamp_seconds(F.col("id") * 86400).alias("ts")) \
        .write.parquet(path)
    df = spark.read.parquet(path).where(filters.date_range("ts", "1970-01-10", "1970-01-20")).select("id")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert df.count() == 11


def test_dimensions_are_broadcast_only_below_the_planner_s_threshold(spark):
    fact = spark.range(100).select(F.col("id").alias("status_id"))
    from runway.plans.warehouse import statuses_for
    from runway.schemas import status_dim
    joined = lambda: plan(fact.join(statuses_for(status_dim(spark), "booking"), "status_id"))
    assert "BroadcastHashJoin" in joined()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in joined()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quantile_search_returns_bounded_rows(spark):
    df = hot_frame(spark, 20000)
    s = stats.summarize(df, ["v", "ord"], [0.5], buckets=16)
    assert s[0].quantiles == [8.0] and s[1].quantiles == [9999.5]


def test_normalisation_stays_in_codegen(spark):
    df = spark.createDataFrame([("svo",)], "x string").select(X.normalize_airport("x").alias("a"))
    p = plan(df)
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
