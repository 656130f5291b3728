"""Registered queries over the driver's tables, one per operator of SURVEY section 2.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where
the operator is expressible in SQL, the DuckDB SQL of the same result over
the same parquet tables (``oracle_sql.py`` holds the shared derivations).
Every query reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.functions import expr as X
from runway.operators import dedupe, filters, quality, stats
from runway.operators.keys import assign_keys
from runway.plans import cleaning, marts, tpch
from runway.plans import oracle_sql as Q
from runway.plans.tpch import load_tables
from runway.plans.warehouse import revenue_aggregate

QueryFn = Callable[[SparkSession, str], DataFrame]
ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def _t(spark, sf, *names):
    return load_tables(spark, sf, list(names))


# =============================================================== 2.2 filters

@register("f1_good_rows", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT * FROM bookings_raw WHERE {Q.null_count_sql(Q.BOOKING_COLS)} <= 2""")
def f1_good_rows(spark, sf):
    good, _ = quality.mark_bad_rows(tpch.bookings(_t(spark, sf, "orders", "customer")), 2)
    return good


@register("f1_bad_rows", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT *, {Q.null_count_sql(Q.BOOKING_COLS)} AS null_count FROM bookings_raw
WHERE {Q.null_count_sql(Q.BOOKING_COLS)} > 2""")
def f1_bad_rows(spark, sf):
    _, bad = quality.mark_bad_rows(tpch.bookings(_t(spark, sf, "orders", "customer")), 2)
    return bad


@register("f2_membership_filter", """
SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def f2(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.where(filters.membership("o_orderstatus", ["F", "O"]) &
                   filters.membership("o_orderpriority", ["1-URGENT", "2-HIGH"]))


@register("f3_membership_or_null", Q.with_(Q.BOOKINGS_RAW) + """
SELECT id, flight_number FROM bookings_raw WHERE flight_number IN ('SU101', 'SU 102', 'su 103') OR flight_number IS NULL""")
def f3(spark, sf):
    b = tpch.bookings(_t(spark, sf, "orders", "customer"))
    return b.where(filters.membership_or_null("flight_number", ["SU101", "SU 102", "su 103"])).select("id", "flight_number")


@register("f4_price_range", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000""")
def f4(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.where(filters.closed_range("o_totalprice", 100000, 200000)).select("o_orderkey", "o_totalprice")


@register("f5_date_range", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'""")
def f5(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.where(filters.date_range("o_orderdate", "1996-01-01", "1996-12-31")).select("o_orderkey", "o_orderdate")


@register("f6_both_present", Q.with_(Q.FLIGHTS_RAW) + """
SELECT flight_number, scheduled_departure, actual_departure FROM flights_raw
WHERE actual_departure IS NOT NULL AND scheduled_departure IS NOT NULL""")
def f6(spark, sf):
    f = tpch.flights_report(_t(spark, sf, "lineitem", "orders"))
    return f.where(filters.both_present("actual_departure", "scheduled_departure")).select(
        "flight_number", "scheduled_departure", "actual_departure")


@register("f7_in_list", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def f7(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.where(filters.membership("o_orderstatus", ["F", "P"])).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("f8_category_filter", """
SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY'""")
def f8(spark, sf):
    p = _t(spark, sf, "part")["part"]
    return p.where(F.col("p_type") == "ECONOMY").select("p_partkey", "p_name")


@register("f9_projection_literals", """
SELECT n_nationkey AS airport_id, n_name AS airport_code, n_name AS airport_name, n_name AS city,
       'Россия' AS country, 180 AS capacity, 'Unknown' AS manufacturer FROM nation""")
def f9(spark, sf):
    n = _t(spark, sf, "nation")["nation"]
    return n.select(F.col("n_nationkey").alias("airport_id"), F.col("n_name").alias("airport_code"),
                    F.col("n_name").alias("airport_name"), F.col("n_name").alias("city"),
                    F.lit("Россия").alias("country"), F.lit(180).alias("capacity"),
                    F.lit("Unknown").alias("manufacturer"))


@register("f10_outlier_rows", """
WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, user_id, value FROM events, b
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def f10(spark, sf):
    e = _t(spark, sf, "events")["events"]
    return stats.outlier_rows(e, "value", ["event_id", "user_id", "value"])


# =============================================================== 2.3 scalar functions

@register("n1_normalize_airport", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT id, departure_airport AS raw, {Q.airport_sql('departure_airport')} AS airport FROM bookings_raw""")
def n1(spark, sf):
    b = tpch.bookings(_t(spark, sf, "orders", "customer"))
    return b.select("id", F.col("departure_airport").alias("raw"), X.normalize_airport("departure_airport").alias("airport"))


@register("n1_normalize_nation_name", f"""
SELECT n_nationkey, {Q.airport_sql('n_name')} AS airport FROM nation""")
def n1b(spark, sf):
    n = _t(spark, sf, "nation")["nation"]
    return n.select("n_nationkey", X.normalize_airport("n_name").alias("airport"))


@register("n2_normalize_flight_number", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT id, flight_number AS raw, {Q.flight_sql('flight_number')} AS flight FROM bookings_raw""")
def n2(spark, sf):
    b = tpch.bookings(_t(spark, sf, "orders", "customer"))
    return b.select("id", F.col("flight_number").alias("raw"), X.normalize_flight_number("flight_number").alias("flight"))


@register("n2_normalize_part_name", """
SELECT p_partkey, replace(upper(p_name), ' ', '') AS flight FROM part""")
def n2b(spark, sf):
    p = _t(spark, sf, "part")["part"]
    return p.select("p_partkey", X.normalize_flight_number("p_name").alias("flight"))


@register("n3_case_trim", Q.with_(Q.BOOKINGS_RAW, Q.LOGS_RAW) + """
SELECT 'booking' AS kind, CAST(id AS VARCHAR) AS k, lower(trim(status)) AS a, upper(trim(currency)) AS b FROM bookings_raw
UNION ALL
SELECT 'log', message || '|' || "timestamp", upper(trim(level)), NULL FROM logs_raw""")
def n3(spark, sf):
    t = _t(spark, sf, "orders", "customer", "events")
    b = tpch.bookings(t).select(F.lit("booking").alias("kind"), F.col("id").cast("string").alias("k"),
                                X.lower_trim("status").alias("a"), X.upper_trim("currency").alias("b"))
    lg = tpch.server_logs(t).select(F.lit("log").alias("kind"), F.concat_ws("|", "message", "timestamp").alias("k"),
                                    X.upper_trim("level").alias("a"), F.lit(None).cast("string").alias("b"))
    return b.unionByName(lg)


@register("n4_standardize_formats", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT id, booking_ref, passenger_name, {Q.flight_sql('flight_number')} AS flight_number,
       {Q.airport_sql('departure_airport')} AS departure_airport, {Q.airport_sql('arrival_airport')} AS arrival_airport,
       departure_time, arrival_time, aircraft_type, ticket_price, upper(trim(currency)) AS currency,
       booking_date, lower(trim(status)) AS status
FROM bookings_raw""")
def n4(spark, sf):
    return cleaning.standardize_formats(tpch.bookings(_t(spark, sf, "orders", "customer")))


@register("n5_remap_or_self", Q.with_(Q.MAINTENANCE_RAW) + """
SELECT aircraft_code, description, lower(trim(maintenance_type)) AS maintenance_type FROM maintenance_raw""")
def n5(spark, sf):
    m = tpch.maintenance(_t(spark, sf, "part"))
    return m.select("aircraft_code", "description", X.remap_or_self(X.lower_trim("maintenance_type")).alias("maintenance_type"))


@register("n6_safe_timestamp", Q.with_(Q.LOGS_RAW) + """
SELECT message, "timestamp" AS raw, try_cast("timestamp" AS TIMESTAMP) AS ts FROM logs_raw""")
def n6(spark, sf):
    lg = tpch.server_logs(_t(spark, sf, "events"))
    return lg.select("message", F.col("timestamp").alias("raw"),
                     X.safe_timestamp("timestamp").cast("timestamp_ntz").alias("ts"))


@register("n7_safe_double", Q.with_(Q.MAINTENANCE_RAW) + """
SELECT cost AS raw, try_cast(cost AS DOUBLE) AS cost FROM maintenance_raw""")
def n7(spark, sf):
    m = tpch.maintenance(_t(spark, sf, "part"))
    return m.select(F.col("cost").alias("raw"), X.safe_double("cost").alias("cost"))


@register("n8_to_date", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders""")
def n8(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.select("o_orderkey", X.to_date("o_orderdate").alias("order_day"))


@register("n9_date_key", """
SELECT o_orderkey, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_id
FROM orders""")
def n9(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.select("o_orderkey", X.date_key("o_orderdate").alias("date_id"))


CALENDAR_SQL = """
CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id, d AS full_date,
CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
CAST(quarter(d) AS INTEGER) AS quarter, isodow(d) >= 6 AS is_weekend"""


@register("n10_calendar_parts", f"""
SELECT {CALENDAR_SQL} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""")
def n10(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    days = o.select(X.to_date("o_orderdate").alias("d")).distinct()
    return days.select(*[c.alias(n) for n, c in X.calendar_columns("d").items()])


@register("n11_delay_whole_minutes", Q.with_(Q.FLIGHTS_RAW) + """
SELECT flight_number, scheduled_departure, actual_departure,
       CASE WHEN actual_departure IS NOT NULL AND scheduled_departure IS NOT NULL
            THEN CAST(greatest(date_diff('minute', scheduled_departure, actual_departure), 0) AS INTEGER) END AS delay_minutes
FROM flights_raw""")
def n11(spark, sf):
    f = tpch.flights_report(_t(spark, sf, "lineitem", "orders"))
    return f.select("flight_number", "scheduled_departure", "actual_departure",
                    X.delay_minutes("scheduled_departure", "actual_departure").alias("delay_minutes"))


@register("n12_signed_delay", Q.with_(Q.FLIGHTS_RAW) + """
SELECT flight_number, scheduled_departure, actual_departure,
       date_diff('microsecond', scheduled_departure, actual_departure) / 60000000.0 AS delay
FROM flights_raw""")
def n12(spark, sf):
    f = tpch.flights_report(_t(spark, sf, "lineitem", "orders"))
    return f.select("flight_number", "scheduled_departure", "actual_departure",
                    X.signed_delay_minutes("scheduled_departure", "actual_departure").alias("delay"))


DAY_RU_SQL = "CASE dayname({d}) " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in X.DAY_NAMES_RU.items()) + " END"


@register("n13_day_names", f"""
SELECT o_orderkey, dayname(o_orderdate) AS day_name, {DAY_RU_SQL.format(d='o_orderdate')} AS day_name_ru FROM orders""")
def n13(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.select("o_orderkey", X.day_name("o_orderdate").alias("day_name"),
                    X.day_name_ru("o_orderdate").alias("day_name_ru"))


@register("n14_percent_text", """
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority)
SELECT o_orderpriority, n AS "count", printf('%.1f', round_even(n * 100.0 / (SELECT sum(n) FROM c), 1)) || '%' AS percent
FROM c""")
def n14(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return marts.frequency_share(o, "o_orderpriority")


@register("n15_default_if_null", Q.with_(Q.MAINTENANCE_RAW) + """
SELECT aircraft_code, coalesce(description, '') AS description FROM maintenance_raw""")
def n15(spark, sf):
    m = tpch.maintenance(_t(spark, sf, "part"))
    return m.select("aircraft_code", X.default_if_null("description", "").alias("description"))


# =============================================================== 2.4 joins

@register("j1_key_lookup", """
SELECT o.o_orderkey, c.c_custkey AS passenger_id, c.c_name AS passenger_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def j1(spark, sf):
    t = _t(spark, sf, "orders", "customer")
    return (t["orders"].join(t["customer"], t["orders"].o_custkey == t["customer"].c_custkey, "left")
            .select("o_orderkey", F.col("c_custkey").alias("passenger_id"), F.col("c_name").alias("passenger_name")))


@register("j2_composite_key_lookup", """
WITH pairs AS (SELECT l_partkey, l_suppkey, row_number() OVER (ORDER BY l_partkey, l_suppkey) AS pair_id
               FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, p.pair_id
FROM lineitem l LEFT JOIN pairs p ON l.l_partkey = p.l_partkey AND l.l_suppkey = p.l_suppkey""")
def j2(spark, sf):
    li = _t(spark, sf, "lineitem")["lineitem"]
    pairs = assign_keys(li.select("l_partkey", "l_suppkey").distinct(), ["l_partkey", "l_suppkey"], "pair_id")
    return li.join(pairs, ["l_partkey", "l_suppkey"], "left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pair_id")


@register("j3_role_playing_dimension", """
SELECT l.l_orderkey, l.l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN nation sn ON s.s_nationkey = sn.n_nationkey""")
def j3(spark, sf):
    t = _t(spark, sf, "lineitem", "orders", "customer", "supplier", "nation")
    n = t["nation"]
    cn = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("customer_nation"))
    sn = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    return (t["lineitem"].join(t["orders"].select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(t["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(t["supplier"].select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(cn, "c_nationkey").join(sn, "s_nationkey")
            .select("l_orderkey", "l_linenumber", "customer_nation", "supplier_nation"))


# =============================================================== 2.5 aggregation

@register("a1_completeness", Q.with_(Q.BOOKINGS_RAW) + """
SELECT "column", nulls, rows, (rows - nulls) * 100.0 / rows AS filled_percent FROM (
  SELECT count(*) AS rows,
         count(*) FILTER (WHERE booking_ref IS NULL) AS booking_ref,
         count(*) FILTER (WHERE passenger_name IS NULL) AS passenger_name,
         count(*) FILTER (WHERE flight_number IS NULL) AS flight_number,
         count(*) FILTER (WHERE departure_airport IS NULL) AS departure_airport,
         count(*) FILTER (WHERE arrival_airport IS NULL) AS arrival_airport,
         count(*) FILTER (WHERE ticket_price IS NULL) AS ticket_price,
         count(*) FILTER (WHERE status IS NULL) AS status
  FROM bookings_raw)
UNPIVOT (nulls FOR "column" IN (booking_ref, passenger_name, flight_number, departure_airport,
                                arrival_airport, ticket_price, status))""")
def a1(spark, sf):
    b = tpch.bookings(_t(spark, sf, "orders", "customer"))
    return quality.completeness(b, ["booking_ref", "passenger_name", "flight_number", "departure_airport",
                                    "arrival_airport", "ticket_price", "status"])


_ORDER_NULLS = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in ORDER_COLS)


@register("a2_final_report", f"""
WITH g AS (SELECT {', '.join(ORDER_COLS)}, {_ORDER_NULLS} AS z, count(*) AS n FROM orders GROUP BY ALL),
s AS (SELECT sum(n) AS total, sum(n - 1) AS dups, coalesce(sum(n) FILTER (WHERE z = {len(ORDER_COLS)}), 0) AS empty, sum(n * z) AS nulls FROM g)
SELECT 'orders' AS source, CAST(total AS BIGINT) AS total_rows, {len(ORDER_COLS)} AS total_columns,
       CAST(dups AS BIGINT) AS duplicate_count, CAST(empty AS BIGINT) AS empty_rows,
       (1 - CAST(nulls AS DOUBLE) / CAST(total * {len(ORDER_COLS)} AS DOUBLE)) * 100.0 AS completeness_percent
FROM s""")
def a2(spark, sf):
    o = _t(spark, sf, "orders")["orders"].select(ORDER_COLS)
    r = quality.validate_results(o, "orders", ORDER_COLS)
    return r.select("source", "total_rows", "total_columns", "duplicate_count", "empty_rows", "completeness_percent")


@register("a3_outlier_report", """
WITH b AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS med,
                  quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
     e AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med,
                  quantile_cont(value, 0.75) AS q3 FROM events)
SELECT 'o_totalprice' AS "column",
       (SELECT count(*) FROM orders, b WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS "count",
       round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound,
       (SELECT min(o_totalprice) + 0.0 FROM orders) AS "min", (SELECT max(o_totalprice) + 0.0 FROM orders) AS "max",
       round((SELECT avg(o_totalprice) FROM orders), 4) AS mean, round(med, 4) AS median
FROM b
UNION ALL
SELECT 'value', (SELECT count(*) FROM events, e WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)),
       round(q1 - 1.5 * (q3 - q1), 4), round(q3 + 1.5 * (q3 - q1), 4),
       (SELECT min(value) + 0.0 FROM events), (SELECT max(value) + 0.0 FROM events),
       round((SELECT avg(value) FROM events), 4), round(med, 4)
FROM e""")
def a3(spark, sf):
    from runway.plans.stages import in_parallel
    t = _t(spark, sf, "orders", "events")
    # Two independent searches over two tables: their jobs are submitted side by side.
    parts = in_parallel({"orders": lambda: stats.detect_outliers(t["orders"], ["o_totalprice"]),
                         "events": lambda: stats.detect_outliers(t["events"], ["value"])})
    out = parts["orders"].unionByName(parts["events"])
    # "+ 0.0" turns a negative zero into 0.0 on both sides (engines differ on the sign of a zero minimum).
    return out.select("column", "count", F.round("lower_bound", 4).alias("lower_bound"),
                      F.round("upper_bound", 4).alias("upper_bound"), (F.col("min") + 0.0).alias("min"),
                      (F.col("max") + 0.0).alias("max"),
                      F.round("mean", 4).alias("mean"), F.round("median", 4).alias("median"))


# =============================================================== the job over the driver's tables

_RUNS: dict[tuple[str, str], object] = {}
_RUNS_LOCK = threading.Lock()


def job_result(spark: SparkSession, sf: str):
    """The whole run (clean, load, check) over ``sf``, once per application and input."""
    from runway.plans import job
    from runway.session import shared_path
    key = (spark.sparkContext.applicationId, sf)
    with _RUNS_LOCK:
        if key not in _RUNS:
            root = shared_path(spark, "job")
            _RUNS[key] = job.run(spark, tpch.sources(spark, sf), root)
        return _RUNS[key]


def _tables(spark, sf) -> dict[str, DataFrame]:
    return job_result(spark, sf).tables


W = Q.warehouse_with


def _star(name: str, sql_body: str, fn):
    register(name, W() + sql_body)(fn)


# ---- T1-T5: cleaned sources
register("t1_clean_bookings", Q.with_(*Q.SOURCES_CLEAN) + "SELECT * FROM bookings_clean")(
    lambda spark, sf: job_result(spark, sf).cleaned["bookings"])
register("t2_clean_flights", Q.with_(*Q.SOURCES_CLEAN) + "SELECT * FROM flights_clean")(
    lambda spark, sf: job_result(spark, sf).cleaned["flights"])
register("t3_clean_logs", Q.with_(Q.LOGS_RAW, Q.LOGS_CLEAN) + "SELECT * FROM logs_clean")(
    lambda spark, sf: job_result(spark, sf).cleaned["logs"].withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")))
register("t4_clean_weather", Q.with_(Q.WEATHER_RAW, Q.WEATHER_CLEAN) + "SELECT * FROM weather_clean")(
    lambda spark, sf: job_result(spark, sf).cleaned["weather"].withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")))
register("t5_clean_maintenance", Q.with_(*Q.SOURCES_CLEAN) + "SELECT * FROM maintenance_clean")(
    lambda spark, sf: job_result(spark, sf).cleaned["maintenance"])

# ---- A2 at the end of T1-T5: the report of each cleaned source
_CLEANED = {"bookings": (Q.SOURCES_CLEAN, Q.BOOKING_COLS), "flights": (Q.SOURCES_CLEAN, Q.FLIGHT_COLS),
            "logs": ([Q.LOGS_RAW, Q.LOGS_CLEAN], ["timestamp", "level", "flight_number", "message"]),
            "weather": ([Q.WEATHER_RAW, Q.WEATHER_CLEAN], ["airport_code", "timestamp", "temperature", "humidity", "wind_speed",
                                                          "visibility", "conditions"]),
            "maintenance": (Q.SOURCES_CLEAN, Q.MAINT_COLS)}


def _final_report_sql(name: str) -> str:
    parts, cols = _CLEANED[name]
    names = [f'"{c}"' for c in cols]
    z = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in names)
    return Q.with_(*parts) + f"""
SELECT '{name}' AS source, CAST(sum(n) AS BIGINT) AS total_rows, {len(cols)} AS total_columns, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
       CAST(coalesce(sum(n) FILTER (WHERE z = {len(cols)}), 0) AS BIGINT) AS empty_rows, CAST(sum(n * z) AS BIGINT) AS nulls,
       (1 - CAST(sum(n * z) AS DOUBLE) / CAST(sum(n) * {len(cols)} AS DOUBLE)) * 100.0 AS completeness_percent
FROM (SELECT {', '.join(names)}, {z} AS z, count(*) AS n FROM {name}_clean GROUP BY ALL)"""


def _final_report(name: str):
    def run(spark, sf):
        nulls = F.aggregate(F.map_values("null_counts"), F.lit(0).cast("long"), lambda a, x: a + x)
        return job_result(spark, sf).final_report.where(F.col("source") == name).select(
            "source", "total_rows", "total_columns", "duplicate_count", "empty_rows", nulls.alias("nulls"), "completeness_percent")
    return run


for _n, _source in enumerate(("bookings", "flights", "logs", "weather", "maintenance"), 1):
    register(f"t{_n}_final_report", _final_report_sql(_source))(_final_report(_source))

# ---- M6-M14, M16: warehouse tables after a fresh load
for _name, _table in [("m6_dim_airports", "dim_airports"), ("m7_dim_aircraft", "dim_aircraft"),
                      ("m8_dim_dates", "dim_dates"), ("m9_dim_passengers", "dim_passengers"),
                      ("m10_dim_flights", "dim_flights"), ("m11_fact_bookings", "fact_bookings"),
                      ("m12_fact_flights", "fact_flights"), ("m13_fact_revenue", "fact_revenue"),
                      ("m14_fact_maintenance", "fact_maintenance")]:
    register(_name, W() + f"SELECT * FROM {_table}")(
        (lambda tbl: lambda spark, sf: _tables(spark, sf)[tbl])(_table))

register("a7_revenue_fact", W() + """
SELECT flight_id, date_id, total_revenue, passenger_count, avg_ticket_price, confirmed_count, cancelled_count
FROM fact_revenue""")(
    lambda spark, sf: revenue_aggregate(_tables(spark, sf)["fact_bookings"], _tables(spark, sf)["dim_statuses"]))


@register("a7_revenue_all_statuses", W() + """
SELECT fb.flight_id, fb.booking_date_id AS date_id, CAST(sum(fb.ticket_price) AS DECIMAL(15,2)) AS total_revenue,
       count(fb.booking_id) AS passenger_count, """ + Q.avg_dec("fb.ticket_price") + """ AS avg_ticket_price,
       count(*) FILTER (WHERE ds.status_code = 'confirmed') AS confirmed_count,
       count(*) FILTER (WHERE ds.status_code = 'cancelled') AS cancelled_count
FROM fact_bookings fb JOIN dim_statuses ds ON fb.status_id = ds.status_id
GROUP BY fb.flight_id, fb.booking_date_id""")
def a7_all(spark, sf):
    t = _tables(spark, sf)
    return revenue_aggregate(t["fact_bookings"], t["dim_statuses"], None)


@register("m15_status_usage", W() + """
SELECT s.status_id, s.status_code, s.category,
       (SELECT count(*) FROM fact_bookings f WHERE f.status_id = s.status_id)
     + (SELECT count(*) FROM fact_flights f WHERE f.status_id = s.status_id)
     + (SELECT count(*) FROM fact_maintenance f WHERE f.status_id = s.status_id) AS facts
FROM dim_statuses s""")
def m15(spark, sf):
    t = _tables(spark, sf)
    used = (t["fact_bookings"].select("status_id").unionAll(t["fact_flights"].select("status_id"))
            .unionAll(t["fact_maintenance"].select("status_id")).groupBy("status_id").count())
    return (t["dim_statuses"].join(used, "status_id", "left")
            .select("status_id", "status_code", "category", F.coalesce("count", F.lit(0)).alias("facts")))


_WEATHER_DIM = """
SELECT row_number() OVER (ORDER BY airport_id NULLS FIRST, observation_time NULLS FIRST) AS weather_id, *
FROM (SELECT a.airport_id, w."timestamp" AS observation_time,
             min(""" + Q.dec('w.temperature', 5, 2) + """) AS temperature,
             arg_min(CAST(w.humidity AS INTEGER), """ + Q.dec('w.temperature', 5, 2) + """) AS humidity,
             arg_min(""" + Q.dec('w.wind_speed', 5, 2) + """, """ + Q.dec('w.temperature', 5, 2) + """) AS wind_speed,
             arg_min(CAST(w.visibility AS INTEGER), """ + Q.dec('w.temperature', 5, 2) + """) AS visibility,
             arg_min(w.conditions, """ + Q.dec('w.temperature', 5, 2) + """) AS conditions
      FROM weather_clean w LEFT JOIN dim_airports a ON w.airport_code = a.airport_code
      GROUP BY a.airport_id, w."timestamp")"""


@register("m16_dim_weather", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE, Q.WEATHER_RAW, Q.WEATHER_CLEAN) + _WEATHER_DIM)
def m16(spark, sf):
    return _tables(spark, sf)["dim_weather"].withColumn(
        "observation_time", F.col("observation_time").cast("timestamp_ntz"))


# ---- J4-J7: star views
_star("j4_flights_view", "SELECT * FROM flights_view",
      lambda spark, sf: marts.flights_view(_tables(spark, sf)))
_star("j5_bookings_view", "SELECT * FROM bookings_view",
      lambda spark, sf: marts.bookings_view(_tables(spark, sf)))
_star("j6_maintenance_view", "SELECT * FROM maintenance_view",
      lambda spark, sf: marts.maintenance_view(_tables(spark, sf)))
_star("j7_fact_status_join", """
SELECT fb.booking_id, ds.status_code FROM fact_bookings fb JOIN dim_statuses ds ON fb.status_id = ds.status_id""",
      lambda spark, sf: _tables(spark, sf)["fact_bookings"].join(
          _tables(spark, sf)["dim_statuses"], "status_id").select("booking_id", "status_code"))


def _fv(spark, sf):
    return marts.flights_view(_tables(spark, sf), ordered=False)


def _bv(spark, sf):
    return marts.bookings_view(_tables(spark, sf), ordered=False)


def _mv(spark, sf):
    return marts.maintenance_view(_tables(spark, sf), ordered=False)


# ---- A8-A22 over the views
_star("a8_kpis", """
SELECT 'total_flights' AS metric, CAST(count(*) AS DOUBLE) AS value FROM flights_view
UNION ALL SELECT 'total_bookings', CAST(count(*) AS DOUBLE) FROM bookings_view
UNION ALL SELECT 'total_revenue', CAST(sum(ticket_price) AS DOUBLE) FROM bookings_view
UNION ALL SELECT 'avg_price', round(CAST(avg(ticket_price) AS DOUBLE), 6) FROM bookings_view""",
      lambda spark, sf: marts.kpis(_fv(spark, sf), _bv(spark, sf)))
_star("a9_maintenance_kpis", """
SELECT count(*) AS total_maintenance, sum(cost) AS total_cost,
       count(*) FILTER (WHERE status_code = 'completed') AS completed,
       count(*) FILTER (WHERE status_code = 'planned') AS planned
FROM maintenance_view""", lambda spark, sf: marts.maintenance_kpis(_mv(spark, sf)))
_star("a10_booking_status_counts", """
SELECT status, count(*) AS "count" FROM bookings_view WHERE status IS NOT NULL GROUP BY status""",
      lambda spark, sf: marts.frequency(_bv(spark, sf), "status"))
_star("a10_flights_by_departure", """
SELECT departure, count(*) AS "count" FROM flights_view WHERE departure IS NOT NULL GROUP BY departure""",
      lambda spark, sf: marts.frequency(_fv(spark, sf), "departure"))
_star("a10_aircraft_usage", """
SELECT aircraft_id, count(*) AS "count" FROM flights_view WHERE aircraft_id IS NOT NULL GROUP BY aircraft_id""",
      lambda spark, sf: marts.frequency(_fv(spark, sf), "aircraft_id"))
_star("a10_maintenance_type_counts", """
SELECT type_name, count(*) AS "count" FROM maintenance_view WHERE type_name IS NOT NULL GROUP BY type_name""",
      lambda spark, sf: marts.frequency(_mv(spark, sf), "type_name"))
_star("a11_flight_status_share", """
SELECT status, count(*) AS "count",
       printf('%.1f', round_even(count(*) * 100.0 / (SELECT count(*) FROM flights_view WHERE status IS NOT NULL), 1)) || '%' AS percent
FROM flights_view WHERE status IS NOT NULL GROUP BY status""",
      lambda spark, sf: marts.frequency_share(_fv(spark, sf), "status"))
_star("a12_flights_by_date", """
SELECT flight_date, count(*) AS "count" FROM flights_view WHERE flight_date IS NOT NULL GROUP BY flight_date""",
      lambda spark, sf: marts.count_by(_fv(spark, sf), "flight_date"))
_star("a13_revenue_by_airport", """
SELECT departure_airport, sum(ticket_price) AS revenue FROM bookings_view
WHERE departure_airport IS NOT NULL GROUP BY departure_airport""",
      lambda spark, sf: marts.sum_by(_bv(spark, sf), "departure_airport", "ticket_price", "revenue"))
_star("a13_cost_by_type", """
SELECT type_name, sum(cost) AS cost FROM maintenance_view WHERE type_name IS NOT NULL GROUP BY type_name""",
      lambda spark, sf: marts.sum_by(_mv(spark, sf), "type_name", "cost", "cost"))
_star("a13_cost_by_aircraft", """
SELECT aircraft_code, sum(cost) AS cost FROM maintenance_view WHERE aircraft_code IS NOT NULL GROUP BY aircraft_code""",
      lambda spark, sf: marts.sum_by(_mv(spark, sf), "aircraft_code", "cost", "cost"))
_star("a14_price_by_departure", """
SELECT departure_airport, round(avg(CAST(ticket_price AS DOUBLE)), 6) AS mean,
       round(quantile_cont(CAST(ticket_price AS DOUBLE), 0.5), 6) AS median, count(ticket_price) AS "count"
FROM bookings_view WHERE departure_airport IS NOT NULL GROUP BY departure_airport""",
      lambda spark, sf: marts.mean_median_count_by(_bv(spark, sf), "departure_airport", "ticket_price")
      .select("departure_airport", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "count"))
_star("a14_price_by_aircraft", """
SELECT aircraft_type, round(avg(CAST(ticket_price AS DOUBLE)), 6) AS mean,
       round(quantile_cont(CAST(ticket_price AS DOUBLE), 0.5), 6) AS median, count(ticket_price) AS "count"
FROM bookings_view WHERE aircraft_type IS NOT NULL GROUP BY aircraft_type""",
      lambda spark, sf: marts.mean_median_count_by(_bv(spark, sf), "aircraft_type", "ticket_price")
      .select("aircraft_type", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "count"))
_star("a15_price_by_weekday", f"""
SELECT CAST(isodow(booking_date) - 1 AS INTEGER) AS weekday, dayname(booking_date) AS day_name,
       round(avg(CAST(ticket_price AS DOUBLE)), 6) AS mean, count(*) AS "count",
       {DAY_RU_SQL.format(d='min(booking_date)')} AS day_name_ru
FROM bookings_view WHERE booking_date IS NOT NULL GROUP BY ALL""",
      lambda spark, sf: marts.by_weekday(_bv(spark, sf), "booking_date", "ticket_price")
      .withColumn("mean", F.round(F.col("mean").cast("double"), 6)))
_star("a16_price_describe", """
SELECT count(ticket_price) AS "count", round(avg(CAST(ticket_price AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST(ticket_price AS DOUBLE)), 6) AS std, CAST(min(ticket_price) AS DOUBLE) AS "min",
       round(quantile_cont(CAST(ticket_price AS DOUBLE), 0.25), 6) AS p25,
       round(quantile_cont(CAST(ticket_price AS DOUBLE), 0.5), 6) AS p50,
       round(quantile_cont(CAST(ticket_price AS DOUBLE), 0.75), 6) AS p75, CAST(max(ticket_price) AS DOUBLE) AS "max"
FROM bookings_view""",
      lambda spark, sf: marts.price_stats(_bv(spark, sf)).select(
          "count", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"), "min",
          F.round("p25", 6).alias("p25"), F.round("p50", 6).alias("p50"), F.round("p75", 6).alias("p75"), "max"))
_star("a18_delay_summary", """
SELECT count(*) AS flights_with_data,
       round(avg(date_diff('microsecond', scheduled_departure, actual_departure) / 60000000.0), 6) AS avg_delay,
       max(date_diff('microsecond', scheduled_departure, actual_departure) / 60000000.0) AS max_delay,
       count(*) FILTER (WHERE actual_departure > scheduled_departure) AS delayed,
       count(*) - count(*) FILTER (WHERE actual_departure > scheduled_departure) AS on_time
FROM flights_view WHERE actual_departure IS NOT NULL AND scheduled_departure IS NOT NULL""",
      lambda spark, sf: marts.delay_summary(_fv(spark, sf)).withColumn("avg_delay", F.round("avg_delay", 6)))
register("a19_price_histogram", W("""
hb AS (SELECT CAST(min(ticket_price) AS DOUBLE) AS lo, CAST(max(ticket_price) AS DOUBLE) AS hi FROM bookings_view),
hx AS (SELECT least(CAST(floor((CAST(ticket_price AS DOUBLE) - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin, lo, hi
       FROM bookings_view, hb WHERE ticket_price IS NOT NULL)""") + """
SELECT bin, round(lo + bin * ((hi - lo) / 20), 4) AS bin_start, round(lo + (bin + 1) * ((hi - lo) / 20), 4) AS bin_end,
       count(*) AS "count"
FROM hx GROUP BY bin, lo, hi""")(
    lambda spark, sf: marts.price_histogram(_bv(spark, sf)).select(
        "bin", F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"), "count"))
_star("a20_filter_bounds", """
SELECT min(ticket_price) AS min_price, max(ticket_price) AS max_price,
       min(booking_date) AS min_date, max(booking_date) AS max_date FROM bookings_view""",
      lambda spark, sf: marts.filter_bounds(_bv(spark, sf)))


# =============================================================== 2.5 imputation and report views

def _events_with_gaps(spark, sf) -> DataFrame:
    """Events with NULLs made from the data: no value for errors, no type for large values."""
    e = _t(spark, sf, "events")["events"]
    return e.select("event_id", F.when(F.col("value") <= 100, F.col("event_type")).alias("event_type"),
                    F.when(F.col("event_type") != "error", F.col("value")).alias("value"))


EVENTS_GAPS = """
ev AS (SELECT event_id, CASE WHEN value <= 100 THEN event_type END AS event_type,
              CASE WHEN event_type <> 'error' THEN value END AS value FROM events),
ev_median AS (SELECT quantile_cont(value, 0.5) AS m FROM ev),
ev_mode AS (SELECT event_type AS v FROM ev WHERE event_type IS NOT NULL
            GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)"""


@register("a4_median_imputation", Q.with_(EVENTS_GAPS) + """
SELECT event_id, coalesce(value, (SELECT m FROM ev_median)) AS value FROM ev""")
def a4(spark, sf):
    filled, _ = stats.smart_fill(_events_with_gaps(spark, sf).drop("event_type"), exclude={"event_id"})
    return filled.select("event_id", "value")


@register("a5_mode_imputation", Q.with_(EVENTS_GAPS) + """
SELECT event_id, coalesce(event_type, (SELECT v FROM ev_mode)) AS event_type FROM ev""")
def a5(spark, sf):
    filled, _ = stats.smart_fill(_events_with_gaps(spark, sf).drop("value"), exclude={"event_id"})
    return filled.select("event_id", "event_type")


@register("a6_fill_report", Q.with_(EVENTS_GAPS) + """
SELECT 'value' AS "column", 'median' AS method, CAST((SELECT m FROM ev_median) AS VARCHAR) AS value,
       (SELECT count(*) FROM ev WHERE value IS NULL) AS filled
UNION ALL
SELECT 'event_type', 'mode', (SELECT v FROM ev_mode), (SELECT count(*) FROM ev WHERE event_type IS NULL)""")
def a6(spark, sf):
    _, report = stats.smart_fill(_events_with_gaps(spark, sf), exclude={"event_id"})
    return report


@register("a17_null_profile", Q.with_(Q.BOOKINGS_RAW) + """
SELECT "column", nulls, round_even(nulls * 100.0 / rows, 1) AS percent FROM (
  SELECT count(*) AS rows,
         count(*) FILTER (WHERE id IS NULL) AS id,
         count(*) FILTER (WHERE booking_ref IS NULL) AS booking_ref,
         count(*) FILTER (WHERE passenger_name IS NULL) AS passenger_name,
         count(*) FILTER (WHERE flight_number IS NULL) AS flight_number,
         count(*) FILTER (WHERE departure_airport IS NULL) AS departure_airport,
         count(*) FILTER (WHERE arrival_airport IS NULL) AS arrival_airport,
         count(*) FILTER (WHERE departure_time IS NULL) AS departure_time,
         count(*) FILTER (WHERE arrival_time IS NULL) AS arrival_time,
         count(*) FILTER (WHERE aircraft_type IS NULL) AS aircraft_type,
         count(*) FILTER (WHERE ticket_price IS NULL OR isnan(ticket_price)) AS ticket_price,
         count(*) FILTER (WHERE currency IS NULL) AS currency,
         count(*) FILTER (WHERE booking_date IS NULL) AS booking_date,
         count(*) FILTER (WHERE status IS NULL) AS status
  FROM bookings_raw)
UNPIVOT (nulls FOR "column" IN (id, booking_ref, passenger_name, flight_number, departure_airport, arrival_airport,
                                departure_time, arrival_time, aircraft_type, ticket_price, currency, booking_date,
                                status))
WHERE nulls > 0""")
def a17(spark, sf):
    return quality.null_profile(tpch.bookings(_t(spark, sf, "orders", "customer")))


def _completeness_sql(table: str, cols: list[str]) -> str:
    nulls = " + ".join(f'count(*) FILTER (WHERE "{c}" IS NULL)' for c in cols)
    return f"(SELECT (1 - ({nulls}) / (count(*) * {len(cols)}.0)) * 100 FROM {table})"


_CLEAN_COLS = {
    "bookings": Q.BOOKING_COLS, "flights": Q.FLIGHT_COLS, "maintenance": Q.MAINT_COLS,
    "logs": ["timestamp", "level", "flight_number", "message"],
    "weather": ["airport_code", "timestamp", "temperature", "humidity", "wind_speed", "visibility", "conditions"],
}
_REQ = {"bookings": ["booking_ref", "passenger_name", "flight_number", "departure_airport", "arrival_airport",
                     "ticket_price", "status"],
        "flights": ["flight_number", "departure", "arrival", "status"],
        "maintenance": ["aircraft_code", "maintenance_type", "scheduled_date", "status", "cost"]}

REPORT_SQL = Q.with_(*Q.SOURCES_CLEAN, Q.LOGS_RAW, Q.LOGS_CLEAN, Q.WEATHER_RAW, Q.WEATHER_CLEAN) + f"""
, rep AS (
  SELECT 'bookings' AS source, (SELECT count(*) FROM bk_good) AS initial_rows,
         (SELECT count(*) FROM bookings_clean) AS final_rows,
         (SELECT count(*) FROM bk_flag WHERE null_count > 2) AS rejected_rows,
         (SELECT count(*) FROM bk_good) - (SELECT count(*) FROM bookings_clean) AS duplicates_removed,
         {_completeness_sql('bookings_raw', _REQ['bookings'])} AS completeness_before,
         {_completeness_sql('bookings_clean', _CLEAN_COLS['bookings'])} AS completeness_after
  UNION ALL
  SELECT 'flights', (SELECT count(*) FROM flights_raw), (SELECT count(*) FROM flights_clean), 0,
         (SELECT count(*) FROM flights_raw) - (SELECT count(*) FROM flights_clean),
         {_completeness_sql('flights_raw', _REQ['flights'])},
         {_completeness_sql('flights_clean', _CLEAN_COLS['flights'])}
  UNION ALL
  SELECT 'logs', (SELECT count(*) FROM logs_raw), (SELECT count(*) FROM logs_raw), 0, 0, NULL,
         {_completeness_sql('logs_clean', _CLEAN_COLS['logs'])}
  UNION ALL
  SELECT 'weather', (SELECT count(*) FROM weather_raw), (SELECT count(*) FROM weather_raw), 0, 0, NULL,
         {_completeness_sql('weather_clean', _CLEAN_COLS['weather'])}
  UNION ALL
  SELECT 'maintenance', (SELECT count(*) FROM maintenance_raw), (SELECT count(*) FROM mt_std),
         (SELECT count(*) FROM maintenance_raw) - (SELECT count(*) FROM mt_std), 0,
         {_completeness_sql('maintenance_raw', _REQ['maintenance'])},
         {_completeness_sql('maintenance_clean', _CLEAN_COLS['maintenance'])})
""".replace("WITH ", "WITH ", 1)
# the report CTE follows the WITH list
REPORT_SQL = REPORT_SQL.replace("\n, rep AS (", ",\nrep AS (")


@register("a23_quality_report", REPORT_SQL + """
SELECT source, initial_rows, final_rows, rejected_rows, duplicates_removed,
       round(completeness_before, 6) AS completeness_before, round(completeness_after, 6) AS completeness_after
FROM rep""")
def a23(spark, sf):
    r = job_result(spark, sf).report
    return r.select("source", "initial_rows", "final_rows", "rejected_rows", "duplicates_removed",
                    F.round("completeness_before", 6).alias("completeness_before"),
                    F.round("completeness_after", 6).alias("completeness_after"))


@register("a21_quality_summary", REPORT_SQL + """
SELECT source, initial_rows, final_rows, rejected_rows, duplicates_removed,
       printf('%.2f', completeness_after) AS completeness FROM rep""")
def a21(spark, sf):
    return marts.quality_summary(job_result(spark, sf).report)


@register("s11_report_json_roundtrip", REPORT_SQL + """
SELECT source, initial_rows, final_rows, rejected_rows FROM rep""")
def s11(spark, sf):
    return job_result(spark, sf).report.select("source", "initial_rows", "final_rows", "rejected_rows")


@register("a22_fill_details", Q.with_(*Q.SOURCES_CLEAN) + """
SELECT 'bookings' AS source, 'ticket_price' AS "column", 'median' AS method,
       CAST((SELECT m FROM bk_median) AS VARCHAR) AS value,
       (SELECT count(*) FROM bookings_std WHERE ticket_price IS NULL) AS filled
UNION ALL
SELECT 'maintenance', 'cost', 'median', CAST((SELECT m FROM mt_median) AS VARCHAR),
       (SELECT count(*) FROM mt_std WHERE cost IS NULL)
UNION ALL
SELECT 'maintenance', 'description', 'mode', (SELECT v FROM mt_mode),
       (SELECT count(*) FROM mt_std WHERE description IS NULL)""")
def a22_fill(spark, sf):
    return marts.fill_details(job_result(spark, sf).report)


def _outlier_sql(source: str, table: str, col: str) -> str:
    v = f"CAST({col} AS DOUBLE)"
    return f"""
SELECT '{source}' AS source, '{col}' AS "column",
       (SELECT count(*) FROM {table} WHERE {v} < q.lo OR {v} > q.hi) AS "count",
       (SELECT min({v}) + 0.0 FROM {table}) AS "min", (SELECT max({v}) + 0.0 FROM {table}) AS "max",
       round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound
FROM (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
      FROM (SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM {table})) q"""


@register("a22_outlier_details", Q.with_(*Q.SOURCES_CLEAN, Q.WEATHER_RAW, Q.WEATHER_CLEAN) + " UNION ALL ".join(
    [_outlier_sql("bookings", "bookings_clean", "ticket_price")] +
    [_outlier_sql("weather", "weather_clean", c) for c in ("temperature", "humidity", "wind_speed")]))
def a22_out(spark, sf):
    d = marts.outlier_details(job_result(spark, sf).report)
    return d.select("source", "column", "count", (F.col("min") + 0.0).alias("min"), (F.col("max") + 0.0).alias("max"),
                    F.round("lower_bound", 6).alias("lower_bound"),
                    F.round("upper_bound", 6).alias("upper_bound"))


# =============================================================== 2.6 distinct, set operations, sort

@register("d1_dedupe_full_rows", "SELECT DISTINCT * FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders)")
def d1(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return dedupe.dedupe_rows(o.unionAll(o), None)


@register("d1_dedupe_ignoring_id", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT min(id) AS id, {Q._bk_keys} FROM bookings_raw GROUP BY {Q._bk_keys}""")
def d1b(spark, sf):
    return dedupe.dedupe_rows(tpch.bookings(_t(spark, sf, "orders", "customer")))


@register("d2_first_row_per_key", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE) + "SELECT * FROM route_src")
def d2(spark, sf):
    from runway.plans.warehouse import route_source
    c = job_result(spark, sf).cleaned
    return route_source(c["bookings"], c["flights"])


@register("d3_distinct_values", "SELECT DISTINCT c_nationkey FROM customer WHERE c_nationkey IS NOT NULL")
def d3(spark, sf):
    return dedupe.distinct_values(_t(spark, sf, "customer")["customer"], "c_nationkey")


@register("d4_union_distinct", """
SELECT DISTINCT nationkey FROM (SELECT c_nationkey AS nationkey FROM customer UNION ALL
                                SELECT s_nationkey FROM supplier) WHERE nationkey IS NOT NULL""")
def d4(spark, sf):
    t = _t(spark, sf, "customer", "supplier")
    return dedupe.union_distinct([(t["customer"], "c_nationkey"), (t["supplier"], "s_nationkey")], "nationkey")


@register("d5_union_by_name", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, NULL, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def d5(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    parts = [o.where("o_orderstatus = 'F'"),
             o.where("o_orderstatus = 'O'").drop("o_orderpriority"),
             o.where("o_orderstatus = 'P'").drop("o_totalprice").select("o_orderpriority", "o_orderkey", "o_custkey",
                                                                     "o_orderstatus", "o_orderdate")]
    return dedupe.union_by_name(parts).select(o.columns)


@register("d6_union_projections", Q.with_(Q.BOOKINGS_RAW, Q.FLIGHTS_RAW) + """
SELECT flight_number, departure_airport, arrival_airport FROM bookings_raw
UNION ALL SELECT flight_number, departure, arrival FROM flights_raw""")
def d6(spark, sf):
    t = _t(spark, sf, "orders", "customer", "lineitem")
    b = tpch.bookings(t).select("flight_number", "departure_airport", "arrival_airport")
    f = tpch.flights_report(t).select("flight_number", F.col("departure").alias("departure_airport"),
                                      F.col("arrival").alias("arrival_airport"))
    return dedupe.union_by_name([b, f])


_star("d7_distinct_in_check", """
SELECT DISTINCT ds.status_code FROM fact_bookings fb JOIN dim_statuses ds ON fb.status_id = ds.status_id""",
      lambda spark, sf: _tables(spark, sf)["fact_bookings"].join(_tables(spark, sf)["dim_statuses"], "status_id")
      .select("status_code").distinct())


@register("d8_order_by", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey")
def d8(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return o.select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(F.col("o_orderdate").desc(), "o_orderkey")


@register("d9_weekday_order", """
SELECT CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday, dayname(o_orderdate) AS day_name, count(*) AS "count"
FROM orders GROUP BY ALL ORDER BY weekday""")
def d9(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    return (o.groupBy(F.weekday(F.to_date("o_orderdate")).alias("weekday"), X.day_name("o_orderdate").alias("day_name"))
            .count().orderBy("weekday"))


# =============================================================== 2.7 merges and keys

@register("m1_upsert_update", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE) + """
SELECT airport_id, airport_code, airport_code AS airport_name, lower(airport_code) AS city, 'Россия' AS country
FROM dim_airports
UNION ALL
SELECT (SELECT max(airport_id) FROM dim_airports) + row_number() OVER (ORDER BY n_name), n_name, n_name, n_name, 'Россия'
FROM nation WHERE n_name NOT IN (SELECT airport_code FROM dim_airports)""")
def m1(spark, sf):
    from runway.operators.merge import upsert
    target = _tables(spark, sf)["dim_airports"]
    n = _t(spark, sf, "nation")["nation"]
    src = target.select("airport_code", F.col("airport_code").alias("airport_name"),
                        F.lower("airport_code").alias("city"), "country").unionByName(
        n.select(F.col("n_name").alias("airport_code"), F.col("n_name").alias("airport_name"),
                 F.col("n_name").alias("city"), F.lit("Россия").alias("country")))
    return upsert(target, src, ["airport_code"], "airport_id")


@register("m2_upsert_dates", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE) + f"""
SELECT {Q.CALENDAR} FROM (SELECT full_date AS d FROM dim_dates UNION
                          SELECT CAST(l_shipdate AS DATE) FROM lineitem)""")
def m2(spark, sf):
    from runway.operators.merge import upsert_on_key
    target = _tables(spark, sf)["dim_dates"]
    li = _t(spark, sf, "lineitem")["lineitem"]
    days = li.select(X.to_date("l_shipdate").alias("d")).distinct()
    src = days.select(*[c.alias(k) for k, c in X.calendar_columns("d").items()])
    return upsert_on_key(target, src, ["date_id"])


@register("m3_insert_missing", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE) + """
SELECT passenger_id, passenger_name FROM dim_passengers
UNION ALL
SELECT (SELECT max(passenger_id) FROM dim_passengers) + row_number() OVER (ORDER BY c_name), c_name
FROM (SELECT DISTINCT c_name FROM customer WHERE c_name NOT IN (SELECT passenger_name FROM dim_passengers))""")
def m3(spark, sf):
    from runway.operators.merge import insert_missing
    target = _tables(spark, sf)["dim_passengers"]
    names = dedupe.distinct_values(_t(spark, sf, "customer")["customer"], "c_name", "passenger_name")
    return insert_missing(target, names, ["passenger_name"], "passenger_id")


@register("m4_upsert_null_safe_rerun", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE, Q.LOGS_RAW, Q.LOGS_CLEAN) + """
SELECT * FROM dim_flights
UNION ALL
SELECT (SELECT max(flight_id) FROM dim_flights) + row_number() OVER (ORDER BY flight_number), flight_number,
       NULL, NULL, NULL, NULL
FROM (SELECT DISTINCT flight_number FROM logs_clean WHERE flight_number IS NOT NULL)""")
def m4(spark, sf):
    from runway.operators.merge import upsert
    target = _tables(spark, sf)["dim_flights"]
    logs = job_result(spark, sf).cleaned["logs"]
    src = dedupe.distinct_values(logs, "flight_number").select(
        "flight_number", *[F.lit(None).cast("long").alias(c) for c in
                           ("departure_airport_id", "arrival_airport_id", "aircraft_id")],
        F.lit(None).cast("int").alias("scheduled_duration_minutes"))
    keys = ["flight_number", "departure_airport_id", "arrival_airport_id"]
    once = upsert(target, src, keys, "flight_id", update_cols=["aircraft_id"], null_safe=True)
    once = once.checkpoint()
    # A re-run with the same routes must not add rows whose key holds NULLs.
    return upsert(once, src, keys, "flight_id", update_cols=["aircraft_id"], null_safe=True)


@register("m5_surrogate_keys", """
SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS sk FROM orders""")
def m5(spark, sf):
    o = _t(spark, sf, "orders")["orders"].select("o_custkey", "o_orderkey")
    return assign_keys(o, ["o_custkey", "o_orderkey"], "sk")


# =============================================================== 2.9 data-quality checks

def _checks(spark, sf) -> DataFrame:
    return job_result(spark, sf).checks


def _check_sql(name: str, count_sql: str) -> str:
    return f"SELECT '{name}' AS \"check\", CAST(({count_sql}) AS BIGINT) AS violations, ({count_sql}) = 0 AS passed"


_CHECK_SQL = {
    "v1c_not_empty": [
        ("dim_airports_not_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM dim_airports"),
        ("dim_aircraft_not_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM dim_aircraft"),
        ("dim_dates_not_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM dim_dates"),
        ("fact_flights_not_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM fact_flights"),
        ("fact_bookings_not_empty", "SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM fact_bookings")],
    "v2c_unique_keys": [
        ("no_duplicate_airports", "SELECT count(*) FROM (SELECT airport_code FROM dim_airports GROUP BY 1 HAVING count(*) > 1)"),
        ("no_duplicate_aircraft", "SELECT count(*) FROM (SELECT aircraft_code FROM dim_aircraft GROUP BY 1 HAVING count(*) > 1)"),
        ("no_duplicate_dates", "SELECT count(*) FROM (SELECT date_id FROM dim_dates GROUP BY 1 HAVING count(*) > 1)")],
    "v3c_non_negative": [
        ("flight_prices_positive", "SELECT count(*) FROM fact_bookings WHERE ticket_price < 0 OR ticket_price IS NULL")],
    "v4c_date_in_range": [
        ("flight_dates_valid", "SELECT count(*) FROM fact_flights ff JOIN dim_dates dd ON ff.flight_date_id = dd.date_id "
                               "WHERE dd.full_date < DATE '2020-01-01' OR dd.full_date > DATE '2030-12-31'")],
    "v5c_code_format": [
        ("airport_codes_format", "SELECT count(*) FROM dim_airports WHERE length(airport_code) <> 3 "
                                 "OR NOT regexp_matches(airport_code, '^[A-Z]{3}$')")],
    "v6c_min_length": [
        ("flight_numbers_format", "SELECT count(*) FROM fact_flights ff JOIN dim_flights df ON ff.flight_id = df.flight_id "
                                  "WHERE df.flight_number IS NULL OR length(df.flight_number) < 2")],
    "v7c_allowed_values": [
        ("booking_status_values", "SELECT count(*) FROM (SELECT DISTINCT ds.status_code FROM fact_bookings fb JOIN "
                                  "dim_statuses ds ON fb.status_id = ds.status_id WHERE ds.status_code NOT IN "
                                  "('confirmed', 'cancelled', 'pending', 'completed'))"),
        ("flight_status_values", "SELECT count(*) FROM (SELECT DISTINCT ds.status_code FROM fact_flights ff JOIN "
                                 "dim_statuses ds ON ff.status_id = ds.status_id WHERE ds.status_code NOT IN "
                                 "('scheduled', 'landed', 'delayed', 'cancelled', 'diverted'))")],
    "v8c_not_null": [
        ("no_null_flight_numbers", "SELECT count(*) FROM fact_flights ff JOIN dim_flights df ON ff.flight_id = df.flight_id "
                                   "WHERE df.flight_number IS NULL"),
        ("no_null_booking_refs", "SELECT count(*) FROM fact_bookings WHERE booking_ref IS NULL")],
}

for _qname, _items in _CHECK_SQL.items():
    register(_qname, W() + "\nUNION ALL\n".join(_check_sql(n, s) for n, s in _items))(
        (lambda names: lambda spark, sf: _checks(spark, sf).where(F.col("check").isin(names)))(
            [n for n, _ in _items]))


def _constraint_sql() -> list[tuple[str, str]]:
    from runway.schemas import CONSTRAINTS, PARENT_KEYS
    out = [(f"orphan_{n}_status", f"SELECT count(*) FROM fact_{n} WHERE status_id IS NULL OR status_id NOT IN (SELECT status_id FROM dim_statuses)")
           for n in ("bookings", "flights", "maintenance")]
    for table, (not_null, unique, foreign) in CONSTRAINTS.items():
        out += [(f"not_null_{table}_{c}", f"SELECT count(*) FROM {table} WHERE {c} IS NULL") for c in not_null]
        out += [(f"fk_{table}_{c}", f"SELECT count(*) FROM {table} WHERE {c} NOT IN (SELECT {PARENT_KEYS[p]} FROM {p})") for c, p in foreign.items()]
        for keys in unique:
            present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
            out.append((f"unique_{table}_{'_'.join(keys)}", f"SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {present} "
                                                            f"GROUP BY {', '.join(keys)} HAVING count(*) > 1)"))
    return out


@register("v9c_declared_constraints", Q.with_(*Q.SOURCES_CLEAN, Q.WAREHOUSE, Q.WEATHER_RAW, Q.WEATHER_CLEAN, f"dim_weather AS ({_WEATHER_DIM})")
          + "\nUNION ALL\n".join(_check_sql(n, q) for n, q in _constraint_sql()))
def v9c(spark, sf):
    """All 12 NOT NULL, 7 UNIQUE and 16 foreign-key constraints, and the facts without a status."""
    from runway.plans import job
    return job.constraint_checks(_tables(spark, sf))


# =============================================================== 2.1 sources and sinks

def _scratch(spark, name: str) -> str:
    from runway.session import shared_path
    return shared_path(spark, name)


@register("s2_csv_files_header_check", """
SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')""")
def s2(spark, sf):
    """Three CSV folders: reordered columns with an extra one, the plain layout, and one missing a column."""
    from runway.sources import readers
    o = _t(spark, sf, "orders")["orders"]
    root = _scratch(spark, "s2-csv")
    w = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    (o.where("o_orderstatus = 'F'").select("o_orderpriority", "o_orderkey", F.lit("x").alias("note"), "o_custkey",
                                           "o_orderstatus", "o_totalprice", "o_orderdate")
     .write.options(**w).csv(f"{root}/a"))
    o.where("o_orderstatus = 'O'").write.options(**w).csv(f"{root}/b")
    o.where("o_orderstatus = 'P'").drop("o_orderpriority").write.options(**w).csv(f"{root}/c")
    return readers.read_csv_files(spark, [f"{root}/a", f"{root}/b", f"{root}/c", f"{root}/missing"],
                                  ORDER_COLS, o.schema, on_error="skip")


@register("s3_csv_maintenance_skip", Q.with_(Q.MAINTENANCE_RAW.replace("FROM part)", "FROM part WHERE p_type <> 'SMALL')")) +
          "SELECT * REPLACE (nullif(cost, 'n/a') AS cost) FROM maintenance_raw")
def s3(spark, sf):
    from runway import schemas as S
    from runway.sources import readers
    p = _t(spark, sf, "part")["part"]
    root = _scratch(spark, "s3-csv")
    w = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    tpch.maintenance({"part": p.where("p_type <> 'SMALL'")}).write.options(**w).csv(f"{root}/good")
    tpch.maintenance({"part": p.where("p_type = 'SMALL'")}).drop("cost").write.options(**w).csv(f"{root}/bad")
    return readers.read_csv_files(spark, [f"{root}/good", f"{root}/bad"], [f.name for f in S.MAINTENANCE.fields],
                                  S.MAINTENANCE, on_error="skip")


@register("s4_json_logs", Q.with_(Q.LOGS_RAW) + "SELECT * FROM logs_raw")
def s4(spark, sf):
    from runway import schemas as S
    from runway.sources import readers
    path = _scratch(spark, "s4-json")
    tpch.server_logs(_t(spark, sf, "events")).write.json(path)
    return readers.read_json(spark, [path], S.LOGS, json_array=False)


@register("s5_json_weather", Q.with_(Q.WEATHER_RAW) + "SELECT * FROM weather_raw")
def s5(spark, sf):
    from runway import schemas as S
    from runway.sources import readers
    path = _scratch(spark, "s5-json")
    tpch.weather(_t(spark, sf, "events")).write.json(path)
    return readers.read_json(spark, [path], S.WEATHER, json_array=False)


@register("s6_column_set_validation", "SELECT * FROM orders")
def s6(spark, sf):
    from runway.sources import readers
    o = _t(spark, sf, "orders")["orders"]
    return readers.select_expected(o.withColumn("extra_col", F.lit(1)), ORDER_COLS)


@register("s9_parquet_roundtrip", "SELECT * FROM lineitem")
def s9(spark, sf):
    from runway.sources import sinks
    path = _scratch(spark, "s9-parquet")
    li = _t(spark, sf, "lineitem")["lineitem"]
    sinks.write_parquet(li, path, partition_by=["l_returnflag"])
    return spark.read.parquet(path).select(li.columns)


@register("s10_reject_sink", Q.with_(Q.BOOKINGS_RAW) + f"""
SELECT *, {Q.null_count_sql(Q.BOOKING_COLS)} AS null_count FROM bookings_raw
WHERE {Q.null_count_sql(Q.BOOKING_COLS)} > 2""")
def s10(spark, sf):
    from runway.sources import sinks
    _, bad = cleaning.split_bad_rows(tpch.bookings(_t(spark, sf, "orders", "customer")))
    path = _scratch(spark, "s10-rejects")
    sinks.write_rejects(bad, path)
    return spark.read.parquet(path)


@register("s12_full_refresh", f"""
SELECT o_custkey, count(*) AS orders, {Q.dec('sum(o_totalprice)', 18, 2)} AS total FROM orders GROUP BY o_custkey""")
def s12(spark, sf):
    from runway.sources import sinks
    t = _t(spark, sf, "orders", "customer")
    path = _scratch(spark, "s12-table")
    sinks.overwrite_table(t["customer"].select(F.col("c_custkey").alias("o_custkey")), path)
    agg = t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"),
                                               F.sum("o_totalprice").cast("decimal(18,2)").alias("total"))
    sinks.overwrite_table(agg, path)
    return spark.read.parquet(path)


@register("s13_sql_scan", """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_totalprice) AS DECIMAL(18,2)) AS total
FROM orders GROUP BY o_orderstatus""")
def s13(spark, sf):
    from runway.sources import readers
    o = _t(spark, sf, "orders")["orders"]
    return readers.sql(spark, "SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) "
                              "AS DECIMAL(18,2)) AS total FROM {orders} GROUP BY o_orderstatus", orders=o)


def _record_sql(source: str) -> str:
    """Every row of a source as one text, cells in schema order; in the raw zone CSV's missing texts are NULL."""
    from runway import schemas as S
    from pyspark.sql import types as T
    cells = []
    for f in S.SOURCE_SCHEMAS[source].fields:
        c = f'"{f.name}"'
        if isinstance(f.dataType, T.DoubleType):
            c = Q.dec(c, 18, 3)
        elif source == "maintenance":
            c = f"nullif({c}, 'n/a')"
        cells.append(f"coalesce(CAST({c} AS VARCHAR), '~')")
    return f"SELECT '{source}' AS source, concat_ws('|', {', '.join(cells)}) AS record FROM {source}_raw"


def _record(df: DataFrame, source: str) -> DataFrame:
    from runway import schemas as S
    cells = [F.col(f.name).cast("decimal(18,3)") if f.dataType.typeName() == "double" else F.col(f.name) for f in S.SOURCE_SCHEMAS[source].fields]
    return df.select(F.lit(source).alias("source"), F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in cells]).alias("record"))


_READ = ("flights", "maintenance", "logs", "weather")


@register("s8_extract_sources", Q.with_(Q.FLIGHTS_RAW, Q.MAINTENANCE_RAW, Q.LOGS_RAW, Q.WEATHER_RAW)
          + "\nUNION ALL\n".join(map(_record_sql, _READ)))
def s8(spark, sf):
    """S7/S8 + extract: files of four sources, the bookings source switched off; all rows of the raw zone."""
    from runway.plans import job
    t = _t(spark, sf, "orders", "lineitem", "part", "events")
    root = _scratch(spark, "s8-extract")
    w = {"header": True, "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
         "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    tpch.flights_report(t).write.options(**w).csv(f"{root}/in/flights")
    tpch.maintenance(t).write.options(**w).csv(f"{root}/in/maintenance")
    tpch.server_logs(t).write.json(f"{root}/in/logs")
    tpch.weather(t).write.json(f"{root}/in/weather")
    config = {"sources": {
        "bookings": {"enabled": False, "format": "jdbc"},
        "flights": {"enabled": True, "format": "csv", "files": [f"{root}/in/flights", f"{root}/in/absent.csv"]},
        "maintenance": {"enabled": True, "format": "csv", "files": [f"{root}/in/maintenance"]},
        "logs": {"enabled": True, "format": "json", "files": [f"{root}/in/logs"], "json_array": False},
        "weather": {"enabled": True, "format": "json", "files": [f"{root}/in/weather"], "json_array": False}},
        "processing": {"on_validation_error": "skip"}}
    raw = job.extract_raw(spark, config, root)
    if not raw["bookings"].isEmpty():
        raise AssertionError("a disabled source must be empty")
    return dedupe.union_by_name([_record(raw[n], n) for n in _READ])


@register("f2_f5_dashboard_filters", W() + """
SELECT booking_id, booking_ref, ticket_price FROM bookings_view
WHERE departure_airport IN ('SVO', 'LED', 'DME') AND arrival_airport IN ('LED', 'KZN', 'SVX', 'OVB', 'AER')
  AND status IN ('confirmed') AND ticket_price BETWEEN 50000 AND 300000
  AND (aircraft_type IN ('AUTOMOBILE', 'BUILDING') OR aircraft_type IS NULL)
  AND booking_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""")
def f2_f5(spark, sf):
    v = _bv(spark, sf)
    out = filters.booking_filters(v, departures=["SVO", "LED", "DME"], arrivals=["LED", "KZN", "SVX", "OVB", "AER"],
                                  statuses=["confirmed"], aircraft=["AUTOMOBILE", "BUILDING"],
                                  price_range=(50000, 300000), date_range_=("1996-01-01", "1999-12-31"))
    return out.select("booking_id", "booking_ref", "ticket_price")


@register("s5_json_array_weather", Q.with_(Q.WEATHER_RAW) + "SELECT * FROM weather_raw")
def s5_array(spark, sf):
    from runway import schemas as S
    from runway.sources import readers, sinks
    path = _scratch(spark, "s5-json-array")
    sinks.write_json_array(tpch.weather(_t(spark, sf, "events")), path)
    return readers.read_json(spark, [path], S.WEATHER, json_array=True)


# =============================================================== files as they come

@register("s2_csv_time_forms", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS TIMESTAMP) + to_hours(CAST(l_linenumber AS BIGINT)) + INTERVAL 30 MINUTE AS at
FROM lineitem""")
def s2_times(spark, sf):
    """Times of four written forms in one CSV column, with and without seconds and fractions."""
    from pyspark.sql import types as T

    from runway.sources import readers
    li = _t(spark, sf, "lineitem")["lineitem"]
    at = (F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("l_linenumber"), mins=F.lit(30)))
    forms = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd HH:mm:ss.SSS", "dd.MM.yyyy HH:mm"]
    text = F.element_at(F.array(*[F.date_format(at, f) for f in forms]), (F.col("l_orderkey") % 4 + 1).cast("int"))
    root = _scratch(spark, "s2-times")
    li.select("l_orderkey", "l_linenumber", text.alias("at")).write.option("header", True).csv(root)
    schema = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.LongType()),
                           T.StructField("at", T.TimestampNTZType())])
    return readers.read_csv_files(spark, [root], schema.names, schema)


@register("s3_csv_quoted_text", """
SELECT p_partkey, concat('say "', p_name, '", then', chr(10), p_type) AS note, CASE WHEN p_size % 4 <> 0 THEN p_size END AS p_size
FROM part""")
def s3_quoted(spark, sf):
    """Quotes, separators and line breaks inside CSV cells, and written-out missing values."""
    from pyspark.sql import types as T

    from runway.sources import readers
    p = _t(spark, sf, "part")["part"]
    root = _scratch(spark, "s3-quoted")
    note = F.concat(F.lit('say "'), "p_name", F.lit('", then\n'), "p_type")
    missing = F.element_at(F.array(*[F.lit(x) for x in ("NA", "n/a", "null", "None")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    size = F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("string")).otherwise(missing)
    p.select("p_partkey", note.alias("note"), size.alias("p_size")).write.options(header=True, escape='"', quoteAll=True).csv(root)
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("note", T.StringType()), T.StructField("p_size", T.LongType())])
    return readers.read_csv_files(spark, [root], schema.names, schema)


@register("s4_json_array_logs", Q.with_(Q.LOGS_RAW) + """
SELECT *, concat('host', length(message) % 3) AS host FROM logs_raw""")
def s4_array(spark, sf):
    """Server logs as JSON arrays with a field that is not declared."""
    from runway import schemas as S
    from runway.sources import readers, sinks
    path = _scratch(spark, "s4-json-array")
    logs = tpch.server_logs(_t(spark, sf, "events"))
    sinks.write_json_array(logs.withColumn("host", F.concat(F.lit("host"), F.length("message") % 3)), path)
    return readers.read_json(spark, [path], S.LOGS, json_array=True)


@register("s5_json_bad_cell", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value, event_type FROM events""")
def s5_bad(spark, sf):
    """One cell of another type in many records of JSON arrays, and lines that are no JSON beside them."""
    from pyspark.sql import types as T

    from runway.sources import readers
    e = _t(spark, sf, "events")["events"]
    path = _scratch(spark, "s5-bad")
    value = F.when(F.col("event_type") != "error", F.col("value").cast("string")).otherwise(F.lit('"n/a"'))
    record = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "value": '), F.coalesce(value, F.lit("null")),
                      F.lit(', "event_type": "'), "event_type", F.lit('"}'))
    broken = F.when(F.col("event_id") % 50 == 0, F.array(record, F.lit('{"event_id": '))).otherwise(F.array(record))
    e.select(F.explode(broken).alias("value")).write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("event_type", T.StringType())])
    rows, rejects = readers.read_json_parts(spark, [path], schema, json_array=False)
    if rejects.count() != e.where("event_id % 50 = 0").count():
        raise AssertionError("rows in must be rows out plus rejects")
    return rows


@register("a3_outliers_with_inf", """
WITH v AS (SELECT CASE WHEN l_linenumber = 7 AND l_quantity > 49 THEN 'infinity'::DOUBLE ELSE CAST(l_extendedprice AS DOUBLE) END AS price FROM lineitem),
q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS q2, quantile_cont(price, 0.75) AS q3, max(price) AS hi FROM v)
SELECT 'price' AS "column", (SELECT count(*) FROM v WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)) AS "count",
       round(q1 - 1.5 * (q3 - q1), 4) AS lower_bound, round(q3 + 1.5 * (q3 - q1), 4) AS upper_bound, round(q2, 4) AS median
FROM q""")
def a3_inf(spark, sf):
    li = _t(spark, sf, "lineitem")["lineitem"]
    price = F.when((F.col("l_linenumber") == 7) & (F.col("l_quantity") > 49), F.lit(float("inf"))).otherwise(F.col("l_extendedprice").cast("double"))
    found = stats.detect_outliers(li.select(price.alias("price")), ["price"])
    return found.select("column", "count", *[F.round(c, 4).alias(c) for c in ("lower_bound", "upper_bound", "median")])


@register("n6_time_forms", """
SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 9 HOUR + INTERVAL 5 MINUTE AS at FROM orders""")
def n6_forms(spark, sf):
    o = _t(spark, sf, "orders")["orders"]
    at = F.col("o_orderdate").cast("timestamp_ntz") + F.expr("INTERVAL '09:05' HOUR TO MINUTE")
    forms = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm", "d.M.yyyy H:mm", "MM/dd/yyyy HH:mm:ss", "yyyyMMdd HHmmss", "d MMM yyyy HH:mm", "MMM d, yyyy H:mm"]
    text = F.element_at(F.array(*[F.date_format(at, f) for f in forms]), (F.col("o_orderkey") % len(forms) + 1).cast("int"))
    return o.select("o_orderkey", X.safe_timestamp(text).cast("timestamp_ntz").alias("at"))


@register("s4_json_name_variants", """
SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN event_type END AS event_type, CASE WHEN event_id % 10 = 3 THEN event_type END AS "Event_Type_2",
       CASE WHEN event_id % 7 = 0 THEN CAST(user_id AS VARCHAR) END AS user_id, CASE WHEN event_id % 7 > 0 THEN CAST(user_id AS VARCHAR) END AS "the user"
FROM events""")
def s4_names(spark, sf):
    """JSON arrays whose names differ in case only, or hold a backtick or a space."""
    from pyspark.sql import types as T

    from runway.sources import readers, sinks
    path = _scratch(spark, "s4-names")
    n = F.col("event_id")
    fields = lambda kind, user: F.to_json(F.struct("event_id", F.col("event_type").alias(kind), F.col("user_id").alias(user)))
    named = lambda user: F.when(n % 10 == 3, fields("Event_Type", user)).otherwise(fields("event_type", user))
    text = F.when(n % 7 == 0, named("user`id")).otherwise(named("the user"))
    lines = _t(spark, sf, "events")["events"].select(text.alias("value"))
    lines.mapInPandas(sinks._as_array_lines, "value string").write.text(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    rows, rejects = readers.read_json_parts(spark, [path], schema)
    if not rejects.isEmpty():
        raise AssertionError("no record may be rejected")
    return rows


def _with_blank_lines(header: str):
    """Every file begins with blank lines and its header, and every record is followed by a blank line."""
    def run(batches):
        import pandas as pd
        yield pd.DataFrame({"value": ["", "  ", header]})
        for pdf in batches:
            yield pd.DataFrame({"value": [x for v in pdf["value"] for x in (v, "")]})
    return run


@register("s2_csv_blank_lines", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN concat('two', chr(10), chr(10), 'lines, "', o_orderpriority, '"') ELSE o_orderpriority END AS note
FROM orders""")
def s2_blank(spark, sf):
    """Blank lines before the header, between records and within quoted cells."""
    from pyspark.sql import types as T

    from runway.sources import readers
    o = _t(spark, sf, "orders")["orders"]
    root = _scratch(spark, "s2-blank")
    quoted = F.concat(F.lit('"two\n\nlines, ""'), "o_orderpriority", F.lit('"""'))
    note = F.when(F.col("o_orderkey") % 3 == 0, quoted).otherwise(F.col("o_orderpriority"))
    lines = o.select(F.concat(F.col("o_orderkey").cast("string"), F.lit(","), note).alias("value"))
    lines.mapInPandas(_with_blank_lines("o_orderkey,note"), "value string").write.text(root)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("note", T.StringType())])
    return readers.read_csv_files(spark, [root], schema.names, schema)


@register("a4_median_large_longs", """
WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN 9007199254740993 + 2 * o_orderkey END AS big FROM orders),
r AS (SELECT big, row_number() OVER (ORDER BY big) AS i, count(*) OVER () AS n FROM v WHERE big IS NOT NULL),
m AS (SELECT CAST((min(big) + max(big)) // 2 AS BIGINT) AS big FROM r WHERE i IN ((n + 1) // 2, n // 2 + 1))
SELECT o_orderkey, CAST(coalesce(v.big, m.big) AS BIGINT) AS big FROM v, m""")
def a4_large(spark, sf):
    """Integers beyond 2**53, which no double tells apart, filled with their exact median."""
    o = _t(spark, sf, "orders")["orders"]
    big = F.when(F.col("o_orderkey") % 5 != 0, F.lit(9007199254740993).cast("long") + 2 * F.col("o_orderkey"))
    filled, _ = stats.smart_fill(o.select("o_orderkey", big.alias("big")), exclude={"o_orderkey"})
    return filled.select("o_orderkey", "big")
