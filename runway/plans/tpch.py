"""Airline-shaped sources derived from the driver's TPC-H-style tables.

The driver's tables hold no airline data, so the job's five sources are
derived from them with column expressions and joins (role mapping of
SURVEY 7.5): orders x customer -> bookings, lineitem x orders -> flights
report, part -> maintenance, events -> server logs and weather.  The
derivation adds the kinds of dirt the real sources have (case and space
variants, airport names in place of codes, NULLs, repeated rows, text that
does not parse), each decided by data values, so every row of every table
is used and the work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runway.functions.expr import AIRPORT_CODES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

# (code, name) of each airport of the lookup table, in its order: a name is the first key of its code.
AIRPORT_INDEX = list({code: name for name, code in reversed(AIRPORT_CODES.items())}.items())[::-1]


def load_tables(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in (names or TABLES)}


def _code(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c, _ in AIRPORT_INDEX]), (idx + 1).cast("int"))


def _name(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for _, n in AIRPORT_INDEX]), (idx + 1).cast("int"))


def _route(custkey: Column) -> tuple[Column, Column, Column]:
    """Flight number and airport indexes of a customer's route."""
    num = (F.lit(100) + custkey % 50).cast("string")
    dep = custkey % 10
    arr = (custkey % 10 + 1 + custkey % 7) % 10
    return num, dep, arr


def bookings(t: dict[str, DataFrame]) -> DataFrame:
    """Bookings: one per order (orders x customer), some repeated with a new id."""
    o, c = t["orders"], t["customer"]
    j = o.join(c.select("c_custkey", "c_name", "c_mktsegment"), o.o_custkey == c.c_custkey)
    num, dep, arr = _route(F.col("o_custkey"))
    bad = (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P")
    copies = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"),
                    F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    j = j.select("*", F.explode(copies).alias("_copy"))
    copy = F.col("_copy")
    flight = (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("su "), num))
              .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("SU "), num))
              .otherwise(F.concat(F.lit("SU"), num)))
    dep_text = (F.when(F.col("o_orderstatus") == "F", _code(dep))
                .when(F.col("o_orderstatus") == "O", _name(dep))
                .otherwise(F.concat(F.lit(" "), F.lower(_code(dep)), F.lit(" "))))
    departure_time = F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")
    return j.select(
        (F.col("o_orderkey") + copy * F.lit(1_000_000_000_000)).alias("id"),
        F.concat(F.lit("BK"), F.col("o_orderkey").cast("string")).alias("booking_ref"),
        F.when(~bad, F.col("c_name")).alias("passenger_name"),
        F.when(~bad, flight).alias("flight_number"),
        F.when(~bad, dep_text).alias("departure_airport"),
        _code(arr).alias("arrival_airport"),
        departure_time.alias("departure_time"),
        (departure_time + F.expr("INTERVAL 2 HOURS")).alias("arrival_time"),
        F.col("c_mktsegment").alias("aircraft_type"),
        F.when(~((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")),
               F.col("o_totalprice")).alias("ticket_price"),
        F.when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("rub")).otherwise(F.lit("RUB")).alias("currency"),
        F.col("o_orderdate").alias("booking_date"),
        F.when(F.col("o_orderstatus") == "F", F.lit("confirmed"))
        .when(F.col("o_orderstatus") == "O", F.lit("CONFIRMED "))
        .otherwise(F.lit("cancelled")).alias("status"),
    )


def flights_report(t: dict[str, DataFrame]) -> DataFrame:
    """Flights report: one row per line item (lineitem x orders)."""
    li, o = t["lineitem"], t["orders"]
    j = li.join(o.select("o_orderkey", "o_custkey", "o_orderdate"), li.l_orderkey == o.o_orderkey)
    num, dep, arr = _route(F.col("o_custkey"))
    sched_dep = F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")
    sched_arr = sched_dep + F.expr("INTERVAL 2 HOURS")
    flown = F.col("l_linestatus") == "F"
    late = (F.col("l_quantity") - 10).cast("int")
    return j.select(
        F.to_date(sched_dep).alias("flight_date"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("su "), num))
        .otherwise(F.concat(F.lit("SU"), num)).alias("flight_number"),
        F.when(F.col("l_returnflag") == "A", _name(dep)).otherwise(_code(dep)).alias("departure"),
        _code(arr).alias("arrival"),
        sched_dep.alias("scheduled_departure"),
        sched_arr.alias("scheduled_arrival"),
        F.when(flown, F.timestamp_add("MINUTE", late, sched_dep)).alias("actual_departure"),
        F.when(flown, F.timestamp_add("MINUTE", late + F.col("l_linenumber"), sched_arr)).alias("actual_arrival"),
        F.when(flown, F.lit("landed")).otherwise(F.lit("SCHEDULED")).alias("status"),
        F.concat(F.lit("AC"), (F.col("l_partkey") % 40).cast("string")).alias("aircraft_id"),
    )


def maintenance(t: dict[str, DataFrame]) -> DataFrame:
    """Maintenance report (text columns): one row per part."""
    p = t["part"]
    bad = (F.col("p_brand") == "Brand#2") & (F.col("p_size") % 3 == 1)
    mtype = (F.when(F.col("p_type") == "ECONOMY", F.lit("Technical_Inspection"))
             .when(F.col("p_type") == "STANDARD", F.lit(" fueling"))
             .when(F.col("p_type") == "SMALL", F.lit("REPAIR"))
             .when(F.col("p_type") == "PROMO", F.lit("engine_check"))
             .when(F.col("p_type") == "MEDIUM", F.lit("cabin_check"))
             .otherwise(F.lit("scheduled_maintenance")))
    base = F.lit("2024-01-01").cast("date")
    return p.select(
        F.when(~bad, F.concat(F.lit(" ac"), (F.col("p_partkey") % 40).cast("string"), F.lit(" ")))
        .alias("aircraft_code"),
        F.when(~bad, mtype).alias("maintenance_type"),
        F.when(F.col("p_size") == 50, F.lit("not a date"))
        .otherwise(F.date_add(base, F.col("p_size")).cast("string")).alias("scheduled_date"),
        F.when(F.col("p_size") % 3 == 0, F.date_add(base, F.col("p_size") + 1).cast("string"))
        .alias("completed_date"),
        F.when(F.col("p_size") % 3 == 0, F.lit("completed"))
        .when(F.col("p_size") % 3 == 1, F.lit("Planned")).otherwise(F.lit("in_progress")).alias("status"),
        F.when(F.col("p_brand") == "Brand#1", F.lit("n/a"))
        .otherwise(F.round(F.col("p_retailprice") * 100).cast("long").cast("string")).alias("cost"),
        F.when(~bad & (F.col("p_size") != 1), F.col("p_name")).alias("description"),
    )


def server_logs(t: dict[str, DataFrame]) -> DataFrame:
    """Server logs: one record per event."""
    e = t["events"]
    level = (F.when(F.col("event_type") == "error", F.lit(" error"))
             .when(F.col("event_type") == "view", F.lit("info"))
             .when(F.col("event_type") == "click", F.lit("Debug")).otherwise(F.lit("warning")))
    return e.select(
        F.when((F.col("event_type") == "error") & (F.col("user_id") % 10 == 0), F.lit("garbage"))
        .otherwise(F.col("ts").cast("string")).alias("timestamp"),
        level.alias("level"),
        F.concat(F.lit("su "), (F.lit(100) + F.col("user_id") % 50).cast("string")).alias("flight_number"),
        F.col("props").alias("message"),
    )


def weather(t: dict[str, DataFrame]) -> DataFrame:
    """Weather observations: one per event, ISO time with 'Z'."""
    e = t["events"]
    idx = F.col("user_id") % 10
    return e.select(
        F.when(F.col("user_id") % 3 == 0, _name(idx)).otherwise(F.lower(_code(idx))).alias("airport_code"),
        F.concat(F.regexp_replace(F.col("ts").cast("string"), " ", "T"), F.lit("Z")).alias("timestamp"),
        (F.col("value") - 20.0).alias("temperature"),
        (F.col("user_id") % 100).alias("humidity"),
        (F.col("value") / 2.0).alias("wind_speed"),
        ((F.col("user_id") * 100) % 10000).alias("visibility"),
        F.col("event_type").alias("conditions"),
    )


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = load_tables(spark, sf_dir)
    return {"bookings": bookings(t), "flights": flights_report(t), "maintenance": maintenance(t),
            "logs": server_logs(t), "weather": weather(t)}
