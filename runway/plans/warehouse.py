"""Warehouse loads: dimensions by keyed merge, facts by full refresh.

Functions here are pure: they take the cleaned sources and the current
tables and return the new table images.  ``Warehouse`` stores them as
parquet below one root with a staged overwrite.

Join strategy: no dimension carries a broadcast hint.  The planner broadcasts
one only when its measured size is below ``autoBroadcastJoinThreshold``, and
AQE re-plans from the actual shuffle sizes; beyond the limit it is a shuffle
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway import schemas as S
from runway.functions import expr as X
from runway.operators import dedupe
from runway.operators.keys import assign_keys
from runway.operators.merge import insert_missing, upsert, upsert_on_key
from runway.plans.stages import in_parallel
from runway.sources import sinks

# ------------------------------------------------------------------ dimensions


def airport_source(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M6 input: every airport code seen in either source (D3 + D4 + F9)."""
    codes = dedupe.union_distinct([(bookings, "departure_airport"), (bookings, "arrival_airport"),
                                   (flights, "departure"), (flights, "arrival")], "airport_code")
    return codes.select("airport_code", F.col("airport_code").alias("airport_name"),
                        F.col("airport_code").alias("city"), F.lit(S.AIRPORT_COUNTRY).alias("country"))


def load_dim_airports(target: DataFrame, bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M6 = M1 on airport_code."""
    return upsert(target, airport_source(bookings, flights), ["airport_code"], "airport_id")


def aircraft_source(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M7 input: aircraft type names and aircraft ids both become codes."""
    codes = dedupe.union_distinct([(bookings, "aircraft_type"), (flights, "aircraft_id")], "aircraft_code")
    return codes.select("aircraft_code", F.col("aircraft_code").alias("aircraft_type"),
                        F.lit(S.AIRCRAFT_CAPACITY).alias("capacity"),
                        F.lit(S.AIRCRAFT_MANUFACTURER).alias("manufacturer"))


def load_dim_aircraft(target: DataFrame, bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M7 = M1 on aircraft_code."""
    return upsert(target, aircraft_source(bookings, flights), ["aircraft_code"], "aircraft_id")


def date_source(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M8 input: the calendar row of every date in three date columns."""
    days = dedupe.union_distinct([
        (bookings.select(X.to_date("departure_time").alias("d")), "d"),
        (bookings.select(X.to_date("booking_date").alias("d")), "d"),
        (flights.select(X.to_date("flight_date").alias("d")), "d"),
    ], "d")
    return days.select(*[c.alias(n) for n, c in X.calendar_columns("d").items()])


def load_dim_dates(target: DataFrame, bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M8 = M2: upsert on date_id (the key is the natural key, no numbering)."""
    return upsert_on_key(target, date_source(bookings, flights), ["date_id"])


def load_dim_passengers(target: DataFrame, bookings: DataFrame) -> DataFrame:
    """M9 = M3: new names only."""
    names = dedupe.distinct_values(bookings, "passenger_name")
    return insert_missing(target, names, ["passenger_name"], "passenger_id")


def route_source(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """M10 input: one row per (flight_number, dep, arr), bookings before flights (D2 + D6).

    Within a source the first row is the one with the smallest ordering
    columns: booking ``id``; for the report, date, scheduled time, aircraft.
    """
    def order(id_, day, time, code):
        return F.struct(id_.cast("long").alias("id"), day.cast("date").alias("day"),
                        time.cast("timestamp_ntz").alias("time"), code.cast("string").alias("code")).alias("_ord")

    none = F.lit(None)
    b = bookings.select("flight_number", F.col("departure_airport"), F.col("arrival_airport"),
                        F.col("aircraft_type").alias("aircraft_code"), F.lit(0).alias("_src"),
                        order(F.col("id"), none, none, none))
    f = flights.select("flight_number", F.col("departure").alias("departure_airport"),
                       F.col("arrival").alias("arrival_airport"), F.col("aircraft_id").alias("aircraft_code"),
                       F.lit(1).alias("_src"),
                       order(none, F.col("flight_date"), F.col("scheduled_departure"), F.col("aircraft_id")))
    both = dedupe.union_by_name([b, f])
    first = dedupe.first_per_key(both, ["flight_number", "departure_airport", "arrival_airport"], ["_src", "_ord"])
    return first.drop("_src", "_ord")


def resolve_route_keys(routes: DataFrame, airports: DataFrame, aircraft: DataFrame) -> DataFrame:
    """J1 lookups of a route's airports and aircraft (misses give NULL)."""
    dep = airports.select(F.col("airport_code").alias("departure_airport"),
                          F.col("airport_id").alias("departure_airport_id"))
    arr = airports.select(F.col("airport_code").alias("arrival_airport"),
                          F.col("airport_id").alias("arrival_airport_id"))
    ac = aircraft.select("aircraft_code", "aircraft_id")
    return (routes.join(dep, "departure_airport", "left").join(arr, "arrival_airport", "left")
            .join(ac, "aircraft_code", "left"))


def load_dim_flights(target: DataFrame, bookings: DataFrame, flights: DataFrame,
                     airports: DataFrame, aircraft: DataFrame) -> DataFrame:
    """M10 = M4: upsert on (flight_number, dep id, arr id) with NULL-safe equality; only aircraft_id updates."""
    src = resolve_route_keys(route_source(bookings, flights), airports, aircraft).select(
        "flight_number", "departure_airport_id", "arrival_airport_id", "aircraft_id",
        F.lit(None).cast("int").alias("scheduled_duration_minutes"))
    return upsert(target, src, ["flight_number", "departure_airport_id", "arrival_airport_id"],
                  "flight_id", update_cols=["aircraft_id"], null_safe=True)


def route_codes(dim_flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Routes with both airports resolved to codes (role-playing dimension, inner joins)."""
    dep = airports.select(F.col("airport_id").alias("departure_airport_id"), F.col("airport_code").alias("dep_code"))
    arr = airports.select(F.col("airport_id").alias("arrival_airport_id"), F.col("airport_code").alias("arr_code"))
    return (dim_flights.join(dep, "departure_airport_id").join(arr, "arrival_airport_id")
            .select("flight_id", "flight_number", "dep_code", "arr_code"))


def statuses_for(statuses: DataFrame, category: str) -> DataFrame:
    """F8: the status rows of one category."""
    return statuses.where(F.col("category") == category).select("status_id", "status_code")


def load_weather_dim(target: DataFrame, weather: DataFrame, airports: DataFrame) -> DataFrame:
    """Weather observations keyed by (airport_id, observation_time)."""
    src = (weather.join(airports.select(F.col("airport_code"), "airport_id"), "airport_code", "left")
           .select("airport_id", F.col("timestamp").cast("timestamp").alias("observation_time"),
                   F.col("temperature").try_cast("decimal(5,2)").alias("temperature"),
                   F.col("humidity").cast("int").alias("humidity"),
                   F.col("wind_speed").try_cast("decimal(5,2)").alias("wind_speed"),
                   F.col("visibility").cast("int").alias("visibility"), "conditions"))
    src = dedupe.first_per_key(src, ["airport_id", "observation_time"],
                               ["temperature", "humidity", "wind_speed", "visibility", "conditions"])
    return upsert(target, src, ["airport_id", "observation_time"], "weather_id", null_safe=True)


# ------------------------------------------------------------------ facts


def build_fact_bookings(bookings: DataFrame, passengers: DataFrame, dim_flights: DataFrame,
                        airports: DataFrame, dates: DataFrame, statuses: DataFrame) -> DataFrame:
    """J1 x3 + J2, keys numbered in booking id order."""
    routes = route_codes(dim_flights, airports).select(
        "flight_id", "flight_number", F.col("dep_code").alias("departure_airport"),
        F.col("arr_code").alias("arrival_airport"))
    day = dates.select(F.col("full_date").alias("_day"), F.col("date_id").alias("booking_date_id"))
    st = statuses_for(statuses, "booking").withColumnRenamed("status_code", "status")
    j = (bookings.join(passengers.select("passenger_name", "passenger_id"), "passenger_name", "left")
         .join(routes, ["flight_number", "departure_airport", "arrival_airport"], "left")
         .withColumn("_day", X.to_date("booking_date"))
         .join(day, "_day", "left")
         .join(st, "status", "left"))
    facts = j.select("id", "booking_ref", "passenger_id", "flight_id", "booking_date_id", "status_id",
                     F.col("ticket_price").cast("decimal(10,2)").alias("ticket_price"), "currency")
    return assign_keys(facts, ["id"], "booking_id").drop("id").select(
        "booking_id", "booking_ref", "passenger_id", "flight_id", "booking_date_id", "status_id",
        "ticket_price", "currency")


FACT_FLIGHT_COLUMNS = ["flight_instance_id", "flight_id", "flight_date_id", "status_id",
                       "scheduled_departure_time", "scheduled_arrival_time", "actual_departure_time",
                       "actual_arrival_time", "delay_minutes"]


def build_fact_flights(flights: DataFrame, dim_flights: DataFrame, airports: DataFrame,
                       dates: DataFrame, statuses: DataFrame) -> DataFrame:
    """J1 x2 + J2 + N11, keys numbered in (date, flight, times) order."""
    routes = route_codes(dim_flights, airports).select(
        "flight_id", "flight_number", F.col("dep_code").alias("departure"), F.col("arr_code").alias("arrival"))
    day = dates.select(F.col("full_date").alias("_day"), F.col("date_id").alias("flight_date_id"))
    st = statuses_for(statuses, "flight").withColumnRenamed("status_code", "status")
    j = (flights.join(routes, ["flight_number", "departure", "arrival"], "left")
         .withColumn("_day", X.to_date("flight_date"))
         .join(day, "_day", "left")
         .join(st, "status", "left"))
    facts = j.select(
        "flight_id", "flight_date_id", "status_id",
        F.col("scheduled_departure").alias("scheduled_departure_time"),
        F.col("scheduled_arrival").alias("scheduled_arrival_time"),
        F.col("actual_departure").alias("actual_departure_time"),
        F.col("actual_arrival").alias("actual_arrival_time"),
        X.delay_minutes("scheduled_departure", "actual_departure").alias("delay_minutes"),
        "flight_number", "aircraft_id")
    order = ["flight_date_id", "flight_number", "scheduled_departure_time", "scheduled_arrival_time",
             "actual_departure_time", "actual_arrival_time", "aircraft_id", "flight_id", "status_id"]
    return assign_keys(facts, order, "flight_instance_id").select(FACT_FLIGHT_COLUMNS)


def revenue_aggregate(fact_bookings: DataFrame, statuses: DataFrame,
                      codes: tuple[str, ...] | None = ("confirmed", "completed")) -> DataFrame:
    """Revenue per (flight, booking date) over the given statuses (all when ``None``)."""
    st = statuses.select("status_id", "status_code")
    j = fact_bookings.join(st, "status_id")
    if codes is not None:
        j = j.where(F.col("status_code").isin(list(codes)))
    price = F.col("ticket_price")
    return (j.groupBy("flight_id", F.col("booking_date_id").alias("date_id"))
            .agg(F.sum(price).cast("decimal(15,2)").alias("total_revenue"),
                 F.count("booking_id").alias("passenger_count"),
                 F.avg(price).cast("decimal(10,2)").alias("avg_ticket_price"),
                 F.count_if(F.col("status_code") == "confirmed").alias("confirmed_count"),
                 F.count_if(F.col("status_code") == "cancelled").alias("cancelled_count")))


def build_fact_revenue(fact_bookings: DataFrame, statuses: DataFrame, all_statuses: bool = False) -> DataFrame:
    """A7, keys numbered by (flight_id, date_id)."""
    agg = revenue_aggregate(fact_bookings, statuses, None if all_statuses else ("confirmed", "completed"))
    return assign_keys(agg, ["flight_id", "date_id"], "revenue_id").select(
        "revenue_id", "flight_id", "date_id", "total_revenue", "passenger_count", "avg_ticket_price",
        "confirmed_count", "cancelled_count")


def build_fact_maintenance(maintenance: DataFrame, aircraft: DataFrame, mtypes: DataFrame,
                           statuses: DataFrame) -> DataFrame:
    """J1 x3, keys numbered by (scheduled date, aircraft, type, description)."""
    st = statuses_for(statuses, "maintenance").withColumnRenamed("status_code", "status")
    mt = mtypes.select(F.col("type_code").alias("maintenance_type"), "maintenance_type_id")
    j = (maintenance.join(aircraft.select("aircraft_code", "aircraft_id"), "aircraft_code", "left")
         .join(mt, "maintenance_type", "left").join(st, "status", "left"))
    facts = j.select("aircraft_id", "maintenance_type_id", "status_id", "scheduled_date", "completed_date",
                     F.col("cost").try_cast("decimal(12,2)").alias("cost"),
                     F.coalesce(F.col("description"), F.lit("")).alias("description"))
    order = ["scheduled_date", "aircraft_id", "maintenance_type_id", "status_id", "completed_date",
             "cost", "description"]
    return assign_keys(facts, order, "maintenance_id").select(
        "maintenance_id", "aircraft_id", "maintenance_type_id", "status_id", "scheduled_date",
        "completed_date", "cost", "description")


# ------------------------------------------------------------------ storage


class Warehouse:
    """Warehouse tables as parquet directories below ``root``."""

    TABLES = {
        "dim_airports": S.DIM_AIRPORTS, "dim_aircraft": S.DIM_AIRCRAFT, "dim_dates": S.DIM_DATES,
        "dim_passengers": S.DIM_PASSENGERS, "dim_flights": S.DIM_FLIGHTS, "dim_weather": S.DIM_WEATHER,
        "dim_statuses": S.DIM_STATUSES, "dim_maintenance_types": S.DIM_MAINTENANCE_TYPES,
    }

    # Fact -> (date key, surrogate key) for the date-partitioned layout.
    FACT_LAYOUT = {
        "fact_bookings": ("booking_date_id", "booking_id"),
        "fact_flights": ("flight_date_id", "flight_instance_id"),
        "fact_revenue": ("date_id", "revenue_id"),
    }

    def __init__(self, spark: SparkSession, root: str, partition_facts: bool = False):
        """``partition_facts`` writes the facts in one folder per date key: date filters then prune
        files, and joins through ``dim_dates`` get dynamic partition pruning.  Rows are first
        range-partitioned on (date key, surrogate key), so one date's rows may be written by several
        tasks and a hot date is not one task's work."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_facts = partition_facts
        self._schemas: dict = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        if name in self.TABLES:
            return sinks.read_table(self.spark, self.path(name), self.TABLES[name])
        if name in self._schemas:
            return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def save(self, name: str, df: DataFrame) -> DataFrame:
        if self.partition_facts and name in self.FACT_LAYOUT:
            date_key, key = self.FACT_LAYOUT[name]
            laid_out = df.repartitionByRange(F.col(date_key), F.col(key))
            sinks.overwrite_table(laid_out, self.path(name), partition_by=[date_key])
        else:
            sinks.overwrite_table(df, self.path(name))
        self._schemas[name] = df.schema
        return self.table(name)

    def seed(self) -> None:
        """Reference dimensions, written once."""
        if not sinks.table_exists(self.spark, self.path("dim_statuses")):
            self.save("dim_statuses", S.status_dim(self.spark))
        if not sinks.table_exists(self.spark, self.path("dim_maintenance_types")):
            self.save("dim_maintenance_types", S.maintenance_type_dim(self.spark))

    def load(self, bookings: DataFrame, flights: DataFrame, maintenance: DataFrame,
             weather: DataFrame | None = None, workers: int = 5) -> dict[str, DataFrame]:
        """Dimensions first (facts read their keys), then facts (full refresh).

        Loads that do not depend on each other run concurrently, in three waves: the first-level
        dimensions; then routes, weather and the maintenance fact (which needs only aircraft and the
        seeded dimensions); then the bookings fact, followed in its own thread by the revenue fact
        it feeds, next to the flights fact.
        """
        self.seed()
        t = self.table
        statuses, mtypes = t("dim_statuses"), t("dim_maintenance_types")
        dims = in_parallel({
            "dim_airports": lambda: self.save("dim_airports", load_dim_airports(t("dim_airports"), bookings, flights)),
            "dim_aircraft": lambda: self.save("dim_aircraft", load_dim_aircraft(t("dim_aircraft"), bookings, flights)),
            "dim_dates": lambda: self.save("dim_dates", load_dim_dates(t("dim_dates"), bookings, flights)),
            "dim_passengers": lambda: self.save("dim_passengers", load_dim_passengers(t("dim_passengers"), bookings)),
        }, workers)
        airports, aircraft, dates, passengers = (dims[n] for n in
                                                 ("dim_airports", "dim_aircraft", "dim_dates", "dim_passengers"))
        wave2 = {
            "dim_flights": lambda: self.save("dim_flights", load_dim_flights(
                t("dim_flights"), bookings, flights, airports, aircraft)),
            "fact_maintenance": lambda: self.save("fact_maintenance", build_fact_maintenance(
                maintenance, aircraft, mtypes, statuses)),
        }
        if weather is not None:
            wave2["dim_weather"] = lambda: self.save("dim_weather", load_weather_dim(t("dim_weather"), weather, airports))
        routes = in_parallel(wave2, workers)["dim_flights"]

        def bookings_and_revenue():
            fb = self.save("fact_bookings", build_fact_bookings(bookings, passengers, routes, airports, dates, statuses))
            self.save("fact_revenue", build_fact_revenue(fb, statuses))

        in_parallel({
            "fact_bookings": bookings_and_revenue,
            "fact_flights": lambda: self.save("fact_flights", build_fact_flights(
                flights, routes, airports, dates, statuses)),
        }, workers)
        return {n: self.table(n) for n in
                list(self.TABLES) + ["fact_bookings", "fact_flights", "fact_revenue", "fact_maintenance"]}
