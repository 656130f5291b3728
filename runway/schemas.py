"""Source and warehouse schemas, plus the seeded reference dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------- sources

BOOKINGS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("booking_ref", T.StringType()),
    T.StructField("passenger_name", T.StringType()),
    T.StructField("flight_number", T.StringType()),
    T.StructField("departure_airport", T.StringType()),
    T.StructField("arrival_airport", T.StringType()),
    T.StructField("departure_time", T.TimestampNTZType()),
    T.StructField("arrival_time", T.TimestampNTZType()),
    T.StructField("aircraft_type", T.StringType()),
    # pandas reads DECIMAL prices as float64; cleaning works on doubles and
    # the loaders cast to DECIMAL(10,2), as the warehouse column does.
    T.StructField("ticket_price", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("booking_date", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
])

FLIGHTS_REPORT = T.StructType([
    T.StructField("flight_date", T.DateType()),
    T.StructField("flight_number", T.StringType()),
    T.StructField("departure", T.StringType()),
    T.StructField("arrival", T.StringType()),
    T.StructField("scheduled_departure", T.TimestampNTZType()),
    T.StructField("scheduled_arrival", T.TimestampNTZType()),
    T.StructField("actual_departure", T.TimestampNTZType()),
    T.StructField("actual_arrival", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("aircraft_id", T.StringType()),
])

# Maintenance arrives as text; dates and cost are parsed safely later.
MAINTENANCE = T.StructType([
    T.StructField("aircraft_code", T.StringType()),
    T.StructField("maintenance_type", T.StringType()),
    T.StructField("scheduled_date", T.StringType()),
    T.StructField("completed_date", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("cost", T.StringType()),
    T.StructField("description", T.StringType()),
])

LOGS = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("flight_number", T.StringType()),
    T.StructField("message", T.StringType()),
])

WEATHER = T.StructType([
    T.StructField("airport_code", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("humidity", T.LongType()),
    T.StructField("wind_speed", T.DoubleType()),
    T.StructField("visibility", T.LongType()),
    T.StructField("conditions", T.StringType()),
])

SOURCE_SCHEMAS = {
    "bookings": BOOKINGS,
    "flights": FLIGHTS_REPORT,
    "maintenance": MAINTENANCE,
    "logs": LOGS,
    "weather": WEATHER,
}

# Required columns per source (completeness, final report).
REQUIRED = {
    "bookings": ["booking_ref", "passenger_name", "flight_number", "departure_airport",
                 "arrival_airport", "ticket_price", "status"],
    "flights": ["flight_number", "departure", "arrival", "status"],
    "maintenance": ["aircraft_code", "maintenance_type", "scheduled_date", "status", "cost"],
    "logs": ["timestamp", "level"],
    "weather": ["airport_code", "timestamp"],
}

# ---------------------------------------------------------------- warehouse

DIM_AIRPORTS = T.StructType([
    T.StructField("airport_id", T.LongType()),
    T.StructField("airport_code", T.StringType()),
    T.StructField("airport_name", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
])

DIM_AIRCRAFT = T.StructType([
    T.StructField("aircraft_id", T.LongType()),
    T.StructField("aircraft_code", T.StringType()),
    T.StructField("aircraft_type", T.StringType()),
    T.StructField("capacity", T.IntegerType()),
    T.StructField("manufacturer", T.StringType()),
])

DIM_DATES = T.StructType([
    T.StructField("date_id", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("is_weekend", T.BooleanType()),
])

DIM_PASSENGERS = T.StructType([
    T.StructField("passenger_id", T.LongType()),
    T.StructField("passenger_name", T.StringType()),
])

DIM_FLIGHTS = T.StructType([
    T.StructField("flight_id", T.LongType()),
    T.StructField("flight_number", T.StringType()),
    T.StructField("departure_airport_id", T.LongType()),
    T.StructField("arrival_airport_id", T.LongType()),
    T.StructField("aircraft_id", T.LongType()),
    T.StructField("scheduled_duration_minutes", T.IntegerType()),
])

DIM_WEATHER = T.StructType([
    T.StructField("weather_id", T.LongType()),
    T.StructField("airport_id", T.LongType()),
    T.StructField("observation_time", T.TimestampType()),
    T.StructField("temperature", T.DecimalType(5, 2)),
    T.StructField("humidity", T.IntegerType()),
    T.StructField("wind_speed", T.DecimalType(5, 2)),
    T.StructField("visibility", T.IntegerType()),
    T.StructField("conditions", T.StringType()),
])

DIM_STATUSES = T.StructType([
    T.StructField("status_id", T.LongType()),
    T.StructField("status_code", T.StringType()),
    T.StructField("status_name", T.StringType()),
    T.StructField("category", T.StringType()),
])

DIM_MAINTENANCE_TYPES = T.StructType([
    T.StructField("maintenance_type_id", T.LongType()),
    T.StructField("type_code", T.StringType()),
    T.StructField("type_name", T.StringType()),
    T.StructField("description", T.StringType()),
])

# ---- Fixed values: these must equal the reference's seed rows. -------------
# dim_statuses seed: (status_code, status_name, category), ids 1..10 in this order.
STATUS_SEED = [
    ("confirmed", "Подтверждено", "booking"),
    ("cancelled", "Отменено", "booking"),
    ("pending", "В ожидании", "booking"),
    ("completed", "Завершено", "booking"),
    ("landed", "Приземлился", "flight"),
    ("scheduled", "Запланирован", "flight"),
    ("delayed", "Задержан", "flight"),
    ("diverted", "Перенаправлен", "flight"),
    ("planned", "Запланировано", "maintenance"),
    ("in_progress", "В процессе", "maintenance"),
]

# Pairs that the facts use and the seed lacks, ids 11 and 12.
STATUS_ADDED = [
    ("cancelled", "Отменён", "flight"),
    ("completed", "Завершено", "maintenance"),
]

# dim_maintenance_types seed: (type_code, type_name, description), ids 1..6 in this order.
MAINTENANCE_TYPE_SEED = [
    ("technical_inspection", "Технический осмотр", "Плановая проверка технического состояния"),
    ("fueling", "Заправка топливом", "Заправка самолёта авиатопливом"),
    ("scheduled_maintenance", "Регламентное ТО", "Плановое техническое обслуживание"),
    ("repair", "Ремонт", "Устранение неисправностей"),
    ("engine_check", "Проверка двигателя", "Диагностика двигателей"),
    ("cabin_check", "Проверка салона", "Проверка состояния салона"),
]

# Declared constraints: table -> (NOT NULL columns, UNIQUE column groups, {foreign key: parent table}).
# Status codes are unique within a category, since the added pairs repeat two of them.
CONSTRAINTS = {
    "dim_airports": (["airport_code"], [["airport_code"]], {}),
    "dim_aircraft": (["aircraft_code"], [["aircraft_code"]], {}),
    "dim_dates": (["full_date"], [], {}),
    "dim_flights": (["flight_number"], [["flight_number", "departure_airport_id", "arrival_airport_id"]],
                    {"departure_airport_id": "dim_airports", "arrival_airport_id": "dim_airports", "aircraft_id": "dim_aircraft"}),
    "dim_passengers": (["passenger_name"], [["passenger_name"]], {}),
    "dim_weather": (["observation_time"], [["airport_id", "observation_time"]], {"airport_id": "dim_airports"}),
    "dim_maintenance_types": (["type_code"], [["type_code"]], {}),
    "dim_statuses": (["status_code"], [["category", "status_code"]], {}),
    "fact_bookings": (["booking_ref"], [], {"passenger_id": "dim_passengers", "flight_id": "dim_flights",
                                            "booking_date_id": "dim_dates", "status_id": "dim_statuses"}),
    "fact_flights": ([], [], {"flight_id": "dim_flights", "flight_date_id": "dim_dates", "status_id": "dim_statuses"}),
    "fact_revenue": (["total_revenue", "passenger_count"], [], {"flight_id": "dim_flights", "date_id": "dim_dates"}),
    "fact_maintenance": (["scheduled_date"], [], {"aircraft_id": "dim_aircraft", "maintenance_type_id": "dim_maintenance_types",
                                                  "status_id": "dim_statuses"}),
}
# The key column of each parent table.
PARENT_KEYS = {"dim_airports": "airport_id", "dim_aircraft": "aircraft_id", "dim_dates": "date_id", "dim_flights": "flight_id",
               "dim_passengers": "passenger_id", "dim_statuses": "status_id", "dim_maintenance_types": "maintenance_type_id"}

# Allowed status values used by the data-quality checks.
VALID_BOOKING_STATUSES = ["confirmed", "cancelled", "pending", "completed"]
VALID_FLIGHT_STATUSES = ["scheduled", "landed", "delayed", "cancelled", "diverted"]

# Literal columns the loaders write into dimensions.
AIRPORT_COUNTRY = "Россия"
AIRCRAFT_CAPACITY = 180
AIRCRAFT_MANUFACTURER = "Unknown"
# ---------------------------------------------------------------------------


def status_dim(spark: SparkSession, added_pairs: bool = True) -> DataFrame:
    """Seeded dim_statuses.

    The (category, code) pairs that facts use and the reference's seed lacks
    are appended after it (SURVEY Q6); without ``added_pairs`` the seed stays
    as it is and facts of those statuses resolve to NULL.
    """
    seed = STATUS_SEED + (STATUS_ADDED if added_pairs else [])
    rows = [(i + 1, c, n, cat) for i, (c, n, cat) in enumerate(seed)]
    return spark.createDataFrame(rows, DIM_STATUSES)


def maintenance_type_dim(spark: SparkSession) -> DataFrame:
    rows = [(i + 1, c, n, d) for i, (c, n, d) in enumerate(MAINTENANCE_TYPE_SEED)]
    return spark.createDataFrame(rows, DIM_MAINTENANCE_TYPES)
