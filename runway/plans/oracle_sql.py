"""DuckDB SQL for the correctness oracle.

The same derivations as ``tpch.py`` and the cleaning/warehouse plans,
written independently in plain SQL over the driver's tables, so each
registered Spark query can be compared with a DuckDB result.
"""

from __future__ import annotations

from runway.functions.expr import AIRPORT_CODES
from runway.plans.tpch import AIRPORT_INDEX

CODES = "[" + ", ".join(f"'{c}'" for c, _ in AIRPORT_INDEX) + "]"
NAMES = "[" + ", ".join(f"'{n}'" for _, n in AIRPORT_INDEX) + "]"


def airport_sql(col: str) -> str:
    """N1 in SQL: lookup of trimmed lower text, else upper text."""
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in AIRPORT_CODES.items())
    return f"(CASE lower(trim({col})) {whens} ELSE upper(trim({col})) END)"


def flight_sql(col: str) -> str:
    """N2 in SQL."""
    return f"replace(upper({col}), ' ', '')"


BOOKINGS_RAW = f"""
bk_base AS (
  SELECT o.*, c.c_name, c.c_mktsegment,
         CAST(100 + o_custkey % 50 AS VARCHAR) AS num,
         o_custkey % 10 AS dep, (o_custkey % 10 + 1 + o_custkey % 7) % 10 AS arr,
         (o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P') AS bad
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
bk_copies AS (
  SELECT *, 0 AS copy FROM bk_base
  UNION ALL
  SELECT *, 1 AS copy FROM bk_base WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'),
bookings_raw AS (
  SELECT o_orderkey + copy * 1000000000000 AS id,
         'BK' || CAST(o_orderkey AS VARCHAR) AS booking_ref,
         CASE WHEN NOT bad THEN c_name END AS passenger_name,
         CASE WHEN NOT bad THEN (CASE WHEN o_orderpriority = '1-URGENT' THEN 'su ' || num
                                      WHEN o_orderpriority = '2-HIGH' THEN 'SU ' || num
                                      ELSE 'SU' || num END) END AS flight_number,
         CASE WHEN NOT bad THEN (CASE WHEN o_orderstatus = 'F' THEN {CODES}[dep + 1]
                                      WHEN o_orderstatus = 'O' THEN {NAMES}[dep + 1]
                                      ELSE ' ' || lower({CODES}[dep + 1]) || ' ' END) END AS departure_airport,
         {CODES}[arr + 1] AS arrival_airport,
         o_orderdate + INTERVAL 3 DAY AS departure_time,
         o_orderdate + INTERVAL 3 DAY + INTERVAL 2 HOUR AS arrival_time,
         c_mktsegment AS aircraft_type,
         CASE WHEN NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'P') THEN o_totalprice END AS ticket_price,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'rub' ELSE 'RUB' END AS currency,
         o_orderdate AS booking_date,
         CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'CONFIRMED ' ELSE 'cancelled' END AS status
  FROM bk_copies)"""

FLIGHTS_RAW = f"""
fl_base AS (
  SELECT l.*, o.o_custkey, o.o_orderdate,
         CAST(100 + o_custkey % 50 AS VARCHAR) AS num,
         o_custkey % 10 AS dep, (o_custkey % 10 + 1 + o_custkey % 7) % 10 AS arr,
         o.o_orderdate + INTERVAL 3 DAY AS sd,
         CAST(l_quantity - 10 AS BIGINT) AS late
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
flights_raw AS (
  SELECT CAST(sd AS DATE) AS flight_date,
         CASE WHEN l_returnflag = 'R' THEN 'su ' || num ELSE 'SU' || num END AS flight_number,
         CASE WHEN l_returnflag = 'A' THEN {NAMES}[dep + 1] ELSE {CODES}[dep + 1] END AS departure,
         {CODES}[arr + 1] AS arrival,
         sd AS scheduled_departure,
         sd + INTERVAL 2 HOUR AS scheduled_arrival,
         CASE WHEN l_linestatus = 'F' THEN sd + to_minutes(late) END AS actual_departure,
         CASE WHEN l_linestatus = 'F' THEN sd + INTERVAL 2 HOUR + to_minutes(late + l_linenumber) END AS actual_arrival,
         CASE WHEN l_linestatus = 'F' THEN 'landed' ELSE 'SCHEDULED' END AS status,
         'AC' || CAST(l_partkey % 40 AS VARCHAR) AS aircraft_id
  FROM fl_base)"""

MAINTENANCE_RAW = """
mt_base AS (SELECT *, (p_brand = 'Brand#2' AND p_size % 3 = 1) AS bad FROM part),
maintenance_raw AS (
  SELECT CASE WHEN NOT bad THEN ' ac' || CAST(p_partkey % 40 AS VARCHAR) || ' ' END AS aircraft_code,
         CASE WHEN NOT bad THEN (CASE p_type WHEN 'ECONOMY' THEN 'Technical_Inspection'
                                             WHEN 'STANDARD' THEN ' fueling'
                                             WHEN 'SMALL' THEN 'REPAIR'
                                             WHEN 'PROMO' THEN 'engine_check'
                                             WHEN 'MEDIUM' THEN 'cabin_check'
                                             ELSE 'scheduled_maintenance' END) END AS maintenance_type,
         CASE WHEN p_size = 50 THEN 'not a date' ELSE CAST(DATE '2024-01-01' + p_size AS VARCHAR) END AS scheduled_date,
         CASE WHEN p_size % 3 = 0 THEN CAST(DATE '2024-01-01' + (p_size + 1) AS VARCHAR) END AS completed_date,
         CASE p_size % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'Planned' ELSE 'in_progress' END AS status,
         CASE WHEN p_brand = 'Brand#1' THEN 'n/a'
              ELSE CAST(CAST(round(p_retailprice * 100) AS BIGINT) AS VARCHAR) END AS cost,
         CASE WHEN NOT bad AND p_size <> 1 THEN p_name END AS description
  FROM mt_base)"""

LOGS_RAW = """
logs_raw AS (
  SELECT CASE WHEN event_type = 'error' AND user_id % 10 = 0 THEN 'garbage' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
         CASE event_type WHEN 'error' THEN ' error' WHEN 'view' THEN 'info' WHEN 'click' THEN 'Debug'
                         ELSE 'warning' END AS level,
         'su ' || CAST(100 + user_id % 50 AS VARCHAR) AS flight_number,
         props AS message
  FROM events)"""

WEATHER_RAW = f"""
weather_raw AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN {NAMES}[user_id % 10 + 1] ELSE lower({CODES}[user_id % 10 + 1]) END AS airport_code,
         replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z' AS "timestamp",
         value - 20.0 AS temperature,
         user_id % 100 AS humidity,
         value / 2.0 AS wind_speed,
         (user_id * 100) % 10000 AS visibility,
         event_type AS conditions
  FROM events)"""

BOOKING_COLS = ["id", "booking_ref", "passenger_name", "flight_number", "departure_airport", "arrival_airport",
                "departure_time", "arrival_time", "aircraft_type", "ticket_price", "currency", "booking_date",
                "status"]
FLIGHT_COLS = ["flight_date", "flight_number", "departure", "arrival", "scheduled_departure",
               "scheduled_arrival", "actual_departure", "actual_arrival", "status", "aircraft_id"]
MAINT_COLS = ["aircraft_code", "maintenance_type", "scheduled_date", "completed_date", "status", "cost",
              "description"]


def dec(expr: str, p: int, s: int) -> str:
    """Spark's double -> decimal cast rounds the shortest decimal text half up; so does this."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL({p},{s}))"


def avg_dec(col: str, p: int = 10, s: int = 2) -> str:
    """Exact decimal mean rounded half up (Spark's decimal AVG), from integer cents."""
    cents = f"CAST(sum({col}) * 100 AS HUGEINT)"
    n = f"NULLIF(count({col}), 0)"
    return f"CAST(CAST((2 * {cents} + {n}) // (2 * {n}) AS DECIMAL(38,0)) * 0.01 AS DECIMAL({p},{s}))"


def null_count_sql(cols: list[str]) -> str:
    return " + ".join(f'CAST("{c}" IS NULL AS INTEGER)' for c in cols)


# T1 up to imputation: reject (>2 NULLs), dedupe ignoring id (first id kept), standardise.
_bk_keys = ", ".join(c for c in BOOKING_COLS if c != "id")
BOOKINGS_STD = f"""
bk_flag AS (SELECT *, {null_count_sql(BOOKING_COLS)} AS null_count FROM bookings_raw),
bk_good AS (SELECT * EXCLUDE (null_count) FROM bk_flag WHERE null_count <= 2),
bk_dedup AS (SELECT min(id) AS id, {_bk_keys} FROM bk_good GROUP BY {_bk_keys}),
bookings_std AS (
  SELECT id, booking_ref, passenger_name, {flight_sql('flight_number')} AS flight_number,
         {airport_sql('departure_airport')} AS departure_airport,
         {airport_sql('arrival_airport')} AS arrival_airport,
         departure_time, arrival_time, aircraft_type, ticket_price,
         upper(trim(currency)) AS currency, booking_date, lower(trim(status)) AS status
  FROM bk_dedup)"""

# T1 imputation: the only column with NULLs left is the price (median).
BOOKINGS_CLEAN = BOOKINGS_STD + """,
bk_median AS (SELECT quantile_cont(ticket_price, 0.5) AS m FROM bookings_std),
bookings_clean AS (
  SELECT * REPLACE (coalesce(ticket_price, (SELECT m FROM bk_median)) AS ticket_price) FROM bookings_std)"""

# Flights never lose rows to the NULL rule (at most two NULL times); dedupe on all columns.
FLIGHTS_CLEAN = f""",
fl_dedup AS (SELECT DISTINCT * FROM flights_raw),
flights_clean AS (
  SELECT flight_date, {flight_sql('flight_number')} AS flight_number,
         {airport_sql('departure')} AS departure, {airport_sql('arrival')} AS arrival,
         scheduled_departure, scheduled_arrival, actual_departure, actual_arrival,
         lower(trim(status)) AS status, aircraft_id
  FROM fl_dedup)"""

# T5: reject, standardise, parse, then median cost and mode description.
MAINTENANCE_CLEAN = f""",
mt_flag AS (SELECT *, {null_count_sql(MAINT_COLS)} AS null_count FROM maintenance_raw),
mt_std AS (
  SELECT upper(trim(aircraft_code)) AS aircraft_code,
         lower(trim(maintenance_type)) AS maintenance_type,
         CAST(try_cast(scheduled_date AS TIMESTAMP) AS DATE) AS scheduled_date,
         CAST(try_cast(completed_date AS TIMESTAMP) AS DATE) AS completed_date,
         lower(trim(status)) AS status,
         try_cast(cost AS DOUBLE) AS cost,
         description
  FROM mt_flag WHERE null_count <= 2),
mt_median AS (SELECT quantile_cont(cost, 0.5) AS m FROM mt_std),
mt_mode AS (SELECT description AS v FROM mt_std WHERE description IS NOT NULL
            GROUP BY description ORDER BY count(*) DESC, description LIMIT 1),
maintenance_clean AS (
  SELECT aircraft_code, maintenance_type, scheduled_date, completed_date, status,
         coalesce(cost, (SELECT m FROM mt_median)) AS cost,
         coalesce(description, (SELECT v FROM mt_mode)) AS description
  FROM mt_std)"""

LOGS_CLEAN = """,
logs_clean AS (
  SELECT try_cast("timestamp" AS TIMESTAMP) AS "timestamp", upper(trim(level)) AS level,
         replace(upper(flight_number), ' ', '') AS flight_number, message
  FROM logs_raw)"""

WEATHER_CLEAN = f""",
weather_clean AS (
  SELECT {airport_sql('airport_code')} AS airport_code, try_cast("timestamp" AS TIMESTAMP) AS "timestamp",
         temperature, humidity, wind_speed, visibility, conditions
  FROM weather_raw)"""


def with_(*parts: str) -> str:
    """Join CTE fragments into one WITH clause."""
    body = ""
    for p in parts:
        p = p.strip()
        if not body:
            body = p.lstrip(",").strip()
        elif p.startswith(","):
            body += p
        else:
            body += ",\n" + p
    return "WITH " + body + "\n"


# ------------------------------------------------------------------ warehouse (fresh load)

def _values(rows: list[tuple], cols: str) -> str:
    def lit(v):
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({cols})"


def _seeds() -> str:
    from runway.schemas import MAINTENANCE_TYPE_SEED, STATUS_ADDED, STATUS_SEED
    st = [(i + 1, c, n, cat) for i, (c, n, cat) in enumerate(STATUS_SEED + STATUS_ADDED)]
    mt = [(i + 1, c, n, d) for i, (c, n, d) in enumerate(MAINTENANCE_TYPE_SEED)]
    return (f"dim_statuses AS (SELECT * FROM {_values(st, 'status_id, status_code, status_name, category')}),\n"
            f"dim_maintenance_types AS (SELECT * FROM "
            f"{_values(mt, 'maintenance_type_id, type_code, type_name, description')})")


WAREHOUSE = """,
""" + _seeds() + """,
dim_airports AS (
  SELECT row_number() OVER (ORDER BY airport_code) AS airport_id, airport_code, airport_code AS airport_name,
         airport_code AS city, 'Россия' AS country
  FROM (SELECT DISTINCT airport_code FROM (
          SELECT departure_airport AS airport_code FROM bookings_clean UNION ALL
          SELECT arrival_airport FROM bookings_clean UNION ALL
          SELECT departure FROM flights_clean UNION ALL
          SELECT arrival FROM flights_clean) WHERE airport_code IS NOT NULL)),
dim_aircraft AS (
  SELECT row_number() OVER (ORDER BY aircraft_code) AS aircraft_id, aircraft_code, aircraft_code AS aircraft_type,
         180 AS capacity, 'Unknown' AS manufacturer
  FROM (SELECT DISTINCT aircraft_code FROM (
          SELECT aircraft_type AS aircraft_code FROM bookings_clean UNION ALL
          SELECT aircraft_id FROM flights_clean) WHERE aircraft_code IS NOT NULL)),
dim_dates AS (
  SELECT """ + "{CALENDAR}" + """ FROM (SELECT DISTINCT d FROM (
          SELECT CAST(departure_time AS DATE) AS d FROM bookings_clean UNION ALL
          SELECT CAST(booking_date AS DATE) FROM bookings_clean UNION ALL
          SELECT flight_date FROM flights_clean) WHERE d IS NOT NULL)),
dim_passengers AS (
  SELECT row_number() OVER (ORDER BY passenger_name) AS passenger_id, passenger_name
  FROM (SELECT DISTINCT passenger_name FROM bookings_clean WHERE passenger_name IS NOT NULL)),
route_src AS (
  SELECT flight_number, departure_airport, arrival_airport, aircraft_code FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_number, departure_airport, arrival_airport
                                 ORDER BY src, oid, oday, otime, ocode) AS rn
    FROM (SELECT flight_number, departure_airport, arrival_airport, aircraft_type AS aircraft_code, 0 AS src,
                 id AS oid, CAST(NULL AS DATE) AS oday, CAST(NULL AS TIMESTAMP) AS otime, CAST(NULL AS VARCHAR) AS ocode
          FROM bookings_clean
          UNION ALL
          SELECT flight_number, departure, arrival, aircraft_id, 1, NULL, flight_date, scheduled_departure, aircraft_id
          FROM flights_clean))
  WHERE rn = 1),
dim_flights AS (
  SELECT row_number() OVER (ORDER BY r.flight_number NULLS FIRST, da.airport_id NULLS FIRST, aa.airport_id NULLS FIRST)
           AS flight_id,
         r.flight_number, da.airport_id AS departure_airport_id, aa.airport_id AS arrival_airport_id,
         ac.aircraft_id, CAST(NULL AS INTEGER) AS scheduled_duration_minutes
  FROM route_src r
  LEFT JOIN dim_airports da ON r.departure_airport = da.airport_code
  LEFT JOIN dim_airports aa ON r.arrival_airport = aa.airport_code
  LEFT JOIN dim_aircraft ac ON r.aircraft_code = ac.aircraft_code),
route_codes AS (
  SELECT f.flight_id, f.flight_number, da.airport_code AS dep_code, aa.airport_code AS arr_code
  FROM dim_flights f
  JOIN dim_airports da ON f.departure_airport_id = da.airport_id
  JOIN dim_airports aa ON f.arrival_airport_id = aa.airport_id),
fact_bookings AS (
  SELECT row_number() OVER (ORDER BY b.id) AS booking_id, b.booking_ref, p.passenger_id, rc.flight_id,
         dd.date_id AS booking_date_id, st.status_id, {DEC_PRICE} AS ticket_price, b.currency
  FROM bookings_clean b
  LEFT JOIN dim_passengers p ON b.passenger_name = p.passenger_name
  LEFT JOIN route_codes rc ON b.flight_number = rc.flight_number AND b.departure_airport = rc.dep_code
                          AND b.arrival_airport = rc.arr_code
  LEFT JOIN dim_dates dd ON CAST(b.booking_date AS DATE) = dd.full_date
  LEFT JOIN (SELECT * FROM dim_statuses WHERE category = 'booking') st ON b.status = st.status_code),
ff_base AS (
  SELECT rc.flight_id, dd.date_id AS flight_date_id, st.status_id,
         f.scheduled_departure AS scheduled_departure_time, f.scheduled_arrival AS scheduled_arrival_time,
         f.actual_departure AS actual_departure_time, f.actual_arrival AS actual_arrival_time,
         CASE WHEN f.actual_departure IS NOT NULL AND f.scheduled_departure IS NOT NULL
              THEN CAST(greatest(date_diff('minute', f.scheduled_departure, f.actual_departure), 0) AS INTEGER)
         END AS delay_minutes,
         f.flight_number, f.aircraft_id
  FROM flights_clean f
  LEFT JOIN route_codes rc ON f.flight_number = rc.flight_number AND f.departure = rc.dep_code AND f.arrival = rc.arr_code
  LEFT JOIN dim_dates dd ON f.flight_date = dd.full_date
  LEFT JOIN (SELECT * FROM dim_statuses WHERE category = 'flight') st ON f.status = st.status_code),
fact_flights AS (
  SELECT row_number() OVER (ORDER BY flight_date_id NULLS FIRST, flight_number NULLS FIRST,
                                     scheduled_departure_time NULLS FIRST, actual_departure_time NULLS FIRST,
                                     actual_arrival_time NULLS FIRST, aircraft_id NULLS FIRST,
                                     flight_id NULLS FIRST, status_id NULLS FIRST) AS flight_instance_id,
         flight_id, flight_date_id, status_id, scheduled_departure_time, scheduled_arrival_time,
         actual_departure_time, actual_arrival_time, delay_minutes
  FROM ff_base),
fact_revenue AS (
  SELECT row_number() OVER (ORDER BY flight_id NULLS FIRST, date_id NULLS FIRST) AS revenue_id, *
  FROM (SELECT fb.flight_id, fb.booking_date_id AS date_id,
               CAST(sum(fb.ticket_price) AS DECIMAL(15,2)) AS total_revenue,
               count(fb.booking_id) AS passenger_count,
               {AVG_PRICE} AS avg_ticket_price,
               count(*) FILTER (WHERE ds.status_code = 'confirmed') AS confirmed_count,
               count(*) FILTER (WHERE ds.status_code = 'cancelled') AS cancelled_count
        FROM fact_bookings fb JOIN dim_statuses ds ON fb.status_id = ds.status_id
        WHERE ds.status_code IN ('confirmed', 'completed')
        GROUP BY fb.flight_id, fb.booking_date_id)),
fm_base AS (
  SELECT ac.aircraft_id, mt.maintenance_type_id, st.status_id, m.scheduled_date, m.completed_date,
         {DEC_COST} AS cost, coalesce(m.description, '') AS description
  FROM maintenance_clean m
  LEFT JOIN dim_aircraft ac ON m.aircraft_code = ac.aircraft_code
  LEFT JOIN dim_maintenance_types mt ON m.maintenance_type = mt.type_code
  LEFT JOIN (SELECT * FROM dim_statuses WHERE category = 'maintenance') st ON m.status = st.status_code),
fact_maintenance AS (
  SELECT row_number() OVER (ORDER BY scheduled_date NULLS FIRST, aircraft_id NULLS FIRST,
                                     maintenance_type_id NULLS FIRST, status_id NULLS FIRST,
                                     completed_date NULLS FIRST, cost NULLS FIRST, description NULLS FIRST)
           AS maintenance_id, *
  FROM fm_base)"""

CALENDAR = """CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_id, d AS full_date,
CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
CAST(isodow(d) - 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
CAST(quarter(d) AS INTEGER) AS quarter, isodow(d) >= 6 AS is_weekend"""

WAREHOUSE = (WAREHOUSE.replace("{CALENDAR}", CALENDAR).replace("{DEC_PRICE}", dec("b.ticket_price", 10, 2))
             .replace("{DEC_COST}", dec("m.cost", 12, 2))
             .replace("{AVG_PRICE}", avg_dec("fb.ticket_price")))

VIEWS = """,
flights_view AS (
  SELECT ff.flight_instance_id, df.flight_number, dep.airport_code AS departure, arr.airport_code AS arrival,
         dd.full_date AS flight_date, ds.status_code AS status,
         ff.scheduled_departure_time AS scheduled_departure, ff.scheduled_arrival_time AS scheduled_arrival,
         ff.actual_departure_time AS actual_departure, ff.actual_arrival_time AS actual_arrival,
         ff.delay_minutes, dac.aircraft_code AS aircraft_id
  FROM fact_flights ff
  JOIN dim_flights df ON ff.flight_id = df.flight_id
  JOIN dim_airports dep ON df.departure_airport_id = dep.airport_id
  JOIN dim_airports arr ON df.arrival_airport_id = arr.airport_id
  JOIN dim_dates dd ON ff.flight_date_id = dd.date_id
  JOIN dim_statuses ds ON ff.status_id = ds.status_id
  LEFT JOIN dim_aircraft dac ON df.aircraft_id = dac.aircraft_id),
bookings_view AS (
  SELECT fb.booking_id, fb.booking_ref, dp.passenger_name, df.flight_number,
         dep.airport_code AS departure_airport, arr.airport_code AS arrival_airport,
         dd.full_date AS booking_date, ds.status_code AS status, fb.ticket_price, fb.currency,
         dac.aircraft_code AS aircraft_type
  FROM fact_bookings fb
  JOIN dim_passengers dp ON fb.passenger_id = dp.passenger_id
  JOIN dim_flights df ON fb.flight_id = df.flight_id
  JOIN dim_airports dep ON df.departure_airport_id = dep.airport_id
  JOIN dim_airports arr ON df.arrival_airport_id = arr.airport_id
  JOIN dim_dates dd ON fb.booking_date_id = dd.date_id
  JOIN dim_statuses ds ON fb.status_id = ds.status_id
  LEFT JOIN dim_aircraft dac ON df.aircraft_id = dac.aircraft_id),
maintenance_view AS (
  SELECT fm.maintenance_id, da.aircraft_code, da.aircraft_type, dmt.type_code, dmt.type_name,
         ds.status_code, ds.status_name, fm.scheduled_date, fm.completed_date, fm.cost, fm.description
  FROM fact_maintenance fm
  JOIN dim_aircraft da ON fm.aircraft_id = da.aircraft_id
  JOIN dim_maintenance_types dmt ON fm.maintenance_type_id = dmt.maintenance_type_id
  JOIN dim_statuses ds ON fm.status_id = ds.status_id)"""

SOURCES_CLEAN = [BOOKINGS_RAW, FLIGHTS_RAW, MAINTENANCE_RAW, BOOKINGS_CLEAN, FLIGHTS_CLEAN, MAINTENANCE_CLEAN]


def warehouse_with(*extra: str) -> str:
    """WITH clause: derived sources, cleaning, the loaded warehouse and the dashboard views."""
    return with_(*SOURCES_CLEAN, WAREHOUSE, VIEWS, *extra)
