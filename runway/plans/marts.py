"""Dashboard data: star views and the aggregates behind each chart.

The views are lazy DataFrames; the dashboard's filters are predicates on
them, which Catalyst pushes below the joins, and every chart is a grouped
aggregate with a small result.  Nothing is fetched before filtering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runway.functions import expr as X
from runway.operators import stats
from runway.sources.sinks import materialize


def flights_view(t: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """fact_flights with route, airports (twice), date, status and aircraft."""
    ff, df_, ap = t["fact_flights"], t["dim_flights"], t["dim_airports"]
    dep = ap.select(F.col("airport_id").alias("departure_airport_id"), F.col("airport_code").alias("departure"))
    arr = ap.select(F.col("airport_id").alias("arrival_airport_id"), F.col("airport_code").alias("arrival"))
    dd = t["dim_dates"].select(F.col("date_id").alias("flight_date_id"), F.col("full_date").alias("flight_date"))
    ds = t["dim_statuses"].select("status_id", F.col("status_code").alias("status"))
    ac = t["dim_aircraft"].select(F.col("aircraft_id").alias("_ac"), F.col("aircraft_code").alias("aircraft_id"))
    v = (ff.join(df_.select("flight_id", "flight_number", "departure_airport_id", "arrival_airport_id",
                            F.col("aircraft_id").alias("_ac")), "flight_id")
         .join(dep, "departure_airport_id").join(arr, "arrival_airport_id")
         .join(dd, "flight_date_id").join(ds, "status_id")
         .join(ac, "_ac", "left"))
    v = v.select("flight_instance_id", "flight_number", "departure", "arrival", "flight_date", "status",
                 F.col("scheduled_departure_time").alias("scheduled_departure"),
                 F.col("scheduled_arrival_time").alias("scheduled_arrival"),
                 F.col("actual_departure_time").alias("actual_departure"),
                 F.col("actual_arrival_time").alias("actual_arrival"), "delay_minutes", "aircraft_id")
    # The unique last key lets the range partitioner split a date that holds many flights.
    return v.orderBy("flight_date", "flight_number", "flight_instance_id") if ordered else v


def bookings_view(t: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """fact_bookings with passenger, route, airports, date, status and aircraft."""
    fb, df_, ap = t["fact_bookings"], t["dim_flights"], t["dim_airports"]
    dep = ap.select(F.col("airport_id").alias("departure_airport_id"),
                    F.col("airport_code").alias("departure_airport"))
    arr = ap.select(F.col("airport_id").alias("arrival_airport_id"), F.col("airport_code").alias("arrival_airport"))
    dd = t["dim_dates"].select(F.col("date_id").alias("booking_date_id"), F.col("full_date").alias("booking_date"))
    ds = t["dim_statuses"].select("status_id", F.col("status_code").alias("status"))
    ac = t["dim_aircraft"].select(F.col("aircraft_id").alias("_ac"), F.col("aircraft_code").alias("aircraft_type"))
    v = (fb.join(t["dim_passengers"], "passenger_id")
         .join(df_.select("flight_id", "flight_number", "departure_airport_id", "arrival_airport_id",
                          F.col("aircraft_id").alias("_ac")), "flight_id")
         .join(dep, "departure_airport_id").join(arr, "arrival_airport_id")
         .join(dd, "booking_date_id").join(ds, "status_id")
         .join(ac, "_ac", "left"))
    v = v.select("booking_id", "booking_ref", "passenger_name", "flight_number", "departure_airport",
                 "arrival_airport", "booking_date", "status", "ticket_price", "currency", "aircraft_type")
    return v.orderBy(F.col("booking_date").desc(), "booking_id") if ordered else v


def maintenance_view(t: dict[str, DataFrame], ordered: bool = True) -> DataFrame:
    """fact_maintenance with aircraft, maintenance type and status."""
    fm = t["fact_maintenance"]
    da = t["dim_aircraft"].select("aircraft_id", "aircraft_code", "aircraft_type")
    mt = t["dim_maintenance_types"].select("maintenance_type_id", "type_code", "type_name")
    ds = t["dim_statuses"].select("status_id", "status_code", "status_name")
    v = fm.join(da, "aircraft_id").join(mt, "maintenance_type_id").join(ds, "status_id").select(
        "maintenance_id", "aircraft_code", "aircraft_type", "type_code", "type_name", "status_code",
        "status_name", "scheduled_date", "completed_date", "cost", "description")
    return v.orderBy(F.col("scheduled_date").desc(), "maintenance_id") if ordered else v


# ------------------------------------------------------------------ KPIs and tables

def kpis(flights: DataFrame, bookings: DataFrame) -> DataFrame:
    """Flight count, booking count, revenue and mean ticket price as (metric, value) rows.

    Two independent one-row aggregates, stacked by a union (no join).
    """
    f = flights.agg(F.count(F.lit(1)).cast("double").alias("total_flights"))
    b = bookings.agg(F.count(F.lit(1)).cast("double").alias("total_bookings"),
                     F.sum("ticket_price").cast("double").alias("total_revenue"),
                     F.avg("ticket_price").cast("double").alias("avg_price"))
    return (f.selectExpr("stack(1, 'total_flights', total_flights) as (metric, value)")
            .unionByName(b.selectExpr("stack(3, 'total_bookings', total_bookings, 'total_revenue', "
                                      "total_revenue, 'avg_price', avg_price) as (metric, value)")))


def maintenance_kpis(maint: DataFrame) -> DataFrame:
    """A8 + A9: count, total cost, completed and planned counts."""
    return maint.agg(F.count(F.lit(1)).alias("total_maintenance"), F.sum("cost").alias("total_cost"),
                     F.count_if(F.col("status_code") == "completed").alias("completed"),
                     F.count_if(F.col("status_code") == "planned").alias("planned"))


def frequency(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """A10: value counts, NULLs dropped, most frequent first."""
    return (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(name or col)).count()
            .orderBy(F.col("count").desc(), F.col(name or col)))


def frequency_share(df: DataFrame, col: str) -> DataFrame:
    """A11 + N14: value counts with their share of the total as text ('12.5%').

    The view is aggregated once: the counts (one row per distinct value) are
    staged, and the total is their sum, used as a literal (no join, no
    unpartitioned window, no second pass over ``df``).
    """
    counts = materialize(df.where(F.col(col).isNotNull()).groupBy(col).count(), "value-counts")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n")).first()["n"]
    return (counts.select(col, "count", X.percent_text("count", F.lit(total)).alias("percent"))
            .orderBy(F.col("count").desc(), F.col(col)))


def count_by(df: DataFrame, col: str) -> DataFrame:
    """A12."""
    return df.where(F.col(col).isNotNull()).groupBy(col).count().orderBy(col)


def sum_by(df: DataFrame, key: str, value: str, alias: str) -> DataFrame:
    """A13."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(alias)).orderBy(key)


def mean_median_count_by(df: DataFrame, key: str, value: str, exact: bool = True) -> DataFrame:
    """Mean, median and count of ``value`` per ``key``.

    The exact median is the distributed per-group search of
    ``stats.grouped_quantiles`` (no task holds a group's values);
    ``exact=False`` uses ``percentile_approx`` with bounded memory per group.
    """
    if exact:
        # Mean and count come from the first pass over the staged (group, value) pairs.
        out = stats.grouped_quantiles(df, key, value, [0.5]).withColumnRenamed("q0", "median")
    else:
        v = F.col(value).cast("double")
        out = df.where(F.col(key).isNotNull()).groupBy(key).agg(
            F.avg(v).alias("mean"), F.percentile_approx(v, 0.5, 10_000).cast("double").alias("median"), F.count(v).alias("count"))
    return out.select(key, "mean", "median", "count").orderBy(key)


def by_weekday(df: DataFrame, date_col: str, value: str) -> DataFrame:
    """A15 + D9 + N13: mean and count per weekday, Monday first, with the Russian label."""
    d = F.to_date(date_col)
    return (df.where(F.col(date_col).isNotNull())
            .groupBy(F.weekday(d).alias("weekday"), X.day_name(d).alias("day_name"))
            .agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))
            .withColumn("day_name_ru", X.day_label_ru("day_name"))
            .orderBy("weekday"))


def delay_summary(flights: DataFrame) -> DataFrame:
    """A18 over N12: flights with both times, mean and max delay, delayed and on-time counts."""
    both = flights.where(F.col("actual_departure").isNotNull() & F.col("scheduled_departure").isNotNull())
    d = X.signed_delay_minutes("scheduled_departure", "actual_departure")
    return both.agg(F.count(F.lit(1)).alias("flights_with_data"), F.avg(d).alias("avg_delay"),
                    F.max(d).alias("max_delay"), F.count_if(d > 0).alias("delayed")) \
        .withColumn("on_time", F.col("flights_with_data") - F.col("delayed"))


def price_stats(bookings: DataFrame, exact: bool = True) -> DataFrame:
    """A16.  The exact quartiles take several passes; they scan the staged price column, not the view's joins."""
    prices = bookings.select("ticket_price")
    return stats.describe(materialize(prices, "price-values") if exact else prices, "ticket_price", exact)


def price_histogram(bookings: DataFrame, bins: int = 20) -> DataFrame:
    """A19.  Bounds and bin counts are two passes over the staged price column."""
    return stats.histogram(materialize(bookings.select("ticket_price"), "price-values"), "ticket_price", bins)


def filter_bounds(bookings: DataFrame) -> DataFrame:
    """Price and booking-date bounds for the widgets."""
    return bookings.agg(F.min("ticket_price").alias("min_price"), F.max("ticket_price").alias("max_price"),
                        F.min(F.to_date("booking_date")).alias("min_date"),
                        F.max(F.to_date("booking_date")).alias("max_date"))


# ------------------------------------------------------------------ quality report views

def quality_summary(report: DataFrame) -> DataFrame:
    """One row per source from the quality report."""
    return report.select("source", "initial_rows", "final_rows",
                         F.coalesce("rejected_rows", F.lit(0)).alias("rejected_rows"),
                         F.coalesce("duplicates_removed", F.lit(0)).alias("duplicates_removed"),
                         F.format_string("%.2f", F.coalesce("completeness_after", F.lit(0.0)))
                         .alias("completeness"))


def fill_details(report: DataFrame) -> DataFrame:
    """The fill map exploded to rows."""
    return report.select("source", F.explode("fill_report").alias("column", "info")).select(
        "source", "column", "info.method", "info.value", "info.filled")


def outlier_details(report: DataFrame) -> DataFrame:
    """The outlier map exploded to rows."""
    return report.select("source", F.explode("outliers_report").alias("column", "info")).select(
        "source", "column", "info.count", "info.min", "info.max", "info.lower_bound", "info.upper_bound")


def dashboard(t: dict[str, DataFrame], report: DataFrame | None = None, *, cache: bool = False,
              exact: bool = True, **sidebar) -> dict[str, DataFrame]:
    """Every table and chart of the dashboard's six tabs, as lazy DataFrames.

    ``sidebar`` takes the filter widgets of ``filters.booking_filters``
    (departures, arrivals, statuses, aircraft, price_range, date_range_);
    the booking charts use the filtered view, the KPIs and flight charts the
    whole views, as the reference does.  With ``cache`` the three star views
    are persisted (memory and disk) because every chart re-reads them.
    """
    from runway.operators import filters

    fv, bv, mv = flights_view(t, ordered=False), bookings_view(t, ordered=False), maintenance_view(t, ordered=False)
    if cache:
        fv, bv, mv = fv.persist(), bv.persist(), mv.persist()
    fb = filters.booking_filters(bv, **sidebar)
    out = {
        "kpis": kpis(fv, bv),
        "flight_status_counts": frequency(fv, "status"),
        "flights_by_date": count_by(fv, "flight_date"),
        "flights_table": fv.orderBy("flight_date", "flight_number", "flight_instance_id"),
        "booking_status_counts": frequency(fb, "status"),
        "revenue_by_departure": sum_by(fb, "departure_airport", "ticket_price", "revenue"),
        "price_histogram": price_histogram(fb),
        "price_by_departure": mean_median_count_by(fb, "departure_airport", "ticket_price", exact),
        "price_by_aircraft": mean_median_count_by(fb, "aircraft_type", "ticket_price", exact),
        "price_by_weekday": by_weekday(fb, "booking_date", "ticket_price"),
        "bookings_table": fb.orderBy(F.col("booking_date").desc(), "booking_id"),
        "airports_table": t["dim_airports"].orderBy("airport_code"),
        "flights_by_airport": frequency(fv, "departure"),
        "aircraft_table": t["dim_aircraft"].orderBy("aircraft_code"),
        "aircraft_usage": frequency(fv, "aircraft_id"),
        "maintenance_kpis": maintenance_kpis(mv),
        "maintenance_type_counts": frequency(mv, "type_name"),
        "maintenance_status_counts": frequency(mv, "status_name"),
        "cost_by_type": sum_by(mv, "type_name", "cost", "cost"),
        "cost_by_aircraft": sum_by(mv, "aircraft_code", "cost", "cost"),
        "maintenance_table": mv.orderBy(F.col("scheduled_date").desc(), "maintenance_id"),
        "price_stats": price_stats(bv, exact),
        "null_profile": _null_profile(bv),
        "price_outliers": stats.outlier_rows(bv, "ticket_price", ["booking_ref", "passenger_name", "ticket_price"],
                                             exact, stage=not cache),
        "flight_status_share": frequency_share(fv, "status"),
        "delay_summary": delay_summary(fv),
        "filter_bounds": filter_bounds(bv),
    }
    if report is not None:
        out.update({"quality_summary": quality_summary(report), "fill_details": fill_details(report),
                    "outlier_details": outlier_details(report)})
    return out


def _null_profile(df: DataFrame) -> DataFrame:
    from runway.operators import quality
    return quality.null_profile(df)
