"""Row filters of the dashboard and the loaders (F2-F8).

Filters are plain predicates, so Catalyst pushes them below joins and into
the parquet scan (``PushedFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def membership(col: str, values) -> Column:
    """``col IN values``."""
    return F.col(col).isin(list(values))


def membership_or_null(col: str, values) -> Column:
    """``col IN values OR col IS NULL``."""
    return F.col(col).isin(list(values)) | F.col(col).isNull()


def closed_range(col: str, lo, hi) -> Column:
    """``lo <= col <= hi``."""
    return F.col(col).between(F.lit(lo), F.lit(hi))


def date_range(col: str, lo: str, hi: str) -> Column:
    """date part of a timestamp between two dates, both ends included."""
    return F.to_date(F.col(col)).between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))


def both_present(a: str, b: str) -> Column:
    """F6."""
    return F.col(a).isNotNull() & F.col(b).isNotNull()


def booking_filters(df: DataFrame, departures=None, arrivals=None, statuses=None, aircraft=None,
                    price_range=None, date_range_=None) -> DataFrame:
    """The dashboard's sidebar filters over the bookings view.

    ``None`` means "no restriction" (the widget's default selects everything).
    Aircraft keeps rows without an aircraft, as the reference does.
    """
    cond = F.lit(True)
    if departures is not None:
        cond = cond & membership("departure_airport", departures)
    if arrivals is not None:
        cond = cond & membership("arrival_airport", arrivals)
    if statuses is not None:
        cond = cond & membership("status", statuses)
    if price_range is not None:
        cond = cond & closed_range("ticket_price", *price_range)
    if aircraft is not None:
        cond = cond & membership_or_null("aircraft_type", aircraft)
    if date_range_ is not None:
        cond = cond & date_range("booking_date", *date_range_)
    return df.where(cond)
