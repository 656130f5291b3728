"""Scalar column functions (string, numeric, date).

Every function maps Column -> Column and stays inside Catalyst, so it is
code-generated and runs on the executors; no Python UDF is involved.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

#: Every character that Unicode calls white space.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# ---- Fixed values: these must equal the reference's lookup tables. --------
# Airport names and codes, lower-case key -> IATA code.
AIRPORT_CODES = {
    "sheremetyevo": "SVO", "svo": "SVO",
    "pulkovo": "LED", "led": "LED",
    "domodedovo": "DME", "dme": "DME",
    "koltsovo": "SVX", "svx": "SVX",
    "kazan": "KZN", "kzn": "KZN",
    "tolmachevo": "OVB", "ovb": "OVB",
    "adler": "AER", "aer": "AER",
    "emelyanovo": "KJA", "kja": "KJA",
    "ufa": "UFA",
    "rostov": "ROV", "rov": "ROV",
}

# Maintenance type remap; every known type maps to itself.
MAINTENANCE_TYPES = {
    "technical_inspection": "technical_inspection",
    "fueling": "fueling",
    "scheduled_maintenance": "scheduled_maintenance",
    "repair": "repair",
    "engine_check": "engine_check",
    "cabin_check": "cabin_check",
}

# Weekday names in English and their Russian labels, Monday first.
DAY_NAMES_RU = {
    "Monday": "Понедельник", "Tuesday": "Вторник", "Wednesday": "Среда",
    "Thursday": "Четверг", "Friday": "Пятница", "Saturday": "Суббота",
    "Sunday": "Воскресенье",
}

# Texts that stand for a missing cell in CSV files, as pandas reads them by default.
MISSING_TEXTS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
                 "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# Written forms of times beside the ISO ones; month first where slashes leave it open, as pandas has it.
TIME_FORMS = ["d.M.yyyy[ H:mm[:ss]]", "M/d/yyyy[ H:mm[:ss]]", "yyyy/M/d[ H:mm[:ss]]", "yyyyMMdd[ HHmmss]",
              "d MMM yyyy[ H:mm[:ss]]", "MMM d, yyyy[ H:mm[:ss]]"]
# ---------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _map_literal(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def strip_ws(c: ColumnOrName) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` alone strips spaces only)."""
    return F.btrim(_c(c), F.lit(WHITE_SPACE))


def normalize_airport(c: ColumnOrName) -> Column:
    """Trimmed lower-case lookup in the airport table, else upper-case text; NULL stays NULL."""
    s = strip_ws(c)
    return F.coalesce(F.element_at(_map_literal(AIRPORT_CODES), F.lower(s)), F.upper(s))


def normalize_flight_number(c: ColumnOrName) -> Column:
    """Upper-case, remove the space character (only spaces); NULL stays NULL."""
    return F.translate(F.upper(_c(c)), " ", "")


def lower_trim(c: ColumnOrName) -> Column:
    """N3 for statuses and maintenance types."""
    return F.lower(strip_ws(c))


def upper_trim(c: ColumnOrName) -> Column:
    """N3 for currency, log level and aircraft code."""
    return F.upper(strip_ws(c))


def remap_or_self(c: ColumnOrName, mapping: dict[str, str] = MAINTENANCE_TYPES) -> Column:
    """Value through a lookup, falling back to the value itself."""
    col = _c(c)
    return F.coalesce(F.element_at(_map_literal(mapping), col), col)


def safe_timestamp(c: ColumnOrName) -> Column:
    """Text to timestamp in any of the known written forms, NULL for text in none of them (ANSI-safe)."""
    text = strip_ws(_c(c).cast("string"))
    # A four-digit year first: longer ones and bare times of day would be read as dates, too.
    iso = F.when(F.substring(text, 5, 1).isin("-", ""), F.try_to_timestamp(text))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(form)) for form in TIME_FORMS])


def safe_date(c: ColumnOrName) -> Column:
    """N6 reduced to a date (maintenance dates)."""
    return F.to_date(safe_timestamp(c))


def missing_to_null(c: ColumnOrName) -> Column:
    """NULL for the texts that stand for a missing cell."""
    return F.when(~_c(c).isin(MISSING_TEXTS), _c(c))


def parse_cell(c: ColumnOrName, kind: T.DataType) -> Column:
    """A text cell as ``kind``; text that does not parse costs that cell only (NULL)."""
    if isinstance(kind, T.StringType):
        return _c(c)
    if isinstance(kind, T.DateType):
        return safe_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return safe_timestamp(c).cast(kind)
    text = strip_ws(c)
    if isinstance(kind, T.IntegralType):
        return F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
    return text.try_cast(kind)


def safe_double(c: ColumnOrName) -> Column:
    """Text to double, NULL for text that does not parse."""
    return _c(c).try_cast("double")


def to_date(c: ColumnOrName) -> Column:
    """N8."""
    return F.to_date(_c(c))


def date_key(c: ColumnOrName) -> Column:
    """Date -> yyyymmdd integer, computed arithmetically (no string round trip)."""
    d = F.to_date(_c(c))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def calendar_columns(c: ColumnOrName) -> dict[str, Column]:
    """The calendar attributes of dim_dates for a date column."""
    d = F.to_date(_c(c))
    return {
        "date_id": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
        "is_weekend": F.weekday(d) >= 5,
    }


def delay_minutes(scheduled: ColumnOrName, actual: ColumnOrName) -> Column:
    """Whole minutes late, negative clipped to 0, NULL when a time is missing."""
    s, a = _c(scheduled), _c(actual)
    return F.when(s.isNotNull() & a.isNotNull(),
                  F.greatest(F.timestamp_diff("MINUTE", s, a), F.lit(0)).cast("int"))


def signed_delay_minutes(scheduled: ColumnOrName, actual: ColumnOrName) -> Column:
    """Signed fractional minutes between two timestamps."""
    return F.timestamp_diff("MICROSECOND", _c(scheduled), _c(actual)) / F.lit(60_000_000.0)


def day_name(c: ColumnOrName) -> Column:
    """English weekday name."""
    return F.date_format(F.to_date(_c(c)), "EEEE")


def day_label_ru(name: ColumnOrName) -> Column:
    """Russian label of an English weekday name."""
    return F.element_at(_map_literal(DAY_NAMES_RU), _c(name))


def day_name_ru(c: ColumnOrName) -> Column:
    """Russian weekday label of a date."""
    return day_label_ru(day_name(c))


def percent_text(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Share as text with one decimal, half-to-even like pandas, e.g. '12.5%'."""
    pct = F.bround(F.try_divide(_c(part) * 100.0, _c(whole)), 1)
    return F.concat(F.format_string("%.1f", pct), F.lit("%"))


def default_if_null(c: ColumnOrName, default) -> Column:
    """N15."""
    return F.coalesce(_c(c), F.lit(default))


def null_count(cols: list[ColumnOrName], nan_cols: set[str] | None = None) -> Column:
    """Number of NULL (and NaN, for floating columns) cells in a row."""
    nan_cols = nan_cols or set()
    parts = []
    for c in cols:
        col = _c(c)
        missing = col.isNull()
        if isinstance(c, str) and c in nan_cols:
            missing = missing | F.isnan(col)
        parts.append(missing.cast("int"))
    if not parts:
        return F.lit(0)
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total
