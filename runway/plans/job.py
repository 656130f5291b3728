"""The whole batch run: extract -> clean -> warehouse -> checks, one driver program.

Stages hand over through parquet in the shared folder (raw, cleaned,
warehouse), as the reference's stages do through files and tables; each
write is one action, and later stages read columnar subsets of it.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runway import schemas as S
from runway.operators import checks as C
from runway.operators import quality
from runway.plans import cleaning
from runway.plans.stages import in_parallel
from runway.plans.warehouse import Warehouse
from runway.sources import readers, sinks

log = logging.getLogger(__name__)


@dataclass
class JobResult:
    cleaned: dict[str, DataFrame]
    rejects: dict[str, DataFrame]
    report: DataFrame
    tables: dict[str, DataFrame]
    checks: DataFrame
    final_report: DataFrame


def extract_raw(spark: SparkSession, config: dict, root: str) -> dict[str, DataFrame]:
    """Extract: read every configured source and write the raw zone, one parquet table per source.

    Disabled or unreadable sources (policy ``skip``) become empty tables of
    the source schema, so the later stages always find all five.  Records that
    could not be read are kept beside them and counted in the log by file.
    """
    rejects: dict[str, DataFrame] = {}
    frames = readers.extract_sources(spark, config, S.SOURCE_SCHEMAS, rejects)

    def land(name: str) -> DataFrame:
        landed = _land(frames[name], name, root)
        if name in rejects:
            bad_path = f"{root}/raw/{name}_unreadable"
            sinks.write_rejects(rejects[name], bad_path)
            bad = spark.read.schema(rejects[name].schema).parquet(bad_path)
            for row in bad.groupBy("file").count().collect():  # one row per file with such records
                log.error("%s: %d records cannot be read, see %s", row["file"], row["count"], bad_path)
        return landed

    # The sources are independent: their writes are submitted side by side.
    return in_parallel({name: (lambda name=name: land(name)) for name in frames})


def _land(df: DataFrame, name: str, root: str) -> DataFrame:
    """A source in the raw zone."""
    path = f"{root}/raw/{name}_raw"
    sinks.write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_all(spark: SparkSession, raw: dict[str, DataFrame], root: str, exact: bool = True,
              workers: int = 5):
    """T1-T5, with the cleaned zone, the reject tables and the reports written under ``root``.

    Each cleaned table is validated (A2) where its pipeline ends: rows, duplicates, empty rows, NULLs per column.
    """

    def clean_one(name: str):
        out = cleaning.TRANSFORMS[name](raw[name], exact=exact)
        path = f"{root}/cleaned/{name}_clean"
        sinks.write_parquet(out.clean, path)
        clean = spark.read.schema(out.clean.schema).parquet(path)
        rejected = None
        if name in ("bookings", "flights", "maintenance"):
            rpath = f"{root}/cleaned/{name}_rejected"
            sinks.write_rejects(out.rejects, rpath)
            rejected = spark.read.schema(out.rejects.schema).parquet(rpath)
        fpath = f"{root}/reports/final_report/{name}"
        sinks.write_parquet(quality.validate_results(clean, name, S.REQUIRED[name]), fpath)
        return clean, rejected, out.report

    done = in_parallel({n: (lambda n=n: clean_one(n)) for n in cleaning.TRANSFORMS}, workers)
    cleaned = {n: done[n][0] for n in cleaning.TRANSFORMS}
    rejects = {n: done[n][1] for n in cleaning.TRANSFORMS if done[n][1] is not None}
    report = cleaning.report_frame(spark, [done[n][2] for n in cleaning.TRANSFORMS])
    sinks.write_report(report, f"{root}/reports/quality_report")
    report = sinks.read_report(spark, f"{root}/reports/quality_report", cleaning.SOURCE_REPORT)
    final = spark.read.schema(quality.REPORT_SCHEMA).parquet(*[f"{root}/reports/final_report/{n}" for n in cleaning.TRANSFORMS])
    return cleaned, rejects, report, final


def quality_checks(t: dict[str, DataFrame]) -> DataFrame:
    """The reference's sixteen warehouse assertions plus declared-constraint and orphan checks.

    Row-level checks of one table share one aggregate pass (a fact is scanned
    once for them); key uniqueness is a grouped count; checks through a
    dimension share one join per dimension.
    """
    fb, ff = t["fact_bookings"], t["fact_flights"]
    price, ref = F.col("ticket_price"), F.col("booking_ref")
    code = F.col("airport_code")
    flights_named = ff.select(F.col("flight_id").alias("_k")).join(
        t["dim_flights"].select(F.col("flight_id").alias("_k"), "flight_number"), "_k")
    number = F.col("flight_number")
    suite = [
        C.row_checks(t["dim_airports"], {"airport_codes_format": (F.length(code) != 3) | ~code.rlike("^[A-Z]{3}$")},
                     "dim_airports_not_empty"),
        C.not_empty(t["dim_aircraft"], "dim_aircraft_not_empty"),
        C.not_empty(t["dim_dates"], "dim_dates_not_empty"),
        C.not_empty(ff, "fact_flights_not_empty"),
        C.row_checks(fb, {"flight_prices_positive": (price < 0) | price.isNull(),
                          "no_null_booking_refs": ref.isNull()}, "fact_bookings_not_empty"),
        C.unique_key(t["dim_airports"], "no_duplicate_airports", ["airport_code"]),
        C.unique_key(t["dim_aircraft"], "no_duplicate_aircraft", ["aircraft_code"]),
        C.unique_key(t["dim_dates"], "no_duplicate_dates", ["date_id"]),
        C.date_in_range(ff, t["dim_dates"], "flight_dates_valid", "flight_date_id", "2020-01-01", "2030-12-31"),
        C.row_checks(flights_named, {"flight_numbers_format": number.isNull() | (F.length(number) < 2),
                                     "no_null_flight_numbers": number.isNull()}),
        C.allowed_values(fb, t["dim_statuses"], "booking_status_values", "status_id", "status_id", "status_code",
                         S.VALID_BOOKING_STATUSES),
        C.allowed_values(ff, t["dim_statuses"], "flight_status_values", "status_id", "status_id", "status_code",
                         S.VALID_FLIGHT_STATUSES),
    ]
    return C.run_suite([*suite, constraint_checks(t)])


def constraint_checks(t: dict[str, DataFrame]) -> DataFrame:
    """The schema's constraints and the facts without a status, every table read once."""
    mandatory = {f"orphan_{n}_status": (f"fact_{n}", "status_id") for n in ("bookings", "flights", "maintenance")}
    return C.declared_constraints(t, S.CONSTRAINTS, S.PARENT_KEYS, mandatory)


def run_from_config(spark: SparkSession, config: dict, root: str, exact: bool = True,
                    partition_facts: bool = False) -> JobResult:
    """Extract -> transform -> load -> test, as the reference's four scripts in order."""
    return run(spark, extract_raw(spark, config, root), root, exact, partition_facts=partition_facts, landed=True)


def run(spark: SparkSession, raw: dict[str, DataFrame], root: str, exact: bool = True,
        workers: int = 5, partition_facts: bool = False, landed: bool = False) -> JobResult:
    """Transform, load and test; independent stages run concurrently (``workers=1``: one at a time).

    Sources that are not ``landed`` in the raw zone yet are written there first, so every later step scans files.
    Staged tables of the run are deleted at its end.

    ``partition_facts`` stores the facts in date-key folders (see ``Warehouse``), the layout to use
    on a cluster; it is off by default because small local runs only pay its file-listing cost.
    """
    with sinks.scratch(spark):
        if not landed:
            raw = in_parallel({n: (lambda n=n: _land(raw[n], n, root)) for n in raw}, workers)
        cleaned, rejects, report, final_report = clean_all(spark, raw, root, exact, workers)
        wh = Warehouse(spark, f"{root}/dwh", partition_facts=partition_facts)
        tables = wh.load(cleaned["bookings"], cleaned["flights"], cleaned["maintenance"], cleaned["weather"],
                         workers=workers)
    return JobResult(cleaned, rejects, report, tables, quality_checks(tables), final_report)
