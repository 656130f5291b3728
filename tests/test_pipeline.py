"""End to end on the small fixtures: clean five sources, load the warehouse twice, run the checks."""

import os

from runway import schemas as S
from runway.plans import job, marts
from runway.plans.cleaning import transform_maintenance
from runway.sources import readers
from tests.fixtures import FLIGHTS_CSV, MAINTENANCE_CSV, WEATHER_JSON, bookings_df, logs_df, write_text


def _raw(spark, tmp_dir):
    flights = readers.read_csv_files(spark, [write_text(os.path.join(tmp_dir, "in/f.csv"), FLIGHTS_CSV)],
                                     [f.name for f in S.FLIGHTS_REPORT.fields], S.FLIGHTS_REPORT)
    maint = readers.read_csv_files(spark, [write_text(os.path.join(tmp_dir, "in/m.csv"), MAINTENANCE_CSV)],
                                   [f.name for f in S.MAINTENANCE.fields], S.MAINTENANCE)
    weather = readers.read_json(spark, [write_text(os.path.join(tmp_dir, "in/w.json"), WEATHER_JSON)], S.WEATHER)
    return {"bookings": bookings_df(spark), "flights": flights, "maintenance": maint, "logs": logs_df(spark),
            "weather": weather}


def test_end_to_end(spark, tmp_dir):
    root = os.path.join(tmp_dir, "run")
    res = job.run(spark, _raw(spark, tmp_dir), root)
    rep = {r.source: r for r in res.report.collect()}
    b = rep["bookings"]
    assert (b.initial_rows, b.final_rows, b.rejected_rows, b.duplicates_removed) == (10, 8, 1, 2)
    assert b.fill_report["ticket_price"].method == "median"
    # known prices after dedupe: 3100 3300 5200 7400 7900 8100
    assert b.fill_report["ticket_price"].value == "6300.0" and b.fill_report["ticket_price"].filled == 2
    assert rep["maintenance"].rejected_rows == 1 and rep["maintenance"].final_rows == 3
    assert rep["weather"].outliers_report["temperature"]["count"] == 1

    clean = res.cleaned["bookings"]
    assert sorted(r.flight_number for r in clean.collect()) == [
        "DP410", "DP410", "DP411", "N477", "N477", "N478", "WZ900", "WZ901"]
    assert {r.departure_airport for r in clean.collect()} == {"KZN", "AER", "OVB", "KJA", "UFA", "ROV"}
    assert clean.where("currency <> 'EUR' OR status NOT IN ('confirmed', 'cancelled', 'pending', 'completed')").count() == 0

    t = res.tables
    assert sorted(r.airport_code for r in t["dim_airports"].collect()) == ["AER", "KJA", "KZN", "OVB", "ROV", "UFA"]
    assert t["dim_passengers"].count() == 5 and t["fact_bookings"].count() == 8
    delays = [r.delay_minutes for r in t["fact_flights"].collect()]
    assert sorted(d for d in delays if d is not None) == [0, 0, 12, 30]
    rev = t["fact_revenue"].collect()
    assert all(r.cancelled_count == 0 for r in rev) and sum(r.passenger_count for r in rev) == 6

    checks = {r.check: r for r in res.checks.collect()}
    assert checks["no_duplicate_airports"].passed and checks["airport_codes_format"].passed
    assert checks["fk_fact_bookings_flight_id"].passed and checks["flight_status_values"].passed
    assert checks["orphan_maintenance_status"].passed  # 'completed' is among the added pairs

    view = marts.bookings_view(t).collect()
    assert len(view) == 8 and view[0].booking_date >= view[-1].booking_date

    # A second load of the same sources leaves every dimension as it was.
    before = {n: sorted(tuple(r) for r in t[n].collect()) for n in ("dim_airports", "dim_flights", "dim_passengers")}
    again = job.run(spark, _raw(spark, tmp_dir), root)
    after = {n: sorted(tuple(r) for r in again.tables[n].collect()) for n in before}
    assert before == after


def test_maintenance_cleaning(spark, tmp_dir):
    maint = readers.read_csv_files(spark, [write_text(os.path.join(tmp_dir, "m.csv"), MAINTENANCE_CSV)],
                                   [f.name for f in S.MAINTENANCE.fields], S.MAINTENANCE)
    out = transform_maintenance(maint)
    rows = {r.aircraft_code: r for r in out.clean.collect()}
    assert set(rows) == {"B737", "A320", "B777"}
    assert rows["A320"].maintenance_type == "fueling" and rows["B777"].status == "in_progress"
    assert rows["A320"].cost == 525000.0  # median of 150000 and 900000
    assert rows["B777"].scheduled_date is None and rows["A320"].description == "engine mount"


def test_job_runs_on_empty_sources(spark, tmp_dir):
    raw = {name: spark.createDataFrame([], schema) for name, schema in S.SOURCE_SCHEMAS.items()}
    res = job.run(spark, raw, os.path.join(tmp_dir, "empty"))
    rep = {r.source: r for r in res.report.collect()}
    assert all(r.final_rows == 0 for r in rep.values())
    assert rep["bookings"].completeness_before is None
    assert all(res.tables[n].count() == 0 for n in ("dim_airports", "fact_bookings", "fact_revenue"))
    checks = {r.check: r for r in res.checks.collect()}
    assert checks["dim_airports_not_empty"].violations == 1 and checks["no_duplicate_airports"].passed


def test_dashboard_charts(spark, tmp_dir):
    res = job.run(spark, _raw(spark, tmp_dir), os.path.join(tmp_dir, "dash"))
    charts = marts.dashboard(res.tables, res.report, statuses=["confirmed"], price_range=(0, 50000))
    counts = {k: v.count() for k, v in charts.items()}
    assert counts["booking_status_counts"] == 1 and counts["kpis"] == 4 and counts["quality_summary"] == 5
    assert counts["flights_table"] == 6 and counts["price_histogram"] >= 1
    kp = {r.metric: r.value for r in charts["kpis"].collect()}
    assert kp["total_bookings"] == 8.0 and kp["total_flights"] == 6.0


def test_command_line_with_reference_config(spark, tmp_dir):
    from runway.__main__ import main
    from runway.sources import sinks
    f = write_text(os.path.join(tmp_dir, "in/flights.csv"), FLIGHTS_CSV)
    m = write_text(os.path.join(tmp_dir, "in/maint.csv"), MAINTENANCE_CSV)
    w = write_text(os.path.join(tmp_dir, "in/weather.json"), WEATHER_JSON)
    logs_path = os.path.join(tmp_dir, "in/logs")
    sinks.write_json_array(logs_df(spark), logs_path)
    conf = write_text(os.path.join(tmp_dir, "config.yaml"), f"""
sources:
  postgres: {{enabled: false, host: db, port: 5434, database: booking_db, table: raw_bookings}}
  csv_flights: {{enabled: true, files: ['{f}', '{tmp_dir}/in/missing.csv']}}
  csv_maintenance: {{enabled: true, files: ['{m}']}}
  json_logs: {{enabled: true, file: '{logs_path}'}}
  api_weather: {{enabled: true, file: '{w}'}}
processing:
  on_validation_error: skip
""")
    out = os.path.join(tmp_dir, "cli")
    # Bookings are switched off, so fact_bookings is empty and its not-empty check fails.
    assert main(["--config", conf, "--out", out]) == 1
    raw = spark.read.parquet(f"{out}/raw/flights_raw")
    assert raw.count() == 6 and spark.read.parquet(f"{out}/raw/logs_raw").count() == 3
    assert spark.read.parquet(f"{out}/raw/bookings_raw").count() == 0


def test_date_partitioned_facts_prune(spark, tmp_dir):
    from pyspark.sql import functions as F
    plain = job.run(spark, _raw(spark, tmp_dir), os.path.join(tmp_dir, "plain"))
    parted = job.run(spark, _raw(spark, tmp_dir), os.path.join(tmp_dir, "parted"), partition_facts=True)
    for name in ("fact_bookings", "fact_flights", "fact_revenue"):
        a = sorted(repr(tuple(r[c] for c in sorted(plain.tables[name].columns))) for r in plain.tables[name].collect())
        b = sorted(repr(tuple(r[c] for c in sorted(parted.tables[name].columns))) for r in parted.tables[name].collect())
        assert a == b, name
    assert os.path.isdir(os.path.join(tmp_dir, "parted/dwh/fact_flights/flight_date_id=20240305"))
    t = parted.tables
    q = (t["fact_flights"].join(t["dim_dates"].where(F.col("day") == 10),
                                F.col("flight_date_id") == F.col("date_id")).select("flight_instance_id"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    assert q.count() == 1
