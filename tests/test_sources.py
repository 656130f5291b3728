"""Readers and sinks: header check, skip/fail policy, JSON arrays, source switch, staged overwrite."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runway import schemas as S
from runway.sources import readers, sinks
from tests.fixtures import FLIGHTS_CSV, MAINTENANCE_CSV, WEATHER_JSON, write_text


def test_jdbc_options_build_parallel_reads():
    opts = readers.jdbc_options({"host": "db", "port": 5434, "database": "booking_db", "table": "raw_bookings",
                                 "user": "u", "password": "p", "partition_column": "id", "lower_bound": 1,
                                 "upper_bound": 1000, "num_partitions": 8})
    assert opts["url"] == "jdbc:postgresql://db:5434/booking_db"
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "8" and opts["dbtable"] == "raw_bookings"


@pytest.mark.parametrize("cuts", [[5], [-3, 0, 4, 4, 90], readers.jdbc_cuts(-10, 99, 7)])
def test_every_row_meets_one_jdbc_predicate(spark, cuts):
    ids = spark.range(-10, 100).select(F.col("id").alias("the id")).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("the id")))
    predicates = [p.replace('"', "`") for p in readers.jdbc_predicates("the id", cuts)]
    assert len(predicates) == len(set(cuts)) + 1
    hits = ids.select(sum(F.expr(f"CAST(coalesce({p}, false) AS INT)") for p in predicates).alias("n"))
    assert {r.n for r in hits.collect()} == {1}


def test_jdbc_scan_is_planned_from_the_table(monkeypatch):
    monkeypatch.setattr(readers, "JDBC_TASK_ROWS", 100)
    asked = []

    def table(lo, hi, n, cuts=()):
        def read(query):
            asked.append(query)
            return [{"cut": c} for c in cuts] if "TABLESAMPLE" in query else [{"lo": lo, "hi": hi, "n": n}]
        return readers.plan_jdbc_scan(read, "raw_bookings", "id")

    assert table(1, 400, 400) == ['"id" < 101 OR "id" IS NULL', '"id" >= 101 AND "id" < 201', '"id" >= 201 AND "id" < 301', '"id" >= 301']
    sparse = table(1, 10 ** 12, 250, [7, 80, 10 ** 12])
    assert sparse == ['"id" < 7 OR "id" IS NULL', '"id" >= 7 AND "id" < 80', '"id" >= 80']
    assert "TABLESAMPLE SYSTEM (100.000000)" in asked[-1] and "ntile(3)" in asked[-1]
    assert table(None, None, 0) == [] and table(5, 9, 4) == []


def test_validate_columns():
    ok, missing, extra = readers.validate_columns(["a", "b", "x"], ["a", "b", "c"])
    assert not ok and missing == ["c"] and extra == ["x"]
    assert readers.validate_columns(["b", "a", "x"], ["a", "b"]) == (True, [], ["x"])


def test_csv_header_check_skip_and_fail(spark, tmp_dir):
    good = write_text(os.path.join(tmp_dir, "f1.csv"), FLIGHTS_CSV)
    reordered = write_text(os.path.join(tmp_dir, "f2.csv"),
                           "status,flight_date,flight_number,departure,arrival,scheduled_departure,scheduled_arrival,"
                           "actual_departure,actual_arrival,aircraft_id,extra\n"
                           "landed,2024-02-05,SU300,SVO,KZN,2024-02-05 08:00:00,2024-02-05 10:00:00,"
                           "2024-02-05 08:05:00,2024-02-05 10:01:00,A321,x\n")
    bad = write_text(os.path.join(tmp_dir, "f3.csv"), "flight_date,flight_number\n2024-02-01,SU1\n")
    expected = [f.name for f in S.FLIGHTS_REPORT.fields]
    df = readers.read_csv_files(spark, [good, reordered, bad, os.path.join(tmp_dir, "nope.csv")], expected,
                                S.FLIGHTS_REPORT, on_error="skip")
    rows = df.collect()
    assert len(rows) == 7 and df.columns == expected
    su300 = [r for r in rows if r.flight_number == "SU300"][0]
    assert su300.status == "landed" and su300.aircraft_id == "A321"
    assert sum(r.actual_departure is None for r in rows) == 2
    with pytest.raises(readers.SourceError):
        readers.read_csv_files(spark, [good, bad], expected, S.FLIGHTS_REPORT, on_error="fail")


def test_json_array_file(spark, tmp_dir):
    path = write_text(os.path.join(tmp_dir, "weather.json"), WEATHER_JSON)
    df = readers.read_json(spark, [path], S.WEATHER)
    assert df.count() == 4 and df.where("airport_code = 'pulkovo'").first().humidity == 85


def test_extract_sources_switch_and_missing(spark, tmp_dir):
    flights = write_text(os.path.join(tmp_dir, "flights.csv"), FLIGHTS_CSV)
    maint = write_text(os.path.join(tmp_dir, "maint.csv"), MAINTENANCE_CSV)
    config = {"sources": {"flights": {"enabled": True, "format": "csv", "files": [flights]},
                          "maintenance": {"enabled": True, "format": "csv", "files": [maint, "/nope/m.csv"]},
                          "logs": {"enabled": True, "format": "json", "files": ["/nope/logs.json"]},
                          "bookings": {"enabled": False}},
              "processing": {"on_validation_error": "skip"}}
    out = readers.extract_sources(spark, config, S.SOURCE_SCHEMAS)
    assert out["flights"].count() == 6 and out["maintenance"].count() == 4
    assert out["logs"].count() == 0 and out["bookings"].count() == 0 and out["weather"].count() == 0
    config["processing"]["on_validation_error"] = "fail"
    with pytest.raises(readers.SourceError):
        readers.extract_sources(spark, config, S.SOURCE_SCHEMAS)


def test_overwrite_table_reads_itself(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    sinks.overwrite_table(spark.range(5), path)
    cur = spark.read.parquet(path)
    sinks.overwrite_table(cur.selectExpr("id * 10 AS id"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 10, 20, 30, 40]
    assert sinks.read_table(spark, os.path.join(tmp_dir, "none"), S.DIM_AIRPORTS).count() == 0


class FailingSwap:
    """A file system whose second rename reports failure the way Hadoop does: by returning false."""

    def __init__(self, fs):
        self.fs, self.renames = fs, 0

    def rename(self, a, b):
        self.renames += 1
        return False if self.renames == 2 else self.fs.rename(a, b)

    def delete(self, *args):
        return self.fs.delete(*args)


def test_a_failed_rename_keeps_the_old_table(spark, tmp_dir):
    fs, Path = sinks._fs(spark, tmp_dir)
    paths = [f"{tmp_dir}/{n}" for n in ("staging", "table", "old")]
    spark.range(3).write.parquet(paths[0])
    spark.range(5).write.parquet(paths[1])
    with pytest.raises(OSError):
        sinks.swap_in(FailingSwap(fs), *map(Path, paths))
    assert spark.read.parquet(paths[1]).count() == 5 and spark.read.parquet(paths[0]).count() == 3
    sinks.swap_in(fs, *map(Path, paths))
    assert spark.read.parquet(paths[1]).count() == 3 and not fs.exists(Path(paths[2]))


def test_sql_scan(spark):
    df = readers.sql(spark, "SELECT count(*) AS n FROM {t} WHERE id > 2", t=spark.range(10))
    assert df.first().n == 7


def test_header_fallback_through_spark(spark, tmp_dir):
    path = write_text(os.path.join(tmp_dir, "h x.csv"), "\ufeffa,b\n1,2\n")
    other = write_text(os.path.join(tmp_dir, "i.csv"), "c\n")
    assert readers._headers_through_spark(spark, [f"file:{path}", other]) == {f"file:{path}": "a,b", other: "c"}
    assert readers._headers_through_spark(spark, ["/nope/x.csv"]) == {"/nope/x.csv": None}
    assert readers._arrow_uri("s3a://bucket/x.csv") == "s3://bucket/x.csv"


def test_a_header_of_any_length_is_read_whole(spark, tmp_dir):
    names = [f"another_column_{i}" for i in range(10_000)] + ["a"]
    path = write_text(os.path.join(tmp_dir, "wide.csv"), ",".join(names) + "\n" + ",".join(["x"] * 10_000) + ",7\n")
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert [r.a for r in readers.read_csv_files(spark, [path], ["a"], schema).collect()] == [7]


CSV_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("said", T.StringType()), T.StructField("at", T.TimestampNTZType()),
                           T.StructField("price", T.DoubleType())])


@pytest.mark.parametrize("broken", [True, False])
def test_quoted_text_missing_cells_and_wrong_widths(spark, tmp_dir, broken):
    text = ('id,"said",at,price\n1,"said ""ok"", then left",2024-02-01T09:00:00,1.5\n3,NA,2024-02-01 09:00,n/a\n4,x\n'
            "5,a,2024-02-01 09:00:00.500,1,too much,more\n6,,01.02.2024 9:05,x\n7.0,None,garbage,-3\n")
    text += '2,"a line\nbreak",2024/02/01,NULL\n' if broken else "2,plain,2024/02/01,\n"
    path = write_text(os.path.join(tmp_dir, "q.csv"), text)
    rows, rejects = readers.read_csv_parts(spark, [path], CSV_SCHEMA.names, CSV_SCHEMA)
    got = {r.id: (r.said, str(r.at), r.price) for r in rows.collect()}
    nine = "2024-02-01 09:00:00"
    assert got == {1: ('said "ok", then left', nine, 1.5), 3: (None, nine, None), 4: ("x", "None", None), 6: (None, "2024-02-01 09:05:00", None),
                   7: (None, "None", -3.0), 2: ("a line\nbreak" if broken else "plain", "2024-02-01 00:00:00", None)}
    assert [r.record for r in rejects.collect()] == ["5,a,2024-02-01 09:00:00.500,1,too much,more"]
    assert rejects.first().file.endswith("q.csv")
    with pytest.raises(readers.SourceError):
        readers.read_csv_parts(spark, [path], CSV_SCHEMA.names, CSV_SCHEMA, "fail")


def test_a_bad_json_cell_costs_that_cell_and_extra_fields_stay(spark, tmp_dir):
    array = write_text(os.path.join(tmp_dir, "w.json"), '''[
      {"airport_code": "SVO", "timestamp": "2024-02-01T09:00:00Z", "temperature": "n/a", "humidity": 80.5, "station": {"id": 4}},
      {"airport_code": "LED", "temperature": -3, "humidity": 71, "note": "dry"}]''')
    cut = write_text(os.path.join(tmp_dir, "cut.json"), '[{"airport_code": "OVB", "temp')
    rows, rejects = readers.read_json_parts(spark, [array, cut], S.WEATHER)
    got = {r.airport_code: r for r in rows.collect()}
    assert rows.count() == 2 and rows.columns[-2:] == ["note", "station"]
    assert (got["SVO"].temperature, got["SVO"].humidity, json.loads(got["SVO"].station)) == (None, 80, {"id": 4})
    assert (got["LED"].temperature, got["LED"].humidity, got["LED"].note) == (-3.0, 71, "dry")
    assert [os.path.basename(r.file) for r in rejects.collect()] == ["cut.json"]
    lines = write_text(os.path.join(tmp_dir, "l.json"), '{"level": "info", "host": "a"}\n{"level": \n{"level": "warn"}\n')
    rows, rejects = readers.read_json_parts(spark, [lines], S.LOGS, json_array=False)
    assert sorted((r.level, r.host) for r in rows.collect()) == [("info", "a"), ("warn", None)] and rejects.count() == 1
    with pytest.raises(readers.SourceError):
        readers.read_json_parts(spark, [lines], S.LOGS, "fail", json_array=False)


def test_unreadable_records_are_kept_and_extra_fields_reach_the_cleaned_logs(spark, tmp_dir):
    from runway.plans import cleaning, job
    logs = write_text(os.path.join(tmp_dir, "l.json"), '{"level": " info", "timestamp": "2024-02-01 10:00", "host": "a"}\nnot json\n')
    config = {"sources": {"logs": {"enabled": True, "format": "json", "files": [logs], "json_array": False}}}
    raw = job.extract_raw(spark, config, os.path.join(tmp_dir, "run"))
    assert spark.read.parquet(os.path.join(tmp_dir, "run/raw/logs_unreadable")).count() == 1
    clean = cleaning.transform_logs(raw["logs"]).clean.first()
    assert (clean.level, clean.host, str(clean.timestamp)) == ("INFO", "a", "2024-02-01 10:00:00")


def test_reference_config_layout(tmp_dir):
    from runway import config
    text = """
sources:
  postgres: {enabled: false, host: db, port: 5434, database: booking_db, user: u, password: p, table: raw_bookings}
  csv_flights: {enabled: true, files: [/data/a.csv, /data/b.csv]}
  csv_maintenance: {enabled: true, files: [/data/m.csv]}
  json_logs: {enabled: true, file: /data/logs.json}
  api_weather: {enabled: false, file: /data/weather.json}
processing:
  on_validation_error: fail
"""
    path = write_text(os.path.join(tmp_dir, "config.yaml"), text)
    conf = config.load(path)
    s = conf["sources"]
    assert s["flights"] == {"enabled": True, "format": "csv", "files": ["/data/a.csv", "/data/b.csv"]}
    assert s["logs"]["files"] == ["/data/logs.json"] and s["logs"]["format"] == "json"
    assert s["bookings"]["format"] == "jdbc" and s["bookings"]["host"] == "db" and not s["bookings"]["enabled"]
    assert conf["processing"]["on_validation_error"] == "fail"
