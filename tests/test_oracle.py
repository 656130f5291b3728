"""Every registered query against its DuckDB oracle on the smallest driver tables (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
import tools.check_oracle as checker
from runway.plans import registry
from tools.check_oracle import TABLES, digest
from tools.plan_audit import audit, plan_text

checker.EXACT = True  # floats compared bit for bit, as a value hash would

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    import duckdb
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["flight_id", "date_id", "total_revenue", "passenger_count", "avg_ticket_price",
                          "confirmed_count", "cancelled_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = sorted(set(registry.QUERIES) - set(E.oracle_sql()))
    assert missing == []


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    # Plan shape: no Cartesian or nested-loop join, no window or sort funnelled into one
    # partition, no Python step.
    shape = audit(plan_text(df))
    assert (shape["cross"], shape["single"], shape["python"]) == (0, 0, 0), shape
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]
