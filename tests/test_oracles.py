"""Every registered query against its DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E
from contrail.plans.oracle import ORACLE
from contrail.plans.queries import QUERIES
from helpers import rows_of

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    from check_oracles import kinds_differ
    assert not kinds_differ(df, cur.description)
    from helpers import norm
    want = sorted((tuple(norm(r[dcols.index(c)]) for c in sorted(dcols)) for r in cur.fetchall()), key=repr)
    assert rows_of(df) == want


def test_fixture_holds_the_dirt():
    """The edge cases the operators promise to survive are in the feed, so the oracles exercise them."""
    from contrail.plans.oracle import FLIGHTS, w
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.01/{t}.parquet')")
    total, *dirty = con.execute(w(FLIGHTS) + """SELECT count(*), count(*) FILTER (airline_icao IS NULL),
      count(*) FILTER (airline_icao = ''), count(*) FILTER (airline_icao = 'N/A'), count(*) FILTER (destination_airport_iata IS NULL),
      count(*) FILTER (aircraft_model IS NULL), count(*) FILTER (historical_flighttime IS NULL),
      count(*) FILTER (scheduled_time_arrival IS NULL AND estimated_arrival IS NULL), count(*) FILTER (origin_airport_iata = 'HUB')
      FROM flights""").fetchone()
    for n in dirty:
        assert 0 < n < total


def test_stream_counts_on_a_folder_of_parts(spark, tmp_path):
    want = rows_of(E.queries()["stream_active_counts"](spark, SF))
    spark.read.parquet(f"{SF}/events.parquet").repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    assert rows_of(E.queries()["stream_active_counts"](spark, str(tmp_path))) == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["airline_name", "airline_iata", "total_active_flights"]
