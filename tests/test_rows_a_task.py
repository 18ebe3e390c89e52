import pytest
from pyspark.sql import functions as F

from contrail.plans import queries as Q
from contrail.plans import views as V
from conftest import SF_SMALL
from helpers import plan_text, rows_of


@pytest.fixture
def large(spark, monkeypatch):
    """The smallest tables, taken for large ones: over a scan split, and no dimension broadcast."""
    def on(**conf):
        for k, v in {"spark.sql.files.maxPartitionBytes": "16k", "contrail.broadcast.maxBytes": "0"}.items():
            spark.conf.set(k, v)
        monkeypatch.setattr(V, "TASK_BYTES", 4096, raising=False)
    yield on
    for k in ("spark.sql.files.maxPartitionBytes", "contrail.broadcast.maxBytes"):
        spark.conf.unset(k)


def test_flights_of_large_tables_are_dealt_by_size_and_equal(spark, large):
    before = rows_of(Q.q_dedup_latest(spark, SF_SMALL))
    detail = rows_of(V.detail_view(spark, SF_SMALL).where(F.col("id").startswith("1")))
    large()
    df = Q.q_dedup_latest(spark, SF_SMALL)
    size = V.planned_bytes(V.read(spark, SF_SMALL, "lineitem"))
    assert size > 16 << 10 and f", {-(-size // 4096)}), REPARTITION_BY_NUM" in plan_text(df, "simple")
    assert rows_of(df) == before
    assert rows_of(V.detail_view(spark, SF_SMALL).where(F.col("id").startswith("1"))) == detail


def test_positions_are_dealt_before_they_are_sorted(spark, large):
    before = rows_of(V.position_feed(spark, SF_SMALL))
    large()
    df = V.position_feed(spark, SF_SMALL, for_sort=True)
    assert "REPARTITION_BY_NUM" in plan_text(df, "simple") and rows_of(df) == before


def test_presence_of_a_history_builds_no_leg(spark):
    df = V.detail_view(spark, SF_SMALL).select("id", F.col("aircraft_history").isNotNull().alias("has"))
    assert "https://" not in plan_text(df, "simple")
    n = {r.ln: r.n for r in V.detail_view(spark, SF_SMALL).select(F.split_part("id", F.lit("-"), F.lit(2)).alias("ln"),
         F.array_size("aircraft_history").alias("n")).distinct().collect()}
    assert n == {"1": 1, "2": 2, "3": 3, "4": 0, "5": 1, "6": 2, "7": None}


def test_groups_of_flights_grow_with_the_table(spark, monkeypatch):
    found, real = [], Q.active_changes
    monkeypatch.setattr(Q, "STATE_GROUP_BYTES", 3000, raising=False)
    monkeypatch.setattr(Q, "active_changes", lambda *a, **k: found.append(k.get("state_groups")) or real(*a, **k))
    rows = rows_of(Q.q_stream_active_flights(spark, SF_SMALL))
    assert len(set(found)) == 1 and found[0] > 32
    monkeypatch.undo()
    assert rows_of(Q.q_stream_active_flights(spark, SF_SMALL)) == rows
