import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators.sequence import with_neighbor
from helpers import plan_text

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, n int, v string"


def _plain(df, direction):
    rank = [F.col("ts").asc_nulls_first(), F.col("n").asc_nulls_first()]
    w = Window.partitionBy("k").orderBy(*rank)
    shift = F.lag if direction == "prev" else F.lead
    return df.select("*", shift("v").over(w).alias("x_v"), shift("n").over(w).alias("x_n"))


def _feed(spark, seed=0):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([None, T0 + dt.timedelta(minutes=rng.randint(0, 50))]), i, f"v{i}")
            for i in range(600)]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


@pytest.mark.parametrize("direction", ["prev", "next"])
@pytest.mark.parametrize("pieces", [None, 1, 3, 40])
def test_equals_plain_window(spark, direction, pieces):
    df = _feed(spark)
    got = with_neighbor(df, ["k"], ["ts", "n"], ["v", "n"], direction, prefix="x_", pieces=pieces)
    key = lambda r: repr((r.k, r.ts, r.n, r.v, r.x_v, r.x_n))
    assert sorted(map(key, got.collect())) == sorted(map(key, _plain(df, direction).collect()))


def test_hot_key_within_one_second_is_split(spark):
    """A key with every row in one second still spreads evenly: pieces follow rank, not time."""
    n, pieces = 40_000, 20
    df = spark.range(n).selectExpr("'hot' AS k", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts", "CAST(id AS INT) AS n", "'v' AS v")
    df = df.repartition(8)
    rng = df.repartitionByRange(pieces, "k", "ts", "n").groupBy(F.spark_partition_id()).count()
    assert rng.agg(F.max("count")).first()[0] <= 2 * n / pieces
    got = with_neighbor(df, ["k"], ["ts", "n"], ["n"], pieces=pieces)
    assert got.where("prev_n = n - 1").count() == n - 1 and got.where("prev_n IS NULL").count() == 1


def test_many_hot_keys(spark):
    df = spark.range(60_000).selectExpr("CAST(id % 300 AS STRING) AS k", "TIMESTAMP_NTZ'2024-01-01 00:00:00' AS ts",
                                        "CAST(id AS INT) AS n", "'v' AS v")
    got = with_neighbor(df, ["k"], ["ts", "n"], ["n"], "next", pieces=32)
    assert got.where("next_n = n + 300").count() == 60_000 - 300


def test_one_lazy_plan_and_one_read(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_text(with_neighbor(df, ["user_id"], ["ts", "event_id"], ["event_type"]), "simple")
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_bad_direction(spark):
    with pytest.raises(ValueError):
        with_neighbor(_feed(spark), ["k"], ["ts"], ["v"], "up")
