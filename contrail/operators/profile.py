"""Missing-value profiles that add up.

A run's profile is two numbers a column: its rows and how many of them have a
value. Profiles of runs are stored as a mart and summed, so the share of missing
values over all of bronze needs no old run to be read again, and pruning decides
by the sums.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions.nulls import DEFAULT_SENTINELS, missing
from contrail.operators.clean import normalize_blanks
from contrail.sources.sinks import read_table, run_folder, write_table

PROFILE_SCHEMA = "column_name STRING, present BIGINT, total BIGINT, run BIGINT"


def run_profile(df: DataFrame, sentinels: Sequence[str] = DEFAULT_SENTINELS) -> DataFrame:
    """(column_name, present, total) of one run, in one aggregate over it.

    A column's values are tested where they are: of a nested one only whether it is NULL.
    """
    counts = [F.count(F.when(~missing(f, sentinels), F.lit(1))).alias(f.name) for f in df.schema.fields]
    one = df.agg(F.count(F.lit(1)).alias("__total"), *counts)
    return one.unpivot(["__total"], [f.name for f in df.schema.fields], "column_name", "present").select(
        "column_name", "present", F.col("__total").alias("total"))


def unprofiled_runs(spark: SparkSession, bronze: str, profiles: str) -> list[int]:
    """Bronze runs without a stored profile, oldest first. Runs are folder names: no file of bronze is opened."""
    runs = spark.read.format("binaryFile").load(bronze).select(F.col("extract_time").cast("bigint").alias("run")).distinct()
    try:
        done = spark.read.schema(PROFILE_SCHEMA).parquet(profiles).select("run").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return [r.run for r in runs.orderBy("run").collect()]
    return [r.run for r in runs.join(done, "run", "left_anti").orderBy("run").collect()]


def update_profiles(spark: SparkSession, bronze: str, profiles: str, again: Sequence[int] = (),
                    sentinels: Sequence[str] = DEFAULT_SENTINELS) -> list[int]:
    """Profile the bronze runs that have no profile yet, and those in ``again`` (runs published anew).

    Each run is read from its own folder under its own columns, and its profile replaced as a
    whole, so a repeated job adds nothing twice. Returns the runs it read.
    """
    runs = sorted({*unprofiled_runs(spark, bronze, profiles), *again})
    for run in runs:
        part = read_table(spark, run_folder(bronze, dt.datetime(1970, 1, 1) + dt.timedelta(seconds=run)))
        write_table(run_profile(part, sentinels).coalesce(1), f"{profiles}/run={run}", mode="replace")
    return runs


def merged_ratios(spark: SparkSession, profiles: str) -> DataFrame:
    """(column_name, missing_ratio) over all profiled runs; a run that lacks a column misses all its values."""
    p = spark.read.schema(PROFILE_SCHEMA).parquet(profiles)
    rows = p.groupBy("run").agg(F.max("total").alias("rows")).agg(F.sum("rows").alias("rows"))
    per = p.groupBy("column_name").agg(F.sum("present").alias("present"))
    return per.select("column_name", F.when(rows.scalar() > 0, 1 - F.col("present") / rows.scalar()).alias("missing_ratio"))


def prune_by_profile(df: DataFrame, ratios: DataFrame, max_missing: float = 0.7,
                     sentinels: Sequence[str] = DEFAULT_SENTINELS) -> DataFrame:
    """P6b by stored profiles: blanks become NULL, and columns of ``df`` with more than ``max_missing`` missing go.

    The names come to the driver, one per column; no row of the feed is read to decide. A column
    without a profile stays.
    """
    gone = [r.column_name for r in ratios.where(F.col("missing_ratio") > max_missing).select("column_name").collect()]
    return normalize_blanks(df, sentinels).drop(*gone)
