"""Packing the small files of past runs.

Hourly runs leave a folder of small files each. ``compact_runs`` writes the runs
that are closed into a few files a day, sized by Spark's rebalance, as one committed
version; ``read_runs`` reads those and, from their own folders, the runs since.
The run's stamp ``extract_time`` is then a column sorted within the files and no
folder, so a run is still found by row-group bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.timefmt import STAMP_FORMATS
from contrail.sources.commits import commit, commits
from contrail.sources.sinks import read_table, write_table

PACKED = "_packed"


def _packed_to(spark: SparkSession, path: str) -> tuple[int | None, int | None]:
    """(last committed version, end of the packed runs), or Nones."""
    records = commits(spark, f"{path}/{PACKED}")
    row = None if records is None else records.agg(F.max("version"), F.max("source_id")).first()
    return (None, None) if row is None else (row[0], row[1])


def compact_runs(spark: SparkSession, path: str, before: int, schema: T.StructType) -> int | None:
    """Pack the runs with ``extract_time`` under ``before`` that no version has packed yet.

    Returns the version written, None when there was nothing to pack. Pack runs that are closed: the rows of a run
    are taken once. A run that comes late, under an earlier ``before``, is read again after the next call, which packs
    it. Files have about ``spark.sql.adaptive.advisoryPartitionSizeInBytes``: rows are rebalanced by day, a large day is
    split and small ones share a task. Cost follows the runs packed; the run folders stay, for whoever owns them to
    expire. ``schema`` is the table's, stamps included. One compaction of a table at a time.
    """
    rows = read_table(spark, path, schema)
    version, _ = _packed_to(spark, path)
    mine = rows.where(F.col("extract_time") < before).select(F.col("extract_time").cast("bigint").alias("run")).distinct()
    if version is not None:
        done = commits(spark, f"{path}/{PACKED}").select(F.explode("parts").alias("run"))
        mine = mine.join(done, "run", "left_anti")
    runs = [r.run for r in mine.orderBy("run").collect()]      # one number per run since the last compaction
    if not runs:
        return None
    n = 0 if version is None else version + 1
    days = list(STAMP_FORMATS)
    packed = rows.where(F.col("extract_time").isin(runs)).hint("rebalance", *days).sortWithinPartitions(*days, "extract_time")
    write_table(packed, f"{path}/{PACKED}/version={n}", days, mode="replace")
    commit(spark, f"{path}/{PACKED}", n, "compact", before, runs)
    return n


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Every run of a table: packed ones from committed versions, later ones from their folders.

    A filter on ``extract_time`` prunes folders on one side and row groups on the other; ``latest_run`` works on it.
    """
    rows = read_table(spark, path, schema)
    version, end = _packed_to(spark, path)
    if version is None:
        return rows
    full = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
    packed = spark.read.schema(full).option("basePath", f"{path}/{PACKED}").parquet(
        *[f"{path}/{PACKED}/version={v}" for v in range(version + 1)])
    return packed.select(rows.columns).union(rows.where(F.col("extract_time") >= end))
