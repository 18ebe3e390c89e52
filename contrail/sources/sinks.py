"""Writing tables and marts.

Partitioned writes need no pre-shuffle: Spark's file writer sorts each task's
rows by the partition columns and writes one file per (task, partition value)
in sequence, so a partition value holding a third of the data is still
written by many tasks in parallel. ``max_records_per_file`` caps file size.
A run owns its partition folder and replaces it as a whole, so a rerun is
idempotent even when it has fewer rows or none.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions.timefmt import STAMP_FORMATS
from contrail.session import shuffles_removed
from contrail.sources.commits import commit, last_version

RUN_PARTITIONS = (*STAMP_FORMATS.keys(), "extract_time")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | str = (), mode: str = "append",
                fmt: str = "parquet", max_records_per_file: int = 5_000_000,
                files_per_value: int | None = None) -> None:
    """Append (or overwrite) ``df`` at ``path``, partitioned by 0..n columns.

    ``files_per_value`` bounds small files: rows are hash-partitioned by the
    partition columns plus a salt in ``[0, files_per_value)``, so each
    partition value is written by at most that many tasks, and a hot value
    is still spread over that many. The salt is a hash of the row, not
    ``rand()``, so a retried task rebuilds exactly the same partitioning.

    ``mode='overwrite'`` replaces the partitions present in ``df`` only;
    ``mode='replace'`` replaces everything under ``path``. Parquet is packed by zstd, and the
    shuffles of the write are removed with its end.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    if files_per_value and cols:
        salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files_per_value))
        df = df.repartition(*[F.col(f"`{c}`") for c in cols], salt)
    w = df.write.format(fmt).mode("overwrite" if mode == "replace" else mode)
    w = w.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    if mode in ("overwrite", "replace"):
        w = w.option("partitionOverwriteMode", "dynamic" if mode == "overwrite" else "static")
    if cols:
        w = w.partitionBy(*cols)
    with shuffles_removed(df.sparkSession):
        w.save(path)


def write_indexed(df: DataFrame, path: str, key: str, mode: str = "append", row_group_bytes: int = 32 << 20) -> None:
    """Write a table for point reads by ``key`` (S1): rows sorted within each file, with Parquet bloom filters.

    Sorting needs no shuffle. Within a file at most a row group or two can hold a value by their bounds, and
    their bloom filter rules out the files that don't have it, so an equality predicate on ``key`` (pushed down by
    ``read_feed``) decodes the row groups that hold it and few others. Bloom filters are sized by the values found.
    """
    (df.sortWithinPartitions(F.col(f"`{key}`")).write.mode(mode)
       .option("parquet.block.size", row_group_bytes)
       .option(f"parquet.bloom.filter.enabled#{key}", "true")
       .option("parquet.bloom.filter.adaptive.enabled", "true")
       .parquet(path))


def run_folder(path: str, as_of) -> str:
    """The partition folder of the run at ``as_of`` (text or datetime): year, month, day, extraction time."""
    t = as_of if isinstance(as_of, _dt.datetime) else _dt.datetime.fromisoformat(str(as_of))
    stamp = {"extract_year": f"{t:%Y}", "extract_month": f"{t:%Y_%m}", "extract_day": f"{t:%Y_%m_%d}",
             "extract_time": (t - _dt.datetime(1970, 1, 1)) // _dt.timedelta(seconds=1)}
    return "/".join([path.rstrip("/"), *(f"{c}={stamp[c]}" for c in RUN_PARTITIONS)])


def write_run(df: DataFrame, path: str, as_of, files: int | None = None) -> None:
    """Publish one run of a table (S4, S10): the run's folder is replaced as a whole.

    Repeating a run with fewer rows, or none, leaves no row of the first
    attempt behind; other runs are untouched. ``df`` carries no stamp
    columns, they are the folder names. ``files`` bounds the files of the run.
    """
    if files:
        df = df.repartition(files)
    write_table(df, run_folder(path, as_of), mode="replace")


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] | str = (), source: str | None = None,
                  source_id: int | None = None) -> int:
    """Replace a whole table (D8): a new version folder, then its commit record.

    Readers keep the version they started with, and a value that has left a
    partition is gone with the next version. ``source`` and ``source_id`` name the
    batch that made the version, for writers that must add a replayed batch once.
    """
    spark = df.sparkSession
    last = last_version(spark, path)
    n = 0 if last is None else last + 1
    write_table(df, f"{path}/version={n}", partition_by, mode="replace")
    commit(spark, path, n, source, source_id)
    return n


def read_version(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The last committed version of a table written by ``write_version``."""
    n = last_version(spark, path)
    if n is None:
        raise FileNotFoundError(f"no committed version at {path}")
    return read_table(spark, f"{path}/version={n}", schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Read a table written by ``write_table``. Pass the full schema (partition
    columns included) to stop Spark from re-typing partition folder values
    (a '2024' year folder would otherwise come back as an integer)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def latest_run(df: DataFrame, run_col: str = "extract_time") -> DataFrame:
    """Rows of the most recent run only.

    ``run_col = (scalar subquery max(run_col))``: when ``run_col`` is a
    partition column the subquery reads only partition values and the filter
    lands in the scan's ``PartitionFilters``, so only the newest run's folder
    is read however many runs the mart has accumulated.
    """
    return df.where(F.col(run_col) == df.select(F.max(run_col)).scalar())
