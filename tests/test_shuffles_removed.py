import time

from pyspark.sql import functions as F

from contrail.operators import scd2
from contrail.operators.clean import sparse_columns
from contrail.plans import views as V
from contrail.session import SHUFFLE_CLEANUP_CONF, shuffles_removed
from contrail.sources.scd2_table import read_scd2, upsert_scd2
from contrail.sources.sinks import read_version, write_version
from conftest import SF_SMALL
from helpers import rows_of


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_of(spark, before, seconds=10):
    """New shuffle files still there after some seconds: they are removed in the background."""
    end = time.time() + seconds
    while (new := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    return new


def test_the_profile_leaves_no_shuffle_behind(spark):
    before = shuffle_files(spark)
    sparse_columns(V.read(spark, SF_SMALL, "lineitem").repartition(3, "l_orderkey"))
    assert left_of(spark, before) == set()


def test_the_setting_is_as_it_was_and_frames_can_be_read_again(spark):
    was, df = spark.conf.get(SHUFFLE_CLEANUP_CONF, None), spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_removed(spark):
        first = sorted(df.collect())
    try:
        with shuffles_removed(spark):
            raise ValueError
    except ValueError:
        pass
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF, None) == was and sorted(df.collect()) == first


def test_writes_leave_no_shuffle_behind_and_are_packed(spark, tmp_path):
    before, df = shuffle_files(spark), V.read(spark, SF_SMALL, "lineitem").repartition(3, "l_orderkey")
    assert write_version(df, str(tmp_path / "t")) == 0
    assert left_of(spark, before) == set()
    assert all(f.endswith(".zstd.parquet") or ".zstd." in f for f in read_version(spark, str(tmp_path / "t")).inputFiles())
    assert rows_of(read_version(spark, str(tmp_path / "t"))) == rows_of(df)


def test_a_batch_written_down_is_not_sought_for_doubles_again(spark, tmp_path, monkeypatch):
    sought, real = [], scd2._latest
    monkeypatch.setattr(scd2, "_latest", lambda *a: sought.append(1) or real(*a))
    first = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), (None, 1, "n"), (None, 3, "m")], "k STRING, t INT, s STRING")
    second = spark.createDataFrame([("a", 3, "z"), ("a", 4, "y"), ("b", 5, "q"), ("b", 5, "r"), (None, 3, "o"), ("c", None, "c")], "k STRING, t INT, s STRING")
    path = str(tmp_path / "h")
    for part in (first, second):
        upsert_scd2(spark, path, part, "k", "t", ["s"], tie_break=["s"])
    assert sought == []
    merged = scd2.scd2_merge(scd2.scd2_init(first, "k", "t", ["s"]), second, "k", "t", ["s"], ["s"])
    assert rows_of(read_scd2(spark, path)) == rows_of(merged) and len(sought) == 2
