"""Profiles that add up, against one pass over everything."""

from contrail.operators.clean import null_ratios, prune_sparse
from contrail.operators.profile import merged_ratios, prune_by_profile, run_profile, update_profiles
from contrail.session import scratch_path
from contrail.sources.sinks import RUN_PARTITIONS, read_table, write_run
from helpers import rows_of

RUNS = ["2024-01-01 00:00:00", "2024-01-01 01:00:00", "2024-01-02 00:00:00"]


def _run(spark, i):
    rows = [(j, None if j % 3 == i else " N/A " if j % 5 == 0 else "x", float("nan") if j % 4 == 0 else 1.5, [1] if j % 2 else None, (None if j % 7 else "a",))
            for j in range(40 * i, 40 * i + 20 + 10 * i)]
    return spark.createDataFrame(rows, "k int, t string, d double, a array<int>, s struct<v:string>")


def test_sum_of_run_profiles_is_the_profile(spark):
    bronze, profiles = scratch_path(spark, "pb"), scratch_path(spark, "pp")
    taken = []
    for i, as_of in enumerate(RUNS):
        write_run(_run(spark, i), bronze, as_of)
        taken.append(update_profiles(spark, bronze, profiles))
    assert [len(x) for x in taken] == [1, 1, 1] and update_profiles(spark, bronze, profiles) == []
    everything = read_table(spark, bronze).drop(*RUN_PARTITIONS)
    want = {r.column_name: r.missing_ratio for r in null_ratios(everything).collect()}
    got = {r.column_name: round(r.missing_ratio, 6) for r in merged_ratios(spark, profiles).collect()}
    assert got == want
    assert rows_of(prune_by_profile(everything, merged_ratios(spark, profiles), 0.3)) == rows_of(prune_sparse(everything, 0.3))


def test_second_profile_reads_one_run(spark):
    """Only the new run's folder is scanned: an old run whose files can't be read any more doesn't matter."""
    bronze, profiles = scratch_path(spark, "pb2"), scratch_path(spark, "pp2")
    write_run(_run(spark, 0), bronze, RUNS[0])
    update_profiles(spark, bronze, profiles)
    write_run(_run(spark, 1), bronze, RUNS[1])
    part = read_table(spark, bronze)
    new = max(r.extract_time for r in part.select("extract_time").distinct().collect())
    old = [f for f in part.inputFiles() if f"extract_time={new}" not in f]
    assert old
    for f in old:                                   # break the old run
        with open(f.removeprefix("file:").replace("///", "/"), "wb") as fh:
            fh.write(b"broken")
    assert update_profiles(spark, bronze, profiles) == [new]
    assert {r.total for r in spark.read.parquet(profiles).where(f"run = {new}").collect()} == {30}


def test_run_published_anew_and_column_of_one_run(spark):
    bronze, profiles = scratch_path(spark, "pb3"), scratch_path(spark, "pp3")
    write_run(_run(spark, 0).drop("d"), bronze, RUNS[0])
    write_run(_run(spark, 1), bronze, RUNS[1])
    runs = update_profiles(spark, bronze, profiles)
    write_run(_run(spark, 2), bronze, RUNS[1])
    assert update_profiles(spark, bronze, profiles, again=runs[1:]) == runs[1:]
    per = {(r.run, r.column_name): (r.present, r.total) for r in spark.read.parquet(profiles).collect()}
    want = {(runs[1], r.column_name): (r.present, r.total) for r in run_profile(_run(spark, 2)).collect()}
    assert {k: v for k, v in per.items() if k[0] == runs[1]} == want
    ratio = {r.column_name: r.missing_ratio for r in merged_ratios(spark, profiles).collect()}
    assert abs(ratio["d"] - (1 - per[runs[1], "d"][0] / 60)) < 1e-9      # the first run has no such column


def test_empty_runs(spark):
    bronze, profiles = scratch_path(spark, "pb4"), scratch_path(spark, "pp4")
    write_run(_run(spark, 0).limit(0), bronze, RUNS[0])
    assert [r.total for r in run_profile(_run(spark, 0).limit(0)).collect()] == [0] * 5
    update_profiles(spark, bronze, profiles)
