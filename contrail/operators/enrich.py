"""Summary + detail feeds matched per flight.

The reference fetches details one flight at a time in a driver loop and
silently drops flights whose fetch fails. Here both feeds are landed tables:
the match is an inner equi-join and the flights without detail are kept for
audit by a left anti join, so nothing vanishes unseen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.sources.commits import commit, committed_version, last_version
from contrail.sources.sinks import write_table


def enrich(summary: DataFrame, detail: DataFrame, summary_key: str, detail_key: str | None = None
           ) -> tuple[DataFrame, DataFrame]:
    """Return (``matched``, ``missing``): summary rows joined with their detail
    rows, and summary rows that have no detail at all.

    The audit side needs only key existence, so detail keys are deduplicated
    first (partial aggregate: one row per key per map task) - a hot key can
    then not pile its detail rows into one reducer of the anti join, where
    AQE cannot split the right side. The inner join is left to AQE's skew
    handling, which can split the streamed side.
    """
    detail_key = detail_key or summary_key
    matched = summary.join(detail, summary[summary_key] == detail[detail_key], "inner")
    keys = detail.select(detail[detail_key].alias("__k")).distinct()
    missing = summary.join(keys, summary[summary_key] == keys["__k"], "left_anti")
    return matched, missing


_FOUND, _WAITED = "matched", "polls_waited"


def match_once(summary: DataFrame, detail: DataFrame, summary_key: str, detail_key: str) -> DataFrame:
    """Every summary row with its detail rows and ``matched``; one left join, a marker tells a match from a miss.

    A summary without detail is there once with NULL details, a NULL key matches
    nothing. Details have a row or a few per key; summaries may repeat a key as often as they like.
    """
    d = detail.withColumn(_FOUND, F.lit(True))
    j = summary.join(d, summary[summary_key] == d[detail_key], "left")
    return j.withColumn(_FOUND, F.coalesce(F.col(_FOUND), F.lit(False)))


def enrich_poll(spark: SparkSession, path: str, summary: DataFrame, detail: DataFrame, summary_key: str, detail_key: str,
                poll: int, max_polls: int | None = None) -> int:
    """One poll of S8: its summaries, and those still waiting from earlier polls, meet the details at hand.

    Layout: ``path/poll=<n>/matched=true|false``, written by one job from one join; a
    commit record makes it visible, and names ``poll`` so that a repeated poll is
    not added again. Summaries without detail wait in the last poll's ``matched=false`` part with
    the number of polls they have waited, and are tried again by the next; after
    ``max_polls`` tries they stay behind in that poll's part, where an audit finds them. Returns n.
    """
    done = committed_version(spark, path, "poll", poll)
    if done is not None:
        return done
    last = last_version(spark, path)
    n = 0 if last is None else last + 1
    todo = summary.withColumn(_WAITED, F.lit(0))
    if last is not None:
        waiting = read_pending(spark, path, last)
        if max_polls is not None:
            waiting = waiting.where(F.col(_WAITED) < max_polls)
        todo = todo.unionByName(waiting.select(*todo.columns))
    joined = match_once(todo, detail, summary_key, detail_key)
    joined = joined.withColumn(_WAITED, F.when(F.col(_FOUND), F.col(_WAITED)).otherwise(F.col(_WAITED) + 1))
    write_table(joined, f"{path}/poll={n}", _FOUND, mode="replace")
    commit(spark, path, n, "poll", poll)
    return n


def _polls(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.parquet(path)
    return t.withColumn(_FOUND, F.col(_FOUND).cast("boolean"))


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    """Matched rows of every committed poll."""
    return _polls(spark, path).where(F.col(_FOUND) & (F.col("poll") <= last_version(spark, path))).drop("poll", _FOUND, _WAITED)


def read_pending(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Summaries that wait for their detail after the last (or given) poll, with ``polls_waited``; the detail columns are NULL."""
    n = last_version(spark, path) if version is None else version
    return _polls(spark, path).where(~F.col(_FOUND) & (F.col("poll") == n)).drop("poll", _FOUND)
