"""Slowly changing dimension, type 2, as plain DataFrame plans.

A history has the feed's columns plus ``is_current`` (bool),
``effective_time`` and ``end_time`` (NULL while current). These functions
are lazy DataFrame plans; ``contrail.sources.scd2_table`` stores a history
on Parquet so that a merge reads only the current part.

Differences from the reference, on purpose:
* ``effective_time`` is the record's own source time, not the wall clock, so
  reruns are reproducible and an older snapshot arriving late cannot close a
  newer version (updates at or before the current ``effective_time`` are ignored).
* The first load is deduplicated too, so a key never has two current rows.
* Attribute comparison is NULL-safe by default (NULL -> value is a change).
* Only the attributes the caller names are tracked; extraction stamps are not.
* A NULL key is a key like any other. A row without a source time is older than
  any row with one: it can start a key's history but never replaces a version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.operators.dedup import dedup_latest
from contrail.operators.sequence import with_neighbor

SCD_COLUMNS = ("is_current", "effective_time", "end_time")


def _latest(df: DataFrame, key: str, ts: str, tie_break: Sequence[str]) -> DataFrame:
    order = [F.col(ts).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_break]
    return dedup_latest(df, key, order)


def scd2_init(df: DataFrame, key: str, ts: str, tie_break: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """First load (C1): latest row per key, stamped current from its source time. ``unique``: the
    caller has one row per key already, and no shuffle looks for others."""
    return (df if unique else _latest(df, key, ts, tie_break)).withColumns({
        "is_current": F.lit(True),
        "effective_time": F.col(ts),
        "end_time": F.lit(None).cast(df.schema[ts].dataType),
    })


def _changed(cur: str, new: str, attrs: Sequence[str], nullsafe: bool) -> Column:
    tests = []
    for a in attrs:
        c, n = F.col(f"{cur}.{a}"), F.col(f"{new}.{a}")
        tests.append(~c.eqNullSafe(n) if nullsafe else (c != n))
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    # With nullsafe=False a comparison against NULL is unknown: no change.
    return F.coalesce(out, F.lit(False))


def scd2_merge(history: DataFrame, updates: DataFrame, key: str, ts: str, tracked: Sequence[str],
               tie_break: Sequence[str] = (), nullsafe: bool = True, unique: bool = False) -> DataFrame:
    """Upsert a batch of snapshots into a type-2 history (C2) and return the new history.

    ``unique``: the batch has one row per key already.

    * key absent from the batch: untouched;
    * new key: inserted as current, with a NULL ``effective_time`` if it has no source time;
    * tracked attributes changed and the update is newer (any time is newer than
      none): the current version is closed (``end_time`` = update time) and the
      update inserted as current;
    * unchanged, not newer, or without a source time: nothing.

    Keys meet NULL-safely, and ``is_current`` is never NULL. Plan: closed
    versions pass through untouched; the current part and the deduplicated
    batch (at most one row per key each, so no key can skew the join) meet in
    one full outer join on the key, and each joined pair emits 0, 1 or 2 rows
    through ``inline`` of a filtered array - one pass, no second scan of the join.
    """
    cols = [c for c in history.columns if c not in SCD_COLUMNS]
    closed = history.where(~F.col("is_current"))
    current = history.where(F.col("is_current")).withColumn("__there", F.lit(True))
    updates = updates.select(*cols)
    batch = (updates if unique else _latest(updates, key, ts, tie_break)).withColumn("__there", F.lit(True))

    j = current.alias("c").join(batch.alias("u"), F.col(f"c.{key}").eqNullSafe(F.col(f"u.{key}")), "full_outer")
    # Presence by marker: a NULL key says nothing about which side has the row.
    has_c, has_u = F.col("c.__there").isNotNull(), F.col("u.__there").isNotNull()
    new_ts, old_ts = F.col(f"u.{ts}"), F.col(f"c.{ts}")
    newer = new_ts.isNotNull() & (old_ts.isNull() | F.coalesce(new_ts > old_ts, F.lit(False)))
    replace = has_c & has_u & newer & _changed("c", "u", tracked, nullsafe)
    insert = (has_u & ~has_c) | replace

    ts_type = history.schema["effective_time"].dataType
    old_row = F.struct(*[F.col(f"c.{c}").alias(c) for c in cols],
                       (~replace).alias("is_current"),
                       F.col("c.effective_time").alias("effective_time"),
                       F.when(replace, F.col(f"u.{ts}")).otherwise(F.col("c.end_time")).cast(ts_type)
                        .alias("end_time"))
    new_row = F.struct(*[F.col(f"u.{c}").alias(c) for c in cols],
                       F.lit(True).alias("is_current"),
                       F.col(f"u.{ts}").cast(ts_type).alias("effective_time"),
                       F.lit(None).cast(ts_type).alias("end_time"))
    rows = F.filter(F.array(F.when(has_c, old_row), F.when(insert, new_row)), lambda r: r.isNotNull())
    merged = j.select(F.inline(rows))
    return closed.unionByName(merged)


def scd2_history(feed: DataFrame, key: str, ts: str, tracked: Sequence[str], tie_break: Sequence[str] = ()
                 ) -> DataFrame:
    """Whole type-2 history from a full change feed.

    A version starts at the first row of a key and at every row whose tracked
    attributes differ (NULL-safe) from the previous row; it ends where the
    next version starts. Equals what repeated ``scd2_merge`` runs build when
    batches arrive in order with at most one change per key per batch.
    NULL keys form one history, and rows without a time come first in theirs.

    One lazy plan that reads the feed once: the previous row and the next
    version are looked up by ``with_neighbor``, which splits a hot key by rank.
    """
    order = [ts, *tie_break]
    p = with_neighbor(feed.withColumn("__seen", F.lit(True)), [key], order, ["__seen", *tracked], "prev", prefix="__p_")
    changed = F.col("__p___seen").isNull()
    for a in tracked:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"__p_{a}"))
    versions = p.where(changed).select(*feed.columns, "__seen")
    n = with_neighbor(versions, [key], order, [ts, "__seen"], "next", prefix="__n_")
    return (n.withColumn("end_time", F.col(f"__n_{ts}"))
             .withColumn("effective_time", F.col(ts))
             .withColumn("is_current", F.col("__n___seen").isNull())
             .select(*feed.columns, "is_current", "effective_time", "end_time"))


def scd2_as_of(history: DataFrame, as_of: Column) -> DataFrame:
    """The version of every key that was valid at ``as_of`` (time travel over C3/C2 output)."""
    return history.where((F.col("effective_time") <= as_of)
                         & (F.col("end_time").isNull() | (F.col("end_time") > as_of)))


def scd2_timeline(feed: DataFrame, key: str, ts: str, tracked: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """Every row of a change feed with ``starts`` (it begins a version) and, where it does, the version's SCD2 columns.

    Rows that repeat their predecessor's attributes begin nothing now, but would if a late
    snapshot came between: a history that late rows can be spliced into keeps them.
    """
    order = [ts, *tie_break]
    p = with_neighbor(feed.withColumn("__seen", F.lit(True)), [key], order, ["__seen", *tracked], "prev", prefix="__p_")
    changed = F.col("__p___seen").isNull()
    for a in tracked:
        changed = changed | ~F.col(a).eqNullSafe(F.col(f"__p_{a}"))
    rows = p.withColumn("starts", changed).select(*feed.columns, "starts")
    n = with_neighbor(rows.where("starts").withColumn("__seen", F.lit(True)), [key], order, [ts, "__seen"], "next", prefix="__n_")
    scd = {"is_current": F.col("__n___seen").isNull(), "effective_time": F.col(ts), "end_time": F.col(f"__n_{ts}")}
    none = {"is_current": F.lit(False), "effective_time": F.lit(None).cast(feed.schema[ts].dataType), "end_time": F.lit(None).cast(feed.schema[ts].dataType)}
    versions = n.withColumns(scd).select(*rows.columns, *SCD_COLUMNS)
    return versions.unionByName(rows.where("NOT starts").withColumns(none))


def timeline_history(timeline: DataFrame) -> DataFrame:
    """The type-2 history of a timeline: the rows that begin versions, as ``scd2_history`` gives them."""
    return timeline.where("starts").drop("starts")


def scd2_splice(timeline: DataFrame, late: DataFrame, key: str, ts: str, tracked: Sequence[str], tie_break: Sequence[str] = ()
                ) -> tuple[DataFrame, DataFrame]:
    """Splice snapshots of any age into a timeline: (untouched, repaired) rows, together the new timeline.

    A late snapshot with other attributes splits the version it falls in, the rest of which
    begins anew where it was next seen; versions that become neighbours with equal attributes
    merge. Only keys that ``late`` names are worked on; a writer keeps what it has of the others.
    However a feed is dealt over batches, the result is the timeline of the whole feed. A row whose key, time
    and tie break are known is a replay and changes nothing. NULL keys are one key; rows
    without a time come first in theirs.
    """
    place = [key, ts, *tie_break]
    names = late.select(F.col(key).alias("__k")).distinct()
    mine = timeline.join(names, timeline[key].eqNullSafe(names["__k"]), "left_semi")
    untouched = timeline.join(names, timeline[key].eqNullSafe(names["__k"]), "left_anti")
    cols = [c for c in timeline.columns if c not in (*SCD_COLUMNS, "starts")]
    # a known row wins over its replay, and of replays in one batch any one does: they are the same
    all_rows = mine.select(*cols, F.lit(0).alias("__new")).unionByName(late.select(*cols, F.lit(1).alias("__new")))
    kept = dedup_latest(all_rows, place, [F.col("__new").asc()]).drop("__new")
    return untouched, scd2_timeline(kept, key, ts, tracked, tie_break)
