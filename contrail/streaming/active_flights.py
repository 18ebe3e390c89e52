"""Counts of the flights in progress, kept from a stream of snapshots.

Keyed streaming state holds each flight's last snapshot, so that a newer one takes
the old one's count back: a landed flight leaves its airline, a flight that changes
its airline moves. A flight whose arrival has passed leaves by an event-time timer,
also when no snapshot says so. What the state operator emits are signed changes
per group; a batch's changes are added up with the last totals and
published as the next version, so readers read one small folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from contrail.functions.timefmt import epoch_micros
from contrail.operators.current import LANDED_MARKER, arrival_time
from contrail.sources.commits import committed_version
from contrail.sources.sinks import read_version, write_version


#: Groups that flights are dealt to by hash. State is kept, read and written a group at a time, so that Python runs
#: once a group and not once a flight; a stream keeps its number, so choose it for the flights in progress it will have.
STATE_GROUPS = 32
#: The deadline of a flight that only a snapshot can end.
_NEVER = 1 << 62


def _newest(frame: pd.DataFrame) -> pd.DataFrame:
    return frame.sort_values("at", ascending=False, kind="stable").drop_duplicates("flight")


def _changes(rows: pd.DataFrame, groups: list[str], delta: int) -> pd.DataFrame:
    return rows.loc[rows["counted"], groups].assign(delta=delta)


def advance(old: pd.DataFrame, new: pd.DataFrame, watermark: int, groups: list[str]) -> tuple[pd.DataFrame, pd.DataFrame]:
    """(last snapshots, signed changes) after ``new`` snapshots and a ``watermark``.

    Frames have flight, at, until, counted and the groups; ``new`` has one row per flight.
    """
    seen = new.merge(old[["flight", "at"]], on="flight", how="left", suffixes=("", "_old"))["at_old"]
    new = new[(seen.isna() | (new["at"].to_numpy() > seen)).to_numpy()]
    again = old["flight"].isin(new["flight"])
    moved = [_changes(old[again], groups, -1), _changes(new, groups, 1)]
    last = pd.concat([old[~again], new], ignore_index=True)
    ended = last["until"] < watermark
    moved.append(_changes(last[ended], groups, -1))
    moved = pd.concat(moved, ignore_index=True).groupby(groups, dropna=False, as_index=False)["delta"].sum()
    return last[~ended], moved[moved["delta"] != 0]


def active_changes(stream: DataFrame, key: str, ts: str, groups: Sequence[str], lateness: str = "0 seconds",
                   state_groups: int = STATE_GROUPS) -> DataFrame:
    """Signed changes (groups..., delta) of the number of flights in progress.

    A flight counts from its newest snapshot: airborne, not landed, and its
    arrival unknown or not before the watermark (the newest ``ts`` seen, less
    ``lateness``). A snapshot that is not newer than the flight's last one
    changes nothing, so a replayed one doesn't either; one older than the watermark is late and is
    dropped. NULL keys are one flight, a NULL ``ts`` is dropped. ``groups`` are text columns. A flight's
    state goes when the watermark has passed its arrival, or the last snapshot of one that
    doesn't count; a flight of unknown arrival stays until a snapshot ends it. So state
    holds the flights in progress, and a poll's cost follows them, not the feed's history.
    """
    groups = list(groups)
    names = [f"g{i}" for i in range(len(groups))]
    flying = (F.col("on_ground").try_cast("int") == 0) & ~F.col("status_text").contains(LANDED_MARKER)
    flight = F.col(key).cast("string")
    snapshots = stream.where(F.col(ts).isNotNull()).select(
        F.pmod(F.xxhash64(flight), F.lit(state_groups)).alias("bucket"), flight.alias("flight"),
        F.timestamp_micros(epoch_micros(F.col(ts))).alias("seen"), epoch_micros(F.col(ts)).alias("at"),
        F.coalesce(F.floor(epoch_micros(arrival_time()) / 1000), F.lit(_NEVER)).alias("until"),
        F.coalesce(flying, F.lit(False)).alias("counted"),
        *(F.col(g).alias(n) for g, n in zip(groups, names, strict=True))).withWatermark("seen", lateness)
    columns = ["flight", "at", "until", "counted", *names]
    out = T.StructType([*(T.StructField(n, T.StringType()) for n in names), T.StructField("delta", T.LongType())])
    kept = T.StructType([T.StructField("rows", T.BinaryType())])
    table = pa.schema([("flight", pa.string()), ("at", pa.int64()), ("until", pa.int64()), ("counted", pa.bool_()), *((n, pa.string()) for n in names)])

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = pa.ipc.open_stream(state.get[0]).read_pandas() if state.exists else table.empty_table().to_pandas()
        new, watermark = table.empty_table().to_pandas(), state.getCurrentWatermarkMs()
        if not state.hasTimedOut:
            for frame in frames:
                new = _newest(pd.concat([new, frame[columns]], ignore_index=True))
        # one that doesn't count is remembered while an older snapshot of it could still come
        new["counted"] = new["counted"].astype(bool) & (new["until"] >= watermark)
        new["until"] = new["until"].where(new["counted"], new["at"] // 1000)
        last, moved = advance(old, new, watermark, names)
        if len(last):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table) as w:
                w.write_table(pa.Table.from_pandas(last[columns], table, preserve_index=False))
            state.update((sink.getvalue().to_pybytes(),))
            if (first := int(last["until"].min())) < _NEVER:
                state.setTimeoutTimestamp(max(first, watermark + 1))
        elif state.exists:
            state.remove()
        yield moved

    changes = snapshots.groupBy("bucket").applyInPandasWithState(step, out, kept, "update", GroupStateTimeout.EventTimeTimeout)
    return changes.select(*(F.col(n).alias(g) for g, n in zip(groups, names, strict=True)), "delta")


def start_active_counts(changes: DataFrame, groups: Sequence[str], path: str, checkpoint: str) -> StreamingQuery:
    """Drain what has landed, publishing the totals after each micro-batch as the table's next version.

    The stream (named by its checkpoint) and its batch id go into the commit
    record, so a batch replayed after a failure is added once.
    """
    groups = list(groups)

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if committed_version(spark, path, checkpoint, batch_id) is not None:
            # the totals are there already, but the batch must run for its state to be kept
            batch.write.format("noop").mode("overwrite").save()
            return
        totals = batch.withColumnRenamed("delta", "n")
        try:
            totals = totals.unionByName(read_version(spark, path, totals.schema))
        except FileNotFoundError:
            pass
        totals = totals.groupBy(*groups).agg(F.sum("n").alias("n")).where("n != 0")
        write_version(totals, path, source=checkpoint, source_id=batch_id)

    return (changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
            .trigger(availableNow=True).start())
