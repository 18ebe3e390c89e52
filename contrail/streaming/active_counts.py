"""Structured Streaming ingest.

A file-source stream over a landing folder, event-time windows with a
watermark (state is dropped once a window is older than the watermark), and
``foreachBatch`` sinks: one appends window counts, the other runs the type-2
merge per micro-batch. ``trigger(availableNow=True)`` drains what has landed
and stops, which is how an hourly batch schedule maps onto streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.functions.timefmt import epoch_micros, epoch_ntz
from contrail.sources.scd2_table import upsert_scd2
from contrail.sources.sinks import read_table, write_table


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A stream over the files of a table, be ``path`` one file or a folder of them."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    # As a pattern (of that one path) Spark takes a file as well as a folder.
    path = path.rstrip("/")
    return r.load(f"{path[:-1]}[{path[-1]}]")


def windowed_counts(stream: DataFrame, ts: str, group: Sequence[str], window: str, watermark: str,
                    dedup_keys: Sequence[str] = ()) -> DataFrame:
    """Event-time tumbling-window counts per group with a watermark.

    Watermarks need a TIMESTAMP (not NTZ) column. The NTZ event time is moved
    to the instant with the same UTC wall clock through epoch microseconds
    (not a cast, which would apply the session zone), so windows align to the
    NTZ calendar in any session zone; bounds are moved back the same way.
    ``dedup_keys`` drops records seen again within the watermark (a snapshot
    landed twice by a retried poll) before counting; that state is bounded
    by the watermark too.
    """
    def to_instant(c):
        return F.timestamp_micros(epoch_micros(c))

    def to_ntz(c):
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch_ntz())

    ev = stream.withColumn("__ets", to_instant(F.col(ts))).withWatermark("__ets", watermark)
    if dedup_keys:
        ev = ev.dropDuplicatesWithinWatermark(list(dedup_keys))
    agg = ev.groupBy(F.window("__ets", window).alias("w"), *group).agg(F.count(F.lit(1)).alias("n"))
    return agg.select(to_ntz(F.col("w.start")).alias("window_start"),
                      to_ntz(F.col("w.end")).alias("window_end"), *group, "n")


def start_window_counts(counts: DataFrame, out_path: str, checkpoint: str, available_now: bool = True
                        ) -> StreamingQuery:
    """Run ``counts`` in update mode; each micro-batch appends its changed windows
    tagged with the batch id. ``read_window_counts`` keeps the last value per window."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_table(batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), out_path, mode="append")

    w = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(sink)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def read_window_counts(spark: SparkSession, out_path: str, keys: Sequence[str]) -> DataFrame:
    """Final count per window: the row from the latest batch that touched it."""
    df = read_table(spark, out_path)
    w = Window.partitionBy(*keys).orderBy(F.col("batch_id").desc())
    return df.withColumn("__rk", F.row_number().over(w)).where("__rk = 1").drop("__rk", "batch_id")


def start_scd2_stream(stream: DataFrame, table_path: str, key: str, ts: str, tracked: Sequence[str],
                      checkpoint: str, tie_break: Sequence[str] = ()) -> StreamingQuery:
    """Keep a stored type-2 history current from a stream.

    Each micro-batch is merged with ``upsert_scd2`` as the table's next batch;
    the stream (named by its checkpoint) and its batch id go into the commit
    record. A batch replayed after a failure is merged once, and a new stream
    on an old table carries on after the table's last batch.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_scd2(batch.sparkSession, table_path, batch, key, ts, tracked, tie_break,
                    source=checkpoint, source_id=batch_id)

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge)
            .trigger(availableNow=True).start())
