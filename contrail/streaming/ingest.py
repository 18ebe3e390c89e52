"""Landed JSON into bronze and quarantine by one stream.

A file-source stream over the landing folder: which files are new, and which of
them a batch takes, is in Spark's own source log under the checkpoint, written
before the batch runs. One ``foreachBatch`` parses the lines and writes both sides.
Each micro-batch owns a folder of bronze, and one of the quarantine, and replaces them as a whole: a
batch that runs again after a failure takes the same files and writes the same folders.
"""

from __future__ import annotations

import datetime as dt
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from contrail.sources.feeds import parse_json_lines
from contrail.sources.sinks import run_folder, write_table

#: The partition below a run's, one folder for each micro-batch of each stream.
BATCH_COLUMN = "ingest_batch"


def _landed_at(batch: DataFrame) -> dt.datetime:
    """When the newest file of a batch landed, in whole seconds: the same whenever the batch runs."""
    seconds = batch.agg(F.max("at").alias("at")).first()["at"]
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=seconds)


def start_ingest(spark: SparkSession, landing: str, schema: T.StructType, bronze: str, checkpoint: str,
                 as_of: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Ingest every line that has landed since the stream (named by its checkpoint) last ran, then stop.

    Records that parse under ``schema`` go to ``bronze``, the text of others to
    ``<bronze>/_quarantine``, both below the run partitions of ``as_of`` (by default the time the batch's newest file
    landed) and ``ingest_batch``. Blank lines and empty files are nothing. ``max_files_per_trigger`` bounds a batch.
    """
    stream = spark.readStream.schema("value STRING")
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = stream.text(landing).select("value", F.unix_seconds("_metadata.file_modification_time").alias("at"))
    name = f"{zlib.crc32(checkpoint.encode()):08x}"

    def sink(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        stamp = as_of if as_of is not None else _landed_at(batch)
        good, bad = parse_json_lines(batch, schema)
        for rows, path in ((good, bronze), (bad, f"{bronze}/_quarantine")):
            write_table(rows, f"{run_folder(path, stamp)}/{BATCH_COLUMN}={name}-{batch_id}", mode="replace")

    return (lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start())
