"""Shared helpers: input columns, written intermediate tables, Arrow text access."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_path, table_path

#: Text bytes a Python worker holds at once; only a single longer text exceeds it.
SLICE_BYTES = 2 << 20


def reach_workers(spark: SparkSession) -> None:
    """Put this package on the import path of Python workers, wherever the driver was started.

    Executors on other hosts get the package by ``--py-files`` or an install.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns an operator reads, whatever else the table holds."""
    reach_workers(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold_of(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo n."""
    return F.crc32(col.cast("string").cast("binary")) % F.lit(n)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and return the table read back.

    Cuts lineage: a lost executor costs a reread, not a recomputation. The
    reread also forgets the partitioning, so AQE may split skewed joins on it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_slices(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit`` text bytes (one row at least).

    At the end Arrow gives back what the batches took: Spark keeps the worker for other stages.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = size[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(size, before + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
        del batch
    pa.default_memory_pool().release_unused()


def filter_rows(docs: DataFrame, keep: Callable[[pa.RecordBatch], np.ndarray]) -> DataFrame:
    """The rows of ``docs``, with all columns, for which ``keep`` of their slice says so."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            yield part.filter(pa.array(keep(part)))
    reach_workers(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets of length n + 1); null counts as empty."""
    col = pc.fill_null(col.cast(pa.binary()), b"")
    off = np.frombuffer(col.buffers()[1], dtype=np.int32, count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
    buf = col.buffers()[2]
    data = np.frombuffer(buf, dtype=np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def located(docs: DataFrame) -> DataFrame:
    """(doc_id, text, file, row): rows named by where they stand in their files, the same on every read.

    A frame that doesn't come straight from files is written first.
    """
    reach_workers(docs.sparkSession)
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    try:
        return docs.select(*columns, *place)
    except AnalysisException as e:
        if e.getCondition() != "UNRESOLVED_COLUMN.WITH_SUGGESTION":
            raise
    return stored(docs.select(*columns), "located").select(*columns, *place)


#: Byte tables for ``split_words``: lower-case A-Z and blank what parts words, either all
#: ASCII white space or everything but 0-9, a-z and bytes from 0x80.
ASCII_LOWER_WORDS = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
ALNUM_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def split_words(texts: list[bytes], table: bytes) -> tuple[list[bytes], np.ndarray]:
    """The words of all texts in one list, and the offset of each text in it."""
    if not texts:
        return [], np.zeros(1, np.int64)
    joined = b" ".join([*texts, b""]).translate(table)
    is_word = np.frombuffer(joined, np.uint8) != 32
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    return joined.split(), np.r_[0, np.cumsum(np.add.reduceat(first, begins, dtype=np.int64))]


def word_array(texts: list[bytes], table: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of ``split_words`` as one Arrow array; no word is made an object."""
    if not texts:
        return pa.array([], pa.binary()), np.zeros(1, np.int64)
    data = np.frombuffer(b" ".join([*texts, b""]).translate(table), np.uint8)
    inside = data != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.r_[0, edges] if inside[0] else edges  # the last byte is blank
    first = edges[::2]
    ends = np.r_[0, np.cumsum(edges[1::2] - first)]
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    words = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data[inside])])
    return words, np.searchsorted(first, begins)


def text_bytes(col: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null counts as empty."""
    return pc.fill_null(col.cast(pa.binary()), b"").to_pylist()
