"""Exact deduplication by content-defined chunk recipes.

A rolling hash over the last 16 bytes cuts each text where the hash has its low
bits clear, so equal stretches of text are cut alike wherever they stand. Each
chunk gets a 64-bit identifier. The identifiers are verified against the bytes:
chunks are grouped by identifier, and all bytes of a group must be equal; if any
identifier names two different chunks, another hash seed is taken. A text is then
its ordered list of identifiers (its recipe), texts are equal when their
recipes are, and only recipes are compared and moved from there on: chunk bytes
travel once, long documents never.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import id_text, stored, text_slices, utf8

#: Chunks have 2 KiB on average and lie between these bounds (the last may be shorter).
MIN_CHUNK, MAX_CHUNK, CUT_BITS = 512, 16384, 11
_GEAR = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 32, 256, dtype=np.uint32)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Positions after which the rolling hash of the last 16 bytes allows a cut."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):  # windows of 2, 4, 8 and 16 bytes
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return np.flatnonzero((h >> np.uint32(32 - CUT_BITS)) == 0) + 1


def chunk_bounds(data: np.ndarray) -> list[int]:
    """Cut positions of one text, its end included; [] for an empty text."""
    n, bounds, at = len(data), [], 0
    if n <= MIN_CHUNK:
        return [n] if n else []
    cuts = cut_points(data)
    while n - at > MIN_CHUNK:
        i = np.searchsorted(cuts, at + MIN_CHUNK)
        at = int(min(cuts[i] if i < len(cuts) else n, at + MAX_CHUNK, n))
        bounds.append(at)
    if at < n:
        bounds.append(n)
    return bounds


def _chunks(part: pa.RecordBatch) -> Iterator[tuple[bytes, list[bytes]]]:
    data, off = utf8(part.column("text"))
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        text = data[a:b]
        raw, ends = text.tobytes(), chunk_bounds(text)
        yield raw, [raw[i:j] for i, j in zip([0, *ends], ends)]  # noqa: B905


def _identifier(chunk: bytes, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(chunk, seed) - (1 << 63)


def chunk_table(docs: DataFrame, seed: int) -> DataFrame:
    """Rows (id, chunk): each task names a chunk once for every slice of rows it reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            seen = list({c for _, chunks in _chunks(part) for c in chunks})
            yield pa.RecordBatch.from_arrays(
                [pa.array([_identifier(c, seed) for c in seen], pa.int64()), pa.array(seen, pa.binary())], ["id", "chunk"])
    return id_text(docs).mapInArrow(run, "id long, chunk binary")


def verified_seed(docs: DataFrame, seed: int = 0) -> int:
    """The first seed under which every identifier names one chunk only, byte for byte."""
    while True:
        ids = chunk_table(docs, seed).groupBy("id").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
        if ids.where(F.col("lo") != F.col("hi")).isEmpty():
            return seed
        seed += 1


def recipes(docs: DataFrame, seed: int) -> DataFrame:
    """One row per row: doc_id, text_sha256, recipe (identifiers in order; empty for an empty text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sha, recipe = [], []
            for raw, chunks in _chunks(part):
                sha.append(hashlib.sha256(raw).hexdigest())
                recipe.append([_identifier(c, seed) for c in chunks])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sha, pa.string()), pa.array(recipe, pa.list_(pa.int64()))],
                ["doc_id", "text_sha256", "recipe"])
    return id_text(docs).mapInArrow(run, "doc_id long, text_sha256 string, recipe array<long>")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays. Null and empty texts are
    equal to each other. A null doc_id never wins over a number; a group of null
    ids only keeps them all under a null keep_id. Rows repeated with the same id
    are the same document: each counts in group_size and has the same ``kept``.

    Groups are counted before the shuffle, single texts need no join, and the
    join back reads written tables, so that AQE splits a large group of copies.
    """
    rows = stored(recipes(docs, verified_seed(docs)), "recipes")
    groups = rows.groupBy("recipe").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    copies = stored(groups.where("group_size > 1"), "recipe_groups")
    joined = rows.join(copies, "recipe", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``exact_groups`` keeps.

    Each row is judged by its id and its text: a copy takes no other text of the
    same id with it. Of rows with a null id those go whose text a numbered row has.
    """
    gone = exact_groups(docs).where(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    sha = F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary"), 256)
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (sha == gone["text_sha256"]), "left_anti")
