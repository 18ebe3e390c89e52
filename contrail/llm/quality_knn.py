"""Text quality by nearest-neighbour voting in a latent semantic space.

Texts become hashed byte-trigram profiles (sublinear counts, inverse document
frequency, unit length) with a few shares that tell their shape: repeated words,
capitals, signs, digits. A truncated SVD of a labelled sample spans the latent
space, and the sample's latent vectors with their labels are broadcast: their
number is a parameter, so their size is bounded. Every document is projected in
its task and compared with all labelled vectors by exact cosine products, block
by block; the nearest ones vote, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import filter_rows, fold_of, id_text, text_slices, utf8

#: Columns of a trigram profile, latent dimensions, neighbours that vote, documents per block of products.
FEATURES, LATENT, NEIGHBOURS, BLOCK = 8192, 64, 24, 512
#: Shape columns that follow the trigrams, and their weight against a trigram profile of length 1.
SHAPES, SHAPE_WEIGHT = 5, 2.0
#: Labelled documents the model is fitted on, per label. The only bound; it does not depend on the corpus.
SAMPLE_PER_LABEL = 2048
#: A vote counts as similarity to this power.
SHARPNESS = 4
THRESHOLD = 0.7


def shape_of(text: bytes, counts: np.ndarray) -> list[float]:
    """Shares of a text: words equal to the one before, repeated words, capitals, signs, digits."""
    words = text.split()
    n, size = max(len(words), 1), max(len(text), 1)
    again = sum(map(eq, words, islice(words, 1, None))) / n
    capitals, digits = counts[65:91].sum(), counts[48:58].sum()
    letters = capitals + counts[97:123].sum() + counts[128:].sum()
    signs = counts[33:127].sum() - digits - capitals - counts[97:123].sum()
    return [again, 1 - len(set(words)) / n if words else 0.0, capitals / max(letters, 1), signs / size, digits / size]


def profiles(part: pa.RecordBatch) -> np.ndarray:
    """Counts of hashed byte trigrams, one row per text, as log(1 + count), then the shape."""
    data, off = utf8(part.column("text"))
    out = np.zeros((len(off) - 1, FEATURES + SHAPES), np.float32)
    for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist(), strict=True)):
        # in stretches, so that a very long text needs no more memory than a short one
        for at in range(a, b - 2, 1 << 20):
            t = data[at:min(at + (1 << 20) + 2, b)].astype(np.uint32)
            h = ((t[:-2] << 16 | t[1:-1] << 8 | t[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(19)
            out[i, :FEATURES] += np.bincount(h, minlength=FEATURES)
        out[i, FEATURES:] = shape_of(data[a:b].tobytes(), np.bincount(data[a:b], minlength=256))
    np.log1p(out[:, :FEATURES], out=out[:, :FEATURES])
    return out


def text_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most BLOCK rows: a profile takes 32 KiB however short its text is."""
    for part in text_slices(batches):
        for at in range(0, part.num_rows, BLOCK):
            yield part.slice(at, BLOCK)


def weighted(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.hstack([unit(rows[:, :FEATURES] * idf), SHAPE_WEIGHT * rows[:, FEATURES:]])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    idf: np.ndarray        # FEATURES
    basis: np.ndarray      # (FEATURES + SHAPES) x LATENT
    vectors: np.ndarray    # labelled x LATENT, unit rows
    labels: np.ndarray     # labelled, 0 or 1
    weight: np.ndarray     # labelled: undoes the sampling by label
    prior: float           # share of label 1, the score of a text without a direction

    def latent(self, rows: np.ndarray) -> np.ndarray:
        return unit(weighted(rows, self.idf) @ self.basis)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        out = np.empty(len(rows))
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(rows), BLOCK):
            cos = self.latent(rows[at:at + BLOCK]) @ self.vectors.T
            near = np.argpartition(cos, len(self.labels) - k, axis=1)[:, len(self.labels) - k:]
            vote = np.maximum(np.take_along_axis(cos, near, axis=1), 0).astype(np.float64) ** SHARPNESS * self.weight[near]
            total = vote.sum(axis=1)
            share = (vote * self.labels[near]).sum(axis=1) / np.maximum(total, 1e-300)
            out[at:at + BLOCK] = np.where(total > 1e-12, share, self.prior)
        return np.clip(out, 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, train: Callable, per_label: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Profiles and labels of a bounded sample, and the share of label 1 among all training labels.

    Takes, for either label, the documents with the smallest hashed ids; a document
    labelled more than once takes its smallest label.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("quality").cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1) & F.col("id").isNotNull() & train(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    order = F.xxhash64("id")
    share = known.agg(F.avg("y")).first()[0]
    picked = [known.where(F.col("y") == y).orderBy(order, "id").limit(per_label) for y in (0, 1)]
    picked = F.broadcast(picked[0].union(picked[1]))  # at most 2 * per_label rows of two numbers
    chosen = id_text(docs).join(picked, F.col("doc_id") == F.col("id")).select("doc_id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_blocks(batches):
            rows = profiles(part)
            at = [np.flatnonzero(r) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("y"),
                 pa.array([a.astype(np.int16).tobytes() for a in at], pa.binary()),
                 pa.array([r[a].tobytes() for r, a in zip(rows, at, strict=True)], pa.binary())], ["doc_id", "y", "at", "value"])
    got = chosen.mapInArrow(run, "doc_id long, y int, at binary, value binary").dropDuplicates(["doc_id"]).collect()
    got.sort(key=lambda r: r.doc_id)
    rows = np.zeros((len(got), FEATURES + SHAPES), np.float32)
    for row, r in zip(rows, got, strict=True):
        row[np.frombuffer(r["at"], np.int16)] = np.frombuffer(r["value"], np.float32)
    return rows, np.array([r.y for r in got], np.int64), 0.0 if share is None else float(share)


def fit(rows: np.ndarray, labels: np.ndarray, prior: float) -> Model:
    """Latent space of the sample by a randomised truncated SVD."""
    idf = np.log((1 + len(rows)) / (1 + (rows[:, :FEATURES] > 0).sum(axis=0))).astype(np.float32) + np.float32(0.1)
    x = weighted(rows, idf)
    rank = min(LATENT, *x.shape)
    q = np.random.Generator(np.random.PCG64(1)).standard_normal((x.shape[1], min(rank + 16, len(x))), dtype=np.float32)
    for _ in range(3):
        q = np.linalg.qr(x.T @ np.linalg.qr(x @ q)[0])[0]
    basis = q @ np.linalg.svd(x @ q, full_matrices=False)[2].T[:, :rank]
    part = np.array([(labels == 0).mean(), (labels == 1).mean()])
    weight = np.array([1 - prior, prior]) / np.maximum(part, 1e-12)
    return Model(idf, basis, unit(x @ basis), labels, weight[labels], prior)


def train_model(docs: DataFrame, labels: DataFrame, train: Callable, per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    rows, y, prior = labelled_sample(docs, labels, train, per_label)
    return fit(rows, y, prior) if len(y) else None


def _scorer(docs: DataFrame, model: Model | None) -> Callable[[pa.RecordBatch], np.ndarray]:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(part: pa.RecordBatch) -> np.ndarray:
        if not shared.value or not part.num_rows:
            return np.ones(part.num_rows)
        return np.concatenate([shared.value.score(profiles(part.slice(at, BLOCK))) for at in range(0, part.num_rows, BLOCK)])
    return score


def learns_from(col):
    """Rows the classifier may learn from: crc32 of the id as text, modulo 4, is not 2."""
    return fold_of(col, 4) != 2


def score_quality(docs: DataFrame, labels: DataFrame, train: Callable = learns_from) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (score >= 0.7).

    The score depends on the text alone. Null and empty texts (and texts of fewer
    than three bytes) have no direction and score the share of label 1 among the
    training labels. Without any training label nothing speaks against a
    text, and every score is 1. Repeated rows score alike; a row without an id is
    scored and not held out; null labels are ignored.
    """
    score = _scorer(docs, train_model(docs, labels, train))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score(part), pa.float64())], ["doc_id", "score"])
    held_out = F.coalesce(~train(F.col("doc_id")), F.lit(False))
    scored = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, train: Callable = learns_from) -> DataFrame:
    """The rows of ``docs``, all columns, that ``score_quality`` predicts as label 1."""
    score = _scorer(docs, train_model(docs, labels, train))
    return filter_rows(docs, lambda part: score(part) >= THRESHOLD)
