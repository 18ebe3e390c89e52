"""The quality classifier on held-out documents, and its defined edge cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from contrail.llm import quality_knn
from contrail.llm.quality_knn import keep_quality, score_quality

from .helpers import EDGES, docs_frame, prose, with_clashes

SF = "/root/testdata/sf0.01"


def fold4(i):
    return zlib.crc32(str(i).encode()) % 4


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = score_quality(docs, labels)
    assert got.count() == docs.count() and got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    seen = got.join(labels, "doc_id").where("held_out")
    n, right = seen.agg(F.count("*"), F.sum((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert n > 50 and right >= 0.95 * n
    assert all((fold4(r.doc_id) == 2) == r.held_out for r in got.collect())


def test_scores_depend_on_the_text_alone(spark):
    rng = random.Random(1)
    good = [(i, prose(rng, 120)) for i in range(60)]
    bad = [(100 + i, " ".join(w for w in prose(rng, 12).split() for _ in range(9))) for i in range(60)]
    same = [(1000 + i, t) for i, t in good[:5] + bad[:5]]
    rows = good + bad + same + [(5000 + i, t) for i, (_, t) in enumerate(EDGES)] + [(None, good[0][1])]
    docs = with_clashes(docs_frame(spark, rows)).withColumn("quality", F.lit(0))
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(7, None), (None, 1), (good[0][0], 1)], "doc_id long, quality int")
    out = score_quality(docs, labels).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and by[None].held_out is False
    assert all(by[1000 + i].score == by[k].score for i, k in enumerate([0, 1, 2, 3, 4]))
    assert all(by[i].predicted == 1 for i, _ in good) and all(by[i].predicted == 0 for i, _ in bad)
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in out)


@pytest.mark.parametrize("labels", [[], [(1, None)], [(99, 1)]])
def test_without_training_labels_everything_stays(spark, labels):
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    docs = docs_frame(spark, [(1, "some words"), (2, None)])
    assert [r.score for r in score_quality(docs, labels).collect()] == [1.0, 1.0]
    assert score_quality(docs.limit(0), labels).collect() == []


def test_short_texts_are_profiled_in_blocks(spark, monkeypatch):
    """A profile is 32 KiB, so a slice of many short texts must not be profiled as a whole."""
    texts = [f"{i} ab cd {i * 7}" for i in range(3000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    rows, full = [], quality_knn.profiles(batch)
    y = np.arange(400) % 2
    model = quality_knn.fit(full[:400], y, 0.5)
    monkeypatch.setattr(quality_knn, "profiles", lambda part, f=quality_knn.profiles: rows.append(part.num_rows) or f(part))
    score = quality_knn._scorer(docs_frame(spark, []), model)
    assert np.array_equal(score(batch), model.score(full))
    assert len(score(batch.slice(0, 0))) == 0
    assert max(rows) <= quality_knn.BLOCK and sum(rows) == 3000
    assert [b.num_rows for b in quality_knn.text_blocks(iter([batch]))] == [512] * 5 + [440]
