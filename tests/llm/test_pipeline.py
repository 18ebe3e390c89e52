"""The corpus pipeline against its stages, stage by stage, and registration."""

import __spark_entry__ as E
import corpus_pipeline
from contrail.llm.chunk_dedup import exact_groups
from contrail.llm.circulant_minhash import near_duplicates
from contrail.llm.common import read_table
from contrail.llm.quality_knn import score_quality
from contrail.llm.wu_manber import decontaminate

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    ops = sorted(int(n[2:].split("_")[0]) for n in E.queries() if n.startswith("op"))
    assert ops == list(range(1, 14)) and "pipeline" in E.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "MinHash near-dedup", "benchmark decontamination", "byte-level BPE"]


def test_stages_take_effect(spark, monkeypatch):
    docs = read_table(spark, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    frames, left = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, SF).persist()
        frames.append(left)
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    assert ids[1] == {r.doc_id for r in score_quality(docs, read_table(spark, SF, "labels")).where("predicted = 1").collect()}
    assert ids[2] == {r.doc_id for r in exact_groups(frames[1]).where("kept").collect()}
    assert len({text[i] for i in ids[2]}) == len(ids[2])
    assert ids[3] == {r.doc_id for r in near_duplicates(frames[2]).where("kept").collect()}
    assert ids[4] == {r.doc_id for r in decontaminate(frames[3], read_table(spark, SF, "benchmark")).where("NOT contaminated").collect()}
    assert ids[5] == ids[4] and 0 < len(ids[5]) < len(ids[0])
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, frames[-1].collect()))
