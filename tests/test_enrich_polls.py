"""Summaries that wait for their details, poll by poll."""

from collections import Counter

from contrail.operators.enrich import enrich, enrich_poll, match_once, read_enriched, read_pending
from contrail.session import scratch_path
from helpers import plan_text, rows_of

S, D = "id long, name string", "key long, leg int"


def _frames(spark, summaries, details):
    return spark.createDataFrame(summaries, S), spark.createDataFrame(details, D)


POLLS = [([(1, "a"), (2, "b"), (None, "x"), (2, "again")], [(1, 1), (1, 2)]),
         ([(3, "c")], [(2, 7), (9, 9)]),
         ([], [(3, 1), (None, 5)])]


def test_detail_one_poll_late_is_enriched(spark):
    path = scratch_path(spark, "polls")
    for n, (s, d) in enumerate(POLLS):
        for _ in range(2):                                            # every poll is repeated
            assert enrich_poll(spark, path, *_frames(spark, s, d), "id", "key", n) == n
    got = Counter((r.id, r.name, r.leg) for r in read_enriched(spark, path).collect())
    assert got == Counter([(1, "a", 1), (1, "a", 2), (2, "b", 7), (2, "again", 7), (3, "c", 1)])
    assert [(r.id, r.name, r.polls_waited) for r in read_pending(spark, path).collect()] == [(None, "x", 3)]


def test_one_join_gives_both_sides(spark):
    s, d = _frames(spark, POLLS[0][0], POLLS[0][1] + [(2, 5)])
    both = match_once(s, d, "id", "key")
    matched, missing = enrich(s, d, "id", "key")
    assert rows_of(both.where("matched").drop("matched")) == rows_of(matched)
    assert rows_of(both.where("NOT matched").select("id", "name")) == rows_of(missing)
    plan = plan_text(both, "simple")
    assert sum("Join" in line for line in plan.splitlines()) == 1 and "NestedLoop" not in plan


def test_giving_up_leaves_an_audit(spark):
    path = scratch_path(spark, "polls_max")
    for n in range(4):
        enrich_poll(spark, path, *_frames(spark, [(7, "gone")] if n == 0 else [], []), "id", "key", n, max_polls=2)
    assert read_pending(spark, path).isEmpty()
    assert [r.polls_waited for r in read_pending(spark, path, 1).collect()] == [2]


def test_half_written_poll_does_not_exist(spark, monkeypatch):
    import pytest

    from contrail.operators import enrich as module
    path = scratch_path(spark, "polls_half")
    enrich_poll(spark, path, *_frames(spark, *POLLS[0]), "id", "key", 0)
    before = rows_of(read_enriched(spark, path)), rows_of(read_pending(spark, path))
    with monkeypatch.context() as m:
        m.setattr(module, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            enrich_poll(spark, path, *_frames(spark, *POLLS[1]), "id", "key", 1)
    assert (rows_of(read_enriched(spark, path)), rows_of(read_pending(spark, path))) == before
    enrich_poll(spark, path, *_frames(spark, *POLLS[1]), "id", "key", 1)
    assert read_enriched(spark, path).where("id = 2").count() == 2
