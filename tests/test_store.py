"""One commit for posts and state: runs that die, replays, other writers, compaction."""

import os

import pytest

from digestloom.plans import daily_run
from digestloom.sources import posts as post_source, state as state_source
from digestloom.sources.store import Conflict, Store
from tests.test_runs import AS_OF, ROWS, STYLE, article_id, counts, landed

OPTIONS = daily_run.Options(base_url="https://n.example", style=STYLE, summary_method="lead")


def seen(store):
    """Ids of posts and of the state, as a reader finds them."""
    posts = [r.article_id for r in store.posts().collect()]
    assert len(posts) == len(set(posts))
    return set(posts), {r.article_id for r in store.state().collect()}


def ids(*numbers):
    return {article_id(n) for n in numbers}


class Crash(Exception):
    pass


def dies(*_, **__):
    raise Crash


def test_a_run_that_dies_between_any_two_writes_is_not_seen(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    assert seen(store) == (set(), set())
    listing, pages = landed(spark, ROWS[:2])
    daily_run.run_in_store(listing, pages, store, "r1", AS_OF, OPTIONS)
    assert seen(store) == (ids(1, 2), ids(1, 2))
    listing, pages = landed(spark, ROWS)
    steps = [(post_source, "write_posts"), (state_source, "append_state"), (Store, "commit")]
    for module, name in steps:
        with monkeypatch.context() as m:
            m.setattr(module, name, dies)
            with pytest.raises(Crash):
                daily_run.run_in_store(listing, pages, store, "r2", AS_OF, OPTIONS)
        assert seen(store) == (ids(1, 2), ids(1, 2))
    # Also where the manifest's draft was written and its rename did not come.
    open(tmp_path / "store" / "manifest" / ".torn.draft", "w").close()
    done = daily_run.run_in_store(listing, pages, store, "r2", AS_OF, OPTIONS)
    assert counts(done) == (2, 2, 0) and seen(store) == (ids(1, 2, 3, 5), ids(1, 2, 3, 5))
    before = {t: len(os.listdir(tmp_path / "store" / t)) for t in ("posts", "state")}
    assert before == {"posts": 4, "state": 3}
    assert store.remove_unused() == 3
    assert seen(store) == (ids(1, 2, 3, 5), ids(1, 2, 3, 5))
    assert store.remove_unused() == 0


def test_a_repeated_run_takes_the_place_of_its_former_try(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    listing, pages = landed(spark, ROWS[:2])
    daily_run.run_in_store(listing, pages, store, "r1", AS_OF, OPTIONS)
    old = store.version()
    listing, pages = landed(spark, ROWS[:3])
    done = daily_run.run_in_store(listing, pages, store, "r1", AS_OF, OPTIONS)
    assert counts(done) == (3, 3, 0) and seen(store) == (ids(1, 2, 3), ids(1, 2, 3))
    # A reader that holds the former version goes on reading it.
    assert {r.article_id for r in store.posts(old).collect()} == ids(1, 2)
    assert counts(daily_run.run_in_store(listing, pages, store, "r2", AS_OF, OPTIONS)) == (0, 0, 0)
    assert store.version().number == 2


def test_of_two_writers_one_is_refused(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    began = store.version()
    store.commit(began, {"posts": {"a": "1"}})
    with pytest.raises(Conflict):
        store.commit(began, {"posts": {"b": "2"}})
    assert store.version().tables == {"posts": {"a": "1"}, "state": {}}
    assert not [n for n in os.listdir(tmp_path / "store" / "manifest") if n.endswith(".draft")]


def test_compaction_changes_over_at_once(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    assert store.compact_state().number == 0
    for run, rows in (("r1", ROWS[:2]), ("r2", ROWS[:3])):
        daily_run.run_in_store(*landed(spark, rows), store, run, AS_OF, OPTIONS)
    before = sorted(map(tuple, store.state().collect()))
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", dies)
        with pytest.raises(Crash):
            store.compact_state()
    assert sorted(map(tuple, store.state().collect())) == before
    store.compact_state()
    assert list(store.version().tables["state"]) == ["compacted"] and sorted(map(tuple, store.state().collect())) == before
    # The next run reads the compacted state, of the days of its ids.
    assert counts(daily_run.run_in_store(*landed(spark, ROWS), store, "r3", AS_OF, OPTIONS)) == (1, 1, 0)
    found = spark.createDataFrame([(article_id(1),)], "article_id string")
    plan = store.state(ids=found)._jdf.queryExecution().executedPlan().toString()
    assert "20260719" in plan.split("PartitionFilters")[1]
    assert store.remove_unused() == 3 and seen(store)[1] == ids(1, 2, 3, 5)
