"""Occurrences that follow a changing folder of SQL files."""

import os
import time

import pytest

from tessera.operators import discovery
from tessera.sources import corpus, mined

JOIN = "select * from s.fact f join s.{0} d on f.{0}_id = d.id;\n"


def put(root, name, *dims, at=None):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(JOIN.format(d) for d in dims))
    if at:
        os.utime(path, (at, at))
    return path


@pytest.fixture()
def store(spark, tmp_path):
    kept = mined.mined_buckets(str(tmp_path / "state"), 8)
    mined.begin(spark, kept)
    return kept


def edges(spark, store, version):
    return {r.id: r.n_occurrences for r in mined.edges_of(spark, store, version).collect()}


def edge(dim):
    return "|".join(sorted([f"s.{dim}.id", f"s.fact.{dim}_id"]))


def test_add_change_delete(spark, tmp_path, store):
    root = tmp_path / "sql"
    put(root, "a.sql", "one", "two")
    put(root, "sub/b [x]+1.SQL", "two")
    put(root, "c.sql").write_text("select 1;")
    put(root, "empty.sql")
    put(root, "node_modules/d.sql", "nine")
    got = {r.file: r.outcome for r in mined.update(spark, store, str(root), 0).collect()}
    assert got == {"a.sql": "added", "sub/b [x]+1.SQL": "added", "c.sql": "added"}
    assert edges(spark, store, 0) == {edge("one"): 1, edge("two"): 2}

    later = time.time() + 5
    put(root, "a.sql", "two", "four", at=later)
    put(root, "new.sql", "five", at=later)
    os.utime(root / "c.sql", (later, later))
    (root / "sub" / "b [x]+1.SQL").unlink()
    for _ in range(2):  # run again, it replaces its own version
        got = {r.file: r.outcome for r in mined.update(spark, store, str(root), 1).collect()}
        assert got == {"a.sql": "changed", "new.sql": "added", "c.sql": "touched", "sub/b [x]+1.SQL": "removed"}
        assert edges(spark, store, 1) == {edge("two"): 1, edge("four"): 1, edge("five"): 1}
    # what a whole scan finds
    whole, seen = discovery.discover(corpus.read_sql_corpus(spark, str(root)))
    assert sorted(map(str, mined.edges_of(spark, store, 1).collect())) == sorted(map(str, whole.collect()))
    assert mined.occurrences_of(store.read(spark, 1)).count() == seen.count()

    # nothing changed, then all goes
    assert mined.update(spark, store, str(root), 2).count() == 0
    assert edges(spark, store, 2) == edges(spark, store, 1)
    for name in ("a.sql", "new.sql", "c.sql"):
        (root / name).unlink()
    assert {r.outcome for r in mined.update(spark, store, str(root), 3).collect()} == {"removed"}
    assert edges(spark, store, 3) == {}


def test_unchanged_files_are_not_read_again(spark, tmp_path, store):
    root = tmp_path / "sql"
    long_ago = time.time() - 10_000
    paths = [put(root, f"f{i}.sql", f"d{i}", at=long_ago) for i in range(6)]
    mined.update(spark, store, str(root), 0)
    put(root, "f2.sql", "other")
    for i in (0, 1, 3, 4, 5):
        # another text of the same length and time: reading it would show
        put(root, f"f{i}.sql", f"x{i}", at=long_ago)
    before = store.manifest(spark, 0)
    got = mined.update(spark, store, str(root), 1).collect()
    assert [(r.file, r.outcome) for r in got] == [("f2.sql", "changed")]
    assert set(edges(spark, store, 1)) == {edge("other")} | {edge(f"d{i}") for i in (0, 1, 3, 4, 5)}
    after = store.manifest(spark, 1)
    assert sum(after[b]["version"] == 1 for b in after) == 1 and len(after) == len(before)
    # a file that arrives with an old time is read as well
    put(root, "old.sql", "late", at=long_ago - 10_000)
    assert [(r.file, r.outcome) for r in mined.update(spark, store, str(root), 2).collect()] == [("old.sql", "added")]
    assert edge("late") in edges(spark, store, 2) and edge("x0") not in edges(spark, store, 2)
    assert len(paths) == 6


def test_the_listing_reads_no_text(spark, tmp_path):
    put(tmp_path, "a.sql", "one")
    listed = corpus.list_sql_corpus(spark, str(tmp_path))
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan and listed.first().length == len(JOIN.format("one"))
