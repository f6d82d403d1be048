"""Changes that happen whole or not at all: failures before and after the commit, reruns, partial rewrites."""

import os

import pytest

from assaywright.catalog.builtin import build
from assaywright.plans import run as R
from assaywright.sinks import commit, writers

SCHEMA = "k string, v int"


def values(spark, target):
    return sorted(map(tuple, writers.read(spark, target).collect()), key=repr)


@pytest.fixture
def stored_table(spark, frame, tmp_path):
    """A folder of four files with one key each."""
    target = str(tmp_path / "t")
    for k in "abcd":
        frame(SCHEMA, (k, 1), (k, 2)).coalesce(1).write.mode("append").parquet(target)
    return target


def fail(*_):
    raise RuntimeError("the driver is lost")


def test_failure_before_the_commit_leaves_the_old_table(spark, frame, stored_table, monkeypatch):
    before = values(spark, stored_table)
    with monkeypatch.context() as patch:
        patch.setattr(commit.Files, "rename_new", fail)
        with pytest.raises(RuntimeError):
            writers.merge_upsert(frame(SCHEMA, ("a", 9)), stored_table, ["k"])
    assert values(spark, stored_table) == before == sorted(map(tuple, spark.read.parquet(stored_table).collect()))
    writers.merge_upsert(frame(SCHEMA, ("a", 9)), stored_table, ["k"])
    assert values(spark, stored_table) == [("a", 9)] + [r for r in before if r[0] != "a"]


@pytest.mark.parametrize("steps", [0, 1])
def test_failure_after_the_commit_is_made_good(spark, frame, stored_table, monkeypatch, steps):
    done = []

    def stops(files, *names):
        if len(done) == steps:
            fail()
        done.append(names)
        return keep(files, *names)

    keep = commit.Files.move
    source = frame(SCHEMA, ("a", 9), ("d", 8), ("e", 7)).repartition(2, "k")
    with monkeypatch.context() as patch:
        patch.setattr(commit.Files, "move", stops)
        with pytest.raises(RuntimeError):
            writers.merge_delete_insert(source, stored_table, ["k"])
    want = [("a", 9), ("b", 1), ("b", 2), ("c", 1), ("c", 2), ("d", 8), ("e", 7)]
    assert values(spark, stored_table) == want
    assert sorted(map(tuple, spark.read.parquet(stored_table).collect())) == want
    commit.finish(spark, stored_table)
    assert values(spark, stored_table) == want


def test_only_files_with_affected_keys_are_rewritten(spark, frame, stored_table):
    names = lambda: {n for n in os.listdir(stored_table) if n.startswith("part")}
    before = names()
    writers.merge_upsert(frame(SCHEMA, ("b", 5), ("x", 6)), stored_table, ["k"])
    assert len(before - names()) == 1 and values(spark, stored_table)[-1] == ("x", 6)
    kept = names()
    writers.merge_delete_insert(frame(SCHEMA, ("z", 5)), stored_table, ["k"])
    assert kept <= names() and len(values(spark, stored_table)) == 9


def test_a_change_made_from_an_older_version_is_refused(spark, frame, stored_table):
    first = commit.version(commit.Files(spark), stored_table)
    writers.merge_upsert(frame(SCHEMA, ("a", 3)), stored_table, ["k"])
    before = values(spark, stored_table)
    with pytest.raises(RuntimeError, match="another writer"):
        commit.publish(spark, [stored_table], commit.Change(removes=[f"{stored_table}/x"]), first)
    assert values(spark, stored_table) == before


def test_partitioned_tables_and_odd_values(spark, frame, tmp_path):
    target = str(tmp_path / "with space")
    rows = [("a b/c%", 1, "x"), (None, 2, "y"), ("é", 3, "z")]
    frame("p string, k int, v string", *rows).write.partitionBy("p").parquet(target)
    writers.merge_upsert(frame("k int, v string, p string", (1, "new", "a b/c%"), (4, "more", None)), target, ["k"])
    got = {(r["p"], r["k"], r["v"]) for r in writers.read(spark, target).collect()}
    assert got == {("a b/c%", 1, "new"), (None, 2, "y"), ("é", 3, "z"), (None, 4, "more")}


def test_overwrite(spark, frame, stored_table):
    writers.overwrite(frame(SCHEMA, ("n", 1)), stored_table)
    assert values(spark, stored_table) == [("n", 1)]
    writers.overwrite(writers.read(spark, stored_table).withColumn("v", writers.F.col("v") + 1), stored_table)
    assert values(spark, stored_table) == [("n", 2)]
    writers.overwrite(frame("other long", (5,)), stored_table)
    assert values(spark, stored_table) == [(5,)]


PEOPLE = [(1, "a", 20240101), (1, None, 20240101), (2, "b", 20240102)]


@pytest.mark.parametrize("catalog", [False, True])
def test_reruns_replace_both_logs(spark, frame, tmp_path, monkeypatch, catalog):
    people = frame("id int, name string, load_date int", *PEOPLE)
    about = {"object": "people", "system": "S s", "sub_system": "X", "domain": "D"}
    names = ("summary_of_reruns", "detail_of_reruns") if catalog else (str(tmp_path / "s"), str(tmp_path / "d"))
    rules = [build("DQ_001", "name", **about), build("DQ_005", "id", **about)]

    def run(date, day, some=rules, **more):
        settings = R.RunSettings(f"{day} 08:00:00", *names, load_date=date, layer="bronze", **more)
        assert all(s.passed for s in R.run_table(people, some, settings))

    def logs():
        summary, detail = (writers.read_log(spark, n) for n in names)
        shown = sorted((r["batch_id"], r["rule_id"], str(r["rule_run_date"])[:10]) for r in summary.collect())
        return shown, sorted((r["batch_id"], r["rule_id"], str(r["rule_run_date"])[:10]) for r in detail.collect())

    run(20240101, "2026-01-01"), run(20240102, "2026-01-01")
    first = logs()
    assert len(first[0]) == 4 and len(first[1]) == 3
    run(20240101, "2026-01-02", rules[:1])
    again = logs()
    assert [r for r in again[0] if r[0] == 20240101] == [(20240101, "DQ_001", "2026-01-02")]
    assert [r for r in again[1] if r[0] == 20240101] == [(20240101, "DQ_001", "2026-01-02")]
    assert [r for r in again[0] if r[0] == 20240102] == [r for r in first[0] if r[0] == 20240102]
    with monkeypatch.context() as patch:  # committed, and lost before anything was applied
        patch.setattr(commit.Files, "move", fail)
        with pytest.raises(RuntimeError):
            run(20240101, "2026-01-03")
    assert {r[2] for r in logs()[0] if r[0] == 20240101} == {"2026-01-03"} and len(logs()[1]) == 3
    with monkeypatch.context() as patch:  # lost before the commit
        patch.setattr(commit, "replace_run", fail)
        with pytest.raises(RuntimeError):
            run(20240101, "2026-01-04")
    assert {r[2] for r in logs()[0] if r[0] == 20240101} == {"2026-01-03"}
    run(20240101, "2026-01-05", run_name="second look")
    assert len(logs()[0]) == 6
