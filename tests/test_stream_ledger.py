from datetime import datetime

from assaywright import Compare, Rule
from assaywright.plans.table_check import TableCheck
from assaywright.sinks import commit, writers
from assaywright.streaming import checks as C
from assaywright.streaming import copies, ledger

import pytest

SCHEMA = "k string, ts timestamp, v int"
RULES = [Rule("R", ("v",), violation=Compare("v", ">", 5)), Rule("K", ("k",), violation=Compare("k", "=", "bad"))]


def at(day, hour=0, micro=0):
    return datetime(2024, 1, day, hour, 0, 0, micro)


@pytest.fixture
def arrive(spark, tmp_path):
    folder = str(tmp_path / "feed" / "events")

    def add(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        return C.parquet_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema)

    return add


def counted(spark, target):
    rows = ledger.window_counts(spark, target).collect()
    return {(r["rule_id"], r["kind"], r["window_start"]): (r["total_record_count"], r["no_of_failures"]) for r in rows}


def test_late_and_untimed_rows_are_counted(arrive, spark, tmp_path):
    target, state = str(tmp_path / "windows"), str(tmp_path / "state")
    batches = (
        [("a", at(1, 3), 9), ("bad", at(5), 1), ("c", None, 7)],
        # the watermark is now day 4: day 3 ended with it, day 4 is open
        [("d", at(3, 23), 6), ("e", at(4), None), ("f", at(1), 1), ("g", at(9), 1)],
        [("h", at(7, 23), 9), ("i", at(8), 9), ("j", None, 1)],
    )
    for batch in batches:
        stream = arrive(*batch)
        ledger.count_windows(stream, RULES, "ts", target, state).awaitTermination()
    want = {
        ("on_time", at(1)): (1, 1), ("on_time", at(5)): (1, 0), ("untimed", None): (2, 1),
        ("late", at(3)): (1, 1), ("on_time", at(4)): (1, 1), ("late", at(1)): (1, 0), ("on_time", at(9)): (1, 0),
        ("late", at(7)): (1, 1), ("on_time", at(8)): (1, 1),
    }
    got = counted(spark, target)
    assert {key[1:]: value for key, value in got.items() if key[0] == "R"} == want
    assert sum(n for (rule, _, _), (n, _) in got.items() if rule == "K") == sum(map(len, batches))
    assert got["K", "on_time", at(5)] == (1, 1)


def test_a_failed_micro_batch_is_counted_once(arrive, spark, tmp_path, monkeypatch):
    target, state = str(tmp_path / "windows"), str(tmp_path / "state")
    ledger.count_windows(arrive(("a", at(1), 9), ("b", at(8), 1)), RULES, "ts", target, state).awaitTermination()
    stream = arrive(("c", at(2), 9), ("d", at(20), 1))
    whole = commit.publish

    def lost_after(*args, **kwargs):
        whole(*args, **kwargs)
        raise OSError("lost after the commit")

    def lost_before(*args, **kwargs):
        raise OSError("lost before the commit")

    for lost in (lost_before, lost_after):
        monkeypatch.setattr(commit, "publish", lost)
        with pytest.raises(Exception, match="lost"):
            ledger.count_windows(stream, RULES, "ts", target, state).awaitTermination()
    monkeypatch.setattr(commit, "publish", whole)
    ledger.count_windows(stream, RULES, "ts", target, state).awaitTermination()
    got = counted(spark, target)
    assert got["R", "late", at(2)] == (1, 1)  # judged by the watermark of the first batch, at every attempt
    assert sum(n for (rule, _, _), (n, _) in got.items() if rule == "R") == 4


def test_stream_and_batch_share_a_log_and_a_replay_changes_nothing(arrive, spark, tmp_path):
    log = str(tmp_path / "log")
    rule = RULES[0]
    stream = arrive(("a", at(1), 9), ("b", at(2), 1), ("c", at(3), None))
    found = C.row_failures(stream, [rule], "2026-01-01 00:00:00", 7)
    for attempt in ("first", "second"):
        ledger.publish_available(found, log, str(tmp_path / attempt), "feed").awaitTermination()
        assert sorted(r["result"] for r in spark.read.parquet(log).collect()) == [-1, 1]
    table = spark.createDataFrame([("z", at(1), 9)], SCHEMA)
    writers.publish_run("by-batch", {log: TableCheck(table, [rule], "2026-01-01 00:00:00", 7).detail()})
    assert spark.read.parquet(log).count() == 3
    ledger.publish_available(found, log, str(tmp_path / "second"), "feed").awaitTermination()
    assert spark.read.parquet(log).count() == 3
    other = C.row_failures(arrive(("d", at(4), 8)), [rule], "2026-01-01 00:00:00", 7)
    ledger.publish_available(other, log, str(tmp_path / "second"), "feed").awaitTermination()
    assert spark.read.parquet(log).count() == 4


def test_all_copies_include_the_first(arrive, spark, tmp_path):
    target, state = str(tmp_path / "copies"), str(tmp_path / "state")

    def go(*rows):
        found = copies.all_copies(arrive(*rows), ["k"], "ts", "2 days")
        C.write_available(found, target, state).awaitTermination()
        return sorted((r["k"] or "", r["ts"], r["v"]) for r in spark.read.schema(found.schema).parquet(target).collect())

    first = ("a", at(1, 1, 123456), 1)
    assert go(first, ("b", at(1), 1), (None, at(1), 5)) == []
    assert go(("a", at(2), 2), (None, at(1), 5)) == [("", at(1), 5), ("", at(1), 5), first, ("a", at(2), 2)]
    assert go(("a", at(2), 3), ("c", at(9), 1), ("c", at(9), 1))[3:] == [("a", at(2), 2), ("a", at(2), 3), ("c", at(9), 1), ("c", at(9), 1)]
    # the watermark has passed every earlier key by its delay: b was forgotten
    assert len(go(("b", at(10), 2), ("z", at(10), 1))) == 7


def test_all_copies_of_a_flood_equal_the_batch_rule(arrive, spark, tmp_path):
    rows = [("hot" if i % 3 == 0 else f"k{i // 2}", at(1 + i % 5), i) for i in range(3000)]
    target, state = str(tmp_path / "copies"), str(tmp_path / "state")
    for part in range(3):
        found = copies.all_copies(arrive(*rows[part * 1000 : part * 1000 + 1000]), ["k"], "ts", "30 days")
        C.write_available(found, target, state).awaitTermination()
    want = sorted(v for k, _, v in rows if sum(1 for o in (rows if k != "hot" else rows[:7]) if o[0] == k) > 1)
    assert sorted(r["v"] for r in spark.read.schema(found.schema).parquet(target).collect()) == want


def test_all_copies_call_python_by_bucket(arrive, spark, tmp_path):
    """Many keys share a state; each is held, repeated and forgotten on its own."""
    target, state = str(tmp_path / "copies"), str(tmp_path / "state")

    def go(*rows):
        found = copies.all_copies(arrive(*rows), ["k", "v"], "ts", "2 days", buckets=2)
        C.write_available(found, target, state).awaitTermination()
        return sorted((r["k"] or "", r["ts"].day, r["v"]) for r in spark.read.schema(found.schema).parquet(target).collect())

    assert go(*[(f"k{i}", at(1 + i % 2 * 7), 0) for i in range(100)], ("x", at(1), 1), (None, at(8), 1)) == []
    want = [("", 8, 1), ("", 9, 1), ("k1", 8, 0), ("k1", 9, 0)]
    # the watermark is day 6: keys of day 1 end on day 3 and are forgotten beside those of day 8
    assert go(("k1", at(9), 0), ("k1", at(9), 7), (None, at(9), 1)) == want
    assert go(("k0", at(9), 0), ("x", at(9), 1), ("k3", at(9), 0)) == want + [("k3", 8, 0), ("k3", 9, 0)]
