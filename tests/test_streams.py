from datetime import datetime

from assaywright import Compare, Rule
from assaywright.catalog.builtin import build
from assaywright.sinks import writers
from assaywright.sinks.writers import LOG_PARTITIONS
from assaywright.streaming import checks as C

import pytest


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of small files, read one file per micro-batch."""
    folder = str(tmp_path / "feed" / "events")
    schema = "k string, ts timestamp, v int"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)

    def run(build_stream, name):
        target, state = str(tmp_path / name), str(tmp_path / f"{name}-state")
        kind = spark.createDataFrame([], schema).schema
        C.write_available(build_stream(C.parquet_stream(spark, folder, kind)), target, state).awaitTermination()
        return spark.read.parquet(target).collect()

    return add, run


def at(day, hour=0):
    return datetime(2024, 1, day, hour)


def test_row_rules_resume_where_they_stopped(feed):
    add, run = feed
    rules = [build("DQ_001", "k"), Rule("R", ("v",), violation=Compare("v", ">", 5))]

    def failures(stream):
        return C.row_failures(stream, rules, "2026-01-01 00:00:00", 1)

    add(("a", at(1), 9), (None, at(1), 1))
    assert {(r["rule_id"], r["result"]) for r in run(failures, "out")} == {("DQ_001", -1), ("R", 1)}
    add(("b", at(2), 7))
    assert len(run(failures, "out")) == 3


def test_detail_stream_fills_a_partitioned_log(feed, spark, tmp_path):
    add, _ = feed
    add(("a", at(1), 9), (None, at(1), 1))
    rule = build("DQ_001", "k", system="S", sub_system="X", object="events")
    kind = spark.createDataFrame([], "k string, ts timestamp, v int").schema
    stream = C.parquet_stream(spark, str(tmp_path / "feed" / "events"), kind)
    target = str(tmp_path / "log")
    failures = C.row_failures(stream, [rule], "2026-01-01 00:00:00", 20240101)
    C.write_available(failures, target, str(tmp_path / "state"), LOG_PARTITIONS).awaitTermination()
    assert (tmp_path / "log" / "system=S" / "sub_system=X" / "batch_id=20240101").is_dir()
    row = spark.read.parquet(target).first()
    assert (row["rule_id"], row["result"], row["object"]) == ("DQ_001", -1, "events")


def test_key_rules_are_refused(feed):
    add, run = feed
    add(("a", at(1), 9))
    with pytest.raises(ValueError, match="DQ_005"):
        run(lambda s: C.row_failures(s, [build("DQ_005", "k")], "2026-01-01 00:00:00", 1), "out")


def test_windows_close_behind_the_watermark_and_late_rows_are_dropped(feed):
    add, run = feed
    rules = [build("DQ_001", "k")]

    def daily(stream):
        return C.windowed_summary(stream, rules, "ts", "1 day", "1 day")

    add(("a", at(1, 5), 1), (None, at(1, 6), 1), ("a", at(2, 5), 1))
    assert run(daily, "daily") == []
    add(("a", at(5), 1))
    first = {r["window_start"]: (r["total_record_count"], r["no_of_failures"]) for r in run(daily, "daily")}
    assert first == {at(1): (2, 1), at(2): (1, 0)}
    add(("late", at(1, 7), 1), ("a", at(9), 1))
    again = {r["window_start"]: r["total_record_count"] for r in run(daily, "daily")}
    assert again == {at(1): 2, at(2): 1, at(5): 1}


@pytest.mark.parametrize("spread", [1, 4])
def test_first_seen_across_batches(feed, spread):
    add, run = feed

    def keys(stream):
        return C.first_seen(stream, ["k"], "ts", "10 days", spread).select("k")

    add(*[("hot", at(1, h % 24), h) for h in range(60)], ("a", at(1), 0))
    assert sorted(r["k"] for r in run(keys, f"seen{spread}")) == ["a", "hot"]
    add(("hot", at(2), 1), ("b", at(2), 1))
    assert sorted(r["k"] for r in run(keys, f"seen{spread}")) == ["a", "b", "hot"]


def test_windowed_duplicates(feed):
    add, run = feed
    add(("a", at(1, 1), 1), ("a", at(1, 2), 2), ("b", at(1, 3), 1), ("a", at(2, 1), 1))
    add(("z", at(8), 1))

    def repeated(stream):
        return C.windowed_duplicates(stream, ["k"], "ts", "1 day", "1 hour")

    assert [(r["k"], r["duplicate_count"]) for r in run(repeated, "dups")] == [("a", 2)]


def test_rows_without_a_time_are_counted(feed, spark):
    add, run = feed
    rules = [build("DQ_001", "k"), Rule("R", ("v",), violation=Compare("v", ">", 5))]

    def daily(stream):
        return C.windowed_summary(stream, rules, "ts", "1 day", "1 day")

    def merged(written):
        rows = C.merged_windows(spark.createDataFrame(written)).collect()
        return {(r["rule_id"], r["window_start"]): (r["total_record_count"], r["no_of_failures"]) for r in rows}

    add(("a", at(1), 1), ("a", None, 9), (None, None, None), ("a", at(5), 1))
    first = {("DQ_001", None): (2, 1), ("R", None): (2, 2), ("DQ_001", at(1)): (1, 0), ("R", at(1)): (1, 0)}
    assert merged(run(daily, "daily")) == first  # the first day closed behind the watermark
    add(("b", None, 1), ("a", at(9), 1))
    found = merged(run(daily, "daily"))
    assert found["DQ_001", None] == (3, 1) and found["R", None] == (3, 2) and found["R", at(1)] == (1, 0)


def test_batch_and_stream_do_not_share_a_folder(feed, spark, tmp_path):
    add, run = feed
    add(("a", at(1), 9))
    spark.range(1).write.parquet(str(tmp_path / "batch"))
    with pytest.raises(ValueError, match="batch runs"):
        run(lambda s: s.select("k"), "batch")
    run(lambda s: s.select("k"), "streamed")
    with pytest.raises(ValueError, match="file sink"):
        writers.append_log(spark.createDataFrame([("a",)], "k string"), str(tmp_path / "streamed"))
