import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assaywright import Calculation, Compare, Enrich, GroupAggregate, Reference, Rule, Sql
from assaywright.catalog.builtin import build
from assaywright.operators.groups import aggregate_column, group_members
from assaywright.operators import joins
from assaywright.operators.joins import SizeLimit, delete_insert, insert_if_absent, join_by_name, spread_join, upsert, without_keys
from assaywright.operators.reshape import distinct_rows
from assaywright.plans.table_check import TableCheck

RUN = "2026-01-01 00:00:00"
TINY = SizeLimit(rows=2, bytes=1_000_000, hot_rows=5)  # nothing but the hottest keys may be broadcast
NONE = SizeLimit(rows=0, bytes=0, hot_rows=1_000_000)  # nothing may be broadcast


@pytest.fixture
def skewed(frame):
    """One key holds a third of all rows; some keys repeat, some are unique, some missing."""
    rng = random.Random(11)
    keys = ["hot"] * 200 + [f"k{rng.randrange(150)}" for _ in range(380)] + [None] * 20
    rng.shuffle(keys)
    return frame("n int, k string, p int", *[(i, k, i % 7) for i, k in enumerate(keys)]), keys


@pytest.mark.parametrize("limit", [SizeLimit(), TINY, NONE])
def test_duplicates_under_every_join_strategy(skewed, limit):
    df, keys = skewed
    copies = Counter(keys)
    check = TableCheck(df, [build("DQ_005", "k", composite_columns=("n",))], RUN, 1, limit=limit)
    flagged = {int(r["n"]): r["rule_violation_flag"] for r in check.flags(check.rules[0]).collect()}
    want = {i: -1 if k is None else int(copies[k] > 1) for i, k in enumerate(keys)}
    assert flagged == want
    detail = check.detail().collect()
    assert {int(r["value1"]): r["result"] for r in detail} == {i: f for i, f in want.items() if f}
    assert len(detail) == sum(f != 0 for f in want.values())
    images = {r["source_table_attributes"] for r in detail if r["result"] == 1 and r["value"] == "hot"}
    assert all('"duplicate_count":200}' in i for i in images)
    assert all('"duplicate_count":0}' in r["source_table_attributes"] for r in detail if r["result"] == -1)
    summary = check.summary().first()
    assert summary["total_record_count"] == 600
    assert summary["no_of_failures"] == len(detail)
    assert summary["no_of_complete_records"] == 580


@pytest.mark.parametrize("limit", [SizeLimit(), TINY, NONE])
def test_reference_under_every_join_strategy(skewed, frame, limit):
    df, keys = skewed
    known = {f"k{i}" for i in range(0, 150, 2)}
    master = frame("code string", *[(f" {k.upper()} ",) for k in sorted(known)] * 2)
    rule = build("DQ_003", "k", reference=Reference("master", ("code",)), composite_columns=("n",))
    check = TableCheck(df, [rule], RUN, 1, tables={"master": master}, limit=limit)
    want = {i: -1 if k is None else int(k not in known) for i, k in enumerate(keys)}
    assert {int(r["n"]): r["rule_violation_flag"] for r in check.flags(rule).collect()} == want
    assert {int(r["value1"]): r["result"] for r in check.detail().collect()} == {i: f for i, f in want.items() if f}


@pytest.mark.parametrize("limit", [SizeLimit(), TINY, NONE])
def test_row_against_group_under_every_join_strategy(skewed, limit):
    df, keys = skewed
    top = {}
    for i, k in enumerate(keys):
        top[k] = max(top.get(k, 0), i % 7)
    spec = GroupAggregate(("k",), (Calculation("max", "p", "top"),))
    rule = Rule("R", ("k",), aggregations=(spec,), having=Compare(Sql("p"), "=", Sql("top")))
    check = TableCheck(df, [rule], RUN, 1, limit=limit)
    want = {i: -1 if k is None else int(i % 7 == top[k]) for i, k in enumerate(keys)}
    assert {int(r["n"]): r["rule_violation_flag"] for r in check.flags(rule).collect()} == want


def test_digest_gives_the_same_duplicates(skewed):
    df, _ = skewed
    plain, digest = build("DQ_005", "k"), build("DQ_005", "k", digest=True)
    check = TableCheck(df, [], RUN, 1)
    assert check.flags(plain).exceptAll(check.flags(digest)).count() == 0


def test_duplicates_are_exact_about_case_and_spaces(frame):
    df = frame("v string", ("a",), ("A",), ("a ",), ("a",))
    rows = TableCheck(df, [], RUN, 1).flags(build("DQ_005", "v")).collect()
    assert sorted((r["v"], r["rule_violation_flag"]) for r in rows) == [("A", 0), ("a", 1), ("a", 1), ("a ", 0)]


def test_counts_over_years_and_batches(frame):
    df = frame(
        "k string, year_id int, load_date string",
        ("a", 2020, "20240101"), ("a", 2021, "20240101"), ("b", 2020, "20240101"), ("c", None, "20240102"),
    )
    check = TableCheck(df, [build("DQ_005", "k")], RUN)
    rows = {(r["year_id"], r["batch_id"]): (r["total_record_count"], r["no_of_failures"]) for r in check.summary().collect()}
    assert rows == {(2020, 20240101): (2, 1), (2021, 20240101): (1, 1), (None, 20240102): (1, 0)}
    assert check.detail().count() == 2


def test_selection_limits_the_population(frame):
    df = frame("n int, k string, s string", (1, "a", "x"), (2, "a", "y"), (3, "b", "x"), (4, "b", "x"))
    spec = GroupAggregate(("k",), (Calculation("count", "*", "c"),))
    rule = Rule("R", ("k",), violation=Compare("s", "=", "X"), aggregations=(spec,), having=Compare("c", ">", 1))
    rows = TableCheck(df, [], RUN, 1).flags(rule).collect()
    assert {r["n"]: r["rule_violation_flag"] for r in rows} == {"1": 0, "2": 0, "3": 1, "4": 1}


def test_conditional_aggregate_without_rows_is_null(frame):
    df = frame("k string, s string", ("a", "x"), ("b", "y"))
    calc = Calculation("count", "*", "c", where=Compare("s", "=", "x"))
    rows = {r["k"]: r["c"] for r in df.groupBy("k").agg(aggregate_column(calc)).collect()}
    assert rows == {"a": 1, "b": None}


def test_flag_algebra_of_having_and_reference(frame):
    df = frame("k string", ("a",), ("a",), ("b",), ("c",))
    master = frame("code string", ("A",), ("B",))
    spec = GroupAggregate(("k",), (Calculation("count", "*", "c"),))
    either = Rule("R", ("k",), aggregations=(spec,), having=Compare("c", ">", 1), references=(Reference("m", ("code",)),))
    check = TableCheck(df, [either], RUN, 1, tables={"m": master})
    assert sorted((r["k"], r["rule_violation_flag"]) for r in check.flags(either).collect()) == [
        ("a", 1), ("a", 1), ("b", 0), ("c", 1),
    ]
    assert check.summary().first()["no_of_failures"] == 3 == check.detail().count()
    both = either.bind(violation=Compare("k", ">", ""))
    assert {r["rule_violation_flag"] for r in check.flags(both).collect()} == {0}


def test_global_aggregate(frame):
    df = frame("p int", (1,), (5,), (9,))
    spec = GroupAggregate((), (Calculation("avg", "p", "mean"),))
    rule = Rule("R", ("p",), aggregations=(spec,), having=Compare(Sql("cast(p as double)"), ">", Sql("mean")))
    check = TableCheck(df, [rule], RUN, 1)
    assert check.summary().first()["no_of_failures"] == 1
    assert check.detail().first()["value"] == "9"


def test_enriched_rows_multiply_and_share_no_pass(frame):
    df = frame("k string", ("a",), ("b",))
    side = frame("K string, score int", ("a", 10), ("a", 90), ("b", 80))
    spec = GroupAggregate(("k",), (Calculation("avg", "score", "mean"),))
    rule = Rule("R", ("k",), enrich=Enrich("side"), aggregations=(spec,), having=Compare("mean", "<", 60))
    check = TableCheck(df, [build("DQ_001", "k"), rule], RUN, 1, tables={"side": side})
    totals = {r["rule_id"]: (r["total_record_count"], r["no_of_failures"]) for r in check.summary().collect()}
    assert totals == {"DQ_001": (2, 0), "R": (3, 2)}


def test_distinct_keeps_the_smallest_record(frame):
    df = frame("k string, p int", ("a", 3), ("a", 1), ("b", None), ("b", 2), ("c", 5), ("c", 5))
    assert sorted(map(tuple, distinct_rows(df, ["k"]).collect())) == [("a", 1), ("b", None), ("c", 5)]
    assert distinct_rows(df).count() == 5


def test_members_instead_of_collected_lists(frame):
    df = frame("k string, v string", ("a", "x"), ("a", "x"), ("a", "y"))
    assert sorted(map(tuple, group_members(df, ["k"], "v").collect())) == [("a", "x", 2), ("a", "y", 1)]
    with pytest.raises(ValueError, match="group_members"):
        aggregate_column(Calculation("collect_set", "v", "s"))


def test_join_by_name_ignores_case_and_null_keys(frame):
    left, right = frame("Id int, a string", (1, "x"), (None, "y")), frame("ID int, b string", (1, "p"), (None, "q"))
    joined = join_by_name(left, right, "left")
    assert joined.columns == ["Id", "a", "b"]
    assert sorted(map(tuple, joined.collect()), key=repr) == [(1, "x", "p"), (None, "y", None)]
    with pytest.raises(ValueError):
        join_by_name(left, frame("z int", (1,)))


@pytest.mark.parametrize("limit", [SizeLimit(), TINY, NONE])
def test_merges(frame, limit):
    target = frame("a string, b string, v int", *[("x", None, i) for i in range(8)], ("y", "1", 20), ("z", "1", 30))
    source = frame("a string, b string, v int", ("x", None, 100), ("y", "1", 200), ("y", "1", 201), ("w", "1", 300),
                   ("u", "1", 1))
    keys = ["a", "b"]
    inserted = insert_if_absent(target, source, keys, limit).collect()
    assert sorted(map(tuple, inserted)) == [("u", "1", 1), ("w", "1", 300)]
    merged = sorted(map(tuple, upsert(target, source, keys, limit).collect()), key=repr)
    assert ("y", "1", 200) in merged and ("y", "1", 20) not in merged and ("z", "1", 30) in merged
    assert sum(row[:2] == ("x", None) for row in merged) == 9  # NULL keys never match, so they are inserted
    replaced = sorted(map(tuple, delete_insert(target, source, keys, limit).collect()), key=repr)
    assert sum(row[0] == "x" for row in replaced) == 1 and sum(row[0] == "y" for row in replaced) == 2
    assert len(replaced) == 6


@pytest.mark.parametrize("limit", [SizeLimit(), SizeLimit(rows=1, bytes=10**6)])
def test_insert_reads_the_target_by_the_source_keys(frame, limit, monkeypatch):
    target = frame("k string, v int", *[("hot", i) for i in range(300)], *[(f"k{i}", i) for i in range(200)], (None, 1))
    source = frame("k string, v int", ("hot", 1), (None, 2), ("new", 3), ("new", 4))
    measured, whole = [], SizeLimit.after
    monkeypatch.setattr(SizeLimit, "after", lambda self, keyed, *rest: measured.append(keyed) or whole(self, keyed, *rest))
    inserted = insert_if_absent(target, source, ["k"], limit)
    assert [tuple(r) for r in inserted.collect()] == [("new", 3)]
    assert [m.count() for m in measured] == [3]  # the source's keys, not the target
    plan = inserted._jdf.queryExecution().optimizedPlan().toString().split("\n")
    semi = next(i for i, line in enumerate(plan) if "LeftSemi" in line)
    below = plan[semi + 1]
    assert "Aggregate" not in below  # the target goes into the semi join as it is


def test_without_keys_splits_hot_rows(frame):
    rows = frame("k string", *[("hot",)] * 9, *[("kept",)] * 9, ("a",), ("b",), (None,))
    gone = frame("k string", ("hot",), ("a",), ("c",), ("d",))
    left = without_keys(rows, gone, ["k"], False, SizeLimit(rows=3, bytes=10**6, hot_rows=5))
    assert Counter(r["k"] for r in left.collect()) == {"kept": 9, "b": 1, None: 1}


def test_only_failing_keys_are_broadcast_and_rows_are_not_shuffled(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    check = TableCheck(df, [build("DQ_005", ("l_orderkey", "l_linenumber"))], RUN, 1)
    plan = check.detail()._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan
    physical = check.detail()._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("limit", [SizeLimit(), SizeLimit(rows=3, bytes=10**6, hot_rows=20), NONE])
def test_spread_join_equals_a_plain_join(frame, how, limit):
    left = frame("k string, n int", *[("hot", i % 3) for i in range(60)], ("a", 1), ("b", 2), (None, 3))
    right = frame("K string, v int", ("hot", 1), ("hot", 2), ("a", 3), ("c", 4), (None, 5))
    plain = join_by_name(left, right, how, ["k"])
    spread = spread_join(left, right, ["k"], how, limit)
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "left_outer", "outer"])
@pytest.mark.parametrize("shares", [1, 5, 64])
def test_spread_join_with_hot_keys_on_both_sides(frame, how, shares):
    limit = SizeLimit(rows=4, bytes=1_000_000, hot_rows=6)
    left = frame("k string, n int", *[("both", i) for i in range(9)], *[("mine", i % 2) for i in range(8)],
                 *[("lonely", i) for i in range(7)], ("other", 1), ("a", 2), ("b", 3), (None, 4), (None, 5))
    right = frame("K string, v int", *[("both", i) for i in range(11)], *[("other", 7)] * 8, ("mine", 1),
                  *[("alone", i) for i in range(7)], ("a", 3), ("a", 4), ("c", 5), (None, 6))
    plain = join_by_name(left, right, how, ["k"])
    spread = spread_join(left, right, ["k"], how, limit, shares)
    assert spread.columns == plain.columns
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


def test_a_key_of_most_right_rows_is_spread(frame):
    limit = SizeLimit(rows=4, bytes=1_000_000, hot_rows=50)
    left = frame("k string, n int", *[("hot", i) for i in range(3)], *[(f"k{i}", i) for i in range(40)])
    right = frame("k string, v int", *[("hot", i) for i in range(750)], *[(f"k{i}", i) for i in range(250)])
    hot = joins._hot_on_either(left, ["k"], right, ["k"], limit, None)
    assert [tuple(r) for r in hot.collect()] == [("hot", False, True)]
    dealt = joins._in_cells(right, ["k"], hot, ("__right_hot", "__j"), ("__left_hot", "__i"), 16)
    cells = dealt.where("k = 'hot'").groupBy("__i", "__j").count().collect()
    assert len(cells) == 16 and sum(c["count"] for c in cells) == 750 and max(c["count"] for c in cells) < 150
    repeated = joins._in_cells(left, ["k"], hot, ("__left_hot", "__i"), ("__right_hot", "__j"), 16)
    assert repeated.where("k = 'hot'").count() == 3 * 16 and repeated.where("k <> 'hot'").count() == 40
    plan = spread_join(left, right, ["k"], "full", limit, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join FullOuter" in plan and "Cartesian" not in plan


def test_small_cells_with_many_pairs_stay_apart(frame):
    limit = SizeLimit(rows=4, bytes=1_000_000, hot_rows=50)
    left = frame("k string, n int", *[("hot", i) for i in range(3)], ("a", 1))
    right = frame("k string, v int", *[("hot", i) for i in range(750)], ("b", 2))
    for how, rows in (("full", 2252), ("right", 2251)):
        spread = spread_join(left, right, ["k"], how, limit, 16)
        tasks = spread.groupBy(F.spark_partition_id().alias("task")).count().collect()
        assert len(tasks) >= 8 and sum(t["count"] for t in tasks) == rows
    physical = spread_join(left, right, ["k"], "full", limit, 16)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in physical  # it would hold all pairs of a key


def test_a_distinct_rule_keeps_no_record_it_does_not_read(frame):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "c", -0.0), (2, "c", 0.0), (None, "d", 1.0), (None, "e", None)]
    table, known = frame("k bigint, wide string, x double", *rows), frame("n bigint", (1,))
    for columns, flagged in ((("k",), [-1, 0, 1]), (("x", "k"), [-1, -1, 0, 0, 1, 1])):
        rule = Rule("R", ("k",), distinct=True, distinct_columns=columns, references=(Reference("known", ("n",)),))
        flags = TableCheck(table, [rule], "2026-01-01 00:00:00", 1, tables={"known": known}).flags(rule)
        read = flags.select(*columns, "rule_violation_flag")
        assert "min(" not in read._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(r["rule_violation_flag"] for r in read.collect()) == flagged
