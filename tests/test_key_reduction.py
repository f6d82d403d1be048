"""Key rules that share one scan: against brute force, with slices, skew and mixed key types; the plan; exact numbers."""

import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from assaywright import Between, Calculation, Compare, GroupAggregate, Matches, Param, Reference, Rule, Sql, if_then
from assaywright.catalog.builtin import build
from assaywright.operators import key_reduction
from assaywright.operators.joins import SizeLimit
from assaywright.plans import table_check
from assaywright.plans.table_check import TableCheck

RUN = "2026-01-01 00:00:00"
NONE = SizeLimit(rows=0, bytes=0, hot_rows=1_000_000)


def grouped(rule_id, column, *calculations, having):
    return Rule(rule_id, (column,), composite_columns=("n",), aggregations=(GroupAggregate((column,), calculations),), having=having)


RULES = [
    build("DQ_005", "k", composite_columns=("n",)),
    build("DQ_005", ("k", "p"), composite_columns=("n",)),
    build("DQ_005", "k", digest=True, composite_columns=("n",)).bind(rule_id="digest"),
    grouped("sum", "p", Calculation("sum", "n", "total"), having=Compare("total", ">", 9000)),
    grouped("avg", "k", Calculation("avg", "n", "mean"), Calculation("max", "t", "top"), having=Compare("mean", "<", 250)),
    grouped("few", "k", Calculation("count", "*", "zeros", where=Compare("p", "=", 0)), having=Compare("zeros", "<", 2)),
    build("DQ_003", "k", reference=Reference("names", ("code",)), composite_columns=("n",)),
    build("DQ_004", "p", reference=Reference("numbers", ("id",)), composite_columns=("n",)),
    build("DQ_004", "p", reference=Reference("texts", ("id",)), composite_columns=("n",)).bind(rule_id="texts"),
    build("DQ_004", ("p", "k"), reference=Reference("pairs", ("id", "code")), composite_columns=("n",)).bind(rule_id="pairs"),
    Rule("some", ("k",), composite_columns=("n",), violation=Compare("p", ">", 3), references=(Reference("names", ("code",)),)),
]


@pytest.fixture
def world(frame):
    rng = random.Random(5)
    keys = ["hot"] * 150 + [f"k{rng.randrange(90)}" for _ in range(280)] + [None, " null ", ""] * 6
    rng.shuffle(keys)
    rows = [(i, k, i % 8 if i % 13 else None, f"t{i % 10}", 20240101 + i % 3, 2020 + i % 2) for i, k in enumerate(keys)]
    tables = {
        "names": frame("code string", *[(f" K{i} ",) for i in range(0, 90, 2)], (None,)),
        "numbers": frame("id bigint", *[(i,) for i in (0, 2, 4, 6, None)]),
        "texts": frame("id string", ("0",), (" 2 ",), ("04",), (None,)),
        "pairs": frame("id int, code string", *[(i % 8, f"k{i}") for i in range(90)]),
    }
    return rows, frame("n int, k string, p int, t string, load_date int, year_id int", *rows), tables


def missing(value):
    return value is None or str(value).strip(" ").upper() in ("", "NULL")


def brute(rows):
    """Failing rows of each rule, by the row's number."""
    def groups(columns, keep=lambda r: True):
        members = defaultdict(list)
        for r in rows:
            if all(not missing(r[c]) for c in columns) and keep(r):
                members[tuple(r[c] for c in columns)].append(r)
        return members

    def failing(columns, test):
        return {r[0] for members in groups(columns).values() if test(members) for r in members}

    evens = {f"K{i}" for i in range(0, 90, 2)}
    pairs = {(i % 8, f"K{i}") for i in range(90)}
    return {
        ("DQ_005", "k"): failing([1], lambda m: len(m) > 1), ("DQ_005", "k,p"): failing([1, 2], lambda m: len(m) > 1),
        ("digest", "k"): failing([1], lambda m: len(m) > 1), ("sum", "p"): failing([2], lambda m: sum(r[0] for r in m) > 9000),
        ("avg", "k"): failing([1], lambda m: sum(r[0] for r in m) / len(m) < 250),
        ("few", "k"): failing([1], lambda m: sum(r[2] == 0 for r in m) == 1),
        ("DQ_003", "k"): failing([1], lambda m: m[0][1].strip().upper() not in evens),
        ("DQ_004", "p"): failing([2], lambda m: m[0][2] not in (0, 2, 4, 6)),
        ("texts", "p"): failing([2], lambda m: m[0][2] not in (0, 2)),
        ("pairs", "p,k"): failing([2, 1], lambda m: (m[0][2], m[0][1].strip().upper()) not in pairs),
        ("some", "k"): {r[0] for r in rows if not missing(r[1]) and (r[2] or 0) > 3 and r[1].strip().upper() not in evens},
    }


@pytest.mark.parametrize("limit,fixed", [(SizeLimit(), False), (NONE, True)])
def test_shared_rules(world, limit, fixed):
    rows, df, tables = world
    slices = (20240101, 2020) if fixed else (None, None)
    check = TableCheck(df, RULES, RUN, *slices, tables=tables, limit=limit)
    want = brute(rows)
    found = defaultdict(list)
    for r in check.detail().collect():
        if r["result"] == 1:
            found[(r["rule_id"], r["attribute_name"])].append(int(r["value1"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items() if v}
    counted = check.summary().collect()
    by_n = {r[0]: (2020, 20240101) if fixed else (r[5], r[4]) for r in rows}
    for key, numbers in want.items():
        per_slice = Counter(by_n[n] for n in numbers)
        got = {(s["year_id"], s["batch_id"]): s for s in counted if (s["rule_id"], s["attribute_name"]) == key}
        assert {k: s["no_of_complete_records"] - s["total_passed_count"] for k, s in got.items()} == {k: per_slice[k] for k in got}
    check.release()


def test_alone_and_shared_agree(world):
    _, df, tables = world
    rules = RULES[1:10:3]
    together = TableCheck(df, rules, RUN, tables=tables).summary()
    alone = [TableCheck(df, [rule], RUN, tables=tables).summary() for rule in rules]
    assert sorted(map(tuple, together.collect())) == sorted(tuple(r) for s in alone for r in s.collect())


def test_one_scan_and_one_shuffle(world, tmp_path, spark, monkeypatch):
    _, df, tables = world
    df.write.parquet(str(tmp_path / "t"))
    plans = []
    keep = table_check.stored

    def watched(frame, paths, by=()):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(frame, paths, by)

    monkeypatch.setattr(table_check, "stored", watched)
    rules = [r for r in RULES if not r.references]
    check = TableCheck(spark.read.parquet(str(tmp_path / "t")), rules, RUN, 1, 1, tables=tables)
    check._share_key_rules()
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and len(re.findall(r"Exchange hashpartitioning", plans[0])) == 1
    assert "t2" not in plans[0] and "collect" not in plans[0].lower()
    check.summary().collect(), check.detail().collect()
    assert len(plans) == 1
    check.release()


@pytest.mark.parametrize("fixed", [True, False])
def test_references_are_grouped_with_the_rows(world, frame, monkeypatch, fixed):
    rows, df, tables = world
    tables = tables | {"numbers": frame("id bigint", *[(i,) for i in (0, 2, 4, 6, None)] * 40)}
    plans, keep = [], table_check.stored

    def watched(kept, paths, by=()):
        plans.append(kept._jdf.queryExecution().optimizedPlan().toString())
        return keep(kept, paths, by)

    monkeypatch.setattr(table_check, "stored", watched)
    rules = [r for r in RULES if r.references]
    check = TableCheck(df, rules, RUN, *((1, 1) if fixed else (None, None)), tables=tables)
    found = defaultdict(list)
    for r in check.detail().collect():
        if r["result"] == 1:
            found[(r["rule_id"], r["attribute_name"])].append(int(r["value1"]))
    want = {k: sorted(v) for k, v in brute(rows).items() if v and k in {(r.rule_id, ",".join(r.columns)) for r in rules}}
    assert {k: sorted(v) for k, v in found.items()} == want
    assert len(plans) == 1 and "Join" not in plans[0]
    check.release()


def test_keys_of_fixed_slices_are_not_grouped_again(world):
    _, df, tables = world
    for fixed in (True, False):
        check = TableCheck(df, RULES, RUN, *((1, 1) if fixed else (None, None)), tables=tables)
        check._share_key_rules()
        for rule in RULES:
            keys, verdicts = check._verdicts(rule)
            assert ("Aggregate" in verdicts._jdf.queryExecution().optimizedPlan().toString()) == (not fixed)
            assert verdicts.count() == verdicts.select(*keys).distinct().count()
        check.release()


def test_failing_keys_hold_whole_numbers_as_numbers(world):
    _, df, tables = world
    check = TableCheck(df, RULES, RUN, 1, 1, tables=tables)
    kinds = {r.rule_id + ",".join(r.columns): [k for k, _ in check._key_task(0, r).keys] for r in RULES}
    assert kinds["DQ_004p"] == ["bigint"] and kinds["textsp"] == ["string"] and kinds["pairsp,k"] == ["bigint", "string"]
    assert kinds["digestk"] == ["binary"] and not key_reduction.shareable((Calculation("stddev", "n", "s"),), True)


BIG = 2**53


@pytest.mark.parametrize("schema", ["v bigint", "v string", "v decimal(20,2)"])
@pytest.mark.parametrize("condition,want", [
    (Compare("v", "=", BIG + 1), [0, 1, 0]), (Compare("v", ">", BIG), [0, 1, 1]), (Compare("v", "<=", BIG + 1), [1, 1, 0]),
    (Between("v", BIG + 1, BIG + 1), [0, 1, 0]), (Compare("v", ">", Param("limit")), [0, 0, 1]),
    (Compare("v", ">=", Decimal(BIG) + Decimal("1.5")), [0, 0, 1]), (Compare("v", "<>", BIG + 2, negate=True), [0, 0, 1]),
])
def test_large_numbers_are_told_apart(frame, schema, condition, want):
    values = [BIG, BIG + 1, BIG + 2]
    shaped = [(str(v),) if "string" in schema else (Decimal(v),) if "decimal" in schema else (v,) for v in values]
    rule = Rule("R", ("v",), violation=condition, thresholds=(("limit", f"{BIG + 1}.25"),))
    flags = TableCheck(frame(schema, *shaped), [], RUN).flags(rule).orderBy("v").collect()
    assert [r["rule_violation_flag"] for r in flags] == want


def test_text_numbers_of_any_form(flag_of):
    flags = flag_of(Rule("R", ("v",), violation=Compare("v", ">", 100)), ["1e2", " 101 ", "1e300", "-1e300", "abc", "100.000000001", "NaN", "1e-40"])
    assert [f for f, _ in flags] == [0, 1, 1, 0, 0, 1, 1, 0]


def test_sums_are_exact(frame):
    rows = [(1, BIG, Decimal("0.10"), 0.5), (1, 1, Decimal("0.20"), 0.25), (2, BIG, Decimal("0.10"), 0.5)]
    spec = GroupAggregate(("g",), (Calculation("sum", "b", "whole"), Calculation("sum", "d", "dec"), Calculation("sum", "f", "double")))
    for condition in (Compare("whole", "=", BIG + 1), Compare("dec", "=", Decimal("0.3")), Compare("double", "=", 0.75)):
        rule = Rule("R", ("g",), aggregations=(spec,), having=condition)
        flags = TableCheck(frame("g int, b bigint, d decimal(10,2), f double", *rows), [], RUN).flags(rule).collect()
        assert sorted((r["g"], r["rule_violation_flag"]) for r in flags) == [("1", 1), ("1", 1), ("2", 0)]


def test_rules_from_json():
    rules = RULES + [
        Rule("R1", ("zip",), violation=if_then(Compare("country", "=", "US"), Matches("zip", r"^\d{5}$")), composite_columns=()),
        Rule("R2", violation=Compare(Sql("a - b"), ">", Decimal("1.50")), thresholds=(("x", 1), ("y", "2"))),
        build("DQ_014", "g"),
    ]
    for rule in rules:
        assert Rule.from_json(rule.to_json()) == rule
    plain = '{"rule_id": "R", "columns": ["a"], "violation": {"kind": "Compare", "field": "a", "op": ">", "value": 3}}'
    assert Rule.from_json(plain) == Rule("R", ("a",), violation=Compare("a", ">", 3))
    for bad in ('{"columns": ["a"], "rule_id": "R", "violation": {"kind": "Run", "field": "a"}}', '{"rule_id": "R", "colour": 1}', "[]"):
        with pytest.raises(ValueError):
            Rule.from_json(bad)
