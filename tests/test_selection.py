"""Quantiles and modes against numpy, with a group of a third of all rows dealt over many tasks."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaywright import Calculation, Compare, GroupAggregate, Rule, Sql
from assaywright.operators import selection
from assaywright.operators.groups import group_facts
from assaywright.plans.table_check import TableCheck


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(2)
    out = [("hot", draw.choice([draw.gauss(0, 50), float(draw.randrange(9))])) for _ in range(3000)]
    out += [(f"g{draw.randrange(40)}", round(draw.uniform(-5, 5), 1)) for _ in range(5000)]
    return out + [(None, 1.0), (None, 2.0), ("one", 7.5), ("none", None), ("none", None), ("same", 3.0), ("same", 3.0), ("pair", 1.0), ("pair", 2.0)]


def members(rows):
    groups = defaultdict(list)
    for k, v in rows:
        groups[k] += [] if v is None else [v]
    return groups


def test_quantiles(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    points = {"least": 0.0, "low": 0.01, "q1": 0.25, "middle": 0.5, "high": 0.999, "most": 1.0}
    got = {r["k"]: r for r in selection.group_quantiles(df, ["k"], "v", points).collect()}
    want = {k: v for k, v in members(rows).items() if v}
    assert set(got) == set(want)
    for k, values in want.items():
        for name, point in points.items():
            assert got[k][name] == pytest.approx(np.quantile(values, point), abs=1e-9)


def test_modes(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in selection.group_modes(df, ["k"], "v", "m").collect()}
    for k, values in members(rows).items():
        if values:
            counts = Counter(values)
            assert got[k] == min(counts, key=lambda v: (-counts[v], v))


def test_a_large_group_is_dealt_over_many_tasks(spark, rows, monkeypatch):
    spread = []
    keep = selection.stored

    def watched(df, paths):
        out = keep(df, paths)
        spread.extend(r["n"] for r in out.where("k = 'hot'").groupBy(selection.PART).agg(F.count(F.lit(1)).alias("n")).collect())
        return out

    monkeypatch.setattr(selection, "stored", watched)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = selection.group_quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", {"m": 0.5})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert len(spread) > 1 and "percentile" not in text and "collect" not in text.lower() and "SinglePartition" not in text


def test_facts_with_conditions_and_null_keys(spark, rows):
    df = spark.createDataFrame([(k, None if v is None else str(v), "x" if i % 2 else "y") for i, (k, v) in enumerate(rows)], "k string, v string, f string")
    calculations = (
        Calculation("median", "v", "middle"), Calculation("percentile", "v", "high", where=Compare("f", "=", "x"), at=0.9),
        Calculation("mode", "f", "usual"), Calculation("count", "*", "n"),
    )
    got = {r["k"]: r for r in group_facts(df, {"k": F.col("k")}, calculations).collect()}
    odd = members([(k, v if i % 2 else None) for i, (k, v) in enumerate(rows)])
    for k, values in members(rows).items():
        assert got[k]["middle"] == (pytest.approx(np.median(values)) if values else None)
        assert got[k]["high"] == (pytest.approx(np.quantile(odd[k], 0.9)) if odd[k] else None)
    assert got[None]["n"] == 2 and got["none"]["__n"] == 2
    with pytest.raises(ValueError):
        group_facts(df, {"k": F.col("k")}, (Calculation("percentile", "v", "p"),))


def test_rules_on_medians(spark, rows):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "n int, k string, v double")
    per_group = Rule("R", ("k",), aggregations=(GroupAggregate(("k",), (Calculation("median", "v", "middle"),)),), having=Compare("middle", ">", 0))
    flags = {int(r["n"]): r["rule_violation_flag"] for r in TableCheck(df, [], "2026-01-01 00:00:00").flags(per_group).collect()}
    groups = members(rows)
    assert flags == {i: -1 if k is None else int(bool(groups[k]) and np.median(groups[k]) > 0) for i, (k, _) in enumerate(rows)}
    whole = Rule("W", ("v",), aggregations=(GroupAggregate((), (Calculation("median", "v", "middle"),)),),
                 having=Compare(Sql("cast(v as double)"), ">", Sql("middle")))
    flags = {int(r["n"]): r["rule_violation_flag"] for r in TableCheck(df, [], "2026-01-01 00:00:00").flags(whole).collect()}
    middle = np.median([v for _, v in rows if v is not None])
    assert flags == {i: -1 if v is None else int(v > middle) for i, (_, v) in enumerate(rows)}
