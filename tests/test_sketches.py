import math
import statistics

from assaywright.operators import sketches

import pytest


def test_parts_merge_to_the_whole(frame, spark, tmp_path):
    rows = [(f"v{i % 700}", str(i * 1.5) if i % 3 else " ", i % 5) for i in range(6000)]
    df, target = frame("a string, b string, batch int", *rows), str(tmp_path / "profile")
    sketches.store_parts(df.where("batch < 2"), ["a", "b"], target, "first", ["batch"])
    sketches.store_parts(df.where("batch < 4"), ["a", "b"], target, "second", ["batch"])
    sketches.store_parts(df.where("batch >= 2"), ["a", "b"], target, "second", ["batch"])  # replaces the wrong one
    found = {r["column"]: r for r in sketches.stored_profile(spark, target).collect()}
    a, b = found["a"], found["b"]
    numbers = [float(r[1]) for r in rows if r[1] != " "]
    assert (a["rows"], a["missing"], a["numbers"], a["mean"], a["stddev"], a["quartiles"]) == (6000, 0, 0, None, None, None)
    assert abs(a["approx_distinct"] - 700) <= 700 * sketches.DISTINCT_ERROR
    assert (b["rows"], b["missing"], b["numbers"], b["min_number"], b["max_number"]) == (6000, 2000, 4000, 1.5, max(numbers))
    assert math.isclose(b["mean"], statistics.mean(numbers)) and math.isclose(b["stddev"], statistics.stdev(numbers))
    errors = sketches.rank_errors(df, sketches.stored_profile(spark, target)).collect()
    assert {r["column"]: r["rank_error"] <= sketches.RANK_ERROR for r in errors} == {"a": True, "b": True}
    by_batch = sketches.stored_profile(spark, target, ["batch"]).where("column = 'b'")
    assert by_batch.count() == 5 and by_batch.agg({"rows": "sum"}).first()[0] == 6000


def test_rank_errors_are_exact(frame, spark):
    df = frame("a string", *[(str(i),) for i in range(100)], ("nan?",))
    estimates = spark.createDataFrame([("a", [25.0, 60.0, 75.0])], "column string, quartiles array<double>")
    assert sketches.rank_errors(df, estimates).first()["rank_error"] == pytest.approx(0.1)


def test_profiles_of_nothing(frame):
    nothing = frame("a string")
    part = sketches.profile_parts(nothing, ["a"])
    row = sketches.merged_profile(part).first()
    assert (row["rows"], row["approx_distinct"], row["quartiles"], row["mean"]) == (0, 0, None, None)
    odd = frame("a string", ("NaN",), (None,), ("7",))
    row = sketches.merged_profile(sketches.profile_parts(odd, ["a"])).first()
    assert row["quartiles"] == [7.0, 7.0, 7.0] and row["numbers"] == 2
