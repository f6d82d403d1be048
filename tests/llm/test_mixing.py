import math
import re

import pytest


from assaywright.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """By rounds: every source gets its share by weight, those above the cap stop there, the excess is dealt anew."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * share, set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            out.update({s: level * weight[s] for s in open_})
            break
        out.update({s: float(most * sizes[s]) for s in full})
        left -= sum(most * sizes[s] for s in full)
        open_ -= full
    return out


def check(rows, texts_by_id):
    sizes = {}
    for r, source in rows:
        sizes[source] = sizes.get(source, 0) + r["size"]
    want = targets(sizes)
    longest, taken = {}, {}
    for r, source in rows:
        assert r["source_size"] == sizes[source]
        assert math.isclose(r["target"], want[source], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        longest[source] = max(longest.get(source, 0), r["size"])
        taken[source] = taken.get(source, 0) + r["taken"]
    for source in sizes:
        assert abs(taken[source] - want[source]) <= longest[source]


def test_documents(spark, documents):
    rows = mixing.mix_report(documents).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(r["size"] == len(words(text[r["doc_id"]])) for r in rows)
    check([(r, source[r["doc_id"]]) for r in rows], text)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_report(documents.repartition(5)).collect()))
    taken = sum(r["taken"] for r in rows)
    assert abs(taken / sum(r["size"] for r in rows) - 1.5) < 0.1


def test_one_source_holds_most(docs_of):
    rows = [(i, "a b c d e " * (1 + i % 4), "en", "big" if i % 10 else f"small{i % 3}") for i in range(300)]
    df = docs_of(*rows)
    source = {i: s for i, _, _, s in rows}
    found = mixing.mix_report(df).collect()
    check([(r, source[r["doc_id"]]) for r in found], None)
    drawn = mixing.mixed(df)
    assert drawn.columns == df.columns
    assert drawn.count() == sum(r["taken"] // r["size"] for r in found)


def test_odd_rows(docs_of):
    df = docs_of((1, None, "en", None), (None, "a b", "en", "s"), (None, "a b", "en", "s"), (2, "", None, "s"), (3, " \t\n", "en", "t"), (4, "x\x0by z", "en", None))
    rows = {(r["doc_id"], r["size"]): r for r in mixing.mix_report(df).collect()}
    assert {k[1] for k in rows} == {0, 2, 3}
    assert rows[(1, 0)]["taken"] == 0 and rows[(1, 0)]["source_size"] == 3 and rows[(3, 0)]["target"] == 0
    assert all(r["text"] for r in mixing.mixed(df).collect())


def test_no_rows(docs_of):
    empty = docs_of((1, "a")).where("false")
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_order_follows_the_curriculum(docs_of):
    rows = [(i, "w " * 10, "en", "early" if i % 2 else "late") for i in range(400)]
    cur = mixing.Curriculum(weights=(1, 1), slopes=(-0.9, 0.9), share=0.5)
    df = docs_of(*rows)
    order = [r["source"] for r in mixing.mixed(df, cur).collect()]
    half = len(order) // 2
    assert order[:half].count("early") > 0.6 * half
    assert order[half:].count("late") > 0.6 * half


def test_place_inverts_the_integrated_schedule(spark):
    from pyspark.sql import functions as F

    df = spark.range(1, 100).select((F.col("id") / 100).alias("t"), F.explode(F.array(*[F.lit(x) for x in (-0.9, -0.3, 0.0, 0.5, 0.9)])).alias("a"))
    demand = F.lit(1000.0) * (F.col("t") * (1 - F.col("a")) + F.col("a") * F.col("t") * F.col("t"))
    worst = df.select(F.max(F.abs(mixing.place(demand, F.lit(1000.0), F.col("a")) - F.col("t")))).first()[0]
    assert worst < 1e-9
    with pytest.raises(ValueError):
        mixing.Curriculum(slopes=(1.0,))
