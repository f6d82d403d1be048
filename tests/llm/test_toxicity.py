"""Toxicity: scores against a plain re-computation, held-out quality, odd rows."""

import random
import zlib

import numpy as np
import pandas as pd
import pytest

from assaywright.llm import toxicity

SMALL = toxicity.Settings(toxic=400, clean=400, bits=16, width=8)
GOOD = "river stone cloud paper window garden letter music summer bread table winter forest bridge market".split()
BAD = ["grumblewort", "snarkface", "plodhead"]


def labelled(n=600, seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = [draw.choice(GOOD) + draw.choice(["", "s", "ing", "ed"]) for _ in range(draw.randint(5, 90))]
        toxic = i % 3 == 0
        for _ in range(2 * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = labelled()
    sample = pd.DataFrame({"toxic": [bool(t) for *_, t in rows], "windows": [toxicity.drawn_windows(x, SMALL) for _, x, _ in rows]})
    weights, bias = toxicity.trained(sample, SMALL)
    return toxicity.Model(weights, bias, SMALL)


def plain_score(text, model):
    """Windows of distinct words, averaged over their subwords, one at a time."""
    words = [w for block in toxicity.words_of(text or "") for w in block]
    step, size = SMALL.window // 2, SMALL.window
    best = None
    for at in range(0, max(1, len(words) - step), step):
        slots = [s for w in set(words[at : at + size]) for s in toxicity.subwords([w], SMALL.bits)[0]]
        value = sum(float(model.weights[s]) for s in slots) / max(len(slots), SMALL.least_subwords)
        best = value if best is None else max(best, value)
    return 1 / (1 + np.exp(-(best + model.bias)))


def test_scores_are_those_of_the_worst_window(model):
    texts = [x for _, x, _ in labelled(30, 9)] + ["", None, "...", "a", "plodhead", "plodhead " * 500, "x" * 5000, "été \U0001f600 " * 40]
    got = toxicity.Scorer(model).scores(texts)
    assert got == pytest.approx([plain_score(t, model) for t in texts], abs=1e-6)
    long = " ".join(GOOD * 30_000)
    assert toxicity.Scorer(model).scores([long + " snarkface plodhead " + long])[0] > toxicity.Scorer(model).scores([long])[0]


def test_new_texts_and_misspellings(model):
    rows = labelled(90, 77)
    got = toxicity.Scorer(model).scores([x for _, x, _ in rows])
    assert np.mean([(s >= 0.7) == bool(t) for s, (*_, t) in zip(got, rows)]) > 0.95
    clean = " ".join(GOOD[:8])
    base, *changed = toxicity.Scorer(model).scores([clean, *(f"{clean} {w}" for w in ("grumblewart", "snarkfacee", "plodheads", "plodhaed"))])
    assert min(changed) > base and sorted(changed)[1] > 10 * base


def test_words_beyond_memory_are_learned_again(model, monkeypatch):
    texts = [x for _, x, _ in labelled(700, 5)]
    want = toxicity.Scorer(model).scores(texts)
    monkeypatch.setattr(toxicity, "_MANY_WORDS", 3)
    assert toxicity.Scorer(model).scores(texts) == want


def test_subwords_of_one_are_those_among_many():
    words = [b"a", b"idiot", b"", b"...", "été".encode(), b"worthless,"]
    slots, counts = toxicity.subwords(words, 16)
    each = [toxicity.subwords([w], 16)[0].tolist() for w in words]
    assert slots.tolist() == [s for part in each for s in part] and counts.tolist() == [len(p) for p in each]
    assert counts.tolist()[:2] == [2, 1 + 5 + 4 + 3] and counts[2] == counts[3] == 0


def test_report(spark, docs_of):
    rows = labelled()
    docs = docs_of(*[(i, x) for i, x, _ in rows], (None, "plodhead here"), (900, None), (901, ""), (901, ""), (902, "... !"), (0, rows[0][1]))
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows] + [(None, 1, 1), (900, 0, None), (903, 0, 1), (1, 1, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.report(docs, labels, SMALL).collect()
    assert len(found) == len(rows) + 6
    assert all(r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in found)
    told = dict((i, t) for i, _, t in rows)
    out = [(r["predicted"], told[r["doc_id"]]) for r in found if r["held_out"] and r["doc_id"] in told]
    assert np.mean([p == t for p, t in out]) > 0.9
    empty = {r["score"] for r in found if r["doc_id"] in (900, 901, 902)}
    assert len(empty) == 1
    turned = labels.withColumn("toxic", (1 - labels.toxic).cast("int")).where("crc32(cast(doc_id as string)) % 3 = 1")
    kept = labels.where("crc32(cast(doc_id as string)) % 3 <> 1")
    again = toxicity.report(docs, kept.unionByName(turned), SMALL).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["score"])
    assert sorted(again, key=key) == sorted(found, key=key)


def test_nothing_to_learn_from(spark, docs_of):
    docs = docs_of((1, "a text"), (2, None))
    for rows in ([], [(1, 1, 1)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
        assert {(r["score"], r["predicted"]) for r in toxicity.report(docs, labels).collect()} == {(0.0, 0)}
    labels = spark.createDataFrame([(7, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.report(docs, labels).collect()} == {0.0}
    assert toxicity.report(docs.limit(0), labels).collect() == []
