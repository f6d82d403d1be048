"""What line templates store and shuffle, and tokens that masks must not confuse."""

import time

from test_templates import TREE, brute

from assaywright.llm import templates


def test_stored_lines_and_spots(docs_of, monkeypatch):
    kept = []

    def stored(df, paths, by=()):
        kept.append(df)
        return df.localCheckpoint()

    monkeypatch.setattr(templates, "stored", stored)
    rows = [(i, f"a  b{i}\t<*> c<*> x٣ y\nsay {i} of it <*> z-{i}-z now\n{'q' * 50} w{'q' * i}{i} e r t") for i in range(6)]
    df = docs_of(*rows, (7, "a b <*> c<*> x٣ y"), (8, "<*> <*> <*> 1"), (9, None))
    want = brute([(r["doc_id"], r["text"]) for r in df.collect()], TREE)
    got = [tuple(r) for r in templates.report(df, TREE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    kinds = [dict(df.dtypes) for df in kept]
    lines = next(k for k in kinds if "tokens" in k)
    assert lines["tokens"] == "string"  # one text, not an array with a length for each token
    constant = [k for k in kinds if "__n" in k and ("at" in k or "spot" in k)]
    assert constant == [{"spot": "bigint", "__n": "bigint"}]


def test_long_tokens_are_masked_in_one_pass(spark):
    text = "x" * 1_000_000 + " b c " + "y" * 1_000_000 + "1 d"
    began = time.time()
    shown = spark.createDataFrame([(text,)], "said string").select(templates._masked(templates.F.col("said")).alias("m")).first()["m"]
    assert shown == "x" * 1_000_000 + " b c <*> d" and time.time() - began < 20
