"""Marks of repeated strings: as few rows as pieces, the same bytes as string by string."""

import random

import numpy as np
import pyarrow as pa

from assaywright.llm import repeats
from assaywright.llm.runindex import suffix_array


def test_crowded_pieces_are_settled_whole(spark):
    rng = random.Random(3)
    same = bytes(rng.choices(b"abcd", k=64))
    other = same[:56] + b"zzzzzzzz"
    rows = [(1, doc, 0, 100, 30, bytearray(same)) for doc in range(1, 40)] + [(1, 40, 0, 7, 30, bytearray(other))]
    marks = repeats._crowded(spark.createDataFrame(rows, repeats.TEXTS), []).collect()
    bits = (1 << repeats.SPAN_BITS) - 1
    got = {}
    for m in marks:
        start = m["span"] >> repeats.SPAN_BITS
        got.setdefault(m["doc"], set()).update(range(start, start + (m["span"] & bits)))
    assert len(marks) == 38 + 7  # one row for each equal piece, one for each string of the other that ends before its 57th byte
    assert got == {doc: set(range(100, 164)) for doc in range(2, 40)} | {40: set(range(7, 63))}


def test_merged_spans():
    rng = random.Random(5)
    want, spans = [], []
    for n in (0, 1, 5, 40, 0, 200):
        own = [(rng.randrange(2000), rng.randrange(50, 81)) for _ in range(n)]
        spans.append([s << repeats.SPAN_BITS | k for s, k in own])
        runs = []
        for s, k in sorted(own):
            if runs and s <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], s + k)
            else:
                runs.append([s, s + k])
        want.append(runs)
    ids = list(range(len(spans)))
    table = pa.RecordBatch.from_pydict({"doc": ids, "print": ids, "spans": pa.array(spans, pa.list_(pa.int64()))})
    for batch in (table, table.slice(2)):
        (out,) = repeats._merged(iter([batch]))
        got = [list(map(list, zip(a, b))) for a, b in zip(out.column("starts").to_pylist(), out.column("ends").to_pylist())]
        assert got == want[len(want) - batch.num_rows :]


def test_suffix_array():
    rng = random.Random(7)
    for n, kinds in ((1, 1), (2, 1), (50, 1), (300, 2), (3000, 3), (500, 1 << 40)):
        text = np.array([rng.randrange(kinds) + 5 for _ in range(n - 1)] + [1])
        suffixes = sorted(range(n), key=lambda i: text[i:].tolist())
        assert suffix_array(text).tolist() == suffixes
