"""Work of repeat removal: in proportion to the corpus, whatever is common in it, and the same bytes as by brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from assaywright.llm import repeats


def noise(rng, n, signs=b"abcdefghijklmnopqrstuvwxyz"):
    return bytes(rng.choices(signs, k=n))


def batches_of(texts, rows):
    for i in range(0, len(texts), rows):
        part = texts[i : i + rows]
        yield pa.RecordBatch.from_pydict({"doc": pa.array([d for d, _ in part], pa.int64()), "print": pa.array([0] * len(part), pa.int64()), "text": [t.decode() for _, t in part]})


def sizes_of(packed):
    found = {}
    for batch in packed:
        for b, blob in zip(*(c.to_pylist() for c in batch.columns)):
            if b >= 0:
                found.setdefault(b, []).append(len(repeats._unpack(blob, zstandard.ZstdDecompressor())[0]))
    return found


def brute(texts):
    first = {}
    for d, t in texts:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], d), d)
    gone = {d: {j for i in range(len(t) - 49) if first[t[i : i + 50]] < d for j in range(i, i + 50)} for d, t in texts}
    return {d: x for d, x in gone.items() if x}


def bytes_of(spans, texts):
    texts, gone = dict(texts), {}
    for d, span in spans:
        start = span >> repeats.SPAN_BITS
        gone.setdefault(d, set()).update(range(start, min(start + (span & ((1 << repeats.SPAN_BITS) - 1)), len(texts[d]))))
    return gone


def bounded(pieces):
    for batch in pieces:
        left = batch.column("mark").to_numpy() >= repeats.SPLIT
        low, high = (pa.array(np.where(left, a, b).astype(np.int32)) for a, b in ((-30, -15), (-16, 0)))
        yield pa.RecordBatch.from_arrays([*batch.columns, low, high], schema=repeats._HALVES)


def sorted_by(batches, *columns):
    return pa.Table.from_batches(list(batches)).sort_by([(c, "ascending") for c in columns]).combine_chunks().to_batches()


def test_anchors_of_small_batches_are_packed_together():
    rng = random.Random(1)
    texts = [(d, noise(rng, 700)) for d in range(400)]
    sizes = sizes_of(repeats._anchored(64)(batches_of(texts, 5)))
    assert len(sizes) == 64 and all(len(s) == 1 for s in sizes.values())  # before: a piece for every batch of five documents


def test_buckets_are_of_one_size():
    rng = random.Random(2)
    texts = [(d, noise(rng, 5000)) for d in range(200)]
    sizes = [sum(s) for s in sizes_of(repeats._anchored(64)(batches_of(texts, 50))).values()]
    assert len(sizes) == 64 and max(sizes) < 1.5 * np.mean(sizes)  # before: anchors, the least hashes around, were in the first ones


def test_common_anchors_are_dealt():
    rng = random.Random(3)
    line = noise(rng, 45)
    texts = [(d, noise(rng, 40) + line + noise(rng, 40)) for d in range(3000)]
    sizes = [sum(s) for s in sizes_of(repeats._anchored(64)(batches_of(texts, 500))).values()]
    assert max(sizes) < 2 * np.mean(sizes)  # before: 3,000 of an anchor in one


@pytest.mark.parametrize("most, indexed, symbols", [(64, 32, 1 << 20), (2, 2, 4000), (3, 0, 1)])
def test_steps_against_brute_force(monkeypatch, most, indexed, symbols):
    monkeypatch.setattr(repeats, "INDEXED", indexed)
    monkeypatch.setattr(repeats, "INDEX_SYMBOLS", symbols)
    monkeypatch.setattr(repeats, "BATCH_ANCHORS", 150)
    rng = random.Random(most)
    passages = [noise(rng, rng.randrange(30, 200), b"ab cd") for _ in range(12)] + [b"ab" * 60, b"x" * 130]
    texts = []
    for d in rng.sample(range(-200, 1000), 160):
        parts = [noise(rng, rng.randrange(25))]
        for _ in range(rng.randrange(6)):
            p = rng.choice(passages)
            parts += [p[rng.randrange(20) * rng.randrange(2) :][: rng.randrange(40, 250)], noise(rng, rng.randrange(12), b"ab")]
        texts.append((d, b"".join(parts)))
    texts += [(d + 2000, t) for d, t in rng.sample(texts, 5)] + [(5001, b""), (5002, b"a" * 49), (5003, b"ab" * 25)]
    packed = sorted_by(repeats._anchored(8, most)(batches_of(texts, 20)), "bucket")
    judged = pa.Table.from_batches(repeats._judged(iter(packed))).to_pylist()
    spans = [(r["doc"], r["at"]) for r in judged if r["whole"]]
    asked = {}
    for r in judged:
        if not r["whole"]:
            asked.setdefault(r["doc"], []).append(r["at"])
    rows = [(d, t) for d, t in texts if d in asked]
    kinds = {"doc": pa.int64(), "mark": pa.int64()}
    table = pa.RecordBatch.from_pydict({"doc": pa.array([d for d, _ in rows], pa.int64()), "print": pa.array([0] * len(rows), pa.int64()), "text": [t.decode() for _, t in rows], "asked": pa.array([sorted(asked[d]) for d, _ in rows], pa.list_(kinds["doc"]))})
    pieces = sorted_by(bounded(repeats._pieces(iter([table]))), "key", "doc")
    pieces = [b.slice(i, 70) for b in pieces for i in range(0, b.num_rows, 70)]
    for batch in repeats._matched(iter(pieces)):
        spans += list(zip(batch.column("doc").to_pylist(), batch.column("span").to_pylist()))
    assert bytes_of(spans, texts) == brute(texts)


def test_texts_of_a_key_are_narrowed_before_they_are_indexed(monkeypatch):
    rng = random.Random(4)
    symbols, index = [], repeats.RunIndex
    monkeypatch.setattr(repeats, "RunIndex", lambda text: symbols.append(len(text)) or index(text))
    line = noise(rng, 60)
    pieces = [line[:52] + noise(rng, 12) for _ in range(600)]  # three strings of each are the same
    rows = [(7, d, 0, 100, 30, p, -30, -16) for d, p in enumerate(pieces)]
    marks = [m for b in repeats._matched(iter([repeats._table_of(rows, repeats._HALVES)])) for m in b.to_pylist()]
    want = {d: {100 + i for i in x} for d, x in brute(list(enumerate(pieces))).items()}
    assert bytes_of([(m["doc"], m["span"]) for m in marks], [(d, bytes(164)) for d in range(600)]) == want
    assert sum(symbols) < 600 * 66  # before: half of them in each of ten rounds


def test_packed_anchors():
    big = 1 << 63
    for ids, prints, place in (([5, 7, 9], [0, 0, 0], [3, 4, 0, 9]), ([-big, 0, big - 1], [0, -1, big - 1], [1 << 40, 0, 1, 2]), ([3], [0], [8])):
        ids, prints, place = (np.array(x, dtype=np.int64) for x in (ids, prints, place))
        which = np.array([0, 1, 1, 2][: len(place)])
        h, around = place.astype(np.uint64) + np.uint64(big), place.astype(np.uint64)
        blob = repeats._pack(zstandard.ZstdCompressor(), ids, prints, which, place, h, around)
        for got, want in zip(repeats._unpack(blob, zstandard.ZstdDecompressor()), (ids[which], prints[which], place, h, around), strict=True):
            assert got.tolist() == want.tolist()


def test_key_of_different_cores():
    rng = random.Random(5)
    one, other = noise(rng, 64), noise(rng, 64)
    rows = [(7, d, 0, 0, 30, p, -30, -16) for d, p in enumerate([one, other, one, other, other[:30] + one[30:]])]
    marks = [m for b in repeats._matched(iter([repeats._table_of(rows, repeats._HALVES)])) for m in b.to_pylist()]
    assert {m["doc"] for m in marks} == {2, 3}
