"""Texts of crowded keys: halved by longer keys and matched by the index, not cut into single strings."""

import random

from assaywright.llm import repeats


def test_halves_hold_each_string_once():
    rng = random.Random(11)
    want, rows = [], []
    for low, high in ((-30, -16), (-15, 0)):
        for mark in range(-high, -low + 1):
            for size in {mark + high + 50, min(mark + high + 50, 50), 49, 80 - 30 + mark}:
                piece = bytes(rng.choices(b"ab", k=size))
                rows.append((0, len(rows), 0, 500, mark, piece, low, high))
                want += [(rows[-1][1], 500 + s, piece[s : s + 50]) for s in range(max(0, mark + low), min(mark + high, size - 50) + 1)]
    for _ in range(repeats.HALVINGS):
        before = len(rows)
        rows = [tuple(r.values()) for b in repeats._halved(iter([repeats._table_of(rows, repeats._HALVES)])) for r in b.to_pylist()]
        assert len(rows) <= 2 * before
        got = []
        for key, doc, _, base, mark, piece, low, high in rows:
            starts = range(max(0, mark + low), min(mark + high, len(piece) - 50) + 1)
            assert len(starts) and 0 <= mark <= len(piece) <= 50 + high - low
            got += [(doc, base + s, piece[s : s + 50]) for s in starts]
        assert sorted(got) == sorted(want)
    assert all(len(r[5]) == 50 for r in rows)


def test_crowded_keys_go_through_the_index(docs_of, monkeypatch):
    def never(*_):
        raise AssertionError("cut into single strings")

    monkeypatch.setattr(repeats, "_crowded", never)
    rng = random.Random(13)

    def noise(n):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))

    passage, ahead, behind = noise(42), [noise(60) for _ in range(9)], [noise(60) for _ in range(9)]
    # 42 bytes are too few; 4 more before or 7 behind, with the rest of the other side, are a repeat
    texts = [rng.choice(ahead)[-rng.randrange(60) :].rjust(60, rng.choice("XYZ")) + passage + rng.choice(behind)[: rng.randrange(60)].ljust(60, rng.choice("xyz")) for _ in range(120)]
    first = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - 49):
            first.setdefault(t[i : i + 50], d)
    want = {d: {j for i in range(len(t) - 49) if first[t[i : i + 50]] < d for j in range(i, i + 50)} for d, t in enumerate(texts)}
    got = repeats.repeats(docs_of(*enumerate(texts)), [], crowd=50).collect()
    assert {r["doc"]: {j for a, b in zip(r["starts"], r["ends"]) for j in range(a, min(b, len(texts[r["doc"]])))} for r in got} == {d: w for d, w in want.items() if w}
