"""A run-length index: the run-compressed Burrows-Wheeler transform of a text with sampled run ends.

``RunIndex`` keeps, per run of the transform, its symbol, start, length, and the
text positions at its first and last row; the suffix array is gone once it is
built.  ``stream`` reads patterns from right to left and gives the matching
statistics: at each place the length of the longest match with the text that
starts there.  A row inside a run of the next symbol moves by LF; any other row
jumps to the nearest run of that symbol above or below, whichever sampled end
has the longer common extension.  All patterns move in step, as arrays.
"""

from __future__ import annotations

import numpy as np

STEP = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; the last symbol must be unique and the least.

    The first sort takes as many symbols as a word holds, later ones only the suffixes not yet alone in their rank.
    """
    n = len(text)
    low = int(text.min())
    bits = max(1, (int(text.max()) - low).bit_length())
    width = max(1, 62 // bits)
    padded = np.append(text - low, np.zeros(width, dtype=np.int64))
    key = np.zeros(n, dtype=np.int64)
    for i in range(width):
        key = (key << bits) | padded[i : i + n]
    order = np.argsort(key)
    rank = np.empty(n, dtype=np.int64)  # the first row of a suffix's group
    rows = np.arange(n)
    key = key[order]
    while True:
        new = np.append(True, key[1:] != key[:-1])
        rank[order[rows]] = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
        rows = rows[~(new & np.append(new[1:], True))]
        if not len(rows):
            return order
        at = order[rows]
        after = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + after
        by_key = np.argsort(key)
        order[rows], key = at[by_key], key[by_key]
        width *= 2


class RunIndex:
    def __init__(self, text: np.ndarray):
        n = self.n = len(text)
        self.padded = np.append(text, -np.arange(2, 2 + STEP))
        order = suffix_array(text)
        last = text[order - 1]
        starts = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        ends = np.append(starts[1:], n) - 1
        heads = last[starts]
        by_head = np.lexsort((starts, heads))
        self.heads, self.starts = heads[by_head], starts[by_head]
        self.lengths = (ends - starts + 1)[by_head]
        self.first_at, self.last_at = order[starts][by_head], order[ends][by_head]
        self.rows_before = np.cumsum(self.lengths) - self.lengths  # LF of a run's first row: runs are in order of symbol
        self.key = self.heads * (n + 1) + self.starts
        self.home = int(order[0])

    def _common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common extension of text positions, up to ``most``."""
        found = np.zeros(len(a), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        steps = np.arange(STEP)
        while len(live):
            x, y = a[live] + found[live], b[live] + found[live]
            differ = self.padded[x[:, None] + steps] != self.padded[y[:, None] + steps]
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), STEP)
            found[live] += same
            live = live[(same == STEP) & (found[live] < most[live])]
        return np.minimum(found, most)

    def stream(self, patterns: np.ndarray) -> np.ndarray:
        """Matching statistics of right-aligned patterns, one a row, filled with -1 on the left."""
        count, width = patterns.shape
        row = np.zeros(count, dtype=np.int64)
        at = np.full(count, self.home, dtype=np.int64)
        length = np.zeros(count, dtype=np.int64)
        out = np.zeros(patterns.shape, dtype=np.int64)
        n, runs = self.n, len(self.key)
        for s in range(width - 1, -1, -1):
            c = patterns[:, s]
            j = np.searchsorted(self.key, c * (n + 1) + row, side="right") - 1
            up = (j >= 0) & (self.heads[np.maximum(j, 0)] == c)
            below = np.minimum(j + 1, runs - 1)
            down = (j + 1 < runs) & (self.heads[below] == c)
            j = np.maximum(j, 0)
            inside = up & (row < self.starts[j] + self.lengths[j])
            jump = np.flatnonzero(~inside & (up | down))
            new_row = self.rows_before[j] + row - self.starts[j]
            new_at, new_length = at - 1, length + 1
            if len(jump):
                a, most = at[jump], length[jump]
                above_end, below_start = self.last_at[j[jump]], self.first_at[below[jump]]
                go_up = np.where(up[jump], self._common(a, above_end, np.where(up[jump], most, 0)), -1)
                go_down = np.where(down[jump], self._common(a, below_start, np.where(down[jump], most, 0)), -1)
                higher = go_up >= go_down
                new_length[jump] = np.maximum(go_up, go_down) + 1
                new_at[jump] = np.where(higher, above_end, below_start) - 1
                jj, bb = j[jump], below[jump]
                new_row[jump] = np.where(higher, self.rows_before[jj] + self.lengths[jj] - 1, self.rows_before[bb])
            absent = ~(up | down)
            row = np.where(absent, 0, new_row)
            at = np.where(absent, self.home, new_at)
            length = np.where(absent, 0, new_length)
            out[:, s] = length
        return out
