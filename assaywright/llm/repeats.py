"""Exact removal of long repeated byte strings, by run-length indexes over the repetitive parts of a corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  Four steps, each over all documents:

1. Every string of that length holds an anchor, a short string whose hash is the
   least in its neighbourhood, wherever the string occurs.  Anchors are dealt by
   hash, as packed arrays, one for each bucket and ``BATCH_ANCHORS`` anchors of a
   task.  Equal surroundings of an anchor in an earlier document settle it (at
   once for documents of one batch, so a passage that a third of all documents
   share is sent once per batch).  Of an anchor that comes very often in a batch
   all but two are dealt by their surroundings, and asked about if not settled.
2. Anchors left in two or more documents with different surroundings are read
   from the text again, each with its left or right context as a longer key, so
   only true common parts meet.
3. Texts that meet are put in a run-length index (``runindex``): earlier
   documents are indexed, later ones streamed, and matching statistics of the
   full length mark repeats.  What the texts of a key have in common is compared
   once and stands as one symbol, so only the up to 15 bytes on either side of it
   are indexed.  Every earlier and later document of a key meet in exactly one of
   log2(documents) rounds.  Of keys of more than ``INDEXED`` texts, equal ones are
   settled by their first document and the others halved, each half with what all
   its strings have in common as a longer key, until they are few as well.  Keys
   of more than ``CROWD`` texts are halved so across tasks, their equal texts by a
   partial aggregate; what is crowded after ``HALVINGS`` rounds is single strings.
4. Marks are merged per document and cut out of its text.

Memory of a task is a bucket of anchors, a batch of them, a batch of texts, or
about ``INDEX_SYMBOLS`` bytes of texts that meet, whatever the size of the corpus.

Defined results: NULL and empty text is empty; a document with a NULL id is
smaller than none and loses nothing; repeated ids are not smaller than each
other, so their rows lose the same bytes only to smaller ids.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import stored
from .common import slices, small, text_or_empty
from .runindex import RunIndex

LENGTH = 50
CORE = 20  # bytes of an anchor
SIDE = LENGTH - CORE
SPLIT = 16  # strings with so many bytes before the anchor are found by their left context
BUCKET_ANCHORS = 1 << 19
BATCH_ANCHORS = 1 << 19  # of a Python task, packed at a time: a piece for every bucket
COMMON = 64  # times that an anchor comes in a batch
SLICE = 1 << 17  # bytes of texts hashed at a time
INDEX_SYMBOLS = 1 << 20
INDEX_TEXTS = 1 << 15  # in one index
INDEXED = 32  # texts of a key that go through the index as they are
CROWD = 4096
HALVINGS = 4  # down to one string of the up to 16 of a piece
ROWS_AT_ONCE = 1 << 15  # of a Python task's output
SPAN_BITS = 12  # of a packed span, for its length
DOC = ["doc", "print"]
_P = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _mixed(h: np.ndarray, more: np.ndarray, i: int) -> np.ndarray:
    h = (h ^ more) * _P[i % 4]
    return h ^ (h >> np.uint64(29 + i % 3))


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """Best of each window, by doubling."""
    have = 1
    while 2 * have <= width:
        values = best(values[:-have], values[have:])
        have *= 2
    more = width - have
    return best(values[: len(values) - more], values[more:]) if more else values


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of anchors, by text and position: their text, position, hash, and the hash of their surroundings."""
    flat = b"".join(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    n = len(flat)
    if n < LENGTH:
        empty = np.zeros(0, dtype=np.uint64)
        return empty.astype(np.int64), empty.astype(np.int64), empty, empty
    ends = np.cumsum(sizes)
    heads = ends - sizes
    loads = np.ndarray((n - 7,), dtype="<u8", buffer=flat, strides=(1,))
    cores = n - CORE + 1
    h = _mixed(np.full(cores, _P[1]), loads[:cores], 0)
    h = _mixed(h, loads[8 : 8 + cores], 1)
    h = np.maximum(_mixed(h, loads[CORE - 8 : CORE - 8 + cores], 2), np.uint64(1))  # zero is for no neighbourhood
    least = _sliding(h, SIDE + 1, np.minimum)
    # no neighbourhood reaches beyond its text
    beyond = (np.maximum(ends - LENGTH + 1, heads)[:, None] + np.arange(LENGTH - 1)).clip(max=(ends - 1)[:, None]).ravel()
    least[beyond[(beyond >= 0) & (beyond < len(least))]] = 0
    rim = np.zeros(SIDE, dtype=np.uint64)
    place = np.flatnonzero(_sliding(np.concatenate([rim, least, rim]), SIDE + 1, np.maximum) == h)
    which = np.searchsorted(ends, place, side="right")
    at = place - heads[which]
    around = np.zeros(len(at), dtype=np.uint64)
    whole = (at >= SIDE) & (at + LENGTH <= sizes[which])
    first = place[whole] - SIDE
    seg = np.full(len(first), _P[2])
    for i in range((LENGTH + SIDE) // 8):
        seg = _mixed(seg, loads[first + 8 * i], i)
    around[whole] = seg
    cut = np.flatnonzero(~whole)
    before, behind = np.minimum(at[cut], SIDE), np.minimum((sizes[which] - at)[cut], LENGTH)
    for i, p, x, y in zip(cut.tolist(), place[cut].tolist(), before.tolist(), behind.tolist()):
        around[i] = xxhash.xxh64_intdigest(flat[p - x : p + y], x * 256 + y)
    return which, at, h[place], around


_HEAD = struct.Struct("<QQQqBBB")


def _narrow(values: np.ndarray) -> np.ndarray:
    return values.astype("<u4" if values.min() >= 0 and values.max() < 1 << 32 else "<i8")


def _pack(zstd: zstandard.ZstdCompressor, ids, prints, which, place, *hashes) -> bytes:
    """Anchors of documents in order, those of a document next to each other."""
    new = np.ones(len(which), dtype=bool)
    np.not_equal(which[1:], which[:-1], out=new[1:])
    names = which[new]
    new[0] = False
    own = ids[names].astype(np.int64)
    steps = own.copy()
    steps[1:] -= own[:-1]
    steps[0] = 0
    steps, prints, place = _narrow(steps), prints[names].astype("<i8"), _narrow(place)
    prints = prints if prints.any() else prints[:0]
    small_ones = zstd.compress(b"".join([steps, prints, place, new]))
    head = _HEAD.pack(len(names), len(which), len(small_ones), int(own[0]), steps.itemsize, 8 * (len(prints) > 0), place.itemsize)
    return b"".join([head, small_ones, *hashes])


def _unpack(blob: bytes, zstd: zstandard.ZstdDecompressor):
    names, n, size, first, *widths = _HEAD.unpack_from(blob)
    raw, kinds, at = zstd.decompress(blob[_HEAD.size : _HEAD.size + size]), {4: "<u4", 8: "<i8"}, 0
    steps = np.frombuffer(raw, kinds[widths[0]], names)
    at += steps.nbytes
    prints = np.frombuffer(raw, "<i8", names, at) if widths[1] else np.zeros(names, dtype=np.int64)
    at += names * widths[1]
    place = np.frombuffer(raw, kinds[widths[2]], n, at).astype(np.int64)
    local = np.cumsum(np.frombuffer(raw, "?", n, at + n * widths[2]))
    ids = np.cumsum(steps, dtype=np.int64) + np.int64(first)
    hashes = [np.frombuffer(blob, "<u8", n, at) for at in range(_HEAD.size + size, len(blob), 8 * n)]
    return ids[local], prints[local], place, *hashes


def _shared(values: np.ndarray) -> np.ndarray:
    """Places of the values that come more than once."""
    order = np.argsort(values)
    ordered = values[order]
    same = ordered[1:] == ordered[:-1]
    return order[np.append(same, False) | np.append(False, same)] if len(values) else order


def _later(h: np.ndarray, around: np.ndarray, doc: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In an order by anchor and surroundings with ascending documents: starts of equal runs; rows after the run's first document."""
    first = np.flatnonzero(np.append(True, (h[order[1:]] != h[order[:-1]]) | (around[order[1:]] != around[order[:-1]])))
    least = np.repeat(doc[order[first]], np.diff(np.append(first, len(order))))
    return first, doc[order] > least


def _spans(which: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Surroundings of anchors, by text and position, as packed spans; those that touch are one, to about half of what a span holds."""
    start = np.maximum(at - SIDE, 0)
    part = at >> (SPAN_BITS - 1)
    apart = (which[1:] != which[:-1]) | (part[1:] != part[:-1]) | (start[1:] > at[:-1] + LENGTH)
    some = np.ones(min(len(at), 1), dtype=bool)
    first, last = np.flatnonzero(np.append(some, apart)), np.flatnonzero(np.append(apart, some))
    return which[first], start[first] << SPAN_BITS | (at[last] + LENGTH - start[first])


def _common_anchors(h: np.ndarray, doc: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of documents in order: rows of anchors that come more than ``most`` times, in two documents or more; of these, the first and last row of each anchor."""
    order = np.argsort(h, kind="stable")
    first = np.flatnonzero(np.append(True, h[order[1:]] != h[order[:-1]])) if len(h) else order
    last = np.append(first[1:], len(h))[: len(first)] - 1
    many = (last - first >= most) & (doc[order[first]] != doc[order[last]])
    common = order[np.repeat(many, last - first + 1)]
    return common, np.concatenate([order[first[many]], order[last[many]]])


def _anchored(buckets: int, most: int = COMMON):
    """Documents to packed anchors by bucket, ``BATCH_ANCHORS`` at a time; those settled at once go apart, without hashes.

    Of an anchor that comes very often only a first and a last document go to its
    own bucket, marked as common; the others, marked too, are dealt by their
    surroundings as well.
    """
    shift = np.uint64(64 - max(1, buckets.bit_length() - 1))

    def packed(parts: list[tuple]) -> pa.RecordBatch:
        ids, prints, sizes, at, h, around = (np.concatenate(x) for x in zip(*parts))
        by_id = np.argsort(ids, kind="stable")
        heads = np.cumsum(sizes) - sizes
        ids, prints, heads, sizes = ids[by_id], prints[by_id], heads[by_id], sizes[by_id]
        rows = np.repeat(heads - np.cumsum(sizes) + sizes, sizes) + np.arange(len(at))
        at, h, around, which = at[rows], h[rows], around[rows], np.repeat(np.arange(len(ids)), sizes)
        settled = np.zeros(len(at), dtype=bool)
        both = _mixed(h, around, 3)
        order = np.sort(_shared(both))
        if len(order):
            order = order[np.argsort(both[order], kind="stable")]
            settled[order] = _later(h, around, ids[which], order)[1]
        zstd, out = zstandard.ZstdCompressor(level=1), []
        if settled.any():
            own, span = _spans(which[settled], at[settled])
            out.append((-1 - int(both[0] >> shift), _pack(zstd, ids, prints, own, span)))
        rest = np.flatnonzero(~settled)
        place = at[rest] * 2
        which, h, around, both = which[rest], h[rest], around[rest], both[rest]
        common, ends = _common_anchors(h, ids[which], most)
        place[common] += 1
        bucket = h * _P[0] >> shift  # anchors have low hashes
        own = bucket[ends]
        bucket[common] = both[common] >> shift
        bucket[ends] = own
        order = np.argsort(bucket.astype(np.uint16) if shift >= 48 else bucket, kind="stable")
        which, place, h, around = which[order], place[order], h[order], around[order]
        cuts = np.searchsorted(bucket[order], np.arange((1 << (64 - int(shift))) + 1, dtype=np.uint64)).tolist()
        for b, (i, j) in enumerate(zip(cuts, cuts[1:])):
            if i < j:
                out.append((b, _pack(zstd, ids, prints, which[i:j], place[i:j], h[i:j], around[i:j])))
        return pa.RecordBatch.from_pydict({"bucket": pa.array([b for b, _ in out], pa.int32()), "packed": pa.array([p for _, p in out], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            which, at, h, around = anchors([t.encode() for t in batch.column("text").to_pylist()])
            if len(at):
                ids, prints = (batch.column(c).to_numpy() for c in DOC)
                parts.append((ids, prints, np.bincount(which, minlength=len(ids)), at, h, around))
                held += len(at)
            if held >= BATCH_ANCHORS:
                yield packed(parts)
                parts, held = [], 0
        if parts:
            yield packed(parts)

    return run


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted packed anchors, a bucket at a time, to spans of settled ones and places of those to be asked about."""

    def said(doc, prints, at, whole) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"doc": doc, "print": prints, "at": at.astype(np.int64), "whole": whole})

    def judge(blobs: list[bytes]) -> pa.RecordBatch:
        doc, prints, place, h, around = (np.concatenate(x) for x in zip(*(_unpack(blob, zstd) for blob in blobs)))
        common = (place & 1).astype(bool)
        shared = common.copy()
        shared[_shared(h)] = True
        rest = np.flatnonzero(shared)
        order = rest[np.lexsort((doc[rest], around[rest], h[rest]))]
        done = asked = order
        if len(order):
            _, later = _later(h, around, doc, order)
            group = np.flatnonzero(np.append(True, h[order[1:]] != h[order[:-1]]))
            ones = np.where(later, np.repeat(doc[order[group]], np.diff(np.append(group, len(order)))), doc[order])
            low, high = np.minimum.reduceat(ones, group), np.maximum.reduceat(ones, group)
            ask = (low != high) | np.logical_or.reduceat(common[order], group)
            done, asked = order[later], order[~later & np.repeat(ask, np.diff(np.append(group, len(order))))]
        own = np.concatenate([done, asked])
        at = place[own] >> 1
        at[: len(done)] = _spans(np.arange(len(done)), at[: len(done)])[1]
        return said(doc[own], prints[own], at, np.arange(len(own)) < len(done))

    zstd, now, blobs = zstandard.ZstdDecompressor(), None, []
    for batch in batches:
        for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("packed")):
            if bucket < 0:  # settled
                doc, prints, span = _unpack(blob.as_py(), zstd)
                yield said(doc, prints, span, np.ones(len(span), dtype=bool))
                continue
            if bucket != now and blobs:
                yield judge(blobs)
                blobs = []
            now = bucket
            blobs.append(blob.as_py())
    if blobs:
        yield judge(blobs)


TEXTS = "key long, doc long, print long, base long, mark int, piece binary"
_TEXTS = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("print", pa.int64()), ("base", pa.int64()), ("mark", pa.int32()), ("piece", pa.binary())])
HALVES = TEXTS + ", low int, high int"
_HALVES = _TEXTS.append(pa.field("low", pa.int32())).append(pa.field("high", pa.int32()))
MARKS = "doc long, print long, span long"


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text around each anchor asked about, keyed by the anchor with its left or its right context."""
    for batch in (part for whole in batches for part in slices(whole, "text", 4 << 20)):
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        raw = np.frombuffer(b"".join(texts) + bytes(8), dtype=np.uint8)
        loads = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        sizes = np.array([len(t) for t in texts])
        heads = np.cumsum(sizes) - sizes
        asked = batch.column("asked")
        places = asked.flatten().to_numpy()
        owners = np.repeat(np.arange(len(texts)), np.diff(asked.offsets.to_numpy()))
        doc, mark = (batch.column(c).to_numpy() for c in DOC)
        for i in range(0, len(places), ROWS_AT_ONCE // 2):
            p, own = places[i : i + ROWS_AT_ONCE // 2], owners[i : i + ROWS_AT_ONCE // 2]
            out = []
            # first and last start of the strings in a piece, before the anchor
            for side, most, least in ((0, SIDE, SPLIT), (1, SPLIT - 1, 0)):
                ok = (p >= least) & (p - most + LENGTH <= sizes[own])
                q, of = p[ok], own[ok]
                length = LENGTH - most + least
                key = np.full(len(q), _P[side])
                for n, step in enumerate([*range(0, length - 8, 8), length - 8]):
                    key = _mixed(key, loads[heads[of] + q - least + step], n)
                start, end = np.maximum(q - most, 0), np.minimum(q - least + LENGTH, sizes[of])
                out.append((key.view(np.int64), of, q, start, end))
            key, of, q, start, end = (np.concatenate(x) for x in zip(*out))
            ends = np.cumsum(end - start)
            at = np.repeat(heads[of] + start - ends + end - start, end - start) + np.arange(ends[-1] if len(ends) else 0)
            offsets = np.append(0, ends).astype(np.int32)
            piece = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw[at].tobytes())])
            columns = [key, doc[of], mark[of], start, (q - start).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), piece], schema=_TEXTS)


def _offsets(pieces: pa.BinaryArray) -> np.ndarray:
    return np.frombuffer(pieces.buffers()[1], "<i4", len(pieces) + 1, 4 * pieces.offset).astype(np.int64)


def _ranked(*columns: np.ndarray) -> np.ndarray:
    """Dense ranks of rows, the first column leading."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), dtype=bool)
    for c in columns:
        new[1:] |= c[order[1:]] != c[order[:-1]]
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


class _Texts:
    """Texts that meet, as columns: ``group``, ``doc``, ``print``, ``base``, ``low``, ``high``, and places in ``raw``: of the anchor, of start and end.

    The strings of a text start ``low`` to ``high`` bytes from its anchor on, so
    all texts of a group have a core in common, from ``anchor + high`` to ``anchor
    + low + LENGTH``, and differ only in up to ``high - low`` bytes on either side.
    """

    FIELDS = ("group", "doc", "print", "base", "low", "high", "anchor", "start", "end")

    def __init__(self, raw: np.ndarray, *columns: np.ndarray):
        self.raw = raw
        self.loads = np.ndarray((len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
        for name, column in zip(self.FIELDS, columns):
            setattr(self, name, column)
        self.left = self.anchor + self.high - self.start
        self.right = self.end - self.anchor - self.low - LENGTH

    @classmethod
    def of(cls, part: pa.RecordBatch) -> _Texts:
        """Rows sorted by key; rows of one key whose cores differ are groups of their own."""
        key, doc, prints, base, mark, low, high = (part.column(c).to_numpy().astype(np.int64) for c in ("key", "doc", "print", "base", "mark", "low", "high"))
        offsets = _offsets(part.column("piece"))
        raw = np.append(np.frombuffer(part.column("piece").buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]], np.zeros(LENGTH + 8, dtype=np.uint8))
        start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        made = cls(raw, _ranked(key), doc, prints, base, low, high, start + mark, start, end)
        cores = made.bytes_at(made.anchor + high, LENGTH + low - high, LENGTH)
        first = np.searchsorted(made.group, made.group)
        if (cores != cores[first]).any() or (low != low[first]).any() or (high != high[first]).any():
            made.group = _ranked(made.group, low, high, *np.ascontiguousarray(np.pad(cores, ((0, 0), (0, 6)))).view(np.uint64).T)
        return made

    def __len__(self) -> int:
        return len(self.group)

    def bytes_at(self, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
        """A row of ``width`` bytes for each text, zeros behind its size."""
        steps = np.arange(width)
        inside = steps < size[:, None]
        return np.where(inside, self.raw[np.where(inside, start[:, None] + steps, 0)], 0).astype(np.uint8)

    def take(self, rows: np.ndarray) -> _Texts:
        return _Texts(self.raw, *(getattr(self, name)[rows] for name in self.FIELDS))

    def settled(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows that an earlier document of the group has as they are; the other rows, of groups of two documents, by group and document; the text of each."""
        whole = np.zeros((len(self), 4 * 8), dtype=np.uint8)
        whole[:, 0], whole[:, 1] = self.left, self.right
        whole[:, 2:17] = self.bytes_at(self.start, self.left, 15)
        whole[:, 17:32] = self.bytes_at(self.anchor + self.low + LENGTH, self.right, 15)
        words = whole.view(np.uint64)
        digest = np.full(len(self), _P[3])
        for i in range(4):
            digest = _mixed(digest, words[:, i], i)
        order = np.lexsort((self.doc, digest, self.group))
        new = np.append(True, (words[order[1:]] != words[order[:-1]]).any(axis=1) | (self.group[order[1:]] != self.group[order[:-1]]))
        run = np.cumsum(new) - 1
        later = self.doc[order] > self.doc[order[new]][run]
        rest, run = order[~later], run[~later]
        by_doc = np.lexsort((run, self.doc[rest], self.group[rest]))
        rest, run = rest[by_doc], run[by_doc]
        group, doc = self.group[rest], self.doc[rest]
        low, high = np.searchsorted(group, group), np.searchsorted(group, group, side="right") - 1
        met = doc[low] != doc[high]
        return order[later], rest[met], run[met]

    def halves(self) -> _Texts:
        """Each text as two, for the earlier and the later half of its strings, in groups of what the strings of a half have in common."""
        middle = (self.low + self.high) // 2
        parts = []
        for first, last, more, size in ((self.low, middle, self.anchor + middle, self.high - middle), (middle + 1, self.high, self.anchor + self.low + LENGTH, middle + 1 - self.low)):
            start, end = np.maximum(self.anchor + first, self.start), np.minimum(self.anchor + last + LENGTH, self.end)
            ok = np.flatnonzero((first <= last) & (end - start >= LENGTH))
            added = self.loads[more[ok]] & ((np.uint64(1) << (8 * np.minimum(size[ok], 7)).astype(np.uint64)) - np.uint64(1) | np.where(size[ok] > 7, ~np.uint64(0), np.uint64(0)))
            columns = self.group, self.doc, self.print, self.base + start - self.start, first, last, self.anchor, start, end
            parts.append(([c[ok] for c in columns], added))
        columns = [np.concatenate(c) for c in zip(*(c for c, _ in parts))]
        columns[0] = _ranked(columns[0], columns[4], np.concatenate([added for _, added in parts]))
        return _Texts(self.raw, *columns)


def _repeat_starts(texts: _Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct texts by group and document: those with strings that an earlier document of the group has, and their first and last start.

    A mark stands for the core of a group, so a match that holds it stays within
    the group; every pair of an earlier and a later document meets in one round,
    in which their mark is a symbol of its own.
    """
    new_group = np.append(True, texts.group[1:] != texts.group[:-1])
    new_doc = new_group | np.append(True, texts.doc[1:] != texts.doc[:-1])
    nth = np.cumsum(new_doc)
    rank = nth - nth[np.flatnonzero(new_group)][np.cumsum(new_group) - 1]
    wide = texts.high - texts.low
    size = texts.left + 1 + texts.right
    width = int(size.max())
    # texts aligned to the right, -1 before them
    at = np.arange(width) - (width - size)[:, None]
    after = at - texts.left[:, None]
    place = np.where(after < 0, texts.start[:, None] + at, (texts.anchor + texts.low + LENGTH)[:, None] + after - 1)
    rows = np.where(at < 0, -1, texts.raw[np.where(at < 0, 0, place)].astype(np.int64) + 2)
    marked = width - size + texts.left
    first, last = np.full(len(texts), LENGTH), np.full(len(texts), -1)
    for bit in range(int(rank.max()).bit_length()):
        block = _ranked(texts.group, rank >> (bit + 1))
        later = (rank >> bit & 1).astype(bool)
        both = (np.bincount(block[later], minlength=len(texts)) > 0) & (np.bincount(block[~later], minlength=len(texts)) > 0)
        symbol = 2 + 256 + np.cumsum(both)[block]
        earlier, asked = np.flatnonzero(both[block] & ~later), np.flatnonzero(both[block] & later)
        rows[np.arange(len(rows)), marked] = symbol
        for start in range(0, len(earlier), INDEX_TEXTS):
            index = RunIndex(_coded(rows[earlier[start : start + INDEX_TEXTS]]))
            for i in range(0, len(asked), 1 << 14):
                part = asked[i : i + (1 << 14)]
                long = (index.stream(rows[part]) > wide[part, None]) & (np.arange(width) <= marked[part, None])
                hit = np.flatnonzero(long.any(axis=1))
                skip = (width - size)[part[hit]]
                first[part[hit]] = np.minimum(first[part[hit]], long[hit].argmax(axis=1) - skip)
                last[part[hit]] = np.maximum(last[part[hit]], width - 1 - long[hit, ::-1].argmax(axis=1) - skip)
    found = np.flatnonzero(last >= 0)
    return found, first[found], last[found]


def _coded(rows: np.ndarray) -> np.ndarray:
    """Texts one after another, each with an end behind it, and the end of all."""
    ended = np.append(rows, np.ones((len(rows), 1), dtype=np.int64), axis=1)
    return np.append(ended[ended >= 0], 0)


def _marks_of(texts: _Texts) -> pa.RecordBatch | None:
    """Marks of whole groups: equal texts by their first document, those of many texts halved until they are few, the others by the index."""
    marks, left = [], []

    def mark(some: _Texts, first: np.ndarray, size: np.ndarray) -> None:
        if len(some):
            marks.append((some.doc, some.print, (some.base + first) << SPAN_BITS | size))

    while len(texts):
        whole, rest, run = texts.settled()
        equal = texts.take(whole)
        mark(equal, np.zeros(len(equal), dtype=np.int64), equal.end - equal.start)
        texts = texts.take(rest)
        many = np.bincount(texts.group, minlength=1)[texts.group] > INDEXED
        left.append((texts.take(np.flatnonzero(~many)), run[~many]))
        texts = texts.take(np.flatnonzero(many)).halves() if many.any() else texts.take(np.zeros(0, dtype=np.int64))
    left = [(t, run) for t, run in left if len(t)]
    if left:
        groups = np.cumsum([0, *(int(t.group.max()) + 1 for t, _ in left)])
        runs = np.cumsum([0, *(int(run.max()) + 1 for _, run in left)])
        columns = [np.concatenate([getattr(t, name) for t, _ in left]) for name in _Texts.FIELDS]
        columns[0] = columns[0] + np.repeat(groups[:-1], [len(t) for t, _ in left])
        run = np.concatenate([r + n for (_, r), n in zip(left, runs)])
        few = _Texts(left[0][0].raw, *columns)
        one = np.append(True, run[1:] != run[:-1])  # a text that its document has in several places is looked for once
        found, first, last = _repeat_starts(few.take(np.flatnonzero(one)))
        nth = np.full(int(one.sum()), -1)
        nth[found] = np.arange(len(found))
        nth = nth[np.cumsum(one) - 1]
        hit = np.flatnonzero(nth >= 0)
        mark(few.take(hit), first[nth[hit]], (last - first)[nth[hit]] + LENGTH)
    if not marks:
        return None
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*marks)], names=["doc", "print", "span"])


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts (``HALVES``) sorted by key and document to marks; whole keys of about ``INDEX_SYMBOLS`` at a time, but those of one text."""
    held, symbols = [], 0

    def part(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key = rows.column("key").to_numpy()
        same = key[1:] == key[:-1]
        rows = rows.filter(pa.array(np.append(same, False) | np.append(False, same))) if len(key) else rows
        if rows.num_rows and (out := _marks_of(_Texts.of(rows))) is not None:
            yield out

    for batch in batches:
        offsets = _offsets(batch.column("piece"))
        held.append(batch)
        symbols += int(offsets[-1] - offsets[0])
        if symbols >= INDEX_SYMBOLS:
            rows = pa.concat_batches(held)
            keys = rows.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            yield from part(rows.slice(0, cut))
            held = [rows.slice(cut)]
            offsets = _offsets(held[0].column("piece"))
            symbols = int(offsets[-1] - offsets[0])
    if held:
        yield from part(pa.concat_batches(held))


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string of the full length in a piece that holds its anchor, as two hashes."""
    kinds = pa.schema([(c, pa.int64()) for c in ("h1", "h2", "doc", "print", "start")])
    rows = []
    for batch in batches:
        for doc, mark_of, base, mark, piece in zip(*(batch.column(c).to_pylist() for c in ("doc", "print", "base", "mark", "piece"))):
            for s in range(min(mark, len(piece) - LENGTH) + 1):
                string = piece[s : s + LENGTH]
                rows.append((_signed(xxhash.xxh64_intdigest(string, 3)), _signed(xxhash.xxh64_intdigest(string, 4)), doc, mark_of, base + s))
            if len(rows) >= ROWS_AT_ONCE:
                yield _table_of(rows, kinds)
                rows = []
    if rows:
        yield _table_of(rows, kinds)


def _span(start: Column, length: Column | int) -> Column:
    return F.shiftleft(start, SPAN_BITS).bitwiseOR(length if isinstance(length, Column) else F.lit(length)).cast("long").alias("span")


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece as two, for the earlier and the later half of its strings, keyed by what the strings of a half have in common.

    ``low`` and ``high`` are the first and the last start of the strings, from the anchor on.
    """
    for batch in batches:
        rows = []
        for doc, mark_of, base, mark, piece, low, high in zip(*(batch.column(c).to_pylist() for c in ("doc", "print", "base", "mark", "piece", "low", "high"))):
            middle = (low + high) // 2
            for first, last in ((low, middle), (middle + 1, high)):
                start, end = max(mark + first, 0), min(mark + last + LENGTH, len(piece))
                if end - start >= LENGTH:
                    key = xxhash.xxh64_intdigest(piece[mark + last : mark + first + LENGTH], 64 * last - first & 0xFFFF)
                    rows.append((_signed(key), doc, mark_of, base + start, mark - start, piece[start:end], first, last))
        for i in range(0, len(rows), ROWS_AT_ONCE):
            yield _table_of(rows[i : i + ROWS_AT_ONCE], _HALVES)


def _settled(pieces: DataFrame, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Marks of texts that an earlier document of the key has as they are; the other texts."""
    spot = ["key", "mark", "piece"]
    first = stored(pieces.groupBy(*spot).agg(F.min("doc").alias("first")), paths)
    met = stored(pieces.join(small(first), spot), paths)
    size = F.octet_length("piece")
    whole = met.where((F.col("doc") > F.col("first")) & (size >= LENGTH)).select(*DOC, _span(F.col("base"), size))
    return whole, met.where("doc = first").drop("first")


def _crowded(pieces: DataFrame, paths: list[str]) -> DataFrame:
    """Marks of keys with very many texts: equal ones by their first document, the others string by string."""
    whole, ones = _settled(pieces, paths)
    strings = stored(ones.mapInArrow(_strings, "h1 long, h2 long, doc long, print long, start long"), paths)
    first = strings.groupBy("h1", "h2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first <> last")
    hit = strings.join(small(stored(first, paths)), ["h1", "h2"]).where("doc > first")
    return whole.unionByName(hit.select(*DOC, _span(F.col("start"), LENGTH)))


def _counted(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("a"), F.max("doc").alias("b"))


def _met(pieces: DataFrame, paths: list[str]) -> DataFrame:
    """Keys of two or more documents, with their number of texts."""
    return stored(_counted(pieces).where("a <> b").select("key", "n"), paths)


def _bounded(pieces: DataFrame) -> DataFrame:
    """Pieces with the first and last start of their strings, from the anchor on: ``HALVES``."""
    low, high = (F.when(F.col("mark") >= SPLIT, F.lit(a)).otherwise(F.lit(b)) for a, b in ((-SIDE, 1 - SPLIT), (-SPLIT, 0)))
    return pieces.withColumns({"low": low, "high": high})


def _narrowed(pieces: DataFrame, crowds: DataFrame, crowd: int, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Of keys with very many texts: texts that are few by a longer key, and marks of the others."""
    pieces, few, marks = _bounded(pieces), None, None
    for _ in range(HALVINGS):
        whole, ones = _settled(stored(pieces.join(small(crowds), "key"), paths), paths)
        pieces = stored(ones.mapInArrow(_halved, HALVES), paths)
        counts = _met(pieces, paths)
        some = pieces.join(counts.where(F.col("n") <= crowd).select("key"), "key")
        few, marks = (some, whole) if few is None else (few.unionByName(some), marks.unionByName(whole))
        crowds = stored(counts.where(F.col("n") > crowd).select("key"), paths)
        if crowds.isEmpty():
            return few, marks
    return few, marks.unionByName(_crowded(stored(pieces.join(small(crowds), "key").drop("low", "high"), paths), paths))


def _print(docs: DataFrame) -> tuple[Column, bool, int]:
    """What tells rows of one id apart, 0 if no id comes twice; whether one does; bytes of text."""
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc"))
    ids = ids.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size"))
    most, size = ids.agg(F.max("n"), F.coalesce(F.sum("size"), F.lit(0))).first()
    repeated = (most or 0) > 1
    return F.xxhash64("text") if repeated else F.lit(0).cast("long"), repeated, int(size)


def repeats(docs: DataFrame, paths: list[str], crowd: int = CROWD, bucket_anchors: int = BUCKET_ANCHORS, named: tuple[Column, bool, int] | None = None) -> DataFrame:
    """Marks of all documents (doc_id, text): doc, print, and the merged spans to remove as arrays; stored."""
    prints, repeated, size = named or _print(docs)
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), prints.alias("print"), text_or_empty("text").alias("text"))
    buckets = 1 << max(1, (size // (16 * bucket_anchors)).bit_length())
    packed = rows.mapInArrow(_anchored(buckets), "bucket int, packed binary")
    packed = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    judged = stored(packed.mapInArrow(_judged, "doc long, print long, at long, whole boolean"), paths)
    asked = judged.where("not whole").groupBy(*DOC).agg(F.sort_array(F.collect_set("at")).alias("asked"))
    pieces = rows.join(stored(asked, paths), DOC)
    pieces = pieces.dropDuplicates(DOC) if repeated else pieces
    pieces = stored(pieces.mapInArrow(_pieces, TEXTS), paths)
    # at most all pieces / crowd; a key of one document is met by none
    counts = stored(_counted(pieces).where(F.col("n") > crowd), paths)
    few, marks = _bounded(pieces), None
    if not counts.isEmpty():
        few = few.join(small(counts.select("key")), "key", "left_anti")
        crowds = stored(counts.where("a <> b").select("key"), paths)
        if not crowds.isEmpty():
            more, marks = _narrowed(pieces, crowds, crowd, paths)
            few = few.unionByName(more)
    matched = few.repartition("key").sortWithinPartitions("key", "doc").mapInArrow(_matched, MARKS)
    marks = matched if marks is None else matched.unionByName(marks)
    whole = judged.where("whole").select(*DOC, F.col("at").alias("span"))
    spans = whole.unionByName(marks).groupBy(*DOC).agg(F.collect_list("span").alias("spans"))
    return stored(spans.mapInArrow(_merged, "doc long, print long, starts array<long>, ends array<long>"), paths)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed spans of a document to its maximal runs."""
    for batch in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
        spans = batch.column("spans")
        packed = spans.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(spans.offsets.to_numpy()))
        start = packed >> SPAN_BITS
        end = start + (packed & ((1 << SPAN_BITS) - 1))
        apart = row * (int(end.max(initial=0)) + 1)  # rows one after another, none touching the next
        order = np.argsort(start + apart)
        reach = np.maximum.accumulate((end + apart)[order])
        row, apart, start = row[order], apart[order], start[order]
        first = np.flatnonzero(np.append(True, (start + apart)[1:] > reach[:-1])) if len(order) else order
        last = np.append(first[1:], len(order))[: len(first)] - 1
        offsets = pa.array(np.append(0, np.cumsum(np.bincount(row[first], minlength=batch.num_rows))), pa.int32())
        runs = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (start[first], (reach - apart)[last])]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("print"), *runs], names=["doc", "print", "starts", "ends"])


def kept_bytes(text: str, starts: list[int] | None, ends: list[int] | None) -> tuple[bytes, list[bytes]]:
    """The text's bytes, and the parts left of them."""
    raw, left, at = text.encode(), [], 0
    for start, end in zip(starts or (), ends or ()):
        left.append(raw[at:start])
        at = min(end, len(raw))
    return raw, [*left, raw[at:]]


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (part for whole in batches for part in slices(whole, "text", 4 << 20)):
        rows = []
        for doc, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "starts", "ends"))):
            raw, left = kept_bytes(text, starts, ends)
            digest = hashlib.sha256()
            for part in left:
                digest.update(part)
            rows.append((doc, len(raw), len(raw) - sum(map(len, left)), len(starts or ()), digest.hexdigest()))
        kinds = [pa.int64()] * 4 + [pa.string()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def report(docs: DataFrame, crowd: int = CROWD, bucket_anchors: int = BUCKET_ANCHORS) -> DataFrame:
    paths: list[str] = []
    named = _print(docs)
    marks = repeats(docs.select("doc_id", "text"), paths, crowd, bucket_anchors, named)
    rows = docs.select("doc_id", text_or_empty("text").alias("text"), F.col("doc_id").cast("long").alias("doc"), named[0].alias("print"))
    rows = rows.join(marks, DOC, "left").select("doc_id", "text", "starts", "ends")
    return rows.mapInArrow(_digested, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
