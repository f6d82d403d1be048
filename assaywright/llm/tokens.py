"""Token ids in seekable files: independent zstandard frames, a trailing seek table, a checksum per frame.

A shard file is a sequence of zstandard frames, each holding the ids (unsigned,
32 bits, little-endian) of consecutive documents; a document longer than a frame
continues in the next.  Two skippable frames follow: an index of documents (id
and end, in tokens) and the seek table of the public seekable format (compressed
size, size and checksum of every frame).  Any zstandard tool decompresses the
file to the plain stream of ids, and ``Shard.tokens`` reads one document by
decompressing only its frames.

Documents are range-partitioned and sorted by id, and every task streams its
range into one shard, holding one frame and 17 bytes a document at a time.  The
file's name carries the task attempt and the manifest is what Spark commits, so
a lost or repeated task leaves an unlisted file and nothing else.

Defined results: NULL text is encoded as empty, so it has just the end id; NULL
ids come first; repeated ids are separate documents, ordered by a hash of their
text; an empty table gives an empty manifest.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pfs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.storage import new_path, stored
from .common import slices

# fixed values of the zstandard seekable format
SKIPPABLE_SEEK, SEEK_MAGIC, CHECKSUM_FLAG = 0x184D2A5E, 0x8F92EAB1, 0x80
# this format's own skippable frame
SKIPPABLE_INDEX = 0x184D2A50
FRAME_TOKENS = 1 << 16
MANIFEST = "shard int, path string, n_docs long, n_tokens long"
_EMPTY = np.zeros(0, dtype="<u4")


def _cuts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where pieces of texts begin, in UTF-8 bytes from offset to offset; for each byte, whether a piece that begins or ends with it is plain there.

    Plain are printable ASCII and the letters U+00C0 to U+023F: never white space by any version of Unicode.
    """
    n = len(raw)
    after = np.append(raw[1:], np.uint8(0))
    ascii_ = raw - np.uint8(0x21) < 0x5E
    letter = (raw | np.uint8(0x20)) - np.uint8(0x61) < 26
    two = (raw - np.uint8(0xC3) < 6) & ~((raw == 0xC3) & ((after == 0x97) | (after == 0xB7)))  # the first byte of a letter; not of the two signs among them
    begins = ascii_ | two
    tail = np.append(False, two[:-1])
    ends, letter = ascii_ | tail, letter | tail
    inner = offsets[(offsets > 0) & (offsets < n)]
    plain_next, plain_before, letter_before = np.append(begins[1:], False), np.append(False, ends[:-1]), np.append(False, letter[:-1])
    plain_next[inner - 1] = plain_before[inner] = letter_before[inner] = False
    space, line_end = raw == 0x20, raw == 0x0A
    between = plain_next & plain_before
    stop = (raw == 0x2C) | (raw == 0x2E) | (raw == 0x3A) | (raw == 0x3B) | (raw == 0x21) | (raw == 0x3F)
    line_end &= between
    cut = (space & between) | line_end | (stop & letter_before)
    cut[1:] |= line_end[:-1]
    cut[offsets[offsets < n]] = True
    return np.flatnonzero(cut), begins | (space & plain_next), ends


class PieceEncoder:
    """The tokenizer's ids of texts, encoding each distinct piece once.

    A text is cut before a single space between two plain characters: byte-level pre-tokenisation always starts a piece there, so the
    pieces' ids, one after another, are the text's ids.  So it does at a single line
    end between plain characters and between a letter and punctuation.
    Strings of the tokenizer's special tokens within a text become these tokens, as
    the library has it; no cut falls within one.
    New pieces that begin and end plainly are given to the tokenizer as lines of one
    text: a line end between them is a token of its own and tells them apart.
    Of ``most`` remembered pieces the half that was not met lately is forgotten.
    """

    LINES = 64

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        added_tokens = self.tokenizer.get_added_tokens_decoder().values()
        for added in added_tokens:
            raw = np.frombuffer(added.content.encode(), dtype=np.uint8)
            if added.lstrip or added.rstrip or added.single_word or len(_cuts(raw, np.array([0, len(raw)]))[0]) > 1 or " " in added.content:
                raise ValueError(f"pieces would cut the added token {added.content!r}")
        self.no_line = re.compile(b"|".join([b"\n", *(re.escape(added.content.encode()) for added in added_tokens)]))
        self.line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.most = most
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _each(self, pieces: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _lines(self, pieces: list[bytes]) -> Iterator[bytes]:
        """Ids of pieces, encoded as lines of texts."""
        parts = [pieces[i : i + self.LINES] for i in range(0, len(pieces), self.LINES)]
        for part, found in zip(parts, self.tokenizer.encode_batch_fast([b"\n".join(part).decode() for part in parts], add_special_tokens=False)):
            ids = np.array(found.ids, dtype="<u4")
            at = np.flatnonzero(ids == self.line_end[0])
            if len(self.line_end) == 1 and len(at) == len(part) - 1:
                raw, start = ids.tobytes(), 0
                for end in [*(4 * at).tolist(), len(raw)]:
                    yield raw[start:end]
                    start = end + 4
            else:  # a tokenizer that joins line ends with something else
                yield from self._each(part)

    def _ids(self, pieces: list[bytes], plain: np.ndarray) -> list[bytes]:
        ids = list(map(self.known.get, pieces))
        lines, others = [], []
        for i in [i for i, x in enumerate(ids) if x is None]:
            p = pieces[i]
            if p in self.before:
                ids[i] = self.known[p] = self.before[p]
            else:
                (lines if plain[i] and not self.no_line.search(p) else others).append(i)
        for many, encoded in ((lines, self._lines), (others, self._each)):
            for i, found in zip(many, encoded([pieces[i] for i in many])):
                ids[i] = self.known[pieces[i]] = found
        if 2 * len(self.known) > self.most:
            self.known, self.before = {}, self.known
        return ids

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of each text's ids."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset) if len(texts) else np.zeros(1, dtype=np.int64)
        size = int(offsets[-1] - offsets[0])
        if size == 0:
            return _EMPTY, np.zeros(len(texts), dtype=np.int64)
        raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8, count=size, offset=int(offsets[0]))
        offsets = offsets - offsets[0]
        at, begins, ends = _cuts(raw, offsets)
        bounds = np.append(at, size)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)]).dictionary_encode()
        code = pieces.indices.to_numpy()
        some = np.zeros(len(pieces.dictionary), dtype=np.int64)
        some[code] = np.arange(len(code))  # a place where the piece stands
        ids = self._ids(pieces.dictionary.to_pylist(), begins[at[some]] & ends[bounds[some + 1] - 1])
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        heads, each = (np.cumsum(sizes) - sizes)[code], sizes[code]
        totals = np.append(0, np.cumsum(each))
        out = flat[np.repeat(heads - totals[:-1], each) + np.arange(totals[-1])]
        return out, np.diff(totals[np.searchsorted(at, offsets)])


@functools.lru_cache(maxsize=1)
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder a Python worker: its pieces serve the tasks that come after."""
    return PieceEncoder(path)


def open_folder(uri: str) -> tuple[pfs.FileSystem, str]:
    return pfs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


class ShardWriter:
    """Writes one shard; ``add`` takes a document's ids, ``close`` the two trailing frames."""

    def __init__(self, out, level: int = 3):
        self.out, self.pack = out, zstandard.ZstdCompressor(level=level)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = 0
        self.frames: list[tuple[int, int, int]] = []
        self.keys: list[int | None] = []
        self.ends: list[int] = []

    def _frame(self, ids: np.ndarray) -> None:
        raw = ids.astype("<u4").tobytes()
        packed = self.pack.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def _flush(self) -> None:
        if self.n_waiting:
            ids = np.concatenate(self.waiting)
            for at in range(0, len(ids), FRAME_TOKENS):
                self._frame(ids[at : at + FRAME_TOKENS])
        self.waiting, self.n_waiting = [], 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        if self.n_waiting and self.n_waiting + len(ids) > FRAME_TOKENS:
            self._flush()
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_tokens += len(ids)
        self.keys.append(key)
        self.ends.append(self.n_tokens)

    def close(self) -> None:
        self._flush()
        index = struct.pack("<Q", len(self.keys)) + bytes(k is not None for k in self.keys)
        index += np.array([k or 0 for k in self.keys], dtype="<i8").tobytes() + np.array(self.ends, dtype="<u8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


@dataclass
class Shard:
    """A shard open for reading: its documents' ids and ends, and its frames."""

    file: object
    keys: list[int | None]
    ends: np.ndarray
    frames: np.ndarray

    @staticmethod
    def open(file) -> Shard:
        size = file.size()
        file.seek(size - 9)
        n, flag, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEK_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("no seek table with checksums at the end of the file")
        at = size - 9 - 12 * n - 8
        file.seek(at)
        if struct.unpack("<I", file.read(4))[0] != SKIPPABLE_SEEK:
            raise ValueError("the seek table does not begin where it should")
        file.seek(at + 8)
        frames = np.frombuffer(file.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        data_end = int(frames[:, 0].sum())
        file.seek(data_end)
        magic, length = struct.unpack("<II", file.read(8))
        if magic != SKIPPABLE_INDEX:
            raise ValueError("the document index does not follow the data")
        index = file.read(length)
        docs = struct.unpack_from("<Q", index)[0]
        keys = np.frombuffer(index, dtype="<i8", count=docs, offset=8 + docs).tolist()
        ends = np.frombuffer(index, dtype="<u8", count=docs, offset=8 + 9 * docs).astype(np.int64)
        return Shard(file, [k if there else None for k, there in zip(keys, index[8 : 8 + docs])], ends, frames)

    def frame(self, i: int) -> np.ndarray:
        self.file.seek(int(self.frames[:i, 0].sum()))
        packed, size, checksum = self.frames[i].tolist()
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {i} does not match its checksum")
        return np.frombuffer(raw, dtype="<u4")

    def span(self, doc: int) -> tuple[int, int]:
        return (int(self.ends[doc - 1]) if doc else 0), int(self.ends[doc])

    def tokens(self, doc: int) -> np.ndarray:
        """The ids of one document, from its frames only."""
        start, end = self.span(doc)
        last = np.cumsum(self.frames[:, 1]) // 4
        out = []
        for i in range(int(np.searchsorted(last, start, "right")), len(last)):
            first = int(last[i - 1]) if i else 0
            if first >= end:
                break
            out.append(self.frame(i)[max(0, start - first) : end - first])
        return np.concatenate(out) if out else _EMPTY

    def checksums(self) -> Iterator[tuple[int | None, int, int, int]]:
        """Id, start, number of ids and CRC-32 of every document, decompressing each frame once."""
        at, first, ids = -1, 0, _EMPTY
        for doc, key in enumerate(self.keys):
            start, end = self.span(doc)
            crc, here = 0, start
            while here < end:
                while here >= first + len(ids):
                    first += len(ids)
                    at += 1
                    ids = self.frame(at)
                stop = min(end, first + len(ids))
                crc = zlib.crc32(ids[here - first : stop - first].tobytes(), crc)
                here = stop
            yield key, start, end - start, crc


def written(docs: DataFrame, tokenizer: str, end_id: int, folder: str, shards: int | None = None) -> DataFrame:
    """Write the documents (doc_id, text) as shards; returns the manifest, one row per shard, not yet run.

    Each run of the frame writes its files, so store it once and read it from there.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encoder = writer = None
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                if part.num_rows == 0:
                    continue
                if writer is None:
                    encoder = piece_encoder(tokenizer)
                    files, where = open_folder(folder)
                    files.create_dir(where, recursive=True)
                    name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.zst"
                    out = files.open_output_stream(f"{where}/{name}", compression=None)
                    writer = ShardWriter(out)
                ids, counts = encoder(part.column("text"))
                start = 0
                for key, n in zip(part.column("doc_id").to_pylist(), counts.tolist()):
                    writer.add(key, np.append(ids[start : start + n], np.uint32(end_id)))
                    start += n
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [context.partitionId()], "path": [f"{folder}/{name}"], "n_docs": [len(writer.keys)], "n_tokens": [writer.n_tokens]},
                schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]),
            )

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    dealt = rows.repartitionByRange(shards, *order[:2]) if shards else rows.repartitionByRange(*order[:2])
    return dealt.sortWithinPartitions(*order).mapInArrow(write, MANIFEST)


def read(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start in the whole stream, n_tokens, ids_crc32."""

    def checked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, base in zip(batch["path"], batch["base"]):
                files, where = open_folder(path)
                with files.open_input_file(where) as file:
                    rows = pd.DataFrame(Shard.open(file).checksums(), columns=["doc_id", "start", "n_tokens", "ids_crc32"])
                rows["doc_id"] = rows["doc_id"].astype("Int64")
                rows["start"] += base
                yield rows

    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    based = manifest.select("path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    return based.repartition(max(1, manifest.count())).mapInPandas(checked, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int, paths: list[str] | None = None) -> DataFrame:
    """Write the documents' ids and read them back."""
    paths = [] if paths is None else paths
    folder = new_path(docs.sparkSession, "tokens")
    paths.append(folder)
    return read(stored(written(docs, tokenizer, end_id, folder), paths))
