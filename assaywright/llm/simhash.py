"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint of 64 bits is cut into blocks; two fingerprints that differ in at
most three bits agree in all blocks but three.  So every choice of all but three
blocks is a key, close pairs share a key, and pairs that share a key are verified
by Hamming distance.

Work is on distinct fingerprints, so exact copies cost nothing.  With six blocks
a key holds three of them (about 32 bits); keys with more than ``BUCKET_MOST``
fingerprints are cut anew into sixteen blocks, where a bucket leaves twelve bits
free and so holds 4,096 fingerprints at most, by construction.  A bucket is one
bounded array in one row; it yields the edges of a spanning forest, never all
its pairs, and the groups are the connected components of these edges.

Defined results: a text without words, or NULL, has fingerprint zero, linked like
any other; repeated rows and NULL ids are documents like any other; a group's id
is its smallest id that is not NULL, and NULL if it has none; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import ROWS, join_keyed
from ..operators.storage import stored
from .common import BROADCAST, small, word_blocks
from .components import components

SHINGLE = 3
SEED = 42
DISTANCE = 3
BUCKET_MOST = 4096


def fingerprint(text: str | None) -> int:
    """Bits set in over half of the XXH64 hashes of the text's word shingles, as a signed 64-bit integer."""
    counts = np.zeros(64, dtype=np.int64)
    total = 0
    carry: list[bytes] = []

    def count(shingles: list[bytes]) -> None:
        nonlocal total
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8", count=len(shingles))
        for at in range(0, len(hashes), 1 << 16):
            part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            counts[:] += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(shingles)

    for block in word_blocks((text or "").encode().lower()):
        words = carry + block
        count([b"%b %b %b" % s for s in zip(words, words[1:], words[2:])])
        carry = words[-(SHINGLE - 1) :]
    if not total:
        if not carry:
            return 0
        count([b" ".join(carry)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def block_keys(column: Column, blocks: int) -> Column:
    """One key for each choice of all blocks but ``DISTANCE``."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for left_out in combinations(range(blocks), DISTANCE):
        mask = sum(((1 << edges[b + 1]) - (1 << edges[b])) for b in range(blocks) if b not in left_out)
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(len(keys)), column.bitwiseAND(F.lit(mask).cast("long"))))
    return F.array(*keys)


def forest(members: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the pairs within the distance, by breadth-first search."""
    members = np.unique(members.astype(np.int64)).view(np.uint64)
    open_ = np.ones(len(members), dtype=bool)
    edges = []
    for first in range(len(members)):
        if not open_[first]:
            continue
        open_[first] = False
        queue = [first]
        while queue:
            at = queue.pop()
            near = np.flatnonzero(open_)
            near = near[np.bitwise_count(members[near] ^ members[at]) <= DISTANCE]
            open_[near] = False
            queue.extend(near.tolist())
            edges.extend((int(members[at].view(np.int64)), int(members[n].view(np.int64))) for n in near)
    return edges


def _forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        edges = [e for members in batch["members"] for e in forest(np.asarray(members))]
        yield pd.DataFrame(edges, columns=["u", "v"], dtype="int64")


def _bucketed(distinct: DataFrame, blocks: int, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """Fingerprints by key, for keys with more than one; and these keys with their numbers."""
    keyed = distinct.select("fingerprint", F.explode(block_keys(F.col("fingerprint"), blocks)).alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias(ROWS)).where(F.col(ROWS) > 1)
    counts = stored(counts, paths)
    return join_keyed(keyed, [F.col("key")], counts, ["key"], BROADCAST, "inner", paths), counts


def _edges(bucketed: DataFrame) -> DataFrame:
    lists = bucketed.groupBy("key").agg(F.collect_list("fingerprint").alias("members"))
    return lists.select("members").mapInPandas(_forests, "u long, v long")


def links(distinct: DataFrame, paths: list[str], bucket_most: int = BUCKET_MOST) -> DataFrame:
    """Edges between distinct fingerprints with the same components as all pairs within the distance."""
    bucketed, counts = _bucketed(distinct, 6, paths)
    edges = _edges(bucketed.where(F.col(ROWS) <= bucket_most))
    if not counts.where(F.col(ROWS) > bucket_most).isEmpty():
        crowded = stored(bucketed.where(F.col(ROWS) > bucket_most).select("fingerprint").distinct(), paths)
        finer, _ = _bucketed(crowded, 16, paths)
        edges = edges.unionByName(_edges(finer))
    return edges


def rooted(rows: DataFrame, paths: list[str], bucket_most: int = BUCKET_MOST) -> DataFrame:
    """From stored rows with doc_id and fingerprint: the same rows with ``component_id`` and ``root``, a fingerprint that names the group."""
    distinct = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias(ROWS))
    distinct = stored(distinct, paths)
    edges = stored(links(distinct.select("fingerprint"), paths, bucket_most), paths)
    found = stored(components(edges, paths), paths).withColumnRenamed("node", "fingerprint")
    placed = distinct.join(small(found), "fingerprint", "left")
    placed = stored(placed.withColumn("root", F.coalesce("root", "fingerprint")), paths)
    groups = placed.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias(ROWS))
    groups = stored(groups.where(F.col(ROWS) > 1), paths)
    many = join_keyed(placed.drop(ROWS).withColumnRenamed("root", "at"), [F.col("at")], groups, ["root"], BROADCAST, "left", paths)
    component = F.when(F.col(ROWS).isNotNull(), F.col("component_id")).otherwise(F.col("least"))
    by_print = many.select(F.col("fingerprint").alias("__print"), component.alias("component_id"), "root")
    by_print = stored(by_print.join(distinct.select(F.col("fingerprint").alias("__print"), ROWS), "__print"), paths)
    return join_keyed(rows, [F.col("fingerprint")], by_print, ["__print"], BROADCAST, "inner", paths).select(
        *rows.columns, "component_id", "root"
    )


def grouped(rows: DataFrame, paths: list[str], bucket_most: int = BUCKET_MOST) -> DataFrame:
    """From stored rows (doc_id, fingerprint): the same rows with ``component_id``."""
    return rooted(rows, paths, bucket_most).select("doc_id", "fingerprint", "component_id")


def near_duplicates(docs: DataFrame, paths: list[str] | None = None, bucket_most: int = BUCKET_MOST) -> DataFrame:
    """One row per document: doc_id, fingerprint (a long), component_id."""
    paths = [] if paths is None else paths
    rows = docs.select("doc_id", fingerprints(F.col("text")).alias("fingerprint"))
    return grouped(stored(rows, paths), paths, bucket_most)


def report(docs: DataFrame) -> DataFrame:
    rows = near_duplicates(docs)
    return rows.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


def without_near_duplicates(docs: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """One document of each group, the one with the smallest id that is not NULL; columns as given.

    A group without ids, or with several texts of that id, keeps one row too: the
    one of the least hashes of its text and columns.
    """
    paths = [] if paths is None else paths
    columns = [F.col(f"`{c}`") for c in docs.columns]
    by_row = F.xxhash64(*columns, *[c.isNull() for c in columns])
    rows = docs.select("doc_id", F.xxhash64("text").alias("by_text"), by_row.alias("by_row"), fingerprints(F.col("text")).alias("fingerprint"))
    rows = rooted(stored(rows, paths), paths)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "by_text", "by_row"))
    keep = rows.groupBy("root").agg(least.alias("least"))
    keep = stored(keep.select(F.col("least.doc_id").alias("__id"), F.col("least.by_text").alias("__text"), F.col("least.by_row").alias("__row")), paths)
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text")) & (by_row == F.col("__row"))
    return docs.join(small(keep), same, "left_semi").distinct()  # of equal rows one stays
