"""Hard negatives: for each anchor and each of its best rows of the same label, the best rows of other labels whose
score lies in a window below that row's score.

Scores are inner products of whole-number vectors.  All rows are indexed by a
multiway hyperplane tree (``hypertree``): its leaves are dealt out in blocks of
bounded size, anchors are sent only to leaves that the distance ranges do not
rule out, and a leaf compares its rows with the anchors that reach it exactly.
Nothing is approximate: split points come from a bounded sample, the ranges from
all rows.

Two searches use the tree.  The first finds the best rows of the anchor's label;
a row of the sample is a row, so the fifth best score within the sample is a
lower bound and makes the first annuli.  The second finds the best of the other
labels within each window, bounded likewise by the tenth best of the sample.

A block of a leaf is held in memory while the anchors that reach it are streamed
past; a leaf with many rows (or copies of one) is several blocks.  Blocks are
numbered and dealt to partitions in turn, so no hash puts two large ones together.

Defined results: rows with a NULL label, a NULL vector, or a NULL or non-finite
component take no part; shorter vectors are compared as if they ended in zeros;
a NULL id is never an anchor, but a candidate that comes last among ties; rows
that repeat an id are rows of their own, each an anchor or candidate; anchors
without a row of their label, and windows without a row, give no rows; no rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.storage import release, stored
from .hypertree import Ranges, Tree, grown, leaf_of, reachable
from .vectors import all_finite, matrix, products, whole

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: Stands for a NULL id, so that it is the last among ties.
NO_ID = (1 << 63) - 1
NOTHING = -(1 << 62)


@dataclass(frozen=True)
class Settings:
    """``sample``: rows that split points and first bounds are taken from; ``block``: rows of a leaf held at once;
    ``leaves``: about how many the tree has at most, whatever the size of the table.
    """

    positives: int = 5
    negatives: int = 10
    least_percent: int = 30
    most_percent: int = 90
    anchors: int = 100
    sample: int = 4096
    fan: int = 8
    block: int = 2048
    leaves: int = 1024


def rows_of(given: DataFrame, id: Column, label: Column, vector: Column, paths: list[str]) -> DataFrame:
    """The rows that take part: uid, id (NULLs last), label and whole-number vector, stored."""
    usable = given.where(label.isNotNull() & all_finite(vector))
    shaped = usable.select(
        F.monotonically_increasing_id().alias("uid"), F.coalesce(id.cast("long"), F.lit(NO_ID)).alias("id"),
        label.cast("long").alias("label"), whole(vector).alias("v"),
    )
    return stored(shaped, paths)


# -- the index --------------------------------------------------------------------------


def _numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def indexed(rows: DataFrame, tree: Tree, width: int, paths: list[str]) -> DataFrame:
    """Every row with the leaf it belongs to, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("leaf", pa.array(leaf_of(tree, matrix(batch.column("v"), width)), pa.int32()))

    return stored(rows.mapInArrow(run, "uid long, id long, label long, v array<int>, leaf int"), paths)


def all_ranges(rows: DataFrame, tree: Tree, width: int) -> Ranges:
    """The tree's ranges over all rows: minima and maxima per task, then of these; as many rows as the tree has edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Ranges(tree)
        for batch in batches:
            own.add(tree, matrix(batch.column("v"), width))
        at = own.filled()
        columns = [*at.T, own.low[tuple(at.T)], own.high[tuple(at.T)]]
        kinds = [pa.int32()] * 3 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "child", "slot", "low", "high"])

    ranges = Ranges(tree)
    if not tree.nodes:
        return ranges
    found = rows.select("v").mapInArrow(run, "node int, child int, slot int, low long, high long")
    for r in found.groupBy("node", "child", "slot").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        ranges.low[r.node, r.child, r.slot], ranges.high[r.node, r.child, r.slot] = r.low, r.high
    return ranges


# -- bounds and routes ------------------------------------------------------------------


def _kth_best(scores: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row; NOTHING where there are fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NOTHING)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


@dataclass(frozen=True)
class Sample:
    uid: np.ndarray
    label: np.ndarray
    rows: np.ndarray


def positive_bounds(sample: Sample, uid, label, queries: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Scores from which on a row can be one of the best of the anchor's label."""
    scores = products(queries, sample.rows)
    other = (label[:, None] == sample.label[None, :]) & (uid[:, None] != sample.uid[None, :])
    low = _kth_best(np.where(other, scores, NOTHING), settings.positives)[:, None]
    return low, np.full(low.shape, -NOTHING)


def window_bounds(sample: Sample, label, queries: np.ndarray, low: np.ndarray, high: np.ndarray, settings: Settings) -> np.ndarray:
    """Windows' lower ends, raised to where the sample already has enough rows of other labels."""
    scores = products(queries, sample.rows)
    other = label[:, None] != sample.label[None, :]
    raised = low.copy()
    for w in range(low.shape[1]):
        inside = other & (scores >= low[:, w : w + 1]) & (scores <= high[:, w : w + 1])
        raised[:, w] = np.maximum(low[:, w], _kth_best(np.where(inside, scores, NOTHING), settings.negatives))
    return raised


def windows_of(scores: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Whole scores ``n`` with ``least_percent * score <= 100 * n <= most_percent * score``; NOTHING gives none."""
    low, high = -((-settings.least_percent * scores) // 100), (settings.most_percent * scores) // 100
    none = scores == NOTHING
    return np.where(none, 1, low), np.where(none, 0, high)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), pa.int64()))


ROUTED = "leaf int, uid long, label long, v array<int>, low array<long>, high array<long>"


def routed(anchors: DataFrame, tree: Tree, ranges: Ranges, width: int, bounds) -> DataFrame:
    """Each anchor once for every leaf that its windows reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                queries = matrix(part.column("v"), width)
                low, high = bounds(part, queries)
                query, leaf = reachable(tree, ranges, queries, low, high)
                for start in range(0, len(query), 4096):
                    q, n = query[start : start + 4096], leaf[start : start + 4096]
                    plain = [part.column(c).take(pa.array(q)) for c in ("uid", "label", "v")]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(n, pa.int32()), *plain, _lists(low[q]), _lists(high[q])],
                        ["leaf", "uid", "label", "v", "low", "high"],
                    )

    return anchors.mapInArrow(run, ROUTED)


# -- leaves -----------------------------------------------------------------------------


def _best(query: np.ndarray, score: np.ndarray, ids: np.ndarray, uids: np.ndarray, most: int) -> np.ndarray:
    """Positions of the first ``most`` hits of each query: high scores first, then small ids."""
    order = np.lexsort((uids, ids, -score, query))
    starts = np.flatnonzero(np.append(True, np.diff(query[order]) != 0)) if len(order) else np.zeros(0, int)
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


FOUND = "anchor long, window int, uid long, id long, score long"


def searched(blocks: DataFrame, queries: DataFrame, parts: int, width: int, most: int, same_label: bool) -> DataFrame:
    """The best rows of every block for every anchor sent to it: at most ``most`` an anchor, window and block."""
    nothing = F.lit(None)
    rows = blocks.select("block", F.lit(0).alias("kind"), "uid", "id", "label", "v", nothing.cast("array<long>").alias("low"), nothing.cast("array<long>").alias("high"))
    asked = queries.select("block", F.lit(1).alias("kind"), "uid", nothing.cast("long").alias("id"), "label", "v", "low", "high")
    dealt = rows.unionByName(asked).repartitionById(parts, (F.col("block") % parts).cast("int")).sortWithinPartitions("block", "kind")

    def compare(held, part: pa.RecordBatch):
        uid, ids, label, x = held
        queries, own, own_label = matrix(part.column("v"), width), _numbers(part, "uid"), _numbers(part, "label")
        low, high = (part.column(c).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1) for c in ("low", "high"))
        scores = products(queries, x)
        allowed = (own_label[:, None] == label[None, :]) & (own[:, None] != uid[None, :]) if same_label else own_label[:, None] != label[None, :]
        for w in range(low.shape[1]):
            q, r = np.nonzero(allowed & (scores >= low[:, w : w + 1]) & (scores <= high[:, w : w + 1]))
            if not len(q):
                continue
            kept = _best(q, scores[q, r], ids[r], uid[r], most)
            q, r = q[kept], r[kept]
            columns = [own[q], np.full(len(q), w), uid[r], ids[r], scores[q, r]]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "window", "uid", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, kept, held = None, [], None
        for batch in batches:
            blocks_here, kinds = _numbers(batch, "block"), _numbers(batch, "kind")
            edges = np.flatnonzero(np.append(True, (np.diff(blocks_here) != 0) | (np.diff(kinds) != 0))) if len(blocks_here) else []
            for start, end in zip(edges, [*edges[1:], len(blocks_here)]):
                part = batch.slice(start, end - start)
                if blocks_here[start] != block:
                    block, kept, held = blocks_here[start], [], None
                if kinds[start] == 0:
                    kept.append((_numbers(part, "uid"), _numbers(part, "id"), _numbers(part, "label"), matrix(part.column("v"), width)))
                elif kept:
                    held = held or tuple(np.concatenate(c) for c in zip(*kept))
                    for at in range(0, part.num_rows, 512):
                        yield from compare(held, part.slice(at, 512))

    return dealt.mapInArrow(run, FOUND)


def _to_blocks(df: DataFrame, shares: DataFrame, share: Column) -> DataFrame:
    """Rows of a leaf with the number of the block (or, for an exploded share, of each block) they go to."""
    joined = df.join(F.broadcast(shares), "leaf").withColumn("share", share)
    return joined.withColumn("block", F.col("first") + F.col("share")).drop("first", "shares", "share")


def best_of(found: DataFrame, most: int, *keys: str) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(F.desc("score"), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


# -- the operator -----------------------------------------------------------------------


def mined(given: DataFrame, settings: Settings | None = None, id: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """Hard negatives of every anchor: rows whose id is divisible by ``anchors``, against all rows."""
    settings = settings or Settings()
    spark, paths = given.sparkSession, []
    rows = rows_of(given, F.col(f"`{id}`"), F.col(f"`{label}`"), F.col(f"`{vector}`"), paths)
    total, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    width = max(width, 1)
    if not total:
        return spark.createDataFrame([], RESULT)
    drawn = rows.orderBy(F.xxhash64("v", "id", "uid"), "uid").limit(settings.sample).collect()
    dense = np.zeros((len(drawn), width))
    for at, r in zip(dense, drawn):
        at[: len(r.v)] = r.v
    sample = Sample(np.array([r.uid for r in drawn]), np.array([r.label for r in drawn]), dense)
    leaves = min(settings.leaves, max(1, total // (settings.block // 4)))
    tree = grown(dense, settings.fan, max(1, len(drawn) // leaves))
    rows = indexed(rows, tree, width, paths)
    ranges = all_ranges(rows, tree, width)

    counts = sorted((r.leaf, r.n) for r in rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect())
    about, blocks = [], 0
    for leaf, n in counts:
        shares = -(-n // settings.block)
        about.append((leaf, blocks, shares))
        blocks += shares
    shares = spark.createDataFrame(about, "leaf int, first long, shares int")
    dealt = _to_blocks(rows, shares, F.pmod(F.xxhash64("uid"), F.col("shares")))
    parts = max(1, min(blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    anchors = rows.where((F.col("id") % settings.anchors == 0) & (F.col("id") != NO_ID)).drop("leaf")

    def sent(queries: DataFrame, bounds) -> DataFrame:
        return _to_blocks(routed(queries, tree, ranges, width, bounds), shares, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))

    def first(batch: pa.RecordBatch, queries: np.ndarray):
        return positive_bounds(sample, _numbers(batch, "uid"), _numbers(batch, "label"), queries, settings)

    found = searched(dealt, sent(anchors, first), parts, width, settings.positives, True)
    positives = stored(best_of(found, settings.positives, "anchor").drop("window"), paths)

    scores = F.transform(F.sequence(F.lit(1), F.lit(settings.positives)), lambda n: F.coalesce(F.get(F.col("scores"), n - 1), F.lit(NOTHING)))
    ranked = positives.groupBy(F.col("anchor").alias("uid")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("best"))
    ranked = ranked.select("uid", F.col("best.score").alias("scores"))
    asked = anchors.join(ranked, "uid").withColumn("scores", scores)

    def second(batch: pa.RecordBatch, queries: np.ndarray):
        known = batch.column("scores").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        low, high = windows_of(known, settings)
        return window_bounds(sample, _numbers(batch, "label"), queries, low, high, settings), high

    found = searched(dealt, sent(asked, second), parts, width, settings.negatives, False)
    negatives = best_of(found, settings.negatives, "anchor", "window")
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    named = positives.select("anchor", (F.col("rank") - 1).alias("window"), F.col("id").alias("p"), F.col("score").alias("positive_score"))
    out = negatives.withColumnsRenamed({"id": "n", "score": "negative_score"}).join(named, ["anchor", "window"]).join(ids, "anchor")
    shown = {c: F.when(F.col(x) != NO_ID, F.col(x)) for c, x in (("positive_id", "p"), ("negative_id", "n"))}
    result = stored(out.select("anchor_id", shown["positive_id"].alias("positive_id"), F.col("rank").cast("int").alias("rank"), shown["negative_id"].alias("negative_id"), "positive_score", "negative_score"), [])
    release(spark, paths)
    return result


def report(given: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The query: ids divisible by 7 have the next of ten labels."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(given.select("vec_id", moved.cast("long").alias("label"), "embedding"), settings)


REPORT_SQL = """
with v as materialized (
 select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
 where label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
s as materialized (
 select a.vec_id as anchor_id, a.label as own, x.vec_id as other_id, x.label,
  cast(list_dot_product(a.v, x.v) as bigint) as score
 from v a join v x on a.vec_id % 100 = 0 and a.vec_id <> x.vec_id),
p as (select * from (select *, row_number() over (partition by anchor_id order by score desc, other_id) as place
 from s where label = own) o where place <= 5),
n as (select p.anchor_id, p.other_id as positive_id, s.other_id as negative_id, p.score as positive_score,
  s.score as negative_score,
  cast(row_number() over (partition by p.anchor_id, p.other_id order by s.score desc, s.other_id) as int) as rank
 from p join s on s.anchor_id = p.anchor_id and s.label <> p.own
  and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""
