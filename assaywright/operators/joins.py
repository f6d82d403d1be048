"""Joins: by name, against keyed facts with hot keys split off, and null-safe merges."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import named
from .storage import stored

ROWS = "__n"


@dataclass(frozen=True)
class SizeLimit:
    """What may be broadcast, and from how many rows on a key counts as hot."""

    rows: int = 1_000_000
    bytes: int = 128 * 1024 * 1024
    hot_rows: int = 100_000

    def admits(self, keyed: DataFrame) -> bool:
        return self.after(keyed) is not None

    def after(self, keyed: DataFrame, of_table: bool = False) -> SizeLimit | None:
        """What is left once the frame is broadcast; None when it does not fit.

        Measured, not estimated: one aggregate over a stored or source frame.  A
        whole table's rows are counted first, which file footers answer.
        """
        if of_table and keyed.count() > self.rows:
            return None
        width = F.length(F.concat_ws("", *[named(c).cast("string") for c in keyed.columns]))
        rows, size = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
        size += 16 * rows * len(keyed.columns)
        if rows > self.rows or size > self.bytes:
            return None
        return replace(self, rows=self.rows - rows, bytes=self.bytes - size)


def join_by_name(left: DataFrame, right: DataFrame, how: str = "inner", columns: Sequence[str] = ()) -> DataFrame:
    """Equi-join on the named (or all common) columns, keeping the left side's key columns.

    Names match without regard to case; NULL keys never match.
    """
    left_names = {c.lower(): c for c in left.columns}
    right_names = {c.lower(): c for c in right.columns}
    wanted = [c.strip().lower() for c in columns] or [c for c in left_names if c in right_names]
    if not wanted:
        raise ValueError("the two sides share no column to join on")
    renamed = right.select(
        *[
            named(c).alias(f"__right_{c.lower()}") if c.lower() in wanted else named(c)
            for c in right.columns
        ]
    )
    test = None
    for name in wanted:
        pair = named(left_names[name]) == named(f"__right_{name}")
        test = pair if test is None else test & pair
    return left.join(renamed, test, how).drop(*[f"__right_{name}" for name in wanted])


def join_keyed(
    rows: DataFrame,
    key_values: Sequence[Column],
    keyed: DataFrame,
    keys: Sequence[str],
    limit: SizeLimit,
    how: str = "inner",
    paths: list[str] | None = None,
) -> DataFrame:
    """Join rows to a stored frame holding one row per key and ``__n``, the rows behind that key.

    A frame within the limit is broadcast, so the rows are not shuffled at all.
    Beyond it, the keys that carry many of the rows, whether the frame holds them
    or not, are counted and broadcast on their own, rows with a NULL key match
    nothing and stay where they are, and only the rest is shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError("join_keyed supports inner and left")
    wide = rows.withColumns(dict(zip(keys, key_values)))
    on = list(keys)
    if limit.admits(keyed):
        return wide.join(F.broadcast(keyed), on, how)
    whole = reduce(and_, [F.col(k).isNotNull() for k in on])
    named_rows = wide.where(whole)
    counted = named_rows.groupBy(*on).agg(F.count(F.lit(1)).alias(ROWS))
    hot = _hot_keys(counted, limit, paths)[0].select(*on)
    facts = stored(keyed.join(F.broadcast(hot), on, "left_semi"), [] if paths is None else paths)
    of_hot = named_rows.join(F.broadcast(hot), on, "left_semi").join(F.broadcast(facts), on, how)
    of_cold = named_rows.join(F.broadcast(hot), on, "left_anti").join(keyed, on, how)
    joined = of_hot.unionByName(of_cold)
    if how == "inner":
        return joined
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in keyed.schema if f.name not in on}
    return joined.unionByName(wide.where(~whole).withColumns(nothing))


def _hot_keys(counted: DataFrame, limit: SizeLimit, paths: list[str] | None) -> tuple[DataFrame, int]:
    """Keys with many rows, few enough to broadcast, and the row count that makes a key hot.

    At most all rows / hot_rows keys qualify; they are stored, so that raising
    the bound until they fit re-reads only them.
    """
    kept = stored(counted.where(F.col(ROWS) >= limit.hot_rows), [] if paths is None else paths)
    hot_rows = limit.hot_rows
    while not limit.admits(kept.where(F.col(ROWS) >= hot_rows)):
        hot_rows *= 10
    return kept.where(F.col(ROWS) >= hot_rows), hot_rows


#: Rows of the hashed side of a full join that a partition holds.
_BUILT_ROWS = 500_000
_INNER, _LEFT, _RIGHT, _FULL = "inner", "left", "right", "full"
_KINDS = {"inner": _INNER, "left": _LEFT, "leftouter": _LEFT, "right": _RIGHT, "rightouter": _RIGHT}
_KINDS |= {"full": _FULL, "outer": _FULL, "fullouter": _FULL}


def spread_join(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str],
    how: str,
    limit: SizeLimit,
    shares: int = 64,
    paths: list[str] | None = None,
) -> DataFrame:
    """``join_by_name`` for tables of any size, with hot keys of either side spread over many tasks.

    A side that may be broadcast and is within the limit is.  Otherwise a hot key
    becomes a grid of cells: the rows of the side on which it is hot are dealt
    over one axis (by row content and source partition, so a rerun deals alike) and the other side's rows of that
    key are repeated along it.  Rows with a NULL key match nothing and are dealt too.

    Outer joins need no second pass: a key that is hot on one side has rows there,
    so no row of the other side with that key can be without a match.  Where such a
    row meets an empty cell it is dropped; every other row stands in one cell and is settled there.

    Few input rows may have many partners, so cells are dealt over a fixed number of partitions: adaptive execution
    would put small ones together into one task.  A full join by sorting holds all pairs of a key in memory, so it is
    done by hashing the side with fewer rows, in partitions of about ``_BUILT_ROWS`` of them.
    """
    names = {c.lower(): c for c in left.columns}
    theirs = {c.lower(): c for c in right.columns}
    on = [c.strip().lower() for c in columns] or [c for c in names if c in theirs]
    kind = _KINDS.get(how.lower().replace("_", ""))
    if not on or kind is None:
        return join_by_name(left, right, how, on)
    if kind in (_INNER, _LEFT) and limit.after(right, of_table=True) is not None:
        return join_by_name(left, F.broadcast(right), how, on)
    if kind == _RIGHT and limit.after(left, of_table=True) is not None:
        return join_by_name(F.broadcast(left), right, how, on)
    hot = _hot_on_either(left, [names[c] for c in on], right, [theirs[c] for c in on], limit, paths)
    mine = _in_cells(left, [names[c] for c in on], hot, ("__left_hot", "__i"), ("__right_hot", "__j"), shares)
    other = _in_cells(right, [theirs[c] for c in on], hot, ("__right_hot", "__j"), ("__left_hot", "__i"), shares)
    mine = mine.withColumn("__mine", F.lit(True)).withColumnRenamed("__elsewhere", "__mine_met")
    other = other.withColumn("__other", F.lit(True)).withColumnRenamed("__elsewhere", "__other_met")
    parts = max(4 * shares, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if kind == _FULL:
        counts = mine.count(), other.count()
        parts = max(parts, min(counts) // _BUILT_ROWS)
        mine, other = (mine.hint("shuffle_hash"), other) if counts[0] < counts[1] else (mine, other.hint("shuffle_hash"))
    if kind == _FULL or not hot.isEmpty():
        mine = mine.repartition(parts, *[named(names[c]) for c in on], "__i", "__j")
        other = other.repartition(parts, *[named(theirs[c]) for c in on], "__i", "__j")
    joined = join_by_name(mine, other, how, [*on, "__i", "__j"])
    if kind in (_LEFT, _FULL):
        joined = joined.where(F.col("__other").isNotNull() | ~F.coalesce("__mine_met", F.lit(False)))
    if kind in (_RIGHT, _FULL):
        joined = joined.where(F.col("__mine").isNotNull() | ~F.coalesce("__other_met", F.lit(False)))
    return joined.drop("__i", "__j", "__mine", "__other", "__mine_met", "__other_met")


def _hot_on_either(
    left: DataFrame, left_keys: Sequence[str], right: DataFrame, right_keys: Sequence[str], limit: SizeLimit, paths
) -> DataFrame:
    """Keys hot on the left or the right, with a flag for each; each side's keys were measured to fit."""
    marks, found = [f"__hot_{i}" for i in range(len(left_keys))], []
    for side, keys, flags in ((left, left_keys, (True, False)), (right, right_keys, (False, True))):
        whole = reduce(and_, [named(k).isNotNull() for k in keys])
        counted = side.where(whole).groupBy(*[named(k).alias(m) for k, m in zip(keys, marks)])
        hot, _ = _hot_keys(counted.agg(F.count(F.lit(1)).alias(ROWS)), limit, paths)
        found.append(hot.select(*marks, *[F.lit(f).alias(n) for f, n in zip(flags, ("__left_hot", "__right_hot"))]))
    flags = [F.max(n).alias(n) for n in ("__left_hot", "__right_hot")]
    return found[0].union(found[1]).groupBy(*marks).agg(*flags)


def _in_cells(
    rows: DataFrame, keys: Sequence[str], hot: DataFrame, own: tuple[str, str], across: tuple[str, str], shares: int
) -> DataFrame:
    """Rows with their cell: dealt over the axis on which their key is hot, repeated along the other side's.

    A key hot on both sides has about ``shares`` cells as well, the root of it on
    each axis.  ``__elsewhere``: the key is hot on the other side, which so has a match.
    """
    (own_flag, own_axis), (other_flag, other_axis) = own, across
    marks = [c for c in hot.columns if c not in (own_flag, other_flag)]
    share = F.xxhash64(*[named(c) for c in rows.columns], F.spark_partition_id())
    wide = rows.withColumn("__share", share).join(F.broadcast(hot), _same(keys, marks, False), "left")
    is_own, is_other = (F.coalesce(F.col(flag), F.lit(False)) for flag in (own_flag, other_flag))
    unnamed = reduce(or_, [named(k).isNull() for k in keys])
    width = F.when(is_own & is_other, F.lit(max(1, math.isqrt(shares)))).otherwise(F.lit(shares))
    dealt = F.when(is_own | unnamed, F.pmod(F.col("__share"), width)).otherwise(F.lit(0)).cast("int")
    copies = F.when(is_other, F.sequence(F.lit(0), width - 1)).otherwise(F.array(F.lit(0)))
    wide = wide.withColumns({own_axis: dealt, "__elsewhere": is_other, other_axis: copies})
    return wide.withColumn(other_axis, F.explode(other_axis)).drop("__share", own_flag, other_flag, *marks)


def without_keys(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    null_safe: bool,
    limit: SizeLimit | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """Rows whose key is not in ``keyed``; with ``null_safe`` a NULL key part equals a NULL.

    Few keys are broadcast, so the rows stay where they are.  Beyond the limit
    rows of hot keys are settled against a broadcast of just those keys and the
    others by a hash join.
    """
    limit = limit or SizeLimit()
    marks = [f"__other_{i}" for i in range(len(keys))]
    other = keyed.select(*[named(k).alias(m) for k, m in zip(keys, marks)]).distinct()
    if limit.admits(other):
        return rows.join(F.broadcast(other), _same(keys, marks, null_safe), "left_anti")
    counted = rows.groupBy(*[named(k).alias(f"__key_{i}") for i, k in enumerate(keys)])
    counted = counted.agg(F.count(F.lit(1)).alias(ROWS))
    hot, _ = _hot_keys(counted, limit, paths)
    hot = hot.drop(ROWS)
    heads = hot.columns
    taken = hot.join(other, _same(heads, marks, null_safe), "left_semi")
    cold_rows = rows.join(F.broadcast(hot), _same(keys, heads, True), "left_anti")
    hot_rows_kept = rows.join(F.broadcast(hot), _same(keys, heads, True), "left_semi")
    hot_rows_kept = hot_rows_kept.join(F.broadcast(taken), _same(keys, heads, True), "left_anti")
    return hot_rows_kept.unionByName(cold_rows.join(other, _same(keys, marks, null_safe), "left_anti"))


def _same(left: Sequence[str], right: Sequence[str], null_safe: bool) -> Column:
    test = None
    for a, b in zip(left, right):
        pair = named(a).eqNullSafe(F.col(b)) if null_safe else named(a) == F.col(b)
        test = pair if test is None else test & pair
    return test


def null_safe_anti(
    left: DataFrame, right: DataFrame, keys: Sequence[str], limit: SizeLimit | None = None
) -> DataFrame:
    """Left rows whose key (NULL equals NULL) is not on the right; a hash join, not a nested loop."""
    return without_keys(left, right, keys, True, limit)


def insert_if_absent(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    limit: SizeLimit | None = None,
    paths: list[str] | None = None,
) -> DataFrame:
    """The source rows to append: one per key, and only keys the target does not hold.

    The target is first reduced to the source's keys by a semi join, so it is
    neither made distinct nor measured.  Source keys within the limit are
    broadcast and the target stays where it is; beyond it the target's keys are
    shuffled as the left side, which adaptive execution may split where a key is
    hot and Spark may thin by a Bloom filter.  What is left has no more keys than
    the source.  ``paths``: store the source's keys once instead of reading it again.
    """
    limit = limit or SizeLimit()
    fresh = one_per_key(source, keys)
    if paths is not None:
        fresh = stored(fresh, paths)
    marks = [f"__other_{i}" for i in range(len(keys))]
    wanted = fresh.select(*[named(k).alias(m) for k, m in zip(keys, marks)])
    few = limit.admits(wanted)
    held = target.join(F.broadcast(wanted) if few else wanted, _same(keys, marks, True), "left_semi")
    held = held.select(*[named(k).alias(m) for k, m in zip(keys, marks)]).distinct()
    left = fresh.join(F.broadcast(held) if few else held, _same(keys, marks, True), "left_anti")
    return left.select(*target.columns)


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], limit: SizeLimit | None = None
) -> DataFrame:
    """Target with matched rows replaced and the rest of the source added; NULL keys always insert."""
    fresh = one_per_key(source, keys)
    kept = without_keys(target, fresh, keys, False, limit)
    return kept.select(*target.columns).unionByName(fresh.select(*target.columns))


def delete_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], limit: SizeLimit | None = None
) -> DataFrame:
    """Drop every target row whose (null-safe) key is in the source, then add the whole source."""
    return null_safe_anti(target, source, keys, limit).unionByName(source.select(*target.columns))


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by all columns, so reruns agree.

    A partial minimum runs before the shuffle, so copies of one key never meet in one task.
    """
    rest = [c for c in rows.columns if c not in set(keys)]
    if not rest:
        return rows.distinct()
    smallest = F.min(F.struct(*[named(c) for c in rest])).alias("__kept")
    chosen = rows.groupBy(*[named(k) for k in keys]).agg(smallest)
    return chosen.select(
        *[named(c) if c in set(keys) else F.col("__kept").getField(c).alias(c) for c in rows.columns]
    )
