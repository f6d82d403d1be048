"""Mixing sources to target weights along a time-varying curriculum, with built-in functions only.

Every source has a share of the mix (its target, in words) and a schedule: the
rate at which it is drawn changes linearly over the training run, from
``1 - slope`` to ``1 + slope`` times its mean.  The integral of the rate is the
source's cumulative demand; inverting it at the words that precede a document
in its source gives the document's place (0 to 1) in the run, and the mix is
the documents range-sorted by that place.

Documents of a source are ordered by a hash of their id.  Running totals are
taken in two steps, per hash bucket and within it, so a source that holds a
third of all rows is never one task's window.

Defined results: NULL or empty text has size 0 and is never drawn; a NULL source
is a source of its own, after the others; NULL ids and repeated rows are
documents like any other; an empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.storage import stored
from .common import small, word_count

PRIVATE = "__mix_"


@dataclass(frozen=True)
class Curriculum:
    """``weights`` and ``slopes`` repeat over the sources in code-point order, NULL last.

    ``share`` is the size of the mix against all words, ``most`` how often a
    source may be repeated (its target stops there and the excess goes to the
    others by weight).
    """

    weights: Sequence[int] = (3, 1, 2)
    slopes: Sequence[float] = (-0.5, 0.0, 0.5)
    share: float = 1.5
    most: int = 2

    def __post_init__(self):
        if not all(-0.9 <= s <= 0.9 for s in self.slopes) or not all(w > 0 for w in self.weights):
            raise ValueError("slopes must lie within -0.9 and 0.9, weights above 0")
        if not 0 < self.share <= self.most:
            raise ValueError("share must be above 0 and at most the repeats a source allows")


def source_targets(per_source: DataFrame, curriculum: Curriculum) -> DataFrame:
    """Target of each source, from a frame of one row per source: no source, source, source_size.

    Filling by weight up to a cap: with sources ordered by cap / weight, those whose
    cap lies below their share of what is left are full, the others split the rest.
    """
    turn = F.row_number().over(W.orderBy("__mix_none", "__mix_source")) - 1

    def repeated(values, kind):
        return F.element_at(F.array(*[F.lit(v).cast(kind) for v in values]), (turn % len(values) + 1).cast("int"))

    rows = per_source.withColumn("__mix_weight", repeated(curriculum.weights, "double"))
    rows = rows.withColumn("__mix_slope", repeated(curriculum.slopes, "double"))
    rows = rows.withColumn("__mix_cap", F.col("__mix_size") * F.lit(float(curriculum.most)))
    rows = rows.withColumn("__mix_ratio", F.col("__mix_cap") / F.col("__mix_weight"))
    order = W.orderBy("__mix_ratio", "__mix_none", "__mix_source")
    below = order.rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumn("__mix_full", F.coalesce(F.sum("__mix_cap").over(below), F.lit(0.0)))
    rows = rows.withColumn(
        "__mix_rest_weight", F.sum("__mix_weight").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    )
    rows = rows.withColumn("__mix_words", F.sum("__mix_size").over(whole) * F.lit(float(curriculum.share)))
    level = (F.col("__mix_words") - F.col("__mix_full")) / F.col("__mix_rest_weight")
    # the first source that is not full sets the level; counting it as full would only lower it
    rows = rows.withColumn("__mix_level", F.when(level <= F.col("__mix_ratio"), level))
    rows = rows.withColumn("__mix_level", F.max("__mix_level").over(whole))
    target = F.least(F.col("__mix_cap"), F.coalesce(F.col("__mix_level") * F.col("__mix_weight"), F.col("__mix_cap")))
    return rows.select("__mix_none", "__mix_source", "__mix_size", "__mix_slope", target.alias("__mix_target"))


def place(words: Column, target: Column, slope: Column) -> Column:
    """Where in the run (0 to 1) a source's cumulative demand reaches ``words``.

    Demand is target * (t * (1 - slope) + slope * t * t); this is its inverse.
    """
    u = words / target
    flat = F.lit(1.0) - slope
    return F.lit(2.0) * u / (flat + F.sqrt(flat * flat + F.lit(4.0) * slope * u))


def scheduled(
    docs: DataFrame, curriculum: Curriculum | None = None, text: str = "text", source: str = "source",
    key: str = "doc_id", paths: list[str] | None = None,
) -> DataFrame:
    """The documents with private columns: size, source size, target, and the places of the copies drawn."""
    curriculum = curriculum or Curriculum()
    paths = [] if paths is None else paths
    named = F.col(f"`{source}`")
    draw = F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")))
    rows = docs.withColumns(
        {
            "__mix_words_in": word_count(F.col(f"`{text}`")),
            "__mix_none": named.isNull(),
            "__mix_source": F.coalesce(named, F.lit("")),
            "__mix_draw": draw,
            "__mix_bucket": F.substring(draw, 1, 3),
        }
    )
    held = ["__mix_none", "__mix_source"]
    totals = rows.groupBy(*held, "__mix_bucket").agg(F.sum("__mix_words_in").alias("__mix_in_bucket"))
    totals = stored(totals, paths)
    before = W.partitionBy(*held).orderBy("__mix_bucket").rowsBetween(W.unboundedPreceding, -1)
    per_source = totals.groupBy(*held).agg(F.sum("__mix_in_bucket").alias("__mix_size"))
    offsets = totals.withColumn("__mix_offset", F.coalesce(F.sum("__mix_in_bucket").over(before), F.lit(0)))
    offsets = offsets.join(source_targets(per_source, curriculum), held).drop("__mix_in_bucket")
    offsets = stored(offsets, paths)
    rows = rows.join(small(offsets), [*held, "__mix_bucket"])
    order = [F.col("__mix_draw"), F.col(f"`{key}`"), F.col("__mix_words_in"), F.xxhash64(F.col(f"`{text}`"))]
    within = W.partitionBy(*held, "__mix_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    start = F.col("__mix_offset") + F.sum("__mix_words_in").over(within) - F.col("__mix_words_in")
    rows = rows.withColumn("__mix_start", start)
    middle = F.col("__mix_start") + F.col("__mix_words_in") * F.lit(0.5)
    places = [
        F.when(
            (F.col("__mix_words_in") > 0) & (middle + F.lit(e) * F.col("__mix_size") <= F.col("__mix_target")),
            place(middle + F.lit(e) * F.col("__mix_size"), F.col("__mix_target"), F.col("__mix_slope")),
        )
        for e in range(curriculum.most)
    ]
    return rows.withColumn("__mix_places", F.array_compact(F.array(*places)))


def mixed(
    docs: DataFrame, curriculum: Curriculum | None = None, text: str = "text", source: str = "source",
    key: str = "doc_id", paths: list[str] | None = None,
) -> DataFrame:
    """The mix: the documents drawn, once per copy, range-sorted by their place in the run; columns as given."""
    rows = scheduled(docs, curriculum, text, source, key, paths)
    copies = rows.withColumn("__mix_place", F.explode("__mix_places"))
    ordered = copies.orderBy("__mix_place", "__mix_none", "__mix_source", "__mix_draw")
    return ordered.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_report(docs: DataFrame, curriculum: Curriculum | None = None, paths: list[str] | None = None) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken and the places of its copies."""
    rows = scheduled(docs.select("doc_id", "source", "text"), curriculum, paths=paths)
    return rows.select(
        "doc_id",
        F.col("__mix_words_in").alias("size"),
        F.col("__mix_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("__mix_words_in") * F.size("__mix_places")).cast("long").alias("taken"),
        F.get("__mix_places", F.lit(0)).alias("first_place"),
    )


#: The mix in DuckDB's SQL; {documents} is the table.
SQL = r"""
with sized as (
  select *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5(coalesce(cast(doc_id as varchar), '')) as draw from {documents}),
sources as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
turns as (select *, row_number() over (order by source nulls last) - 1 as turn from sources),
weighed as (select *, case turn % 3 when 0 then 3.0 when 1 then 1.0 else 2.0 end::double as weight,
    case turn % 3 when 0 then -0.5 when 1 then 0.0 else 0.5 end::double as slope, source_size * 2.0::double as cap from turns),
filled as (select *, coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0.0) as full_,
    sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as rest,
    sum(source_size) over () * 1.5::double as words from weighed),
levels as (select *, max(case when (words - full_) / rest <= cap / weight then (words - full_) / rest end) over () as level from filled),
targets as (select source, source_size, slope, least(cap, coalesce(level * weight, cap)) as target from levels),
started as (select s.*, t.source_size, t.target, t.slope,
    cast(sum(size) over (partition by s.source order by draw, s.doc_id, size rows between unbounded preceding and current row) as bigint) - size as start
  from sized s join targets t on s.source is not distinct from t.source),
placed as (select *, start + size * 0.5::double as m1, start + size * 0.5::double + source_size as m2 from started)
"""

REPORT_SQL = (
    SQL.replace("{documents}", "documents")
    + """
select doc_id, cast(size as bigint) as size, source_size, target,
  cast(size * ((size > 0 and m1 <= target)::int + (size > 0 and m2 <= target)::int) as bigint) as taken,
  case when size > 0 and m1 <= target
    then 2.0::double * (m1 / target) / ((1.0::double - slope) + sqrt((1.0::double - slope) * (1.0::double - slope) + 4.0::double * slope * (m1 / target))) end as first_place
from placed"""
)
