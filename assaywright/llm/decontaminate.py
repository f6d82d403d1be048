"""Benchmark decontamination by a distributed positional inverted index, with built-in functions only.

The index holds one posting (term, document, position) for every occurrence of a
benchmark term in the training documents, written where the documents are read:
building it shuffles nothing.  A phrase is looked up from its rarest terms: the
postings of the rarest two, each moved back by the term's offset, are
intersected, which leaves little more than the true matches; the other terms'
postings are then intersected for what is left.  Proximity matches ask for the
rarest terms of a phrase within a span of words, in any order.

A document is known by its id and a hash of its text, so repeated ids with
different texts are kept apart, and repeated rows share one result.

Defined results: NULL and word-less texts have no words and no hits; items
without words have no windows; a NULL item id is not counted or listed, though
its words are hit; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.storage import stored
from .common import ascii_lower, small, text_or_empty

BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LENGTH = 10
ANCHORS = 2
NEAR_TERMS = 3
DOC = ["doc", "print"]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), BREAK), "")


def identified(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc": F.coalesce(F.col("doc_id"), F.lit(-1)), "print": F.xxhash64("text")})


@dataclass
class TestWindows:
    """The benchmark cut to windows: items of each, and each one's terms with offsets."""

    of_items: DataFrame
    terms: DataFrame

    @staticmethod
    def of(benchmark: DataFrame, paths: list[str], length: int = LENGTH) -> TestWindows:
        items = benchmark.select(F.col("item_id"), words_of(text_or_empty("text")).alias("words")).where(F.size("words") > 0)
        starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(length - 1), F.lit(1)))
        cut = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("terms"))
        cut = stored(cut.withColumn("window", F.xxhash64("terms")), paths)
        terms = cut.dropDuplicates(["window"]).select("window", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
        return TestWindows(cut.select("window", "item_id").distinct(), terms)


@dataclass
class PositionalIndex:
    """Postings of the test terms: term, doc, print, position; stored in the shared folder."""

    postings: DataFrame
    paths: list[str] = field(default_factory=list)

    @staticmethod
    def build(docs: DataFrame, terms: DataFrame, paths: list[str]) -> PositionalIndex:
        """``terms``: a frame whose ``term`` column holds the words to index."""
        wanted = stored(terms.select("term").distinct().withColumn("term_id", F.xxhash64("term")), paths)
        tokens = identified(docs.select("doc_id", "text")).select(*DOC, F.posexplode(words_of(text_or_empty("text"))).alias("pos", "term"))
        postings = tokens.join(small(wanted), "term").select("term_id", *DOC, "pos")
        return PositionalIndex(stored(postings, paths), paths)

    def ranked(self, windows: TestWindows) -> DataFrame:
        """Terms of each window by how rare they are in the documents, rarest first."""
        seen = self.postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("seen"))
        rows = windows.terms.withColumn("term_id", F.xxhash64("term")).join(stored(seen, self.paths), "term_id", "left")
        rank = F.row_number().over(W.partitionBy("window").orderBy(F.coalesce("seen", F.lit(0)), "offset")) - 1
        return stored(rows.select("window", "length", "offset", "term_id", rank.alias("rank")), self.paths)

    def phrases(self, windows: TestWindows) -> DataFrame:
        """Exact matches: doc, print, start, window, length; stored."""
        ranked = self.ranked(windows)
        anchors = small(ranked.where(F.col("rank") < ANCHORS))
        spot = [*DOC, "start", "window", "length"]
        bit = F.expr("shiftleft(1, rank)")
        moved = self.postings.join(anchors, "term_id").select(*DOC, (F.col("pos") - F.col("offset")).alias("start"), "window", "length", bit.alias("bit"))
        met = moved.where("start >= 0").groupBy(*spot).agg(F.bit_or("bit").alias("met"))
        met = stored(met.where(F.col("met") == F.expr(f"shiftleft(1, least(length, {ANCHORS})) - 1")), self.paths)
        others = small(ranked.where(F.col("rank") >= ANCHORS).drop("length"))
        asked = met.join(others, "window").withColumn("pos", F.col("start") + F.col("offset"))
        in_doubt = stored(met.select(*DOC).distinct(), self.paths)
        there = self.postings.join(small(in_doubt), DOC, "left_semi")
        found = asked.join(there, [*DOC, "pos", "term_id"]).groupBy(*spot, "met").agg(F.bit_or(bit).alias("rest"))
        whole = F.expr("shiftleft(1, length) - 1")
        long = found.where(F.col("met").bitwiseOR(F.col("rest")) == whole).select(*spot)
        return stored(long.unionByName(met.where(F.col("length") <= ANCHORS).select(*spot)), self.paths)

    def near(self, windows: TestWindows, span: int = 30) -> DataFrame:
        """Proximity matches: documents and windows whose rarest terms all lie within ``span`` words of the rarest one."""
        ranked = self.ranked(windows).where(F.col("rank") < NEAR_TERMS)
        rows = self.postings.join(small(ranked), "term_id")
        around = W.partitionBy(*DOC, "window").orderBy("pos").rangeBetween(-span, span)
        met = F.bit_or(F.expr("shiftleft(1, rank)")).over(around)
        found = rows.withColumn("met", met).where("rank = 0")
        return found.where(F.col("met") == F.expr(f"shiftleft(1, least(length, {NEAR_TERMS})) - 1")).select(*DOC, "pos", "window")


def hits_of(docs: DataFrame, benchmark: DataFrame, paths: list[str]) -> tuple[DataFrame, TestWindows]:
    windows = TestWindows.of(benchmark, paths)
    return PositionalIndex.build(docs, windows.terms, paths).phrases(windows), windows


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    paths: list[str] = []
    hits, windows = hits_of(docs, benchmark, paths)
    ends = hits.groupBy(*DOC, "start").agg((F.col("start") + F.max("length")).alias("end"))
    before = W.partitionBy(*DOC).orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.withColumn("covered", F.coalesce(F.max("end").over(before), F.lit(0)))
    fresh = F.greatest(F.col("end") - F.greatest("start", "covered"), F.lit(0))
    lengths = ends.groupBy(*DOC).agg(F.sum(fresh).cast("long").alias("n_hit"))
    named = hits.select(*DOC, "window").distinct().join(windows.of_items, "window")
    named = named.groupBy(*DOC).agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    found = stored(lengths.join(named, DOC), paths)
    every = identified(docs.select("doc_id", "text"))
    every = every.select("doc_id", *DOC, F.size(words_of(text_or_empty("text"))).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(small(found), DOC, "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, paths: list[str] | None = None) -> DataFrame:
    """The documents that hold no benchmark window, columns as given."""
    paths = [] if paths is None else paths
    hits, _ = hits_of(docs, benchmark, paths)
    found = stored(hits.select(F.col("doc").alias("__doc"), F.col("print").alias("__print")).distinct(), paths)
    mine = F.coalesce(F.col("doc_id"), F.lit(-1))
    return docs.join(small(found), (mine == F.col("__doc")) & (F.xxhash64("text") == F.col("__print")), "left_anti")


#: Hits of each document in DuckDB's SQL; {documents} is the table.
SQL = r"""
with doc_words as (select doc_id, row_number() over () as row_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from {documents}),
item_words as (select item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from benchmark),
cut as (select item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as i from item_words where len(words) > 0),
windows as (select distinct item_id, array_to_string(words[i:i + 9], ' ') as phrase, least(len(words), 10) as length from cut),
lengths as (select distinct length from windows),
spots as (select row_id, words, length, unnest(range(1, len(words) - length + 2)) as i from doc_words, lengths where len(words) >= length),
hits as (select s.row_id, s.i, s.length, w.item_id from spots s join windows w
    on s.length = w.length and array_to_string(s.words[s.i:s.i + s.length - 1], ' ') = w.phrase),
hit_words as (select row_id, count(distinct p) as n_hit from (select row_id, unnest(range(i, i + length)) as p from hits) group by row_id),
hit_items as (select row_id, list_sort(list(distinct cast(item_id as varchar))) as items from hits group by row_id)
"""

REPORT_SQL = (
    SQL.replace("{documents}", "documents")
    + """
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(len(items), 0) as bigint) as n_items, sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc_words left join hit_words using (row_id) left join hit_items using (row_id)"""
)
