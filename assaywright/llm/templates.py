"""Line dedup by a log-template tree, with built-in functions only.

A line falls into the leaf of its number of tokens and its leading tokens, with
tokens that hold a digit taken as variable.  In leaves that recur, a token is
constant at its place if it stands there in enough documents, and variable
(``<*>``) otherwise; so lines that differ in some fields share a template.
Lines are dropped if their template recurs in enough documents and most of it is
constant.

What is enough for a constant is tried at several levels, each ``widening`` times
the one before, while most of the line stays constant.  The values of a field
grow with the table as its fixed tokens do, and some level lies between the two,
whatever the size of the table and whichever other formats share the leaf.  A
line is dropped if its template of any level recurs.

With ``exact`` a line is also dropped if it recurs as it stands, however short
it is and whatever part of it holds digits.

Lines with equal tokens (a shape) share their templates, which are made once.  A
shape that recurs in enough documents is its own template of the first level, so
its lines are settled without looking at tokens; only leaves that hold another
shape as well as one not settled are looked into, with all their lines.  Counts
are of documents, by partial aggregates.

Defined results: NULL text stays NULL, lines without a token always stay; ids
may be NULL or repeated (a document is its id and a hash of its text), repeated
rows count as one document and lose the same lines.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import ROWS, join_keyed
from ..operators.storage import stored
from .common import BROADCAST, GAP, GAP_CHARACTERS, small, text_or_empty

DOC = ["doc", "print"]
VARIABLE = "<*>"


@dataclass(frozen=True)
class Tree:
    depth: int = 3
    least_documents: int = 10
    least_constant: float = 0.6
    least_tokens: int = 4
    widening: int = 0  # 0: the first level only
    exact: bool = False


#: What is used where no tree is given.
RECURRING = Tree(least_documents=2, widening=2, exact=True)


def _masked(said: Column) -> Column:
    """The tokens, joined by spaces, with those that hold a digit as variable; a token is looked at from its start only."""
    return F.when(said.rlike("[0-9]"), F.regexp_replace(said, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", VARIABLE)).otherwise(said)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"doc": F.coalesce(F.col("doc_id"), F.lit(-1)), "print": F.xxhash64("text")})


def _templates(tree: Tree) -> Column:
    """Hashes of a line's templates (``parts``: at, token, documents of the token there), one a level, if mostly constant."""

    def template(least: Column) -> Column:
        shown = F.transform("parts", lambda p: F.when(p["n"] >= least, p["token"]).otherwise(F.lit(VARIABLE)))
        return F.transform(F.array(shown), lambda x: F.when(_constant(x) >= tree.least_constant, F.xxhash64(F.col("leaf"), x)))[0]

    levels = F.array(F.lit(tree.least_documents).cast("long"))
    if tree.widening > 1:
        most = F.greatest(F.lit(1.0), F.array_max(F.transform("parts", lambda p: p["n"])) / F.lit(float(tree.least_documents)))
        steps = F.sequence(F.lit(0), F.floor(F.log2(most) / math.log2(tree.widening)).cast("int"))
        levels = F.transform(steps, lambda k: (F.lit(tree.least_documents) * F.pow(F.lit(float(tree.widening)), k)).cast("long"))
    return F.array_distinct(F.array_compact(F.transform(levels, template)))


def _tokens(said: Column | str) -> Column:
    return F.split(said, " ")


def _constant(shown: Column) -> Column:
    return F.size(F.filter(shown, lambda x: x != VARIABLE)) / F.size(shown)


def _recurring(shaped: DataFrame, tree: Tree, paths: list[str]) -> DataFrame:
    """From stored rows (doc, print, line, template): the lines whose template recurs."""
    known = shaped.select("template", *DOC).distinct().groupBy("template").agg(F.count(F.lit(1)).alias(ROWS))
    known = stored(known.where(F.col(ROWS) >= tree.least_documents), paths)
    return join_keyed(shaped, [F.col("template")], known, ["template"], BROADCAST, "inner", paths).select(*DOC, "line")


def dropped_lines(docs: DataFrame, paths: list[str], tree: Tree | None = None) -> DataFrame:
    """Per document that loses lines: doc, print, the numbers of the lines; stored."""
    tree = tree or RECURRING
    said = F.btrim("said", F.lit(GAP_CHARACTERS))
    lines = _identified(docs.select("doc_id", "text")).select(*DOC, F.posexplode(F.split(text_or_empty("text"), "\n")).alias("line", "said"))
    lines = lines.where(said != "").select(*DOC, "line", F.split(said, GAP).alias("words"))
    lines = lines.where((F.size("words") >= tree.least_tokens) | F.lit(tree.exact))
    lines = lines.select(*DOC, "line", F.size("words").alias("size"), F.array_join("words", " ").alias("said"))
    lines = lines.select(*DOC, "line", "size", F.xxhash64("said").alias("exact"), _masked(F.col("said")).alias("tokens"))
    long = F.col("size") >= tree.least_tokens
    leaf = F.when(long, F.xxhash64("size", F.substring_index("tokens", " ", tree.depth)))
    some = F.col("tokens").contains(VARIABLE)
    lines = lines.select(
        *DOC, "line", "exact", leaf.alias("leaf"), F.xxhash64("tokens").alias("shape"),
        F.when(some, _constant(_tokens("tokens")) >= tree.least_constant).otherwise(tree.least_constant <= 1).alias("open"),
        F.when(long, F.col("tokens")).alias("tokens"),
    )
    lines = stored(lines, paths)
    gone = []
    if tree.exact:
        gone.append(_recurring(lines.select(*DOC, "line", F.col("exact").alias("template")), tree, paths))
    lines = lines.where("leaf is not null").drop("exact")
    shapes = lines.select("leaf", "shape", "open", *DOC).distinct().groupBy("leaf", "shape", "open").agg(F.count(F.lit(1)).alias(ROWS))
    shapes = stored(shapes, paths)
    enough = F.col(ROWS) >= tree.least_documents
    settled = stored(shapes.where(F.col("open") & enough).select("shape", ROWS), paths)
    gone.append(join_keyed(lines.select(*DOC, "line", "shape"), [F.col("shape")], settled, ["shape"], BROADCAST, "inner", paths).select(*DOC, "line"))
    leaves = shapes.groupBy("leaf").agg(F.sum(ROWS).alias(ROWS), F.max(F.col("open") & ~enough).alias("unsettled"), F.count(F.lit(1)).alias("shapes"))
    leaves = stored(leaves.where(F.col("unsettled") & (F.col("shapes") > 1) & enough).select("leaf", ROWS), paths)
    looked = join_keyed(lines, [F.col("leaf")], leaves, ["leaf"], BROADCAST, "inner", paths).drop(ROWS)
    looked = stored(looked, paths)
    spot = F.xxhash64("leaf", "at", "token").alias("spot")
    placed = looked.select("leaf", *DOC, F.posexplode(_tokens("tokens")).alias("at", "token")).where(F.col("token") != VARIABLE)
    constant = placed.select(spot, *DOC).distinct().groupBy("spot").agg(F.count(F.lit(1)).alias(ROWS))
    constant = stored(constant.where(F.col(ROWS) >= tree.least_documents), paths)
    looked = looked.where("open")
    asked = stored(looked.groupBy("leaf", "shape").agg(F.min("tokens").alias("tokens")), paths)  # a shape has one text
    placed = asked.select("leaf", "shape", F.posexplode(_tokens("tokens")).alias("at", "token"))
    kept = join_keyed(placed, [spot], constant, ["spot"], BROADCAST, "left", paths)
    part = F.struct("at", "token", F.coalesce(F.col(ROWS), F.lit(0)).alias("n"))
    found = kept.groupBy("leaf", "shape").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    found = found.select("shape", _templates(tree).alias("templates"), F.lit(1).cast("long").alias(ROWS))
    found = stored(found.where(F.size("templates") > 0), paths)
    whole = join_keyed(looked.select(*DOC, "line", "shape"), [F.col("shape")], found, ["shape"], BROADCAST, "inner", paths)
    whole = stored(whole.select(*DOC, "line", F.explode("templates").alias("template")), paths)
    gone.append(_recurring(whole, tree, paths))
    gone = reduce(DataFrame.unionByName, gone)
    return stored(gone.groupBy(*DOC).agg(F.collect_set("line").alias("gone")), paths)


def without_recurring_lines(docs: DataFrame, paths: list[str] | None = None, tree: Tree | None = None) -> DataFrame:
    """The documents with lines of recurring templates taken out, columns as given and ``__gone``, their number."""
    paths = [] if paths is None else paths
    gone = dropped_lines(docs, paths, tree).select(F.col("doc").alias("__doc"), F.col("print").alias("__print"), F.col("gone").alias("__lines"))
    same = (F.coalesce(F.col("doc_id"), F.lit(-1)) == F.col("__doc")) & (F.xxhash64("text") == F.col("__print"))
    rows = docs.join(small(gone), same, "left")
    left = F.filter(F.transform(F.split("text", "\n"), lambda x, i: F.when(~F.array_contains("__lines", i), x)), lambda x: x.isNotNull())
    text = F.when(F.col("__lines").isNotNull(), F.array_join(left, "\n")).otherwise(F.col("text"))
    number = F.when(F.col("__lines").isNotNull(), F.size("__lines")).otherwise(0).cast("long")
    return rows.withColumns({"text": text, "__gone": number}).select(*[F.col(f"`{c}`") for c in docs.columns], "__gone")


def report(docs: DataFrame, tree: Tree | None = None) -> DataFrame:
    rows = without_recurring_lines(docs.select("doc_id", "text"), tree=tree)
    digest = F.sha2(text_or_empty("text").cast("binary"), 256)
    return rows.select("doc_id", F.col("__gone").alias("n_dropped_lines"), digest.alias("kept_sha256"))
