"""Secrets in texts, with built-in functions only.

Three fixed patterns give the base spans: assignments, access keys and long hex
strings.  On top, candidate strings (runs of key characters with a digit) are
scanned by a sliding window: the counts of the characters in the window and the
sum of n log n over them change by the character that enters and the one that
leaves, and the entropy of the window is held against the limit of the
candidate's character class.  Candidates on the allow-list are left out; base
spans never are.

Offsets count code points, ends exclusive; they come from the lengths of the
matches and of what stands between them.

Defined results: NULL text is empty and has no spans; repeated rows are scanned
one by one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

# fixed values: the base patterns
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # as AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"  # as [0-9a-f]+ of 24 or more characters
KINDS = ("assign", "access", "hex", "entropy")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = "[A-Za-z0-9+/_=-]"
_PART, _PART_END = "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"
_UNIT = 1_000_000


@dataclass(frozen=True)
class CharacterClass:
    """Candidates that match the pattern, and the bits a character from which a window counts as random."""

    pattern: str
    bits: float


@dataclass(frozen=True)
class Scan:
    """The first class that a candidate matches decides; the last ones take every candidate.

    Names, prefixes and signs around a value do not hide it: a part between signs
    that is as long as a window is classed as it would be alone.
    """

    width: int = 20
    classes: Sequence[CharacterClass] = (
        CharacterClass(r"^[0-9+/_=-]+$", math.inf),
        CharacterClass(r"^[0-9a-fA-F]+$", 3.0),
        CharacterClass(r"^(?=(?:[^0-9]*[0-9]){4})(?:[0-9a-z]+|[0-9A-Z]+)$", 3.7),
        CharacterClass(rf"{_PART}(?=[0-9]*[a-fA-F])[0-9a-fA-F]{{20,}}{_PART_END}", 3.0),
        CharacterClass(rf"{_PART}(?=(?:[A-Za-z]*[0-9]){{4}})(?:[0-9a-z]{{20,}}|[0-9A-Z]{{20,}}){_PART_END}", 3.7),
        CharacterClass(r"^(?=.*[a-z])(?=.*[A-Z])", 3.9),
        CharacterClass(r"^(?:[^0-9]*[0-9]){4}", 3.9),
        CharacterClass(r"^", 4.1),
    )
    allowed: Sequence[str] = (
        r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
        r"(?i)example|sample|placeholder|changeme",
        r"^(?:[A-Za-z]+[/_-])+[A-Za-z]*[0-9]{0,4}$",
        r"(.)\1{7}",
    )


def located(text: Column, pattern: str) -> Column:
    """Leftmost matches that do not overlap: an array of (start, end)."""
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    between = F.transform(F.split(text, pattern, -1), F.length)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def step(state, pair):
        start = state["at"] + pair["gap"]
        end = start + pair["long"]
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda g, m: F.struct(g.alias("gap"), m.alias("long")))
    state = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
    found = F.aggregate(pairs, state, step, lambda s: s["spans"])
    return F.when(text.rlike(pattern), found).otherwise(empty)


def of_kind(spans: Column, kind: str) -> Column:
    at = F.lit(KINDS.index(kind))
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), at.alias("kind"), s["end"].alias("end")))


def base_spans(text: Column) -> dict[str, Column]:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = F.zip_with(located(text, ASSIGN), values, lambda s, v: F.when(F.length(v) >= 6, s))
    assigned = F.when(text.rlike(ASSIGN), F.array_compact(long_enough)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    return {
        "assign": of_kind(assigned, "assign"),
        "access": of_kind(located(text, ACCESS), "access"),
        "hex": of_kind(located(text, HEX), "hex"),
    }


def random_part(candidate: Column, scan: Scan) -> Column:
    """(start, end) within the candidate from the first to the last window over its class's limit, or NULL."""
    n_log_n = F.array(*[F.lit(round(n * math.log2(n) * _UNIT) if n else 0) for n in range(scan.width + 1)]).cast("array<long>")
    most = round(scan.width * math.log2(scan.width) * _UNIT)
    limit = F.lit(None).cast("long")
    for kind in reversed(scan.classes):
        at_most = -1 if math.isinf(kind.bits) else most - round(kind.bits * scan.width * _UNIT)
        limit = F.when(candidate.rlike(kind.pattern), F.lit(at_most).cast("long")).otherwise(limit)
    allowed = F.lit(False)
    for pattern in scan.allowed:
        allowed = allowed | candidate.rlike(pattern)
    codes = F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def scanned(codes):
        def step(state, i):
            enters = F.get(codes, i)
            leaves = F.when(i >= scan.width, F.get(codes, i - scan.width)).otherwise(F.lit(-1))
            had = F.when(leaves >= 0, F.get(state["counts"], leaves)).otherwise(F.lit(0))
            has = F.get(state["counts"], enters) - (enters == leaves).cast("int")
            less = F.when(had > 0, F.get(n_log_n, had - 1) - F.get(n_log_n, had)).otherwise(F.lit(0))
            total = state["total"] + less + F.get(n_log_n, has + 1) - F.get(n_log_n, has)
            counts = F.transform(state["counts"], lambda c, k: c + (k == enters).cast("int") - (k == leaves).cast("int"))
            random = (i >= scan.width - 1) & (total <= state["limit"])
            first = F.when(random & (state["first"] < 0), i - (scan.width - 1)).otherwise(state["first"])
            last = F.when(random, i + 1).otherwise(state["last"])
            return F.struct(
                counts.alias("counts"), total.cast("long").alias("total"), state["limit"].alias("limit"), first.cast("int").alias("first"), last.cast("int").alias("last")
            )

        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0).cast("long").alias("total"), limit.alias("limit"),
            F.lit(-1).alias("first"), F.lit(-1).alias("last"),
        )
        found = lambda s: F.when(s["first"] >= 0, F.struct(s["first"].alias("start"), s["last"].alias("end")))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, found)

    worth = (limit >= 0) & ~allowed
    return F.when(worth, F.get(F.transform(F.array(codes), scanned), F.lit(0)))


def entropy_spans(text: Column, scan: Scan) -> Column:
    """Spans of random-looking parts of candidate strings."""
    pattern = f"(?<!{_RUN})(?=[A-Za-z+/_=-]*[0-9]){_RUN}{{{scan.width},}}"
    strings = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def shifted(span, string):
        part = F.transform(F.array(random_part(string, scan)), lambda p: F.when(p.isNotNull(), F.struct((span["start"] + p["start"]).alias("start"), (span["start"] + p["end"]).alias("end"))))
        return F.get(part, F.lit(0))

    found = F.array_compact(F.zip_with(located(text, pattern), strings, shifted))
    return F.when(text.rlike(pattern), of_kind(found, "entropy")).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def scanned(docs: DataFrame, scan: Scan | None = None, text: str = "text") -> DataFrame:
    """The documents with private columns: spans (start, kind, end) of each base kind, and all, in order."""
    scan = scan or Scan()
    value = text_or_empty(F.col(f"`{text}`"))
    rows = docs.withColumns({f"__{kind}": spans for kind, spans in base_spans(value).items()})
    rows = rows.withColumn("__base", F.array_sort(F.concat("__assign", "__access", "__hex")))
    more = F.filter(
        entropy_spans(value, scan),
        lambda s: ~F.exists("__base", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"])),
    )
    return rows.withColumn("__spans", F.array_sort(F.concat(F.col("__base"), more)))


def as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(docs: DataFrame, scan: Scan | None = None, mark: str = "[secret]", text: str = "text") -> DataFrame:
    """The documents with every span replaced, columns as given; overlapping spans become one mark."""
    rows = scanned(docs, scan, text)
    value = F.col(f"`{text}`")
    cut = F.aggregate(
        "__spans",
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda s, p: F.struct(
            F.when(p["start"] >= s["at"], F.concat(s["out"], F.substring(value, s["at"] + 1, p["start"] - s["at"]), F.lit(mark)))
            .otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], p["end"]).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(value, s["at"] + 1, F.length(value))),
    )
    clean = F.when(F.size("__spans") > 0, cut).otherwise(value)
    return rows.withColumn(text, clean).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, scan: Scan | None = None) -> DataFrame:
    rows = scanned(docs.select("doc_id", "text"), scan)
    return rows.select(
        "doc_id",
        *[F.size(f"__{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(as_text(F.col("__base")).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("__spans")).alias("spans"),
    )
