"""Quality rules by distribution divergence.

Two histograms of a document, of its character classes and of common words, are
compared with the references of every language by Jensen-Shannon distance
(base 2, 0 to 1).  A document is kept if it is close to some language in both.
Close means no farther than ordinary documents of the language and of about the
same length are: the shorter a text, the noisier its word shares.  For every
language and length band the distances of all its documents to their own
reference (within a band brought to the same length by the square root of it) are
counted in a histogram, and the limit is the median plus
``spread`` times the distance from the tenth percentile to the median, which junk
among the documents hardly moves.  In words it is not set below ``word_least`` of
``word_margin`` of the distance of a text without any common word (by default, it
is just that margin).  Where ordinary documents reach beyond the margin, words
cannot tell such a text from a plain one, and the band is not judged by words.  The limit in character classes is likewise, and
``char_distance`` at least.  Bands with few documents of a language use those of
all languages; with few of any, words are not judged below ``sure_words`` words.
Texts below the minimum length are not judged by divergence at all.

References are the mean histograms of all documents of a language that pass the
base rules; its common words are the most frequent by document count over all
documents.  Both are sums of integers, so every run gives the same references.

Defined results: NULL, empty and gap-only texts have no words and fail the base
rule; rows with a NULL language take part in no reference but are judged like
others; without any labelled document only the base rules apply; repeated rows
are judged one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import GAP, GAP_CHARACTERS, ascii_lower

SYMBOLS = "#*$%&|<>"
WINDOW = 8
PUNCTUATION = ".,;:!?\"'()-"
SCALE = 1_000_000
#: Bins of a histogram of distances from 0 to 1.
BINS = 1000
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
VERDICT = f"struct<{BASE.replace(' ', ':').replace(',:', ',')},kept:boolean,char_distance:double,word_distance:double>"


@dataclass(frozen=True)
class Limits:
    """Distances up to which a document is kept, lengths from which it is judged, words per language."""

    char_distance: float = 0.3
    word_distance: float = 0.6
    word_margin: float = 0.95
    word_least: float = 1.0
    spread: float = 4.0
    bands: tuple[int, ...] = (100, 200, 400, 800, 1600)
    band_documents: int = 20
    sure_words: int = 200
    least_words: int = 50
    least_chars: int = 200
    common_words: int = 50


@dataclass(frozen=True)
class References:
    """Languages, the common words of all of them, and one row of class and word shares per language.

    ``usual_chars`` and ``usual_words``: per language and length band, how far ordinary documents at the band's lower
    edge are (NaN: too few to say).
    """

    languages: tuple[str, ...]
    words: tuple[bytes, ...]
    classes: np.ndarray
    shares: np.ndarray
    usual_chars: np.ndarray | None = None
    usual_words: np.ndarray | None = None


def _class_table() -> np.ndarray:
    """Character class of each byte of UTF-8; bytes inside a character have none (the last column)."""
    kinds = np.full(256, 7)
    for i in range(128):
        c = chr(i)
        if c.islower():
            kinds[i] = 0
        elif c.isupper():
            kinds[i] = 1
        elif c.isdigit():
            kinds[i] = 2
        elif c == "\n":
            kinds[i] = 3
        elif c in GAP_CHARACTERS:
            kinds[i] = 4
        elif c in PUNCTUATION:
            kinds[i] = 5
        else:
            kinds[i] = 6
    kinds[0x80:0xC0] = 8
    kinds[0xE0:] = 9  # characters of three or four bytes
    table = np.zeros((256, 10), dtype=np.int64)
    table[np.arange(256), kinds] = 1
    return np.delete(table, 8, axis=1)


CLASSES = _class_table()
_TO_GAP = bytes(0x20 if chr(i) in PUNCTUATION else i for i in range(256))
_MIX = np.random.default_rng(8).integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that occur twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    mixed = np.zeros(n, dtype=np.uint64)
    for j in range(WINDOW):
        mixed = (mixed ^ ids[j : j + n]) * _MIX[j]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[:n] += twice
    edges[WINDOW : WINDOW + n] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


def base_values(text: str | None) -> tuple[int, int, int, int, int, bool]:
    if not text:
        return 0, 0, 0, 0, 0, True
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    repeated = repeated_words(words)
    return (
        len(words),
        len(text) - sum(map(text.count, GAP_CHARACTERS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(words) < 20 or 100 * repeated > 30 * len(words),
    )


def histograms(text: str, slots: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, int]:
    """Shares of the character classes, and of the common words with all other words last; the number of words."""
    raw = text.encode()
    classes = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ CLASSES
    words = raw.lower().translate(_TO_GAP).split()
    rest = len(slots)
    found = np.fromiter((slots.get(w, rest) for w in words), dtype=np.int64, count=len(words))
    counts = np.bincount(found, minlength=rest + 1)
    return classes / max(1, classes.sum()), counts / max(1, len(words)), len(words)


def distances(share: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of one histogram to each reference."""
    middle = (share + references) / 2

    def divergence(p):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(p > 0, p * np.log2(p / middle), 0.0).sum(axis=1)

    both = (divergence(np.broadcast_to(share, references.shape)) + divergence(references)) / 2
    return np.sqrt(np.clip(both, 0.0, 1.0))


def band_of(words: int, limits: Limits) -> int:
    return sum(words >= edge for edge in limits.bands)


def _without_common_words(reference: References) -> np.ndarray:
    """Per language, the distance of a text without any common word."""
    without = np.zeros(len(reference.words) + 1)
    without[-1] = 1.0
    return distances(without, reference.shares)


def stretch(words: int, limits: Limits) -> float:
    """By what a text's word distance is multiplied to be as that of a text at the lower edge of its band.

    Noise in shares falls with the square root of the length; what does not is not stretched beyond one doubling.
    """
    edge = (limits.least_words, *limits.bands)[band_of(words, limits)]
    return float(np.sqrt(min(2.0, max(1.0, words / edge))))


def word_limits(reference: References, limits: Limits, stretched: float = 1.0, without: np.ndarray | None = None) -> np.ndarray:
    """Per language and length band, the distance in words up to which a text is close."""
    without = _without_common_words(reference) if without is None else without
    most = np.minimum(limits.word_distance, limits.word_margin * without)[:, None]
    least = limits.word_least * most
    usual = np.full((len(most), len(limits.bands) + 1), np.nan) if reference.usual_words is None else reference.usual_words / stretched
    return np.where(np.isnan(usual), most, np.clip(usual, least, most))


def words_judged(reference: References, limits: Limits, stretched: float = 1.0, without: np.ndarray | None = None) -> np.ndarray:
    """Per language and length band, whether words tell a plain text from one without common words."""
    without = _without_common_words(reference) if without is None else without
    most = np.minimum(limits.word_distance, limits.word_margin * without)[:, None]
    sure = np.array([edge >= limits.sure_words for edge in (0, *limits.bands)])[None, :]
    usual = np.full((len(most), len(limits.bands) + 1), np.nan) if reference.usual_words is None else reference.usual_words / stretched
    return np.where(np.isnan(usual), sure, usual <= most)


def char_limits(reference: References, limits: Limits) -> np.ndarray:
    usual = np.full((len(reference.languages), len(limits.bands) + 1), np.nan) if reference.usual_chars is None else reference.usual_chars
    return np.fmax(limits.char_distance, usual)


def usual_distances(rows: DataFrame, reference: References, limits: Limits) -> References:
    """The references with how far documents of each language and length band are from their own reference.

    Distances are counted in histograms of ``BINS`` bins per task, which add up exactly.
    """
    slots = {w: i for i, w in enumerate(reference.words)}
    at = {lang: i for i, lang in enumerate(reference.languages)}
    shape = (len(at), len(limits.bands) + 1, 2, BINS)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(shape, dtype=np.int64)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                if lang not in at or len(text) < limits.least_chars:
                    continue
                classes, shares, words = histograms(text, slots)
                if words < limits.least_words:
                    continue
                i, band = at[lang], band_of(words, limits)
                longer = stretch(words, limits)
                for kind, share, own, by in ((0, classes, reference.classes, 1.0), (1, shares, reference.shares, longer)):
                    counts[i, band, kind, min(BINS - 1, int(distances(share, own[i : i + 1])[0] * by * BINS))] += 1
        found = np.argwhere(counts)
        yield pd.DataFrame(found, columns=["lang", "band", "kind", "bin"]).assign(n=counts[tuple(found.T)])

    found = rows.mapInPandas(counted, "lang int, band int, kind int, bin int, n long")
    counts = np.zeros(shape, dtype=np.int64)
    for r in found.groupBy("lang", "band", "kind", "bin").agg(F.sum("n").alias("n")).collect():
        counts[r.lang, r.band, r.kind, r.bin] = r.n
    few = counts.sum(axis=3, keepdims=True) < limits.band_documents
    counts = np.where(few, counts.sum(axis=0, keepdims=True), counts)
    total = counts.sum(axis=3)
    running = counts.cumsum(axis=3)

    def quantile(share: float) -> np.ndarray:
        return (running < np.ceil(share * total)[..., None]).sum(axis=3) / BINS

    usual = quantile(0.5) + limits.spread * (quantile(0.5) - quantile(0.1)) + 1 / BINS
    usual = np.where(total < limits.band_documents, np.nan, usual)
    return replace(reference, usual_chars=usual[:, :, 0], usual_words=usual[:, :, 1])


def common_words(docs: DataFrame, limits: Limits, text: str = "text", language: str = "lang") -> list[tuple[str, str]]:
    """The words in most documents of each language: at most ``common_words`` rows a language."""
    gaps = F.translate(ascii_lower(F.col(f"`{text}`")), PUNCTUATION, " " * len(PUNCTUATION))
    pairs = docs.where(F.col(f"`{language}`").isNotNull()).select(
        F.col(f"`{language}`").alias("lang"), F.explode(F.array_distinct(F.split(gaps, GAP))).alias("word")
    )
    counts = pairs.where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "word"))
    rows = counts.withColumn("rank", rank).where(F.col("rank") <= limits.common_words)
    return [(r.lang, r.word) for r in rows.select("lang", "word").collect()]


def references(docs: DataFrame, limits: Limits, text: str = "text", language: str = "lang") -> References | None:
    """Mean histograms of each language over all its documents that pass the base rules."""
    words = tuple(sorted({w.encode() for _, w in common_words(docs, limits, text, language)}))
    slots = {w: i for i, w in enumerate(words)}

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, value in zip(batch["lang"], batch["text"]):
                if base_values(value)[-1]:
                    continue
                both = np.concatenate([[1.0], *histograms(value, slots)[:2]])
                sums[lang] = sums.get(lang, 0) + np.rint(both * SCALE).astype(np.int64)
        for lang, values in sums.items():
            yield pd.DataFrame({"lang": lang, "slot": np.arange(len(values)), "value": values})

    rows = docs.select(F.col(f"`{language}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    known = rows.where("lang is not null and text is not null")
    rows = known.mapInPandas(summed, "lang string, slot int, value long")
    totals = rows.groupBy("lang", "slot").agg(F.sum("value").alias("value")).orderBy("lang", "slot").collect()
    languages = tuple(dict.fromkeys(r.lang for r in totals))
    if not languages:
        return None
    sums = np.array([r.value for r in totals], dtype=np.float64).reshape(len(languages), -1)
    means = sums[:, 1:] / sums[:, :1]
    width = CLASSES.shape[1]
    found = References(languages, words, means[:, :width], means[:, width:])
    return usual_distances(known, found, limits)


def judge(reference: References | None, limits: Limits):
    """A pandas UDF from text to base values, verdict and the distances to the nearest language."""
    slots = {w: i for i, w in enumerate(reference.words)} if reference else {}
    if reference:
        most_chars, without = char_limits(reference, limits), _without_common_words(reference)

    @F.pandas_udf(VERDICT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            base = base_values(text)
            kept, char, word = not base[-1], None, None
            if reference and base[0] >= limits.least_words and len(text) >= limits.least_chars:
                classes, shares, n = histograms(text, slots)
                band = band_of(n, limits)
                chars = distances(classes, reference.classes)
                words = distances(shares, reference.shares)
                longer = stretch(n, limits)
                most, told = (f(reference, limits, longer, without)[:, band] for f in (word_limits, words_judged))
                beyond = np.where(told, words / np.maximum(most, 1e-9), 0.0)
                beyond = np.maximum(beyond, chars / most_chars[:, band])
                near = np.argmin(beyond)
                char, word = float(chars[near]), float(words[near])
                kept = kept and bool(beyond[near] <= 1.0)
            out.append((*base, kept, char, word))
        return pd.DataFrame(out, columns=[*(c.split()[0] for c in BASE.split(", ")), "kept", "char_distance", "word_distance"])

    return verdict


def judged(docs: DataFrame, limits: Limits | None = None, text: str = "text", language: str = "lang") -> DataFrame:
    """The documents with a private column ``__quality``: base values, verdict and distances."""
    limits = limits or Limits()
    found = references(docs, limits, text, language)
    return docs.withColumn("__quality", judge(found, limits)(F.col(f"`{text}`")))


def kept(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    """The documents that pass, columns as given."""
    return judged(docs, limits).where("__quality.kept").drop("__quality")


def report(docs: DataFrame, limits: Limits | None = None) -> DataFrame:
    return judged(docs.select("doc_id", "lang", "text"), limits).select("doc_id", "__quality.*")
