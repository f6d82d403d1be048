"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed character pairs and triples, weighted by TF-IDF and
normalised.  Each language has a few centroids from spherical k-means over a
bounded sample of labelled rows; a text gets the language of the centroid with
the highest cosine, and is marked ``rejected`` if it lies farther from it than
nearly all training texts of that centroid.

Defined results: NULL texts and texts without a letter are ``und`` with score 0;
NULL labels are not learned from; without any labelled row every text is
``und``; repeated rows are predicted one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.storage import stored

UNKNOWN = "und"
BLOCK = 1 << 20
PREDICTION = T.StructType().add("lang_pred", "string").add("score", "double").add("rejected", "boolean")


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows learned from per language, about; drawn by a hash of id and text."""

    slots: int = 4096
    sample: int = 2000
    centroids: int = 4
    rounds: int = 10
    radius_share: float = 0.995
    radius_slack: float = 1.1


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    centroids: np.ndarray
    radii: np.ndarray
    idf: np.ndarray


def _letters() -> np.ndarray:
    table = np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)
    return np.append(table, True)


_LETTER = _letters()


def gram_counts(text: str, slots: int) -> np.ndarray:
    """Counts of hashed pairs and triples of letters, with anything else as one space."""
    counts = np.zeros(slots, dtype=np.int64)
    for at in range(0, len(text), BLOCK):
        points = np.frombuffer(f" {text[at : at + BLOCK].lower()} ".encode("utf-32-le"), dtype="<u4").astype(np.uint64)
        points = np.where(_LETTER[np.minimum(points, 0x10000)], points, np.uint64(32))
        points = points[np.append(True, (points[1:] != 32) | (points[:-1] != 32))]
        pairs = points[:-1] * np.uint64(0x9E3779B97F4A7C15) + points[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        triples = pairs[:-1] * np.uint64(0x165667B19E3779F9) + points[2:] * np.uint64(0x27D4EB2F165667C5)
        for grams in (pairs, triples):
            mixed = (grams ^ (grams >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((mixed >> np.uint64(33)) % np.uint64(slots), minlength=slots)
    return counts


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF rows."""
    out = np.array([gram_counts(t, len(idf)) for t in texts], dtype=np.float32)
    out = np.log1p(out) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def clustered(rows: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of unit rows by spherical k-means, started from far-apart rows, and their radii."""
    chosen = [int(np.argmax(rows @ rows.mean(axis=0)))]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < min(settings.centroids, len(rows)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centres = rows[chosen]
    for _ in range(settings.rounds):
        own = np.argmax(rows @ centres.T, axis=1)
        sums = np.array([rows[own == k].sum(axis=0) if (own == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    cosines = rows @ centres.T
    own = np.argmax(cosines, axis=1)
    far = [1 - cosines[own == k, k] if (own == k).any() else np.zeros(1) for k in range(len(centres))]
    return centres, np.array([np.quantile(f, settings.radius_share) * settings.radius_slack for f in far])


def has_letter(text: Column) -> Column:
    return text.rlike(r"\p{L}")


def fit(labelled: DataFrame, settings: Settings | None = None, paths: list[str] | None = None) -> Model | None:
    """Learn from rows (key, text, lang); None if there is nothing to learn from."""
    settings = settings or Settings()
    paths = [] if paths is None else paths
    rows = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select("key", "text", "lang")
    counts = rows.groupBy("lang").agg((F.lit(float(settings.sample)) / F.count(F.lit(1))).alias("share"))
    rows = rows.withColumn("draw", F.xxhash64("key", "text"))
    rows = rows.join(F.broadcast(counts), "lang").where(F.pmod("draw", F.lit(1 << 30)) < F.col("share") * (1 << 30))
    slots = settings.slots

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [gram_counts(t, slots) for t in batch["text"]]
            at = [np.flatnonzero(f) for f in found]
            yield pd.DataFrame({"lang": batch["lang"], "draw": batch["draw"], "slots": at, "counts": [f[a] for f, a in zip(found, at)]})

    sample = stored(rows.mapInPandas(sparse, "lang string, draw long, slots array<long>, counts array<long>"), paths)
    total = sample.count()
    if not total:
        return None
    idf = np.full(slots, np.log(1.0 + total), dtype=np.float32)
    for slot, n in sample.select(F.explode("slots").alias("slot")).groupBy("slot").count().collect():
        idf[slot] = np.log((1.0 + total) / (1.0 + n)) + 1.0

    def centres(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("draw")
        dense = np.zeros((len(group), slots), dtype=np.float32)
        for row, at, counts in zip(dense, group["slots"], group["counts"]):
            row[at] = counts
        dense = np.log1p(dense) * idf
        dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
        found, radii = clustered(dense, settings)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": list(found.astype(np.float32)), "radius": radii})

    found = sample.groupBy("lang").applyInPandas(centres, "lang string, centroid array<float>, radius double")
    found = found.orderBy("lang", "radius").collect()
    return Model(
        tuple(r.lang for r in found), np.array([r.centroid for r in found], dtype=np.float32), np.array([r.radius for r in found]), idf
    )


def predictor(model: Model | None, at_once: int = 256):
    """A pandas UDF from text (NULL: not to be judged) to language, score and whether it is rejected."""

    @F.pandas_udf(PREDICTION)
    def predict(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": UNKNOWN, "score": 0.0, "rejected": False}, index=range(len(texts)))
        there = [i for i, t in enumerate(texts) if t is not None] if model else []
        for start in range(0, len(there), at_once):
            part = there[start : start + at_once]
            cosines = vectors([texts.iloc[i] for i in part], model.idf) @ model.centroids.T
            best = np.argmax(cosines, axis=1)
            score = np.clip(cosines[np.arange(len(part)), best], 0.0, 1.0).astype(float)
            out.loc[part, "lang_pred"] = [model.languages[b] for b in best]
            out.loc[part, "score"] = score
            out.loc[part, "rejected"] = 1 - score > model.radii[best]
        return out

    return predict


def identified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The documents with a private column ``__language``: lang_pred, score, rejected."""
    column = F.col(f"`{text}`")
    return docs.withColumn("__language", predictor(model)(F.when(has_letter(column), column)))


def report(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Predict every document; learn from the labelled ones outside the held-out fifth."""
    rows = docs.select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0
    rows = rows.withColumn("held_out", held_out)
    model = fit(rows.where(~F.col("held_out")).withColumnRenamed("doc_id", "key"), settings)
    return identified(rows.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "__language.*")
