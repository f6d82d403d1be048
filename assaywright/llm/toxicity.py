"""Toxicity by subword bags: averaged n-gram embeddings into a linear softmax, trained jointly.

A word is the bag of itself and its character 3- to 5-grams, each hashed to an
embedding.  A window of words is the average over the subwords of its distinct
words, and a linear layer with a softmax over two classes reads it.  A text is
scored by its most toxic window, so that one insult in a long text counts, and a
misspelling or an unseen ending shares most n-grams with what was learned.

Embeddings and the linear layer are trained together, in numpy, by one task over
a bounded sample of labelled texts, of which a fifth is set aside.  First every window has its text's label;
then, of toxic texts, only windows that the model takes for toxic (and the best
one), and of clean texts the worst ones and some drawn at random.  The worst of
many windows is worse than one window, so the log odds of whole texts are put
right at the end, by a logistic fit on the texts set aside.

The average is linear, so what scoring needs of the model is one number per
subword: the difference of the two classes' weights on its embedding.

Defined results: NULL and empty texts, and texts of punctuation only, have no
subwords and get the score of the bias; labels that are NULL or without an id
are not learned from; an id labelled more than once is toxic if one label says
so, and one of the texts of an id that stands in several rows is learned from;
without labels of both classes every score is 0; repeated rows are scored one by one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import release, stored
from .common import word_blocks

PUNCTUATION = ".,;:!?\"'()[]"
#: Longer words are read in pieces of this many bytes, as text without gaps would be one word.
PIECE = 96
_MANY_WORDS = 300_000
#: Every so many sampled texts one is not trained on.
ASIDE = 5


@dataclass(frozen=True)
class Settings:
    """``toxic`` and ``clean``: labelled texts learned from, about; ``drawn``: windows of a text learned from, at most."""

    toxic: int = 2000
    clean: int = 4000
    drawn: int = 256
    bits: int = 18
    width: int = 16
    window: int = 12
    least_subwords: int = 64
    rounds: int = 7
    first_rounds: int = 2
    rate: float = 0.1
    kept_subwords: float = 0.7
    limit: float = 0.7


@dataclass(frozen=True)
class Model:
    """One number per subword slot and the bias: the log odds of a window are their average plus the bias."""

    weights: np.ndarray
    bias: float
    settings: Settings


# -- words and subwords ----------------------------------------------------------------


def words_of(text: str) -> Iterator[list[bytes]]:
    """Lower-case words in blocks of bounded size; over-long words in pieces."""
    for block in word_blocks(text.lower().encode("utf-8", "replace"), 1 << 20):
        if not any(len(w) > PIECE for w in block):
            yield block
            continue
        part: list[bytes] = []
        for word in block:
            for at in range(0, len(word), PIECE):
                part.append(word[at : at + PIECE])
                if len(part) >= 1 << 16:
                    yield part
                    part = []
        yield part


def subwords(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the subwords of each word, one after another, and how many each word has."""
    shown = [w.decode("utf-8", "ignore").strip(PUNCTUATION) for w in words]
    marked = [f"<{w}>" if w else "" for w in shown]
    lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(marked)), lengths)
    there = np.flatnonzero(lengths)
    whole = np.fromiter((zlib.crc32(marked[i].encode("utf-8", "replace")) for i in there), dtype=np.uint64, count=len(there))
    slots, owners = [whole * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)], [there]
    mixed = points * np.uint64(0x9E3779B97F4A7C15)
    for n in range(2, 6):
        mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = mixed + points[n - 1 :] * np.uint64(0x94D049BB133111EB)
        if n > 2 and len(mixed):
            inside = word[: len(mixed)] == word[n - 1 :]
            hashed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)
            slots.append(hashed[inside])
            owners.append(word[: len(mixed)][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(slots)[order].astype(np.int64), np.bincount(owner, minlength=len(marked))


def windows(ids: np.ndarray, window: int) -> np.ndarray:
    """Rows of ``window`` word numbers, half overlapping, over all words; what repeats in a row or is missing is 0."""
    step = window // 2
    count = max(1, -(-(len(ids) - step) // step))
    padded = np.zeros((count - 1) * step + window, dtype=np.int64)
    padded[: len(ids)] = ids
    rows = np.sort(np.lib.stride_tricks.sliding_window_view(padded, window)[::step], axis=1)
    rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = 0
    return rows


# -- training ---------------------------------------------------------------------------


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of several spans, one after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _first_per_text(text: np.ndarray, key: np.ndarray, most: int) -> np.ndarray:
    """Windows with the ``most`` largest keys of each text."""
    order = np.lexsort((-key, text))
    starts = np.flatnonzero(np.append(True, np.diff(text[order]) != 0))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


class Trainer:
    """Embeddings, linear layer and bias, moved by gradients scaled with their own history."""

    def __init__(self, rows: np.ndarray, text: np.ndarray, toxic: np.ndarray, words: list[bytes], settings: Settings):
        self.settings, self.text, self.toxic = settings, text, toxic[text]
        self.rows = rows
        self.slots, self.counts = subwords(words, settings.bits)
        self.starts = np.cumsum(self.counts) - self.counts
        self.sizes = np.maximum(self.counts[rows].sum(axis=1), settings.least_subwords)
        self.draw = np.random.default_rng(12)
        self.embedding = (self.draw.normal(size=(1 << settings.bits, settings.width)) * 0.1).astype(np.float32)
        self.layer = (self.draw.normal(size=(settings.width, 2)) * 0.1).astype(np.float32)
        self.bias = np.zeros(2, dtype=np.float32)
        self.seen = [np.full(shape, 1e-6, dtype=np.float32) for shape in (1 << settings.bits, (settings.width, 2), 2)]

    def weights(self) -> np.ndarray:
        return self.embedding @ (self.layer[:, 1] - self.layer[:, 0])

    def log_odds(self) -> np.ndarray:
        """Of every window, with all subwords."""
        per_word = np.bincount(np.repeat(np.arange(len(self.counts)), self.counts), self.weights()[self.slots], len(self.counts))
        return per_word[self.rows].sum(axis=1) / self.sizes + self.bias[1] - self.bias[0]

    def chosen(self, round_: int) -> np.ndarray:
        """The windows that a round learns from."""
        drawn = self.draw.random(len(self.rows))
        clean = ~self.toxic
        learned = self.text % ASIDE != ASIDE - 1
        if round_ < self.settings.first_rounds:
            some = _first_per_text(self.text, drawn, 16)
            found = np.concatenate([np.flatnonzero(self.toxic), some[clean[some]]])
            return found[learned[found]]
        odds = self.log_odds()
        best, worst, some = (_first_per_text(self.text, key, most) for key, most in ((odds, 1), (odds, 3), (drawn, 4)))
        toxic = np.union1d(np.flatnonzero(self.toxic & (odds >= 0)), best[self.toxic[best]])
        found = np.concatenate([toxic, np.union1d(worst[clean[worst]], some[clean[some]])])
        return found[learned[found]]

    def step(self, at: np.ndarray) -> None:
        words = self.rows[at]
        own = self.counts[words]
        slots = self.slots[_spans(self.starts[words.ravel()], own.ravel())]
        window = np.repeat(np.arange(len(at)), own.sum(axis=1))
        kept = self.draw.random(len(slots)) < self.settings.kept_subwords
        slots, window = slots[kept], window[kept]
        if not len(slots):
            return
        size = np.maximum(np.bincount(window, minlength=len(at)), self.settings.least_subwords)[:, None].astype(np.float32)
        bag = np.zeros((len(at), self.settings.width), dtype=np.float32)
        filled, starts = np.unique(window, return_index=True)
        bag[filled] = np.add.reduceat(self.embedding[slots], starts, axis=0)
        bag /= size
        odds = bag @ self.layer + self.bias
        share = np.exp(odds - odds.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        share[np.arange(len(at)), self.toxic[at].astype(int)] -= 1
        off = share / len(at)
        back = (off @ self.layer.T) / size
        order = np.argsort(slots, kind="stable")
        found, starts = np.unique(slots[order], return_index=True)
        moved = np.add.reduceat(back[window[order]], starts, axis=0)
        self.seen[0][found] += (moved**2).mean(axis=1)
        self.embedding[found] -= self.settings.rate * moved / np.sqrt(self.seen[0][found])[:, None]
        for value, seen, change in ((self.layer, self.seen[1], bag.T @ off), (self.bias, self.seen[2], off.sum(axis=0))):
            seen += change**2
            value -= self.settings.rate * change / np.sqrt(seen)

    def run(self) -> tuple[np.ndarray, float]:
        for round_ in range(self.settings.rounds):
            order = self.draw.permutation(self.chosen(round_))
            for at in range(0, len(order), 128):
                self.step(order[at : at + 128])
        return self.weights().astype(np.float32), float(self.bias[1] - self.bias[0])


def drawn_windows(text: str, settings: Settings) -> list[str]:
    """Windows of words over the whole text, at most ``drawn`` of them, drawn by the text itself."""
    step, found, at = settings.window // 2, [], 0
    draw = np.random.default_rng(zlib.crc32(text.encode("utf-8", "replace")))
    left: list[bytes] = []
    for block in words_of(text):
        left += block
        while len(left) > settings.window:
            at += 1
            place = len(found) if len(found) < settings.drawn else int(draw.integers(at))
            if place == len(found):
                found.append(left[: settings.window])
            elif place < settings.drawn:
                found[place] = left[: settings.window]
            del left[:step]
    found.append(left)
    return [b" ".join(w).decode("utf-8", "ignore") for w in found]


def calibrated(odds: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Factor and offset of log odds by logistic regression, held near 1 and 0 where there is little to learn from."""
    if len(set(toxic)) < 2:
        return 1.0, 0.0
    x = np.stack([odds, np.ones(len(odds))], axis=1)
    held, start = np.array([1.0, 0.1]), np.array([1.0, 0.0])
    value = start.copy()
    for _ in range(50):
        share = 1 / (1 + np.exp(-np.clip(x @ value, -30, 30)))
        slope = x.T @ (share - toxic) + held * (value - start)
        curve = (x * (share * (1 - share))[:, None]).T @ x + np.diag(held)
        value = value - np.clip(np.linalg.solve(curve, slope), -2, 2)
    return (float(value[0]), float(value[1])) if value[0] > 0 else (1.0, 0.0)


def trained(samples: pd.DataFrame, settings: Settings) -> tuple[np.ndarray, float]:
    """From rows (toxic, windows), in an order that does not depend on the run."""
    numbers: dict[bytes, int] = {b"": 0}
    rows, text = [], []
    for i, drawn in enumerate(samples["windows"]):
        for window in drawn:
            ids = [numbers.setdefault(w, len(numbers)) for w in window.encode("utf-8", "replace").split()]
            rows.append(windows(np.array(ids[: settings.window], dtype=np.int64), settings.window)[0])
            text.append(i)
    rows, text, toxic = np.array(rows), np.array(text), samples["toxic"].to_numpy(dtype=bool)
    trainer = Trainer(rows, text, toxic, list(numbers), settings)
    weights, bias = trainer.run()
    aside = text % ASIDE == ASIDE - 1
    worst = np.full(len(toxic), -np.inf)
    np.maximum.at(worst, text[aside], trainer.log_odds()[aside])
    told = np.isfinite(worst)
    factor, offset = calibrated(worst[told], toxic[told])
    return (weights * factor).astype(np.float32), bias * factor + offset


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, paths: list[str] | None = None) -> Model | None:
    """Learn from documents (doc_id, text) and labels (doc_id, toxic); None without labels of both classes."""
    settings = settings or Settings()
    paths = [] if paths is None else paths
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic") > 0).alias("toxic"))
    known = stored(known, paths)
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    share = F.when(F.col("toxic"), F.lit(settings.toxic / counts[True])).otherwise(F.lit(settings.clean / counts[False]))
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share * (1 << 30))
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").where("text is not null")
    texts = texts.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("draw"), "text")).alias("one"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(windows=[drawn_windows(t, settings) for t in batch["text"]])[["doc_id", "toxic", "windows"]]

    rows = texts.select("doc_id", "toxic", "one.text").mapInPandas(cut, "doc_id long, toxic boolean, windows array<string>")
    sample = stored(rows, paths)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*batches, pd.DataFrame({"doc_id": [], "toxic": [], "windows": []})])
        rows = rows.sort_values("doc_id", kind="stable").reset_index(drop=True)
        if rows["toxic"].nunique() == 2:
            weights, bias = trained(rows, settings)
            yield pd.DataFrame({"weights": [weights.astype("<f4").tobytes()], "bias": [bias]})

    made = sample.coalesce(1).mapInPandas(train, "weights binary, bias double").collect()
    return Model(np.frombuffer(made[0].weights, dtype="<f4"), made[0].bias, settings) if made else None


# -- scoring ----------------------------------------------------------------------------


class Scorer:
    """Scores texts in a task; sums per word are kept for words seen before, up to a bounded number."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {b"": 0}
        self.sums, self.counts = np.zeros(1), np.zeros(1)

    def learn(self, words: list[bytes]) -> None:
        fresh = list(dict.fromkeys(w for w in words if w not in self.numbers))
        if not fresh:
            return
        slots, counts = subwords(fresh, self.model.settings.bits)
        sums = np.bincount(np.repeat(np.arange(len(fresh)), counts), self.model.weights[slots], len(fresh))
        self.numbers.update(zip(fresh, range(len(self.sums), len(self.sums) + len(fresh))))
        self.sums, self.counts = np.append(self.sums, sums), np.append(self.counts, counts)

    def log_odds(self, text: str) -> float:
        settings, most, left = self.model.settings, None, np.zeros(0, dtype=np.int64)
        for block in words_of(text):
            ids = np.concatenate([left, np.fromiter(map(self.numbers.__getitem__, block), dtype=np.int64, count=len(block))])
            rows = windows(ids, settings.window)
            size = np.maximum(self.counts[rows].sum(axis=1), settings.least_subwords)
            top = float((self.sums[rows].sum(axis=1) / size).max())
            most = top if most is None else max(most, top)
            left = ids[max(0, len(ids) - settings.window + 1) :]
        return (most or 0.0) + self.model.bias

    def scores(self, texts: list[str | None]) -> list[float]:
        out = []
        for at in range(0, len(texts), 256):
            part = [t or "" for t in texts[at : at + 256]]
            if len(self.numbers) > _MANY_WORDS:
                self.forget()
            fresh: set[bytes] = set()
            for text in part:
                for block in words_of(text):
                    fresh.update(block)
            self.learn(sorted(fresh))
            out += [1 / (1 + np.exp(-np.clip(self.log_odds(t), -500, 500))) for t in part]
        return out


def score(model: Model | None):
    """A pandas UDF from text to the probability that it is toxic."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model) if model else None
        for texts in batches:
            yield pd.Series(scorer.scores(list(texts)) if scorer else np.zeros(len(texts)))

    return scored


def held_out(doc_id: Column) -> Column:
    """A third of the ids; a NULL id counts as empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def report(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Score every document; labels of the held-out third are not learned from."""
    settings = settings or Settings()
    paths: list[str] = []
    rows = docs.select("doc_id", "text").withColumn("held_out", held_out(F.col("doc_id")))
    told = labels.select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    model = fit(rows.where(~F.col("held_out")), told, settings, paths)
    release(docs.sparkSession, paths)
    scored = rows.select("doc_id", "held_out", score(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= settings.limit).cast("int"))
