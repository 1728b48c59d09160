"""Quality classifier on supervised subword embeddings."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskline.llm.common import bounded_batches, text_of, without

BUCKETS = 1 << 17
DIMENSIONS = 16
GRAMS = (3, 4, 5)
EPOCHS = 4
FEATURES = 50.0
RATE = 0.3
# Labels are softened by this much, which keeps margins, and so scores, apart.
SOFT = 0.02
# At most this many labelled rows are learned from, none longer than LONGEST code
# points, so that the sample has a bound in rows and in size. They are chosen by a
# hash of their id. Everything is scored.
SAMPLE = 3000
LONGEST = 50_000
# A 3-word window seen before in the text, and a word equal to the one before it,
# count as this many features each: one such token stands beside some fifteen
# subwords of its word.
REPEAT_WEIGHT = 15
_REPEATED, _ECHO = crc32(b"\0window") % BUCKETS, crc32(b"\0echo") % BUCKETS
CACHED_WORDS = 1_000_000
RESULT = ("held_out", "score", "predicted")


def subwords(word: bytes) -> list[int]:
    """Buckets of the word itself and of its character n-grams, with marks at both ends."""
    marked = b"<" + word + b">"
    grams = [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return [crc32(b"\0word" + word) % BUCKETS, *[crc32(g) % BUCKETS for g in grams]]


def repeats(words: list[bytes]) -> tuple[int, int]:
    """How many 3-word windows were seen before, and how many words repeat the one before."""
    windows = len(words) - 2
    again = windows - len(set(zip(words, words[1:], words[2:]))) if windows > 0 else 0
    return again, sum(map(eq, words, words[1:]))


@dataclass
class SubwordModel:
    """Vectors of the buckets, averaged per document, and a softmax over two classes."""

    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def weights(self) -> tuple[np.ndarray, float]:
        """Each bucket's share in the margin of class 1 over class 0; averages and the output are both linear."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float64), float(self.bias[1] - self.bias[0])


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and how often each counts."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    counts: Counter[int] = Counter()
    for word, n in Counter(words).items():
        for bucket in subwords(word):
            counts[bucket] += n
    again, echo = repeats(words)
    if again:
        counts[_REPEATED] += REPEAT_WEIGHT * again
    if echo:
        counts[_ECHO] += REPEAT_WEIGHT * echo
    return np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), np.float64, len(counts))


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, rate: float = RATE, seed: int = 1) -> SubwordModel:
    """Stochastic gradient descent over single documents, with a rate that falls to zero."""
    rng = np.random.default_rng(seed)
    model = SubwordModel(
        rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)), np.zeros((DIMENSIONS, 2)), np.zeros(2)
    )
    bags = [features(t) for t in texts]
    target = np.abs(np.eye(2)[np.asarray(labels, dtype=np.int64)] - SOFT)
    steps, done = max(1, epochs * len(bags)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)):
            buckets, counts = bags[i]
            step = rate * (1 - done / steps)
            done += 1
            share = counts / max(counts.sum(), 1.0)
            mean = share @ model.vectors[buckets] if len(buckets) else np.zeros(DIMENSIONS)
            margin = mean @ model.output + model.bias
            odds = np.exp(margin - margin.max())
            wrong = odds / odds.sum() - target[i]
            down = model.output @ wrong
            model.output -= step * np.outer(mean, wrong)
            model.bias -= step * 0.1 * wrong
            if len(buckets):
                # A feature's share in a text is small; its vector learns by the step times FEATURES.
                model.vectors[buckets] -= step * np.outer(share * FEATURES, down)
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> SubwordModel:
    """Learn from at most ``sample`` labelled rows with remainder other than 2."""
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("__id"), F.col(label_col).alias("__label")
    )
    # Bounded by the parameter, hence the broadcast.
    chosen = F.broadcast(known.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), text_of(text_col).alias("__text")).filter(F.length("__text") <= LONGEST)
    got = rows.join(chosen, "__id").select("__id", "__text", "__label").collect()
    got.sort(key=lambda r: (crc32(str(r["__id"]).encode()), r["__id"], r["__label"], r["__text"]))
    got = got[:sample]  # ids may repeat
    return train([r["__text"] for r in got], [r["__label"] for r in got])


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 4 == 2, F.lit(False))


class _Scorer:
    """Scores texts; the summed weights of a word are worked out once and kept."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights, bias
        self.known: dict[bytes, tuple[float, int]] = {}

    def margin(self, text: str | None) -> float:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        if not words:
            return self.bias
        total, size = 0.0, 0
        known = self.known
        for word, n in Counter(words).items():
            got = known.get(word)
            if got is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                at = subwords(word)
                got = known[word] = (float(self.weights[at].sum()), len(at))
            total += n * got[0]
            size += n * got[1]
        again, echo = repeats(words)
        total += REPEAT_WEIGHT * (again * self.weights[_REPEATED] + echo * self.weights[_ECHO])
        size += REPEAT_WEIGHT * (again + echo)
        return float(total / size + self.bias)


def classify(docs: DataFrame, model: SubwordModel, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None,
             threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (probability of class 1) and ``predicted``, one row per input row.

    Scoring is one pass without a shuffle. The model goes to the tasks as one weight
    per bucket, a fixed megabyte. Only the text is an input of the score; a null or
    empty text scores by the bias alone. A null id is not held out. ``carry`` names
    the input columns to keep (all by default); one named like a result column is
    replaced. Repeated rows score alike.
    """
    weights, bias = model.weights()
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(weights, bias)
        for texts in batches:
            margins = np.array([scorer.margin(t) for t in texts], dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(margins, -60, 60))))

    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    got = docs.select(*[F.col(f"`{c}`") for c in wanted], F.col(f"`{id_col}`").alias("__id"), score(F.col(f"`{text_col}`")).alias("score"))
    got = got.withColumn("held_out", held_out("__id")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return without(got, "__id")
