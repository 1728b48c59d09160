"""Toxicity: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.llm.common import ascii_terms, bounded_batches, staged, text_of, without

# Learned from at most this many labelled rows, none longer than LONGEST code points,
# chosen by a hash of their id: the only bound, and one of the fit alone. All is scored.
SAMPLE = 6000
LONGEST = 50_000
# Hashed terms that enter the model: in at least LEAST_ROWS learned rows and LEAST_SHARE of
# them (copies of one long text share rare words), with a log-likelihood ratio between the
# classes of at least LEAST_RATIO; of these the MOST_TERMS highest.
LEAST_ROWS = 2
LEAST_SHARE = 0.002
LEAST_RATIO = 8.0
MOST_TERMS = 20_000
# Word beginnings (in bytes) that are terms of their own.
BEGINNINGS = (4, 5, 6, 7, 8, 9)
FACTORS = 8
EPOCHS = 12
RATE = 0.3
# Steps of factors are this much shorter, and factors shrink more: there is one pair term
# for each two of the terms of a text, so noise in them adds up.
FACTOR_RATE = 0.3
SHRINK = 1e-3
FACTOR_SHRINK = 1e-2
CACHED_WORDS = 500_000
SEED = 42
RESULT = ("held_out", "score", "predicted")


def hashed_terms(word: bytes) -> list[int]:
    """64-bit hashes of a word and of its beginnings."""
    marked = [b"=" + word, *[b"<" + word[:n] for n in BEGINNINGS if n <= len(word)]]
    return [xxhash.xxh64_intdigest(m, SEED) for m in marked]


def features(text: str | None) -> np.ndarray:
    """The distinct hashed terms of a whole text, as signed longs."""
    found = {h for w in set(ascii_terms(text)) for h in hashed_terms(w)}
    return np.fromiter(found, np.uint64, len(found)).view(np.int64)


@dataclass
class FactorizationMachine:
    """A bias, a weight per term, and factors whose products weigh the pairs of terms."""

    terms: np.ndarray  # sorted hashes
    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def margin(self, at: np.ndarray) -> float:
        """Of the terms at these places: bias + weights + products of all pairs of factors."""
        f = self.factors[at]
        total = f.sum(axis=0)
        return float(self.bias + self.weights[at].sum() + 0.5 * (total @ total - (f * f).sum()))


def train(terms: np.ndarray, places: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, rate: float = RATE,
          seed: int = 1) -> FactorizationMachine:
    """Stochastic gradient descent on the logistic loss with a step per parameter, over rows of places in ``terms``."""
    target = np.asarray(labels, dtype=np.float64)
    ones, zeros = int(target.sum()), int(len(target) - target.sum())
    if not ones or not zeros:  # nothing to tell apart
        bias = 0.0 if not len(target) else float(np.log((ones + 0.5) / (zeros + 0.5)))
        return FactorizationMachine(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, FACTORS)), bias)
    rng = np.random.default_rng(seed)
    w, v, bias = np.zeros(len(terms)), rng.normal(0, 0.02, (len(terms), FACTORS)), float(np.log(ones / zeros))
    gw, gv, gb = np.full(len(terms), 1e-6), np.full((len(terms), FACTORS), 1e-6), 1e-6
    model = FactorizationMachine(terms, w, v, bias)
    for _ in range(epochs):
        for i in rng.permutation(len(places)):
            p = places[i]
            wrong = 1 / (1 + np.exp(-np.clip(model.margin(p), -30, 30))) - target[i]
            gb += wrong * wrong
            model.bias -= rate * wrong / np.sqrt(gb)
            if not len(p):
                continue
            f = v[p]
            down = wrong * (f.sum(axis=0) - f) + FACTOR_SHRINK * f
            slope = wrong + SHRINK * w[p]
            gw[p] += slope * slope
            gv[p] += down * down
            w[p] -= rate * slope / np.sqrt(gw[p])
            v[p] -= FACTOR_RATE * rate * down / np.sqrt(gv[p])
    return model


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def _likelihood_ratio(ones: int, zeros: int) -> Column:
    """How far (G squared) the rows of each class with and without a term (``one``, ``zero``) depart from chance."""
    total, held = float(ones + zeros), F.col("one") + F.col("zero")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (
        part(F.col("one"), held * ones / total) + part(F.col("zero"), held * zeros / total)
        + part(ones - F.col("one"), (total - held) * ones / total) + part(zeros - F.col("zero"), (total - held) * zeros / total)
    )


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE) -> FactorizationMachine:
    """Learn from at most ``sample`` labelled rows that are not held out.

    Terms are counted and chosen where the rows are; the driver gets the chosen ones, at
    most ``MOST_TERMS``, and their places in the sample. Rows with a null id or label do not
    count, nor texts over ``LONGEST``. Without a row of each class the score is the same for
    all texts. Repeated rows are learned as often as they stand, up to ``sample``.
    """
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("__id"), F.col(label_col).alias("__label")
    )
    # Bounded by the parameter, hence the broadcast.
    chosen = F.broadcast(known.orderBy(F.xxhash64("__id"), "__id", "__label").limit(sample))

    @F.pandas_udf("array<long>")
    def bag(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([np.sort(features(t)) for t in batch])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("__id"), text_of(text_col).alias("__text")).filter(F.length("__text") <= LONGEST)
    bags = rows.join(chosen, "__id").select(F.col("__id").alias("id"), F.col("__label").alias("label"), bag("__text").alias("bag"))
    bags = staged(bags.withColumn("row", F.monotonically_increasing_id()), "toxicity-bags")
    # Ids may repeat: the first rows by narrow keys, which also order the learning.
    keys = bags.select("row", F.xxhash64("id").alias("by"), F.col("id").alias("of"), F.xxhash64("bag").alias("sum"))
    first = F.broadcast(keys.orderBy("by", "of", "sum", "row").limit(sample))
    bags = bags.join(first, "row")
    sizes = bags.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("label"), F.lit(0)).alias("ones")).first()
    ones, zeros = int(sizes["ones"]), int(sizes["rows"] - sizes["ones"])
    if not ones or not zeros:
        return train(np.zeros(0, np.int64), [], [0] * zeros + [1] * ones)
    single = bags.select("row", "label", F.explode("bag").alias("term"))
    counts = single.groupBy("term").agg(F.sum("label").alias("one"), F.sum(1 - F.col("label")).alias("zero"))
    counts = counts.filter(F.col("one") + F.col("zero") >= max(LEAST_ROWS, LEAST_SHARE * (ones + zeros)))
    counts = counts.withColumn("ratio", _likelihood_ratio(ones, zeros)).filter(F.col("ratio") >= LEAST_RATIO)
    terms = np.sort(counts.orderBy(F.desc("ratio"), "term").limit(MOST_TERMS).select("term").toPandas()["term"].to_numpy(np.int64))
    numbered = docs.sparkSession.createDataFrame(pd.DataFrame({"term": terms, "place": np.arange(len(terms))}), "term long, place long")
    held = single.join(F.broadcast(numbered), "term").groupBy("row").agg(F.array_sort(F.collect_list("place")).alias("places"))
    got = bags.select("row", "label", "by", "of", "sum").join(held, "row", "left").orderBy("by", "of", "label", "sum", "row")
    got = got.select("label", "places").collect()
    return train(terms, [np.array(r["places"] or [], np.int64) for r in got], [r["label"] for r in got])


class _Scorer:
    """Scores texts; the places of a word's terms in the model are looked up once and kept."""

    def __init__(self, model: FactorizationMachine) -> None:
        self.model = model
        self.place = {t: i for i, t in enumerate(model.terms.view(np.uint64).tolist())}
        self.known: dict[bytes, tuple[int, ...]] = {}

    def places(self, text: str | None) -> np.ndarray:
        known, place, found = self.known, self.place, set()
        for word in set(ascii_terms(text)):
            at = known.get(word)
            if at is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                at = known[word] = tuple(place[h] for h in hashed_terms(word) if h in place)
            if at:
                found.update(at)
        return np.array(sorted(found), np.int64)

    def margin(self, text: str | None) -> float:
        return self.model.margin(self.places(text))


def classify(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text",
             carry: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (probability of class 1) and ``predicted``, one row per input row.

    A term counts once, however often it stands in a text and however long the text is:
    a few words decide, and a pair of terms that is worse than both alone (an insult
    and the mention of a group) adds the product of its factors. Scoring is one
    pass without a shuffle over whole texts; the model, at most ``MOST_TERMS`` terms with
    their weights and factors (two megabytes), goes to the tasks.

    Only the text is an input. Null and empty texts, and texts without a term the model
    knows, score by the bias alone. A null id is not held out. ``carry`` names the
    input columns to keep (all by default); one named like a result column is
    replaced. Repeated rows score alike.
    """
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = _Scorer(model)
        for texts in batches:
            margins = np.array([scorer.margin(t) for t in texts], dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(margins, -60, 60))))

    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    got = docs.select(*[F.col(f"`{c}`") for c in wanted], F.col(f"`{id_col}`").alias("__id"), score(F.col(f"`{text_col}`")).alias("score"))
    got = got.withColumn("held_out", held_out("__id")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return without(got, "__id")
