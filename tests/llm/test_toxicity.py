"""The toxicity model: held-out accuracy, pair terms and defined cases."""

from __future__ import annotations

import random
from itertools import combinations
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskline.llm import toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels)
    got = toxicity.classify(docs, model, carry=["doc_id"]).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    test = [r for r in got if r["held_out"]]
    toxic, clean = [r for r in test if r["toxic"]], [r for r in test if not r["toxic"]]
    # Some 15 of the 144 toxic ones hold no word that is toxic elsewhere: junk took its place.
    assert len(toxic) > 100 and np.mean([r["predicted"] for r in toxic]) >= 0.82
    assert np.mean([r["predicted"] for r in clean]) <= 0.005
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def pairs(seed, rows):
    """Texts that are toxic only where an insult and a group stand together."""
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"w{rng.randrange(30)}" for _ in range(20)] + ["dreck"] * insult + ["badgers"] * group
        rng.shuffle(words)
        out.append((" ".join(words), int(insult and group)))
    return out


def learned(spark, rows):
    """A model of all rows: ids that are not held out."""
    ids = (i for i in range(10 * len(rows)) if crc32(str(i).encode()) % 3 != 1)
    frame = spark.createDataFrame([(i, *r) for i, r in zip(ids, rows)], "doc_id long, text string, toxic int")
    return toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"))


def test_pairs_of_terms_are_learned(spark):
    known, new = pairs(1, 600), pairs(2, 300)
    model = learned(spark, known)
    scorer = toxicity._Scorer(model)
    assert np.mean([(scorer.margin(t) > 0) == bool(y) for t, y in new]) >= 0.99
    both, one, other, none = (scorer.margin(t) for t in ("dreck badgers", "dreck", "badgers", "plain"))
    assert both > 0 > max(one, other, none)
    weights = model.weights[scorer.places("dreck badgers")].sum() + model.bias
    assert both - weights > 1  # the pairs' part


def test_margin_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(5)
    model = toxicity.FactorizationMachine(np.arange(12), rng.normal(size=12), rng.normal(size=(12, 3)), 0.3)
    at = np.array([0, 3, 4, 9])
    want = 0.3 + model.weights[at].sum() + sum(model.factors[i] @ model.factors[j] for i, j in combinations(at, 2))
    assert model.margin(at) == pytest.approx(want)


def test_a_few_words_decide_in_a_long_text(spark):
    rng = random.Random(3)
    rows = [(" ".join(f"w{rng.randrange(400)}" for _ in range(60)) + " scum" * (i % 5 == 0), int(i % 5 == 0)) for i in range(400)]
    scorer = toxicity._Scorer(learned(spark, rows))
    text = " ".join(f"z{i}" for i in range(60_000))
    assert scorer.margin(text) < 0 < scorer.margin(text + ". SCUM!")


def test_held_out_labels_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, "good plain words" if i % 2 else "scum trash") for i in range(40)], "doc_id long, text string")
    out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    labels = docs.select("doc_id", F.when(out, 0).otherwise((F.col("doc_id") % 2).cast("int")).alias("toxic"))
    a = toxicity.fit(docs, labels)
    b = toxicity.fit(docs, labels.withColumn("toxic", F.when(out, 1).otherwise(F.col("toxic"))))
    assert len(a.terms) and np.array_equal(a.terms, b.terms) and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_nulls_repeats_clashes_and_no_labels(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", None), (3, "w " * 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Score string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    out = toxicity.classify(docs, toxicity.fit(docs, none)).collect()
    assert len(out) == 5 and {r["score"] for r in out} == {0.5} and not next(r for r in out if r["doc_id"] is None)["held_out"]
    null = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.classify(docs.limit(0), toxicity.fit(docs, null)).collect() == []
    one = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "doc_id long, toxic int")
    assert all(r["score"] < 0.5 for r in toxicity.classify(docs, toxicity.fit(docs, one)).collect())
