"""The quality classifier: held-out accuracy and defined cases."""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from duskline.llm import classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = classifier.fit(docs, labels)
    got = classifier.classify(docs, model, carry=["doc_id"]).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    test = [r for r in got if r["held_out"]]
    assert len(test) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in test]) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)


def test_held_out_labels_are_not_learned_from(spark):
    docs = spark.createDataFrame([(i, "good plain words" if i % 2 else "### $$$") for i in range(40)], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 0).otherwise((F.col("doc_id") % 2).cast("int")).alias("quality"))
    a = classifier.fit(docs, labels)
    b = classifier.fit(docs, labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1).otherwise(F.col("quality"))))
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.bias, b.bias)


def test_scorer_equals_the_model():
    model = classifier.train(["good words here", "bad ### bad ### bad ### bad"], [1, 0], epochs=3)
    scorer = classifier._Scorer(*model.weights())
    for text in ("", None, "good", "bad ### words", "x y z x y z x y z", "same same same", "é" * 3000):
        buckets, counts = classifier.features(text)
        mean = counts @ model.vectors[buckets] / max(counts.sum(), 1) if len(buckets) else np.zeros(classifier.DIMENSIONS)
        margin = mean @ model.output + model.bias
        assert scorer.margin(text) == pytest.approx(margin[1] - margin[0])


def test_nulls_repeats_clashes_and_no_labels(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", None), (3, "w " * 100_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Score string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = classifier.classify(docs, classifier.fit(docs, none)).collect()
    assert len(out) == 5 and {r["score"] for r in out} == {0.5} and not next(r for r in out if r["doc_id"] is None)["held_out"]
    null = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert classifier.classify(docs.limit(0), classifier.fit(docs, null)).collect() == []
