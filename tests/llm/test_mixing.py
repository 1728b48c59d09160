"""Mixing against a plain computation of targets and rates."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import types as T

from duskline.llm import mixing

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("Target", T.StringType()),
])


def goals(sizes, weights=(5, 2, 1)):
    """Targets by resharing the excess until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, out = float(sum(sizes.values())), set(), {}
    while True:
        rest = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return out | share
        for s in over:
            full.add(s)
            out[s] = 3.0 * sizes[s]
            left -= out[s]


def rate(sizes, target):
    """The tilt by bisection."""
    mean = sum(sizes) / len(sizes)
    low, high = -700.0, 700.0
    for _ in range(200):
        mid = (low + high) / 2
        if sum(s * min(3, math.exp(min(50, mid * s / mean))) for s in sizes) < target:
            low = mid
        else:
            high = mid
    return {s: min(3, math.exp(min(50, low * s / mean))) for s in set(sizes)}


def corpus(seed=2):
    rng = random.Random(seed)
    rows = []
    for source, n in (("a", 700), ("b", 60), ("c", 20), (None, 40), ("d", 3), ("e", 500)):
        for _ in range(n):
            words = max(1, int(rng.lognormvariate(4, 0.8)))
            rows.append((len(rows), " ".join(["w"] * words), source, "clash"))
    rows += [(len(rows), None, "a", None), (len(rows) + 1, "", "b", None), (len(rows) + 2, " \x0b\n", None, None), (None, "one two", "c", None), (7, "again here", "c", None)]
    return rows


def test_targets_rates_and_words_taken(spark):
    rows = corpus()
    got = mixing.mix(spark.createDataFrame(rows, DOCS))
    assert "Target" not in got.columns
    out = got.collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes.setdefault(r[2], []).append(len((r[1] or "").split()))
    want = goals({s: sum(v) for s, v in sizes.items()})
    taken = {}
    for r in out:
        s = r["source"]
        assert r["size"] == len((r["text"] or "").split()) and r["source_size"] == sum(sizes[s])
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    rates = {s: rate(v, want[s]) for s, v in sizes.items() if want[s] < 3 * sum(v) * 0.999}
    for r in out:
        if r["source"] in rates and r["size"]:
            assert r["rate"] == pytest.approx(rates[r["source"]][r["size"]], rel=1e-3)
            assert abs(r["copies"] - r["rate"]) < 1
    for s, v in sizes.items():
        assert abs(taken[s] - want[s]) <= max(v) / 2 * (1 + len(v) // mixing.BLOCK) + 1


def test_reruns_and_row_order_do_not_matter(spark):
    rows = corpus(3)
    a = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(3)).select("doc_id", "size", "taken").collect()
    random.Random(1).shuffle(rows)
    b = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(5)).select("doc_id", "size", "taken").collect()
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_mixed_rows_repeat_documents(spark):
    rows = corpus(4)
    frame = spark.createDataFrame(rows, DOCS)
    copies = sum(r["copies"] for r in mixing.mix(frame).collect())
    got = mixing.mixed_rows(frame.drop("Target"))
    assert got.columns == ["doc_id", "text", "source"] and got.count() == copies


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (2, "", "a", None)], [(1, "a b", "s", None)]])
def test_nothing_to_mix(spark, rows):
    out = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows) and all(r["taken"] == r["size"] for r in out)
