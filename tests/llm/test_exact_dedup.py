"""Exact dedup against a dictionary."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import types as T

from duskline.llm import exact_dedup

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("Keep_ID", T.StringType())])


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("slots", [1 << 15, exact_dedup.SLOTS])
def test_groups(spark, slots):
    rng = random.Random(1)
    texts = ["a b", "a  b", "a\tb", " a b", "A b", "", None, " ", "x" * 100_000, *[f"text {i}" for i in range(300)]]
    rows = [(i, rng.choice(texts), "clash") for i in range(900)] + [(1000 + i, "hot", None) for i in range(500)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS), slots=slots)
    assert "Keep_ID" not in got.columns
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append(i)
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        ids = groups[norm(r["text"])]
        want = (min(ids), len(ids), r["doc_id"] == min(ids), hashlib.sha256(norm(r["text"]).encode()).hexdigest())
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == want


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "t", None), (4, "t", None), (4, "t", None), (None, "u", None), (None, "u", None)]
    out = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r["keep_id"], r["group_size"]) for r in out if r["text"] == "t"] == [(4, 3)] * 3
    assert sum(r["kept"] for r in out if r["text"] == "t") == 1
    assert [r["keep_id"] for r in out if r["text"] == "u"] == [None, None] and sum(r["kept"] for r in out if r["text"] == "u") == 1


def test_kept_rows_have_their_own_columns(spark):
    rows = [(1, "t", "x"), (2, "t", "y")]
    out = exact_dedup.kept_rows(spark.createDataFrame(rows, "doc_id long, text string, extra string"))
    assert out.columns == ["doc_id", "text", "extra"] and [tuple(r) for r in out.collect()] == [(1, "t", "x")]


def test_empty_table(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], DOCS)).collect() == []


def test_only_suspects_are_shuffled(spark):
    rows = [(i, f"single {i}", None) for i in range(3000)] + [(9000 + i, "twice", None) for i in range(2)]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, DOCS))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and got.filter("group_size > 1").count() == 2
