"""Line dedup against all pairs of equal lines."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from duskline.llm import line_dedup

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("N_Lines", T.StringType())])


def brute(rows, least):
    """Removed line places per row: the maximal common run of every pair of equal lines."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    lines = {}
    for k in order:
        lines[k] = [(pos, x, len(x.split())) for pos, x in enumerate((rows[k][1] or "").split("\n")) if x.split()]
    rank = {k: i for i, k in enumerate(order)}
    gone = {k: set() for k in order}
    for k in order:
        for q in order:
            if rank[q] > rank[k]:
                continue
            a, b = lines[k], lines[q]
            for i in range(len(a)):
                for j in range(len(b)):
                    if (q == k and j >= i) or a[i][1] != b[j][1] or (i and j and a[i - 1][1] == b[j - 1][1]):
                        continue
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n][1] == b[j + n][1]:
                        n += 1
                    if sum(x[2] for x in a[i : i + n]) >= least:
                        gone[k].update(x[0] for x in a[i : i + n])
        for this, after in zip(lines[k], lines[k][1:]):
            if this[0] in gone[k] and after[0] in gone[k]:
                gone[k].update(range(this[0], after[0]))
    return gone


@pytest.mark.parametrize("seed, least", [(1, 6), (2, 12), (3, 1), (4, 30)])
def test_against_all_pairs(spark, seed, least):
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(9)}" for _ in range(rng.choice([1, 1, 2, 5]))) for _ in range(12)] + ["", " "]
    runs = [[rng.choice(pool) for _ in range(rng.randrange(2, 12))] for _ in range(5)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(rng.randrange(4)):
            text += rng.choice(runs) if rng.random() < 0.6 else [rng.choice(pool) + f" own{i}"]
        rows.append((i, "\n".join(text), "clash"))
    rows += [(None, "\n".join(runs[0]), None), (3, rows[3][1], None), (90, None, None), (91, "", None)]
    frame = spark.createDataFrame([(i, t, c) for i, t, c in rows], DOCS).coalesce(1)
    got = line_dedup.line_dedup(frame, least_words=least)
    assert "N_Lines" not in got.columns
    want = brute(rows, least)
    expect = []
    for k, (i, t, _) in enumerate(rows):
        lines = (t or "").split("\n")
        rest = "\n".join(x for pos, x in enumerate(lines) if pos not in want[k])
        expect.append((i, None if t is None else rest, len(lines), len(want[k])))
    out = [(r["doc_id"], r["text"], r["n_lines"], r["n_removed_lines"]) for r in got.collect()]
    assert sorted(out, key=str) == sorted(expect, key=str)
    if least < 30:
        assert any(r[3] for r in expect)


def test_long_texts_and_hot_lines(spark):
    passage = "\n".join(f"line {k} of the passage" for k in range(400))
    rows = [(i, f"start {i}\n{passage}\nend {i}", None) for i in range(60)] + [(100 + i, f"plain {i}\nAll rights reserved.", None) for i in range(60)]
    out = {r["doc_id"]: r for r in line_dedup.line_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[0]["text"] == rows[0][1] and out[0]["removed_runs"] == []
    for i in range(1, 60):
        assert out[i]["text"] == f"start {i}\nend {i}" and [tuple(x) for x in out[i]["removed_runs"]] == [(1, 400)]
    assert all(out[100 + i]["n_removed_lines"] == 0 for i in range(60))


def test_own_columns_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a", "x")], "doc_id long, text string, extra string")
    assert line_dedup.shortened_rows(frame).columns == ["doc_id", "text", "extra"]
    assert line_dedup.line_dedup(spark.createDataFrame([], DOCS)).collect() == []
    assert line_dedup.line_dedup(spark.createDataFrame([(1, None, None), (2, " \n ", None)], DOCS)).count() == 2
