"""Removal of repeats against a scan of all strings."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import types as T

from duskline.llm import suffix_dedup
from duskline.llm.suffix_dedup import cut_out, intervals, repeat_groups, suffix_array, super_strings, window_hashes

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("N_bytes", T.StringType())])


def brute(texts, length):
    """(kept, removed, runs) of each text, in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            part = data[s : s + length]
            if part in seen:
                gone[s : s + length] = [True] * length
            seen.add(part)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((bytes(b for b, g in zip(data, gone) if not g), sum(gone), runs))
    return out


def test_window_hashes():
    data = np.random.default_rng(1).integers(0, 3, 400).astype(np.uint8)
    for width in (1, 2, 3, 4, 7, 20, 100):
        h = window_hashes(data, width, np.uint64(0x9E3779B97F4A7C15))
        parts = [data[i : i + width].tobytes() for i in range(len(data) - width + 1)]
        assert len(h) == len(parts) and len(set(zip(parts, h.tolist()))) == len(set(parts)) == len(set(h.tolist()))


def test_equal_strings_lie_in_stretches_with_equal_anchors():
    rng = random.Random(4)
    shared = bytes(rng.randrange(97, 123) for _ in range(300))
    found = []
    for _ in range(2):
        data = bytes(rng.randrange(97, 123) for _ in range(rng.randrange(50, 200))) + shared + bytes(rng.randrange(97, 123) for _ in range(80))
        h, c, starts, counts = super_strings(np.frombuffer(data, np.uint8))
        assert starts.tolist() == (np.cumsum(counts) - counts).tolist() and counts.sum() == len(data) - 99
        anchor = np.repeat(h, counts)
        at = data.index(shared)
        found.append((anchor[at : at + 201].tolist(), set(c.tolist())))
    assert found[0][0] == found[1][0] and found[0][1] & found[1][1]


@pytest.mark.parametrize("seed", range(10))
def test_interval_tree(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("ab") for _ in range(8)) for _ in range(40)]
    strings = np.frombuffer("".join(words).encode(), np.uint8).reshape(-1, 8)
    order, common = suffix_array(strings)
    ranked = [words[i] for i in order]
    assert ranked == sorted(words)
    nodes = set(intervals(common, 3))
    want = set()
    for i in range(40):
        for j in range(i + 1, 40):
            depth = next((k for k in range(8) if ranked[i][k] != ranked[j][k]), 8)
            if depth >= 3:
                inside = [k for k in range(40) if ranked[k][:depth] == ranked[i][:depth]]
                want.add((depth, inside[0], inside[-1]))
    assert nodes == want


def test_groups_name_all_occurrences_and_their_left_side():
    passage = bytes(range(50, 160))
    context = [b"x" + passage, b"y" + passage, b"x" + passage]
    groups = list(repeat_groups(context, np.array([12, 12, 12]), np.array([-1, 7, 9])))
    deep = [g for g in groups if set(g[3].tolist()) == {1}]
    assert len(deep) == 1 and deep[0][1] and sorted(deep[0][2].tolist()) == [0, 1, 2]
    inside = [g for g in groups if set(g[3].tolist()) == {5}]
    assert len(inside) == 1 and not inside[0][1] and len(inside[0][2]) == 3


def test_cut_out():
    assert cut_out(b"abcdefgh", [(1, 3), (2, 4), (4, 5), (7, 8)]) == (b"afg", 5, 2)
    assert cut_out(b"abc", []) == (b"abc", 0, 0)
    assert cut_out(b"abc", [(0, 3)]) == (b"", 3, 1)


@pytest.mark.parametrize("seed, length, gram", [(1, 100, 20), (2, 100, 20), (3, 12, 4), (4, 12, 5), (5, 30, 20)])
def test_against_all_strings(spark, seed, length, gram):
    rng = random.Random(seed)

    def letters(n, alphabet="abcdefgh é"):
        return "".join(rng.choice(alphabet) for _ in range(n))

    passages = [letters(rng.randrange(length // 2, 4 * length)) for _ in range(6)]
    texts = []
    for _ in range(60):
        text = ""
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            if rng.random() < 0.3:
                a = rng.randrange(len(p))
                p = p[:a] + letters(1) + p[a + 1 :]
            text += p[rng.randrange(20) :] + letters(rng.randrange(30))
        texts.append(text)
    texts += ["a" * (3 * length), "ab" * (2 * length), None, "", texts[3], texts[3], letters(length), letters(length - 1)]
    rows = [(i, t, "clash") for i, t in enumerate(texts)]
    order = list(rows)
    rng.shuffle(order)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(order, DOCS).repartition(3), length=length, gram=gram)
    assert "N_bytes" not in got.columns
    out = {r["doc_id"]: (bytes(r["kept_bytes"]), r["n_removed"], r["n_spans"]) for r in got.collect()}
    assert [out[i] for i in range(len(rows))] == brute(texts, length)


def test_null_and_equal_ids(spark):
    text = "".join(chr(97 + k * k % 26) + str(k) for k in range(100))
    rows = [(None, text, None), (5, text, None), (5, text, None)]
    out = suffix_dedup.remove_repeats(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"] or -1, r["n_removed"] == 0) for r in out) == [(-1, False), (5, False), (5, True)]
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []
