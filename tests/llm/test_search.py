"""Ranked search against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from duskline.llm import search
from duskline.llm.common import ascii_terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, most):
    """``(item_id, rank, doc_id, score)`` by scoring every document for every item."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    total, words = len(bags), sum(sum(b.values()) for _, b in bags)
    holding = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 50 + (50 * sum(b.values()) * total) // words
            s = 0
            for t in set(terms(text)):
                if t in b:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * holding[t] + 1)))
                    s += w * ((1_000_000_000 * b[t]) // (1000 * b[t] + 20 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, n, None if null else i, -s) for n, (s, null, i) in enumerate(sorted(scores)[:most], 1)]
    return out


def plain(rows):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=repr)


@pytest.mark.parametrize("text", ["", None, "Ab-cd_é9 X\x00y\x7fz ÀB", "...", "日本 a日b", "a b", "Ⅷ İi"])
def test_terms(text):
    assert [t.decode() for t in ascii_terms(text)] == terms(text)


@pytest.mark.parametrize("top", [1, 127, 128, 20_000, 1 << 40])
def test_packing_round_trip(top):
    rng = np.random.default_rng(top % 97)
    values = np.concatenate([rng.integers(0, top, 300), [0, top - 1]])
    flat, sizes = search.packed(values)
    assert search.unpacked(flat.tobytes()).tolist() == values.tolist()
    assert sizes.sum() == len(flat)
    assert search.unpacked(b"").tolist() == []


def corpus(seed, rows, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    odds = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(words, odds, k=rng.choice([1, 3, 8, 40, 200])))) for i in range(rows)], rng, words


def test_search_equals_brute_force(spark, monkeypatch):
    """Several shards, blocks and windows, with ties, and items searched in several parts."""
    monkeypatch.setattr(search, "ASKED_TERMS", 40)
    docs, rng, words = corpus(3, 3000)
    docs += [(10_000 + i, docs[i % 7][1]) for i in range(300)]  # equal scores
    items = [(i, " ".join(rng.sample(words, 6))) for i in range(15)] + [(90, docs[5][1]), (91, "nowhere"), (92, "w0 W0 w0")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = search.search(frame, spark.createDataFrame(items, "item_id long, text string"), most=20)
    assert plain(got.collect()) == sorted(brute(docs, items, 20), key=repr)


def test_blocks_are_skipped_without_loss():
    """A shard by itself: lists longer than a block, of which some blocks stay packed."""
    docs, rng, words = corpus(11, 6000)
    docs = [(i, t) for i, t in docs] + [(6000 + i, "rare " + "w1 w2 w3 " * 4) for i in range(60)]
    shard = search._Shard(0, None)
    for i, t in docs:
        shard.add(i, t)
    head, body = shard.rows()
    body = body.to_pandas()
    lengths = np.frombuffer(head.column(8)[0].as_py(), np.int64)
    total, words_all = len(lengths), int(lengths.sum())
    lists = {}
    for term, x in body.groupby("term", sort=False):
        w = search.weight(total, int(x["size"].sum()))
        lists[term] = search._List(w, lengths, (total, words_all), x["first"].to_numpy(), x["last"].to_numpy(),
                                   x["peaks"].tolist(), x["docs"].tolist(), x["tfs"].tolist())
    for one in lists.values():  # a block's maximum is never below one of its documents
        for b in range(len(one.docs)):
            assert one.block(b)[1].max() <= one.best[b] <= one.bound
        one.open.clear()
    asked = ["rare", "w0", "w1", "w4"]
    got, scores = search.best_of_shard([lists[t.encode()] for t in asked], total, 10)
    want = brute(docs, [(0, " ".join(asked))], 10)
    assert list(zip(got.tolist(), scores.tolist())) == [(i, s) for _, _, i, s in want]
    common = lists[b"w0"]
    assert len(common.open) < len(common.docs)


def test_small_shards_and_the_whole_index(spark, monkeypatch):
    docs, _, _ = corpus(5, 400)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, "w3 w9 w20"), (2, "w0")], "item_id long, text string")
    monkeypatch.setattr(search, "MOST_TERMS", 2)  # more terms than that: the index holds all
    assert plain(search.search(frame, items).collect()) == sorted(brute(docs, [(1, "w3 w9 w20"), (2, "w0")], 50), key=repr)
    shard = search._Shard(0, {b"w3": None})
    monkeypatch.setattr(search, "SHARD_ROWS", 2)
    shard.add(1, "w3 w4")
    assert not shard.full()
    shard.add(2, "...")
    assert not shard.full()
    shard.add(3, "w4")
    assert shard.full()


def test_nulls_repeats_clashes_and_empty_tables(spark):
    docs = [(None, "alpha beta"), (1, "alpha"), (1, "alpha"), (2, None), (3, ""), (4, "-- ..."), (5, "gamma " * 100_000), (6, "beta é")]
    items = [(7, "Alpha!"), (7, "Alpha!"), (None, "é"), (8, None), (9, ""), (10, "gamma")]
    wide = "doc_id long, text string, score string, `rank` int, `a.b` int"
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], wide)
    asked = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, terms int")
    got = search.search(frame, asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert plain(got.collect()) == sorted(brute(docs, items, 50), key=repr)
    assert search.search(frame.limit(0), asked).collect() == []
    assert search.search(frame, asked.limit(0)).collect() == []
    assert search.search(frame.filter("doc_id = 4"), asked).collect() == []
