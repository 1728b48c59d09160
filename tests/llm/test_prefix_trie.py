"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from zlib import crc32

import pytest

from duskline.llm import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"


def sequences(rows):
    """Turns of each conversation, in the operator's order."""
    def place(r):
        _, turn, role, text = r
        role, text = role or "", text or ""
        digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
        return turn is not None, turn or 0, role, digest

    found = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            found[r[0]].append(r)
    return {c: [(r[2] or "", r[3] or "") for r in sorted(x, key=place)] for c, x in found.items()}


def borrow(found):
    out = {}
    for c, own in found.items():
        h = crc32(str(c).encode()) % 9
        out[c] = found.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(found):
    members = defaultdict(list)
    for c, turns in found.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, m in members.items():
        size = len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(m) - 1) * size
    out = []
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(found[c]) == len(path)))
        out.append((min(m), len(path), min(members[path[:-1]]) if path else None, len(m), children[path], leaves[path], saved[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def plain(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def corpus(seed, convs, longest):
    """Conversations that share beginnings, copies, and one that is long."""
    rng = random.Random(seed)
    rows, stock = [], [[(rng.choice(["user", "assistant", None]), rng.choice(["", "é", "a b", None, "x" * 50])) for _ in range(longest)] for _ in range(3)]
    for c in rng.sample(range(3 * convs), convs):
        base = rng.choice(stock)[: rng.randrange(longest if c % 7 == 0 else 10)]
        turns = base + [("user", f"own {rng.randrange(3)}")] * rng.randrange(3)
        rows += [(c, 10 * t, r, x) for t, (r, x) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_equals_brute_force(spark, monkeypatch, band):
    """Several levels of bands, and digests of several pieces."""
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    rows = corpus(band, 60, 30)
    frame = spark.createDataFrame(rows, TURNS).repartition(5)
    assert plain(prefix_trie.conversation_trie(frame)) == brute(sequences(rows))
    if band == 3:
        assert plain(prefix_trie.rebuilt_trie(frame)) == brute(borrow(sequences(rows)))


def test_one_conversation_over_many_ranges(spark):
    """A conversation that holds most rows is numbered over all ranges it spans."""
    rows = [(7, t, "user", f"t{t % 5}") for t in range(600)] + [(c, 0, "user", "t0") for c in range(20, 40)]
    got = prefix_trie.numbered_turns(spark.createDataFrame(rows, TURNS).repartition(8)).filter("conv = 7")
    assert sorted(r["pos"] for r in got.collect()) == list(range(1, 601))
    assert plain(prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS))) == brute(sequences(rows))


def test_nulls_ties_repeats_clashes_and_empty_tables(spark):
    rows = [
        (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (1, 1, "", "b"), (1, 1, "assistant", "b"),
        (None, 0, "user", "lost"), (2, None, None, None), (2, 0, "user", "a"), (3, 0, None, "x" * 200_000), (5, 0, "user", "a"), (6, 3, "u", "q"),
    ]
    frame = spark.createDataFrame([(*r, 9, "y") for r in rows], f"{TURNS}, depth int, `n_convs` string")
    got = prefix_trie.conversation_trie(frame)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert plain(got) == brute(sequences(rows))
    assert plain(prefix_trie.rebuilt_trie(frame)) == brute(borrow(sequences(rows)))
    assert prefix_trie.conversation_trie(frame.limit(0)).collect() == []
    assert prefix_trie.rebuilt_trie(frame.limit(0)).collect() == []


def test_role_and_text_do_not_run_into_each_other(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc")]
    got = prefix_trie.conversation_trie(spark.createDataFrame(rows, TURNS))
    assert got.filter("depth = 1").count() == 3
