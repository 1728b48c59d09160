"""Quality rules: counts against brute force, fences against sorted values."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskline.llm import quality_rules

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("N_words", T.StringType()),
])
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    under = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(under))


def bucket(x):
    drop = max(len(bin(x)) - 2 - quality_rules.BITS, 0)
    return x >> drop << drop


def texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    out = ["", None, " \n\t", "one", "a b c a b c", "x\n\nx\nx ", "é# |<>\x0b&", "a a a a a", "long " * 30_000]
    for _ in range(60):
        line = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 8))]
        out.append("\n".join(line + line[: rng.randrange(3)]))
    out += ["### ".join(rng.choice(vocabulary) for _ in range(120)) for _ in range(3)]
    return out


def test_counts_and_verdicts(spark):
    rows = [(i, t, ["en", None][i % 2], ["s", None, "t"][i % 3], "clash") for i, t in enumerate(texts())]
    got = quality_rules.quality_rules(spark.createDataFrame(rows, DOCS), prior=5)
    assert "N_words" not in got.columns
    out = {r["doc_id"]: r for r in got.collect()}
    assert len(out) == len(rows)
    groups = {}
    for i, t, lang, source, _ in rows:
        want = brute(t)
        r = out[i]
        assert tuple(r[c] for c in quality_rules.BASE) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        if not r["base_failed"]:
            for key in ((lang, source), (lang,), ()):
                groups.setdefault(key, []).append(r)
    for i, _, lang, source, _ in rows:
        r = out[i]
        if r["base_failed"]:
            assert not r["kept"]
            continue
        failed = []
        for rule, (low, high, factor, floor) in quality_rules.FENCES.items():
            def share(b, keys=((lang, source), (lang,), ())):
                values = [bucket(x[rule]) for x in groups[keys[0]]]
                below = sum(v <= b for v in values)
                return (below + 5 * share(b, keys[1:])) / (len(values) + 5) if keys[1:] else below / len(values)

            edges = sorted({bucket(x[rule]) for x in groups[()]})
            low, high = (next(b for b in edges if share(b) >= q) for q in (low, high))
            if r[rule] > high + max(factor * (high - low), floor):
                failed.append(rule)
        assert r["failed"] == failed and r["kept"] == (not failed)
    assert any(r["failed"] == ["symbols"] for r in out.values())


def test_margins_follow_the_group(spark):
    """The same share of repeated words is plain in a group that has it often and an outlier in one that has not."""
    rng = random.Random(3)

    def text(twice):
        words = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        return " ".join(words[: 200 - twice] + words[:twice])

    rows = [(i, text(40 if i % 5 == 0 else 0), "en", "echo", None) for i in range(300)]
    rows += [(1000 + i, text(1 if i % 9 == 0 else 0), "en", "plain", None) for i in range(300)]
    rows += [(9000, text(45), "en", "plain", None), (9001, text(45), "en", "echo", None)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS), prior=20).collect()}
    assert got[9000]["failed"] == ["repeats"] and got[9001]["kept"]
    assert sum(not r["kept"] for r in got.values()) == 1


def test_bucket(spark):
    values = [0, 1, 63, 127, 128, 129, 255, 256, 1000, 123_456, (1 << 40) + 12345]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    assert [r["b"] for r in frame.select(quality_rules.bucket(F.col("v")).alias("b")).collect()] == list(map(bucket, values))


def test_empty_table(spark):
    assert quality_rules.quality_rules(spark.createDataFrame([], DOCS)).collect() == []
