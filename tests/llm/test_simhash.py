"""SimHash near-dedup against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskline.llm import simhash
from duskline.llm.common import components

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def brute(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    k = min(shingle, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + k]).encode(), seed=42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def joined(prints):
    """Smallest reachable fingerprint by comparing all pairs."""
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one two", "A b C d e f", "a b c " * 40, "Ünï ÀB\x0bcd\x1ce", "x" * 5000])
@pytest.mark.parametrize("shingle", [3, 5])
def test_fingerprint(text, shingle):
    assert simhash.fingerprint(text, shingle) == brute(text, shingle)


def test_null_text_has_fingerprint_zero():
    assert simhash.fingerprint(None, 3) == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_no_link_is_missed_and_none_is_wrong(spark):
    rng = random.Random(7)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.add(base)
        for distance in (1, 2, 3, 3, 3, 4, 5):
            near = base
            for b in rng.sample(range(64), distance):
                near ^= 1 << b
            prints.add(near)
        block = rng.randrange(4) * 16  # all three bits in one block
        near = base
        for b in rng.sample(range(block, block + 16), 3):
            near ^= 1 << b
        prints.add(near)
    centre = rng.getrandbits(64)  # a crowd around one point
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(12)}
    frame = spark.createDataFrame([(signed(p),) for p in sorted(prints)], "fp long")
    links = simhash.near_fingerprints(frame)
    rows = [(r["a"], r["b"]) for r in links.collect()]
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 for a, b in rows)
    assert len(rows) < 40 * len(prints)
    got = {r["node"]: r["component"] for r in components(links, "test").collect()}
    want = joined(sorted(prints))
    groups = {}
    for p in prints:
        groups.setdefault(got.get(signed(p), signed(p)), set()).add(p)
    expected = {}
    for p in prints:
        expected.setdefault(want[p], set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_tables_do_not_meet(spark):
    """The links of three tables in one pass are those of each by itself."""
    rng = random.Random(11)
    rows = set()
    for _ in range(30):
        base = rng.getrandbits(64)
        for _ in range(6):
            near = base
            for b in rng.sample(range(64), rng.randrange(4)):
                near ^= 1 << b
            rows.add((rng.randrange(3), signed(near)))
    frame = spark.createDataFrame(sorted(rows), "table int, fp long").cache()
    got = simhash.near_fingerprints(frame, tables=True)
    assert got.columns == ["table", "a", "b"]
    want = {(t, r["a"], r["b"]) for t in range(3) for r in simhash.near_fingerprints(frame.filter(F.col("table") == t)).collect()}
    assert want and {tuple(r) for r in got.collect()} == want


def test_rows_with_nulls_ties_and_clashing_columns(spark):
    schema = T.StructType([*DOCS.fields, T.StructField("Kept", T.StringType()), T.StructField("fp", T.StringType())])
    rows = [(5, "a b c d", "x", "y"), (5, "a b c d", "x", "y"), (2, "a  b c D", None, None), (None, "a b c d", None, "z"),
            (7, None, None, None), (8, "", None, None), (None, "other words entirely", None, None)]
    got = simhash.simhash_groups(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["text"] in ("a b c d", "a  b c D")} == {2}
    assert {r["component_id"] for r in got if not r["text"]} == {7}
    assert {r["fingerprint"] for r in got if not r["text"]} == {"0" * 16}
    lone = next(r for r in got if r["text"] == "other words entirely")
    assert lone["component_id"] is None and lone["kept"]
    assert sum(r["kept"] for r in got) == 3


def test_empty_table(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], DOCS)).collect() == []
    assert simhash.near_copies(spark.createDataFrame([], DOCS)).collect() == []


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_near_copies_are_found_and_clean_texts_stay(spark):
    rng = random.Random(11)

    def word():
        return "".join(rng.choice("aeioubdgklmnrst") for _ in range(rng.randrange(2, 9)))

    common = [word() for _ in range(40)]
    rows, sources = [], []
    for k in range(60):
        base = [rng.choice(common) if rng.random() < 0.4 else word() for _ in range(rng.randrange(150, 500))]
        sources.append(base)
        rows.append((10 * k, " ".join(base)))
        for c in range(1, 4):
            copy = list(base)
            for _ in range(max(1, len(base) // 100)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((10 * k + c, "\n".join(copy)))
    rows += [(5000 + k, " ".join(rng.sample(base, len(base)))) for k, base in enumerate(sources[:20])]  # the same words, shuffled
    rows += [(6000, None), (6001, " \t"), (None, "lone text"), (6002, rows[0][1].upper())]
    frame = spark.createDataFrame(rows, DOCS)
    out = {r["doc_id"]: r for r in simhash.near_copies(frame).collect()}
    caught = [out[10 * k + c]["copy_of"] == 10 * k for k in range(60) for c in range(1, 4)]
    assert sum(caught) >= 0.9 * len(caught)
    text = dict(rows)
    for i, r in out.items():
        if i is not None and r["copy_of"] != i:
            group = [j for j, q in out.items() if j is not None and j != i and q["copy_of"] == r["copy_of"]]
            assert max(alike(text[i], text[j]) for j in group) >= 0.75
    assert all(out[5000 + k]["kept"] for k in range(20))
    assert out[6001]["copy_of"] == 6000 and out[None]["kept"] and out[6002]["copy_of"] == 0
    assert simhash.one_per_group(frame).columns == ["doc_id", "text"]


def test_equal_fingerprints_and_sketch(spark):
    key, prints, sketch, keys = simhash.signature("A b c d e f g")
    assert (key, prints, sketch, keys) == simhash.signature("a  B c\td e f g") and len(sketch) == 3
    assert len(set(keys)) == simhash.KEYS
    long = " ".join(str(i) for i in range(5000))
    assert len(simhash.signature(long)[2]) == simhash.SKETCH


def groups_of(rows, least=0.8):
    """Smallest reachable id by comparing all pairs of texts."""
    parts = [(i, shingles(t)) for i, t in rows]
    first = {i: i for i, _ in rows}
    for a, (i, x) in enumerate(parts):
        for j, y in parts[:a]:
            if len(x & y) >= least * len(x | y):
                old, new = max(first[i], first[j]), min(first[i], first[j])
                first = {k: new if v == old else v for k, v in first.items()}
    return first


def edited(rng, words, places):
    """``words`` with those at ``places`` changed."""
    out = list(words)
    for p in places:
        out[p] = f"x{rng.getrandbits(40):x}"
    return " ".join(out)


def test_copies_unlike_each_other_meet_their_original(spark):
    rng = random.Random(23)
    rows = []
    for start in (0, 100):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(260)]
        spread = [rng.sample(range(5, 255, 10), 5) for _ in range(60)]
        texts = [edited(rng, base, places) for places in spread]
        texts.insert(30, " ".join(base))  # the original is neither first nor last
        rows += [(start + k, t) for k, t in enumerate(texts)]
    want = groups_of(rows)
    assert set(want.values()) == {0, 100} and alike(rows[0][1], rows[1][1]) < 0.8
    out = {r["doc_id"]: r["copy_of"] for r in simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == want


def test_every_pair_at_the_limit_or_above_is_found(spark):
    """Scattered edits in texts of 50 to 250 words: word-set fingerprints lie too far apart for many."""
    rng = random.Random(31)
    rows = []
    for k in range(150):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(rng.randrange(50, 250))]
        most = round(len(base) * 0.2)
        rows.append((2 * k, " ".join(base)))
        rows.append((2 * k + 1, edited(rng, base, range(len(base) - rng.randrange(1, most), len(base)))))
    want = groups_of(rows)
    assert 50 < sum(want[i] != i for i in want) < 120
    out = {r["doc_id"]: r["copy_of"] for r in simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == want


def test_long_texts_are_compared_whole(spark):
    """Texts with more shingles than a sketch holds, similarities just under and just over the limit."""
    rng = random.Random(37)
    rows = []
    for k in range(60):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(1004)]  # 1,000 shingles
        n = 111 + (-1) ** k * rng.randrange(1, 5) - 4 * (k % 2)  # 111 changed make 0.8002, 112 make 0.7986
        rows.append((2 * k, " ".join(base)))
        rows.append((2 * k + 1, edited(rng, base, range(1004 - n, 1004))))
    want = groups_of(rows)
    assert 20 <= sum(want[i] != i for i in want) <= 40
    out = {r["doc_id"]: r["copy_of"] for r in simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == want


def test_the_one_pair_of_a_small_group_is_found(spark):
    """Fourteen texts unlike each other by the limit but for one pair: no text meets most others."""
    rng = random.Random(41)
    rows = []
    for k in range(40):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(200)]
        texts = [edited(rng, base, rng.sample(range(5, 195, 10), 6)).split() for _ in range(13)]
        texts.append(edited(rng, texts[5], range(161, 200)).split())
        texts[-1][:161] = texts[5][:161]
        rows += [(100 * k + i, " ".join(t)) for i, t in enumerate(texts)]
    want = groups_of(rows)
    out = {r["doc_id"]: r["copy_of"] for r in simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()}
    assert out == want


def test_hubs_of_all_turns_meet_in_one_row(spark):
    """The pairs are those of a plain choice per turn, and rows are not repeated per turn before the join."""
    rng = random.Random(43)
    rows = sorted({(rng.randrange(30), rng.randrange(80)) for _ in range(600)})
    meets = {n: sum(1 for _, m in rows if m == n) for n in range(80)}
    shared = spark.createDataFrame([(k, n, meets[n]) for k, n in rows], "key long, node long, meets long")
    member = spark.createDataFrame([(n, n // 2 * 2) for n in range(80)], "node long, part long")
    got = simhash._meetings(shared, member, [0])
    want = set()
    for key in range(30):
        best = {}
        for k, n in rows:
            if k == key:
                best[n // 2 * 2] = min(best.get(n // 2 * 2, (0, 0)), (-meets[n], n))
        by, hub, part = min((b, n, p) for p, (b, n) in best.items())
        want |= {(min(hub, n), max(hub, n)) for p, (_, n) in best.items() if p != part}
    assert {tuple(r) for r in got.collect()} == want
    plan = simhash._meetings(shared, member, list(range(8, 16)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join Inner") and plan.count("Generate") == 1
    apart = {tuple(r) for r in simhash._all_meetings(shared.select("key", "node"), member).collect()}
    assert apart == {(a, b) for k, a in rows for q, b in rows if k == q and a < b and a // 2 != b // 2}


def test_codes_leave_out_no_pair_that_is_alike():
    """Fewer least hashes differ between texts alike by 0.8 than a pair may have, and more between texts unlike each other."""
    rng = random.Random(47)
    most = simhash.most_unlike(0.8)

    def apart(x, y):
        a, b = (np.array(simhash.coded(t)[4]).reshape(simhash.PLANES, simhash.PLANE) for t in (x, y))
        return sum(int(v).bit_count() for v in np.bitwise_or.reduce(a ^ b, axis=0).view(np.uint64))

    for _ in range(100):
        base = [f"w{rng.getrandbits(40):x}" for _ in range(rng.randrange(50, 250))]
        n = (len(base) - 4) // 10
        near, far = (edited(rng, base, range(len(base) - k, len(base))) for k in (n, 6 * n))
        assert alike(" ".join(base), near) >= 0.8 and apart(" ".join(base), near) <= most
        assert alike(" ".join(base), far) < 0.4 and apart(" ".join(base), far) > most - 20
    assert apart("a b c", "A  b c") == 0 and simhash.coded(" ")[3:] == ([], []) and simhash.most_unlike(0) >= 160


def test_a_large_group_makes_no_pairs_of_its_own_in_later_rounds(spark, monkeypatch):
    """Copies of one text are one group after the first round: no pair of two of them is met again."""
    rng = random.Random(53)
    base = [f"w{rng.getrandbits(40):x}" for _ in range(200)]
    rows = [(k, edited(rng, base, rng.sample(range(200), 1))) for k in range(300)] + [(900, " ".join(base))]
    made = {}
    staged = simhash.staged

    def counted(df, label):
        made[label] = staged(df, label)
        return made[label]

    monkeypatch.setattr(simhash, "staged", counted)
    out = simhash.near_copies(spark.createDataFrame(rows, DOCS)).collect()
    assert {r["copy_of"] for r in out} == {0}
    assert 0 < made["copies-met-0"].count() < 16 * len(rows)
    assert sum(made[label].count() for label in made if label.startswith("copies-met-") and label != "copies-met-0") == 0


def test_keys_of_a_text_look_up_its_group_once(spark):
    """Exploded keys give the same pairs as a row per key, and codes leave out none that is close."""
    rng = random.Random(59)
    held = [(n, n % 7, [rng.randrange(20) for _ in range(6)], [rng.getrandbits(8)] * 9) for n in range(60)]
    frame = spark.createDataFrame(held, "node long, meets long, many array<long>, code array<long>")
    flat = frame.select("node", "meets", F.explode("many").alias("key"))
    member = spark.createDataFrame([(n, n // 3 * 3) for n in range(60)], "node long, part long")
    turns, key = [8, 9], F.explode("many").alias("key")
    code = {n: c for n, _, _, c in held}

    def close(pairs):
        return {(a, b) for a, b in pairs if sum(simhash_bits(code[a], code[b])) <= 15}

    def simhash_bits(a, b):
        return [((a[w] ^ b[w]) | (a[w + 3] ^ b[w + 3]) | (a[w + 6] ^ b[w + 6])).bit_count() for w in range(3)]

    for of, how in ((simhash._meetings, (turns,)), (simhash._all_meetings, ())):
        want = {tuple(r) for r in of(flat, member, *how).collect()}
        assert {tuple(r) for r in of(frame, member, *how, key).collect()} == want
        assert close(want) and {tuple(r) for r in of(frame, member, *how, key, 15).collect()} == close(want) != want


def test_only_pairs_that_remain_become_rows(spark):
    """Pairs of several turns and keys are one row, pairs with codes too far apart none."""
    rng = random.Random(61)
    keys, codes = list(range(12)), [[rng.getrandbits(60) for _ in range(9)] for _ in range(2)]
    held = [(n, 12, keys, codes[n % 2]) for n in range(24)]  # all texts under all keys, alike by halves
    frame = spark.createDataFrame(held, "node long, meets long, many array<long>, code array<long>")
    member = spark.createDataFrame([(n, n) for n in range(24)], "node long, part long")
    turns = list(range(8, 16))
    met = simhash._meetings(frame, member, turns, F.explode("many").alias("key"), 15)
    pairs = [tuple(r) for r in met.collect()]
    assert pairs and len(set(pairs)) == len(pairs) and all(a < b and (b - a) % 2 == 0 for a, b in pairs)
    made = rows_made(met, "Generate explode(pairs")
    assert len(pairs) <= made <= 24 * len(turns) and made < 2 * len(pairs)


def rows_made(df, node):
    """Rows out of the nodes of the executed plan that begin with ``node``."""
    found = []

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(plan.plan())
        if plan.simpleString(200).startswith(node):
            found.append(plan.metrics().apply("numOutputRows").value())
        for i in range(plan.children().length()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_a_fingerprint_is_shuffled_once_per_bucket(spark):
    """68 rows a fingerprint reach the first shuffle; its 196 variants are made after it, in the same task."""
    rng = random.Random(67)
    frame = spark.createDataFrame([(signed(rng.getrandbits(64)),) for _ in range(200)], "fp long")
    links = simhash.near_fingerprints(frame)
    links._jdf.queryExecution().executedPlan()
    plan = links._jdf.queryExecution().executedPlan().toString()
    # Dealt by bucket, by key where several meet, and for the distinct links.
    assert plan.count("Exchange hashpartitioning(bucket") == 1 and plan.count("Exchange hashpartitioning(key") == 1 and plan.count("Exchange") == 3
    found = {(r["a"], r["b"]) for r in links.collect()}
    assert not found
    before = plan[plan.index("Exchange hashpartitioning(bucket") :]
    assert before.count("Generate") == 2
