"""SimHash near-dedup by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskline.llm.common import bounded_batches, components, numbered, staged, without

RADIUS = 3
BLOCKS = 4  # one of them is left out of a key at a time
WIDE = 64 // BLOCKS  # bits of the block left out
KEPT = 64 - WIDE
HOME = 16  # of the bits kept, those that variants are shuffled by
SEED = 42
RESULT = ("fingerprint", "component_id", "kept")

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_PLACES = np.arange(8, dtype=np.int64) * 256


def _votes(hashes: np.ndarray) -> np.ndarray:
    """For each of the 64 bits, how many hashes have it set."""
    found = np.zeros(2048, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 18):
        part = hashes[start : start + (1 << 18)].view(np.uint8).reshape(-1, 8)
        found += np.bincount((part + _PLACES).ravel(), minlength=2048)
    return (found.reshape(8, 256) @ _BITS).ravel()


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of one text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    width = min(shingle, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    cut = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    hashed = xxhash.xxh64_intdigest
    hashes = np.array([hashed(line[a:b], SEED) for a, b in cut], dtype=np.uint64)
    ones = 2 * _votes(hashes) > len(hashes)
    return int(np.packbits(ones, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text_col: str, shingle: int) -> Column:
    """The fingerprint of each text as a (signed) long, from Arrow batches of texts."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in batch], dtype=np.uint64).view(np.int64))

    return of(F.col(f"`{text_col}`"))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _masks(width: int, most: int) -> list[int]:
    """All bit masks below ``width`` with at most ``most`` bits."""
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(width), n)]


def _rolled(block: Column | str) -> Column:
    """The fingerprint ``fp``, turned so that the given block becomes the top bits."""
    rolled = F.col("fp")
    for b in range(1, BLOCKS):
        moved = F.shiftleft("fp", b * WIDE).bitwiseOR(F.shiftrightunsigned("fp", 64 - b * WIDE))
        rolled = F.when((F.col(block) if isinstance(block, str) else block) == b, moved).otherwise(rolled)
    return rolled


def near_fingerprints(prints: DataFrame, tables: bool = False) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints (column ``fp``), a forest's worth per neighbourhood.

    With ``tables``, a column ``table`` (a small number) parts the fingerprints: only those of one
    table meet, and links come as ``(table, a, b)``.

    Two fingerprints three bits apart have no point half way, so one block of 16
    bits is left out of the key (each block in turn) and takes up the odd bit. Of
    the other 48 bits every fingerprint emits all variants within one bit, 4 x 49
    in all, and rows meet by (block, variant). Any two fingerprints within three
    bits meet under some variant: leave out a block that holds one or all of their
    three differing bits and flip one remaining bit on either side. The variants
    that have the first 16 of the 48 bits in common are shuffled as one row and made after it:
    4 x 17 rows in place of 4 x 49.

    Keys with one fingerprint are done. Where several meet, they are shuffled by key and also emit variants
    of the block left out (up to one bit; up to two for the unchanged 48), without another shuffle. Members of one full 64-bit variant with one
    flip or none are within three bits of every other member (three flips at most
    between them), so all link to the smallest of these: links grow with the
    members, never with their square, and none is missed. Links are made distinct
    and their distance is verified.
    """
    low = (1 << KEPT) - 1
    part = (1 << HOME) - 1
    turn = F.explode(F.array(*[F.lit(b) for b in range(BLOCKS)]))
    rows = prints.select("fp", turn.alias("block"), *(["table"] if tables else []))
    tag = F.col("table") * BLOCKS + F.col("block") if tables else F.col("block")
    rows = rows.select("fp", F.shiftrightunsigned(_rolled("block").bitwiseAND(F.lit(low)), KEPT - HOME).cast("int").alias("home"), tag.alias("tag"))
    near = F.explode(F.array(*[F.col("home").bitwiseXOR(F.lit(m)).bitwiseOR(F.shiftleft("tag", HOME)) for m in _masks(HOME, 1)]))
    rows = rows.select("fp", near.alias("bucket"))
    # One row brings a fingerprint to all its variants of a bucket; these are made there. Rows multiply after both shuffles,
    # so the number of tasks is given: by what they read, Spark would make too few.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, "bucket")
    tag = F.shiftrightunsigned("bucket", HOME)
    rows = rows.select("fp", "bucket", tag.cast("long").alias("tag"), _rolled(tag % BLOCKS).bitwiseAND(F.lit(low)).alias("rolled"))
    away = F.shiftrightunsigned("rolled", KEPT - HOME).bitwiseXOR(F.col("bucket").bitwiseAND(F.lit(part)).cast("long"))
    here = F.array(*[F.lit(m).cast("long") for m in _masks(KEPT - HOME, 1)])
    flip = F.explode(F.when(away == 0, here).otherwise(F.array(F.shiftleft(away, KEPT - HOME))))
    rows = rows.select("fp", "bucket", "tag", "rolled", flip.alias("flip"))
    rows = rows.select("fp", "bucket", F.col("rolled").bitwiseXOR(F.col("flip")).bitwiseOR(F.shiftleft("tag", KEPT)).alias("key"))
    met = Window.partitionBy("key", "bucket")  # a key is of one bucket, so nothing is shuffled again
    rows = rows.withColumn("least", F.min("fp").over(met)).withColumn("most", F.max("fp").over(met))
    crowd = rows.filter("least <> most").select("fp", "key").repartition(tasks, "key")
    tagged = F.shiftrightunsigned("key", KEPT).cast("int")
    crowd = crowd.select("fp", "key", _rolled(tagged % BLOCKS).alias("rolled"))
    flipped = F.bit_count(F.col("rolled").bitwiseXOR(F.col("key")).bitwiseAND(F.lit(low)))
    crowd = crowd.select("fp", "key", F.shiftrightunsigned("rolled", KEPT).cast("int").alias("top"), flipped.alias("flips"))
    two, small = (F.array(*[F.lit(m) for m in _masks(WIDE, n)]) for n in (2, 1))
    crowd = crowd.select("fp", "key", "top", "flips", F.explode(F.when(F.col("flips") == 0, two).otherwise(small)).alias("more"))
    crowd = crowd.select("fp", "key", F.col("top").bitwiseXOR(F.col("more")).alias("rest"), (F.col("flips") + F.bit_count("more")).alias("flips"))
    hub = F.min(F.when(F.col("flips") <= 1, F.col("fp"))).over(Window.partitionBy("key", "rest"))
    of = [F.floor(tagged / BLOCKS).cast("int").alias("table")] if tables else []
    pairs = crowd.select("fp", hub.alias("hub"), *of).filter("hub is not null and hub <> fp").distinct()
    links = [*(["table"] if tables else []), F.col("hub").alias("a"), F.col("fp").alias("b")]
    return pairs.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= RADIUS).select(*links)


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, carry: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``fingerprint`` (hex), ``component_id`` and ``kept``, one row per input row.

    Texts are read once for their fingerprints; everything after works on distinct
    fingerprints, so copies of one text cost one row each and no group of copies
    meets in one task. Components come from links between fingerprints by repeated
    minimum labels in tables in the shared folder. ``component_id`` is the smallest
    id reachable over links of at most three bits; ``kept`` marks one row per
    component, the one with that id.

    Null and empty texts, and texts of white space, have fingerprint 0, which links
    like any other. Null ids do not count for ``component_id`` (null if a component
    has no other). Of rows with equal ids one is kept. ``carry`` names the input
    columns to keep (all by default); one named like a result column is replaced.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    bounded_batches(docs.sparkSession)
    hashed = docs.select(*[F.col(f"`{c}`") for c in wanted], F.col(f"`{id_col}`").alias("__id"), fingerprint_column(text_col, shingle).alias("__fp"))
    hashed = numbered(hashed, "simhash")
    first = F.min(F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__row").alias("row")))
    prints = staged(hashed.groupBy(F.col("__fp").alias("fp")).agg(first.alias("first")), "simhash-prints")
    links = staged(near_fingerprints(prints.select("fp")), "simhash-links")
    parts = components(links, "simhash")
    named = prints.join(parts, prints["fp"] == parts["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("part"))
    named = staged(named, "simhash-parts")
    heads = staged(named.groupBy("part").agg(F.min("first").alias("head")), "simhash-heads")
    names = staged(named.join(heads, "part").select(F.col("fp").alias("__of"), "head"), "simhash-names")
    got = hashed.join(names, F.col("__fp") == F.col("__of")).select(
        *[F.col(f"`{c}`") for c in wanted],
        F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"),
        F.col("head.id").alias("component_id"),
        (F.col("__row") == F.col("head.row")).alias("kept"),
    )
    return got


# Near copies by similarity: see near_copies.
TABLES = 3
SIMILARITY = 0.8
SHINGLE = 5
SKETCH = 256
# Keys a text has besides its fingerprints, each of KEY_HASHES least hashes of its shingles:
# two texts alike by 0.8 have none in common once in 300,000 times.
KEYS = 32
KEY_HASHES = 5
# Hubs per key in each round after the first.
HUBS = 8
# Texts under a key that are all paired with each other, once: at most 7.5 pairs a row.
FEW = 16
# Sketches this far below the wanted similarity (8 standard errors for SKETCH at
# 0.8) settle that a pair is not alike; all others are compared whole.
MARGIN = 0.2
# Bits of each least hash in a text's code, which rows carry to where pairs are made.
PLANES = 3
PLANE = -(-KEYS * KEY_HASHES // 64)  # longs of one bit of all least hashes
COPY_RESULT = ("copy_of", "kept")


def _salted(hashes: np.ndarray, table: int) -> np.ndarray:
    """Another, independent hash of what was hashed."""
    if not table:
        return hashes
    x = hashes ^ np.uint64((0x9E3779B97F4A7C15 * table) & ((1 << 64) - 1))
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _cut(words: list[bytes], shingle: int) -> np.ndarray:
    """Hashes of all runs of ``shingle`` words, in order; the whole text where it is shorter."""
    line = b" ".join(words)
    hashed = xxhash.xxh64_intdigest
    width = min(shingle, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    cut = zip((ends - sizes)[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([hashed(line[a:b], SEED) for a, b in cut], dtype=np.uint64)


def whole(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """All distinct word shingles of a text, as sorted (signed) longs."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(_cut(words, shingle).view(np.int64)) if words else np.zeros(0, dtype=np.int64)


_FACTORS = _salted(np.arange(1, KEYS * KEY_HASHES + 1, dtype=np.uint64), 7) | np.uint64(1)


def least_hashes(parts: np.ndarray) -> np.ndarray:
    """The least values of a set of shingle hashes under ``KEYS * KEY_HASHES`` hash functions."""
    least = np.full(KEYS * KEY_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(parts), 1024):  # in pieces, for very long texts
        least = np.minimum(least, (parts[a : a + 1024, None].view(np.uint64) * _FACTORS[None, :]).min(axis=0))
    return least


def least_keys(least: np.ndarray) -> np.ndarray:
    """``KEYS`` keys, each of ``KEY_HASHES`` least hashes."""
    keys = np.arange(1, KEYS + 1, dtype=np.uint64)
    for column in least.reshape(KEYS, KEY_HASHES).T:
        keys = _salted(keys ^ column, 1)
    return keys.view(np.int64)


def least_code(least: np.ndarray) -> np.ndarray:
    """``PLANES`` bits of each least hash: ``PLANE`` longs for each of these bits."""
    mixed = _salted(least, 2)
    bits = np.zeros((PLANES, PLANE * 64), dtype=np.uint8)
    for plane in range(PLANES):
        bits[plane, : len(mixed)] = (mixed >> np.uint64(plane)).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def unlike(a: str, b: str) -> Column:
    """How many least hashes differ between two codes."""
    words = [[F.col(f"{a}")[i].bitwiseXOR(F.col(f"{b}")[i]) for i in range(w, PLANES * PLANE, PLANE)] for w in range(PLANE)]
    return sum((F.bit_count(reduce(Column.bitwiseOR, planes)) for planes in words), F.lit(0))


def most_unlike(least: float) -> int:
    """More least hashes than this differ, by 8 standard errors, only between texts that are not alike by ``least``."""
    n = KEYS * KEY_HASHES
    equal = least + (1 - least) / 2**PLANES
    return int(n * (1 - equal) + 8 * (n * equal * (1 - equal)) ** 0.5)


def coded(text: str | None, tables: int = TABLES, shingle: int = SHINGLE) -> tuple[str, list[int], list[int], list[int], list[int]]:
    """The :func:`signature` of a text and the code of its least hashes (both empty for a text without words)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    line = b" ".join(words)
    key = xxhash.xxh3_128_hexdigest(line)
    if not words:
        return key, [0] * tables, [], [], []
    hashed = xxhash.xxh64_intdigest
    single = np.array([hashed(w, SEED) for w in set(words)], dtype=np.uint64)
    prints = []
    for table in range(tables):
        ones = 2 * _votes(_salted(single, table)) > len(single)
        prints.append(int(np.packbits(ones, bitorder="little").view(np.int64)[0]))
    parts = np.unique(_cut(words, shingle))
    small = np.unique((parts & np.uint64(0x7FFFFFFF)).astype(np.int32))
    least = least_hashes(parts)
    return key, prints, small[:SKETCH].tolist(), least_keys(least).tolist(), least_code(least).tolist()


def signature(text: str | None, tables: int = TABLES, shingle: int = SHINGLE) -> tuple[str, list[int], list[int], list[int]]:
    """Key of the word sequence, fingerprints of the set of words (one per table), sketch and keys of the word shingles.

    The sketch holds the ``SKETCH`` smallest shingle hashes; a text with no more
    distinct shingles is in it whole.
    """
    return coded(text, tables, shingle)[:4]


def similarity(a: Column, b: Column) -> Column:
    """Share of common shingles, from the smallest of both: exact up to ``SKETCH`` distinct shingles, an estimate beyond."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, 1.0).otherwise(both / F.size(least))


def _meetings(shared: DataFrame, member: DataFrame, turns: list[int], key: Column | str = "key", most: int | None = None) -> DataFrame:
    """Pairs ``(hub, node)`` of texts of different groups that share a key.

    Of each group under a key one text stands for it, and the groups' texts are paired with
    one of them, the hub: fewer pairs than rows, however many texts have the key. In turn 0
    both are texts that meet most others: an original meets all its copies, which may be
    unlike each other. Other turns choose by a hash. ``key`` may explode the keys of a text,
    so that its group is looked up once for all of them. With ``most`` the texts have codes,
    and pairs with more unlike least hashes are not made.
    """
    # All turns stand in one row per group and key, and in one row per key for the hubs: the join makes no more rows than there are groups.
    with_code = [] if most is None else ["code"]
    here = shared.join(member, "node").select(key, "part", "node", "meets", *with_code)
    rank = {t: -F.col("meets") if t == 0 else F.xxhash64("node", F.lit(t)) for t in turns}
    here = here.groupBy("key", "part").agg(*[F.min(F.struct(rank[t].alias("by"), F.col("node"), *with_code)).alias(f"one{t}") for t in turns])
    # Both sides of the join are tables, so that Spark can split the rows of a key that has most of them.
    here = staged(here, "copies-groups")
    rank = {t: F.col(f"one{t}.by") if t == 0 else F.xxhash64("part", F.lit(t)) for t in turns}
    hubs = here.groupBy("key").agg(
        *[F.min(F.struct(rank[t].alias("by"), F.col(f"one{t}.node").alias("node"), F.col("part"), *[f"one{t}.{c}" for c in with_code])).alias(f"hub{t}") for t in turns],
        F.count(F.lit(1)).alias("groups"),
    )
    hubs = staged(hubs.filter("groups > 1").drop("groups"), "copies-hubs")
    pair = []
    for t in turns:
        apart = F.col("part") != F.col(f"hub{t}.part")
        if with_code:
            apart &= unlike(f"hub{t}.code", f"one{t}.code") <= most
        a, b = F.col(f"hub{t}.node"), F.col(f"one{t}.node")
        pair.append(F.when(apart, F.struct(F.least(a, b).alias("hub"), F.greatest(a, b).alias("node"))))
    # Only pairs that remain become rows, and what a text meets under all its keys once: a text has KEYS keys at most, so no list is longer than KEYS times the turns.
    met = here.join(hubs, "key").select(F.col(f"one{turns[0]}.node").alias("by"), F.array_compact(F.array(*pair)).alias("pairs")).filter(F.size("pairs") > 0)
    met = met.groupBy("by").agg(F.array_distinct(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    return met.select(F.explode("pairs").alias("m")).select("m.hub", "m.node").distinct()


def _all_meetings(shared: DataFrame, member: DataFrame, key: Column | str = "key", most: int | None = None) -> DataFrame:
    """All pairs ``(hub, node)`` of texts of different groups that share a key; for keys of at most ``FEW`` texts. ``most``: see :func:`_meetings`."""
    with_code = [] if most is None else ["code"]
    here = shared.join(member, "node").select(key, "part", "node", *with_code)
    a, b = (here.select("key", F.col("part").alias(f"{x}_part"), F.col("node").alias(x), *[F.col(c).alias(f"{x}_code") for c in with_code]) for x in ("hub", "node"))
    met = a.join(b, "key").filter("hub < node and hub_part <> node_part")
    met = met.filter(unlike("hub_code", "node_code") <= most) if with_code else met
    return met.select("hub", "node").distinct()


def _near_meetings(links: DataFrame, firsts: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs ``(hub, node)`` of texts of different groups that stand for linked fingerprints ``(table, a, b)``."""
    grouped = firsts.join(parts.withColumnRenamed("node", "of"), F.col("hub") == F.col("of"), "left")
    grouped = grouped.select("table", "fp", "hub", F.coalesce("component", "hub").alias("part"))
    a, b = (grouped.select("table", F.col("fp").alias(x), F.col("hub").alias(f"n{x}"), F.col("part").alias(f"p{x}")) for x in ("a", "b"))
    near = links.join(a, ["table", "a"]).join(b, ["table", "b"]).filter("pa <> pb")
    return near.select(F.least("na", "nb").alias("hub"), F.greatest("na", "nb").alias("node"))


def near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, least: float = SIMILARITY,
    tables: int = TABLES, shingle: int = SHINGLE,
) -> DataFrame:
    """``docs`` with ``copy_of`` and ``kept``: groups of texts whose word shingles are alike by ``least`` or more.

    Three bits of 64 allow little difference between whole shingle vectors. Here the
    fingerprints are of the set of a text's words, which an edit changes less, in
    ``tables`` independent tables; each goes through the same ball hashing. What
    meets is compared by its shingles of ``shingle`` words, so texts that merely use
    the same words stay apart. Groups are the components of the confirmed links.
    ``copy_of`` is the smallest id of the group; ``kept`` marks one row per group.

    Bits of a hash miss some pairs, and a link to one text of a fingerprint says nothing
    of the others. So texts also meet under ``KEYS`` keys of least shingle hashes, of
    which two alike by 0.8 share ten on average. First, texts of one fingerprint and those under
    keys of more than ``FEW`` texts meet one text each, which makes most of a large group one.
    After that only texts that are not yet of one group are paired: those of linked fingerprints and all under
    a key of at most ``FEW`` texts, once, and under other keys one per group
    with a few hubs, in rounds until one over all these keys links no more.
    All that meets is compared by whole sets of shingles, unless the sketches are far apart.

    Texts with equal words in a row (letter case aside) are one text throughout: a
    group of copies is one row after a map-side aggregation. Texts without words are
    copies of one another. Null ids count only where a group has no other. Input
    columns named like a result column are replaced; ``carry`` names those to keep.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in COPY_RESULT]
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("key string, prints array<long>, sketch array<int>, keys array<long>, code array<long>")
    def sign(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            got = [coded(t, tables, shingle) for t in batch]
            yield pd.DataFrame({name: [g[i] for g in got] for i, name in enumerate(("key", "prints", "sketch", "keys", "code"))})

    # The text is read again for its shingles, under its own name where the result has it too.
    text = [] if text_col in wanted else [F.col(f"`{text_col}`").alias("__text")]
    signed = docs.select(*[F.col(f"`{c}`") for c in wanted], F.col(f"`{id_col}`").alias("__id"), sign(F.col(f"`{text_col}`")).alias("__s"), *text)
    signed = numbered(signed.select(*[F.col(f"`{c}`") for c in wanted], "__id", "__s.*", *[F.col("__text") for _ in text]), "copies")
    words = F.col("__text" if text else f"`{text_col}`")
    head = F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__row").alias("row"))
    texts = staged(signed.groupBy("key").agg(F.min_by(F.struct("prints", "sketch", "keys", "code"), head).alias("s"), F.min(head).alias("head")), "copies-texts")
    nodes = texts.select(F.col("head.row").alias("node"), "s.prints")
    here = nodes.select("node", F.posexplode("prints").alias("table", "fp"))
    firsts = staged(here.groupBy("table", "fp").agg(F.min("node").alias("hub")), "copies-prints")
    same = here.join(firsts, ["table", "fp"]).filter("node <> hub").select("hub", "node")
    near = staged(near_fingerprints(firsts.select("table", "fp"), tables=True), "copies-near")
    sketches = texts.select(F.col("head.row").alias("of"), "s.sketch")

    @F.pandas_udf("array<long>")
    def every(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([whole(t, shingle) for t in batch])

    def confirmed(found: DataFrame, label: str) -> DataFrame:
        """Links ``(a, b)`` between the pairs whose whole shingle sets are alike."""
        left = sketches.select(F.col("of").alias("hub"), F.col("sketch").alias("x"))
        right = sketches.select(F.col("of").alias("node"), F.col("sketch").alias("y"))
        likely = found.join(left, "hub").join(right, "node").filter(similarity(F.col("x"), F.col("y")) >= least - MARGIN)
        likely = staged(likely.select("hub", "node"), f"copies-likely-{label}")
        asked = staged(likely.select(F.col("hub").alias("of")).union(likely.select("node")).distinct(), f"copies-asked-{label}")
        sets = staged(signed.join(asked, F.col("__row") == F.col("of")).select("of", every(words).alias("set")), f"copies-sets-{label}")
        left, right = sets.select(F.col("of").alias("hub"), F.col("set").alias("x")), sets.select(F.col("of").alias("node"), F.col("set").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        alike = likely.join(left, "hub").join(right, "node").filter(both / (F.size("x") + F.size("y") - both) >= least)
        return staged(alike.select(F.col("hub").alias("a"), F.col("node").alias("b")), f"copies-{label}")

    keyed = texts.select(F.col("head.row").alias("node"), F.explode("s.keys").alias("key"))
    several = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # A row per text, so that its group is looked up once for all its keys.
    held = keyed.join(several, "key").groupBy("node").agg(
        F.sum("n").alias("meets"), *[F.collect_list(F.when(rule, F.col("key"))).alias(x) for x, rule in (("few", F.col("n") <= FEW), ("many", F.col("n") > FEW))]
    )
    codes = texts.select(F.col("head.row").alias("of"), "s.code")
    held = staged(held.join(codes, F.col("node") == F.col("of")).drop("of"), "copies-keys")
    most = most_unlike(least)
    few, many = (F.explode(x).alias("key") for x in ("few", "many"))
    # First what a large group needs to become one: its pairs of later turns are then never made.
    alone = held.select("node", F.col("node").alias("part"))
    tested = staged(same.union(_meetings(held, alone, [0], many, most)).distinct(), "copies-met-0")
    links = confirmed(tested, "alike-0")
    parts = components(links, "copies-0")
    turn = 1
    while True:
        member = held.select("node").join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("part"))
        if turn == 1:
            met = _all_meetings(held, member, few, most).union(_near_meetings(near, firsts, parts)).distinct()
        else:
            met = _meetings(held, member, [HUBS * turn + i for i in range(HUBS)], many, most)
        met = staged(met.join(tested, ["hub", "node"], "left_anti"), f"copies-met-{turn}")
        more = confirmed(met, f"alike-{turn}")
        if more.limit(1).count():
            links = links.union(more)
            parts = components(links, f"copies-{turn}")
        elif turn > 1:
            break
        tested = tested.union(met)
        turn += 1
    named = staged(
        texts.join(parts, F.col("head.row") == parts["node"], "left").select("key", "head", F.coalesce("component", "head.row").alias("part")), "copies-parts"
    )
    heads = staged(named.groupBy("part").agg(F.min("head").alias("first")), "copies-heads")
    names = staged(named.join(heads, "part").select(F.col("key").alias("__of"), "first"), "copies-names")
    return signed.join(names, F.col("key") == F.col("__of")).select(
        *[F.col(f"`{c}`") for c in wanted], F.col("first.id").alias("copy_of"), (F.col("__row") == F.col("first.row")).alias("kept")
    )


def one_per_group(docs: DataFrame, **how) -> DataFrame:
    """The documents that stay of each group of near copies, with their own columns."""
    return without(near_copies(docs, **how).filter("kept"), *COPY_RESULT)
