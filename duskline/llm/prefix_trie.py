"""Prefix trie of conversations, with sums over subtrees rolled up in bands of depth."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskline.llm.common import bounded_batches, staged

# Height of a band: a row meets at most this many others, and there are as many rounds
# as the greatest depth has digits to this base.
BAND = 16
# Turns a rebuilt conversation borrows at most, and conversations that share a lender.
BORROWED = 8
SHARING = 5
# Conversation ids of one piece of text on the way to a digest.
PIECE = 4096
NODE = ["depth", "h1", "h2"]
SUMS = ["n_leaves", "saved_tokens"]


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """``(conv, pos, digest, size)``: the place of each turn (from 1), a SHA-256 of role and text, and the text's UTF-8 bytes.

    Rows are dealt by ranges of (conversation, turn) and numbered within a range; a
    conversation that spans several adds the counts of the ranges before. So one that holds
    a third of all rows is spread like any other. Texts stay behind: only digests move.

    A null turn comes first; equal turns go by role, then by digest. Null roles and texts
    are empty. Rows without a conversation id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = turns.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    ).filter("conv IS NOT NULL")
    rows = staged(rows.repartitionByRange("conv", "turn", "role", "digest").withColumn("part", F.spark_partition_id()), "trie-turns")
    here = Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    got = rows.withColumn("at", F.row_number().over(here)).join(counts, ["conv", "part"])
    return got.select("conv", (F.col("at") + F.col("before")).alias("pos"), "digest", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations of :func:`numbered_turns`: their turns, and ``(conv, length)`` of all, turnless ones too.

    Conversation c has the first h turns of conversation c - c % 5 (all if there are fewer,
    none if it does not exist), then its own after its first h; h is crc32(c) % 9.
    """
    turns = staged(turns, "trie-numbered")
    sizes = staged(turns.groupBy("conv").agg(F.max("pos").alias("n")), "trie-sizes")
    first = F.crc32(F.col("conv").cast("string")) % (BORROWED + 1)
    convs = sizes.select("conv", "n", first.alias("h"), (F.col("conv") - F.col("conv") % SHARING).alias("lender"))
    lent = sizes.select(F.col("conv").alias("lender"), F.col("n").alias("lent"))
    convs = convs.join(lent, "lender", "left").withColumn("used", F.least("h", F.coalesce("lent", F.lit(0))))
    convs = staged(convs.withColumn("length", F.col("used") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")
    heads = turns.filter(F.col("pos") <= BORROWED).withColumnRenamed("conv", "lender")
    borrowed = convs.join(heads, "lender").filter("pos <= used").select("conv", "pos", "digest", "size")
    own = turns.join(convs.select("conv", "h", "used"), "conv").filter("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("used")).alias("pos"), "digest", "size")
    return borrowed.union(own), convs.select("conv", "length")


def _running(rows: DataFrame, deepest: int, label: str) -> DataFrame:
    """``rows (conv, k, x1, x2)`` with the xor of all rows of the conversation up to each, by bands."""
    upto = Window.partitionBy("conv", "band").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("band", F.expr(f"k div {BAND}"))
    here = rows.withColumn("r1", F.bit_xor("x1").over(upto)).withColumn("r2", F.bit_xor("x2").over(upto))
    if deepest < BAND:
        return here.drop("band")
    bands = rows.groupBy("conv", F.col("band").alias("k")).agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    above = _running(staged(bands, f"{label}-sums"), deepest // BAND, label)
    above = above.select("conv", F.col("k").alias("band"), F.expr("r1 ^ x1").alias("b1"), F.expr("r2 ^ x2").alias("b2"))
    got = here.join(above, ["conv", "band"]).withColumn("r1", F.expr("r1 ^ b1")).withColumn("r2", F.expr("r2 ^ b2"))
    return got.drop("band", "b1", "b2")


def _exploded(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Sums of ``nodes (conv, k, ...)`` at each row on their path within its band: ``(k, h1, h2, ...)``."""
    met = nodes.join(rows.select("conv", "k", "path"), ["conv", "k"])
    met = met.select(F.expr(f"(k div {BAND}) * {BAND}").alias("low"), *SUMS, F.posexplode("path").alias("i", "h"))
    return met.select((F.col("low") + F.col("i")).alias("k"), "h.h1", "h.h2", *SUMS)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("k", "h1", "h2").agg(*[F.sum(c).alias(c) for c in SUMS])


def subtree_sums(nodes: DataFrame, rows: DataFrame, deepest: int, label: str = "trie") -> DataFrame:
    """Sums of ``SUMS`` over the subtree of every node, its top included: ``(k, h1, h2, ...)``.

    ``nodes`` has one row per node with one of its conversations; ``rows (conv, k, h1, h2)``
    the path of every conversation. A node adds its values to its ancestors within its own
    band of ``BAND`` depths, no further. The tops of bands, with what their bands gave, are a
    trie of a ``BAND``-th of the depth, summed in the same way; each top's total then goes to
    the ancestors in the band above it. So no row is repeated more than ``BAND`` times on any
    of the log(depth) levels, and every sum is combined before it is shuffled.
    """
    upto = Window.partitionBy("conv", "band").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("band", F.expr(f"k div {BAND}")).withColumn("path", F.collect_list(F.struct("h1", "h2")).over(upto))
    rows = staged(rows.drop("band"), f"{label}-paths")
    inside = _summed(_exploded(nodes, rows))
    if deepest < BAND:
        return inside
    inside = staged(inside, f"{label}-inside")
    top = F.col("k") % BAND == 0
    tops = nodes.filter(top).select("conv", "k", "h1", "h2").join(inside.filter(top), ["k", "h1", "h2"])
    tops = staged(tops.withColumn("k", F.expr(f"k div {BAND}")), f"{label}-tops")
    further = rows.filter(top).select("conv", F.expr(f"k div {BAND}").alias("k"), "h1", "h2")
    totals = subtree_sums(tops, further, deepest // BAND, label)
    whole = tops.filter("k > 0").select("conv", "k", "h1", "h2").join(totals, ["k", "h1", "h2"])
    # The last row of the band above has the whole band as its path.
    above = whole.select("conv", (F.col("k") * BAND - 1).alias("k"), *SUMS)
    return _summed(inside.select("k", "h1", "h2", *SUMS).union(_exploded(above, rows)))


def _digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined ids of each node: ``(depth, h1, h2, ends_sha256)``.

    A digest reads its ids in order. Ranges of (node, id) are joined to pieces of up to
    ``PIECE`` ids in parallel; the task of a node then reads pieces, one after the other, and
    holds no more than a batch of them.
    """
    ends = ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["piece"] = batch.groupby(NODE, sort=False).cumcount() // PIECE
            got = batch.groupby([*NODE, "piece"], sort=False)["conv"].agg(first="min", ids=lambda x: ",".join(map(str, x)))
            yield got.reset_index()[[*NODE, "first", "ids"]]

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            out = []
            for depth, h1, h2, ids in zip(batch["depth"].tolist(), batch["h1"].tolist(), batch["h2"].tolist(), batch["ids"]):
                if (depth, h1, h2) != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = (depth, h1, h2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*NODE, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    keys = "depth long, h1 long, h2 long"
    joined = ends.mapInPandas(pieces, f"{keys}, first long, ids string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInPandas(digests, f"{keys}, ends_sha256 string")


def _lane(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of all ``convs (conv, length)`` with their ``turns (conv, pos, digest, size)``.

    A node is a distinct sequence of first turns; its turn is that of ``conv_id``, the smallest
    member, at ``depth``. The root is at depth 0. Columns: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256 (see ``op13``).

    A sequence is known by the xor of two 64-bit hashes of each (place, digest), so that the
    keys of all prefixes are running sums, worked out in bands like the sums over
    subtrees. Conversations of one sequence are counted where they lie before they meet.
    A turnless conversation is a member of the root alone. No conversations, no nodes.
    """
    spark = turns.sparkSession
    bounded_batches(spark, 10_000)
    deepest = convs.agg(F.max("length")).first()[0]
    deepest = int(deepest or 0)
    hashed = turns.select(
        "conv", F.col("pos").cast("long").alias("k"), "size",
        _lane(F.col("pos").cast("long"), F.col("digest")).alias("x1"), _lane(F.col("digest"), F.col("pos").cast("long"), F.lit(1)).alias("x2"),
    )
    roots = convs.select("conv", F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("size"), *[F.lit(0).cast("long").alias(c) for c in ("x1", "x2")])
    rows = _running(staged(hashed.union(roots), "trie-rows"), deepest, "trie-keys")
    rows = staged(rows.select("conv", "k", "size", F.col("r1").alias("h1"), F.col("r2").alias("h2"),
                              F.expr("r1 ^ x1").alias("p1"), F.expr("r2 ^ x2").alias("p2")), "trie-keyed")
    nodes = rows.groupBy(F.col("k").alias("depth"), "h1", "h2").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.max("size").alias("size"),
        F.first("p1").alias("p1"), F.first("p2").alias("p2"),
    )
    nodes = staged(nodes, "trie-nodes")
    parents = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2"))
    counted = nodes.join(parents.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left")
    counted = staged(counted.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "trie-counted")
    valued = counted.select(
        F.col("conv_id").alias("conv"), F.col("depth").alias("k"), "h1", "h2",
        (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
    )
    sums = subtree_sums(valued, rows.select("conv", "k", "h1", "h2"), deepest).withColumnRenamed("k", "depth")
    ends = rows.join(convs, (rows["conv"] == convs["conv"]) & (rows["k"] == convs["length"]), "left_semi")
    digests = _digests(ends.select(F.col("k").alias("depth"), "h1", "h2", "conv"))
    above = counted.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    got = counted.join(sums, NODE).join(digests, NODE, "left").join(above, ["depth", "p1", "p2"], "left")
    return got.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *SUMS,
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """:func:`prefix_trie` of conversations as they are; ``columns`` as in :func:`numbered_turns`.

    Null turns come first, null roles and texts are empty, rows without a conversation id are
    left out, rows that repeat are turns of their own. Very long texts and conversations are
    taken whole. Other columns do not matter. An empty table gives no rows.
    """
    rows = staged(numbered_turns(turns, **columns), "trie-numbered")
    return prefix_trie(rows, staged(rows.groupBy("conv").agg(F.max("pos").alias("length")), "trie-convs"))


def rebuilt_trie(turns: DataFrame, **columns: str) -> DataFrame:
    """:func:`prefix_trie` of conversations rebuilt as in :func:`rebuilt`; otherwise as :func:`conversation_trie`."""
    return prefix_trie(*rebuilt(numbered_turns(turns, **columns)))
