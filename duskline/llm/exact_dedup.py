"""Exact deduplication by a two-pass Bloom filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.llm.common import SPACE, numbered, staged, text_of, without

# Slots of the filter: 2 ** 27 bits are 16 MB, whatever the number of rows. More
# rows than slots only send more rows into the shuffle; the result is the same.
SLOTS = 1 << 27
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def normalised(column: str) -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(text_of(column), f"{SPACE}+", " ")


def _slot(seed: int, slots: int) -> Column:
    return F.pmod(F.xxhash64("text_sha256", F.lit(seed)), F.lit(slots))


def _repeated_slots(keyed: DataFrame, slots: int) -> DataFrame:
    """The filter: slots that two rows or more fall into, as bitmaps of 32768 slots each.

    At most ``slots / 8`` bytes in all, so it may be broadcast.
    """
    hit = keyed.select(F.explode(F.array(_slot(1, slots), _slot(2, slots))).alias("slot"))
    often = hit.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return often.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )


def _is_set(bits: Column, slot: Column) -> Column:
    place = F.bitmap_bit_position(slot)
    byte = F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    return F.coalesce(F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), (place % 8).cast("int")) == 1, F.lit(False))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, slots: int = SLOTS
) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, one row per input row.

    Pass one hashes each text once and counts two filter slots per row; slots hit
    twice become the filter. Pass two tests every row: a row with a slot that was
    hit once has no equal and goes straight through. Only the others are shuffled,
    by the digest of the whole text, which decides exactly. Groups are counted
    map-side, so a text that holds a third of all rows sends one row per task, and
    rows meet their group in a join that Spark may split.

    ``carry`` names the input columns to keep (all by default); one that is named
    like a result column is replaced by it. Null and empty texts are equal. The
    smallest id of a group stays, a null id only where a group has no other; of
    rows with the same id one stays. Empty input gives an empty result.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    key = docs.select(
        *[F.col(f"`{c}`") for c in wanted], F.col(f"`{id_col}`").alias("__id"), F.sha2(normalised(text_col), 256).alias("text_sha256")
    )
    keyed = numbered(key, "exact-keys")
    bitmaps = staged(_repeated_slots(keyed, slots), "exact-filter")
    probed = keyed
    for seed in (1, 2):
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(f"__b{seed}"), F.col("bits").alias(f"__f{seed}")))
        slot = _slot(seed, slots)
        probed = probed.join(side, F.bitmap_bucket_number(slot) == F.col(f"__b{seed}"), "left")
        probed = probed.withColumn(f"__s{seed}", _is_set(F.col(f"__f{seed}"), slot)).drop(f"__b{seed}", f"__f{seed}")
    maybe = F.col("__s1") & F.col("__s2")
    alone = probed.filter(~maybe).select(
        *[F.col(f"`{c}`") for c in wanted],
        F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256",
    )
    suspects = staged(probed.filter(maybe).drop("__s1", "__s2"), "exact-suspects")
    first = F.min(F.struct(F.col("__id").isNull().alias("no_id"), F.col("__id").alias("id"), F.col("__row").alias("row")))
    groups = staged(suspects.groupBy("text_sha256").agg(first.alias("__first"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    met = suspects.join(groups, "text_sha256").select(
        *[F.col(f"`{c}`") for c in wanted],
        F.col("__first.id").alias("keep_id"), "group_size", (F.col("__row") == F.col("__first.row")).alias("kept"), "text_sha256",
    )
    return alone.unionByName(met)


def kept_rows(docs: DataFrame, **how) -> DataFrame:
    """The documents that stay, with their own columns."""
    return without(exact_dedup(docs, **how).filter("kept"), *RESULT)
