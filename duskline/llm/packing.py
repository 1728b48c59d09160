"""Best-fit packing of token pieces by linear grouping of their lengths."""

from __future__ import annotations

import bisect
import os
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duskline.llm.common import bounded_batches, staged, text_of, without

CAPACITY = 2048
GROUPS = 512  # equal-cardinality groups of large lengths
SMALL = 4  # a length below capacity / SMALL is small
ROWS_PER_SALT = 200  # rows of one length that are ranked together
CACHED_WORDS = 1_500_000
TOKENIZER = "byte_bpe_50k.json"
RESULT = ("piece", "start", "length", "ids", "sequence_id", "offset")

# Letters and digits up to U+024F, where all Unicode versions agree. Texts with
# other characters are not split here but given to the tokenizer whole.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\s{_LETTER}{_DIGIT}]+|\s+(?!\S)|\s+"
)
_OTHER = re.compile("[\x1c-\x1fɐ-\U0010ffff]")


class Encoder:
    """Token ids as little-endian bytes. The ids of a word are asked for once and kept.

    The vocabulary's own pre-tokenizer cuts a text into words and encodes each for
    itself, so the ids of a text are those of its words in a row.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        if not os.path.exists(path):
            import public_tokenizers

            path = public_tokenizers.path(path)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [
            None if _OTHER.search(t) or any(s in t for s in self.special) else _WORDS.findall(t) for t in texts
        ]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        new = list({w for words in split if words for w in words if w not in known})
        known.update(zip(new, self._ids(new)))
        whole = iter(self._ids([t for t, words in zip(texts, split) if words is None]))
        return [next(whole) if words is None else b"".join(map(known.__getitem__, words)) for words in split]


@cache
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def cut(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """(start, ids) of each piece: whole pieces of ``capacity`` tokens from the end, the rest first."""
    n = len(ids) // 4
    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
    return [(a, ids[4 * a : 4 * b]) for a, b in zip(edges, edges[1:])]


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY
) -> DataFrame:
    """``(id, piece, start, length, ids)``: each whole text's token ids, then id 0, in pieces of at most ``capacity``.

    ``ids`` are little-endian unsigned 32-bit numbers. Only longer documents are
    cut; their first piece may be the shorter one. ``tokenizer`` is a path or the
    name of a public vocabulary file. A null text is empty: one piece, id 0. Repeated rows give their
    own pieces.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        ]
    )

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer).encode
        for batch in batches:
            rows = [
                (key, k, a, len(part) // 4, part)
                for key, ids in zip(batch["id"].array, encode(batch["text"].tolist()))
                for k, (a, part) in enumerate(cut(ids + b"\0\0\0\0", capacity))
            ]
            frame = pd.DataFrame(rows, columns=schema.names)
            frame[id_col] = frame[id_col].astype(batch["id"].dtype)
            yield frame

    return docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).mapInPandas(pieces, schema)


class _Supply:
    """Pieces that are not placed yet, by length; each is known by its rank within its length."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.left = dict(counts)
        self.used: dict[int, int] = defaultdict(int)

    def take(self, length: int, n: int) -> int:
        rank = self.used[length]
        self.used[length] += n
        self.left[length] -= n
        return rank


def _best_config(sizes: list[int], left: list[int], capacity: int, first: int) -> dict[int, int]:
    """How many of each size fill ``capacity`` best, with one of ``first`` in it: a bounded knapsack by dynamic programming."""
    room = capacity - sizes[first]
    full = np.zeros(room + 1, dtype=np.int64)
    picks = []
    for k, size in enumerate(sizes):
        have = left[k] - (k == first)
        taken = np.zeros(room + 1, dtype=np.int16)
        base = full
        for n in range(1, min(have, room // size) + 1 if size <= room else 1):
            trial = np.full(room + 1, -1, dtype=np.int64)
            trial[n * size :] = base[: room + 1 - n * size] + n * size
            better = trial > full
            full = np.where(better, trial, full)
            taken[better] = n
        picks.append(taken)
    chosen: dict[int, int] = {first: 1}
    for k in range(len(sizes) - 1, -1, -1):
        n = int(picks[k][room])
        if n:
            chosen[k] = chosen.get(k, 0) + n
            room -= n * sizes[k]
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, small: int = SMALL) -> np.ndarray:
    """Where the pieces go, from the number of pieces of each length alone.

    Rows ``(length, rank, n, sequence, offset)``: pieces ``rank .. rank + n - 1`` of a
    length go to sequences ``sequence ..`` in step, each at ``offset``. At most
    ``capacity`` lengths go in, so this does not grow with the documents.

    1. Lengths of ``capacity / small`` and more are cut, longest first, into
       ``groups`` groups of equal cardinality; each counts as the group's longest.
    2. Over these few sizes, configurations are chosen one by one: the fullest that
       holds the largest size left, used as often as the supply lasts.
    3. Actual lengths take the places of the rounded ones, which leaves more room.
    4. Small lengths, longest first, go to the tightest sequence with room for them,
       or open a new one.
    """
    supply = _Supply({l: n for l, n in counts.items() if n > 0})
    moves: list[tuple[int, int, int, int, int]] = []
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> ranges of sequences
    bins = 0
    large = sorted((l for l in supply.left if l * small >= capacity), reverse=True)
    total = sum(supply.left[l] for l in large)
    members: list[list[int]] = []
    seen = 0
    for length in large:
        slot = seen * groups // max(total, 1)
        if not members or slot != opened:
            members.append([])
            opened = slot
        members[-1].append(length)
        seen += supply.left[length]
    sizes = [m[0] for m in members]
    left = [sum(supply.left[l] for l in m) for m in members]
    first = 0
    while first < len(sizes):
        if not left[first]:
            first += 1
            continue
        config = _best_config(sizes, left, capacity, first)
        times = min(left[k] // n for k, n in config.items())
        ranges = [(bins, times, 0)]  # first sequence, how many, tokens in each
        bins += times
        for k, n in sorted(config.items()):
            left[k] -= n * times
            for _ in range(n):
                filled = []
                for at, width, used in ranges:
                    while width:
                        length = members[k][0]
                        if not supply.left[length]:
                            members[k].pop(0)
                            continue
                        m = min(width, supply.left[length])
                        moves.append((length, supply.take(length, m), m, at, used))
                        filled.append((at, m, used + length))
                        at, width = at + m, width - m
                ranges = filled
        for at, width, used in ranges:
            open_bins[capacity - used].append((at, width))
    rooms = sorted(r for r in open_bins if r)
    for length in sorted((l for l in supply.left if l * small < capacity), reverse=True):
        while supply.left[length]:
            spot = bisect.bisect_left(rooms, length)
            if spot == len(rooms):
                # No room: as many new sequences as these pieces fill, all but the last full.
                each = capacity // length
                for width, per in ((supply.left[length] // each, each), (1, supply.left[length] % each)):
                    if width and per:
                        for k in range(per):
                            moves.append((length, supply.take(length, width), width, bins, k * length))
                        room = capacity - per * length
                        if room and room not in open_bins:
                            bisect.insort(rooms, room)
                        open_bins[room].append((bins, width))
                        bins += width
                continue
            room = rooms[spot]
            at, width = open_bins[room].pop()
            m = min(width, supply.left[length])
            moves.append((length, supply.take(length, m), m, at, capacity - room))
            if m < width:
                open_bins[room].append((at + m, width - m))
            if not open_bins[room]:
                del open_bins[room]
                rooms.pop(spot)
            rest = room - length
            if rest and rest not in open_bins:
                bisect.insort(rooms, rest)
            open_bins[rest].append((at, m))
    return np.array(sorted(moves), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, key: list[str], capacity: int = CAPACITY, groups: int = GROUPS, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Only the number of pieces per length reaches the driver, ``capacity`` numbers at
    most; the plan made of them is a table of moves in which each piece finds its
    place by its length and its rank within that length. Ranks come from windows
    over (length, salt), where a hash of the ``key`` columns gives as many salts as
    keep a window small, so a length that holds a third of all rows is many windows.
    Places are worked out on keys and lengths; tokens are shuffled once, to meet their place.
    Sequences are filled from offset 0 without gaps. The rows' other columns are
    carried along; a ``sequence_id`` or ``offset`` of their own is replaced. Ties
    between rows with equal keys are broken by a row number. No rows, no sequences.
    """
    pieces = staged(without(pieces, "sequence_id", "offset").withColumn("__row", F.monotonically_increasing_id()), "pack-pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    moves = plan(counts, capacity, groups)
    salts = max(1, -(-max(counts.values(), default=0) // rows_per_salt))
    narrow = pieces.select(*key, "length", "__row").withColumn("__salt", F.pmod(F.xxhash64(*key, "__row"), F.lit(salts)))
    parts = narrow.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("length").alias("__length"), F.col("__salt").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__first"))
    starts = staged(starts, "pack-ranks")
    within = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*key, "__row")) - 1
    ranked = narrow.withColumn("__within", within).join(starts, (F.col("length") == F.col("__length")) & (F.col("__salt") == F.col("__part")))
    ranked = ranked.select("length", F.col("__row").alias("__of"), (F.col("__first") + F.col("__within")).alias("rank"))
    stride = int(max(counts.values(), default=0)) + 1
    lookup = moves[:, 0] * stride + moves[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(lookup, length.to_numpy() * stride + rank.to_numpy(), side="right") - 1
        found = moves[at]
        return pd.DataFrame({"sequence_id": found[:, 3] + rank.to_numpy() - found[:, 1], "offset": found[:, 4]})

    placed = ranked.withColumn("place", place("length", "rank")).select("__of", "place.sequence_id", "place.offset")
    return without(pieces.join(staged(placed, "pack-places"), F.col("__row") == F.col("__of")), "__row", "__of")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """Packed sequences with their tokens: one row per piece, ``ids`` included."""
    return pack(token_pieces(docs, id_col, text_col, tokenizer, capacity), [id_col, "piece"], capacity)
