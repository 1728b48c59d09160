"""Ranked lexical search: an inverted index of compressed blocks, searched by Block-Max MaxScore."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from duskline.llm.common import ascii_terms, bounded_batches, staged

# Postings of a block, and rows and term occurrences after which a task begins a new
# shard: they bound the memory of a task and shape no result.
BLOCK = 128
SHARD_ROWS = 65_536
SHARD_TERMS = 4_000_000
# Documents that are scored together; the threshold rises in between.
WINDOW = 1024
# Terms (with repeats between items) of the items that are searched together, and the
# number of distinct terms up to which the index is made of these terms alone.
ASKED_TERMS = 500_000
MOST_TERMS = 1_000_000
# A block's peaks: of its postings with 1, 2, 3 to 4 and more occurrences the shortest
# document, and the most occurrences of the last two classes.
STEPS = (1, 2, 3, 5)
NO_LENGTH = (1 << 62) - 1
INDEX = (
    "shard long, term binary, block int, first int, last int, size int, peaks binary, docs binary, tfs binary"
)
RESULT = ("item_id", "rank", "doc_id", "score")
_ARROW = pa.schema([
    ("shard", pa.int64()), ("term", pa.binary()), ("block", pa.int32()), ("first", pa.int32()), ("last", pa.int32()),
    ("size", pa.int32()), ("peaks", pa.binary()), ("docs", pa.binary()), ("tfs", pa.binary()),
])


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits each, low bits first, the last of a number without the top bit; and bytes per number."""
    values = values.astype(np.uint64)
    sizes = np.ones(len(values), np.int64)
    for k in range(1, 10):
        sizes += values >= np.uint64(1 << (7 * k))
    ends = np.cumsum(sizes)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    for k in range(int(sizes.max()) if len(sizes) else 0):
        here = sizes > k
        part = ((values[here] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8)
        out[starts[here] + k] = part | np.where(sizes[here] > k + 1, 128, 0).astype(np.uint8)
    return out, sizes


def unpacked(data: bytes) -> np.ndarray:
    """The numbers that :func:`packed` wrote."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw) or raw.max() < 128:
        return raw.astype(np.int64)
    last = raw < 128
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


def _cells(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose cells are consecutive parts of ``flat``."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])


class _Shard:
    """Gathers documents and writes their postings, in blocks, as index rows."""

    def __init__(self, number: int, asked: dict[bytes, int] | None) -> None:
        self.number, self.asked = number, asked
        self.terms: dict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.found: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        words = ascii_terms(text)
        if not words:
            return  # has no postings, and counts in neither N nor L
        self.ids.append(doc_id)
        self.lengths.append(len(words))
        kept = words if self.asked is None else [w for w in words if w in self.asked]
        numbers = np.fromiter(map(self.terms.__getitem__, kept), np.int64, len(kept))
        found, times = np.unique(numbers, return_counts=True)
        self.found.append(found)
        self.times.append(times)
        self.held += len(found)

    def full(self) -> bool:
        return len(self.ids) >= SHARD_ROWS or self.held >= SHARD_TERMS

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        nulls = np.array([i is None for i in self.ids])
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        order = np.lexsort((ids, nulls))  # documents are numbered by id, so that ties are in order
        lengths = np.array(self.lengths, np.int64)[order]
        yield pa.record_batch(
            [[self.number], [b""], [0], [0], [len(ids) - 1], [len(ids)], [nulls[order].tobytes()], [ids[order].tobytes()], [lengths.tobytes()]],
            schema=_ARROW,
        )
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        term = np.concatenate(self.found)
        if not len(term):
            return
        doc = np.repeat(place, [len(f) for f in self.found])
        tf = np.concatenate(self.times)
        self.found, self.times = [], []
        by = np.argsort(term * len(ids) + doc)
        term, doc, tf = term[by], doc[by], tf[by]
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
        within = np.arange(len(term)) - np.repeat(first, np.diff(np.append(first, len(term))))
        starts = np.flatnonzero(within % BLOCK == 0)
        ends = np.append(starts[1:], len(term))
        gaps = np.diff(doc, prepend=0)
        gaps[starts] = 0
        columns = []
        for values in (gaps, tf - 1):
            flat, sizes = packed(values)
            columns.append((flat, np.cumsum(sizes)[ends - 1]))
        n = lengths[doc]
        peaks = []
        for k, least in enumerate(STEPS):
            inside = (tf >= least) & ((tf < STEPS[k + 1]) if k + 1 < len(STEPS) else True)
            peaks.append(np.minimum.reduceat(np.where(inside, n, NO_LENGTH), starts))
            if k >= 2:
                peaks.append(np.maximum.reduceat(np.where(inside, tf, 0), starts))
        words = list(self.terms)
        peaks = np.column_stack(peaks)
        yield pa.record_batch([
            pa.array(np.full(len(starts), self.number)),
            pa.array([words[t] for t in term[starts]], pa.binary()),
            pa.array((within[starts] // BLOCK).astype(np.int32)),
            pa.array(doc[starts].astype(np.int32)),
            pa.array(doc[ends - 1].astype(np.int32)),
            pa.array((ends - starts).astype(np.int32)),
            _cells(peaks, (np.arange(len(starts)) + 1) * peaks.shape[1] * 8),
            *[_cells(flat, upto) for flat, upto in columns],
        ], schema=_ARROW)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", asked: set[bytes] | None = None) -> DataFrame:
    """The inverted index of all ``docs``: one row per (shard, term, block of ``BLOCK`` postings).

    A row has the block's first and last document (numbered by id within the shard),
    the packed gaps and occurrences, and its peaks. The row of the empty term holds the
    shard's ids and lengths. A shard is what one task reads, cut at ``SHARD_ROWS`` rows or
    ``SHARD_TERMS`` postings, so building is one pass without a shuffle. ``asked`` (at most
    ``MOST_TERMS``) leaves postings of other terms out; lengths still count every term.
    Rows without a term (null, empty or only separators) are in no shard.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    wanted = None if asked is None else spark.sparkContext.broadcast(dict.fromkeys(asked))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = None if wanted is None else wanted.value
        task = TaskContext.get().partitionId() << 32
        made, shard = 0, _Shard(task, terms)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard.add(doc_id, text)
                if shard.full():
                    yield from shard.rows()
                    made += 1
                    shard = _Shard(task + made, terms)
        yield from shard.rows()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(shards, INDEX)


def weight(documents: int, holding: int) -> int:
    """Weight of a term that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class _List:
    """Postings of one term in a shard; blocks are unpacked when they are first needed."""

    def __init__(self, w: int, lengths: np.ndarray, scale: tuple[int, int], first, last, peaks, docs, tfs) -> None:
        self.w, self.lengths, self.scale = w, lengths, scale
        self.first, self.last, self.docs, self.tfs = first, last, docs, tfs
        peaks = np.frombuffer(b"".join(peaks), np.int64).reshape(len(docs), -1)
        best = np.zeros(len(docs), np.int64)
        for n, tf in ((0, 1), (1, 2), (2, peaks[:, 3]), (4, peaks[:, 5])):
            there = peaks[:, n] < NO_LENGTH
            best = np.where(there, np.maximum(best, self.impact(np.where(there, tf, 1), np.where(there, peaks[:, n], 1))), best)
        self.best = best
        self.bound = int(best.max())
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def impact(self, tf, n):
        total, words = self.scale
        m = 50 + (50 * n * total) // words
        return self.w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and what the term adds to their scores."""
        got = self.open.get(b)
        if got is None:
            docs = np.cumsum(unpacked(self.docs[b])) + self.first[b]
            got = self.open[b] = docs, self.impact(unpacked(self.tfs[b]) + 1, self.lengths[docs])
        return got

    def between(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Postings of the documents from ``low`` up to below ``high``."""
        for b in range(int(np.searchsorted(self.last, low)), int(np.searchsorted(self.first, high))):
            docs, adds = self.block(b)
            a, z = np.searchsorted(docs, (low, high))
            yield docs[a:z], adds[a:z]

    def adds(self, wanted: np.ndarray, so_far: np.ndarray, needed: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the documents ``wanted``, those that can come over ``needed`` by their block's maximum, and their scores.

        Blocks in which no such document lies stay packed.
        """
        b = np.searchsorted(self.last, wanted)
        b[b == len(self.last)] = 0  # beyond the last block: ``wanted`` is not inside block 0 either
        inside = (self.first[b] <= wanted) & (wanted <= self.last[b])
        able = so_far + np.where(inside, self.best[b], 0) > needed
        wanted, so_far, b, inside = wanted[able], so_far[able].copy(), b[able], inside[able]
        for one in np.unique(b[inside]).tolist():
            here = np.flatnonzero(inside & (b == one))
            docs, adds = self.block(one)
            at = np.minimum(np.searchsorted(docs, wanted[here]), len(docs) - 1)
            so_far[here] += np.where(docs[at] == wanted[here], adds[at], 0)
        return wanted, so_far


def best_of_shard(lists: list[_List], documents: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` best documents (number, score) of a shard, higher scores first, then lower numbers.

    Lists are in the order of their bounds. Those whose bounds add up to no more than
    the score of the last place are not essential: no document enters by them alone. The
    others are merged, window by window; a document they give goes on from list to list
    as long as the bounds of what is left, and its block's maximum, can lift it above the
    last place.
    """
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: x.bound)
    upto = np.cumsum([x.bound for x in lists])
    docs, scores, last = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for low in range(0, documents, WINDOW):
        high = min(low + WINDOW, documents)
        first = int(np.searchsorted(upto, last, side="right"))
        if first == len(lists):
            break
        sums = np.zeros(high - low, np.int64)
        for x in lists[first:]:
            for found, adds in x.between(low, high):
                sums[found - low] += adds
        wanted = np.flatnonzero(sums)
        so_far, wanted = sums[wanted], wanted + low
        for j in range(first - 1, -1, -1):
            able = so_far + upto[j] > last
            wanted, so_far = lists[j].adds(wanted[able], so_far[able], last - (int(upto[j - 1]) if j else 0))
        able = so_far > last
        docs, scores = np.concatenate([docs, wanted[able]]), np.concatenate([scores, so_far[able]])
        if len(docs) > most:
            kept = np.lexsort((docs, -scores))[:most]
            docs, scores = docs[kept], scores[kept]
        if len(docs) == most:
            last = int(scores.min())
    order = np.lexsort((docs, -scores))
    return docs[order], scores[order]


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", most: int = 50) -> DataFrame:
    """For each row of ``items`` its ``most`` best of all ``docs``: ``(item_id, rank, doc_id, score)``.

    Terms are the runs of ASCII letters, digits and other characters from U+0080 on, with
    A-Z in lower case. Scores are sums over an item's distinct terms; documents without a
    common term are not returned, equal scores go by ascending id (a null id last).

    The index is built once and staged; document frequencies, N and L are counted from
    it. Items are searched in blocks of about ``ASKED_TERMS`` terms, whose terms and
    weights, no more than that, are broadcast. Each shard gives ``most`` rows per item;
    these are merged per item in two steps, so no task gets the heaps of all shards.

    Null and empty texts, or texts of separators, have no terms: such a document is never
    found, such an item finds nothing. Rows are found by themselves: rows that repeat, or
    repeat an id, each take a rank, and each of two equal items gets its own ranks. A null
    item id stays null. An empty table gives no rows. Very long texts are indexed whole, one
    at a time. Other input columns do not matter; result columns are always these four.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    @F.pandas_udf("array<binary>")
    def distinct_terms(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([sorted(set(ascii_terms(t))) for t in batch])

    asked = items.select(F.col(f"`{item_col}`").alias("item_id"), distinct_terms(F.col(f"`{item_text}`")).alias("terms"))
    asked = staged(asked.withColumn("row", F.monotonically_increasing_id()), "search-items")
    wanted = asked.select(F.explode("terms").alias("term"))
    total = wanted.count()
    terms = wanted.distinct().limit(MOST_TERMS + 1).collect() if total else []
    index = build_index(docs, id_col, text_col, {bytes(r["term"]) for r in terms} if len(terms) <= MOST_TERMS else None)
    index = staged(index, "search-index")
    counts = index.filter(F.length("term") == 0).select(
        F.coalesce(F.sum("size"), F.lit(0)).alias("rows"), F.coalesce(F.sum(_total("tfs")), F.lit(0)).alias("words")
    ).first()
    parts = max(1, -(-total // ASKED_TERMS))
    found = [
        _search_part(index, asked.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part), counts["rows"], counts["words"], most)
        for part in range(parts)
    ]
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    # The heaps of some hundred shards at a time, then what is left of these.
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    near = Window.partitionBy("row", F.col("shard") % 211).orderBy(*order)
    every = every.withColumn("rank", F.row_number().over(near)).filter(F.col("rank") <= most)
    every = every.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).filter(F.col("rank") <= most)
    return every.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


@F.pandas_udf(LongType())
def _total(lengths: pd.Series) -> pd.Series:
    return pd.Series([int(np.frombuffer(x, np.int64).sum()) for x in lengths])


def _search_part(index: DataFrame, asked: DataFrame, documents: int, words: int, most: int) -> DataFrame:
    """The best documents of each shard for some items: ``(row, shard, doc_id, score)``."""
    spark = index.sparkSession
    items = {r["row"]: [bytes(t) for t in r["terms"]] for r in asked.select("row", "terms").collect()}
    terms = spark.createDataFrame([(t,) for t in {t for x in items.values() for t in x}], "term binary")
    holding = index.join(terms, "term", "left_semi").groupBy("term").agg(F.sum("size").alias("holding")).collect()
    weights = {bytes(r["term"]): weight(documents, r["holding"]) for r in holding}
    shared = spark.sparkContext.broadcast(({k: [t for t in v if t in weights] for k, v in items.items()}, weights))

    def best(rows: pd.DataFrame) -> pd.DataFrame:
        items, weights = shared.value
        rows = rows.sort_values(["term", "block"])
        head, rows = rows.iloc[0], rows.iloc[1:]
        ids, nulls = np.frombuffer(head["docs"], np.int64), np.frombuffer(head["peaks"], bool)
        lengths = np.frombuffer(head["tfs"], np.int64)
        lists = {
            bytes(term): _List(weights[bytes(term)], lengths, (documents, words), x["first"].to_numpy(), x["last"].to_numpy(),
                               x["peaks"].tolist(), x["docs"].tolist(), x["tfs"].tolist())
            for term, x in rows.groupby("term", sort=False)
        }
        out = []
        for row, terms in items.items():
            got, scores = best_of_shard([lists[t] for t in terms if t in lists], len(ids), most)
            id_ = pd.array(ids[got], dtype="Int64")
            id_[nulls[got]] = pd.NA
            out.append(pd.DataFrame({"row": row, "shard": head["shard"], "doc_id": id_, "score": scores}))
        return pd.concat(out, ignore_index=True)

    heads = F.length("term") == 0
    postings = index.filter(~heads).join(terms, "term", "left_semi").select(*index.columns)
    return index.filter(heads).union(postings).groupBy("shard").applyInPandas(best, "row long, shard long, doc_id long, score long")
