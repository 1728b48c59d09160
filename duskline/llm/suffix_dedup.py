"""Removal of repeated passages through the interval tree of an enhanced suffix array.

Texts are bytes. A repeat is a string of ``LENGTH`` bytes that starts at two places
or more; every byte under a copy that starts later (by document, then place) goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskline.llm.common import bounded_batches, staged, text_of

LENGTH = 100
GRAM = 20  # bytes whose hash picks the anchor of a string
_FIRST, _SECOND, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
RESULT = ("kept_bytes", "n_bytes", "n_removed", "n_spans")


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _stirred(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def window_hashes(data: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """A hash of every ``width`` bytes, by doubling: the hash of 2n bytes comes from two hashes of n bytes."""
    part, size = _stirred(data.astype(np.uint64) + np.uint64(1)), 1
    total, covered = None, 0
    bits = width
    while True:
        if bits & 1:
            if total is None:
                total, covered = part, size
            else:
                n = len(total) - size
                total = _stirred(total[:n] * base + part[covered : covered + n]) if n > 0 else total[:0]
                covered += size
        bits >>= 1
        if not bits:
            return total[: max(0, len(data) - width + 1)]
        n = len(part) - size
        part = _stirred(part[:n] * base + part[size : size + n]) if n > 0 else part[:0]
        size *= 2


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` hashes, the place of its smallest one, the first if several are equal."""
    # Sparse-table minimum over places ordered by (hash, place).
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    level, best = 1, np.arange(len(hashes))
    while level * 2 <= width:
        a, b = best[: len(best) - level], best[level:]
        best = np.where(hashes[b] < hashes[a], b, a)
        level *= 2
    a, b = best[:n], best[width - level : width - level + n]
    return np.where(hashes[b] < hashes[a], b, a)


def super_strings(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text's strings of ``length`` bytes in stretches with one anchor.

    Every string's anchor is its gram with the smallest hash. Equal strings have equal
    anchors at equal places, and the strings with one anchor are a stretch of
    neighbours. Returns per stretch: hash of the anchor, hash of the stretch's bytes,
    first string, number of strings.
    """
    none = np.zeros(0, dtype=np.uint64)
    if len(data) < length:
        return none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = window_hashes(data, gram, _FIRST)
    at = anchors(grams, length - gram + 1)
    starts = np.concatenate([[0], np.nonzero(np.diff(at))[0] + 1])
    counts = np.diff(np.append(starts, len(at)))
    # Hash of each stretch's bytes: sums of stirred bytes times powers, brought to a common start.
    powers = _powers(_SECOND, len(data))
    inverse = _powers(np.uint64(pow(int(_SECOND), -1, 1 << 64)), len(data))
    summed = np.concatenate([[np.uint64(0)], np.cumsum(window_hashes(data, 4, _FIRST) * powers[: len(data) - 3])])
    ends = starts + counts + length - 1
    body = (summed[ends - 3] - summed[starts]) * inverse[starts]
    body = _stirred(_stirred(body) + counts.astype(np.uint64) * _FIRST + (at[starts] - starts).astype(np.uint64) * _MIX)
    return grams[at[starts]], body, starts, counts


def suffix_array(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of fixed-width strings (rows of bytes), and the length of the common prefix of each with the one before."""
    width = strings.shape[1]
    order = np.argsort(np.ascontiguousarray(strings).view(f"V{width}").ravel(), kind="stable") if len(strings) else np.zeros(0, np.int64)
    rows = strings[order]
    common = np.zeros(len(rows), dtype=np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, common


def intervals(common: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """The nodes ``(depth, first, last)`` of the common-prefix interval tree at ``least`` and deeper, by a scan with a stack."""
    stack: list[tuple[int, int]] = []  # (depth, first)
    for i in range(1, len(common) + 1):
        depth = int(common[i]) if i < len(common) else 0
        first = i - 1
        while stack and stack[-1][0] > depth:
            deep, first = stack.pop()
            if deep >= least:
                yield deep, first, i - 1
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def repeat_groups(
    context: list[bytes], counts: np.ndarray, before: np.ndarray, length: int = LENGTH
) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
    """All repeat groups among the strings of stretches, with all their occurrences.

    ``context[k]`` holds stretch ``k``'s bytes, ``counts[k]`` its strings, ``before[k]``
    the byte before it (-1: none). Strings whose hash is single are left out; the
    others are suffixes of an enhanced suffix array, compared byte by byte. The
    nodes of its interval tree are the groups of equal strings. Yields (depth,
    whether the bytes before differ, stretch and string of each occurrence). Where
    all bytes before are equal, the group is the inside of a repeat that reaches
    further left and so is not maximal.
    """
    which = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    flat = np.frombuffer(b"".join(context), dtype=np.uint8)
    sizes = np.fromiter(map(len, context), np.int64, len(context))
    at = (np.cumsum(sizes) - sizes)[which] + inner
    hashes = window_hashes(flat, length, _FIRST)[at]
    _, back, seen = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = np.nonzero(seen[back] > 1)[0]
    which, inner, at = which[twice], inner[twice], at[twice]
    ranked, common = suffix_array(flat[at[:, None] + np.arange(length)])
    left = np.where(inner > 0, flat[np.maximum(at - 1, 0)].astype(np.int64), before[which])
    for depth, first, last in intervals(common, length):
        members = ranked[first : last + 1]
        ahead = left[members]
        yield depth, bool((ahead != ahead[0]).any() or ahead[0] < 0), which[members], inner[members]


def _later_strings(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Strings of these stretches that also start earlier, as runs ``(row, start, count)``."""
    context, counts = frame["context"].tolist(), frame["count"].to_numpy()
    ids, rows, starts = (frame[c].to_numpy() for c in ("id", "row", "start"))
    gone: list[np.ndarray] = []
    for _, _, stretch, string in repeat_groups(context, counts, frame["before"].to_numpy(), length):
        place = starts[stretch] + string
        order = np.lexsort((place, rows[stretch], ids[stretch]))[1:]
        gone.append(np.stack([rows[stretch][order], place[order]], axis=1))
    if not gone:
        return pd.DataFrame({"row": [], "start": [], "count": []}, dtype=np.int64)
    found = np.unique(np.concatenate(gone), axis=0)
    head = np.ones(len(found), dtype=bool)
    head[1:] = (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 1)
    first = np.nonzero(head)[0]
    return pd.DataFrame({"row": found[first, 0], "start": found[first, 1], "count": np.diff(np.append(first, len(found)))})


def cut_out(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many are inside, and the number of maximal removed runs."""
    kept, removed, runs, at, end = [], 0, 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            kept.append(data[at:a])
            runs += 1
            removed += b - a
        else:
            removed += max(0, b - end)
        end = at = max(end, b)
    kept.append(data[at:])
    return b"".join(kept), removed, runs


SEEN = 500_000  # stretches a task remembers, to send a copy on only once


def _stretches(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(h, c, id, row, start, count, sure)``: the stretches of all texts of ``length`` bytes or more.

    Of equal stretches that one task meets, only those smaller than all before are
    sent on; the others are ``sure`` to be copies. So a text that holds a third of
    all rows sends a few rows per task, whatever the size of its group.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, tuple[int, int, int]] = {}
        for batch in batches:
            parts: list[tuple[np.ndarray, ...]] = []
            for key, row, text in zip(batch["id"].to_numpy(), batch["row"].to_numpy(), batch["text"]):
                h, c, starts, counts = super_strings(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), length, gram)
                if len(h):
                    parts.append((h, c, np.full(len(h), key), np.full(len(h), row), starts, counts))
            if not parts:
                continue
            h, c, ids, rows, starts, counts = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((starts, rows, ids, c))
            h, c, ids, rows, starts, counts = (x[order] for x in (h, c, ids, rows, starts, counts))
            sure = np.zeros(len(c), dtype=bool)
            sure[1:] = c[1:] == c[:-1]
            first = np.nonzero(~sure)[0]
            if len(seen) > SEEN:
                seen.clear()
            for k, body, place in zip(first.tolist(), c[first].tolist(), zip(ids[first].tolist(), rows[first].tolist(), starts[first].tolist())):
                known = seen.get(body)
                if known is not None and known < place:
                    sure[k] = True
                else:
                    seen[body] = place
            # Copies need no neighbours: they go wherever their row's hash sends them, without what is not asked of them.
            h = np.where(sure, _stirred(rows.astype(np.uint64)), h)
            c, ids = np.where(sure, np.uint64(0), c), np.where(sure, 0, ids)
            yield pd.DataFrame(
                {"h": h.view(np.int64), "c": c.view(np.int64), "id": ids, "row": rows, "start": starts, "count": counts.astype(np.int32), "sure": sure}
            )

    return texts.select("id", "row", "text").mapInPandas(cut, "h long, c long, id long, row long, start long, count int, sure boolean")


def _contexts(texts: DataFrame, reps: DataFrame, length: int) -> DataFrame:
    """The stretches in ``reps`` with their bytes and the byte before."""
    listed = reps.groupBy(F.col("row").alias("of")).agg(F.collect_list(F.struct("h", "start", "count")).alias("found"))

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, row, text, found in zip(batch["id"], batch["row"], batch["text"], batch["found"]):
                data = text.encode("utf-8", "surrogatepass")
                for x in found:
                    a, n = x["start"], x["count"]
                    out.append((x["h"], key, row, a, n, data[a : a + n + length - 1], data[a - 1] if a else -1))
            yield pd.DataFrame(out, columns=["h", "id", "row", "start", "count", "context", "before"])

    met = texts.join(listed, texts["row"] == listed["of"]).select("id", "row", "text", "found")
    return met.mapInPandas(take, "h long, id long, row long, start long, count long, context binary, before int")


def _tree_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Later copies among stretches with one anchor: they meet in order of the anchor's hash."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            held.append(batch)
            # An anchor's stretches are worked on together, once the next anchor begins.
            last = batch["h"].iloc[-1]
            if batch["h"].iloc[0] == last and held[0]["h"].iloc[0] == last or sum(map(len, held)) < 5000:
                continue
            frame = pd.concat(held, ignore_index=True)
            whole = int(np.argmax(frame["h"].to_numpy() == last))
            held = [frame.iloc[whole:]]
            if whole:
                yield _later_strings(frame.iloc[:whole], length)
        if held:
            yield _later_strings(pd.concat(held, ignore_index=True), length)

    together = contexts.repartition(F.col("h")).sortWithinPartitions("h")
    return together.mapInPandas(scan, "row long, start long, count long")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``docs`` with ``kept_bytes``, ``n_bytes``, ``n_removed`` and ``n_spans``, one row per input row.

    1. Each whole text's strings of ``length`` bytes are taken in stretches with one
       anchor (their smallest gram), about one row per 40 bytes. Equal strings lie in
       stretches with equal anchors.
    2. Rows shuffle on the anchor. A stretch that equals an earlier one is a copy as a
       whole. Anchors with one kind of stretch are then done.
    3. Where an anchor has several kinds, the first of each kind brings its bytes. Its
       strings are the suffixes of an enhanced suffix array, and the nodes of its
       common-prefix interval tree are the repeat groups with all occurrences; all but
       the earliest go. Only these few per cent of the texts are ever suffixes.
    4. The removed places of a text are joined back and cut out.

    Earlier means the smaller id, then the earlier start; null ids come last, rows with
    equal ids follow their row number. A null text is empty. Texts shorter than
    ``length`` bytes keep all. Kept bytes need not be whole characters. ``carry`` names
    the input columns to keep (all by default); one named like a result column is
    replaced. No rows give no rows.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    spark = docs.sparkSession
    bounded_batches(spark, 500)
    last = F.lit((1 << 63) - 1)
    own = docs.select(
        *[F.col(f"`{c}`") for c in wanted], F.coalesce(F.col(f"`{id_col}`").cast("long"), last).alias("__id"), text_of(text_col).alias("__text")
    )
    own = staged(own.withColumn("__row", F.monotonically_increasing_id()), "repeats-texts")
    texts = own.select(F.col("__id").alias("id"), F.col("__row").alias("row"), F.col("__text").alias("text"))
    order = ["id", "row", "start"]
    rows = _stretches(texts.filter(F.octet_length("text") >= length), length, gram).repartition(F.col("h"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("h", "c").orderBy(*order)))
    alike = Window.partitionBy("h")
    rows = rows.withColumn("mixed", F.min("c").over(alike) != F.max("c").over(alike))
    copy = F.col("sure") | (F.col("nth") > 1)
    found = staged(rows.filter(copy | F.col("mixed")).select("h", "row", "start", "count", copy.alias("copy")), "repeats-stretches")
    contexts = _contexts(texts, found.filter("not copy"), length)
    tree = staged(_tree_spans(contexts, length), "repeats-tree")
    spans = found.filter("copy").select("row", "start", F.col("count").cast("long").alias("count")).union(tree.select("row", "start", "count"))
    spans = spans.groupBy(F.col("row").alias("__of")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("count") + length - 1).alias("b")))).alias("__spans")
    )

    @F.pandas_udf("kept_bytes binary, n_bytes long, n_removed long, n_spans long")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for some, lists in batches:
            out = []
            for text, found in zip(some, lists):
                data = text.encode("utf-8", "surrogatepass")
                kept, removed, runs = cut_out(data, [(x["a"], x["b"]) for x in found] if found is not None else [])
                out.append((kept, len(data), removed, runs))
            yield pd.DataFrame(out, columns=["kept_bytes", "n_bytes", "n_removed", "n_spans"])

    got = own.join(spans, F.col("__row") == F.col("__of"), "left").withColumn("__cut", cut("__text", "__spans"))
    return got.select(*[F.col(f"`{c}`") for c in wanted], "__cut.*")
