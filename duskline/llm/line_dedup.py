"""Line dedup: repeated runs of lines through a suffix array built by distributed prefix doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskline.llm.common import WORD, staged, text_of, without

# A run of lines counts as repeated from this many words on. Shorter phrases that
# plain documents share stay.
LEAST_WORDS = 50
RESULT = ("n_lines", "n_removed_lines", "removed_runs")


def _ranked(counts: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The keys that occur more than once, with ranks in their order.

    A range sort of distinct keys: no key is in it twice, so no partition is hot.
    Row numbers of a sorted, range-partitioned frame rise with the keys.
    """
    order = counts.filter("n > 1").select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return staged(order.withColumn("rank", F.monotonically_increasing_id()), label)


def _numbered_lines(texts: DataFrame) -> DataFrame:
    """``(row, no, pos, w, h1, h2)``: the lines that hold a word, in order, without their text."""
    filled = F.filter(
        F.transform(F.split("text", "\n"), lambda x, i: F.struct(x.alias("x"), i.alias("pos"))),
        lambda s: F.regexp_like(s["x"], F.lit(WORD)),
    )
    lines = texts.select("id", "row", F.posexplode(filled).alias("no", "s"))
    return lines.select(
        "id", "row", "no", F.col("s.pos").alias("pos"), F.regexp_count("s.x", F.lit(WORD)).cast("long").alias("w"),
        F.xxhash64("s.x").alias("h1"), F.xxhash64(F.lit(1), "s.x").alias("h2"),
    )


def _windows(lines: DataFrame, least_words: int) -> DataFrame:
    """``(id, row, a, b, pa, pb)``: from each line the shortest run on and the shortest run back of ``least_words`` words.

    Every line of any run with that many words lies in one of these inside the run,
    so removing repeated ones removes exactly the lines of all repeated runs. Runs
    are found in running sums: ends and wanted sums are sorted together, and each
    wanted sum takes the last end before it.
    """
    upto = F.sum("w").over(Window.partitionBy("row").orderBy("no"))
    sums = lines.select("id", "row", "no", "pos", "w", upto.alias("c"))
    ends = F.struct("no", "pos")
    # Forward: the first line whose sum reaches the sum before this line plus the words asked for.
    on = sums.select("id", "row", "no", "pos", F.explode(F.array(
        F.struct(F.col("c").alias("v"), F.lit(0).alias("q")), F.struct((F.col("c") - F.col("w") + least_words).alias("v"), F.lit(1).alias("q")),
    )).alias("x")).select("id", "row", "no", "pos", "x.v", "x.q")
    falling = Window.partitionBy("row").orderBy(F.col("v").desc(), "q", F.col("no").desc()).rowsBetween(Window.unboundedPreceding, 0)
    on = on.withColumn("end", F.last(F.when(F.col("q") == 0, ends), ignorenulls=True).over(falling)).filter("q = 1 and end is not null")
    on = on.select("id", "row", F.col("no").alias("a"), F.col("end.no").alias("b"), F.col("pos").alias("pa"), F.col("end.pos").alias("pb"))
    # Back: the last line with a sum before it that leaves the words asked for.
    back = sums.select("id", "row", "no", "pos", F.explode(F.array(
        F.struct((F.col("c") - F.col("w")).alias("v"), F.lit(0).alias("q")), F.struct((F.col("c") - least_words).alias("v"), F.lit(1).alias("q")),
    )).alias("x")).select("id", "row", "no", "pos", "x.v", "x.q")
    rising = Window.partitionBy("row").orderBy("v", "q", "no").rowsBetween(Window.unboundedPreceding, 0)
    back = back.withColumn("end", F.last(F.when(F.col("q") == 0, ends), ignorenulls=True).over(rising)).filter("q = 1 and end is not null")
    back = back.select("id", "row", F.col("end.no").alias("a"), F.col("no").alias("b"), F.col("end.pos").alias("pa"), F.col("pos").alias("pb"))
    return on.union(back).distinct()


def repeated_runs(texts: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(row, runs)``: per text the maximal runs of lines to delete, as (first, last) places of lines.

    ``texts`` has ``id``, ``row`` and ``text``. Prefix doubling: the rank of a line
    comes from a sort of the lines, the rank of 2n lines from a sort of the pairs of
    ranks at a place and n lines on. Only what occurs twice has a rank and goes on,
    so rounds shrink. A run of ``least_words`` words has no more lines than words,
    which bounds the rounds by the logarithm of that number, whatever the texts.
    Runs with equal ranks at both ends (2^k lines from the start and to the end) are
    the intervals of the suffix array with that common prefix; of an interval's
    runs all but the earliest are deleted, and what overlaps or adjoins is joined to
    maximal runs.
    """
    lines = staged(_numbered_lines(texts), "lines")
    firsts = _ranked(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")), ["h1", "h2"], "lines-rank-0")
    level = staged(lines.select("row", "no", "h1", "h2").join(firsts, ["h1", "h2"]).select("row", "no", "rank"), "lines-level-0")
    spans = staged(_windows(lines, least_words).withColumn("size", F.col("b") - F.col("a") + 1), "lines-windows")
    longest = spans.agg(F.max("size").alias("m")).first()["m"] or 0
    named, k = [], 0
    while (1 << k) <= longest:
        step = 1 << k
        own = spans.filter((F.col("size") >= step) & (F.col("size") < 2 * step))
        head = level.select("row", F.col("no").alias("a"), F.col("rank").alias("ra"))
        met = own.join(head, ["row", "a"])
        if step > 1:
            tail = level.select("row", (F.col("no") + step - 1).alias("b"), F.col("rank").alias("rb"))
            met = met.join(tail, ["row", "b"])
        else:
            met = met.withColumn("rb", F.col("ra"))
        named.append(met.select("id", "row", "a", "b", "pa", "pb", "size", "ra", "rb"))
        k += 1
        if (1 << k) > longest:
            break
        ahead = Window.partitionBy("row").orderBy("no").rangeBetween(step, step)
        pairs = staged(level.withColumn("next", F.max("rank").over(ahead)).filter("next is not null"), f"lines-pairs-{k}")
        ranks = _ranked(pairs.groupBy(F.col("rank").alias("r1"), F.col("next").alias("r2")).agg(F.count(F.lit(1)).alias("n")), ["r1", "r2"], f"lines-rank-{k}")
        level = staged(
            pairs.join(ranks.withColumnRenamed("rank", "named"), (pairs["rank"] == F.col("r1")) & (F.col("next") == F.col("r2"))).select(
                "row", "no", F.col("named").alias("rank")
            ),
            f"lines-level-{k}",
        )
    if not named:
        return spans.select("row", F.array(F.struct("pa", "pb")).alias("runs")).limit(0)
    found = named[0]
    for more in named[1:]:
        found = found.union(more)
    found = staged(found, "lines-named")
    key = ["size", "ra", "rb"]
    origin = staged(found.groupBy(*key).agg(F.min(F.struct("id", "row", "a")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "lines-intervals")
    later = found.join(origin, key).filter(F.struct("id", "row", "a") != F.col("first")).select("row", "a", "b", "pa", "pb")
    before = Window.partitionBy("row").orderBy("a", "b")
    reach = F.max("b").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opened = later.withColumn("fresh", F.when(F.col("a") <= reach + 1, 0).otherwise(1))
    runs = opened.withColumn("run", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy("row", "run").agg(F.min("pa").alias("pa"), F.max("pb").alias("pb"))
    return runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("pa", "pb"))).alias("runs"))


def _rest(lines: Column, runs: Column) -> Column:
    """The lines outside the runs."""
    after = F.sequence(F.lit(0), F.size(runs))

    def piece(i: Column) -> Column:
        start = F.coalesce(F.get(runs, i - 1)["pb"] + 1, F.lit(0))
        end = F.coalesce(F.get(runs, i)["pa"], F.size(lines))
        return F.slice(lines, start + 1, F.greatest(end - start, F.lit(0)))

    return F.flatten(F.transform(after, piece))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``docs`` with the text without later copies of repeated line runs, one row per input row.

    A line goes if it lies in a run of consecutive lines with at least
    ``least_words`` words that also stands earlier: in a document with a smaller id,
    or further up in the same one. Lines are compared whole; lines without a word
    are passed over, and go where the lines around them both go. ``n_lines`` (before),
    ``n_removed_lines`` and ``removed_runs`` (first and last line, from 0) are added.

    Only hashes and numbers of lines are shuffled, texts once for the last join. A
    line that a third of all documents share is counted map-side and joined in parts
    that Spark may split. Null ids come last in order, equal ids by row number. A
    null text stays null; an empty one has one empty line. A text may lose all its
    lines; its row stays. ``carry`` names the input columns to keep besides the text
    (all by default); one named like a result column is replaced.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT and c != text_col]
    own = docs.select(
        *[F.col(f"`{c}`") for c in wanted], F.col(f"`{text_col}`").cast("string").alias("__text"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)).alias("__id"), F.monotonically_increasing_id().alias("__row"),
    )
    own = staged(own, "lines-texts")
    runs = staged(repeated_runs(own.select(F.col("__id").alias("id"), F.col("__row").alias("row"), text_of("__text").alias("text")), least_words), "lines-runs")
    got = own.join(runs.select(F.col("row").alias("__of"), F.col("runs").alias("removed_runs")), F.col("__row") == F.col("__of"), "left")
    got = got.withColumn("__lines", F.split(text_of("__text"), "\n"))
    rest = F.array_join(_rest(F.col("__lines"), F.col("removed_runs")), "\n")
    gone = F.aggregate("removed_runs", F.lit(0).cast("long"), lambda a, x: a + x["pb"] - x["pa"] + 1)
    none = F.array().cast(runs.schema["runs"].dataType)
    got = got.select(
        *[F.col(f"`{c}`") for c in wanted],
        F.when(F.col("removed_runs").isNull(), F.col("__text")).otherwise(rest).alias(text_col),
        F.size("__lines").cast("long").alias("n_lines"), F.coalesce(gone, F.lit(0).cast("long")).alias("n_removed_lines"),
        F.coalesce("removed_runs", none).alias("removed_runs"),
    )
    return got


def shortened_rows(docs: DataFrame, **how) -> DataFrame:
    """The documents with their own columns, in their order, and the shorter text."""
    return without(line_dedup(docs, **how), *RESULT).select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT])
