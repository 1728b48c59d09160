"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskline.llm.common import WORD, numbered, staged, text_of, without

MOST = 3  # copies of a document, and times a source's size its target may be
# Rows of a source whose copies are rounded together; more rows make more such blocks.
BLOCK = 256
# Starting points tried for the rounding of a source.
PHASES = 8
RESULT = ("size", "source_size", "target", "rate", "copies", "taken")


def words_in(column: str) -> Column:
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def targets(sources: DataFrame, weights: list[int]) -> DataFrame:
    """``(source, source_size)`` with ``target``: the weights share all sizes, no target above ``MOST`` sizes.

    The level at which the excess has been reshared is found in closed form: sources
    fill up in order of size per weight, and running sums give the level at which the
    rest shares what is left. Works on one row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    got = sources.withColumn("weight", share).withColumn("most", F.lit(float(MOST)) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    got = got.withColumn("full", F.coalesce(F.sum("most").over(upto), F.lit(0.0)))
    got = got.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    # The level if this source and all later ones stay open; the first source it does not overfill settles it.
    got = got.withColumn("level", (F.sum("source_size").over(everything) - F.col("full")) / F.col("open"))
    settled = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    level = F.first(settled, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    got = got.withColumn("settled", level)
    return got.select("source", "source_size", F.least("most", F.coalesce("settled", F.lit(0.0)) * F.col("weight")).alias("target"))


def _rate(tilt: Column, size: Column, mean: Column) -> Column:
    """exp(tilt * size / mean), at most ``MOST`` copies."""
    return F.least(F.lit(float(MOST)), F.exp(F.least(F.lit(50.0), F.greatest(F.lit(-700.0), tilt * size / mean))))


def tilts(counts: DataFrame, goals: DataFrame, rounds: int = 40, close: float = 1e-6) -> DataFrame:
    """``(source, tilt, mean)``: the solution of the dual of each source's entropy problem.

    The rates nearest to one copy each (in relative entropy) whose words meet the
    target are ``exp(tilt * size / mean)`` cut at ``MOST``; the tilt is the zero of
    a rising function of one number per source. Every round is one aggregation of
    the (source, size, rows) counts and a Newton step, kept inside a bracket that
    each round narrows. Only the largest remaining error reaches the driver.
    """
    mean = F.when(F.col("rows") > 0, F.greatest(F.col("source_size") / F.col("rows"), F.lit(1e-9)))
    state = goals.select(
        F.col("source").alias("__source"), "source_size", "target", mean.alias("mean"),
        F.lit(0.0).alias("tilt"), F.lit(-700.0).alias("low"), F.lit(700.0).alias("high"), F.lit(1.0).alias("error"),
    )
    state = staged(state, "mix-dual-0")
    for turn in range(1, rounds + 1):
        met = counts.join(state, F.col("source").eqNullSafe(F.col("__source")))
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"))
        words = F.col("size") * F.col("n") * rate
        bent = F.when(rate < MOST, words * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = met.groupBy("__source").agg(
            F.sum(words).alias("words"), F.sum(bent).alias("slope"),
            *[F.max(c).alias(c) for c in ("source_size", "target", "mean", "tilt", "low", "high")],
        )
        gap = F.col("words") - F.col("target")
        sums = sums.withColumn("low", F.when(gap < 0, F.col("tilt")).otherwise(F.col("low")))
        sums = sums.withColumn("high", F.when(gap > 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.col("tilt") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        middle = F.when(F.col("high") >= 700, F.col("low") + 2 + F.abs("low")).when(
            F.col("low") <= -700, F.col("high") - 2 - F.abs("high")
        ).otherwise((F.col("low") + F.col("high")) / 2)
        step = F.when(gap == 0, F.col("tilt")).when(inside, newton).otherwise(middle)
        error = F.when((F.col("target") > 0) & (F.col("tilt") < 690), F.abs(gap) / F.col("target")).otherwise(0.0)
        state = staged(
            sums.select(
                "__source", "source_size", "target", "mean",
                F.when(error > close, F.least(F.lit(699.0), step)).otherwise(F.col("tilt")).alias("tilt"), "low", "high", error.alias("error"),
            ),
            f"mix-dual-{turn}",
        )
        worst = state.agg(F.max("error").alias("e")).first()["e"]
        if worst is None or worst <= close:
            break
    return state.select("__source", "tilt", "mean")


def mix(
    docs: DataFrame, weights: list[int] = (5, 2, 1), id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", carry: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``rate``, ``copies`` and ``taken``, one row per input row.

    Sizes are counted in one pass over whole texts. Rates depend on source and size
    only, so the Newton rounds run on counts per (source, size), which are summed
    map-side. Rounding: in blocks of a source in order of size, copies follow the
    running sum of the rates, so the words taken stay within half a document of the
    rates' words per block; each source takes the one of ``PHASES`` starting points
    that comes nearest to its target. Blocks are cut by a hash of the id, so a hot source is many blocks.

    A null source is a source of its own, the last in order. Null and empty texts
    have size 0, take no words and get one copy. Repeated rows are rows of their
    own. If all sizes are 0, all targets are 0. The result depends on the rows only,
    not on their order. Columns named like a result column are replaced.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    sized = docs.select(
        *[F.col(f"`{c}`") for c in wanted], F.col(f"`{source_col}`").alias("__src"), F.col(f"`{id_col}`").alias("__id"),
        words_in(text_col).alias("size"),
    )
    sized = numbered(sized, "mix-sizes")
    counts = staged(sized.groupBy(F.col("__src").alias("source"), "size").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("rows"))
    totals = staged(totals, "mix-totals")
    goals = targets(totals.drop("rows"), list(weights)).withColumnRenamed("source", "__gs").drop("source_size")
    goals = staged(totals.join(goals, F.col("source").eqNullSafe(F.col("__gs"))).drop("__gs"), "mix-goals")
    dual = tilts(counts, goals)
    per = staged(goals.join(dual, F.col("source").eqNullSafe(F.col("__source"))).drop("__source"), "mix-sources").withColumnRenamed("source", "__gs")
    blocks = F.ceil(F.col("rows") / BLOCK)
    rated = sized.join(per, F.col("__src").eqNullSafe(F.col("__gs"))).select(
        *[F.col(f"`{c}`") for c in wanted], "__src", "__id", "__row", "size", "source_size", "target",
        F.when(F.col("size") > 0, _rate(F.col("tilt"), F.col("size"), F.col("mean"))).otherwise(1.0).alias("rate"),
        F.pmod(F.xxhash64("__id", "size"), blocks).alias("__block"),
    )
    part = F.col("rate") - F.floor("rate")
    order = Window.partitionBy("__src", "__block").orderBy("size", F.xxhash64("__id"), "__id", "__row")
    run = F.sum(part).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rated = rated.withColumn("__run", run).withColumn("__part", part)
    picks = F.array(*[
        (F.floor("rate") + F.floor(F.col("__run") + (k + 0.5) / PHASES) - F.floor(F.col("__run") - F.col("__part") + (k + 0.5) / PHASES)).cast("long")
        for k in range(PHASES)
    ])
    rated = staged(rated.withColumn("__picks", picks).drop("__run", "__part", "__block"), "mix-rounded")
    off = [F.abs(F.sum(F.get("__picks", F.lit(k)) * F.col("size")) - F.max("target")).alias(f"e{k}") for k in range(PHASES)]
    off = rated.groupBy(F.col("__src").alias("__gs")).agg(*off)
    best = F.array_position(F.array(*[f"e{k}" for k in range(PHASES)]), F.array_min(F.array(*[f"e{k}" for k in range(PHASES)])))
    phase = staged(off.select("__gs", (best - 1).cast("int").alias("__phase")), "mix-phases")
    got = rated.join(phase, F.col("__src").eqNullSafe(F.col("__gs"))).withColumn(
        "copies", F.least(F.lit(MOST), F.greatest(F.lit(0), F.get("__picks", F.col("__phase")))).cast("long")
    )
    got = got.withColumn("taken", F.col("copies") * F.col("size"))
    return without(got, "__src", "__id", "__row", "__picks", "__gs", "__phase")


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    repeated = mix(docs, **how).withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return without(repeated, *RESULT, "__copy")
