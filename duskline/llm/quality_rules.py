"""Quality rules whose thresholds come from quantile sketches per language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from duskline.llm.common import SPACE, numbered, staged, text_of, without

# Sketch buckets keep this many leading bits of a value, so that a bucket is at
# most 1/64 of its value wide and a group has at most a few thousand of them.
BITS = 7
# A group's sketch is merged with that of its language as if the latter had this many
# rows, and a language's likewise with that of all rows: small groups lean on it, large
# ones do not, and no size switches from one to the other.
PRIOR = 500
# Per rule, two percentiles, a factor and a floor: the fence is
# high + max(factor * (high - low), floor), in thousandths. Rules that are 0 for nearly
# all rows are judged by a percentile further up. Symbols are 0 or many, and a
# tenth of a source may be such junk, so its percentiles stay below that.
FENCES = {
    "symbols": (0.5, 0.75, 3, 60),
    "capitals": (0.5, 0.9, 4, 10),
    "same_lines": (0.5, 0.97, 4, 100),
    "repeats": (0.5, 0.97, 4, 50),
    "word_length": (0.5, 0.9, 4, 300),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RESULT = (*BASE, "n_lines", "n_capitals", *FENCES, "base_failed", "failed", "kept")


def _repeat_words() -> Column:
    """Words in 3-word windows that occur twice or more, from columns ``__h`` (window hashes) and ``__s``.

    ``__s`` holds (hash, place) in order, only for texts where a window recurs:
    equal windows are then neighbours, and their places mark the words.
    """
    twin = F.filter(
        "__s", lambda x, i: (F.get(F.col("__s"), i - 1)["h"] == x["h"]) | (F.get(F.col("__s"), i + 1)["h"] == x["h"])
    )
    return F.array_sort(F.transform(twin, lambda x: x["i"]))


def text_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts the rules use, from each whole text in one pass without a shuffle."""
    got = without(docs, *RESULT, "__t", "__w", "__h", "__s", "__p", "__l").withColumn("__t", text_of(text_col))
    got = got.withColumn("__w", F.filter(F.split("__t", f"{SPACE}+"), lambda w: w != ""))
    got = got.withColumn("__l", F.filter(F.split("__t", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    window = F.transform(
        F.sequence(F.lit(0), F.size("__w") - 3),
        lambda i: F.xxhash64(F.get(F.col("__w"), i), F.get(F.col("__w"), i + 1), F.get(F.col("__w"), i + 2)),
    )
    got = got.withColumn("__h", F.when(F.size("__w") >= 3, window).otherwise(F.array().cast("array<bigint>")))
    placed = F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    got = got.withColumn("__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), placed).otherwise(none))
    got = got.withColumn("__p", _repeat_words())
    reach = F.transform("__p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("__p"), i + 1) - p, F.lit(3))))
    words = F.array_join("__w", "")
    got = got.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(words).cast("long"),
            "n_symbols": (F.length("__t") - F.length(F.regexp_replace("__t", "[#*$%&|<>]+", ""))).cast("long"),
            "n_capitals": (F.length("__t") - F.length(F.regexp_replace("__t", r"\p{Lu}+", ""))).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "n_repeat_words": F.aggregate(reach, F.lit(0), lambda a, x: a + x).cast("long"),
        }
    )
    return got.drop("__t", "__w", "__h", "__s", "__p", "__l")


def _share(part: str, whole: str) -> Column:
    """Thousandths, as a whole number; 0 of nothing."""
    return F.when(F.col(whole) > 0, F.floor(1000 * F.col(part) / F.col(whole))).otherwise(0).cast("long")


def _ratios(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "symbols": _share("n_symbols", "n_words"),
            "capitals": _share("n_capitals", "word_chars"),
            "same_lines": _share("n_dup_lines", "n_lines"),
            "repeats": _share("n_repeat_words", "n_words"),
            "word_length": _share("word_chars", "n_words"),
        }
    )


def bucket(value: Column) -> Column:
    """The lower edge of the value's sketch bucket: its leading ``BITS`` bits."""
    width = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))).cast("long")
    return value - value % width


def sketches(measured: DataFrame) -> DataFrame:
    """Counts per (lang, source, rule, bucket): partial sums merge map-side, and groups merge by adding."""
    long = measured.select("lang", "source", F.explode(F.create_map(*[x for r in FENCES for x in (F.lit(r), F.col(r))])).alias("rule", "value"))
    return long.groupBy("lang", "source", "rule", bucket(F.col("value")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def _upto(cells: DataFrame, keys: list[str]) -> Column:
    """Rows of the group in this bucket or below."""
    return F.coalesce(F.sum("n").over(Window.partitionBy(*keys, "rule").orderBy("bucket")), F.lit(0))


def shares(counts: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Per (lang, source, rule, bucket of any group): the merged share of rows in this bucket or below.

    The share of all rows goes into that of a language, and the language's into that of a
    group, each as ``prior`` rows. Rows are groups times buckets, whatever the number of documents.
    """
    # Null is a group of its own: keys are marked so that plain equality finds them.
    marked = [F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(f"__{c}") for c in ("lang", "source")]
    counts = counts.select("*", *marked)
    every = counts.groupBy("rule", "bucket").agg(F.sum("n").alias("n"))
    every = every.join(counts.groupBy("rule").agg(F.sum("n").alias("total")), "rule")
    every = every.select("rule", "bucket", (_upto(every, []) / F.col("total")).alias("above"))

    def merged(part: DataFrame, keys: list[str], above: DataFrame) -> DataFrame:
        own = part.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))
        total = own.groupBy(*keys, "rule").agg(F.sum("n").alias("total"))
        on = [c for c in above.columns if c != "above"]
        cells = total.join(above, [c for c in on if c != "bucket"]).join(own, [*keys, "rule", "bucket"], "left")
        share = (_upto(cells, keys) + F.lit(float(prior)) * F.col("above")) / (F.col("total") + F.lit(float(prior)))
        return cells.select(*keys, "rule", "bucket", share.alias("above"))

    by_lang = merged(counts, ["__lang"], every)
    got = merged(counts, ["__lang", "__source"], by_lang)
    names = counts.select("lang", "source", "__lang", "__source").distinct()
    return got.join(names, ["__lang", "__source"]).select("lang", "source", "rule", "bucket", F.col("above").alias("share"))


def fences(counts: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per (lang, source) with an upper fence for each rule."""
    of_rule = {k: F.create_map(*[x for r, f in FENCES.items() for x in (F.lit(r), F.lit(f[k]))])[F.col("rule")] for k in range(4)}
    at = [F.min(F.when(F.col("share") >= of_rule[k], F.col("bucket"))).alias(name) for k, name in ((0, "low"), (1, "high"))]
    found = shares(counts, prior).groupBy("lang", "source", "rule").agg(*at)
    fence = F.col("high") + F.greatest(of_rule[2] * (F.col("high") - F.col("low")), of_rule[3].cast("long"))
    return found.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == r, fence)).alias(f"fence_{r}") for r in FENCES])


def quality_rules(docs: DataFrame, text_col: str = "text", prior: int = PRIOR, carry: list[str] | None = None) -> DataFrame:
    """``docs`` with the counts, ``base_failed``, ``failed`` (names of broken rules) and ``kept``, one row per input row.

    One pass measures every whole text and writes the measures. Rows that pass the
    base rules feed quantile sketches per (lang, source): integer log buckets with
    counts, added up map-side, so a source with a third of all rows costs each task
    a few thousand counters. The fences, one row per group, are joined back. A fence
    lies beyond an upper percentile by a multiple of that percentile's distance from the
    median (``FENCES``); small groups borrow from their language, by counts (``PRIOR``).

    ``carry`` names the input columns to keep (all by default). Null and empty texts
    have no words and fail the base rules. A null language or source is a group of
    its own. Input columns named like a result column are replaced. Repeated rows
    each get the same verdict. Empty input, empty result.
    """
    wanted = [c for c in (carry if carry is not None else docs.columns) if c.lower() not in RESULT]
    grouped = docs.withColumns({"__lang": F.col("lang"), "__source": F.col("source")})
    measured = _ratios(text_features(grouped, text_col)).select(
        *[F.col(f"`{c}`") for c in wanted], "__lang", "__source", *BASE, "n_lines", "n_capitals", *FENCES
    )
    measured = numbered(measured, "quality").withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    sound = measured.filter(~F.col("base_failed")).select(F.col("__lang").alias("lang"), F.col("__source").alias("source"), *FENCES)
    limits = staged(fences(staged(sketches(sound), "quality-sketches"), prior), "quality-fences")
    limits = limits.withColumnsRenamed({"lang": "__l", "source": "__s"})
    met = measured.join(limits, F.col("__lang").eqNullSafe(F.col("__l")) & F.col("__source").eqNullSafe(F.col("__s")), "left")
    broken = F.filter(F.array(*[F.when(F.col(r) > F.col(f"fence_{r}"), F.lit(r)) for r in FENCES]), lambda x: x.isNotNull())
    met = met.withColumn("failed", broken).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
    return without(met, "__lang", "__source", "__l", "__s", "__row", *[f"fence_{r}" for r in FENCES])
