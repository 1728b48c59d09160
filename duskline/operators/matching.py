"""Matching notices with the technologies and assets they affect.

A notice names a family and, optionally, a runtime and a version; a blank one is
a wildcard. As a plain condition that leaves the family, with its handful of
values, as the only equi key. Instead every distinct technology triple is listed
under the four keys a notice can ask for (runtime or any) x (version or any).
A notice has exactly one of those keys, so one equi join finds each pair once,
and it runs on the distinct triples and the distinct notice patterns, not on
assets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskline.functions.keys import technology_sk
from duskline.functions.text import is_blank
from duskline.operators.skew import HOT_MIN_ROWS, HOT_SHARE, hot_keys, salted_join, tasks_for, total_rows

TRIPLE = ["technology_family", "runtime_name", "runtime_version"]
TOKENS = ["__token_family", "__token_name", "__token_version"]
PATTERN = ["__family", "__name", "__version"]
# Markers in front of a value; a bare ANY is the wildcard.
ANY, IS = "*", "="

# Our own mapping from the families technologies are detected with to the
# families notices are classified into. Without it the two never meet.
FAMILY_CROSSWALK = {
    "container_orchestration": "containers",
    "app_runtime": "compute",
    "virtual_machine": "compute",
    "database": "data",
    "storage_config": "storage",
    "key_vault_config": "security",
}


def crosswalk_family(df: DataFrame, mapping: dict[str, str] | None = None, column: str = "technology_family") -> DataFrame:
    """Replace detected families by the notice family they belong to; others stay."""
    pairs = [F.lit(x) for item in (mapping or FAMILY_CROSSWALK).items() for x in item]
    return df.withColumn(column, F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(column)), F.col(column)))


def _asked(c: str) -> Column:
    """Key part a notice asks for."""
    return F.when(is_blank(c), F.lit(ANY)).otherwise(F.concat(F.lit(IS), F.lower(c)))


def _offered(c: str) -> Column:
    """Key parts a technology can be asked for by."""
    return F.array_compact(F.array(F.lit(ANY), F.concat(F.lit(IS), F.lower(c))))


def notice_patterns(notices: DataFrame) -> DataFrame:
    """Notices with the three key parts they ask for; a null family matches nothing."""
    return notices.filter(F.col("technology_family").isNotNull()).select(
        "*",
        F.lower("technology_family").alias("__family"),
        _asked("affected_runtime").alias("__name"),
        _asked("affected_version").alias("__version"),
    )


def technology_offers(triples: DataFrame) -> DataFrame:
    """Each triple once under every key a notice may ask for it by."""
    offers = triples.filter(F.col("technology_family").isNotNull()).select(
        "*", F.lower("technology_family").alias("__family"), F.explode(_offered("runtime_name")).alias("__name")
    )
    return offers.select("*", F.explode(_offered("runtime_version")).alias("__version"))


def with_tokens(df: DataFrame) -> DataFrame:
    """The triple as three non-null columns, so that joins on it are plain equi joins."""
    return df.select("*", *[F.coalesce(F.concat(F.lit(IS), F.col(c)), F.lit("")).alias(t) for c, t in zip(TRIPLE, TOKENS)])


def triple_counts(technology: DataFrame) -> DataFrame:
    """The distinct triples with the number of technology rows on each, combined map-side.

    Everything that matches or looks for hot keys starts from this one
    aggregation, so Spark computes it once and reuses its shuffle.
    """
    return technology.groupBy(*TRIPLE).agg(F.count(F.lit(1)).alias("technology_rows"))


def notice_classes(notices: DataFrame, key: str = "deprecation_sk") -> DataFrame:
    """``(key, notice_class)``: notices that ask for the same set of patterns are of one class.

    A class is named by the smallest key in it. Sets are compared by their size and two
    64-bit hashes, which add up map-side, so no set is gathered anywhere. Rows with a null
    family ask for nothing.
    """
    asked = notice_patterns(notices).select(key, *PATTERN).distinct()
    hashes = [F.bit_xor(F.xxhash64(F.lit(seed), *PATTERN)).alias(f"__h{seed}") for seed in (1, 2)]
    sets = asked.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *hashes)
    alike = ["__n", "__h1", "__h2"]
    return sets.join(sets.groupBy(*alike).agg(F.min(key).alias("notice_class")), alike).select(key, "notice_class")


def class_technologies(notices: DataFrame, classes: DataFrame, triples: DataFrame, key: str = "deprecation_sk") -> DataFrame:
    """``(notice_class, technology_sk)`` once each: the technologies that the patterns of a class cover.

    Only the patterns of one notice per class meet the offers, so rows grow with
    distinct pattern sets times what they cover, not with notices. A technology that
    a class covers by several patterns, or with several spellings, counts once.
    """
    asked = notice_patterns(notices).select(key, *PATTERN).distinct()
    asked = asked.join(classes.filter(F.col(key) == F.col("notice_class")), key).select("notice_class", *PATTERN)
    offers = technology_offers(triples).select("technology_sk", *PATTERN).distinct()
    return asked.join(offers, PATTERN).select("notice_class", "technology_sk").distinct()


# Matches of one pattern that one task may put out; a pattern with more is split.
ROWS_PER_PART = 100_000


def match_triples(notices: DataFrame, triples: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Every (notice, triple) the notice covers: the triple columns and the notice columns.

    ``triples`` has distinct rows and may carry more columns than the triple.
    Notices that ask for the same thing are matched once and spread out after. A
    notice that leaves everything open asks for a whole family, so a pattern can
    stand for very many matches: it is cut into parts by a hash of the triple, as
    many as its notices times its triples need, and its notices are repeated per part.
    The parts are dealt over as many tasks as their matches need; the sum of these is
    counted when the plan is made.
    """
    asked = notice_patterns(notices)
    offers = technology_offers(triples)
    counted = asked.groupBy(*PATTERN).agg(F.count(F.lit(1)).alias("__asked")).join(
        offers.groupBy(*PATTERN).agg(F.count(F.lit(1)).alias("__offered")), PATTERN
    )
    met = counted.select((F.col("__asked") * F.col("__offered")).alias("matches"))
    tasks = tasks_for(triples.sparkSession, total_rows(met, "matches"))
    parts = F.least(F.col("__offered"), F.ceil(F.col("__asked") * F.col("__offered") / rows_per_part))
    counted = counted.select(*PATTERN, F.greatest(parts, F.lit(1)).cast("long").alias("__parts"))
    part = F.pmod(F.xxhash64(*TRIPLE), F.col("__parts"))
    pairs = offers.join(counted, PATTERN).withColumn("__part", part).drop("__parts")
    keep = [c for c in notices.columns if c not in TRIPLE]
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1))
    spread = asked.select(*PATTERN, *keep).join(counted, PATTERN).withColumn("__part", every).drop("__parts")
    on = [*PATTERN, "__part"]
    return pairs.repartition(tasks, *on).join(spread.repartition(tasks, *on), on).select(*triples.columns, *keep)


def asked_counts(notices: DataFrame, triples: DataFrame) -> DataFrame:
    """``triples`` that are asked for, with ``notices``, the number of notice rows that cover each."""
    asked = notice_patterns(notices).groupBy(*PATTERN).agg(F.count(F.lit(1)).alias("__asked"))
    met = technology_offers(triples).join(asked, PATTERN)
    return met.groupBy(*triples.columns).agg(F.sum("__asked").alias("notices"))


# Technology rows of one triple that meet a notice together.
ROWS_PER_LIST = 64


def listed_rows(technology: DataFrame, counts: DataFrame, min_rows: int = HOT_MIN_ROWS, per_list: int = ROWS_PER_LIST) -> DataFrame:
    """Technology rows of the triples in ``counts``, gathered in ``__rows``: the triple, its tokens, ``__list`` and what else a row has.

    ``counts`` has ``technology_rows`` and ``matches`` of each triple. Rows are dealt over lists by a hash: a
    triple has a list per ``per_list`` rows, and more where it has so many matches that they are salted.
    """
    other = [c for c in technology.columns if c not in TRIPLE]
    rows, matches = F.col("technology_rows"), F.col("matches")
    lists = F.least(rows, F.greatest(F.ceil(rows / per_list), F.ceil(matches / F.lit(float(max(min_rows, 1))))))
    dealt = with_tokens(technology).join(counts.select(*TOKENS, lists.alias("__lists")), TOKENS)
    # A row that is nothing but its triple is still a row of the list.
    row = F.struct(*other) if other else F.struct(F.lit(True).alias("__row"))
    number = F.pmod(F.xxhash64(*(other or TRIPLE)), F.col("__lists"))
    return dealt.withColumn("__list", number).groupBy(*TRIPLE, *TOKENS, "__list").agg(F.collect_list(row).alias("__rows"))


def wildcard_match(
    notices: DataFrame,
    technology: DataFrame,
    share: float = HOT_SHARE,
    min_rows: int = HOT_MIN_ROWS,
) -> DataFrame:
    """Notice x technology rows: same family, and runtime and version equal or left open by the notice.

    The output carries the technology columns and the notice columns other than
    the family. What a triple costs is its technology rows times its notices: one with a
    large share of all matches is salted over several tasks, and the number of tasks
    follows the matches, which are counted per triple when the plan is made.
    Technology rows of a triple meet a notice as a list, so the join itself has a row per
    notice and list; matches are made from it last.
    """
    triples = with_tokens(triple_counts(technology))
    few = match_triples(notices, triples).drop(*TRIPLE, "technology_rows")
    counts = asked_counts(notices, triples).withColumn("matches", F.col("technology_rows") * F.col("notices"))
    tasks = tasks_for(technology.sparkSession, total_rows(counts, "matches"))
    hot = hot_keys(counts, TOKENS, "matches", share, min_rows)
    met = salted_join(listed_rows(technology, counts, min_rows), few, TOKENS, hot, ["__list"], tasks)
    asked = [c for c in few.columns if c not in TOKENS]
    return met.select(*TRIPLE, *asked, F.inline("__rows")).select(*technology.columns, *asked)


def wildcard_match_condition(notices: DataFrame, technology: DataFrame) -> DataFrame:
    """The same rows from the plain join condition. For checks on small frames."""
    n = notices.withColumnRenamed("technology_family", "__notice_family")
    open_or_equal = lambda asked, has: is_blank(asked) | (F.lower(asked) == F.lower(has))
    on = (
        (F.lower("__notice_family") == F.lower("technology_family"))
        & open_or_equal("affected_runtime", "runtime_name")
        & open_or_equal("affected_version", "runtime_version")
    )
    return technology.join(n, on).drop("__notice_family")


def match_to_asset(matches: DataFrame, assets: DataFrame) -> DataFrame:
    """Matches of resources that are known assets, with the asset key."""
    known = assets.select("asset_sk", F.col("native_resource_id").alias("resource_id"))
    return matches.join(known, "resource_id")


def attach_event(matches: DataFrame, events: DataFrame) -> DataFrame:
    """Add retirement_at, severity and status of the notice; a match without an event keeps nulls."""
    return matches.join(events.select("deprecation_sk", "retirement_at", "severity", "status"), "deprecation_sk", "left")


def technology_lookup(dim_technology: DataFrame) -> DataFrame:
    """The dimension keyed by its folded triple, one row each: the smallest source wins."""
    folded = dim_technology.select(
        *[F.lower(c).alias(c) for c in TRIPLE],
        F.struct("technology_source", "technology_sk").alias("__candidate"),
    )
    return folded.groupBy(*TRIPLE).agg(F.min("__candidate")["technology_sk"].alias("technology_sk"))


def lookup_technology(df: DataFrame, dim_technology: DataFrame) -> DataFrame:
    """Add technology_sk from the dimension by the folded triple (null equals null), else the hash of the triple."""
    dim = technology_lookup(dim_technology).select(
        *[F.col(c).alias(f"__{c}") for c in TRIPLE], F.col("technology_sk").alias("__dim_sk")
    )
    on = [F.lower(F.col(c)).eqNullSafe(F.col(f"__{c}")) for c in TRIPLE]
    joined = df.join(dim, on, "left").withColumn("technology_sk", technology_sk("__dim_sk", *TRIPLE))
    return joined.drop("__dim_sk", *[f"__{c}" for c in TRIPLE])
