"""A corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, packing.

``STAGES`` lists the stages. Each takes ``(spark, docs, sf_dir)`` and returns a frame;
it is written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskline.llm import common, line_dedup, mixing, packing, quality_rules, simhash
from duskline.session import configure, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or their group's fences reject go."""
    judged = quality_rules.quality_rules(docs)
    return judged.filter("kept").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go; ``n_chars`` follows the text."""
    return line_dedup.shortened_rows(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return simhash.one_per_group(docs).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in a sequence. A document in the mix twice is packed twice."""
    return packing.pack_documents(docs)


_LEFT: dict[str, list[str]] = {}


def _fresh(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """``stage``, after the intermediate tables of the stage before are deleted: its result is written by then.

    Only tables that a stage of this pipeline made are deleted.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        common.discard(spark, _LEFT.pop(application, []))
        with common.scratch_scope() as made:
            result = stage(spark, docs, sf_dir)
        _LEFT[application] = made
        return result

    return run_stage


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", _fresh(quality_stage)),
    ("line_dedup", _fresh(line_stage)),
    ("simhash_near_dedup", _fresh(near_dedup_stage)),
    ("source_mixing", _fresh(mixing_stage)),
    ("best_fit_packing", _fresh(packing_stage)),
]

# SQL has no SimHash voting, Newton rounds or tokenizer: tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    configure(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
