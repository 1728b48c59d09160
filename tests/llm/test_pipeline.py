"""The corpus pipeline against the brute-force steps of its stages."""

from __future__ import annotations

import os
import subprocess
import sys

import numpy as np

import corpus_pipeline
from __spark_entry__ import queries
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_mixing import goals
from tests.llm.test_quality_rules import brute as count_brute
from tests.llm.test_simhash import alike

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert docs.columns == columns
        path = f"{spark.sparkContext.getCheckpointDir()}/{name}"
        docs.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs.collect())
    start = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rules, lines, near, mixed, packed = kept

    base = {r["doc_id"] for r in start if (c := count_brute(r["text"]))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert {r["doc_id"] for r in rules} <= base and len(rules) > 0.8 * len(base)

    gone = line_brute([(r["doc_id"], r["text"]) for r in rules], 50)
    for k, r in enumerate(rules):
        want = "\n".join(x for pos, x in enumerate(r["text"].split("\n")) if pos not in gone[k])
        got = next(x for x in lines if x["doc_id"] == r["doc_id"])
        assert got["text"] == want and got["n_chars"] == len(want)

    # Every document that goes has one like it left among those before, and no two of those that stay are copies.
    ahead, stay = {r["doc_id"]: r["text"] for r in lines}, {r["doc_id"] for r in near}
    for i in set(ahead) - stay:
        assert any(j != i and alike(ahead[i], ahead[j]) >= 0.8 for j in ahead)
    left = [i for i in sorted(stay) if ahead[i].split()]
    close = [(i, j) for i in left for j in left if i < j and alike(ahead[i], ahead[j]) >= 0.8]
    assert not close and len({" ".join(ahead[i].lower().split()) for i in left}) == len(left)

    size = {r["doc_id"]: len(r["text"].split()) for r in near}
    per = {}
    for r in near:
        per[r["source"]] = per.get(r["source"], 0) + size[r["doc_id"]]
    want = goals(per)
    taken = {s: 0 for s in per}
    for r in mixed:
        taken[r["source"]] += size[r["doc_id"]]
    assert all(abs(taken[s] - want[s]) <= max(size.values()) for s in per)

    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in mixed}
    assert sum(r["start"] == 0 for r in packed) == len(mixed)
    assert sum(len(np.frombuffer(r["ids"], "<u4")) for r in packed) == sum(r["length"] for r in packed)


def test_run_equals_the_stages(spark):
    got = queries()["pipeline"](spark, SF)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_every_operator_has_a_query():
    names = [n.split("_")[0] for n in queries() if n.startswith("op")]
    assert {f"op{k}" for k in range(1, 14)} <= set(names)


def test_results_of_operators_outlive_a_pipeline_stage(spark):
    held = queries()["op4_exact_dedup"](spark, SF)
    before = sorted(held.collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for _, stage in corpus_pipeline.STAGES[:2]:
        stage(spark, docs, SF).count()
    assert sorted(held.collect()) == before


def test_the_entry_loads_without_a_package_of_the_operators():
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; assert len(e.queries()) > 150 and 'op1_simhash' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(corpus_pipeline.__file__)))
