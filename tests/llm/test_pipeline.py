"""The pipeline's stages, one after the other, against brute force."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from meterline.llm.common import staged  # noqa: E402
from tests.llm.test_operators import (SMALL, brute_components, brute_lines, brute_print, check_places, words)  # noqa: E402


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, None, None, None), (10_002, "12 34 !", "en", "s", 7)], docs.schema)
    docs = docs.unionByName(extra)
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), f"test-{name}")
        seen[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == columns
    rest = {r["doc_id"]: r["text"] for r in seen["language_id"]}
    assert rest == {i: t for i, t in before.items() if i < 10_000}  # clean documents stay

    gone = brute_lines(rest.items())
    kept = {}
    for i, t in rest.items():
        left = [x for k, x in enumerate(t.split("\n")) if (i, k) not in gone]
        if len(left) == len(t.split("\n")) or words("\n".join(left)):
            kept[i] = "\n".join(left)
    assert {r["doc_id"]: r["text"] for r in seen["line_dedup"]} == kept

    groups = brute_components({i: brute_print(t) for i, t in kept.items()}, 2)
    first = {i: kept[i] for i, g in groups.items() if i == g}
    assert {r["doc_id"]: r["text"] for r in seen["simhash_near_dedup"]} == first

    mixed = [(r["doc_id"], r["text"]) for r in seen["source_mixing"]]
    assert set(mixed) <= set(first.items()) and max(mixed.count(x) for x in set(mixed)) <= 3
    total = sum(len(words(t)) for t in first.values())
    assert abs(sum(len(words(t)) for _, t in mixed) / total - 1) < 0.05

    packed = seen["best_fit_packing"]
    assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed)
    assert sum(1 for r in packed if r["piece"] == 0) == len(mixed)
    check_places(packed)


def test_texts_of_one_id_are_judged_each_on_its_own(spark):
    stage = dict(corpus_pipeline.STAGES)["simhash_near_dedup"]
    one, two, other = (" ".join(f"{k}{i * k % 97}" for i in range(1, 90)) for k in (3, 5, 7))
    rows = [(1, one, "en", "s", 1), (1, two, "en", "s", 2), (1, one, "en", "s", 1), (2, two, "en", "t", 2), (3, other, "en", "s", 3)]
    want = [(1, one, "en", "s", 1), (1, two, "en", "s", 2), (3, other, "en", "s", 3)]
    schema = spark.read.parquet(f"{SMALL}/documents.parquet").schema
    for own in (rows, rows[::-1]):
        got = stage(spark, spark.createDataFrame(own, schema).coalesce(1), SMALL).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").filter(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SMALL), f"test-empty-{name}")
        assert docs.count() == 0
