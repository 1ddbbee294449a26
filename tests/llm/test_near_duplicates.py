"""The near-duplicate stage of the pipeline: shingles of five words, 80 percent."""

from __future__ import annotations

import brute
import pytest

import corpus_pipeline
from tickloom.llm import jaccard_join

SF_DIR = "/root/testdata/sf0.001"


def _five(text):
    return brute.word_shingles(text, 5)


@pytest.fixture()
def rows(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    words = [f"word{n}" for n in range(400)]
    near = [f"other{n}" if n % 50 == 25 else w for n, w in enumerate(words)]  # 8 of 400 words: 356/436 by five, 374/422 by three
    ring = [(10_000 + n, " ".join(f"t{n if i == 5 * n else i}" for i in range(60))) for n in range(12)]
    more = [(9_000, " ".join(words)), (9_001, " ".join(near)), (9_002, "one two"), (9_003, "one two"), (9_004, None), *ring]
    return [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()] + more


def test_stage_against_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(brute, "shingles", _five)
    kept = {doc for (doc, _), (n, component) in zip(rows, brute.jaccard(rows, 80)) if n == 0 or doc == component}
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = [r["doc_id"] for r in corpus_pipeline.keep_one_of_each_group(spark, docs, SF_DIR).collect()]
    assert sorted(found) == sorted(kept) and 9_000 in kept and 9_001 not in kept


def test_small_regions_and_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(brute, "shingles", _five)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = jaccard_join.join_components(docs, percent=80, small_region=1, block_shingles=150, words=5).collect()
    assert sorted((r[0], (r[1], r[2])) for r in found) == sorted(zip([i for i, _ in rows], brute.jaccard(rows, 80)))
