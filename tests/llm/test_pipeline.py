"""The pipeline, stage by stage, against brute force; and its registration."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stages")
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    found["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(root / name))
        docs = found[name] = spark.read.parquet(str(root / name))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_every_stage_returns_documents(stages):
    names = list(stages)
    assert names[1:] == ["language_id", "jaccard_join", "suffix_dedup", "decontamination", "packing"]
    for name in names[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_language_keeps_all_real_texts(stages):
    assert texts(stages["language_id"]) == {k: v for k, v in texts(stages["documents"]).items() if any(c.isalpha() for c in v or "")}


def test_one_of_each_group_stays(stages, monkeypatch):
    monkeypatch.setattr(brute, "shingles", lambda text: brute.word_shingles(text, 5))
    rows = sorted(texts(stages["language_id"]).items())
    kept = {doc for (doc, _), (n, component) in zip(rows, brute.jaccard(rows, 80)) if n == 0 or doc == component}
    assert set(texts(stages["jaccard_join"])) == kept


def test_repeats_are_cut(stages):
    before, after = texts(stages["jaccard_join"]), texts(stages["suffix_dedup"])
    rows = list(before.items())
    assert set(after) == set(before)
    for (doc, text), (n_bytes, removed, _, digest) in zip(rows, brute.cut_bytes(rows, corpus_pipeline.REPEATED_BYTES)):
        if brute.sha(after[doc].encode()) != digest:  # only where a character was cut in two
            assert n_bytes - removed - 3 <= len(after[doc].encode()) < n_bytes - removed


def test_passages_of_sixty_words_go(spark):
    """A passage that three documents share, between texts of their own."""
    passage = " ".join(f"w{i}k" for i in range(60))
    own = [" ".join(f"x{i}own{n}" for i in range(80)) for n in range(5)]
    rows = [(n, f"{own[n]} {passage} {own[n][::-1]}") for n in range(3)] + [(3, own[3]), (4, own[4])]
    found = texts(corpus_pipeline.cut_repeated_text(spark, spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), SF_DIR))
    assert all("w30k" not in found[n] and found[n].startswith(own[n]) and found[n].endswith(own[n][::-1]) for n in range(3))
    assert found[3] == own[3] and found[4] == own[4]


ODD_SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, row INT, result STRING, held INT, doc INT, code INT"
ODD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n ", None, "a", 3), (4, "plain short words", "en", None, None), (4, "plain short words", "en", None, None),
    (None, "another text of no id", None, "b", 5), (5, "x" * 3000, "en", "a", 3000), (6, " ".join(f"long{i} words" for i in range(30_000)), "en", "a", 1),
]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_clashing_names_and_empty_tables(spark, name, empty):
    docs = spark.createDataFrame([] if empty else [(*r, 1, "x", 2, 3, 4) for r in ODD], ODD_SCHEMA)
    found = dict(corpus_pipeline.STAGES)[name](spark, docs, SF_DIR)
    rows = found.collect()
    if name != "packing":
        assert found.columns == docs.columns
    if empty:
        assert rows == []
        return
    ids = sorted((r["doc_id"] for r in rows), key=lambda i: (i is not None, i))
    if name == "language_id":
        assert {4, 5, 6, None} >= set(ids) and ids.count(4) == 2
    elif name == "jaccard_join":
        assert ids == [None, 1, 2, 3, 4, 5, 6]
    elif name == "packing":
        assert set(ids) == {None, 1, 2, 3, 4, 5, 6} and sum(r["length"] == r["doc_tokens"] == 1 for r in rows) == 3
    else:
        assert ids == [None, 1, 2, 3, 4, 4, 5, 6]


def test_benchmark_goes(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before = texts(stages["suffix_dedup"])
    assert texts(stages["decontamination"]) == {k: v for k, v in before.items() if not brute.decontaminate(v, items)[-1]}


def test_all_of_it_is_packed(stages):
    packed = stages["packing"].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert packed.where("n <> `all`").count() == 0
    assert {r["doc_id"] for r in packed.collect()} == set(texts(stages["decontamination"]))


def test_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert driver.queries()["pipeline"] is corpus_pipeline.run
