"""What operators leave on disk and shuffle on their way."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from tickloom.llm import frames, suffix_dedup


def _shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {n for folder in blocks.localDirsString() for _, _, names in os.walk(folder) for n in names if n.startswith("shuffle_") and n.endswith(".data")}


@pytest.mark.parametrize("before", ["false", "true"])
def test_a_stored_table_leaves_no_shuffle_files(spark, before):
    conf = spark.conf.get(frames.FREE_SHUFFLES)
    spark.conf.set(frames.FREE_SHUFFLES, before)
    try:
        held = _shuffle_files(spark)
        table = frames.stored(spark.range(20_000).groupBy((F.col("id") % 5_000).alias("key")).agg(F.count("*").alias("n")), "left")
        left, end = _shuffle_files(spark) - held, time.time() + 20
        while left and time.time() < end:
            time.sleep(0.2)
            left = _shuffle_files(spark) - held
        assert not left
        assert spark.conf.get(frames.FREE_SHUFFLES) == before
        assert table.count() == 5_000 and table.where("n = 4").count() == 5_000
    finally:
        spark.conf.set(frames.FREE_SHUFFLES, conf)


def test_texts_travel_once_to_their_spans(spark):
    docs = spark.createDataFrame([(1, "x" * 900), (2, None), (2, "y"), (None, "")], "doc_id BIGINT, text STRING")
    spans = spark.createDataFrame([(1, 0, [(0, 5)])], "doc BIGINT, code INT, spans ARRAY<STRUCT<lo: INT, hi: INT>>")
    cut = suffix_dedup.cut_spans(docs, spans, "doc_id", "text", suffix_dedup._cut_bytes, "n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept BINARY")
    below = cut._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter", 1)[1]
    assert "AS text#" not in below
    assert sorted(r["result"]["n_bytes"] for r in cut.collect()) == [0, 0, 1, 900]
