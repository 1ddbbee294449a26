"""Collocations against brute force: sample failures, odd rows, ties, repeats, empty tables."""

from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from tickloom.llm import collocations
from tickloom.llm.frames import stored

SF_DIR = "/root/testdata/sf0.001"
# Names that the operator uses for itself, and one more column.
SCHEMA = "lang STRING, text STRING, phrase STRING, n INT, salt INT, rank INT, `odd name` INT"

ODD = [
    (None, "lost found lost found lost found"), ("und", "lost found"), ("en", None), (None, None), ("en", ""), ("en", " \t "), ("en", "...!?"),
    ("en", "A a A a a a\ta  a"), ("en", "ab ab\nab ab\x0bab ab"), ("xx", "İK Kelvin K   x"), ("xx", "İK Kelvin K   x"), ("", "no name no name"),
    ("en", " ".join(f"w{i % 37} and so on" for i in range(9000))), ("de", "\x00 zero \x00 zero"),
]


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("lang", "text").collect()
    return [(r["lang"], r["text"]) for r in table] + ODD + ODD[:3] * 3


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4) for r in rows], SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("sample", [0.001, 0.3])
def test_frequent_phrases_are_exact(docs, rows, sample):
    counts, total = brute.phrase_counts(rows)
    wanted = {(p[0], " ".join(p[1:])): n for p, n in counts.items() if n >= 5} | {(lang, ""): n for lang, n in total.items() if n}
    passes = []
    found = collocations.frequent_phrases(docs, min_count=5, sample=sample, slot_bits=20, on_pass=passes.append).collect()
    assert len(found) == len(wanted) and {(r["lang"], r["phrase"]): r["n"] for r in found} == wanted
    # A sample without rows proposes nothing: each length needs a pass of its own, and one shows that nothing is left.
    assert passes[0] == 5 if sample == 0.001 else passes[0] >= 2


@pytest.mark.parametrize("top", [3, 2000])
def test_collocations(docs, rows, top, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 20_000)
    found = collocations.collocations(docs, min_count=4, top=top, slot_bits=16)
    assert sorted(tuple(r) for r in found.collect()) == brute.collocations(rows, 4, top)


def test_products_beyond_64_bits(spark):
    counts = 40 * ["big number"]
    docs = spark.createDataFrame([("en", t) for t in counts], "lang STRING, text STRING")
    scaled = lambda *a, **k: collocations_counts(spark)
    plain = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = scaled
        row = collocations.collocations(docs).first()
    finally:
        collocations.frequent_phrases = plain
    a, left, right, n = 3 * 10**12, 4 * 10**12, 5 * 10**12, 9 * 10**15
    assert row["score"] == 1000 * a * n // (left * right)


def collocations_counts(spark):
    rows = [("en", "", 9 * 10**15), ("en", "big", 4 * 10**12), ("en", "number", 5 * 10**12), ("en", "big number", 3 * 10**12)]
    return spark.createDataFrame(rows, collocations.COUNTS)


def test_bits_of_spark_and_of_the_tasks_agree(spark, docs):
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    found, closed, _ = collocations._closed(texts, np.zeros((1 << 18) // 8, np.uint8), 5, 5, "test")
    codes = np.array([r["code"] for r in found.collect()], np.int64).astype(np.uint64)
    packed = collocations.Proposed.packed(collocations._bitmap(found, 18))
    assert len(codes) > 100 and collocations.Proposed(packed).holds(codes).all()
    sent = spark.sparkContext.broadcast(collocations.Proposed.packed(closed))
    assert collocations._count(texts, sent, sent, 5).count() == 0  # all that these proposals open has been counted before


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang STRING, text STRING")).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None)], "lang STRING, text STRING")).collect() == []


class Local:
    """Stands for a frame and keeps what a pass gives out before Spark adds it up."""

    def __init__(self, batches):
        self.batches = batches

    def mapInArrow(self, run, schema):
        self.table = pa.Table.from_batches(list(run(iter(self.batches))))
        return self

    def groupBy(self, *names):
        return self

    def agg(self, *sums):
        return self


def test_a_task_gives_out_each_phrase_once(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 2000)
    table = pa.table({"lang": ["und" if r[0] is None else r[0] for r in rows], "text": [r[1] or "" for r in rows]}, pa.schema([("lang", pa.string()), ("text", pa.string())]))
    every = spark.sparkContext.broadcast(collocations.Proposed.packed(np.full((1 << 18) // 8, 255, np.uint8)))
    counts, total = brute.phrase_counts(rows)
    wanted = sorted([(p[0], " ".join(p[1:]), n) for p, n in counts.items()])
    for held in (1 << 22, 300):
        monkeypatch.setattr(collocations, "HELD_CODES", held)
        monkeypatch.setattr(collocations, "HELD_PHRASES", held)
        spelled = collocations._spell(Local(table.to_batches(max_chunksize=50)), every, every, 5).table
        phrases = spelled.filter(pc.not_equal(spelled["phrase"], ""))
        summed = phrases.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        assert sorted(zip(*(summed[name].to_pylist() for name in ("lang", "phrase", "n_sum")))) == wanted
        codes = collocations._count(Local(table.to_batches(max_chunksize=50)), every, None, 5).table
        assert len(pc.unique(codes["code"])) == len(wanted) and pc.sum(codes["n"]).as_py() == sum(n for *_, n in wanted)
        if held > 300:
            assert len(phrases) == len(codes) == len(wanted)


class Counted:
    """Stands for a frame and counts the rows that its tasks give out."""

    made: list[int] = []

    def __init__(self, texts):
        self.texts = texts

    def mapInArrow(self, run, schema):
        table = stored(self.texts.mapInArrow(run, schema), "made")
        self.made.append(table.where("phrase != ''").count())
        return table


def test_spelled_rows_do_not_multiply_with_the_tasks(spark, monkeypatch):
    # Phrases of every row, and one that a single row repeats: no small share is sure to hold it.
    common = [(lang, " ".join(f"w{(n + i) % 30}" for i in range(30))) for lang in ("en", None) for n in range(1200)]
    rows = [*common, ("xx", "rare words, " * 20), ("yy", "no phrase")]
    tasks = 48
    docs = spark.createDataFrame(rows, "lang STRING, text STRING").repartition(tasks).cache()
    spell, made = collocations._spell, []
    monkeypatch.setattr(collocations, "_spell", lambda texts, *others: spell(Counted(texts), *others))
    monkeypatch.setattr(Counted, "made", made)
    found = collocations.frequent_phrases(docs, min_count=20, slot_bits=20).collect()
    counts, total = brute.phrase_counts(rows)
    wanted = {(p[0], " ".join(p[1:])): n for p, n in counts.items() if n >= 20} | {(lang, ""): n for lang, n in total.items()}
    assert len(found) == len(wanted) and {(r["lang"], r["phrase"]): r["n"] for r in found} == wanted
    assert 250 < len(wanted) <= sum(made) + len(total) and sum(made) < tasks * len(wanted) / 3
