"""Repeated word windows by super-k-mer partitioning.

Consecutive windows of words that share a minimiser travel as one packed string to the bucket of the
minimiser (see ``repeats``). There all windows are sorted by prefix doubling and counted exactly, with
the smallest document that holds each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays, repeats
from tickloom.llm.suffix_dedup import cut_spans

WINDOW_WORDS = 50
GRAM_WORDS = 6

COUNTED = "anchor BIGINT, digest BINARY, doc BIGINT, counts ARRAY<BIGINT>, firsts ARRAY<BIGINT>"


def window_ranks(symbols: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Numbers of the windows at ``at``, equal for equal windows and in their order."""
    ranks, size = np.unique(symbols, return_inverse=True)[1], 1
    while size * 2 <= window:
        ranks = np.unique((ranks[:-size].astype(np.uint64) << np.uint64(32)) | ranks[size:].astype(np.uint64), return_inverse=True)[1]
        size *= 2
    # A window is its first ``size`` symbols and, overlapping them, its last.
    keys = (ranks[at].astype(np.uint64) << np.uint64(32)) | ranks[at + window - size].astype(np.uint64)
    return np.unique(keys, return_inverse=True)[1]


def bucket_counts(window: int):
    """Job over buckets: how often each window of each packed string occurs, and its smallest document."""

    def one(table: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        words = [[numbers.setdefault(w, len(numbers)) for w in packed.split(b" ")] for packed in table["packed"].to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        at = arrays.window_starts(first, window)
        row = np.searchsorted(first, at, "right") - 1
        group = window_ranks(np.array([n for w in words for n in w], np.int64), at, window)
        order = np.argsort(group, kind="stable")
        heads = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) > 0]))
        counts = np.add.reduceat(table["n"].to_numpy()[row[order]], heads)
        firsts = np.minimum.reduceat(table["doc"].to_numpy()[row[order]], heads)
        bounds = np.searchsorted(row, np.arange(len(words) + 1))
        return pa.table(
            {"anchor": table["anchor"], "digest": table["digest"], "doc": table["doc"], "counts": arrays.lists(counts[group], bounds), "firsts": arrays.lists(firsts[group], bounds)}
        )

    return one


def _each_word(packed: bytes):
    starts, ends, _ = arrays.words(np.frombuffer(packed, np.uint8), np.array([0, len(packed)]), arrays.NOT_SPACE)
    return starts.tolist(), ends.tolist()


def _bucket_strings(texts: DataFrame, distinct: DataFrame, window: int, max_bucket: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Counts of the usual buckets, and of the largest ones all windows one by one and their totals."""
    strings = repeats.packed_strings(texts, distinct.where("n_digests > 1"), repeats.word_units, window)
    usual = repeats.by_bucket(strings.where(F.col("n_digests") <= max_bucket), bucket_counts(window), COUNTED)
    hot = repeats.single_windows(strings.where(F.col("n_digests") > max_bucket), _each_word, window)
    totals = hot.groupBy("window_digest").agg(F.sum("n").alias("count"), F.min("doc").alias("first"))
    return usual, hot, totals


def _late_windows(texts: DataFrame, distinct: DataFrame, window: int, max_bucket: int) -> DataFrame:
    """anchor, digest, marks: the windows of a run that a smaller document than its first one has."""
    usual, hot, totals = _bucket_strings(texts, distinct, window, max_bucket)
    late = F.transform("firsts", lambda first, at: F.when(first < F.col("doc"), at))
    marked = usual.select("anchor", "digest", F.filter(late, lambda at: at.isNotNull()).alias("marks"))
    totals = totals.withColumnRenamed("window_digest", "same")
    beside = hot.join(totals, (F.col("window_digest") == F.col("same")) & (F.col("first") < F.col("doc")))
    listed = beside.groupBy("anchor", "digest").agg(F.sort_array(F.collect_set("at")).alias("marks"))
    return marked.where(F.size("marks") > 0).unionByName(listed)


def count_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, gram: int = GRAM_WORDS, max_bucket: int = repeats.MAX_BUCKET) -> DataFrame:
    """Exact counts of all windows that occur in more than one run: digest (of the run), at, count, first (smallest id)."""
    texts = repeats.keyed(docs, id_col, text_col)
    distinct = repeats.distinct_runs(repeats.find_runs(texts, repeats.word_units, window, gram))
    usual, hot, totals = _bucket_strings(texts, distinct, window, max_bucket)
    each = F.posexplode(F.arrays_zip(F.col("counts").alias("count"), F.col("firsts").alias("first")))
    listed = usual.select("digest", each.alias("at", "w")).select("digest", "at", "w.*")
    # Equal windows are in one bucket and, with one minimiser in a run, once in it: those of a lone run occur as often as it.
    places = F.explode(F.sequence(F.lit(0), F.col("lead.n_windows") - 1))
    lone = distinct.where("n_digests = 1 AND n > 1").select("digest", places.alias("at"), F.col("n").alias("count"), F.col("lead.doc").alias("first"))
    return listed.unionByName(lone).unionByName(hot.join(totals, "window_digest").select("digest", "at", "count", "first")).where("count > 1")


def remove_later(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_WORDS, gram: int = GRAM_WORDS, max_bucket: int = repeats.MAX_BUCKET) -> DataFrame:
    """Cut every word covered by a window whose word sequence also starts in a document of a smaller id.

    Struct ``row`` (the document's columns), struct ``result``: n_words, n_removed, kept (the remaining
    words with single spaces). Windows are judged on the input. A null text has no words, a
    null id is smaller than any other, and rows of one id do not cut each other. Every row
    comes back once.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    runs = repeats.find_runs(texts, repeats.word_units, window, gram)
    distinct = repeats.distinct_runs(runs)
    marks = _late_windows(texts, distinct, window, max_bucket)
    chosen = distinct.select("anchor", "digest", "n", F.col("lead.doc").alias("lead_doc")).join(marks, ["anchor", "digest"], "left").where("n > 1 OR marks IS NOT NULL")
    late = F.col("doc") > F.col("lead_doc")
    whole = F.array(F.struct(F.lit(0).alias("lo"), (F.col("n_windows") + window - 1).alias("hi")))
    parts = F.transform("marks", lambda at: F.struct(at.alias("lo"), (at + window).alias("hi")))
    spans = (
        runs.join(chosen, ["anchor", "digest"])
        .select("doc", "code", "start", F.explode(F.when(late, whole).otherwise(parts)).alias("span"))
        .select("doc", "code", (F.col("start") + F.col("span.lo")).alias("lo"), (F.col("start") + F.col("span.hi")).alias("hi"))
    )
    return cut_spans(docs, repeats.spans_by_document([spans]), id_col, text_col, _cut_words, "n_words BIGINT, n_removed BIGINT, kept STRING")


def _cut_words(data, bounds, spans):
    units = repeats.word_units(data, bounds)
    gone = repeats.flags_of(spans, units.first)
    keep = np.flatnonzero(~gone)
    size = units.ends[keep] - units.starts[keep] + 1  # with the space after it
    place = np.concatenate([[0], np.cumsum(size)])
    text = units.text[np.repeat(units.starts[keep] - place[:-1], size) + np.arange(place[-1])]
    row = np.searchsorted(keep, units.first)
    raw, at = text.tobytes(), place[row].tolist()
    kept = [raw[a : max(b - 1, a)].decode("utf-8") for a, b in zip(at[:-1], at[1:])]
    return [np.diff(units.first), arrays.sums(gone, units.first), pa.array(kept, pa.string())]
