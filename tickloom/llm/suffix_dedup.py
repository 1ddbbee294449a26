"""Repeated byte strings by the interval tree of an enhanced suffix array.

Buckets of packed runs (see ``repeats``) are sorted as suffixes; a stack scan over the common-prefix
table walks the interval tree, and every interval that is long enough and has more than one left
extension is a maximal repeat, reported with all its occurrences.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays, repeats
from tickloom.llm.frames import map_texts

WINDOW_BYTES = 400
GRAM_BYTES = 32

_DIVERSE = -1


def suffix_array(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and common-prefix table (with the suffix before), exact up to ``depth`` symbols.

    Prefix doubling: ranks of 4 symbols, then of 8, 16 and so on; the same ranks give the common prefixes.
    """
    n = len(symbols)
    kinds, low = np.unique(symbols, return_inverse=True)
    padded = np.concatenate([low.astype(np.uint64) + np.uint64(1), np.zeros(4, np.uint64)])
    levels: list[tuple[int, np.ndarray]] = []
    if len(kinds) < (1 << 16) - 1:
        size = 4
        keys = (padded[:n] << np.uint64(48)) | (padded[1 : n + 1] << np.uint64(32)) | (padded[2 : n + 2] << np.uint64(16)) | padded[3 : n + 3]
    else:
        size, keys = 1, padded[:n]
    while True:
        distinct, ranks = np.unique(keys, return_inverse=True)
        ranks = ranks.astype(np.uint64) + np.uint64(1)
        levels.append((size, ranks.astype(np.uint32)))
        if size >= depth or len(distinct) == n:
            break
        ahead = np.zeros(n, np.uint64)
        ahead[: n - size] = ranks[size:]
        keys, size = (ranks << np.uint64(32)) | ahead, size * 2
    order = np.argsort(levels[-1][1], kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(max(n - 1, 0), np.int64)
    for size, ranks in reversed(levels):
        while True:
            ends = np.append(ranks, np.uint32(0))  # beyond the end nothing is equal
            same = (a < n) & (b < n)
            same &= ends[np.minimum(a, n)] == ends[np.minimum(b, n)]
            if size == levels[-1][0]:
                same &= common < depth
            a, b, common = a + size * same, b + size * same, common + size * same
            if size != levels[-1][0] or not same.any():
                break
    if levels[0][0] > 1:
        flat = np.concatenate([low.astype(np.int64), [-1]])
        for _ in range(levels[0][0] - 1):
            same = (a < n) & (b < n)
            same &= flat[np.minimum(a, n)] == flat[np.minimum(b, n)]
            a, b, common = a + same, b + same, common + same
    return order, np.concatenate([[0], common])


def maximal_repeats(order: np.ndarray, common: np.ndarray, before: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(length, first, end): intervals of the suffix array that are maximal repeats of ``shortest`` symbols or more.

    ``before`` is the symbol left of each suffix, unique where there is none. Intervals come innermost first.
    """
    found = []
    deep = np.flatnonzero(common >= shortest)
    if not len(deep):
        return found
    ends = np.flatnonzero(np.diff(deep) > 1)
    for first, last in zip(deep[np.concatenate([[0], ends + 1])].tolist(), deep[np.append(ends, len(deep) - 1)].tolist()):
        # Suffixes first - 1 .. last of the array share ``shortest`` symbols or more.
        lengths = common[first : last + 1].tolist() + [shortest - 1]
        lefts = before[order[first - 1 : last + 1]].tolist()
        stack: list[list[int]] = []  # [length, first suffix, left symbol or diverse]
        for at, length in enumerate(lengths):
            start, left = first - 1 + at, lefts[at]
            while stack and stack[-1][0] > length:
                top = stack.pop()
                merged = top[2] if top[2] == left or top[2] == _DIVERSE else _DIVERSE
                if merged == _DIVERSE:
                    found.append((top[0], top[1], first + at))
                start, left = top[1], merged
            if length < shortest:
                continue
            if stack and stack[-1][0] == length:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == left else _DIVERSE
            else:
                stack.append([length, start, left])
    return found


GROUPS = "group BINARY, length INT, doc BIGINT, code INT, start INT"
RANGES = "doc BIGINT, code INT, lo INT, hi INT"


def _bucket_array(table: pa.Table):
    """Symbols of all packed strings, each with a separator of its own, their bounds, suffix array and common prefixes."""
    strings = table["packed"].to_pylist()
    size = np.array([len(s) for s in strings], np.int64)
    at = np.concatenate([[0], np.cumsum(size + 1)])
    raw = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8)
    symbols = raw.astype(np.int64)
    symbols[at[1:] - 1] = 256 + np.arange(len(strings))
    order, common = suffix_array(symbols, int(size.max(initial=0)) + 1)
    return raw, at, order, common, np.concatenate([[1 << 40], symbols[:-1]])


def repeating(table: pa.Table, window: int) -> pa.Table:
    """The packed strings of which some window may stand twice in the table, by rolling hashes.

    Equal windows have equal hashes, so all strings with a repeat are left; what really repeats
    is for the suffix array to say.
    """
    held = table["packed"].combine_chunks().cast(pa.large_binary())
    _, offsets, data = held.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(held) + 1, held.offset * 8)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    at = arrays.window_starts(bounds, window)
    twice = at[arrays.repeated(arrays.byte_hash(raw, at, at + window))]
    found = np.zeros(len(held), bool)
    found[np.searchsorted(bounds, twice, "right") - 1] = True
    return table.filter(pa.array(found)).combine_chunks()


def bucket_repeats(window: int):
    """Job over buckets: one row for each occurrence of each maximal repeat among the packed strings."""

    def one(table: pa.Table) -> pa.Table:
        table = repeating(table, window)
        raw, at, order, common, before = _bucket_array(table)
        names, lengths, places = [], [], []
        for length, first, end in maximal_repeats(order, common, before, window):
            held = order[first:end]
            names += [hashlib.blake2b(raw[held[0] : held[0] + length].tobytes(), digest_size=16).digest()] * len(held)
            lengths += [length] * len(held)
            places.append(held)
        place = np.concatenate(places) if places else np.zeros(0, np.int64)
        row = np.searchsorted(at, place, "right") - 1
        start = place - at[row] + table["start"].to_numpy()[row]
        part = table.select(["doc", "code"]).take(pa.array(row))
        return pa.table({"group": pa.array(names, pa.binary()), "length": pa.array(lengths, pa.int32()), "doc": part["doc"], "code": part["code"], "start": pa.array(start.astype(np.int32))})

    return one


def bucket_ranges(window: int):
    """Job over buckets: the ranges that the maximal repeats cover in the packed strings."""

    def one(table: pa.Table) -> pa.Table:
        table = repeating(table, window)
        raw, at, order, common, before = _bucket_array(table)
        longest = np.zeros(len(order), np.int64)  # of the repeats that begin with each suffix
        for length, first, end in maximal_repeats(order, common, before, window):
            part = longest[first:end]
            part[part == 0] = length
        held = longest > 0
        lo, hi = arrays.runs(arrays.covered(order[held], order[held] + longest[held], len(raw)))
        row = np.searchsorted(at, lo, "right") - 1
        shift = table["start"].to_numpy()[row] - at[row]
        part = table.select(["doc", "code"]).take(pa.array(row))
        return pa.table({"doc": part["doc"], "code": part["code"], "lo": pa.array((lo + shift).astype(np.int32)), "hi": pa.array((hi + shift).astype(np.int32))})

    return one


def _each_byte(packed: bytes):
    return range(len(packed)), range(1, len(packed) + 1)


def _bucket_strings(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int, max_bucket: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Runs that occur again as a whole; strings of the usual buckets; repeated single windows of the largest ones."""
    texts = repeats.keyed(docs, id_col, text_col)
    runs = repeats.find_runs(texts, repeats.byte_units, window, gram)
    distinct = repeats.distinct_runs(runs)
    whole = runs.join(distinct.where("n > 1").select("anchor", "digest"), ["anchor", "digest"])
    strings = repeats.packed_strings(texts, distinct.where("n_digests > 1"), repeats.byte_units, window)
    hot = repeats.single_windows(strings.where(F.col("n_digests") > max_bucket), _each_byte, window)
    twice = hot.groupBy("window_digest").agg(F.count("*").alias("seen")).where("seen > 1")
    single = hot.join(twice, "window_digest").withColumn("start", F.col("start") + F.col("at"))
    return whole, strings.where(F.col("n_digests") <= max_bucket), single


def repeat_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_BYTES, gram: int = GRAM_BYTES, max_bucket: int = repeats.MAX_BUCKET) -> DataFrame:
    """All repeats as groups: kind, group, length, doc, code, start; one row for each occurrence.

    Three kinds of groups: "run" (a run of windows that occurs again as a whole), "repeat" (a maximal
    repeat within a bucket; copies of a whole run stand for one), and "window" (single windows of a bucket
    with too many different runs). Together they cover every byte of every repeated window.
    """
    whole, strings, single = _bucket_strings(docs, id_col, text_col, window, gram, max_bucket)
    columns = ["kind", "group", "length", "doc", "code", "start"]
    runs = whole.select(F.lit("run").alias("kind"), F.col("digest").alias("group"), (F.col("n_windows") + window - 1).alias("length"), "doc", "code", "start")
    usual = repeats.by_bucket(strings, bucket_repeats(window), GROUPS).withColumn("kind", F.lit("repeat")).select(*columns)
    return runs.unionByName(usual).unionByName(
        single.select(F.lit("window").alias("kind"), F.col("window_digest").alias("group"), F.lit(window).alias("length"), "doc", "code", "start")
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW_BYTES, gram: int = GRAM_BYTES, max_bucket: int = repeats.MAX_BUCKET, as_text: bool = False) -> DataFrame:
    """Cut every byte that lies in a string of ``window`` bytes that also starts anywhere else.

    Struct ``row`` (the document's columns), struct ``result``: n_bytes, n_removed, n_spans (maximal
    removed runs), kept (the remaining bytes; with ``as_text`` a string, without characters of
    which only a part remains). Strings are judged on the input and never cross
    documents; all occurrences go, the first one too. A null text is empty. Every row comes back
    once; rows of equal id and text repeat each other like any two documents.
    """
    whole, strings, single = _bucket_strings(docs, id_col, text_col, window, gram, max_bucket)
    spans = repeats.spans_by_document([
        whole.select("doc", "code", F.col("start").alias("lo"), (F.col("start") + F.col("n_windows") + window - 1).alias("hi")),
        repeats.by_bucket(strings, bucket_ranges(window), RANGES),
        single.select("doc", "code", F.col("start").alias("lo"), (F.col("start") + window).alias("hi")),
    ])
    schema = f"n_bytes BIGINT, n_removed BIGINT, n_spans BIGINT, kept {'STRING' if as_text else 'BINARY'}"
    return cut_spans(docs, spans, id_col, text_col, _cut_text if as_text else _cut_bytes, schema)


def cut_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, one, schema: str) -> DataFrame:
    """Give ``one(data, bounds, spans)`` the spans of each document; struct ``row`` has the document's own columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("held"))
    text = F.coalesce(F.col(f"held.`{text_col}`"), F.lit(""))
    marked = packed.select("held", F.coalesce(F.col(f"held.`{id_col}`").cast("bigint"), F.lit(-(2**63))).alias("doc"), F.hash(text).alias("code"))
    # The text travels once, with its row.
    joined = marked.join(spans, list(repeats.KEY), "left").select("held", text.alias("text"), "spans")
    found = map_texts(joined, "text", schema, lambda: lambda data, bounds, rows: one(data, bounds, rows.field("spans")))
    return found.select(F.col("row.held").alias("row"), "result")


def _cut_bytes(data, bounds, spans):
    gone = repeats.flags_of(spans, bounds)
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    edge[inner] = gone[inner]
    kept = np.concatenate([[0], np.cumsum(~gone)])[bounds]
    held = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~gone]))])
    return [np.diff(bounds), arrays.sums(gone, bounds), arrays.sums(edge, bounds), held.cast(pa.binary())]


def _cut_text(data, bounds, spans):
    *counts, kept = _cut_bytes(data, bounds, spans)
    return [*counts, pa.array([b.decode("utf-8", "ignore") for b in kept.to_pylist()], pa.string())]
