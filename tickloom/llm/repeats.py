"""Repeated windows across a corpus, found through minimisers.

A text is a sequence of units (bytes or words). Each window of ``window`` units has a minimiser:
the leftmost of its n-grams of the smallest hash. Equal windows have equal minimisers at equal places, so
they need to be compared only within the bucket of one minimiser. Consecutive windows with
the same minimiser form a run, which travels as one packed string.

Runs are first counted by a 128-bit digest: a run that occurs twice as a whole is repeated in all
its windows, and copies, however many, leave one string. Only buckets that hold different runs need their
strings, one for each distinct run. Buckets of more than ``max_bucket`` distinct runs are dealt out again by
single windows, so that no task ever gets a bucket without bound.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts, stored

# Different runs of a bucket that one task compares; their strings are a few MB at most.
MAX_BUCKET = 4096
# Strings of a bucket job that are looked at together; a bucket is never divided.
GROUP_BYTES = 1 << 21

KEY = ("doc", "code")


@dataclass(frozen=True)
class Units:
    """How a text is seen: its canonical bytes, the symbols of its units, and where each unit stands."""

    text: np.ndarray
    symbols: np.ndarray
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def byte_units(data: np.ndarray, bounds: np.ndarray) -> Units:
    at = np.arange(len(data) + 1)
    return Units(data, arrays._BYTE_VALUES[data], bounds, at[:-1], at[1:])


def word_units(data: np.ndarray, bounds: np.ndarray) -> Units:
    """Words of any ASCII white space, with exactly one space after each."""
    blank = ~arrays.NOT_SPACE
    text = np.insert(np.where(blank[data], np.uint8(0x20), data), bounds, np.uint8(0x20))
    space = text == 0x20
    keep = ~space
    keep[1:] |= ~space[:-1]
    text = text[keep]
    space = text == 0x20
    starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    ends = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    first = arrays.words(data, bounds, arrays.NOT_SPACE)[2]
    return Units(text, arrays.byte_hash(text, starts, ends), first, starts, ends)


def minimisers(symbols: np.ndarray, at: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of the minimiser of the windows that start at ``at``."""
    heads = np.arange(max(len(symbols) - gram + 1, 0))
    codes = arrays.range_hash(symbols, heads, heads + gram)
    span = window - gram + 1
    # 32 bits of the hash, then the place: the leftmost of equal hashes is the smallest.
    keys = (codes >> np.uint64(32) << np.uint64(32)) | heads.astype(np.uint64)
    blocks = -(-len(keys) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(keys)] = keys
    grid = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[at], ahead[at + span - 1])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return place, codes[place]


def runs_of(units: Units, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: document, first unit (in the chunk), number of windows, minimiser's hash."""
    at = arrays.window_starts(units.first, window)
    if not len(at):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    place, code = minimisers(units.symbols, at, window, gram)
    head = np.ones(len(at), bool)
    head[1:] = (place[1:] != place[:-1]) | (np.diff(at) != 1)
    edges = np.flatnonzero(head)
    count = np.diff(np.append(edges, len(at)))
    start = at[edges]
    row = np.searchsorted(units.first, start, "right") - 1
    return row, start, count, code[edges].view(np.int64)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc, code and text: ids (a null comes first), a code that tells rows of one id apart, texts without nulls."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("doc"), F.hash(text).alias("code"), text.alias("text"))


def find_runs(texts: DataFrame, see: Callable, window: int, gram: int) -> DataFrame:
    """Stored table of all runs: doc, code, start, n_windows, anchor, digest."""

    def job():
        def one(data, bounds, rows):
            units = see(data, bounds)
            row, start, count, code = runs_of(units, window, gram)
            raw = units.text.tobytes()
            a, b = units.starts[start], units.ends[start + count + window - 2]
            digests = [blake2b(raw[i:j], digest_size=16).digest() for i, j in zip(a.tolist(), b.tolist())]
            found = pa.StructArray.from_arrays(
                [pa.array((start - units.first[row]).astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(code), pa.array(digests, pa.binary())],
                ["start", "n_windows", "anchor", "digest"],
            )
            return [arrays.lists(found, np.searchsorted(row, np.arange(len(bounds))))]

        return one

    found = map_texts(texts, "text", "runs ARRAY<STRUCT<start: INT, n_windows: INT, anchor: BIGINT, digest: BINARY>>", job)
    return stored(found.select("row.doc", "row.code", F.explode("result.runs").alias("run")).select(*KEY, "run.*"), "runs")


def distinct_runs(runs: DataFrame) -> DataFrame:
    """Stored table of the runs that can repeat: anchor, digest, n (occurrences), lead (the first one), n_digests.

    A run is left out when its bucket holds nothing else.
    """
    counted = runs.groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "start", "n_windows")).alias("lead"))
    buckets = counted.groupBy("anchor").agg(F.count("*").alias("n_digests"), F.sum("n").alias("total")).where("total > 1")
    return stored(counted.join(buckets.drop("total"), "anchor"), "distinct-runs")


def packed_strings(texts: DataFrame, chosen: DataFrame, see: Callable, window: int) -> DataFrame:
    """Stored table: the columns of ``chosen`` (with ``lead``) and ``packed``, the run's units as one string."""
    wanted = chosen.groupBy(F.col("lead.doc").alias("doc"), F.col("lead.code").alias("code")).agg(
        F.collect_list(F.struct("anchor", "digest", "n", "n_digests", F.col("lead.start").alias("start"), F.col("lead.n_windows").alias("n_windows"))).alias("wanted")
    )
    # Repeated rows of one id and text are the same; one is enough.
    joined = texts.join(wanted, list(KEY)).dropDuplicates(list(KEY))

    def job():
        def one(data, bounds, rows):
            units = see(data, bounds)
            raw = units.text.tobytes()
            held = rows.field("wanted")
            flat, at = held.flatten(), np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy())])
            start = flat.field("start").to_numpy() + units.first[:-1][arrays.owners(at)]
            end = start + flat.field("n_windows").to_numpy() + window - 2
            strings = [raw[i:j] for i, j in zip(units.starts[start].tolist(), units.ends[end].tolist())]
            return [arrays.lists(pa.array(strings, pa.binary()), at)]

        return one

    found = map_texts(joined, "text", "strings ARRAY<BINARY>", job)
    listed = found.select("row.doc", "row.code", F.explode(F.arrays_zip("row.wanted", F.col("result.strings").alias("packed"))).alias("one"))
    return stored(listed.select(*KEY, "one.wanted.*", "one.packed"), "packed-runs")


def by_bucket(strings: DataFrame, job: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run ``job`` over whole buckets: tables of packed strings in which each anchor is complete."""
    dealt = strings.repartition("anchor").sortWithinPartitions("anchor", "digest")

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP_BYTES:
                table = pa.Table.from_batches(held)
                anchors = table["anchor"].to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1], "left"))
                if cut:
                    yield from _in_parts(table.slice(0, cut))
                    held = table.slice(cut).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
        if held and sum(len(b) for b in held):
            yield from _in_parts(pa.Table.from_batches(held))

    def _in_parts(table: pa.Table) -> Iterator[pa.RecordBatch]:
        anchors = table["anchor"].to_numpy()
        heads = np.concatenate([[0], np.flatnonzero(anchors[1:] != anchors[:-1]) + 1, [len(anchors)]])
        sizes = np.concatenate([[0], np.cumsum(pa.compute.binary_length(table["packed"]).to_numpy())])
        first = 0
        while first < len(heads) - 1:
            end = int(np.searchsorted(sizes[heads], sizes[heads[first]] + GROUP_BYTES, "right")) - 1
            end = min(max(end, first + 1), len(heads) - 1)
            yield from job(table.slice(heads[first], heads[end] - heads[first]).combine_chunks()).to_batches()
            first = end

    return dealt.mapInArrow(groups, schema)


def single_windows(strings: DataFrame, unit_spans: Callable, window: int) -> DataFrame:
    """The windows of packed strings one by one: the strings' columns but the string, ``at`` and ``window_digest``."""

    def split(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            index, at, digests = [], [], []
            for row, packed in enumerate(table["packed"].to_pylist()):
                starts, ends = unit_spans(packed)
                for i in range(len(starts) - window + 1):
                    index.append(row), at.append(i)
                    digests.append(blake2b(packed[starts[i] : ends[i + window - 1]], digest_size=16).digest())
            for low in range(0, len(index), 20_000):
                part = table.drop(["packed"]).take(pa.array(index[low : low + 20_000], pa.int64()))
                part = part.append_column("at", pa.array(at[low : low + 20_000], pa.int32()))
                yield from part.append_column("window_digest", pa.array(digests[low : low + 20_000], pa.binary())).combine_chunks().to_batches()

    kinds = ", ".join(f"{name} {kind}" for name, kind in strings.dtypes if name != "packed")
    return strings.mapInArrow(split, f"{kinds}, at INT, window_digest BINARY")


def spans_by_document(parts: list[DataFrame]) -> DataFrame:
    """Ranges (doc, code, lo, hi) of all parts as one list for each document, no longer than its own runs."""
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together.groupBy(*KEY).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def flags_of(spans: pa.ListArray, first: np.ndarray) -> np.ndarray:
    """Units covered by each row's spans, over the units of a chunk."""
    flat = spans.flatten()
    row = arrays.owners(np.concatenate([[0], np.cumsum(spans.value_lengths().fill_null(0).to_numpy())]))
    lo = flat.field("lo").to_numpy() + first[row]
    hi = np.minimum(flat.field("hi").to_numpy() + first[row], first[row + 1])
    return arrays.covered(lo, hi, int(first[-1]))
