"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark texts.

Texts are reduced to lower-case words with one space between them. The windows of all items
become the keys of one automaton, and each document is scanned once. Matches are mapped back to
words and to character offsets of the original text.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts, stored

WINDOW_WORDS = 13
# Keys of one automaton, in characters. A larger benchmark is matched by several automata, one after another.
MAX_KEY_CHARS = 64_000_000

_SPACE, _EDGE = 0x20, 0x0A
_NORMAL = np.where(arrays.ALNUM, arrays.LOWER, np.uint8(_SPACE))

RESULT = """n_words BIGINT, n_hit BIGINT, items ARRAY<STRING>,
    spans ARRAY<STRUCT<first_char: BIGINT, end_char: BIGINT>>, hit_words ARRAY<BIGINT>"""


def normalised(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words of all documents with single spaces; an edge byte stands between two documents."""
    at = np.repeat(bounds, 3)
    text = np.insert(_NORMAL[data], at, np.tile(np.array([_SPACE, _EDGE, _SPACE], np.uint8), len(bounds)))
    blank = text == _SPACE
    keep = ~blank
    keep[0] = True
    keep[1:] |= ~blank[:-1]
    return text[keep]


def window_keys(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row for each distinct window: its key and the ids of its items (none for null ids)."""

    def job():
        def keys(data, bounds, rows):
            starts, ends, first = arrays.words(data, bounds, arrays.ALNUM)
            lowered, found = arrays.LOWER[data].tobytes(), []
            for a, b in zip(first[:-1], first[1:]):
                own = [lowered[s:e] for s, e in zip(starts[a:b], ends[a:b])]
                spans = range(max(len(own) - window, 0) + 1) if own else ()
                found.append([b" " + b" ".join(own[i : i + window]) + b" " for i in spans])
            return [pa.array(found, pa.list_(pa.binary()))]

        return keys

    found = map_texts(items.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")), "text", "keys ARRAY<BINARY>", job)
    return (
        found.select(F.col("row.item").cast("string").alias("item"), F.explode("result.keys").alias("key"))
        .groupBy("key")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _scanner(keys):
    """Match function over the keys of a broadcast."""
    automaton = ahocorasick.Automaton()
    for number, (key, _) in enumerate(keys):
        automaton.add_word(key.decode("latin-1"), number)
    if keys:
        automaton.make_automaton()
    size = np.array([len(key) for key, _ in keys], np.int64)
    count = np.array([key.count(b" ") - 1 for key, _ in keys], np.int64)

    def scan(data, bounds, rows):
        starts, ends, first = arrays.words(data, bounds, arrays.ALNUM)
        docs = len(bounds) - 1
        text = normalised(data, bounds)
        # Each byte is one character here, so that positions in both are the same.
        hits = list(automaton.iter(text.tobytes().decode("latin-1"))) if keys else []
        last, number = np.array(hits, np.int64).reshape(-1, 2).T
        blank = (text == _SPACE) | (text == _EDGE)
        heads = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
        word = np.searchsorted(heads, last - size[number] + 2)
        flags = arrays.covered(word, word + count[number], len(starts)) if len(hits) else np.zeros(len(starts), bool)

        before = list(rows.field("hit_words")) if "hit_words" in [f.name for f in rows.type] else None
        if before is not None:  # an earlier automaton's matches
            for doc, held in enumerate(before):
                if held.is_valid and len(held):
                    flags[first[doc] + np.array(held.as_py())] = True

        row_of = arrays.owners(first)
        items = [set() for _ in range(docs)]
        for doc, key in set(zip(row_of[word].tolist(), number.tolist())):
            items[doc].update(keys[key][1])
        if before is not None:
            for doc, held in enumerate(rows.field("items")):
                items[doc].update(held.as_py() or ())

        hit = np.flatnonzero(flags)
        per_doc = np.concatenate([[0], np.cumsum(arrays.sums(flags, first))])
        # Runs of hit words that do not cross a document, as characters of the original.
        head = np.ones(len(hit), bool)
        head[1:] = (np.diff(hit) > 1) | (row_of[hit[1:]] != row_of[hit[:-1]])
        head_at = np.flatnonzero(head)
        tail_at = np.append(head_at[1:], len(hit))[: len(head_at)] - 1
        chars = np.concatenate([[0], np.cumsum(arrays.NOT_CONTINUED[data])])
        origin = chars[bounds[row_of[hit[head_at]]]]
        spans = pa.StructArray.from_arrays([pa.array(chars[starts[hit[head_at]]] - origin), pa.array(chars[ends[hit[tail_at]]] - origin)], ["first_char", "end_char"])
        per_span = np.concatenate([[0], np.cumsum(np.bincount(row_of[hit[head_at]], minlength=docs))])
        return [
            np.diff(first),
            np.diff(per_doc),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            arrays.lists(spans, per_span),
            arrays.lists(hit - first[row_of[hit]], per_doc),
        ]

    return scan


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW_WORDS,
    max_key_chars: int = MAX_KEY_CHARS,
) -> DataFrame:
    """Match every document against the windows of all benchmark items.

    Returns struct ``row`` (the document's columns as they are) and struct ``result``: n_words,
    n_hit (words inside an occurrence of a window), items (sorted ids of items with occurring
    windows), spans (hit runs in characters of the original text), hit_words (their numbers).

    The keys are broadcast; their size is counted first, and a benchmark above
    ``max_key_chars`` is dealt to several automata by key hash, each of which scans the documents
    in its own pass over a stored table. Null and empty texts have no words, an item without
    words matches nothing, an item without id marks words but is not listed, and repeated rows
    are treated alike. Every row of ``docs`` comes back once.
    """
    spark = docs.sparkSession
    keys = stored(window_keys(items, item_id_col, item_text_col, window), "benchmark-keys")
    chars = keys.agg(F.sum(F.length("key"))).first()[0] or 0
    passes = max(1, -(-chars // max_key_chars))
    found = None
    for number in range(passes):
        own = keys.where(F.pmod(F.xxhash64("key"), F.lit(passes)) == number).collect()  # at most about max_key_chars
        shared = spark.sparkContext.broadcast([(bytes(r["key"]), list(r["items"])) for r in own])

        def job(shared=shared):
            return _scanner(shared.value)

        if found is None:
            found = map_texts(docs, text_col, RESULT, job)
        else:
            wrapped = stored(found, "decontamination").select(
                F.col(f"row.`{text_col}`").alias("text"), F.col("row").alias("held"), "result.hit_words", "result.items"
            )
            again = map_texts(wrapped, "text", RESULT, job)
            found = again.select(F.col("row.held").alias("row"), "result")
    return found


def is_contaminated(result: str = "result"):
    """One word in twenty or more lies in a benchmark window."""
    hit, words = F.col(f"{result}.n_hit"), F.col(f"{result}.n_words")
    return (hit > 0) & (20 * hit >= words)
