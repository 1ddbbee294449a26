"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. The vector of an n-gram binds (multiplies) the
vectors of its letters, each rotated by its place. A text is the bundle (sum) of its n-gram vectors, a
language the bundle of its texts, and a text goes to the language of the largest cosine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts

DIMENSIONS = 1024
GRAM = 3
UNDEFINED = "und"
CHUNK_BYTES = 1 << 19
# Prototypes are held by every task: languages * dimensions doubles at most.
MAX_LANGUAGES = 4096

_SPACE = 0x20
_letters: dict = {}


def _letter_table() -> np.ndarray:
    """Lower-case letter of each code point, a space for all others."""
    if "table" not in _letters:
        table = np.full(0x110000, _SPACE, np.uint32)
        for code in range(0x110000):
            if not 0xD800 <= code < 0xE000 and (char := chr(code)).isalpha():
                low = char.lower()
                table[code] = ord(low) if len(low) == 1 else code
        _letters["table"] = table
    return _letters["table"]


def letter_vectors(codes: np.ndarray, dimensions: int) -> np.ndarray:
    """The random +1 / -1 vector of each letter, the same wherever it is computed."""
    at = codes.astype(np.uint64)[:, None] * np.uint64(1 << 32) + np.arange(dimensions, dtype=np.uint64)
    return ((arrays.mix(at + np.uint64(0x5DEECE66D)) >> np.uint64(63)).astype(np.int8) * 2 - 1).astype(np.int8)


def gram_counts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter n-grams of a chunk (rows of letters) and their counts by document.

    Words are letters between spaces; runs of anything else are one space.
    """
    docs = len(bounds) - 1
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    letters = _letter_table()[codes]
    chars = np.concatenate([[0], np.cumsum(arrays.NOT_CONTINUED[data])])[bounds]
    # A space before and after each document, so that even a single letter makes an n-gram.
    text = np.insert(letters, np.repeat(chars, 2), np.uint32(_SPACE))
    row = np.insert(np.repeat(np.arange(docs), np.diff(chars)), np.repeat(chars, 2), np.repeat(np.arange(-1, docs + 1), 2)[1:-1])
    blank = text == _SPACE
    keep = ~blank
    keep[1:] |= ~(blank[1:] & blank[:-1]) | (row[1:] != row[:-1])
    keep[0] = True
    text, row = text[keep], row[keep]
    present = np.zeros(0x110000, bool)
    present[text] = True
    alphabet = np.flatnonzero(present)
    number = np.zeros(0x110000, np.int64)
    number[alphabet] = np.arange(len(alphabet))
    small, base = number[text], len(alphabet)
    grams = small[: len(small) - GRAM + 1].copy() if len(small) >= GRAM else np.zeros(0, np.int64)
    for k in range(1, GRAM):
        grams = grams * base + small[k : len(small) - GRAM + 1 + k]
    inside = row[: len(grams)] == row[GRAM - 1 : GRAM - 1 + len(grams)]
    grams, row = grams[inside], row[: len(inside)][inside]
    if base**GRAM <= 1 << 24:
        seen = np.zeros(base**GRAM, bool)
        seen[grams] = True
        distinct = np.flatnonzero(seen)
        place = np.zeros(base**GRAM, np.int32)
        place[distinct] = np.arange(len(distinct))
        column = place[grams]
    else:
        distinct, column = np.unique(grams, return_inverse=True)
    counts = np.bincount(row * len(distinct) + column, minlength=docs * len(distinct)).reshape(docs, len(distinct))
    parts = np.stack([alphabet[distinct // base ** (GRAM - 1 - k) % base] for k in range(GRAM)], axis=1) if len(distinct) else np.zeros((0, GRAM), np.int64)
    return parts, counts


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """Bound vectors: the letters' vectors, rotated by place and multiplied."""
    letters, place = np.unique(grams, return_inverse=True)
    own, place = letter_vectors(letters, dimensions), place.reshape(grams.shape)
    bound = np.ones((len(grams), dimensions), np.int8)
    for k in range(GRAM):
        bound *= np.roll(own, GRAM - 1 - k, axis=1)[place[:, k]]
    return bound


def _narrow(data, bounds):
    """Sub-chunks with a bounded count matrix: a row of counts for at most 256 documents."""
    for first in range(0, len(bounds) - 1, 256):
        own = bounds[first : first + 257]
        yield data[own[0] : own[-1]], own - own[0]


def document_vectors(data: np.ndarray, bounds: np.ndarray, dimensions: int) -> np.ndarray:
    grams, counts = gram_counts(data, bounds)
    return counts.astype(np.float32) @ gram_vectors(grams, dimensions).astype(np.float32)


def train(docs: DataFrame, text_col: str, lang_col: str, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of each language: the bundle of all its texts, each text with the same weight.

    Tasks hand over one vector for each language they have seen; Spark adds them up by language and
    dimension. Only languages * dimensions sums reach the driver.
    """
    learn = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )

    def bundle(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1)
            for first, end, data, bounds in arrays.row_chunks(batch.column(0), CHUNK_BYTES):
                done = first
                for part, own in _narrow(data, bounds):
                    vectors = document_vectors(part, own, dimensions).astype(np.float64)
                    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
                    # Whole numbers, so that the order of adding does not matter.
                    vectors = np.rint(vectors * (2.0**20 / np.maximum(norm, 1e-9))).astype(np.int64)
                    names = np.array(langs.slice(done, len(own) - 1).to_pylist(), object)
                    for name in set(names):
                        totals[name] = totals.get(name, 0) + vectors[names == name].sum(axis=0)
                    done += len(own) - 1
        if totals:
            held = pa.array([v.tolist() for v in totals.values()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), held], ["lang", "vector"])

    parts = learn.mapInArrow(bundle, "lang STRING, vector ARRAY<BIGINT>")
    summed = parts.select("lang", F.posexplode("vector").alias("at", "value")).groupBy("lang", "at").agg(F.sum("value").alias("value"))
    by_lang = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("vector"))
    found = by_lang.orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array([v["value"] for v in r["vector"]], float) for r in found}


def identify(docs: DataFrame, learn: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> DataFrame:
    """Struct ``row`` (the document's columns), struct ``result``: lang_pred, score (the cosine, 0 to 1),
    margin (to the next language) and n_letters.

    ``learn`` holds the texts with languages to learn from; null texts and null languages in it
    are passed over. A null text, one without a letter, and every text when nothing could be learned, is
    ``und`` with score 0. Equal cosines go to the language first in the alphabet. Whole texts
    are used, rows never meet, and repeated rows get equal results.
    """
    prototypes = train(learn, text_col, lang_col, dimensions)
    names = sorted(prototypes)
    profile = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-9) for n in names]).reshape(len(names), dimensions)
    shared = docs.sparkSession.sparkContext.broadcast((names, profile.astype(np.float32)))

    def job():
        names, profile = shared.value

        def compare(data, bounds, rows):
            preds, scores, margins, sizes = [], [], [], []
            for part, own in _narrow(data, bounds):
                grams, counts = gram_counts(part, own)
                vectors = counts.astype(np.float32) @ gram_vectors(grams, dimensions).astype(np.float32)
                # Each letter is the middle of one n-gram.
                letters = counts[:, grams[:, GRAM // 2] != _SPACE].sum(axis=1)
                sizes.append(letters)
                norm = np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                cosines = np.clip((vectors / norm) @ profile.T, 0.0, 1.0).astype(float)
                for doc in range(len(own) - 1):
                    if not letters[doc] or not names:
                        preds.append(UNDEFINED), scores.append(0.0), margins.append(0.0)
                        continue
                    best = int(np.argmax(cosines[doc]))
                    rest = np.delete(cosines[doc], best)
                    preds.append(names[best]), scores.append(cosines[doc][best])
                    margins.append(cosines[doc][best] - (rest.max() if len(rest) else 0.0))
            return [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), np.concatenate(sizes)]

        return compare

    return map_texts(docs, text_col, "lang_pred STRING, score DOUBLE, margin DOUBLE, n_letters BIGINT", job, CHUNK_BYTES)
