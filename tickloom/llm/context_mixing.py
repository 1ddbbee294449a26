"""Language-model scores by logistic context mixing over bits.

A text is its bytes, A-Z in lower case, and an end symbol. Each symbol is eight binary decisions. For
every decision the contexts of zero to five bytes before it predict, each from its counts;
the predictions, as log odds, are added with weights that a gate selects (by the longest context that has been
seen and the number of the bit), and the sum is refined by an adaptive map. So every text has a
probability, and its cost in bits per byte.

The counts are exact, for any number of contexts. A gram is a symbol with the five bytes before it; the training
texts leave one stored table of their distinct grams, from which the counts of all contexts follow. Grams are dealt
to shards by the three bytes before the symbol, so a shard has all that contexts of three to five bytes need, and the number
of shards grows with the table. The counts of shorter contexts (at most 2^24 grams of three bytes) are held by every task.

Each shard learns weights over its grams block by block: the mixer predicts from the counts without the occurrence
at hand, and the weights move by the error; a second round also fills the adaptive map. The weights of all shards are averaged,
gate by gate, by the symbols that each has learned there. To be scored, the distinct grams of a block of
documents travel to the shards, and their probabilities back to the block.

Beside it stands the unigram score of words over the counts of all training words.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts, stored

ORDERS = 6  # contexts of 0, 1, ... 5 bytes
END = 0xFF  # no byte of UTF-8
LOW_ORDERS = range(3)  # held by every task; the others are dealt to shards
HIGH_ORDERS = range(3, ORDERS)
SHARD_BITS = 17  # a shard has about 2^17 grams of the training texts
ASKED_BITS = 4  # and is asked for about 2^4 times as many
CHUNK_BYTES = 1 << 22
WORD_CHUNK_BYTES = 1 << 21  # hashing takes many times as much memory
PRIOR = 0.2
# Sets of weights: longest seen context, how often it was seen, number of the bit.
SEEN_STEPS = np.array([1, 2, 4, 16, 64], np.float32)
GATES = ORDERS * len(SEEN_STEPS) * 8
STEPS = 33  # of the adaptive map, over log odds from -LIMIT to LIMIT
LIMIT = 12.0
FLOOR = 2.0**-16
# Weights are added up as whole numbers: (weight + SHIFT) * FIXED.
FIXED, SHIFT = 1 << 16, 64

# The most frequent words are held by every task; all others are looked up by a join.
HELD_WORDS = 1 << 19
SMOOTHING = 0.1
_END_WORD = np.uint64(0x454E44)


def decisions(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the five bytes before it in one number, and the first symbol of each document."""
    before = ORDERS - 1
    # Zeros stand before each document, the end symbol after it.
    marks = np.tile(np.array([END] + [0] * before, np.uint8), len(bounds))
    text = np.insert(arrays.LOWER[data], np.repeat(bounds, before + 1), marks)[1:].astype(np.uint64)
    keys = text[before:].copy()
    for back in range(1, before + 1):
        keys |= text[before - back : len(text) - back] << np.uint64(8 * back)
    docs = len(bounds) - 1
    first = bounds[:-1] + np.arange(docs) * (before + 1)  # of each document among the keys
    count = np.diff(bounds) + 1
    at = np.concatenate([[0], np.cumsum(count)])
    place = np.arange(at[-1]) + np.repeat(first - at[:-1], count)
    return keys[place], at


def _mixed(weights: np.ndarray, gate: np.ndarray, inputs: list[np.ndarray]) -> np.ndarray:
    total = weights[0][gate] * inputs[0]
    for order in range(1, ORDERS):
        total += weights[order][gate] * inputs[order]
    return total


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(total: np.ndarray) -> np.ndarray:
    return (np.clip(total, -LIMIT, LIMIT) + LIMIT) * np.float32((STEPS - 1) / (2 * LIMIT))


def _odds(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = zeros + ones
    return np.log((ones + np.float32(PRIOR)) / (zeros + np.float32(PRIOR))), np.searchsorted(SEEN_STEPS, total, "right")


def _move(weights: np.ndarray, gate: np.ndarray, inputs: list[np.ndarray], bit: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Predict a block, move the weights by its error, and give the predictions (log odds)."""
    total = _mixed(weights, gate, inputs)
    chance = _sigmoid(total)
    error, spread = (bit - chance) * times, np.maximum(chance * (1 - chance), 1e-3) * times
    for order in range(ORDERS):
        slope = np.bincount(gate, error * inputs[order], GATES)
        bend = np.bincount(gate, spread * inputs[order] ** 2, GATES)
        weights[order] += (1.0 / ORDERS * slope / (bend + 50.0)).astype(np.float32)
    return total


def _note(refine: np.ndarray, node: np.ndarray, total: np.ndarray, bit: np.ndarray, times: np.ndarray) -> None:
    """Count what came after a prediction."""
    near = node * STEPS + np.rint(_step(total)).astype(np.int64)
    for value in (0, 1):
        refine[value] += np.bincount(near, times * (bit == value), 256 * STEPS).astype(np.int64)


def _refined(refine: np.ndarray) -> np.ndarray:
    centre = _sigmoid(np.linspace(-LIMIT, LIMIT, STEPS))
    return ((refine[1] + 20 * centre) / (refine.sum(axis=0) + 20)).astype(np.float32).ravel()


def _log10_one(weights, refine, node, bit, inputs, gate) -> np.ndarray:
    """Probability of a decision, as a logarithm."""
    total = _mixed(weights, gate, inputs)
    step = _step(total)
    low = np.minimum(step.astype(np.int64), STEPS - 2)
    part, at = step - low, node * STEPS + low
    refined = (1 - part) * refine[at] + part * refine[at + 1]
    one = np.clip((_sigmoid(total) + refined) / 2, FLOOR, 1 - FLOOR)
    return np.log10(np.where(bit == 1, one, 1 - one))


def _gram(keys: np.ndarray, order: int) -> np.ndarray:
    """A symbol with ``order`` bytes before it."""
    return keys & np.int64((1 << 8 * (order + 1)) - 1)


class Counts:
    """Exact counts (zeros, ones) of all nodes after all contexts of some orders, from grams and how often each occurs."""

    def __init__(self, grams: np.ndarray, times: np.ndarray, orders):
        self.levels = {}
        for order in orders:
            codes, inverse = np.unique(_gram(grams, order), return_inverse=True)
            often = np.bincount(inverse, times, len(codes)).astype(np.int64)
            self.levels[order] = [self._nodes(codes, often, number) for number in range(8)]

    @staticmethod
    def _nodes(codes, often, number):
        nodes = codes >> (8 - number)
        if not len(codes):
            return nodes, often, often
        heads = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]]))
        ones = np.add.reduceat(often * ((codes >> (7 - number)) & 1), heads)
        return nodes[heads], np.add.reduceat(often, heads) - ones, ones

    def of(self, order: int, number: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, zeros, ones = self.levels[order][number]
        if not len(nodes):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        wanted = codes >> (8 - number)
        at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
        known = nodes[at] == wanted
        return np.where(known, zeros[at], 0), np.where(known, ones[at], 0)


def exact_predictions(keys: np.ndarray, counts: dict[int, Counts], own: int = 0):
    """For each of the eight bits: node, bit, log odds by order, gate; the counts lack ``own`` occurrences of each gram."""
    symbol = keys & 0xFF
    grams = [np.unique(_gram(keys, order), return_inverse=True) for order in range(ORDERS)]
    for number in range(8):
        node, bit = (1 << number) | (symbol >> (8 - number)), (symbol >> (7 - number)) & 1
        inputs, gate = [], np.zeros(len(keys), np.int64)
        for order, (codes, inverse) in enumerate(grams):
            zeros, ones = counts[order].of(order, number, codes)
            one = (codes >> (7 - number)) & 1
            odds, often = _odds((zeros - own * (1 - one)).astype(np.float32), (ones - own * one).astype(np.float32))
            inputs.append(odds[inverse])
            often = often[inverse]
            gate = np.where(often > 0, order * len(SEEN_STEPS) - 1 + often, gate)
        yield node, bit, inputs, gate * 8 + number


def shard_of(keys, shards: int):
    """The shard of grams, by the three bytes before the symbol; for arrays and columns alike."""
    if isinstance(keys, np.ndarray):
        return ((keys >> 8) & 0xFFFFFF) * 2654435 % 16777213 % shards
    return F.shiftright(keys, 8).bitwiseAND(0xFFFFFF) * F.lit(2654435).cast("long") % 16777213 % shards


def gram_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Stored table (gram, times): all distinct symbols with five bytes before them, counted; a null is an empty text."""

    def count(batches):
        for batch in batches:
            for _, _, data, bounds in arrays.row_chunks(batch.column(0), CHUNK_BYTES):
                grams, times = np.unique(decisions(data, bounds)[0].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(times)], ["gram", "times"])

    parts = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "gram BIGINT, times BIGINT")
    return stored(parts.groupBy("gram").agg(F.sum("times").alias("times")), "gram-counts")


def learn_grams(grams: np.ndarray, times: np.ndarray, counts: dict[int, Counts]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, symbols learned by gate, and what came after predictions, from the grams of a shard."""
    weights, mass = np.full((ORDERS, GATES), 0.3, np.float32), np.zeros(GATES)
    refine = np.zeros((2, 256 * STEPS), np.int64)
    order = np.argsort(arrays.mix(grams.view(np.uint64)), kind="stable")
    size = min(max(len(grams) // 64, 1 << 10), 1 << 13)
    for last in (False, True):
        for low in range(0, len(order), size):
            part = np.sort(order[low : low + size])
            for node, bit, inputs, gate in exact_predictions(grams[part], counts, own=1):
                total = _move(weights, gate, inputs, bit, times[part])
                if last:
                    mass += np.bincount(gate, times[part], GATES)
                    _note(refine, node, total, bit, times[part])
    return weights, mass, refine


@dataclass(frozen=True)
class Blend:
    """What is learned besides the counts of longer contexts: counts of the shorter ones, weights, adaptive map."""

    low: Counts
    weights: np.ndarray
    refine: np.ndarray

    def log10(self, keys: np.ndarray, high: Counts) -> np.ndarray:
        """Probability of each symbol after its context, as a logarithm."""
        found = np.zeros(len(keys))
        for low in range(0, len(keys), 1 << 16):
            for decision in _each_decision(keys[low : low + (1 << 16)], self.low, high):
                found[low : low + (1 << 16)] += _log10_one(self.weights, self.refine, *decision)
        return found


def _by_order(low: Counts, high: Counts) -> dict[int, Counts]:
    return {order: low if order in LOW_ORDERS else high for order in range(ORDERS)}


def _each_decision(keys: np.ndarray, low: Counts, high: Counts):
    return exact_predictions(keys, _by_order(low, high))


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(table["gram"].to_numpy())
    return table["gram"].to_numpy()[order], table["times"].to_numpy()[order]


def train(grams: DataFrame, bits: int = SHARD_BITS) -> Blend:
    """Learn from a table of ``gram_counts`` in shards of about 2^bits grams."""
    spark = grams.sparkSession
    short = grams.groupBy(F.col("gram").bitwiseAND(0xFFFFFF).alias("gram")).agg(F.sum("times").alias("times")).toArrow()
    low = Counts(*_columns(short), LOW_ORDERS)  # at most 2^24 grams of three bytes, whatever the input
    shards = max(-(-grams.count() // (1 << bits)), 1)
    shared = spark.sparkContext.broadcast(low)

    def learn(table: pa.Table) -> pa.Table:
        keys, times = _columns(table)
        found = learn_grams(keys, times, _by_order(shared.value, Counts(keys, times, HIGH_ORDERS)))
        return pa.table({name: pa.array([part.tobytes()], pa.binary()) for name, part in zip(("weights", "mass", "refine"), found)})

    learned = grams.withColumn("shard", shard_of(F.col("gram"), shards)).groupBy("shard").applyInArrow(learn, "weights BINARY, mass BINARY, refine BINARY")
    weights, mass, refine = np.zeros((ORDERS, GATES)), np.zeros(GATES), np.zeros((2, 256 * STEPS), np.int64)
    for row in learned.orderBy("mass", "weights").toLocalIterator():
        own = np.frombuffer(row["mass"])
        weights += np.frombuffer(row["weights"], np.float32).reshape(ORDERS, GATES) * own
        mass += own
        refine += np.frombuffer(row["refine"], np.int64).reshape(2, -1)
    weights = np.where(mass > 0, weights / np.maximum(mass, 1), 0.3)
    return Blend(low, weights.astype(np.float32), _refined(refine.reshape(2, 256, STEPS)))


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences."""
    return zstandard.compress(np.diff(values, prepend=0).astype(np.int64).tobytes())


def _unpacked(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(packed), np.int64))


def gram_scores(found: DataFrame, grams: DataFrame, blend, bits: int) -> DataFrame:
    """uid and score of the documents of blocks: their grams are looked up in the shards.

    ``found`` has a row for each block: block (the uid of its first document), n_asked and asked (its distinct grams),
    bounds and texts (of its documents, which have consecutive uids), compressed.
    """
    asked = found.select("block", "asked")
    n_asked = found.agg(F.coalesce(F.sum("n_asked"), F.lit(0))).first()[0]
    shards = max(-(-grams.count() // (1 << bits)), -(-n_asked // (1 << bits + ASKED_BITS)), 1)

    def deal(batches):
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys = _unpacked(packed)
                shard = shard_of(keys, shards)
                order = np.argsort(shard, kind="stable")
                heads = np.searchsorted(shard[order], np.arange(shards + 1))
                held = [(n, _packed(keys[order[a:b]])) for n, (a, b) in enumerate(zip(heads[:-1], heads[1:])) if b > a]
                names = [pa.array([block] * len(held), pa.int64()), pa.array([n for n, _ in held], pa.int64()), pa.array([k for _, k in held], pa.binary())]
                yield pa.RecordBatch.from_arrays(names, ["block", "shard", "keys"])

    def answer(own: pa.Table, parts: pa.Table) -> pa.Table:
        high = Counts(*_columns(own), HIGH_ORDERS)
        keys = [_unpacked(packed) for packed in parts["keys"].to_pylist()]
        distinct, inverse = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_inverse=True)
        values = blend.value.log10(distinct, high).astype(np.float32)[inverse]
        at = np.cumsum([0, *(len(k) for k in keys)])
        packed = pa.array([values[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
        return pa.table({"block": parts["block"], "shard": parts["shard"], "chances": packed})

    def add(texts: pa.Table, parts: pa.Table) -> pa.Table:
        block, packed, bounds = (texts[name][0].as_py() for name in ("block", "texts", "bounds"))
        data, bounds = np.frombuffer(zstandard.decompress(packed), np.uint8), _unpacked(bounds)
        keys, begin = decisions(data, bounds)
        distinct, inverse = np.unique(keys.view(np.int64), return_inverse=True)
        shard, value = shard_of(distinct, shards), np.zeros(len(distinct))
        for number, packed in zip(parts["shard"].to_pylist(), parts["chances"].to_pylist()):
            value[shard == number] = np.frombuffer(packed, np.float32)
        score = np.bincount(arrays.owners(begin), value[inverse], len(bounds) - 1)
        return pa.table({"uid": pa.array(block + np.arange(len(score))), "score": pa.array(score)})

    dealt = asked.mapInArrow(deal, "block BIGINT, shard BIGINT, keys BINARY")
    own = grams.withColumn("shard", shard_of(F.col("gram"), shards))
    chances = own.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(answer, "block BIGINT, shard BIGINT, chances BINARY")
    texts = found.select("block", "bounds", "texts")
    return texts.groupBy("block").cogroup(chances.groupBy("block")).applyInArrow(add, "uid BIGINT, score DOUBLE")


def _word_codes(data, bounds):
    """Hashes of all words with the end word after each text, and the first one of each text."""
    low = arrays.LOWER[data]
    starts, ends, first = arrays.words(low, bounds, arrays.NOT_SPACE)
    codes = np.insert(arrays.byte_hash(low, starts, ends), first[1:], _END_WORD)
    return codes, first + np.arange(len(first))


def word_counts(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Stored table (word, count): 64-bit hashes of all words and the end of all texts, counted."""

    def count(batches):
        for batch in batches:
            for _, _, data, bounds in arrays.row_chunks(batch.column(0), WORD_CHUNK_BYTES):
                words, counts = np.unique(_word_codes(data, bounds)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "count"])

    parts = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "word BIGINT, count BIGINT")
    return stored(parts.groupBy("word").agg(F.sum("count").alias("count")), "word-counts")


RESULT = "n_tokens BIGINT, n_bytes BIGINT, held_sum DOUBLE, held_known BIGINT, rare ARRAY<BIGINT>, uid BIGINT, block STRUCT<n_asked: BIGINT, asked: BINARY, bounds: BINARY, texts: BINARY>"


def score(
    docs: DataFrame, learn: DataFrame, text_col: str = "text", bits: int = SHARD_BITS, held_words: int = HELD_WORDS, keep_text: bool = True
) -> DataFrame:
    """Scores of every document under models of the texts of ``learn``.

    Struct ``row`` (the document's columns; without ``keep_text`` all but the text) beside n_tokens, n_known, train_tokens, base_score (unigram), score (log10
    probability of the text by context mixing) and bits_per_byte (the end counts as one byte). Null and
    empty texts are one end. Without training texts the base is uniform over one unseen token, and the
    mixer gives one half for every bit. Every row comes back once, repeated rows alike.
    """
    spark = docs.sparkSession
    counts = word_counts(learn, text_col)
    size = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    n_train, n_distinct = int(size[0]), int(size[1])
    top = counts.orderBy(F.desc("count"), "word").limit(held_words).toArrow()
    words, often = top["word"].to_numpy().view(np.uint64), top["count"].to_numpy()
    order = np.argsort(words)
    shared = spark.sparkContext.broadcast((words[order], np.log10(often[order] + SMOOTHING)))  # of fixed size
    grams = gram_counts(learn, text_col)
    blend = spark.sparkContext.broadcast(train(grams, bits))

    def job():
        words, value = shared.value
        block = TaskContext.get().partitionId() << 40

        def one(data, bounds, rows):
            nonlocal block
            codes, first = _word_codes(data, bounds)
            distinct, inverse = np.unique(codes, return_inverse=True)
            at = np.minimum(np.searchsorted(words, distinct), max(len(words) - 1, 0))
            held = words[at] == distinct if len(words) else np.zeros(len(distinct), bool)
            part = np.where(held, value[at], 0.0)[inverse] if len(words) else np.zeros(len(codes))
            known = held[inverse]
            rare = codes[~known].view(np.int64)
            asked = np.unique(decisions(data, bounds)[0])
            row = arrays.owners(first)
            docs = len(bounds) - 1
            uid, block = block + np.arange(docs), block + docs
            own = {"n_asked": len(asked), "asked": _packed(asked.view(np.int64)), "bounds": _packed(bounds), "texts": zstandard.compress(data.tobytes())}
            kind = pa.struct([("n_asked", pa.int64()), ("asked", pa.binary()), ("bounds", pa.binary()), ("texts", pa.binary())])
            return [
                np.diff(first),
                np.diff(bounds),
                np.bincount(row, part, docs),
                np.bincount(row, known, docs).astype(np.int64),
                arrays.lists(rare, np.concatenate([[0], np.cumsum(~known)])[first]),
                uid,
                pa.array([own] + [None] * (docs - 1), kind),  # with the first document of a block
            ]

        return one

    found = map_texts(docs, text_col, RESULT, job, CHUNK_BYTES)
    # The texts of a block are stored with its first document, so the rows need not carry theirs too.
    row = F.col("row") if keep_text else F.col("row").dropFields(f"`{text_col}`").alias("row")
    scored = stored(found.select(row, "result.*"), "scores")
    # Words beyond the held ones are rare by construction: none of them is a hot key.
    rare = scored.select("uid", F.explode("rare").alias("word")).groupBy("uid", "word").agg(F.count("*").alias("times"))
    looked = (
        rare.join(counts, "word", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + SMOOTHING)).alias("rare_sum"),
            F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    mixed = gram_scores(scored.where("block IS NOT NULL").select(F.col("uid").alias("block"), *(f"block.{c}" for c in ("n_asked", "asked", "bounds", "texts"))), grams, blend, bits)
    total = math.log10(n_train + SMOOTHING * (n_distinct + 1))
    zero = F.lit(0)
    return scored.drop("rare", "block").join(mixed, "uid").join(looked, "uid", "left").select(
        "row",
        "n_tokens",
        (F.col("held_known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("held_sum") + F.coalesce("rare_sum", zero) - F.col("n_tokens") * total).alias("base_score"),
        "score",
        (-F.col("score") * math.log2(10) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
