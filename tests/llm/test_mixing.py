"""Exact counts and weights of the context mixer, whatever the number of contexts and partitions."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tickloom.llm import context_mixing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").limit(60)


def test_counts_of_contexts_are_exact(docs):
    grams = context_mixing.gram_counts(docs).toArrow()
    keys, times = context_mixing._columns(grams)
    wanted = {order: Counter() for order in range(context_mixing.ORDERS)}
    for text in (r["text"] for r in docs.collect()):
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()) + b"\xff"
        for at, symbol in enumerate(data):
            before = (bytes(5) + data[:at])[-5:]
            for order in wanted:
                wanted[order][before[5 - order :], symbol] += 1
    counts = context_mixing.Counts(keys, times, range(context_mixing.ORDERS))
    for order, held in wanted.items():
        context, symbol = list(held)[len(held) // 2]
        code = np.array([int.from_bytes(context, "big") << 8 | symbol], np.int64)
        for number in range(8):
            same = [(s, n) for (c, s), n in held.items() if c == context and s >> (8 - number) == symbol >> (8 - number)]
            ones = sum(n for s, n in same if s >> (7 - number) & 1)
            zeros, found = counts.of(order, number, code)
            assert (zeros[0], found[0]) == (sum(n for _, n in same) - ones, ones)


def _blend(text):
    """What a single shard learns from one text, and its counts of longer contexts."""
    data = np.frombuffer(text.encode(), np.uint8)
    keys = context_mixing.decisions(data, np.array([0, len(data)]))[0].view(np.int64)
    grams, times = np.unique(keys, return_counts=True)
    low, high = (context_mixing.Counts(grams, times, orders) for orders in (context_mixing.LOW_ORDERS, context_mixing.HIGH_ORDERS))
    weights, _, refine = context_mixing.learn_grams(grams, times, context_mixing._by_order(low, high))
    shape = (2, 256, context_mixing.STEPS)
    return context_mixing.Blend(low, weights, context_mixing._refined(refine.reshape(shape))), high, keys


def test_probabilities_of_a_context_add_to_one():
    blend, high, keys = _blend("the cat sat on the mat and the dog sat on the log. " * 300)
    for before in (b"n the", b"\x00\x00\x00\x00\x00", b"zzzzz", b"t sat"):
        symbols = (int.from_bytes(before, "big") << 8) | np.arange(256, dtype=np.int64)
        assert (10 ** blend.log10(symbols, high)).sum() == pytest.approx(1.0, abs=1e-4)
    assert -blend.log10(keys, high).sum() / np.log10(2) / len(keys) < 0.5


def test_probabilities_against_a_plain_mixer():
    """Bit by bit in plain Python, from the same weights and counts kept in dictionaries."""
    text = "a rose is a rose is a rose; " * 40
    blend, high, _ = _blend(text)
    data = text.encode() + b"\xff"
    seen = Counter()
    for at, symbol in enumerate(data):
        before = (bytes(5) + data[:at])[-5:]
        for order in range(context_mixing.ORDERS):
            for number in range(8):
                node = (1 << number) | (symbol >> (8 - number))
                seen[before[5 - order :], node, symbol >> (7 - number) & 1] += 1
    steps, refine = context_mixing.STEPS, blend.refine
    for at in (0, 7, 300, len(data) - 1):
        before, symbol, wanted = (bytes(5) + data[:at])[-5:], data[at], 0.0
        for number in range(8):
            node, bit, gate, odds = (1 << number) | (symbol >> (8 - number)), symbol >> (7 - number) & 1, 0, []
            for order in range(context_mixing.ORDERS):
                zeros, ones = (seen[before[5 - order :], node, value] for value in (0, 1))
                odds.append(np.log((ones + context_mixing.PRIOR) / (zeros + context_mixing.PRIOR)))
                often = sum(zeros + ones >= step for step in context_mixing.SEEN_STEPS)
                gate = order * len(context_mixing.SEEN_STEPS) - 1 + often if often else gate
            total = sum(blend.weights[order][gate * 8 + number] * o for order, o in enumerate(odds))
            place = (min(max(total, -context_mixing.LIMIT), context_mixing.LIMIT) + context_mixing.LIMIT) * (steps - 1) / (2 * context_mixing.LIMIT)
            low = min(int(place), steps - 2)
            refined = (1 - place + low) * refine[node * steps + low] + (place - low) * refine[node * steps + low + 1]
            one = min(max((1 / (1 + np.exp(-total)) + refined) / 2, context_mixing.FLOOR), 1 - context_mixing.FLOOR)
            wanted += np.log10(one if bit else 1 - one)
        key = np.array([int.from_bytes(before + bytes([symbol]), "big")], np.int64)
        assert blend.log10(key, high)[0] == pytest.approx(wanted, abs=1e-4)


def test_rows_may_go_without_their_text(docs):
    found = context_mixing.score(docs, docs, bits=14, keep_text=False)
    assert found.select("row.*").columns == ["doc_id"] and found.count() == 60


def test_no_context_is_lost_among_many(spark):
    """Contexts far beyond the slots of a table of 2^bits: a text that was learned stays cheap."""
    draw = np.random.default_rng(3)
    noise = ["".join(map(chr, draw.integers(97, 123, 4000))) for _ in range(60)]
    learn = spark.createDataFrame([(n, t) for n, t in enumerate([*noise, "wxyzq " * 50])], "doc_id BIGINT, text STRING")
    found = context_mixing.score(learn, learn, bits=12).select("row.doc_id", "bits_per_byte").collect()
    cost = {r["doc_id"]: r["bits_per_byte"] for r in found}
    assert cost[60] < 0.5


def test_weights_are_learned_whatever_the_partitions(docs):
    scores = []
    for parts in (1, 7):
        table = docs.repartition(parts, "doc_id")
        found = context_mixing.score(table, table, bits=14).select("row.doc_id", "score", "bits_per_byte")
        scores.append({r["doc_id"]: r["score"] for r in found.collect()})
        blend = context_mixing.train(context_mixing.gram_counts(table), bits=14)
        assert np.abs(blend.weights - 0.3).max() > 0.1
    assert scores[0] == pytest.approx(scores[1], rel=1e-5)
