"""Sketches of shingle sets: they let no link go, and texts that share a shingle by chance do not travel."""

from __future__ import annotations

import numpy as np
import pytest

from tickloom.llm import jaccard_join


def _held(sets):
    codes = np.concatenate([np.sort(s) for s in sets])
    first = np.cumsum([0, *map(len, sets)])
    return np.diff(first), jaccard_join.sketches(codes, first).to_pylist()


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_no_link_is_lost(percent):
    draw = np.random.default_rng(percent)
    sets = []
    for size in [1, 5, 9, 10, 30, 250, 257, 300, 511, 513, 4000] * 3:
        base = np.unique(draw.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
        less = base[: len(base) - draw.integers(0, len(base) // 6 + 1)]
        sets += [base, np.concatenate([less, draw.integers(0, 1 << 63, len(base) // 25, dtype=np.uint64)])]
    sets += [np.arange(n, dtype=np.uint64) for n in (300, 310, 700)]  # all in one range of hashes
    sets = [s for n, s in enumerate(sets) if not any(np.array_equal(s, t) for t in sets[:n])]
    linked = np.zeros(len(sets), bool)
    for a, one in enumerate(sets):
        for b, other in enumerate(sets[:a]):
            common = len(np.intersect1d(one, other))
            if 100 * common >= percent * (len(one) + len(other) - common):
                linked[[a, b]] = True
    found = jaccard_join.near_some(*_held(sets), percent)
    assert linked.any() and not linked.all() and found[linked].all()


def test_unrelated_sets_go():
    draw = np.random.default_rng(3)
    shared = draw.integers(0, 1 << 63, 20, dtype=np.uint64)
    sets = [np.concatenate([shared, draw.integers(0, 1 << 63, 1700 + n, dtype=np.uint64) * np.uint64(2)]) for n in range(30)]
    assert not jaccard_join.near_some(*_held(sets), 90).any()


def test_only_texts_of_near_sketches_travel(spark, monkeypatch):
    kept = {}
    plain = jaccard_join.stored

    def spy(df, label):
        kept[label] = plain(df, label)
        return kept[label]

    monkeypatch.setattr(jaccard_join, "stored", spy)
    # Each two texts have a passage of 30 words in common.
    passage = lambda a, b: " ".join(f"{min(a, b)}x{max(a, b)}x{n}" for n in range(30))
    rows = [(n, " ".join(passage(n, other) for other in range(40) if other != n)) for n in range(40)]
    rows += [(100, rows[0][1] + " one more")]
    found = jaccard_join.join_components(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {n: n for n in range(40)} | {100: 0}
    assert kept["regions"].select("doc").distinct().count() == 41
    assert {r["doc"] for r in kept["region-texts"].select("doc").collect()} == {0, 100}
