"""Counts of word windows as a whole, among them those of exact copies."""

from __future__ import annotations

from collections import Counter

import brute
import pytest

from tickloom.llm import repeats, substring_dedup


@pytest.mark.parametrize("max_bucket", [1, 4096])
def test_every_repeated_window_has_its_count(spark, max_bucket):
    copy = " ".join(f"a{n}" for n in range(40))
    part = " ".join(f"p{n}" for n in range(25))
    rows = [(n, copy) for n in range(5, 12)] + [(1, f"x y {part} z"), (2, f"u {part} v w"), (3, "alone " * 30), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    counts, size = Counter(), 12
    words_of = {doc: brute.SPACE_WORD.findall(text or "") for doc, text in rows}
    for words in words_of.values():
        counts.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    runs = repeats.find_runs(repeats.keyed(docs, "doc_id", "text"), repeats.word_units, size, 3).collect()
    place = {bytes(r["digest"]): words_of[r["doc"]][r["start"] :] for r in runs}
    found = substring_dedup.count_windows(docs, window=size, gram=3, max_bucket=max_bucket).collect()
    got = {}
    for r in found:
        got.setdefault(tuple(place[bytes(r["digest"])][r["at"] : r["at"] + size]), set()).add((r["count"], r["first"]))
    first = {}
    for doc, words in sorted(words_of.items()):
        for i in range(len(words) - size + 1):
            first.setdefault(tuple(words[i : i + size]), doc)
    assert got == {w: {(n, first[w])} for w, n in counts.items() if n > 1}
