"""Memory of the word counts of context mixing."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from tickloom.llm import arrays, context_mixing


def test_words_are_counted_in_small_chunks():
    texts = pa.array([" ".join(f"w{n * 7919 % 100_003}" for n in range(i, i + 20_000)) for i in range(0, 1_600_000, 20_000)])
    assert texts.nbytes > 1 << 23
    tracemalloc.start()
    try:
        for _, _, data, bounds in arrays.row_chunks(texts, context_mixing.WORD_CHUNK_BYTES):
            np.unique(context_mixing._word_codes(data, bounds)[0], return_counts=True)
        assert tracemalloc.get_traced_memory()[1] < 40 * context_mixing.WORD_CHUNK_BYTES + (150 << 20)
    finally:
        tracemalloc.stop()
