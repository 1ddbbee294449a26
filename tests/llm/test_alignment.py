"""Token alignment against whole-text encoding in plain Python; fragments as a monoid; odd rows; empty tables."""

from __future__ import annotations

import functools
import random
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest

from tickloom.llm import token_alignment
from tickloom.llm.queries import model_bytes, tokenizer_json

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id BIGINT, text STRING, uid INT, seq INT, pairs INT, `n a` INT, result STRING"
A, B = tokenizer_json("byte_bpe_50k.json"), model_bytes()

ODD = [
    (1, None), (2, ""), (3, " "), (4, "x"), (5, "a  b"), (6, "a▁b"), (7, " x ﬁ é"), (8, "<s> </s> <unk> <|endoftext|> <0x41>"),
    (9, "tab\t\tline\n\n  end  "), (10, "\x00 nul \x7f"), (11, "x" * 3000), (12, "漢字かな交じり文 " * 90), (13, "don't I'll we've 12.5% #tag"), (4, "x"), (None, "x y"),
    (14, "😀 👨‍👩‍👧 　z"), (15, "=" * 700 + " a" * 300), (16, " lead and  double   triple"),
]


@functools.cache
def _tools():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    first = Tokenizer.from_str(A)
    first.encode_special_tokens = True
    return first, SentencePieceProcessor(model_proto=B)


def _ends(text):
    """(ids, ends) of both tokenizers over the whole text, or None."""
    first, second = _tools()
    whole = (" " + text).encode()
    one = first.encode(" " + text, add_special_tokens=False)
    code = token_alignment._byte_level()
    parts_a = [bytes(code[c] for c in t) for t in one.tokens]
    ids_b = second.encode(text)
    parts_b = []
    for i in ids_b:
        piece = second.id_to_piece(i)
        parts_b.append(bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode())
    if b"".join(parts_a) != whole or b"".join(parts_b) != whole:
        return None
    return (one.ids, np.cumsum([len(p) for p in parts_a]).tolist()), (ids_b, np.cumsum([len(p) for p in parts_b]).tolist())


def _groups(text):
    found = _ends(text) if text else None
    if found is None:
        return []
    (a, a_end), (b, b_end) = found
    edges = [0, *sorted(set(a_end) & set(b_end))]
    return [
        ([t for t, e in zip(a, a_end) if lo < e <= hi], [t for t, e in zip(b, b_end) if lo < e <= hi])
        for lo, hi in zip(edges, edges[1:])
    ]


def _digest(groups):
    text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return brute.sha(text.encode()) if groups else ""


def _plain(rows):
    groups = [_groups(text) for _, text in rows]
    links = [Counter((x, y) for a, b in own for x in a for y in b) for own in groups]
    counts = Counter(pair for own in links for pair in own)
    tops = defaultdict(int)
    for (x, _), n in counts.items():
        tops[x] = max(tops[x], n)
    return [
        (doc, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), sum(pairs.values()), sum(n for p, n in pairs.items() if counts[p] == tops[p[0]]),
         sum(n * counts[p] for p, n in pairs.items()), _digest(own))
        for (doc, _), own, pairs in zip(rows, groups, links)
    ]


def _ordered(found):
    return sorted(map(tuple, found), key=lambda r: (r[0] is None, r))


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return [(r[0] + 1000, r[1]) for r in table] + ODD


@pytest.mark.parametrize(("range_bytes", "table_pairs"), [(token_alignment.RANGE_BYTES, token_alignment.TABLE_PAIRS), (300, 4000)])
def test_against_whole_texts(spark, rows, range_bytes, table_pairs):
    # Short ranges make many fragments of each text: fewer texts do.
    rows = rows if range_bytes == token_alignment.RANGE_BYTES else rows[-60:]
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4, "x") for r in rows], SCHEMA).repartition(3)
    found = token_alignment.align(docs, A, B, range_bytes=range_bytes, table_pairs=table_pairs)
    assert _ordered(found.collect()) == _ordered(_plain(rows))


@pytest.mark.parametrize("size", [1, 7, 64])
def test_ranges_cover_a_text_once(size):
    for _, text in ODD:
        data = (" " + (text or "")).encode()
        ranges = token_alignment.byte_ranges(data, size)
        assert [lo for _, lo, _, _ in ranges] == [0, *(hi for _, _, hi, _ in ranges[:-1])] and ranges[-1][2] == len(data)
        assert sum(end - lead for lead, _, _, end in ranges) <= 3 * len(data) + 3 * size + 2 * max(map(len, data.split()), default=0) * len(ranges)


def _fragments(text, size):
    pair, data = token_alignment.pair_of(A, B), (" " + text).encode()
    out = []
    for seq, (lead, lo, hi, end) in enumerate(token_alignment.byte_ranges(data, size)):
        out.append(token_alignment.fragment(pair, data[lead:end], lead, lo, hi) | {"at": seq})
    return out


def test_composition_is_associative():
    """Any order of composing neighbours gives the same open ends and the same groups between."""
    pieces = _fragments("Straßenbahnhaltestelle, don't  stop: " * 6 + "x" * 90 + " The end of 12,345 words", 5)
    results = []
    for seed in range(8):
        dice, parts, groups = random.Random(seed), list(pieces), []
        while len(parts) > 1:
            n = dice.randrange(len(parts) - 1)
            joined, group = token_alignment.compose(parts[n], parts[n + 1])
            parts[n : n + 2] = [joined]
            groups += [(group["at"], list(group["head_a"]), list(group["head_b"]))] if group else []
        results.append((sorted(groups), list(parts[0]["head_a"]), list(parts[0]["head_b"]), list(parts[0]["tail_a"]), parts[0]["at"]))
    assert all(r == results[0] for r in results) and results[0][3] == [] and len(results[0][0]) > 5


def test_empty_table(spark):
    assert token_alignment.align(spark.createDataFrame([], "doc_id BIGINT, text STRING"), A, B).collect() == []
    rows = token_alignment.align(spark.createDataFrame([(1, None)], "doc_id BIGINT, text STRING"), A, B).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_remembered_parts_are_not_encoded_again(monkeypatch):
    monkeypatch.setattr(token_alignment, "KNOWN_PARTS", 40)
    plain = token_alignment.Pair._encoded
    sizes = []

    def spy(self, data, starts, ends):
        sizes.append(len(starts))
        return plain(self, data, starts, ends)

    monkeypatch.setattr(token_alignment.Pair, "_encoded", spy)
    pair = token_alignment.Pair(A, B)
    draw = np.random.default_rng(5)
    for n in range(6):
        words = [f"word{x}" if x % 3 else f"wörd{x}, \x00 mark" for x in draw.integers(0, 70, 60)] + ["often", "seen", "long" * 20]
        text = np.frombuffer((" " + " ".join(words)).encode(), np.uint8)
        bounds = np.array([0, 0, len(text) // 2, len(text)])
        while text[bounds[2]] != 0x20:
            bounds[2] += 1
        alone = token_alignment.Pair(A, B).tokens(text, bounds)
        for name, value in vars(pair.tokens(text, bounds)).items():
            assert np.array_equal(value, getattr(alone, name)), name
        first, again = sizes[-1], sizes[-2]  # of the pair, of one that remembers nothing
        assert n == 0 or first < again
        assert len(pair.known) <= 80 and all(len(side[0]) == side[3].sum() for side in pair.sides)
