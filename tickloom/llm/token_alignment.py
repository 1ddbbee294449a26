"""Alignment of two tokenizers by an associative monoid of byte-range fragments.

Byte offsets at which tokens of both tokenizers end cut a text into groups. A byte range of a text gives a
fragment: an open prefix (tokens up to the first common end), closed groups, and an open suffix (tokens after the
last common end). Two neighbours compose: the suffix of the one and the prefix of the other make a group. That is
associative, so ranges of a very long document are tokenized in tasks of their own and
composed as a tree; closed groups stay where they are, only the open ends climb.

Ranges are cut anywhere. A task sees its range with some text around it, up to the nearest places where
neither tokenizer can join (a single space between a mark or letter and a letter, all of ASCII), and keeps the tokens that end in its range.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts, stored

CHUNK_BYTES = 1 << 21
# Documents above so many bytes are cut into ranges of that size.
RANGE_BYTES = 1 << 15
# Fragments that one step of the tree composes.
FAN = 8
# Id pairs of one lookup table (16 bytes each); more pairs take further passes over the links.
TABLE_PAIRS = 1 << 21
BLOCK_PARTS = 2000
# Encoded parts that a worker remembers at least, up to twice as many, of at most so many bytes each; the others are encoded again.
KNOWN_PARTS = 1 << 16
KNOWN_BYTES = 32
# Links of a group up to this product of its sizes are listed together, larger groups one by one.
SMALL_GROUP = 4096

_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True

ALIGNED = "n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, groups_sha256 STRING, pairs ARRAY<BIGINT>, times ARRAY<BIGINT>"


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places of single spaces before which neither tokenizer joins."""
    middle = (data[1:-1] == 0x20) & _GRAPHIC[data[:-2]] & _LETTER[data[2:]]
    return np.flatnonzero(middle) + 1


def _byte_level() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def _decimals(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. count - 1, left-aligned, zero bytes up to a free place behind, and their number."""
    ids = np.arange(count)
    size = np.searchsorted(10 ** np.arange(1, 12), ids, "right") + 1
    width = int(size.max(initial=1)) + 1
    digits = np.zeros((count, width), np.uint8)
    for k in range(width - 1):
        digits[:, k] = np.where(k < size, 48 + ids // 10 ** np.maximum(size - 1 - k, 0) % 10, 0)
    return digits, size


def _flat(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of a vocabulary, where each piece begins in them, and its size."""
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum(size) - size, size


def _ranges(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The given ranges of bytes, one after the other."""
    place = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(starts - place[:-1], size) + np.arange(place[-1])]


class Tokens:
    """Tokens of a chunk of texts: ids, absolute ends, first token of each text, for A and B; texts that do not round-trip."""

    def __init__(self, a, a_end, a_first, b, b_end, b_first, bad):
        self.a, self.a_end, self.a_first, self.b, self.b_end, self.b_first, self.bad = a, a_end, a_first, b, b_end, b_first, bad


class Pair:
    """The two tokenizers of a task."""

    def __init__(self, a_json: str, b_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores
        held = json.loads(a_json)["pre_tokenizer"] or {}
        if held.get("type") != "ByteLevel" or not held.get("use_regex", True):
            raise ValueError("the first tokenizer must be byte-level with the usual word pattern")
        self.first, self.second = Tokenizer.from_str(a_json), SentencePieceProcessor(model_proto=b_model)
        self.first.encode_special_tokens = True
        code, size = _byte_level(), self.first.get_vocab_size()
        self.tables = [_flat([bytes(code[c] for c in t) if t and all(c in code for c in t) else (t or "").encode() for t in map(self.first.id_to_token, range(size))])]
        pieces = [self.second.id_to_piece(i) for i in range(self.second.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("the second tokenizer joins words")
        self.tables.append(_flat([bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]))
        self.size_a, self.size_b = size, len(pieces)
        self.decimals, self.digits = _decimals(max(size, self.size_b))
        none = np.zeros(0, np.int32)
        self.known, self.uses, self.sides = np.zeros(0, np.uint64), none, [(none,) * 4] * 2

    def _block(self, data: np.ndarray, sizes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
        """For A and B: ids, ends within their part and tokens of each part, of parts that were put together; None where bytes differ."""
        text = data.tobytes().decode("utf-8")
        last = np.cumsum(sizes)
        out = []
        # The second tokenizer adds the space in front itself.
        for ids, (flat, offset, size) in zip((self.first.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.second.encode(text[1:])), self.tables):
            ids = np.array(ids, np.int64)
            ends = np.cumsum(size[ids])
            if not len(ids) or ends[-1] != len(data) or not np.array_equal(_ranges(flat, offset[ids], size[ids]), data):
                return None
            cut = np.searchsorted(ends, last)
            if not np.array_equal(ends[cut], last):
                raise AssertionError("a token reaches over a safe cut")
            count = np.diff(np.concatenate([[-1], cut]))
            out.append((ids, ends - np.repeat(last - sizes, count), count))
        return out

    def _encoded(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """For A and B: ids and ends of the tokens of all parts, first token and number of tokens of each; which parts do not round-trip."""
        size = ends - starts
        # Parts that end in a mark or letter and begin with a space before a letter can stand side by side.
        after = data[np.minimum(starts + 1, len(data) - 1)]
        joins = (size > 1) & _LETTER[after] & _GRAPHIC[data[ends - 1]]
        plain, single = np.flatnonzero(joins), np.flatnonzero(~joins)
        blocks = [plain[n : n + BLOCK_PARTS] for n in range(0, len(plain), BLOCK_PARTS)] + [single[n : n + 1] for n in range(len(single))]
        bad, done, found = np.zeros(len(starts), bool), [], []
        while blocks:
            block = blocks.pop()
            result = self._block(_ranges(data, starts[block], size[block]), size[block])
            if result:
                done.append(block)
                found.append(result)
            elif len(block) > 1:  # some part of it: smaller blocks
                blocks += np.array_split(block, min(len(block), 16))
            else:
                bad[block] = True
        order = np.concatenate([*done, np.zeros(0, np.int64)]).astype(np.int64)
        out = []
        for which in (0, 1):
            ids, last, count = (np.concatenate([*(f[which][k] for f in found), np.zeros(0, np.int64)]).astype(np.int64) for k in range(3))
            first, number = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
            first[order], number[order] = np.cumsum(count) - count, count
            out.append((ids, last, first, number))
        return out, bad

    def _looked_up(self, codes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """``_encoded`` of distinct parts with ascending hashes ``codes``; those that are remembered are not encoded again."""
        place = np.searchsorted(self.known, codes)
        hit = np.zeros(len(codes), bool)
        inside = place < len(self.known)
        hit[inside] = self.known[place[inside]] == codes[inside]
        old, fresh = place[hit], np.flatnonzero(~hit)
        found, wrong = self._encoded(data, starts[fresh], ends[fresh])
        bad, out = np.zeros(len(codes), bool), []
        bad[fresh] = wrong
        for (ids, last, first, number), new in zip(self.sides, found):
            first_token, count = np.empty(len(codes), np.int64), np.empty(len(codes), np.int64)
            count[hit], count[fresh] = number[old], new[3]
            total = np.cumsum(count[hit])
            first_token[hit], first_token[fresh] = total - count[hit], new[2] + (total[-1] if len(total) else 0)
            out.append((*(np.concatenate([_ranges(held, first[old], number[old]), more]) for held, more in zip((ids, last), new)), first_token, count))
        self.uses[old] += 1
        some = fresh[~wrong & (ends[fresh] - starts[fresh] <= KNOWN_BYTES)]
        if 8 * len(some) >= len(self.known):  # not worth it for a few
            self._remember(codes[some], [(ids, last, first[some], count[some]) for ids, last, first, count in out])
        return out, bad

    def _remember(self, codes: np.ndarray, sides) -> None:
        known, uses = np.concatenate([self.known, codes]), np.concatenate([self.uses, np.ones(len(codes), np.int32)])
        keep = np.argpartition(-uses, KNOWN_PARTS)[:KNOWN_PARTS] if len(known) > 2 * KNOWN_PARTS else np.arange(len(known))
        keep = keep[np.argsort(known[keep])]
        self.known, self.uses, held = known[keep], uses[keep], []
        for (ids, last, first, number), (more_ids, more_last, more_first, more_number) in zip(self.sides, sides):
            first, number = np.concatenate([first, len(ids) + more_first])[keep], np.concatenate([number, more_number])[keep]
            tokens = (_ranges(np.concatenate([a, b]), first, number).astype(np.int32) for a, b in ((ids, more_ids), (last, more_last)))
            held.append((*tokens, (np.cumsum(number) - number).astype(np.int32), number.astype(np.int32)))
        self.sides = held

    def tokens(self, data: np.ndarray, bounds: np.ndarray) -> Tokens:
        """Tokens of texts that each begin with the space in front. Equal parts of a chunk are encoded once."""
        starts = np.sort(np.concatenate([bounds[:-1][np.diff(bounds) > 0], safe_cuts(data)]).astype(np.int64))
        starts = starts[np.diff(starts, prepend=-1) > 0]
        ends = np.append(starts[1:], len(data))[: len(starts)]
        codes, lead, inverse = np.unique(arrays.byte_hash(data, starts, ends), return_index=True, return_inverse=True)
        found, wrong = self._looked_up(codes, data, starts[lead], ends[lead])
        row = np.searchsorted(bounds, starts, "right") - 1
        bad = np.zeros(len(bounds) - 1, bool)
        bad[row[wrong[inverse]]] = True
        out = []
        for ids, last, first_token, number in found:
            count = np.where(bad[row], 0, number[inverse])
            place = np.concatenate([[0], np.cumsum(count)])
            at = np.repeat(first_token[inverse] - place[:-1], count) + np.arange(place[-1])
            out += [ids[at], last[at] + np.repeat(starts, count), place[np.searchsorted(row, np.arange(len(bounds)))]]
        return Tokens(*out, bad)

    def spelled(self, a, b, closes_a, closes_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text ``a1,a2|b1;...`` of tokens whose groups are closed (a separator after each), and where A and B tokens stand in it."""
        group_a, group_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        at_a = np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")
        at_b = np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")
        ids, mark = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        ids[at_a], ids[at_b] = a, b
        mark[at_a] = np.where(closes_a, ord("|"), ord(","))
        mark[at_b] = np.where(closes_b, ord(";"), ord(","))
        size = self.digits[ids]
        text = self.decimals[ids]
        text.ravel()[np.arange(0, text.size, text.shape[1]) + size] = mark
        flat = np.frombuffer(text.tobytes().translate(None, b"\x00"), np.uint8)
        place = np.concatenate([[0], np.cumsum(size + 1)])
        return flat, place, at_a

    def links(self, a, b, closes_a, closes_b, row_of_group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (row, id pair) of all links within groups and how often each stands: rows, pairs, times."""
        end_a, end_b = np.flatnonzero(closes_a) + 1, np.flatnonzero(closes_b) + 1
        first_a, first_b = np.concatenate([[0], end_a[:-1]]), np.concatenate([[0], end_b[:-1]])
        size_a, size_b = end_a - first_a[: len(end_a)], end_b - first_b[: len(end_b)]
        product = size_a * size_b
        one = np.flatnonzero(product == 1)
        small = np.flatnonzero((product > 1) & (product <= SMALL_GROUP))
        count = product[small]
        place = np.concatenate([[0], np.cumsum(count)])
        within = np.arange(place[-1]) - np.repeat(place[:-1], count)
        group = np.repeat(small, count)
        side_a, side_b = np.divmod(within, size_b[group])
        # A row and its pair as one number.
        span = self.size_a * self.size_b
        keys = np.concatenate([
            row_of_group[one] * span + a[first_a[one]] * self.size_b + b[first_b[one]],
            row_of_group[group] * span + a[first_a[group] + side_a] * self.size_b + b[first_b[group] + side_b],
        ])
        keys.sort()
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        keys, times = keys[heads], np.diff(heads, append=len(keys))
        large = np.flatnonzero(product > SMALL_GROUP).tolist()
        if large:
            more, often = [keys], [times]
            for g in large:
                ids_a, n_a = np.unique(a[first_a[g] : end_a[g]], return_counts=True)
                ids_b, n_b = np.unique(b[first_b[g] : end_b[g]], return_counts=True)
                more.append((row_of_group[g] * span + ids_a[:, None] * self.size_b + ids_b).ravel())
                often.append((n_a[:, None] * n_b).ravel())
            order = np.argsort(np.concatenate(more))
            keys, times = np.concatenate(more)[order], np.concatenate(often)[order]
            heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, times = keys[heads], np.add.reduceat(times, heads)
        rows, pairs = np.divmod(keys, span)
        return rows, pairs, times


@functools.lru_cache(maxsize=1)
def pair_of(a_json: str, b_model: bytes) -> Pair:
    """The tokenizers of a Python worker: its tasks share them."""
    return Pair(a_json, b_model)


def closing(t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of A, and of B, end where a token of the other ends."""
    ends = np.zeros((2, max(t.a_end[-1:].sum(), t.b_end[-1:].sum()) + 1), bool)
    ends[0, t.a_end], ends[1, t.b_end] = True, True
    return ends[1, t.a_end], ends[0, t.b_end]


def _spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a space in front of each that is not empty."""
    filled = np.diff(bounds) > 0
    return np.insert(data, bounds[:-1][filled], 0x20), bounds + np.concatenate([[0], np.cumsum(filled)])


def _whole(a_json: str, b_model: bytes):
    """Job over texts: the columns of ``ALIGNED``."""
    pair = pair_of(a_json, b_model)

    def one(data, bounds, rows):
        t = pair.tokens(*_spaced(data, bounds))
        closes_a, closes_b = closing(t)
        text, place, at_a = pair.spelled(t.a, t.b, closes_a, closes_b)
        start = place[t.a_first + t.b_first].tolist()
        raw = text.tobytes()
        # The separator after a text's last group is not part of it.
        digests = [hashlib.sha256(raw[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(start[:-1], start[1:])]
        row_of_group = arrays.owners(t.a_first)[closes_a]
        rows, pairs, times = pair.links(t.a, t.b, closes_a, closes_b, row_of_group)
        docs = len(bounds) - 1
        first = np.searchsorted(rows, np.arange(docs + 1))
        groups = np.bincount(row_of_group, minlength=docs)
        return [
            np.diff(t.a_first), np.diff(t.b_first), groups, arrays.sums(times, first), pa.array(digests, pa.string()), arrays.lists(pairs, first), arrays.lists(times, first),
        ]

    return one


RANGES = "uid BIGINT, seq BIGINT, lead BIGINT, lo BIGINT, hi BIGINT, part BINARY"
FRAGMENTS = (
    "uid BIGINT, seq BIGINT, bad BOOLEAN, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, body BINARY, pairs ARRAY<BIGINT>, times ARRAY<BIGINT>, "
    "closed BOOLEAN, head_a ARRAY<BIGINT>, head_b ARRAY<BIGINT>, tail_a ARRAY<BIGINT>, tail_b ARRAY<BIGINT>"
)
OPEN = "uid BIGINT, seq BIGINT, is_group BOOLEAN, at BIGINT, closed BOOLEAN, head_a ARRAY<BIGINT>, head_b ARRAY<BIGINT>, tail_a ARRAY<BIGINT>, tail_b ARRAY<BIGINT>"


def byte_ranges(text: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """(lead, lo, hi, end) of the ranges of a text: it is cut at ``lo`` and ``hi``; ``lead`` to ``end`` is what a task has to see of it.

    Ranges without a safe place between them become one, so what is seen grows with the text, not with its square.
    """
    data = np.frombuffer(text, np.uint8)
    cuts = np.concatenate([[0], safe_cuts(data), [len(data)]])
    out: list[tuple[int, int, int, int]] = []
    for lo in range(0, len(data), size):
        hi = min(lo + size, len(data))
        lead, end = int(cuts[np.searchsorted(cuts, lo, "right") - 1]), int(cuts[np.searchsorted(cuts, hi, "left")])
        if out and lead == out[-1][0]:
            out[-1] = (lead, out[-1][1], hi, end)
        else:
            out.append((lead, lo, hi, end))
    return out


def _cut_ranges(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, text in zip(batch.column(0), batch.column(1)):
                text = b" " + text.as_py().encode()
                for seq, (lead, lo, hi, end) in enumerate(byte_ranges(text, size)):
                    yield pa.RecordBatch.from_pylist(
                        [{"uid": uid.as_py(), "seq": seq, "lead": lead, "lo": lo, "hi": hi, "part": text[lead:end]}], schema=_RANGE_SCHEMA
                    )

    return run


_RANGE_SCHEMA = pa.schema([*((n, pa.int64()) for n in ("uid", "seq", "lead", "lo", "hi")), ("part", pa.binary())])
_IDS = pa.list_(pa.int64())
_OPEN_SCHEMA = pa.schema(
    [("uid", pa.int64()), ("seq", pa.int64()), ("is_group", pa.bool_()), ("at", pa.int64()), ("closed", pa.bool_()), *((n, _IDS) for n in ("head_a", "head_b", "tail_a", "tail_b"))]
)
_FRAGMENT_SCHEMA = pa.schema(
    [("uid", pa.int64()), ("seq", pa.int64()), ("bad", pa.bool_()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("body", pa.binary()),
     ("pairs", _IDS), ("times", _IDS), ("closed", pa.bool_()), *((n, _IDS) for n in ("head_a", "head_b", "tail_a", "tail_b"))]
)


def fragment(pair: Pair, part: bytes, lead: int, lo: int, hi: int) -> dict:
    """The fragment of the bytes after ``lo`` up to ``hi`` of a text, from the part of it that begins at ``lead``."""
    data = np.frombuffer(part, np.uint8)
    t = pair.tokens(data, np.array([0, len(data)]))
    if t.bad[0]:
        return {"bad": True, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "body": b"", "pairs": [], "times": [], "closed": False, "head_a": [], "head_b": [], "tail_a": [], "tail_b": []}
    closes_a, closes_b = closing(t)
    use_a, use_b = (t.a_end + lead > lo) & (t.a_end + lead <= hi), (t.b_end + lead > lo) & (t.b_end + lead <= hi)
    a, b, closes_a, closes_b = t.a[use_a], t.b[use_b], closes_a[use_a], closes_b[use_b]
    ends_a, ends_b = np.flatnonzero(closes_a), np.flatnonzero(closes_b)
    out = {"bad": False, "n_a": len(a), "n_b": len(b), "closed": len(ends_a) > 0}
    # Without a common end all is open, and counts as the prefix.
    head_a, head_b = (ends_a[0] + 1, ends_b[0] + 1) if len(ends_a) else (len(a), len(b))
    tail_a, tail_b = (ends_a[-1] + 1, ends_b[-1] + 1) if len(ends_a) else (len(a), len(b))
    out |= {"head_a": a[:head_a], "head_b": b[:head_b], "tail_a": a[tail_a:], "tail_b": b[tail_b:]}
    a, b, closes_a, closes_b = a[head_a:tail_a], b[head_b:tail_b], closes_a[head_a:tail_a], closes_b[head_b:tail_b]
    groups = int(closes_a.sum())
    _, pairs, times = pair.links(a, b, closes_a, closes_b, np.zeros(groups, np.int64))
    body = pair.spelled(a, b, closes_a, closes_b)[0].tobytes()[:-1]
    return out | {"n_groups": groups, "n_links": int(times.sum()), "body": body, "pairs": pairs, "times": times}


def compose(x: dict, y: dict) -> tuple[dict, dict | None]:
    """The open ends of two neighbouring fragments as one, and the group that closes between them."""
    both = lambda p, q, name: [*p[f"{name[0]}_{name[1]}"], *q[f"head_{name[1]}"]]
    if not x["closed"]:  # all of it still belongs to the prefix
        return y | {"head_a": both(x, y, ("head", "a")), "head_b": both(x, y, ("head", "b"))}, None
    joined = {"head_a": both(x, y, ("tail", "a")), "head_b": both(x, y, ("tail", "b"))}
    if not y["closed"]:
        return x | {"tail_a": joined["head_a"], "tail_b": joined["head_b"]}, None
    # The group stands before the closed groups of the fragment whose prefix it ends.
    return x | {"tail_a": y["tail_a"], "tail_b": y["tail_b"]}, {"at": y["at"]} | joined


def _compose_all(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["seq"])
    out, current = [], rows[0]
    for row in rows[1:]:
        current, group = compose(current, row)
        if group:
            out.append(group | {"uid": row["uid"], "seq": 0, "is_group": True, "closed": False, "tail_a": [], "tail_b": []})
    out.append(current | {"seq": rows[0]["seq"] // FAN, "is_group": False})
    return pa.Table.from_pylist(out, schema=_OPEN_SCHEMA)


def open_groups(fragments: DataFrame) -> DataFrame:
    """Groups that reach over range borders (uid, at, head_a, head_b): a tree of compositions over the open ends alone."""
    level = fragments.where(~F.col("bad")).select(
        "uid", "seq", F.lit(False).alias("is_group"), F.col("seq").alias("at"), "closed", "head_a", "head_b", "tail_a", "tail_b"
    )
    most = fragments.agg(F.max("seq")).first()[0] or 0
    found = []
    while True:
        # At each level a task holds the open ends of a few neighbours.
        level = stored(level.groupBy("uid", F.floor(F.col("seq") / FAN)).applyInArrow(_compose_all, OPEN), "open-ends")
        found.append(level.where("is_group"))
        level = level.where("NOT is_group")
        if most < FAN:
            break
        most //= FAN
    # What is left is the first group of a text; nothing is open behind its end.
    found.append(level)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select("uid", F.col("at").alias("seq"), F.col("head_a").alias("group_a"), F.col("head_b").alias("group_b"))


def _assembled(a_json, b_model):
    """Job over a text's fragments in order: the columns of ``ALIGNED``; what is held is one text's distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, now = pair_of(a_json.value, b_model.value), None
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                if now is None or row["uid"] != now["uid"]:
                    if now is not None:
                        yield _finished(now)
                    now = {"uid": row["uid"], "bad": False, "sha": hashlib.sha256(), "begun": False, "sums": np.zeros(4, np.int64), "pairs": np.zeros(0, np.int64), "times": np.zeros(0, np.int64)}
                _take(pair, now, row)
        if now is not None:
            yield _finished(now)

    return run


def _take(pair: Pair, now: dict, row: dict) -> None:
    now["bad"] |= row["bad"]
    pieces, lists = [row["body"]], [(row["pairs"], row["times"])]
    now["sums"] += [row["n_a"], row["n_b"], row["n_groups"], row["n_links"]]
    if row["group_a"] is not None:
        a, b = np.array(row["group_a"], np.int64), np.array(row["group_b"], np.int64)
        closes_a, closes_b = np.arange(len(a)) == len(a) - 1, np.arange(len(b)) == len(b) - 1
        pieces.insert(0, pair.spelled(a, b, closes_a, closes_b)[0].tobytes()[:-1])
        lists.append(pair.links(a, b, closes_a, closes_b, np.zeros(1, np.int64))[1:])
        now["sums"] += [0, 0, 1, len(a) * len(b)]
    for piece in filter(None, pieces):
        now["sha"].update((b";" if now["begun"] else b"") + piece)
        now["begun"] = True
    pairs = np.concatenate([now["pairs"], *(np.array(p, np.int64) for p, _ in lists)])
    times = np.concatenate([now["times"], *(np.array(t, np.int64) for _, t in lists)])
    now["pairs"], inverse = np.unique(pairs, return_inverse=True)
    now["times"] = np.bincount(inverse, weights=times, minlength=len(now["pairs"])).astype(np.int64)


def _finished(now: dict) -> pa.RecordBatch:
    sums = [0] * 4 if now["bad"] else now["sums"].tolist()
    pairs, times = ([], []) if now["bad"] else (now["pairs"], now["times"])
    values = [now["uid"], *sums, "" if now["bad"] else now["sha"].hexdigest(), pairs, times]
    names = ["uid", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    kinds = [*[pa.int64()] * 5, pa.string(), _IDS, _IDS]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def aligned(docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Stored table of every row: id, n_a, n_b, n_groups, n_links, groups_sha256, pairs (A id * size of B + B id, distinct), times.

    Nulls, empty texts and texts that one of the tokenizers does not give back byte by byte have no tokens and an empty digest.
    """
    spark = docs.sparkSession
    sent_a, sent_b = spark.sparkContext.broadcast(a_json), spark.sparkContext.broadcast(b_model)  # vocabularies, whatever the input
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    is_long = F.coalesce(F.octet_length("text") >= range_bytes, F.lit(False))
    short = map_texts(slim.where(~is_long), "text", ALIGNED, lambda: _whole(sent_a.value, sent_b.value), CHUNK_BYTES).select("row.id", "result.*")
    # Row numbers are stored with the ids, so they stay the same for every later reader.
    long = stored(slim.where(is_long).select(F.monotonically_increasing_id().alias("uid"), "id", "text"), "long-texts")
    ranges = long.select("uid", "text").mapInArrow(_cut_ranges(range_bytes), RANGES)

    def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(sent_a.value, sent_b.value)
        for batch in batches:
            for row in batch.to_pylist():
                found = fragment(pair, row["part"], row["lead"], row["lo"], row["hi"])
                yield pa.RecordBatch.from_pylist([found | {"uid": row["uid"], "seq": row["seq"]}], schema=_FRAGMENT_SCHEMA)

    # Ranges of one text go to many tasks.
    pieces = stored(ranges.repartition("uid", "seq").mapInArrow(fragments, FRAGMENTS), "fragments")
    ordered = pieces.drop("closed", "head_a", "head_b", "tail_a", "tail_b").join(open_groups(pieces), ["uid", "seq"], "left")
    whole = ordered.repartition("uid").sortWithinPartitions("uid", "seq").mapInArrow(_assembled(sent_a, sent_b), f"uid BIGINT, {ALIGNED}")
    composed = long.select("uid", "id").join(whole, "uid").drop("uid")
    return stored(short.unionByName(composed), "aligned")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """Stored table (pair, n, best): in how many rows an id pair is linked, and whether no pair of its A id is in more."""
    counts = stored(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pair-counts")
    first = F.expr(f"pair div {size_b}").alias("a")
    tops = counts.groupBy(first).agg(F.max("n").alias("top"))
    marked = counts.select("pair", "n", first).join(tops, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    return stored(marked, "pair-table")


def _added(found: DataFrame, table: DataFrame) -> DataFrame:
    """``found`` with the sums over the links whose pair is in ``table``, a table of bounded size, added to its own."""
    held = table.toArrow()
    order = np.argsort(held["pair"].to_numpy())
    sent = found.sparkSession.sparkContext.broadcast((held["pair"].to_numpy()[order], held["n"].to_numpy()[order], held["best"].to_numpy()[order]))
    at = {name: n for n, name in enumerate(found.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = sent.value
        for batch in batches:
            columns = list(batch.columns)
            lists, times = columns[at["pairs"]], columns[at["times"]].flatten().to_numpy()
            first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            own = lists.flatten().to_numpy()
            place = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            hit = pairs[place] == own if len(pairs) else np.zeros(len(own), bool)
            for name, value in (("n_best", best), ("count_sum", counts)):
                more = np.zeros(len(own), np.int64)
                more[hit] = value[place[hit]].astype(np.int64) * times[hit]
                columns[at[name]] = pa.array(columns[at[name]].to_numpy() + arrays.sums(more, first))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return found.mapInArrow(run, found.schema)


def align(
    docs: DataFrame, a_json: str, b_model: bytes, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES, table_pairs: int = TABLE_PAIRS
) -> DataFrame:
    """Alignment of every document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_json`` is a byte-level tokenizer file, ``b_model`` a sentencepiece model that adds a space in front. Links are
    the A-B token pairs within a group; a pair's count is the number of rows that hold it linked, ``count_sum`` its
    sum over a row's links, ``n_best`` the links whose count is the highest of their A id. Null and empty
    texts, and those whose tokens do not give the text back, have zeros and an empty digest. Every row comes back
    once, repeated ids and texts included; other columns are left out.
    """
    size_b = pair_of(a_json, b_model).size_b
    found = aligned(docs, a_json, b_model, id_col, text_col, range_bytes)
    table = pair_counts(found, size_b)
    shards = -(-table.count() // table_pairs) or 1
    zero = F.lit(0).cast("long")
    found = found.withColumns({"n_best": zero, "count_sum": zero})
    for shard in range(shards):
        # Beyond one table of bounded size, the links are read once for each share of the pairs.
        part = table.where(F.pmod(F.xxhash64("pair"), F.lit(shards)) == shard)
        found = _added(found, part)
        found = found if shard == shards - 1 else stored(found, "link-sums")
    return found.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
