"""Sequence packing along a space-filling curve.

Documents become token ids and a hashed vector of them. The vectors are projected to few
dimensions; a range sort by Hilbert key puts similar documents side by side, and the sorted
stream of ids is cut every ``length`` tokens, so that only the very last sequence has padding.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tickloom.llm import arrays
from tickloom.llm.frames import map_texts, stored
from tickloom.session import shared_folder

LENGTH = 4096
END_ID = 2
BUCKETS = 64
DIMENSIONS = 4
BITS = 12
CHUNK_BYTES = 1 << 21
# Words whose ids a task remembers; beyond that it starts anew, which only costs time.
MEMO_WORDS = 600_000
# Words that the tokenizer gets at a time; what it returns for a word takes far more than its ids.
BATCH_WORDS = 1000


_MARK, _ASCII_LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows), by Skilling's transform of the axes."""
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for axis in range(dims):
            upper = (x[:, axis] & level) != 0
            swap = np.where(upper, 0, (x[:, 0] ^ x[:, axis]) & low)
            x[:, 0] ^= np.where(upper, low, swap)
            x[:, axis] ^= swap
        level >>= 1
    for axis in range(1, dims):
        x[:, axis] ^= x[:, axis - 1]
    turn = np.zeros(len(x), np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where(x[:, dims - 1] & level, level - 1, 0)
        level >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = (key << 1) | ((x[:, axis] >> bit) & 1)
    return key


def _parts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and first part of each document: pieces of text whose ids do not depend on what is around.

    Words between white space, of which marks at the end come apart where they follow a letter of
    ASCII, as the tokenizer parts letters from marks. It lower-cases too, so A-Z need not be told apart from
    a-z, but for words with "<", which may hold the name of a special token.
    """
    starts, ends, _ = arrays.words(data, bounds, arrays.NOT_SPACE)
    at = np.arange(len(data))
    last = np.maximum.accumulate(np.where(_MARK[data], -1, at))[ends - 1] if len(ends) else ends
    inner = (last >= starts) & (last < ends - 1)
    inner[inner] = _ASCII_LETTER[data[last[inner]]]
    cut = last[inner] + 1
    low = arrays.LOWER[data]
    odd = np.flatnonzero(data == ord("<"))
    for word in np.unique(np.searchsorted(starts, odd, "right") - 1).tolist():
        low[starts[word] : ends[word]] = data[starts[word] : ends[word]]
    starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return low, starts, ends, np.searchsorted(starts, bounds)


class WordEncoder:
    """Ids of whole texts from ids of words: the tokenizer never joins across ASCII white space."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.memo: dict[bytes, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        # Ids that end a run of letters, for tokenizers that mark word ends.
        suffix = json.loads(tokenizer_json)["model"].get("end_of_word_suffix")
        self.ends = np.array([bool(suffix) and (self.tokenizer.id_to_token(i) or "").endswith(suffix) for i in range(size)], bool)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and the first id of each and the end."""
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, self.kind), np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(words) + 1))

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words of letters alone, as one text: each is one run of letters, so it has one id that ends a run."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.ends[ids]) + 1
        # Lower case may part a few of them; then there are more ends than words.
        return (ids, np.concatenate([[0], ends])) if len(ends) == len(words) and ends[-1] == len(ids) else self._encode(words)

    def __call__(self, data: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, each text followed by ``end_id``, and the first id of each text."""
        low, starts, ends, first = _parts(data, bounds)
        _, at, inverse = np.unique(arrays.byte_hash(low, starts, ends), return_index=True, return_inverse=True)
        raw = low.tobytes()
        distinct = [raw[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())]
        if len(self.memo) > MEMO_WORDS:
            self.memo = {}
        fresh = {w: w.decode("utf-8") for w in distinct if w not in self.memo}
        letters = [w for w, text in fresh.items() if text.isalpha()]
        others = [w for w, text in fresh.items() if not text.isalpha()]
        for some, encode in ((letters, self._encode_letters), (others, self._encode)):
            for low in range(0, len(some), BATCH_WORDS):
                part = some[low : low + BATCH_WORDS]
                found, first_id = encode([fresh[w] for w in part])
                packed, place = found.tobytes(), (first_id * found.itemsize).tolist()
                self.memo.update((w, packed[i:j]) for w, i, j in zip(part, place[:-1], place[1:]))
        ids = [self.memo[w] for w in distinct] + [self.kind(end_id).tobytes()]
        flat = np.frombuffer(b"".join(ids), self.kind)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        offset = np.concatenate([[0], np.cumsum(size)])
        stream = np.insert(inverse, first[1:], len(distinct))
        row_first = first + np.arange(len(first))
        count = size[stream]
        place = np.concatenate([[0], np.cumsum(count)])
        out = flat[np.repeat(offset[stream] - place[:-1], count) + np.arange(place[-1])]
        return out, place[row_first]


def _hashed(size: int) -> tuple[np.ndarray, np.ndarray]:
    code = arrays.mix(np.arange(size, dtype=np.uint64) + np.uint64(0xC0FFEE))
    return (code % np.uint64(BUCKETS)).astype(np.int64), np.where(code >> np.uint64(63), 1.0, -1.0)


def _projection() -> np.ndarray:
    return np.random.default_rng(7).normal(size=(BUCKETS, DIMENSIONS))


def encoded(docs: DataFrame, tokenizer_json: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """Stored table: uid, id, n_tokens, point (projected unit vector), ids (packed)."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json)  # a vocabulary, whatever the input

    def job():
        encode = WordEncoder(shared.value)
        bucket, sign = _hashed(1 << (8 * np.dtype(encode.kind).itemsize) if encode.kind is np.uint16 else encode.tokenizer.get_vocab_size())
        projection = _projection()

        def one(data, bounds, rows):
            ids, first = encode(data, bounds, end_id)
            docs = len(bounds) - 1
            row = arrays.owners(first)
            vector = np.bincount(row * BUCKETS + bucket[ids], weights=sign[ids], minlength=docs * BUCKETS).reshape(docs, BUCKETS)
            point = (vector / np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-9)) @ projection
            packed = pa.Array.from_buffers(
                pa.large_binary(), docs, [None, pa.py_buffer((first * ids.itemsize).astype(np.int64)), pa.py_buffer(ids)]
            ).cast(pa.binary())
            return [np.diff(first), arrays.lists(point.ravel(), np.arange(docs + 1) * DIMENSIONS), packed]

        return one

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = map_texts(slim, "text", "n_tokens BIGINT, point ARRAY<DOUBLE>, ids BINARY", job, CHUNK_BYTES)
    path = shared_folder(docs.sparkSession, "token-ids")
    # The row numbers are stored with the rows, so they stay the same for every later reader.
    found.select(F.monotonically_increasing_id().alias("uid"), "row.id", "result.*").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def along_curve(tokens: DataFrame) -> DataFrame:
    """Stored table: uid, part and the tokens before the document within its part, in curve order."""
    moments = [f(F.col("point")[i]).alias(f"{name}{i}") for i in range(DIMENSIONS) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    got = tokens.agg(*moments).first()
    centre = np.array([got[f"m{i}"] or 0.0 for i in range(DIMENSIONS)])
    spread = np.array([got[f"s{i}"] or 1.0 for i in range(DIMENSIONS)])

    def keys(batches):
        for table in batches:
            points = np.array(table["point"].tolist(), float).reshape(len(table), DIMENSIONS)
            z = np.clip((points - centre) / np.maximum(spread, 1e-12), -6, 6)
            share = 1 / (1 + np.exp(-1.702 * z))  # close to the normal distribution function
            cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pd.DataFrame({"uid": table["uid"], "n_tokens": table["n_tokens"], "key": hilbert_key(cells, BITS)})

    keyed = tokens.select("uid", "n_tokens", "point").mapInPandas(keys, "uid BIGINT, n_tokens BIGINT, key BIGINT")
    ordered = stored(keyed, "curve-keys").repartitionByRange("key", "uid").sortWithinPartitions("key", "uid")

    def numbered(batches):
        before, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            ends = before + np.cumsum(batch.column(1).to_numpy())
            start = np.concatenate([[before], ends[:-1]]) if len(ends) else ends
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(len(ends), part, np.int32)), pa.array(start), batch.column(1)], ["uid", "part", "before", "n_tokens"])

    return stored(ordered.mapInArrow(numbered, "uid BIGINT, part INT, before BIGINT, n_tokens BIGINT"), "curve-order")


PIECES = """start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, `offset` BIGINT, ids BINARY"""


def pack(
    docs: DataFrame,
    tokenizer_json: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens, similar documents side by side.

    One row for each piece: the id, start (tokens of its document before it), length, ids_crc32 (of the
    ids as little-endian unsigned 32-bit numbers), doc_tokens (with the end id), sequence_id,
    offset in the sequence, ids (packed as 32-bit numbers, unless left out). Sequences are
    gapless and full, but for the last one of all, which is to be padded. A null or empty text
    is its end id alone. Every row is packed, repeated ids and texts included; other columns are left
    out. ``tokenizer_json`` is the text of a tokenizer file.
    """
    spark = docs.sparkSession
    tokens = encoded(docs, tokenizer_json, id_col, text_col, end_id)
    order = along_curve(tokens)
    # One total for each partition of the sort, not for each document.
    totals = sorted((r["part"], r["n"]) for r in order.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base, running = {}, 0
    for part, n in totals:
        base[part] = running
        running += n
    bases = spark.sparkContext.broadcast(base)
    kind = np.uint16 if _vocabulary(tokenizer_json) <= 1 << 16 else np.uint32

    def cut(batches):
        for batch in batches:
            held = {name: [] for name in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
            parts, befores, whole = (batch.column(i).to_pylist() for i in (1, 2, 3))
            for row, (part, before, packed) in enumerate(zip(parts, befores, whole)):
                ids = np.frombuffer(packed, kind).astype("<u4")
                at, done = bases.value[part] + before, 0
                while done < len(ids):
                    size = min(length - at % length, len(ids) - done)
                    piece = ids[done : done + size].tobytes()
                    for name, value in zip(held, (row, done, size, zlib.crc32(piece), len(ids), at // length, at % length, piece if with_ids else None)):
                        held[name].append(value)
                    done, at = done + size, at + size
            rows = pa.array(held.pop("id"), pa.int64())
            ids = pa.array(held.pop("ids"), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), *(pa.array(v, pa.int64()) for v in held.values()), ids],
                ["id", *held, "ids"],
            )

    kinds = dict(tokens.dtypes)
    joined = tokens.select("id", "uid", "ids").join(order.select("uid", "part", "before"), "uid").select("id", "part", "before", "ids")
    pieces = joined.mapInArrow(cut, f"id {kinds['id']}, {PIECES}").withColumnRenamed("id", id_col)
    return pieces if with_ids else pieces.drop("ids")


def _vocabulary(tokenizer_json: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_str(tokenizer_json).get_vocab_size()
