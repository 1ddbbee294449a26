"""Phrase collocations by Toivonen's sampling method.

A sample of the rows is mined with a lowered threshold and proposes phrases. One pass over all rows
counts exactly every proposed phrase and the negative border: phrases that were not proposed although
both their parts (all words but the last, all but the first) were. A phrase cannot be more frequent than its
parts, so if no border phrase is frequent, all frequent phrases have been counted. Frequent border phrases
(failures of the sample) join the proposals, and further passes count what they open up, until no pass
finds one. The sample thus decides how many passes are needed, never what is found.

The proposals travel to the tasks as a bitmap of fixed size over phrase hashes, and passes count hashes; collisions of bits
only add proposals. The words of the frequent hashes are then read off the texts: first off a small share of the rows, then
off a larger one and at last off all rows, each time only those not yet known. A phrase that stands nearly everywhere is
thus spelled by the few tasks of the first share and not by every task of the table. (Places of equal 61-bit hashes count as one phrase.)
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import arrays
from tickloom.llm.frames import stored

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
NO_GROUP = "und"

SAMPLE = 0.125
# The sample's threshold is this share of the count that a phrase at the threshold has there on average.
SAMPLE_MARGIN = 0.4
SLOT_BITS = 27  # 16 MB, whatever the input
CHUNK_BYTES = 1 << 21
# A task adds up the hashes of so many places, and spelled phrases up to so many, before they leave it.
HELD_CODES = 1 << 21
HELD_PHRASES = 1 << 18
BATCH_ROWS = 1 << 16
# A word or language may begin a third of all phrases: joins on them are dealt out so many times.
SALTS = 16
_BLOCK_BITS = 32768  # of Spark's bitmap_construct_agg

_IN_WORD = np.ones(256, bool)
_IN_WORD[[0x20, 0x09, *b".,;:!?", *range(0x0A, 0x0E)]] = False
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)

COUNTS = "lang STRING, phrase STRING, n BIGINT"
SPELLED = f"code BIGINT, {COUNTS}"
# The last bits of a phrase's hash are its number of words.
_SIZE_BITS = 3


def _group_codes(names: pa.Array) -> np.ndarray:
    data, bounds = arrays.text_bytes(names)
    return arrays.byte_hash(data, bounds[:-1], bounds[1:])


def _longer(codes: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of phrases that are one word longer, and then ``size`` words long."""
    code = arrays.mix(codes * _STEP + words)
    return (code >> np.uint64(_SIZE_BITS) << np.uint64(_SIZE_BITS)) | np.uint64(size)


class Proposed:
    """A set of phrase hashes as bits; it may hold more than was put in, never less."""

    def __init__(self, packed: bytes):
        self.bits = np.frombuffer(zlib.decompress(packed), np.uint8)
        self.mask = np.uint64(len(self.bits) * 8 - 1)

    @staticmethod
    def packed(bits: np.ndarray) -> bytes:
        return zlib.compress(bits.tobytes(), 1)

    def holds(self, codes: np.ndarray) -> np.ndarray:
        slot = (codes >> np.uint64(_SIZE_BITS)) & self.mask
        return (self.bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _spelled(low, starts, ends, first, size) -> pa.Array:
    """The phrases of ``size`` words from the words ``first`` on, with single spaces."""
    at = first[:, None] + np.arange(size)
    lead = np.arange(size) > 0
    length = (ends[at] - starts[at] + lead).ravel()
    place = np.concatenate([[0], np.cumsum(length)])
    text = low[np.repeat((starts[at] - lead).ravel() - place[:-1], length) + np.arange(place[-1])]
    text[place[:-1].reshape(at.shape)[:, 1:].ravel()] = 0x20
    bounds = np.ascontiguousarray(place[::size])
    return pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(text)]).cast(pa.string())


def _chunk_phrases(data, bounds, group_of_row, group_codes, proposed: Proposed, former: Proposed | None, max_words: int):
    """Places of phrases of a chunk that ``proposed`` opens, length by length: size, groups, hashes, which are fresh, spell.

    Fresh are those that ``former`` did not open; ``spell`` gives the words at chosen places.
    """
    low = arrays.LOWER[data]
    starts, ends, first = arrays.words(low, bounds, _IN_WORD)
    n_words = len(starts)
    if not n_words:
        return
    group = np.repeat(group_of_row, np.diff(first))
    breaks = np.concatenate([[0], np.cumsum(_BREAK[low])])
    joined = np.zeros(n_words, bool)  # with the word after it, in one piece
    joined[:-1] = breaks[starts[1:]] == breaks[ends[:-1]]
    joined[first[1:-1][first[1:-1] > 0] - 1] = False
    words = arrays.byte_hash(low, starts, ends)
    at, codes = np.arange(n_words), _longer(group_codes[group], words, 1)
    passed = np.zeros(n_words + 1, bool)
    for size in range(1, max_words + 1):
        if former is None:
            fresh = np.ones(len(at), bool)
        elif size == 1:
            fresh = np.zeros(len(at), bool)
        else:
            fresh = ~(passed[at] & passed[at + 1])
        yield size, group[at], codes, fresh, lambda some, at=at, size=size: _spelled(low, starts, ends, at[some], size)
        if size == max_words:
            return
        use = np.zeros(n_words + 1, bool)
        use[at] = proposed.holds(codes)
        if former:
            # Counted before, not merely proposed: a chance bit of a phrase that was never reached opened nothing.
            passed = np.zeros(n_words + 1, bool)
            passed[at] = former.holds(codes) & ~fresh
        goes_on = use[at] & use[at + 1] & joined[at]
        at = at[goes_on]
        codes = _longer(codes[goes_on], words[at + size], size + 1)


def _tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in ascending order and how often each stands."""
    codes = np.sort(codes)
    heads = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[heads], np.diff(heads, append=len(codes))


def _chunks(batches: Iterator[pa.RecordBatch]):
    """(data, bounds, language of each row, hashes of the languages, their names) of all chunks of (lang, text) rows."""
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        names, row_group = coded.dictionary.cast(pa.string()), coded.indices.to_numpy().astype(np.int64)
        codes = _group_codes(names)
        for a, b, data, bounds in arrays.row_chunks(batch.column(1), CHUNK_BYTES):
            yield data, bounds, row_group[a:b], codes, names


class Spelled:
    """Counts of phrases by their hashes, over the chunks of a task; each is spelled once."""

    def __init__(self):
        self.codes, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # ascending hashes, their places in the others
        self.counts, self.parts = np.zeros(0, np.int64), []

    def add(self, codes: np.ndarray, some: np.ndarray, spell: Callable[[np.ndarray], tuple[pa.Array, pa.Array]]) -> None:
        """Count the places ``some``, of which ``spell`` gives languages and phrases."""
        kinds, counts = _tally(codes[some])
        place = np.searchsorted(self.codes, kinds)
        known = np.zeros(len(kinds), bool)
        inside = place < len(self.codes)
        known[inside] = self.codes[place[inside]] == kinds[inside]
        self.counts[self.number[place[known]]] += counts[known]
        new = kinds[~known]
        if not len(new):
            return
        # The first place of each hash that was not met before.
        spot = np.minimum(np.searchsorted(new, codes[some]), len(new) - 1)
        fits = np.flatnonzero(new[spot] == codes[some])
        lead = np.empty(len(new), np.int64)
        lead[spot[fits[::-1]]] = some[fits[::-1]]
        self.parts.append(spell(lead))
        number = len(self.counts) + np.arange(len(new))
        self.counts = np.concatenate([self.counts, counts[~known]])
        at = np.searchsorted(self.codes, new)
        self.codes, self.number = np.insert(self.codes, at, new), np.insert(self.number, at, number)

    def batches(self) -> Iterator[pa.RecordBatch]:
        codes = np.empty(len(self.codes), np.uint64)
        codes[self.number] = self.codes
        first = 0
        for names, phrases in self.parts:
            part = slice(first, first + len(names))
            yield pa.RecordBatch.from_arrays([pa.array(codes[part].view(np.int64)), names, phrases, pa.array(self.counts[part])], ["code", "lang", "phrase", "n"])
            first += len(names)


def _count(texts: DataFrame, proposed: Broadcast, former: Broadcast | None, max_words: int) -> DataFrame:
    """Counts (code, n) of one pass: the hashes of all phrases that ``proposed`` opens and ``former`` did not."""

    def tallied(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes, counts = _tally(np.concatenate(held))
        for at in range(0, len(codes), BATCH_ROWS):
            part = slice(at, at + BATCH_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(codes[part].view(np.int64)), pa.array(counts[part])], ["code", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = Proposed(proposed.value), Proposed(former.value) if former else None
        held: list[np.ndarray] = []
        for *chunk, _ in _chunks(batches):
            held += [codes[fresh] for _, _, codes, fresh, _ in _chunk_phrases(*chunk, now, then, max_words)]
            if sum(map(len, held)) >= HELD_CODES:
                yield from tallied(held)
                held = []
        if held:
            yield from tallied(held)

    return texts.mapInArrow(run, "code BIGINT, n BIGINT").groupBy("code").agg(F.sum("n").alias("n"))


def _spell(texts: DataFrame, proposed: Broadcast, chosen: Broadcast, max_words: int) -> DataFrame:
    """Counts (code, lang, phrase, n) of the phrases whose hash is chosen; the empty phrase counts a language's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, wanted = Proposed(proposed.value), Proposed(chosen.value)
        held = Spelled()
        for *chunk, names in _chunks(batches):
            for size, groups, codes, _, spell in _chunk_phrases(*chunk, now, None, max_words):
                if size == 1:
                    total = np.bincount(groups, minlength=len(names)).astype(np.int64)
                    empty = pa.array([""] * len(names), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.nulls(len(names), pa.int64()), names, empty, pa.array(total)], ["code", "lang", "phrase", "n"])
                held.add(codes, np.flatnonzero(wanted.holds(codes)), lambda some, groups=groups, spell=spell: (names.take(pa.array(groups[some])), spell(some)))
            if len(held.codes) >= HELD_PHRASES:
                yield from held.batches()
                held = Spelled()
        yield from held.batches()

    return texts.mapInArrow(run, SPELLED).groupBy("code", "lang", "phrase").agg(F.sum("n").alias("n"))


def _named(shares: list[DataFrame], found: DataFrame, closed: np.ndarray, max_words: int) -> DataFrame:
    """Counts (lang, phrase, n) from those by hash; ``shares`` are growing parts of the rows, the last one is all of them.

    A share spells what those before it have not. The rows that tasks give out so follow the number of frequent phrases, not
    also that of the tasks: a phrase that many tasks hold is as good as certain to stand in a share that few of them read.
    """
    slot_bits, send = (len(closed) * 8).bit_length() - 1, found.sparkSession.sparkContext.broadcast
    proposed, left, spelled = send(Proposed.packed(closed)), found, []
    for texts in shares:
        bits = _bitmap(left, slot_bits)
        chosen = send(Proposed.packed(bits))
        # With nothing left to spell, the words of the languages are still to be counted.
        spelled.append(stored(_spell(texts, proposed, chosen, max_words if bits.any() else 1), f"phrases-spelled-{len(spelled)}"))
        chosen.destroy()
        left = left.join(spelled[-1], "code", "left_anti")
    proposed.destroy()
    # A chance bit may spell a phrase that is not frequent, or one a second time.
    names = reduce(DataFrame.unionByName, spelled).where(F.col("phrase") != "").groupBy("code").agg(F.min(F.struct("lang", "phrase")).alias("of"))
    phrases = found.join(names, "code").select("of.lang", "of.phrase", "n")
    return stored(phrases.unionByName(spelled[-1].where("phrase = '' AND n > 0").select("lang", "phrase", "n")), "phrases")


def _bitmap(codes: DataFrame, slot_bits: int) -> np.ndarray:
    """Bits of a table of hashes, merged by Spark."""
    slot = F.shiftright("code", _SIZE_BITS).bitwiseAND(F.lit((1 << slot_bits) - 1))
    block, bit = F.floor(slot / _BLOCK_BITS), slot % _BLOCK_BITS
    merged = codes.groupBy(block.alias("block")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    bits = np.zeros((1 << slot_bits) // 8, np.uint8)
    for row in merged.toLocalIterator():  # at most the fixed size of the bitmap
        held = np.frombuffer(row["bits"], np.uint8)
        at = row["block"] * (_BLOCK_BITS // 8)
        bits[at : at + len(held)] |= held[: len(bits) - at]
    return bits


def _closed(texts: DataFrame, bits: np.ndarray, min_count: int, max_words: int, label: str) -> tuple[DataFrame, np.ndarray, int]:
    """Hashes that are frequent, starting from proposals ``bits``; the closed proposals; the number of passes."""
    slot_bits = (len(bits) * 8).bit_length() - 1
    tables, former = [], None
    while True:
        sent = texts.sparkSession.sparkContext.broadcast(Proposed.packed(bits))  # a bitmap of fixed size
        tables.append(stored(_count(texts, sent, former, max_words).where(F.col("n") >= min_count), f"{label}-{len(tables)}"))
        # The counts are stored: no task asks for the bitmap before the last any more.
        if former:
            former.destroy()
        shorter = F.col("code").bitwiseAND(F.lit((1 << _SIZE_BITS) - 1)) < max_words
        former, grown = sent, bits | _bitmap(tables[-1].where(shorter), slot_bits)
        if np.array_equal(grown, bits):
            sent.destroy()
            return reduce(DataFrame.unionByName, tables), bits, len(tables)
        bits = grown


def frequent_phrases(
    docs: DataFrame,
    text_col: str = "text",
    group_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    sample: float = SAMPLE,
    slot_bits: int = SLOT_BITS,
    on_pass: Callable[[int], None] | None = None,
) -> DataFrame:
    """Exact counts (lang, phrase, n) of all phrases of 1 to ``max_words`` words that a group has ``min_count`` times or more.

    The row of the empty phrase holds a group's number of words. Texts are lower-cased (A-Z), parted at
    ``[.,;:!?\\x0A-\\x0D]``, and words are ``[^\\x20\\x09]+``; no phrase crosses a part. A null group is ``und``, a null
    text is empty, and repeated rows count as often as they stand. ``on_pass`` learns the number of passes.
    """
    texts = docs.select(
        F.coalesce(F.col(group_col).cast("string"), F.lit(NO_GROUP)).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    if not 1 <= max_words < 1 << _SIZE_BITS:
        raise ValueError("phrases have 1 to 7 words")
    nothing = np.zeros((1 << slot_bits) // 8, np.uint8)
    some = stored(texts.sample(fraction=sample, seed=11), "phrase-sample")
    lowered = max(2, int(min_count * sample * SAMPLE_MARGIN))
    _, proposed, _ = _closed(some, nothing, lowered, max_words, "sample-phrases")
    found, closed, passes = _closed(texts, proposed, min_count, max_words, "phrases")
    if on_pass:
        on_pass(passes)
    return _named([some.sample(fraction=sample, seed=12), some, texts], found, closed, max_words)


def _salted(counts: DataFrame, names: dict[str, str]) -> DataFrame:
    copies = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return counts.select(*(F.col(old).alias(new) for old, new in names.items()), copies)


def collocations(docs: DataFrame, text_col: str = "text", group_col: str = "lang", min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, **mining) -> DataFrame:
    """The ``top`` phrases of each group: lang, rank, phrase, a, l, r, n, score.

    Candidates have 2 to ``max_words`` words and a = f(phrase) >= ``min_count``. A cut after k words scores
    floor(1000 * a * n / (l * r)); the lowest counts, ties to the smallest k. Candidates inside a longer
    candidate of the same count go. Order: score and a descending, phrase ascending. Arithmetic is in
    decimals of 38 digits. For nulls, repeats and empty tables see ``frequent_phrases``; other columns are left out.
    """
    counts = frequent_phrases(docs, text_col, group_col, min_count, max_words, **mining)
    words, phrase = F.split("phrase", " "), F.col("phrase") != ""
    listed = counts.where(phrase).select("lang", "phrase", F.col("n").alias("a"), words.alias("words"), F.size(words).alias("size")).where("size > 1")
    each = listed.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"), F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    each = each.select(
        "lang", "phrase", "a", "size", "k", "salt",
        F.array_join(F.slice("words", 1, F.col("k")), " ").alias("head"), F.array_join(F.slice("words", F.col("k") + 1, F.col("size")), " ").alias("tail"),
    )
    each = each.join(_salted(counts.where(phrase), {"lang": "lang", "phrase": "head", "n": "l"}), ["lang", "head", "salt"])
    each = each.join(_salted(counts.where(phrase), {"lang": "lang", "phrase": "tail", "n": "r"}), ["lang", "tail", "salt"])
    each = each.join(_salted(counts.where(~phrase), {"lang": "lang", "n": "n"}), ["lang", "salt"])
    exact = {name: F.col(name).cast("decimal(38,0)") for name in ("a", "l", "r", "n")}
    cuts = each.select("*", (exact["a"] * exact["n"] * 1000).alias("over"), (exact["l"] * exact["r"]).alias("under"))
    cuts = stored(cuts.select("lang", "phrase", "a", "l", "r", "n", "k", "size", "head", "tail", F.expr("over div under").alias("score")), "phrase-cuts")
    # A longer candidate of the same count implies one that is longer by one word: it lies between the two in count.
    longer = cuts.where("size > 2")
    inside = longer.where("k = size - 1 AND l = a").select("lang", F.col("head").alias("phrase"))
    inside = inside.unionByName(longer.where("k = 1 AND r = a").select("lang", F.col("tail").alias("phrase"))).distinct()
    worst = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).join(inside, ["lang", "phrase"], "left_anti")
    scored = worst.select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).alias("deal"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First within shares of a language, so that no task sorts all of one.
    first = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
