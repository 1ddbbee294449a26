"""Exact Jaccard join of word shingles in a metric space.

The Jaccard distance is a metric. Two documents that link share one of the rarest shingles of either,
so each of these shingles elects a pivot (its smallest document), and a region is a pivot with all
documents that elected it. Small regions are joined at once, without the members that are too far from all
others: a sketch counts a set's shingles by hash range, which maps sets into a space of vectors where no distance
grows, so sets whose sketches are too far apart cannot link. In a large region every
document is first compared with the pivot: those within the distance are linked to it, and by
the triangle inequality two documents can link only if their distances to the pivot differ by no more than
the threshold. So the region falls into rings as wide as the threshold, ring members are copied to the
neighbouring rings, and only documents that are not yet in the pivot's component are joined again,
in blocks of bounded size.

Documents of equal shingle sets are one from the start. Links inside a component that is already
connected are not listed.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import arrays, repeats
from tickloom.llm.components import components
from tickloom.llm.frames import map_texts, stored
from tickloom.llm.sums import count_table, read_counts

SHINGLE_WORDS = 3
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 90
# Slots of the table of shingle frequencies that orders shingles; held by every task.
FREQUENCY_SLOTS = 1 << 20
# Shingles of all documents of a region, and of a block of a ring, that one task joins at a time.
SMALL_REGION = 500_000
BLOCK_SHINGLES = 500_000
GROUP_BYTES = 1 << 21
# A sketch has up to twice as many counts as a set has shingles for one; counts above 254 are open upwards.
SKETCH_SHINGLES = 16
SKETCH_LEAST = 16
_OPEN_COUNT = 1 << 30


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each document in ascending order, and the first one of each."""
    low = arrays.LOWER[data]
    starts, ends, first = arrays.words(low, bounds, arrays.NOT_SPACE)
    symbols = arrays.byte_hash(low, starts, ends)
    count = np.diff(first)
    at = arrays.window_starts(first, size)
    short = np.flatnonzero((count > 0) & (count < size))
    heads = np.concatenate([at, first[short]])
    codes = arrays.range_hash(symbols, heads, np.concatenate([at + size, first[short + 1]]))
    row = np.searchsorted(first, heads, "right") - 1
    order = np.lexsort((codes, row))
    codes, row = codes[order], row[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
    codes, row = codes[fresh], row[fresh]
    return codes, np.searchsorted(row, np.arange(len(bounds)))


def _slots(codes: np.ndarray) -> np.ndarray:
    return (codes >> np.uint64(64 - FREQUENCY_SLOTS.bit_length() + 1)).astype(np.int64)


def sketches(codes: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each document the number of its shingles in each of equal ranges of hashes, a byte each."""
    size = np.diff(first)
    bits = np.ceil(np.log2(np.maximum(size / SKETCH_SHINGLES, SKETCH_LEAST))).astype(np.int64)
    place = np.concatenate([[0], np.cumsum(1 << bits)])
    row = arrays.owners(first)
    counts = np.bincount(place[row] + (codes >> (64 - bits[row]).astype(np.uint64)).astype(np.int64), minlength=place[-1])
    raw = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return pa.array([raw[a:b] for a, b in zip(place[:-1].tolist(), place[1:].tolist())], pa.binary())


def near_some(size: np.ndarray, held: list[bytes], percent: int) -> np.ndarray:
    """Which documents may link with another one of them, by their set sizes and sketches."""
    width = np.fromiter(map(len, held), np.int64, len(held))
    order = np.argsort(size, kind="stable")
    size, width, near = size[order], width[order], np.zeros(len(order), bool)
    # The documents that are not too large to link with each, and those of whom no other set is near enough.
    last = np.searchsorted(percent * size, 100 * size, "right")
    alone = 100 * size < percent * (size + 1)
    for wide in np.unique(width[~alone]).tolist():
        own = np.flatnonzero((width == wide) & ~alone)
        low, high = int(own[0]), int(last[own[-1]])
        grid = np.empty((high - low, wide), np.int32)
        for other in np.unique(width[low:high]).tolist():  # larger sets have longer sketches, which are added up to this length
            some = np.flatnonzero(width[low:high] == other)
            counts = np.frombuffer(b"".join([held[n] for n in order[low + some].tolist()]), np.uint8).astype(np.int32)
            counts[counts == 255] = _OPEN_COUNT
            grid[some] = np.minimum(counts.reshape(len(some), wide, -1).sum(axis=2), _OPEN_COUNT)
        for at in own.tolist():
            common = np.minimum(grid[at - low], grid[at + 1 - low : last[at] - low]).sum(axis=1)
            hit = (100 + percent) * common >= percent * (size[at] + size[at + 1 : last[at]])
            near[at] |= hit.any()
            near[at + 1 : last[at]] |= hit
    out = np.empty(len(order), bool)
    out[order] = near
    return out


def shingle_frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """Documents by slot of their shingles' hashes: an upper bound of each shingle's frequency."""

    def fill(batches, table):
        for batch in batches:
            for _, _, data, bounds in arrays.row_chunks(batch.column(0)):
                table += np.bincount(_slots(shingle_sets(data, bounds, words)[0]), minlength=FREQUENCY_SLOTS).astype(np.uint32)

    counts = count_table(texts.select("text"), fill, FREQUENCY_SLOTS, "shingle-frequencies")
    return np.minimum(read_counts(counts, FREQUENCY_SLOTS), 0xFFFFFFFF).astype(np.uint32)


def described(texts: DataFrame, percent: int, words: int) -> DataFrame:
    """Stored table: doc, code, n (set size), digest (of the set), rare (the shingles of which a partner has one), sketch."""
    shared = texts.sparkSession.sparkContext.broadcast(shingle_frequencies(texts, words))  # of fixed size

    def job():
        def one(data, bounds, rows):
            codes, first = shingle_sets(data, bounds, words)
            size = np.diff(first)
            row = arrays.owners(first)
            order = np.lexsort((codes, shared.value[_slots(codes)], row))
            # A partner shares ceil(percent * n / 100) shingles, so at least one of the others and one more.
            prefix = np.where(size > 0, size + (-percent * size // 100) + 1, 0)
            place = np.arange(len(codes)) - first[row]
            rare = order[place < prefix[row]]
            raw = codes.tobytes()
            digests = [blake2b(raw[8 * a : 8 * b], digest_size=16).digest() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            return [size, pa.array(digests, pa.binary()), arrays.lists(codes[rare].view(np.int64), np.concatenate([[0], np.cumsum(prefix)])), sketches(codes, first)]

        return one

    found = map_texts(texts, "text", "n BIGINT, digest BINARY, rare ARRAY<BIGINT>, sketch BINARY", job)
    return stored(found.select("row.doc", "row.code", "result.*"), "shingle-sets")


def links_between(codes: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of ``left`` and ``right`` documents link, as a matrix; exact counts of common shingles."""
    size = np.diff(first)
    _, column = np.unique(codes, return_inverse=True)
    often = np.bincount(column, minlength=1) > 1
    number = np.cumsum(often) - 1
    row = arrays.owners(first)
    common = np.zeros((len(left), len(right)), np.float32)
    keep = often[column]
    column, row = number[column[keep]], row[keep]
    width = 1 << 11
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        part = (column >= low) & (column < low + width)
        grid = np.zeros((len(size), min(width, int(number[-1]) + 1 - low)), np.float32)
        grid[row[part], column[part] - low] = 1.0
        common += grid[left] @ grid[right].T
    union = size[left][:, None] + size[right][None, :] - common
    return 100 * common >= percent * union


def _spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the matrix (square) connects."""
    seen, found = np.zeros(len(linked), bool), []
    for root in range(len(linked)):
        if seen[root]:
            continue
        seen[root], todo = True, [root]
        while todo:
            node = todo.pop()
            for other in np.flatnonzero(linked[node] & ~seen).tolist():
                seen[other] = True
                found.append((node, other))
                todo.append(other)
    return found


def _whole_groups(df: DataFrame, keys: list[str], job, schema: str) -> DataFrame:
    """Run ``job(table)`` over tables that hold complete groups of ``keys``."""
    dealt = df.repartition(*keys).sortWithinPartitions(*keys)

    def heads_of(table):
        change = np.zeros(max(len(table) - 1, 0), bool)
        for key in keys:
            values = table[key].to_numpy()
            change |= values[1:] != values[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= GROUP_BYTES:
                table = pa.Table.from_batches(held)
                cut = int(heads_of(table)[-1])
                if cut:
                    yield from job(table.slice(0, cut).combine_chunks(), heads_of(table.slice(0, cut))).to_batches()
                    held = table.slice(cut).combine_chunks().to_batches()
                    size = sum(b.nbytes for b in held)
        if sum(len(b) for b in held):
            table = pa.Table.from_batches(held).combine_chunks()
            yield from job(table, heads_of(table)).to_batches()

    return dealt.mapInArrow(run, schema)


def _packed_texts(texts: DataFrame) -> DataFrame:
    """doc, code and the compressed text, as it travels to every region it is in."""

    def job():
        pack = zstandard.ZstdCompressor(level=3)
        return lambda data, bounds, rows: [
            pa.array([pack.compress(data[a:b].tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())], pa.binary())
        ]

    return map_texts(texts, "text", "packed BINARY", job).select("row.doc", "row.code", "result.packed")


def _unpacked(column: pa.Array) -> pa.Array:
    unpack = zstandard.ZstdDecompressor()
    return pa.array([unpack.decompress(b) for b in column.to_pylist()], pa.binary()).cast(pa.string())


def _sets_of(table: pa.Table, words: int) -> tuple[np.ndarray, np.ndarray]:
    parts, sizes = [], []
    for chunk in table["packed"].chunks:
        for _, _, data, bounds in arrays.row_chunks(_unpacked(chunk)):
            codes, first = shingle_sets(data, bounds, words)
            parts.append(codes), sizes.append(np.diff(first))
    sizes = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def _near_members(percent: int):
    def job(table, heads):
        size, held, keep = table["n"].to_numpy(), table["sketch"].to_pylist(), np.zeros(len(table), bool)
        for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(table)]):
            keep[low:high] = near_some(size[low:high], held[low:high], percent)
        return table.select(["pivot", "doc", "code"]).filter(pa.array(keep))

    return job


def _join_regions(percent: int, words: int):
    def job(table, heads):
        codes, first = _sets_of(table, words)
        docs = table["doc"].to_numpy()
        a, b = [], []
        for low, high in zip(heads, np.append(heads[1:], len(table))):
            own = np.arange(high - low)
            linked = links_between(codes[first[low] : first[high]], first[low : high + 1] - first[low], own, own, percent)
            for x, y in _spanning(linked):
                a.append(docs[low + x]), b.append(docs[low + y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return job


def _join_blocks(percent: int, words: int):
    """Straggling documents against a block of a ring; a link to each component of the other side at most."""

    def job(table, heads):
        codes, first = _sets_of(table, words)
        docs, groups, late = table["doc"].to_numpy(), table["component"].to_numpy(), table["late"].to_numpy(zero_copy_only=False)
        a, b = [], []
        for low, high in zip(heads, np.append(heads[1:], len(table))):
            own = late[low:high]
            left, right = np.flatnonzero(own), np.flatnonzero(~own)
            if not len(left) or not len(right):
                continue
            linked = links_between(codes[first[low] : first[high]], first[low : high + 1] - first[low], left, right, percent)
            linked &= groups[low + left][:, None] != groups[low + right][None, :]
            for i in np.flatnonzero(linked.any(axis=1)).tolist():
                partners = np.flatnonzero(linked[i])
                for j in np.unique(groups[low + right[partners]], return_index=True)[1].tolist():
                    a.append(docs[low + left[i]]), b.append(docs[low + right[partners[j]]])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return job


def _distances(percent: int, words: int):
    """Distance of the text to the pivot's in each row."""

    def run(batches):
        for batch in batches:
            pivot_of, texts = batch.column("pivot").to_numpy(), _unpacked(batch.column("packed"))
            order, place = np.unique(pivot_of, return_index=True)
            pivots = _unpacked(batch.column("pivot_packed").take(pa.array(place)))
            held = dict(zip(order.tolist(), _sets_by_row(pivots, words)))
            for low, high, data, bounds in arrays.row_chunks(texts):
                codes, first = shingle_sets(data, bounds, words)
                size = np.diff(first)
                row = arrays.owners(first)
                common = np.zeros(high - low, np.int64)
                for pivot in np.unique(pivot_of[low:high]).tolist():
                    own = held[pivot]
                    hit = own[np.minimum(np.searchsorted(own, codes), len(own) - 1)] == codes
                    mine = pivot_of[low:high] == pivot
                    common = np.where(mine, np.bincount(row[hit], minlength=high - low), common)
                union = size + np.array([len(held[p]) for p in pivot_of[low:high].tolist()]) - common
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name) for name in ("pivot", "doc", "code", "n")), pa.array(1 - common / union), pa.array(100 * common >= percent * union)],
                    ["pivot", "doc", "code", "n", "distance", "linked"],
                )

    return run


def _sets_by_row(column: pa.Array, words: int) -> list[np.ndarray]:
    found = []
    for _, _, data, bounds in arrays.row_chunks(column):
        codes, first = shingle_sets(data, bounds, words)
        found += np.split(codes, first[1:-1])
    return found


def class_links(texts: DataFrame, sets: DataFrame, percent: int, small_region: int, block_shingles: int, words: int) -> DataFrame:
    """Links (a, b) between documents of different sets that connect all that the join connects."""
    spark = texts.sparkSession
    leads = sets.where("n > 0").groupBy("digest").agg(F.min(F.struct("doc", "code")).alias("lead"))
    rare = (
        sets.join(leads, "digest")
        .where((F.col("doc") == F.col("lead.doc")) & (F.col("code") == F.col("lead.code")))
        .dropDuplicates(["digest"])
        .select("doc", "code", "n", F.explode("rare").alias("shingle"))
    )
    # Two documents of sizes too far apart cannot link, so their shingle elects nobody.
    alike = (F.col("holders") > 2) | (100 * F.col("least") >= percent * F.col("most"))
    # Stored, so that the shuffle of all shingles is gone before they are shuffled again to those that elect.
    elected = stored(
        rare.groupBy("shingle")
        .agg(F.count("*").alias("holders"), F.min("doc").alias("pivot"), F.min("n").alias("least"), F.max("n").alias("most"))
        .where((F.col("holders") > 1) & alike)
        .select("shingle", "pivot"),
        "elected",
    )
    members = stored(rare.join(elected, "shingle").select("pivot", "doc", "code", "n").distinct(), "regions")
    sizes = stored(members.groupBy("pivot").agg(F.count("*").alias("docs"), F.sum("n").alias("size")).where("docs > 1"), "region-sizes")
    sized = members.join(sizes, "pivot")
    # Most members of small regions share a shingle by chance: they go before any text travels.
    sketched = sets.where("n > 0").select("doc", "code", "sketch").dropDuplicates(["doc", "code"])
    small = sized.where(F.col("size") <= small_region).join(sketched, ["doc", "code"]).select("pivot", "doc", "code", "n", "sketch")
    close = stored(_whole_groups(small, ["pivot"], _near_members(percent), "pivot BIGINT, doc BIGINT, code INT"), "near-members")
    large = sized.where(F.col("size") > small_region).select("pivot", "doc", "code", "n")
    wanted = close.select("doc", "code").union(large.select("doc", "code")).distinct()
    held = stored(_packed_texts(texts.join(wanted, ["doc", "code"])).dropDuplicates(["doc", "code"]), "region-texts")

    near = _whole_groups(close.join(held, ["doc", "code"]).select("pivot", "doc", "packed"), ["pivot"], _join_regions(percent, words), "a BIGINT, b BIGINT")

    centres = large.where("doc = pivot").dropDuplicates(["pivot"]).join(held, ["doc", "code"]).select("pivot", F.col("packed").alias("pivot_packed"))
    compared = large.join(held, ["doc", "code"]).join(centres, "pivot").select("pivot", "doc", "code", "n", "packed", "pivot_packed")
    rings = stored(compared.mapInArrow(_distances(percent, words), "pivot BIGINT, doc BIGINT, code INT, n BIGINT, distance DOUBLE, linked BOOLEAN"), "rings")
    first = stored(near.union(rings.where("linked AND doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b"))), "near-links")

    if rings.isEmpty():
        return first
    label = components(first)
    named = rings.join(label.select(F.col("node").alias("doc"), "component"), "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    main = named.where("doc = pivot").select("pivot", F.col("component").alias("main")).distinct()
    # One slack thousandth, so that rounding never separates two rings.
    width = 1 - percent / 100
    ring = F.floor(F.col("distance") / (width + 0.001)).cast("int")
    placed = stored(named.join(main, "pivot").withColumn("ring", ring).withColumn("late", F.col("component") != F.col("main")), "rings")
    late_count = placed.where("late").groupBy("pivot").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("late_blocks"))
    ring_count = placed.groupBy("pivot", "ring").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("ring_blocks"))
    spread = lambda blocks: F.pmod(F.xxhash64("doc", "code"), blocks).cast("int")
    others = (
        placed.join(late_count, "pivot")
        .join(ring_count, ["pivot", "ring"])
        .withColumn("block", spread(F.col("ring_blocks")))
        .withColumn("late_block", F.explode(F.sequence(F.lit(0), F.col("late_blocks") - 1)))
        .select("pivot", "ring", "block", "late_block", "doc", "code", "component", F.lit(False).alias("late"))
    )
    stragglers = (
        placed.where("late")
        .join(late_count, "pivot")
        .withColumn("late_block", spread(F.col("late_blocks")))
        .withColumn("ring", F.explode(F.array(F.col("ring") - 1, F.col("ring"), F.col("ring") + 1)))
        .join(ring_count, ["pivot", "ring"])
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("ring_blocks") - 1)))
        .select("pivot", "ring", "block", "late_block", "doc", "code", "component", F.lit(True).alias("late"))
    )
    cells = others.unionByName(stragglers).join(held, ["doc", "code"])
    rest = _whole_groups(cells, ["pivot", "ring", "block", "late_block"], _join_blocks(percent, words), "a BIGINT, b BIGINT")
    return first.union(rest)


def join_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    small_region: int = SMALL_REGION,
    block_shingles: int = BLOCK_SHINGLES,
    words: int = SHINGLE_WORDS,
) -> DataFrame:
    """Components of the join: id, n_shingles, component_id (the smallest id that links reach).

    Shingles have ``words`` words. Texts of fewer words have all their words as one shingle; null texts and texts without words
    have none and link with nothing. Rows of equal id are one document for the links, so they share a
    component if they have shingles. A null id counts as smaller than any other. Every row comes back
    once; other columns are left out.
    """
    texts = repeats.keyed(docs, id_col, text_col)
    sets = described(texts, percent, words)
    found = components(class_links(texts, sets, percent, small_region, block_shingles, words))
    leads = sets.where("n > 0").groupBy("digest").agg(F.min("doc").alias("lead"))
    # Rows of one id but different sets hang together too.
    classes = leads.join(found.select(F.col("node").alias("lead"), "component"), "lead", "left").select("digest", F.coalesce("component", "lead").alias("component"))
    null = F.lit(-(2**63))
    return sets.join(classes, "digest", "left").select(
        F.when(F.col("doc") != null, F.col("doc")).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.coalesce("component", "doc") != null, F.coalesce("component", "doc")).alias("component_id"),
    )
