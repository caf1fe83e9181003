"""Operator 7: near-copies by SimHash, compared bit-sliced inside buckets of agreeing bits."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import packed
from millrace.scratch import stage

SEED = 42
#: Sets of shingles meet in buckets by BANDS keys of BAND_ROWS minima each: a pair of Jaccard 0.8 misses all with 3 in 100,000.
BANDS, BAND_ROWS = 20, 4
#: Bits by which a node may differ from its bucket's pivot before the two are compared exactly; at Jaccard 0.8 about 10 do.
PIVOT_RADIUS = 24
#: Kinds of keys by which the pivots of a bucket are chosen.
PIVOTS = 3
#: Words of 64 bits of the fingerprint by which the nodes that pivots leave are compared.
WIDE_WORDS = 8
#: Standard deviations of differing bits beyond the mean at the least similarity: one pair in 100,000 differs by more.
WIDE_DEVIATIONS = 4.3
#: Nearest nodes of a bucket that are compared through a join; all that are left after that are compared inside the bucket's task.
CANDIDATES = 8
#: Shingles of the nodes of a bucket's part that such a task holds.
PART_SHINGLES = 1 << 22
#: Rows compared with one another at once; small buckets share such a block.
BLOCK_ROWS = 512
#: Buckets with more fingerprints are cut further by more agreeing bits.
BUCKET_ROWS = 16_384
FULL = (1 << 64) - 1


def fingerprint(text: bytes, shingle: int = 3, seed: int = SEED, piece: int = 1 << 18) -> int:
    """SimHash of the shingles' XXH64, repeats included; a bit is 1 if set in over half of them; no words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        starts, ends = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        after = np.cumsum(lengths + 1) - 1
        starts = (after - lengths)[: len(words) - shingle + 1].tolist()
        ends = after[shingle - 1:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(starts), piece):
        hashes = np.array([digest(joined[a:b], seed) for a, b in zip(starts[k: k + piece], ends[k: k + piece])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.flatnonzero(2 * counts > len(starts))
    return int(sum(1 << int(b) for b in set_bits))


def fingerprints(docs: DataFrame, identity: Column, text: Column, shingle: int) -> DataFrame:
    """(id, fp): fp is the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("fp", T.LongType())])
    return docs.select(identity.cast("bigint").alias("id"), text.alias("text")).mapInArrow(compute, schema)


def agreeing_masks(mask: int, radius: int) -> list[int]:
    """``mask`` with two of ``radius`` + 2 equal blocks of its other bits added, each choice once.

    Fingerprints that agree on ``mask`` and differ in at most ``radius`` bits
    agree on at least one of the results.
    """
    rest = [b for b in range(64) if not mask >> b & 1]
    if len(rest) < radius + 2:
        return []
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(rest, radius + 2)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


def bit_planes(values: np.ndarray) -> np.ndarray:
    """(bits, words): bit k of every value, 64 values to a word; a value has one column of 64 bits or several."""
    rows = values.reshape(len(values), -1)
    lanes = -len(rows) % 64
    padded = np.concatenate([rows, np.zeros((lanes, rows.shape[1]), np.uint64)]) if lanes else rows
    bits = np.unpackbits(np.ascontiguousarray(padded).view(np.uint8), axis=1, bitorder="little")
    return np.packbits(bits.T.copy(), axis=1, bitorder="little").view(np.uint64)


def valid_lanes(count: int) -> np.ndarray:
    """Words whose bits say which lanes of :func:`bit_planes` hold a value."""
    valid = np.full(-(-count // 64), np.uint64(FULL))
    if count % 64:
        valid[-1] = np.uint64((1 << count % 64) - 1)
    return valid


def near_lanes(planes: np.ndarray, valid: np.ndarray, mine: np.ndarray, radius: int, first_word: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): value i of ``mine`` and lane j differ in at most ``radius`` bits.

    The differences of eight planes at a time are added into bitwise counters by
    carry-save steps, and words (64 values) are abandoned once all their counts
    exceed the radius.
    """
    mine = mine.reshape(len(mine), -1)
    columns = np.arange(first_word, planes.shape[1])
    counters = [np.zeros((len(mine), len(columns)), np.uint64) for _ in range(max(4, radius.bit_length()))]
    over = np.broadcast_to(~valid[columns], counters[0].shape).copy()

    def differing(k: int) -> np.ndarray:
        query = (np.uint64(0) - (mine[:, k >> 6] >> np.uint64(k & 63) & np.uint64(1)))[:, None]
        return planes[k, columns][None, :] ^ query

    def add(level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Carry-save step: two more of a counter's weight; what is carried to the next."""
        half = a ^ b
        carry = (a & b) | (half & counters[level])
        counters[level] ^= half
        return carry

    for first in range(0, len(planes), 8):
        fours = [
            add(1, add(0, differing(k), differing(k + 1)), add(0, differing(k + 2), differing(k + 3))) for k in (first, first + 4)
        ]
        carry = add(2, *fours)
        for c in counters[3:]:
            carry, c[:] = c & carry, c ^ carry
        over |= carry
        if first + 8 > radius:
            alive = (~(over | above(counters, radius))).any(axis=0)
            if not alive.any():
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
            if alive.sum() * 2 < len(alive):
                columns, over, counters = columns[alive], over[:, alive], [c[:, alive] for c in counters]
    near = ~(over | above(counters, radius))
    rows, words = np.nonzero(near)
    lanes = np.unpackbits(near[rows, words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    which, lane = np.nonzero(lanes)
    return rows[which], columns[words[which]] * 64 + lane


def close_pairs(values: np.ndarray, radius: int, chunk: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j), i < j, of values that differ in at most ``radius`` bits; up to ``chunk`` values at a time meet all later ones."""
    planes, valid = bit_planes(values), valid_lanes(len(values))
    for first in range(0, len(values), chunk):
        i, j = near_lanes(planes, valid, values[first: first + chunk], radius, first // 64)
        i = i + first
        yield i[i < j], j[i < j]


def above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count exceeds ``radius``: bitwise comparison from the highest counter bit."""
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], np.uint64(FULL))
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same &= counters[k]
        else:
            more |= same & counters[k]
            same &= ~counters[k]
    return more


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give linked indices the smallest index of their group as label."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


def block_links(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A star of links for every group of linked values."""
    label = np.arange(len(values))
    for i, j in close_pairs(values, radius):
        unite(label, i, j)
    tied = np.flatnonzero(label != np.arange(len(values)))
    return values[tied], values[label[tied]]


def bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """(a, b) links from rows (mask, key, fp); whole buckets meet in one task, many buckets per block."""

    def blocks(fps: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
        sizes = np.diff(np.append(starts, len(fps)))
        held, rows = [], 0
        for start, size in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            if rows and rows + size > BLOCK_ROWS:
                yield np.unique(np.concatenate(held))
                held, rows = [], 0
            held.append(fps[start: start + size])
            rows += size
        if held:
            yield np.unique(np.concatenate(held))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        for batch in chain_end(batches):
            last = batch is None
            new = [np.zeros(0, np.int64)] * 3 if last else [c.to_numpy() for c in batch.columns]
            mask, key, fp = (np.concatenate([k, n]) for k, n in zip(kept, new))
            starts = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])]) if len(mask) else np.zeros(0, int)
            end = len(mask) if last or not len(starts) else starts[-1]
            kept = [mask[end:], key[end:], fp[end:]]
            for values in blocks(fp[:end].view(np.uint64), starts[starts < end]):
                a, b = block_links(values, radius)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    # comparing costs more than the rows' size tells: a number, so that tasks aren't put together by it
    tasks = int(buckets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return buckets.repartition(tasks, "mask", "key").sortWithinPartitions("mask", "key").mapInArrow(link, schema)


def chain_end(batches: Iterator) -> Iterator:
    """The batches, then None."""
    yield from batches
    yield None


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def find_links(known: DataFrame, radius: int) -> DataFrame:
    """(a, b): links that connect all fingerprints ``known.fp`` within ``radius`` bits of each other.

    Every fingerprint goes into one bucket for each choice of two agreeing
    blocks.  Members of buckets above ``BUCKET_ROWS`` go on with two more
    agreeing blocks of the other bits, and so on: no pair is lost, and at the
    last level a bucket holds a few fingerprints at most.
    """
    spark = known.sparkSession
    masks, members, links = [0], known.select("fp"), None
    while True:
        pairs = [(signed(m), signed(child)) for m in masks for child in agreeing_masks(m, radius)]
        if not pairs:
            return links
        if masks == [0]:
            level = members.select(F.explode(F.array(*[F.lit(child) for _, child in pairs])).alias("mask"), "fp")
        else:
            schema = T.StructType([T.StructField("mask", T.LongType()), T.StructField("child", T.LongType())])
            children = spark.createDataFrame(pairs, schema).groupBy("mask").agg(F.collect_list("child").alias("children"))
            level = members.join(children, "mask").select(F.explode("children").alias("mask"), "fp").distinct()
        level = stage(level.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))), "simhash-buckets").select("mask", "key", "fp")
        hot = stage(level.groupBy("mask", "key").count().where(F.col("count") > BUCKET_ROWS).drop("count"), "simhash-hot")
        masks = list({child & FULL for _, child in pairs})
        deeper = any(agreeing_masks(m, radius) for m in masks) and not hot.isEmpty()
        found = bucket_links(level.join(hot, ["mask", "key"], "left_anti") if deeper else level, radius)
        links = found if links is None else links.unionByName(found)
        if not deeper:
            return links
        members = level.join(hot, ["mask", "key"], "left_semi").select("mask", "fp")


def stars(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots, root being the smallest of its component.

    Large-star and small-star steps in turn, each stored, until nothing changes.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "simhash-links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("_a"), F.least("low", "a").alias("low"))
        large = both.join(lowest, F.col("a") == F.col("_a")).where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "_a")
        small = large.join(low, F.col("a") == F.col("_a"))
        turned = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(small.select("a", F.col("low").alias("b")))
        edges = stage(turned.where("a != b").distinct(), "simhash-stars")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def group_near_copies(docs: DataFrame, *, identity: Column, text: Column, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(id, fp, component_id) for every row: the smallest id reachable over links of ``radius`` bits at most.

    Words are runs of other than ASCII white space, A-Z lower-cased; a text of
    fewer than ``shingle`` words is one shingle, and without words (null too)
    the fingerprint is zero and linked like any other.  Null ids belong to the
    component but never name it, unless it has no other.  Repeated rows share
    their fingerprint's component.  An empty table gives an empty one.

    Rows with the same fingerprint are one node; only nodes are compared.
    """
    rows = stage(fingerprints(docs, identity, text, shingle), "simhash-rows")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    roots = stars(find_links(nodes, radius))
    linked = nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    names = linked.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "_root")
    named = linked.join(names, F.col("root") == F.col("_root")).select(F.col("fp").alias("_fp"), "component_id")
    named = stage(named, "simhash-components")
    return rows.join(named, F.col("fp") == F.col("_fp")).select("id", "fp", "component_id")


def shingle_set(text: bytes, shingle: int) -> np.ndarray:
    """Distinct XXH64 of the runs of ``shingle`` words, sorted; a shorter text is one run, one without words has none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    last = max(1, len(words) - shingle + 1)
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(words[k: k + shingle]), SEED) for k in range(last)], np.uint64))


def sketch(shingles: np.ndarray, piece: int = 1 << 13) -> tuple[int, list[int]]:
    """(SimHash of the set, one key per band of minima); an empty set has no keys."""
    if not len(shingles):
        return 0, []
    factors = np.random.default_rng(SEED).integers(0, 1 << 63, (2, BANDS * BAND_ROWS, 1), dtype=np.uint64)
    lows, counts = np.full(BANDS * BAND_ROWS, np.uint64(FULL)), np.zeros(64, np.int64)
    for k in range(0, len(shingles), piece):
        part = shingles[k: k + piece]
        lows = np.minimum(lows, ((part ^ factors[0]) * (factors[1] | np.uint64(1))).min(axis=1))
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = sum(1 << int(b) for b in np.flatnonzero(2 * counts > len(shingles)))
    return signed(fp), [signed(xxhash.xxh64_intdigest(lows[k * BAND_ROWS: (k + 1) * BAND_ROWS].tobytes(), k)) for k in range(BANDS)]


def sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """(number, id, high, low, fp, keys) of rows (number, id, text): the words' 128-bit digest and the sketch of the set."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t in batch.column(2).cast(pa.binary()):
                body = t.as_py() or b""
                digest = xxhash.xxh3_128_intdigest(b" ".join(body.lower().split()))
                found.append((signed(digest >> 64), signed(digest & FULL), *sketch(shingle_set(body, shingle))))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
            added = [pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *added], names=["number", "id", "high", "low", "fp", "keys"])

    long = T.LongType()
    added = [T.StructField(n, long) for n in ("high", "low", "fp")] + [T.StructField("keys", T.ArrayType(long))]
    return rows.mapInArrow(compute, T.StructType(rows.schema.fields[:2] + added))


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """The pairs (a, b) of numbers whose sets of shingles have a Jaccard similarity of ``least`` or more; ``texts`` is (number, text)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, own, mine = [], None, None
            for a, left, right in zip(batch.column(0).to_pylist(), *(batch.column(k).cast(pa.binary()) for k in (2, 3))):
                if a != own:
                    own, mine = a, shingle_set(left.as_py() or b"", shingle)
                other = shingle_set(right.as_py() or b"", shingle)
                same = len(np.intersect1d(mine, other, assume_unique=True))
                good.append(same >= least * (len(mine) + len(other) - same))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    first = texts.select(F.col("number").alias("a"), F.col("text").alias("left"))
    second = texts.select(F.col("number").alias("b"), F.col("text").alias("right"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "left", "right")
    return stage(both.mapInArrow(check, T.StructType([T.StructField(n, T.LongType()) for n in ("a", "b")])), "similar-links")


def wide_bits(shingles: np.ndarray, piece: int = 1 << 12) -> bytes:
    """SimHash of a set of shingle hashes in ``WIDE_WORDS`` words, each from hashes mixed anew."""
    counts = np.zeros(64 * WIDE_WORDS, np.int64)
    factors = np.random.default_rng(SEED + 1).integers(0, 1 << 63, (2, 1, WIDE_WORDS), dtype=np.uint64)
    for k in range(0, len(shingles), piece):
        mixed = (shingles[k: k + piece, None] ^ factors[0]) * (factors[1] | np.uint64(1))
        mixed = (mixed ^ mixed >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        counts += np.unpackbits(mixed.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(shingles), bitorder="little").tobytes()


def wide_radius(least: float) -> int:
    """Bits by which sets of a Jaccard similarity of ``least`` may differ; sets of unequal sizes differ by fewer."""
    share, bits = math.acos(2 * least / (1 + least)) / math.pi, 64 * WIDE_WORDS
    return int(bits * share + WIDE_DEVIATIONS * math.sqrt(bits * share * (1 - share)))


def set_facts(texts: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(node, size, held, wide) and (node, shingles) of rows (node, text).

    ``held`` counts the shingles of the set that another node has, too; ``wide``
    is the wide fingerprint.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py() or b"", shingle) for t in batch.column(1).cast(pa.binary())]
            ends = np.cumsum([0, *map(len, sets)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
            wide = pa.array([wide_bits(x) for x in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), wide, lists], names=["node", "size", "wide", "shingles"])

    facts = stage(texts.mapInArrow(compute, "node bigint, size bigint, wide binary, shingles array<bigint>"), "similar-sets")
    cells = facts.select("node", F.explode("shingles").alias("shingle"))
    alone = cells.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("_node")).where("n = 1")
    alone = alone.groupBy("_node").agg(F.count(F.lit(1)).alias("alone"))
    held = facts.drop("shingles").join(alone, F.col("node") == F.col("_node"), "left")
    held = stage(held.select("node", "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("held"), "wide"), "similar-facts")
    return held, facts.select("node", "shingles")


def similar_rows(mine: np.ndarray, sets: list[np.ndarray], rows: np.ndarray, least: float) -> np.ndarray:
    """Which of ``rows`` have sets of a Jaccard similarity of ``least`` or more with ``mine``; sets are sorted."""
    sizes = np.array([len(sets[r]) for r in rows.tolist()])
    cells = np.concatenate([sets[r] for r in rows.tolist()])
    place = np.minimum(np.searchsorted(mine, cells), len(mine) - 1)
    same = np.add.reduceat(mine[place] == cells, np.cumsum(sizes) - sizes)
    return same >= least * (len(mine) + sizes - same)


def compare_cells(cells: DataFrame, least: float, most: int | None) -> DataFrame:
    """(key, part, node, other, distance) of rows (key, part, asking, node, root, size, held, last_distance, last_other, wide).

    For every asking node of a cell the ``most`` nearest others; if ``most`` is
    None and the rows hold ``shingles`` as well, one other of every component to
    which the node is linked, all nodes behind its cursor being compared exactly.
    Others are of another component, within the radius, and similar enough by what
    is known exactly: two sets can't share more than either has in common with any
    other node, and have to share least / (1 + least) of both sizes.
    """
    radius, ratio = wide_radius(least), least / (1 + least) - 1e-12
    schema = "key bigint, part bigint, node bigint, other bigint, distance bigint"

    def chosen(i: np.ndarray, j: np.ndarray, distance: np.ndarray, node: np.ndarray, root: np.ndarray, sets: list) -> np.ndarray:
        """Places of the rows to put out, of candidates in order of i."""
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        ends = np.append(starts[1:], len(i))
        if most is not None:
            return np.flatnonzero(np.arange(len(i)) - np.repeat(starts, ends - starts) < most)
        found = []
        for low, high in zip(starts.tolist(), ends.tolist()):
            linked = low + np.flatnonzero(similar_rows(sets[i[low]], sets, j[low:high], least))
            found.append(linked[np.unique(root[j[linked]], return_index=True)[1]])
        return np.concatenate(found)

    def compare(rows: list[np.ndarray], sets: list) -> Iterator[pa.RecordBatch]:
        key, part, ask, node, root, size, held, last, other, wide = rows
        asks, given = np.flatnonzero(ask), np.flatnonzero(~ask)
        given = given[held[given] >= ratio * size[given]]
        asks = asks[held[asks] >= ratio * size[asks]]
        if not len(asks) or not len(given):
            return
        planes, valid = bit_planes(wide[given]), valid_lanes(len(given))
        for first in range(0, len(asks), 128):
            mine = asks[first: first + 128]
            i, j = near_lanes(planes, valid, wide[mine], radius)
            i, j = mine[i], given[j]
            fits = (root[i] != root[j]) & (np.minimum(held[i], held[j]) >= ratio * (size[i] + size[j]))
            i, j = i[fits], j[fits]
            distance = np.bitwise_count(wide[i] ^ wide[j]).sum(axis=1, dtype=np.int64)
            later = (distance > last[i]) | ((distance == last[i]) & (node[j] > other[i]))
            i, j, distance = i[later], j[later], distance[later]
            if not len(i):
                continue
            order = np.lexsort((node[j], distance, i))
            i, j, distance = i[order], j[order], distance[order]
            kept = chosen(i, j, distance, node, root, sets)
            if len(kept):
                columns = [key[i[kept]], part[i[kept]], node[i[kept]], node[j[kept]], distance[kept]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "part", "node", "other", "distance"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, bool)] + [np.zeros(0, np.int64)] * 6 + [np.zeros((0, WIDE_WORDS), np.uint64)]
        kept, sets = empty, []
        for batch in chain_end(batches):
            new = empty
            if batch is not None:
                wide = np.frombuffer(b"".join(batch.column(9).to_pylist()), np.uint64).reshape(-1, WIDE_WORDS)
                new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(9)] + [wide]
                if most is None:
                    column = batch.column(10)
                    values, ends = column.flatten().to_numpy().view(np.uint64), column.offsets.to_numpy() - column.offsets[0].as_py()
                    sets = sets + [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            rows = [np.concatenate(pair) for pair in zip(kept, new)]
            starts = np.flatnonzero(np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]) if len(rows[0]) else np.zeros(0, np.int64)
            end = len(rows[0]) if batch is None or not len(starts) else int(starts[-1])
            bounds = np.append(starts[starts < end], end).tolist()
            for low, high in zip(bounds[:-1], bounds[1:]):
                yield from compare([r[low:high] for r in rows], sets[low:high])
            kept, sets = [r[end:] for r in rows], sets[end:]

    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = ["shingles"] if most is None else []
    named = cells.select("key", "part", "asking", "node", "root", "size", "held", "last_distance", "last_other", "wide", *extra)
    return named.repartition(tasks, "key", "part").sortWithinPartitions("key", "part").mapInArrow(work, schema)


def lay_out(named: DataFrame, facts: DataFrame) -> DataFrame:
    """(key, part, asking, node): which nodes of the buckets (key, node, root) ask which.

    The nodes of a bucket's largest component only answer.  Buckets of more than
    ``BUCKET_ROWS`` nodes or ``PART_SHINGLES`` shingles are cut into parts, each
    asked by every asking node, and asking nodes are cut likewise, so that no task
    holds a bucket.
    """
    sized = named.join(facts.select("node", "size"), "node")
    sizes = sized.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    shape = sizes.groupBy(F.col("key").alias("_key")).agg(F.max(F.struct("n", "root", "size")).alias("bulk"), F.sum("n").alias("rows"), F.sum("size").alias("size"))

    def pieces(rows: Column, size: Column) -> Column:
        return F.greatest(F.ceil(rows / BUCKET_ROWS), F.ceil(size / PART_SHINGLES))

    shape = shape.select(
        "_key", F.col("bulk.root").alias("bulk"), pieces(F.col("rows"), F.col("size")).alias("parts"),
        pieces(F.col("rows") - F.col("bulk.n"), F.col("size") - F.col("bulk.size")).alias("askers"),
    )
    rows = named.join(shape, F.col("key") == F.col("_key"))

    def cut(kind: int, many: str) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(kind)), F.col(many))

    def each(many: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(many) - 1))

    part = (F.col("piece") * F.col("askers") + F.col("asker")).alias("part")
    given = rows.withColumn("piece", cut(1, "parts")).withColumn("asker", each("askers")).select("key", part, F.lit(False).alias("asking"), "node")
    asks = rows.where("root <> bulk").withColumn("asker", cut(2, "askers")).withColumn("piece", each("parts"))
    return stage(given.unionByName(asks.select("key", part, F.lit(True).alias("asking"), "node")), "similar-layout")


def with_roots(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of ``buckets`` whose bucket holds nodes of several components, with their component's root."""
    named = buckets.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    named = named.select("key", "node", "fp", F.coalesce("root", "node").alias("root"))
    mixed = named.groupBy(F.col("key").alias("_key")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("_key")
    return stage(named.join(mixed, F.col("key") == F.col("_key"), "left_semi"), "similar-open")


def similar_links(nodes: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """(node, root) of every linked node but the roots, over links of a Jaccard similarity of ``least`` or more.

    First the nodes of each bucket meet two pivots, which joins most of a group of
    near-copies at one comparison per node and pivot.  Nodes that still lie in
    different components of a bucket are then compared bit-sliced by a wider
    fingerprint, and each meets its ``CANDIDATES`` nearest ones exactly.  Where a
    node has more than that, the sets themselves go to the bucket's task, which
    compares all that is left and puts out one link per node and component.
    """
    buckets = nodes.select(F.explode("keys").alias("key"), "node", "fp")
    shared = buckets.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_key")
    buckets = stage(buckets.join(shared, F.col("key") == F.col("_key"), "left_semi"), "similar-buckets")
    # a bucket's pivots are its nodes of the smallest and the largest hash; few kinds of keys hash anew, so most buckets of a group share theirs
    order = F.struct(F.xxhash64("node", F.pmod("key", F.lit(PIVOTS))).alias("hash"), "node", "fp")
    ends = buckets.groupBy(F.col("key").alias("_key")).agg(F.array(F.min(order), F.max(order)).alias("pivots"))
    pivots = stage(ends.select("_key", F.explode("pivots").alias("pivot")), "similar-pivots")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("pivot.fp"))) <= PIVOT_RADIUS
    found = buckets.join(pivots, F.col("key") == F.col("_key")).where(near & (F.col("node") != F.col("pivot.node")))
    tested = stage(found.select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct(), "similar-pairs")
    links = verified(tested, texts, shingle, least)
    roots = stars(links)
    named = with_roots(buckets, roots)
    if named.isEmpty():
        return roots
    left = named.select(F.col("node").alias("_node")).distinct()
    open_texts = texts.join(left, F.col("number") == F.col("_node"), "left_semi").select(F.col("number").alias("node"), "text")
    facts, sets = set_facts(open_texts, shingle)
    layout = lay_out(named, facts)
    none = {c: F.lit(-1).cast("bigint") for c in ("last_distance", "last_other")}
    found = stage(compare_cells(layout.withColumns(none).join(with_root(facts, roots), "node"), least, CANDIDATES), "similar-candidates")
    pairs = found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    pairs = stage(pairs.join(tested, ["a", "b"], "left_anti"), "similar-pairs")
    links = links.unionByName(verified(pairs, texts, shingle, least))
    roots = stars(links)
    last = F.max(F.struct("distance", "other"))
    more = found.groupBy("key", "part", "node").agg(F.count(F.lit(1)).alias("n"), last.alias("last")).where(F.col("n") == CANDIDATES)
    more = stage(more.select("key", "part", "node", F.col("last.distance").alias("last_distance"), F.col("last.other").alias("last_other")), "similar-cursors")
    if more.isEmpty():
        return roots
    given = layout.where("NOT asking").join(more.select("key", "part").distinct(), ["key", "part"], "left_semi")
    cells = given.withColumns(none).unionByName(layout.where("asking").join(more, ["key", "part", "node"]))
    found = compare_cells(cells.join(with_root(facts, roots), "node").join(sets, "node"), least, None)
    found = stage(found.select(F.col("node").alias("a"), F.col("other").alias("b")), "similar-links")
    return stars(links.unionByName(found))


def with_root(facts: DataFrame, roots: DataFrame) -> DataFrame:
    """``facts`` with the root of each node's component."""
    named = facts.join(roots.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    return named.select(*facts.columns, F.coalesce("root", "node").alias("root"))


def drop_similar(docs: DataFrame, *, identity: str, text: str, shingle: int = 5, least: float = 0.8) -> DataFrame:
    """One row of every component of texts whose sets of ``shingle`` words have a Jaccard similarity of ``least`` or more.

    Words are those of :func:`group_near_copies`; texts of the same words are
    copies, also those without any, however long.  The row with the smallest id
    stays, of equal ids the first, null ids last; the other rows go.  An empty
    table gives an empty one.  Sets meet in buckets of MinHash band keys; inside
    them a wide SimHash is compared bit-sliced, and every link is checked exactly.
    """
    rows = stage(docs.select(packed(docs), F.monotonically_increasing_id().alias("number")), "similar-rows")
    own = F.col("row").getField
    texts = rows.select("number", own(text).alias("text"))
    known = stage(sketches(rows.select("number", own(identity).alias("id"), own(text).alias("text")), shingle), "similar-sketches")
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "number")
    firsts = stage(known.groupBy("high", "low").agg(F.min(rank).alias("first")).withColumnsRenamed({"high": "_high", "low": "_low"}), "similar-firsts")
    nodes = known.join(firsts.select(F.col("first.number").alias("node")), F.col("number") == F.col("node")).select("node", "fp", "keys")
    nodes = stage(nodes, "similar-nodes")
    roots = similar_links(nodes, texts, shingle, least).withColumnRenamed("node", "_node")
    rooted = firsts.join(roots, F.col("first.number") == F.col("_node"), "left")
    rooted = stage(rooted.select("_high", "_low", "first", F.coalesce("root", "first.number").alias("root")), "similar-roots")
    leads = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("first").alias("lead"))
    kept = rooted.join(leads, F.col("root") == F.col("_root")).select("_high", "_low", F.col("lead.number").alias("kept"))
    kept = stage(kept, "similar-kept")
    same = (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low"))
    gone = known.join(kept, same).where("number != kept").select(F.col("number").alias("_gone"))
    left = rows.join(gone, F.col("number") == F.col("_gone"), "left_anti")
    return left.select(*[own(c).alias(c) for c in docs.columns])


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

