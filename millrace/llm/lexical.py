"""Operator 13: ranked lexical search as an inner product of impact vectors, by buckets of equal length (LEMP)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import stage

#: Text of the items that are searched in one pass over the documents.
QUERY_BYTES = 1 << 22
#: Documents of neighbouring lengths that are pruned together.
BUCKET_ROWS = 1024
#: Longest documents that are scored first, for lower bounds of the scores that count.
SEED_ROWS = 2048
#: Coordinates of an item by which documents of a bucket are filtered.
FOCUS = 3
#: Share by which bounds are widened against rounding.
SLACK = 1e-9
#: Bytes that end a term become blanks, A-Z small letters; all bytes of other than ASCII characters belong to terms.
FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


def weight(total: int, holding: int) -> int:
    """Of a term that ``holding`` of ``total`` documents have."""
    return math.floor(1000 * math.log((2 * total + 2) / (2 * holding + 1)))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(number, doc, n, terms, tf) of rows (number, doc, text): all terms counted, those of ``vocabulary`` one by one."""
    schema = T._parse_datatype_string("number bigint, doc bigint, n bigint, terms array<int>, tf array<bigint>")
    small, long = pa.list_(pa.int32()), pa.list_(pa.int64())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts = [], [], []
            for text in batch.column(2).cast(pa.binary()):
                words = terms_of(text.as_py() or b"")
                found = Counter(map(vocabulary.get, words))
                found.pop(None, None)
                places = sorted(found)
                sizes.append(len(words))
                terms.append(places)
                counts.append([found[p] for p in places])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(terms, small), pa.array(counts, long)], names=schema.names
            )

    return docs.mapInArrow(work, schema)


def impacts(counted: DataFrame, documents: int, terms: int) -> DataFrame:
    """(number, doc, terms, impacts, square) of the documents that hold a term asked for; square is the squared length."""
    schema = T._parse_datatype_string("number bigint, doc bigint, terms array<int>, impacts array<bigint>, square bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy()
            offsets, tf = batch.column(4).offsets.to_numpy(), batch.column(4).flatten().to_numpy()
            m = 25 + (75 * n * documents) // terms
            sizes = np.diff(offsets)
            values = (1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, sizes))
            sums = np.concatenate([[0], np.cumsum(values * values)])
            bounds = (offsets - offsets[0]).astype(np.int64)
            square = sums[bounds[1:]] - sums[bounds[:-1]]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), lists, pa.array(square)], names=schema.names)

    return counted.where(F.size("terms") > 0).mapInArrow(work, schema)


class Items:
    """Weighted terms of the items: a sparse vector each."""

    def __init__(self, terms: list[np.ndarray], weights: list[np.ndarray], size: int):
        self.terms, self.weights, self.size = terms, weights, size
        self.lengths = np.array([math.sqrt(float((w.astype(np.float64) ** 2).sum())) for w in weights])

    def __len__(self) -> int:
        return len(self.terms)


class Bucket:
    """Documents of similar length: their vectors by row and, sorted by value, by coordinate."""

    def __init__(self, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray, squares: np.ndarray, vocabulary: int):
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.values = terms, values
        self.lengths = np.sqrt(squares.astype(np.float64))
        self.longest, self.shortest = self.lengths.max(), self.lengths.min()
        owner = np.repeat(np.arange(len(sizes)), sizes)
        unit = values / self.lengths[owner]
        order = np.lexsort((unit, terms))
        self.owner, self.unit = owner[order], unit[order]
        self.starts = np.searchsorted(terms[order], np.arange(vocabulary + 1))

    def candidates(self, terms: np.ndarray, weights: np.ndarray, length: float, floor: int) -> np.ndarray:
        """Rows that may score ``floor`` or more.

        Cauchy-Schwarz: a row of length l needs a cosine of floor / (length * l)
        at least.  Unit vectors of that cosine t to the item differ little in
        each coordinate: from q the coordinate lies within q t -+ sqrt((1 - q^2)(1 - t^2)).
        t is taken for the longest row, so every row is judged mildly.
        """
        rows = len(self.lengths)
        t = floor / (length * self.longest) * (1 - SLACK)
        if t > 1:
            return np.zeros(0, np.int64)
        if t <= 0:
            return np.arange(rows)
        chosen, asked = np.ones(rows, bool), weights / length
        for k in np.argsort(-asked)[:FOCUS].tolist():
            spread = math.sqrt((1 - asked[k] ** 2 if asked[k] < 1 else 0.0) * (1 - t * t))
            low, high = asked[k] * t - spread - SLACK, asked[k] * t + spread + SLACK
            if asked[k] > t:
                high = 1.0  # the largest cosine lies inside, where the other coordinates vanish
            if low <= 0 and high >= 1:
                continue
            first, behind = self.starts[terms[k]], self.starts[terms[k] + 1]
            span = self.unit[first:behind]
            inside = np.zeros(rows, bool) if low > 0 else np.ones(rows, bool)
            if low <= 0:
                inside[self.owner[first:behind]] = False  # rows without the term stay at 0
            inside[self.owner[first + np.searchsorted(span, low): first + np.searchsorted(span, high, side="right")]] = True
            chosen &= inside
        return np.flatnonzero(chosen & (self.lengths * length * (1 + SLACK) >= floor))

    def scores(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """Exact inner products of ``rows`` with an item whose weights ``dense`` holds by term."""
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(self.bounds[rows] - (ends - sizes), sizes)
        products = self.values[places] * dense[self.terms[places]]
        return np.add.reduceat(products, ends - sizes)


class Best:
    """The ``size`` best rows of one item so far: higher scores first, then smaller ids, null last, then numbers."""

    def __init__(self, size: int, floor: int):
        self.size, self.floor, self.rows = size, floor, []

    def add(self, scores: list[int], docs: list[int | None], numbers: list[int]) -> None:
        rows = self.rows + [(-s, d is None, d or 0, n) for s, d, n in zip(scores, docs, numbers)]
        self.rows = sorted(rows)[: self.size]
        if len(self.rows) == self.size:
            self.floor = max(self.floor, -self.rows[-1][0])


def search(vectors: DataFrame, items: Items, floors: list[int], best: int) -> DataFrame:
    """(item, score, doc, number): the ``best`` rows of every task for every item, no row below its floor.

    Rows come in falling order of length; ``BUCKET_ROWS`` of them are pruned
    together, and floors rise as better rows are found.  Equal scores are never pruned.
    """
    schema = T._parse_datatype_string("item int, score bigint, doc bigint, number bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [Best(best, max(1, f)) for f in floors]
        for batch in batches:
            for first in range(0, batch.num_rows, BUCKET_ROWS):
                part = batch.slice(first, BUCKET_ROWS)
                sizes = np.diff(part.column(2).offsets.to_numpy())
                bucket = Bucket(
                    sizes, part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy(), part.column(4).to_numpy(), items.size
                )
                docs, numbers = part.column(1), part.column(0).to_numpy()
                dense = np.zeros(items.size, np.int64)
                for k in np.flatnonzero(items.lengths * bucket.longest * (1 + SLACK) >= [b.floor for b in kept]).tolist():
                    rows = bucket.candidates(items.terms[k], items.weights[k], items.lengths[k], kept[k].floor)
                    if not len(rows):
                        continue
                    dense[items.terms[k]] = items.weights[k]
                    scores = bucket.scores(rows, dense)
                    dense[items.terms[k]] = 0
                    good = scores >= kept[k].floor
                    if good.sum() > best:
                        # all that tie with the last of the best stay
                        good &= scores >= np.partition(scores[good], -best)[-best]
                    if good.any():
                        chosen = rows[good]
                        kept[k].add(scores[good].tolist(), docs.take(pa.array(chosen)).to_pylist(), numbers[chosen].tolist())
        rows = [(k, -r[0], None if r[1] else r[2], r[3]) for k, b in enumerate(kept) for r in b.rows]
        if rows:
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.select("number", "doc", "terms", "impacts", "square").mapInArrow(work, schema)


def rank_block(rows: DataFrame, asked: list[tuple[int, bytes]], best: int) -> DataFrame:
    """(place, rank, doc, score) for the items ``asked`` as (place, text), over rows (number, doc, text)."""
    spark = rows.sparkSession
    words = [Counter(terms_of(text)) for _, text in asked]
    vocabulary = {w: k for k, w in enumerate(sorted(set().union(*words)))}
    counted = stage(count_terms(rows, vocabulary), "search-counts")
    facts = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    documents, terms = facts[0], facts[1] or 0
    held = np.zeros(len(vocabulary), np.int64)
    if terms:
        # one row per term asked for
        for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            held[row["term"]] = row["count"]
    weights = [weight(documents, int(n)) for n in held]
    places = [np.array(sorted(vocabulary[w] for w in ws), np.int64) for ws in words]
    names = list(vocabulary)
    items = Items(places, [np.array([weights[p] * ws[names[p]] for p in ps.tolist()], np.int64) for ps, ws in zip(places, words)], len(vocabulary))
    dealt = impacts(counted, documents, max(terms, 1)).repartitionByRange(F.desc("square"), F.col("number"))
    ordered = stage(dealt.sortWithinPartitions(F.desc("square"), F.col("number")), "search-vectors")
    seeds = ordered.orderBy(F.desc("square"), F.col("number")).limit(SEED_ROWS)
    found = search(seeds, items, [1] * len(items), best).groupBy("item").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n"))
    floors = [1] * len(items)
    for row in found.where(F.col("n") == best).collect():
        floors[row["item"]] = row["floor"]
    local = search(ordered, items, floors, best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc").asc_nulls_last(), F.col("number"))
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    numbered = spark.createDataFrame([(k, place) for k, (place, _) in enumerate(asked)], "_item int, place bigint")
    return ranked.join(numbered, F.col("item") == F.col("_item")).select("place", "rank", "doc", "score")


def search_documents(
    docs: DataFrame, items: DataFrame, *, identity: Column, text: Column, item: Column, item_text: Column, best: int = 10
) -> DataFrame:
    """(item, rank, doc, score): the ``best`` documents of every item with a score above 0.

    Terms are runs of ASCII letters, digits and other than ASCII characters, A-Z
    lower-cased, over whole texts; the score is a sum of whole numbers (weight of
    a term by its rarity, times its impact in a document by its count and the
    document's length).  Equal scores rank by id, null ids last, then by row.

    Both sides are vectors over the items' terms, and the score is their inner
    product.  Documents are range partitioned by the length of their vector;
    the longest ones give every item a first bound.  Buckets of similar length
    are left out as a whole where the product of lengths is too small, rows in
    them by single coordinates, and all that remain are scored exactly.  Only
    ``best`` rows per task and item are exchanged.

    Items are taken in blocks of about ``QUERY_BYTES`` of text, each one pass
    over the documents; a block's terms, their counts and bounds are all that the
    driver and the tasks hold.  Null or termless texts match nothing and aren't
    counted as documents; repeated rows are documents, or items, of their own.
    Without documents or items the result is empty.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("number"), identity.cast("bigint").alias("doc"), text.alias("text"))
    asked = items.select(item.alias("item"), F.coalesce(item_text, F.lit("")).cast("binary").alias("text"))
    asked = stage(asked.withColumn("place", F.monotonically_increasing_id()), "search-items")
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + total // QUERY_BYTES
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == block).select("place", "text").orderBy("place").collect()
        mine = [(r["place"], bytes(r["text"])) for r in mine]
        mine = [m for m in mine if terms_of(m[1])]
        if mine:
            ranked = rank_block(rows, mine, best)
            found = ranked if found is None else found.unionByName(ranked)
    if found is None:
        empty = asked.limit(0).select("item", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc"), F.lit(0).cast("bigint").alias("score"))
        return empty
    names = asked.select("item", F.col("place").alias("_place"))
    return found.join(names, F.col("place") == F.col("_place")).select("item", "rank", "doc", "score")
