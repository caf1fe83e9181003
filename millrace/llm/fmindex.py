"""Operator 10: benchmark decontamination with an FM-index per training shard."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import TaskFile, open_folder
from millrace.scratch import stage, work_dir

#: A-Z to a-z; bytes that are no part of a word to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
WINDOW = 10
#: Words per index; a longer document is indexed in pieces that overlap.
SHARD_WORDS = 1 << 20
SAMPLE = 16
#: Bytes of benchmark text per block of phrases.
PHRASE_BYTES = 16 << 20
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes, the same throughout a process."""
    return np.fromiter(map(hash, words), np.int64, len(words))


# --- the index ---------------------------------------------------------------


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = (np.cumsum(counts) - counts).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, inside = at >> 6, (at & 63).astype(np.uint64)
        low = self.words[word] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.before[word] + np.bitwise_count(low)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletTree:
    """Ranks of symbols in a sequence, one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels, self.zeros = [], []
        self.bits = max(1, int(size - 1).bit_length())
        for k in reversed(range(self.bits)):
            ones = (symbols >> k & 1).astype(bool)
            self.levels.append(Bits(ones))
            self.zeros.append(int(len(ones) - np.count_nonzero(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``low`` and before ``high``."""
        start = np.zeros(len(symbol), np.int64)
        for k, level, zeros in zip(reversed(range(self.bits)), self.levels, self.zeros):
            one = (symbol >> k & 1).astype(bool)
            a, b, c = level.rank(start), level.rank(low), level.rank(high)
            start, low, high = (np.where(one, zeros + r, p - r) for p, r in ((start, a), (low, b), (high, c)))
        return low - start, high - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol, its occurrences before the place)."""
        symbol, start = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one = level.get(at)
            a, r = level.rank(start), level.rank(at)
            start, at = np.where(one, zeros + a, start - a), np.where(one, zeros + r, at - r)
            symbol = symbol << 1 | one
        return symbol, at - start


def suffix_array(ranks: np.ndarray, width: int) -> np.ndarray:
    """Sorted suffixes of a text that ends in a symbol of its own; ``width`` bits per symbol.

    The first sort takes as many symbols as fit into 63 bits; then only groups
    of equal beginnings are sorted by the rank behind, at doubling distance.
    """
    n, taken = len(ranks), 63 // width
    key = np.zeros(n, np.int64)
    for k in range(min(taken, n)):
        key <<= width
        key[: n - k] |= ranks[k:]
    order = np.argsort(key)
    rank, slots = np.empty(n, np.int64), np.arange(n)
    position, key = order, key[order]
    while True:
        new = np.r_[True, key[1:] != key[:-1]]
        rank[position] = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        tied = ~(new & np.r_[new[1:], True])
        slots = slots[tied]
        if not len(slots):
            return order
        position = order[slots]
        key = rank[position] << 32 | rank[np.minimum(position + taken, n - 1)]
        inside = np.argsort(key)
        position, key = position[inside], key[inside]
        order[slots] = position
        taken *= 2


class FMIndex:
    """Backward search and location over the words of several documents.

    The documents are joined with separators, each smaller than all words and
    ordered by place, so that no phrase crosses one.  Text positions divisible
    by ``SAMPLE`` and those at a document's start are sampled.
    """

    def __init__(self, docs: list[np.ndarray]):
        lengths = np.array([len(d) for d in docs], np.int64)
        self.ends = np.cumsum(lengths + 1)
        words = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        self.alphabet, codes = np.unique(words, return_inverse=True)
        n, seps = len(words) + len(docs), len(docs)
        text = np.zeros(n, np.int64)
        is_word = np.ones(n, bool)
        is_word[self.ends - 1] = False
        text[is_word] = codes + 1
        ranks = text + (seps - 1)
        ranks[self.ends - 1] = np.arange(seps)
        order = suffix_array(ranks, int(len(self.alphabet) + seps).bit_length())
        before = text[order - 1]
        self.size = n
        counts = np.bincount(text, minlength=len(self.alphabet) + 1)
        self.first = np.cumsum(counts) - counts
        self.tree = WaveletTree(before.astype(np.int32), len(self.alphabet) + 1)
        sampled = (order % SAMPLE == 0) | (before == 0)
        self.sampled, self.places = Bits(sampled), order[sampled].astype(np.int32)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of word hashes, 0 for words that the text doesn't have."""
        if not len(self.alphabet):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == hashes, at + 1, 0)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, row behind the last) of the phrases that occur; a phrase fills its line from the left."""
        symbols = self.symbols(phrases.ravel()).reshape(phrases.shape)
        inside = np.arange(phrases.shape[1])[None, :] < lengths[:, None]
        which = np.flatnonzero(((symbols > 0) | ~inside).all(axis=1) & (lengths > 0))
        low, high = np.zeros(len(which), np.int64), np.full(len(which), self.size, np.int64)
        step = 0
        found = [(which[:0], low[:0], high[:0])]
        while len(which):
            symbol = symbols[which, lengths[which] - 1 - step]
            a, b = self.tree.rank(symbol, low, high)
            low, high = self.first[symbol] + a, self.first[symbol] + b
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
            step += 1
            done = lengths[which] == step
            found.append((which[done], low[done], high[done]))
            which, low, high = which[~done], low[~done], high[~done]
        return tuple(np.concatenate(c) for c in zip(*found))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: steps back to the next sampled one."""
        place, open_rows, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows, 0
        while len(open_rows):
            done = self.sampled.get(at)
            place[open_rows[done]] = self.places[self.sampled.rank(at[done])] + steps
            open_rows, at = open_rows[~done], at[~done]
            symbol, rank = self.tree.access(at)
            at, steps = self.first[symbol] + rank, steps + 1
        return place


# --- phrases -----------------------------------------------------------------


class Phrases:
    """A block of test windows: word hashes, lengths and the items that have each window; items without an id add windows only."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int):
        owners: dict[tuple, set] = {}
        for item, text in items:
            words = tuple(word_hashes(text_words(text)).tolist())
            for k in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(words[k: k + window], set()).add(item)
        self.items = [sorted(s - {None}) for s in owners.values()]
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.words = np.zeros((len(owners), window), np.int64)
        for k, w in enumerate(owners):
            self.words[k, : len(w)] = w


def store_phrases(benchmark: DataFrame, identity: Column, text: Column, folder: str) -> list[str]:
    """Write the test items as block files of about ``PHRASE_BYTES`` each; returns their names.

    Tasks write the blocks, and later tasks read them one at a time; the items
    are never held together.  A file that isn't named belongs to a lost attempt.
    """
    schema = pa.schema([("id", pa.string()), ("text", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def block() -> pa.RecordBatch:
            out = TaskFile(folder, ".arrow")
            with pa.ipc.new_stream(out.stream, schema) as writer:
                writer.write_table(pa.Table.from_batches(held, schema))
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([out.name])], names=["name"])

        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                held.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.slice(first, 1000).columns, schema)], schema=schema))
                size += held[-1].nbytes
                if size >= PHRASE_BYTES:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    chosen = benchmark.select(identity.cast("string").alias("id"), text.cast("binary").alias("text")).where("text IS NOT NULL")
    # small partitions are put together, so that blocks are few
    named = stage(chosen.hint("rebalance").mapInArrow(write, "name string"), "phrase-blocks")
    return [r["name"] for r in named.collect()]


def read_phrases(folder: str, name: str, window: int) -> Phrases:
    files, root = open_folder(folder)
    with files.open_input_stream(f"{root}/{name}") as stream, pa.ipc.open_stream(stream) as reader:
        table = reader.read_all()
    return Phrases(list(zip(table["id"].to_pylist(), table["text"].to_pylist())), window)


def search_shard(docs: list[np.ndarray], blocks: Iterator[Phrases]) -> list[tuple[np.ndarray, set]]:
    """(hit mask, items) of every document, from one index over them all."""
    index = FMIndex(docs)
    change, items = np.zeros(index.size + 1, np.int64), [set() for _ in docs]
    for phrases in blocks:
        which, low, high = index.search(phrases.words, phrases.lengths)
        owner = np.repeat(np.arange(len(which)), high - low)
        rows = np.arange(len(owner)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[owner]
        phrase, place = which[owner], index.locate(rows)
        np.add.at(change, place, 1)
        np.add.at(change, place + phrases.lengths[phrase], -1)
        doc = np.searchsorted(index.ends, place, side="right")
        for d, p in np.unique(np.stack([doc, phrase]), axis=1).T.tolist():
            items[d].update(phrases.items[p])
    hit = np.cumsum(change[:-1]) > 0
    starts = index.ends - np.array([len(d) + 1 for d in docs], np.int64)
    return [(hit[s: s + len(d)], i) for s, d, i in zip(starts.tolist(), docs, items)]


def search_documents(texts: list[list[bytes]], load, window: int) -> list[tuple[int, np.ndarray, list[str]]]:
    """(words, hit places, sorted items) of every document; one longer than a shard is searched in pieces."""
    hashes = [word_hashes(w) for w in texts]
    pieces, owner, offset = [], [], []
    for k, h in enumerate(hashes):
        for first in range(0, max(1, len(h) - window + 1), SHARD_WORDS - window + 1):
            pieces.append(h[first: first + SHARD_WORDS])
            owner.append(k)
            offset.append(first)
    masks, items = [np.zeros(len(h), bool) for h in hashes], [set() for _ in hashes]
    first = 0
    while first < len(pieces):
        last, size = first, 0
        while last < len(pieces) and (last == first or size + len(pieces[last]) + 1 <= SHARD_WORDS):
            size += len(pieces[last]) + 1
            last += 1
        for k, (hit, found) in zip(range(first, last), search_shard(pieces[first:last], load())):
            masks[owner[k]][offset[k]: offset[k] + len(hit)] |= hit
            items[owner[k]] |= found
        first = last
    return [(len(h), np.flatnonzero(m), sorted(i)) for h, m, i in zip(hashes, masks, items)]


def word_spans(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring places as (first, behind the last)."""
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.r_[0, breaks + 1]].tolist(), (places[np.r_[breaks, len(places) - 1]] + 1).tolist()))


def cut_words(text: bytes, places: np.ndarray) -> bytes:
    """The text without the words at these places and what lies between neighbouring ones."""
    bounds = [m.span() for m in WORD.finditer(text)]
    kept, at = [], 0
    for first, behind in word_spans(places):
        kept.append(text[at: bounds[first][0]])
        at = bounds[behind - 1][1]
    return b"".join(kept) + text[at:]


def scan(docs: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str, window: int, carried: list[str], added, make) -> DataFrame:
    """``own``, a struct of the ``carried`` columns, and what ``make(text, words, places, items)`` adds, one row per document.

    A task gathers documents up to ``SHARD_WORDS`` words, builds their index and
    searches every block of phrases in it; nothing is exchanged.
    """
    folder = work_dir(docs.sparkSession, "phrases")
    names = store_phrases(benchmark, F.col(f"`{item}`"), F.col(f"`{item_text}`"), folder)
    # carried columns travel as one, so that no name of theirs can clash; a row without any carries a mark
    own = F.struct(*[F.col(f"`{c}`") for c in carried] or [F.lit(0).alias("none")])
    chosen = docs.select(own.alias("own"), F.col(f"`{text}`").cast("binary").alias("text"))
    schema = T.StructType(chosen.schema.fields[:-1] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [read_phrases(folder, n, window) for n in names] if len(names) == 1 else None

        def load() -> Iterator[Phrases]:
            return iter(kept) if kept else (read_phrases(folder, n, window) for n in names)

        for batch in batches:
            column, first, words, size = batch.column(batch.num_columns - 1), 0, [], 0
            for k in range(batch.num_rows + 1):
                if k == batch.num_rows or size >= SHARD_WORDS:
                    if words:
                        yield out(batch.slice(first, len(words)), search_documents(words, load, window))
                    first, words, size = k, [], 0
                if k < batch.num_rows:
                    words.append(text_words(column[k].as_py() or b""))
                    size += len(words[-1]) + 1

    def out(rows: pa.RecordBatch, found: list) -> pa.RecordBatch:
        texts = rows.column(rows.num_columns - 1)
        made = [make(t, *f) for t, f in zip(texts, found)]
        columns = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(added_kinds)]
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], *columns], names=schema.names)

    arrow = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_(), T.BinaryType(): pa.binary()}
    spans = pa.list_(pa.struct([("begins", pa.int64()), ("ends", pa.int64())]))
    added_kinds = [arrow.get(f.dataType, spans if "spans" in f.name else pa.list_(pa.string())) for f in added]
    return chosen.mapInArrow(run, schema)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, *, identity: str, text: str, item: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """(identity, n_words, n_hit, n_items, items_sha256, contaminated, items, spans) of every row of ``docs``.

    Words are runs of ASCII letters, digits and other than ASCII characters, A-Z
    lower-cased.  Windows are ``window`` consecutive words of an item, or the
    whole of a shorter one; ``spans`` are the merged runs of words inside any
    occurrence.  Null or wordless texts have no words and no hits.  Items
    without text or words have no windows; the windows of an item without an id
    hit like any other, but it is not among the items.  Rows that repeat an item
    add windows to it.  Without items nothing is hit; items_sha256 is then that of
    the empty text.  Every row is judged, also repeated ones.
    """
    pair = T.StructType([T.StructField("begins", T.LongType()), T.StructField("ends", T.LongType())])
    long = T.LongType()
    added = T.StructType([
        T.StructField("n_words", long), T.StructField("n_hit", long), T.StructField("n_items", long), T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(pair)),
    ])

    def make(_, n_words, places, items):
        spans = [{"begins": a, "ends": b} for a, b in word_spans(places)]
        return n_words, len(places), len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), len(places) > 0, items, spans

    found = scan(docs, text, benchmark, item, item_text, window, [identity], added, make)
    return found.select(F.col("own").getField(identity).alias(identity), *added.names)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, text: str, item: str = "item_id", item_text: str = "text", window: int = WINDOW
) -> DataFrame:
    """``docs`` with all spans of test windows cut out of ``text``; rows of which no word is left are dropped.

    Rows without a hit stay as they are, also wordless ones.
    """
    added = T.StructType([T.StructField("cut", T.BinaryType()), T.StructField("gone", T.BooleanType())])

    def make(original, n_words, places, _):
        body = original.as_py()
        return (cut_words(body, places) if len(places) else body), len(places) == n_words > 0

    carried = [c for c in docs.columns if c != text]
    found = scan(docs, text, benchmark, item, item_text, window, carried, added, make).where("NOT gone")
    return found.select(*[F.col("cut").cast("string").alias(c) if c == text else F.col("own").getField(c).alias(c) for c in docs.columns])
