"""Operator 8: token ids in files of interleaved rANS blocks with shared frequency tables."""

from __future__ import annotations

import json
import math
import re
import struct
import sys
import types
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import TaskFile, open_folder
from millrace.scratch import stage, work_dir

BITS = 20
LOW = 1 << 31
FILE_MAGIC, BLOCK_MAGIC, END_MAGIC = b"MILLRNS1", b"RNSB", b"RNSE"
#: documents, ids, lanes, words, crc32 of the ids, first id's place in the file
BLOCK_HEAD = "<4sIIIIIQ"
#: offset and bytes of the block, its documents and ids
CHECKPOINT = "<QQII"
END = "<III4s"
BLOCK_IDS = 1 << 18
LANES = 1024
#: Blocks that one task decodes, about.
BLOCKS_PER_TASK = 16

MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("file", T.StringType()),
    T.StructField("at", T.LongType()), T.StructField("bytes", T.LongType()), T.StructField("docs", T.LongType()),
    T.StructField("ids", T.LongType()),
])


# --- the coder ---------------------------------------------------------------


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2**BITS, at least 1 for every symbol that occurs."""
    counts = counts.astype(np.float64)
    total = counts.sum()
    if not total:
        return np.zeros(len(counts), np.uint32)
    size = 1 << BITS
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts * (size / total))), 0).astype(np.int64)
    excess = int(freq.sum()) - size
    for symbol in np.argsort(-freq, kind="stable"):
        if excess <= 0:
            break
        cut = min(excess, int(freq[symbol]) - 1)
        freq[symbol] -= cut
        excess -= cut
    freq[np.argmax(freq)] -= excess
    return freq.astype(np.uint32)


def coder_tables(freq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Frequencies and cumulative starts as 64-bit numbers, and the symbol of every slot."""
    wide = freq.astype(np.uint64)
    return wide, np.cumsum(wide) - wide, np.repeat(np.arange(len(freq), dtype=np.uint32), freq)


def lanes_for(count: int) -> int:
    return min(LANES, max(1, 1 << max(0, (count // 64).bit_length() - 1)))


def encode_ids(ids: np.ndarray, tables, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """(states, words): id i goes to lane i modulo ``lanes``; the decoder reads the words forwards."""
    freq, start, _ = tables
    state, out = np.full(lanes, LOW, np.uint64), []
    shift, mask = np.uint64(BITS), np.uint64(0xFFFFFFFF)
    for first in range((len(ids) - 1) // lanes * lanes, -1, -lanes):
        symbols = ids[first: first + lanes]
        f, c, x = freq[symbols], start[symbols], state[: len(symbols)]
        full = x >= f << np.uint64(63 - BITS)
        if full.any():
            out.append((x[full] & mask).astype(np.uint32))
            x = np.where(full, x >> np.uint64(32), x)
        high, rest = np.divmod(x, f)
        state[: len(symbols)] = (high << shift) + rest + c
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    return state, words


def decode_ids(state: np.ndarray, words: np.ndarray, count: int, tables) -> np.ndarray:
    freq, start, symbol_of = tables
    lanes, state, ids, at = len(state), state.copy(), np.empty(count, np.uint32), 0
    shift, mask = np.uint64(BITS), np.uint64((1 << BITS) - 1)
    for first in range(0, count, lanes):
        x = state[: min(lanes, count - first)]
        slot = x & mask
        symbols = symbol_of[slot]
        ids[first: first + lanes] = symbols
        x = freq[symbols] * (x >> shift) + slot - start[symbols]
        empty = np.flatnonzero(x < np.uint64(LOW))
        x[empty] = x[empty] << np.uint64(32) | words[at: at + len(empty)]
        at += len(empty)
        state[: len(x)] = x
    if at != len(words) or (state != np.uint64(LOW)).any():
        raise ValueError("block doesn't end in its first states")
    return ids


def pack_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, first: int, tables) -> bytes:
    """One independent block: head, documents, lane states, words."""
    lanes = lanes_for(len(ids))
    state, words = encode_ids(ids, tables, lanes)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    names = np.array([d or 0 for d in doc_ids], "<i8")
    head = struct.pack(BLOCK_HEAD, BLOCK_MAGIC, len(doc_ids), len(ids), lanes, len(words), zlib.crc32(ids.astype("<u4").tobytes()), first)
    return b"".join([
        head, known.tobytes(), names.tobytes(), np.array(lengths, "<u4").tobytes(), state.astype("<u8").tobytes(), words.astype("<u4").tobytes()
    ])


def unpack_block(data: bytes, tables) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """(doc ids, lengths, ids, first id's place in the file); checks the ids against their checksum."""
    magic, docs, count, lanes, n_words, crc, first = struct.unpack_from(BLOCK_HEAD, data)
    if magic != BLOCK_MAGIC:
        raise ValueError("not a block")
    at, fields = struct.calcsize(BLOCK_HEAD), []
    for kind, n in (("u1", docs), ("<i8", docs), ("<u4", docs), ("<u8", lanes), ("<u4", n_words)):
        fields.append(np.frombuffer(data, kind, n, at))
        at += fields[-1].nbytes
    known, names, lengths, state, words = fields
    ids = decode_ids(state.astype(np.uint64), words, count, tables)
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("block is damaged")
    return [int(d) if k else None for k, d in zip(known, names)], lengths, ids, first


# --- tokens ------------------------------------------------------------------


class WordTokens:
    """Token ids of texts by a tokenizer that splits at white space, contractions, digits and other signs.

    Every distinct run of letters (or signs) goes through the tokenizer's model
    once; runs and words are then kept, up to ``limit`` of each.  Words beyond
    plain Latin, not in composed form, or with special tokens take the whole
    tokenizer.  The ids are those of the whole text.

    A file with other rules than ``RULES`` encodes every text as a whole.
    """

    # fixed values: the rules of the file under which words may be encoded one by one
    RULES = {
        "normalizer": {"type": "Sequence", "normalizers": [
            {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
        ]},
        "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    }

    # fixed values: the tokenizer's split, written out for plain Latin text
    LETTERS, DIGITS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
    SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^{LETTERS}{DIGITS}]+"
    PLAIN = "[!-~¡-¬®-įı-ɏ]+"

    def __init__(self, path: str, limit: int = 600_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        rules = json.loads(self.tokenizer.to_str())
        self.by_word = all(rules.get(k) == v for k, v in self.RULES.items()) and rules["model"]["type"] == "BPE"
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.model, self.runs = self.tokenizer.model, {}
        self.code = "H" if self.kind == "<u2" else "I"
        self.cut, self.plain = re.compile(self.SPLIT).findall, re.compile(self.PLAIN).fullmatch
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added) or "(?!)").search
        # the byte-level alphabet: printable Latin bytes stand for themselves, the others follow from 256 on
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.signs = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)}
        tokens = self

        class Words(dict):
            def __missing__(self, word: bytes) -> bytes:
                found = tokens.word_ids(word.decode())
                if len(self) < tokens.limit:
                    self[word] = found
                return found

        self.words = Words()

    def packed(self, ids: list[int]) -> bytes:
        found = array(self.code, ids)
        if sys.byteorder == "big":
            found.byteswap()
        return found.tobytes()

    def word_ids(self, word: str) -> bytes:
        composed = word.isascii() or unicodedata.is_normalized("NFC", word)
        if not composed or not self.plain(word) or self.special(word):
            return self.packed(self.tokenizer.encode(word, add_special_tokens=False).ids)
        known, lower = self.runs.get, word.lower()
        if lower.isalpha():
            return known(lower) or self.run_ids(lower)
        return b"".join([known(run) or self.run_ids(run) for run in self.cut(lower)])

    def run_ids(self, run: str) -> bytes:
        signs = run if run.isascii() else "".join([self.signs[b] for b in run.encode()])
        found = self.packed([t.id for t in self.model.tokenize(signs)])
        if len(self.runs) < self.limit:
            self.runs[run] = found
        return found

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The texts' ids as little-endian numbers of ``kind``."""
        if not self.by_word:
            return [self.packed(self.tokenizer.encode(t.decode(), add_special_tokens=False).ids) for t in texts]
        get = self.words.__getitem__
        return [b"".join(map(get, t.split())) for t in texts]


def worker_tokens(path: str) -> WordTokens:
    """The worker process's own tokenizer, kept from task to task."""
    shelf = sys.modules.setdefault("_millrace_worker", types.ModuleType("_millrace_worker"))
    if getattr(shelf, "path", None) != path:
        shelf.path, shelf.tokens = path, WordTokens(path)
    return shelf.tokens


def token_blocks(docs: DataFrame, identity: Column, text: Column, tokenizer: str, end_id: int, block_ids: int) -> DataFrame:
    """Stored (part, block, names, lengths, ids): compressed ids of whole documents in ascending order of the id.

    The texts are exchanged once, by range; every text is encoded once.
    """
    kinds = {"part": pa.int32(), "block": pa.int32(), "names": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "ids": pa.binary()}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, packer = worker_tokens(tokenizer), TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3)
        end, width = np.array([end_id], tokens.kind).tobytes(), np.dtype(tokens.kind).itemsize
        names, found, size, count = [], [], 0, 0

        def block() -> pa.RecordBatch:
            row = [part, count, names, [len(f) // width for f in found], packer.compress(b"".join(found))]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds.values())], names=list(kinds))

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for name, body in zip(ids, texts):
                piece = tokens.encode([body.as_py() or b""])[0] + end
                if size and size + len(piece) // width > block_ids:
                    yield block()
                    names, found, size, count = [], [], 0, count + 1
                names.append(name)
                found.append(piece)
                size += len(piece) // width
        if found:
            yield block()

    long = T.LongType()
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("names", T.ArrayType(long)),
        T.StructField("lengths", T.ArrayType(long)), T.StructField("ids", T.BinaryType()),
    ])
    chosen = docs.select(identity.cast("bigint").alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("at"))
    ordered = chosen.repartitionByRange("id", "at").sortWithinPartitions("id", "at").select("id", "text")
    return stage(ordered.mapInArrow(encode, schema), "token-blocks")


def id_width(tokenizer: str) -> str:
    return WordTokens(tokenizer).kind


def count_ids(blocks: DataFrame, kind: str) -> np.ndarray:
    """How often every id occurs in the whole corpus; one sum per task and id is exchanged."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, counts = zstandard.ZstdDecompressor(), np.zeros(0, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                more = np.bincount(np.frombuffer(unpacker.decompress(packed.as_py()), kind))
                if len(more) < len(counts):
                    more, counts = counts, more
                more[: len(counts)] += counts
                counts = more
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(counts[used].astype(np.int64))], names=["id", "n"])

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])
    found = blocks.select("ids").mapInArrow(count, schema).groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    # one row per id of the vocabulary at most
    counts = np.zeros(int(max(found["id"].to_pylist(), default=0)) + 1, np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    return counts


# --- files -------------------------------------------------------------------


def write_tokens(
    docs: DataFrame, folder: str, *, identity: Column, text: Column, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Write every text's ids and ``end_id`` below ``folder`` in ascending order of the id; returns the stored manifest.

    Null ids come first, null texts have the end id alone, repeated rows are
    written each.  The frequency table counts the whole corpus and is shared by
    all files.  Blocks hold whole documents, about ``block_ids`` ids (a longer
    document has its own); a file holds a run of neighbouring blocks.  Its footer
    and the manifest are the checkpoints at which decoding can start.  Files that
    the manifest doesn't name belong to lost attempts.
    """
    kind = id_width(tokenizer)
    blocks = token_blocks(docs, identity, text, tokenizer, end_id, block_ids)
    freq = scaled_frequencies(count_ids(blocks, kind))
    files, root = open_folder(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/frequencies", compression=None) as out:
        out.write(freq.astype("<u4").tobytes())
    check = zlib.crc32(freq.astype("<u4").tobytes())

    def finish(out: TaskFile, rows: list[tuple]) -> pa.RecordBatch:
        points = b"".join(struct.pack(CHECKPOINT, r[3], r[4], r[5], r[6]) for r in rows)
        out.write(points + struct.pack(END, len(rows), BITS, check, END_MAGIC))
        out.close()
        kinds = [pa.int32(), pa.int32(), pa.string()] + [pa.int64()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=MANIFEST.names)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, unpacker, out, rows, place = coder_tables(freq), zstandard.ZstdDecompressor(), None, [], 0
        for batch in batches:
            for part, block, names, lengths, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if out is not None and (part, block) != (rows[-1][0], rows[-1][1] + 1):
                    yield finish(out, rows)
                    out = None
                if out is None:
                    out, rows, place = TaskFile(folder, ".rans"), [], 0
                    out.write(FILE_MAGIC + struct.pack("<II", BITS, check))
                ids = np.frombuffer(unpacker.decompress(packed), kind)
                data = pack_block(names, lengths, ids, place, tables)
                rows.append((part, block, out.name, out.write(data), len(data), len(names), len(ids)))
                place += len(ids)
        if out is not None:
            yield finish(out, rows)

    return stage(blocks.mapInArrow(write, MANIFEST), "rans-manifest")


def read_checkpoints(stream, size: int) -> list[tuple[int, int, int, int]]:
    """(offset, bytes, documents, ids) of every block, from the file's end."""
    stream.seek(size - struct.calcsize(END))
    blocks, bits, _, magic = struct.unpack(END, stream.read(struct.calcsize(END)))
    if magic != END_MAGIC or bits != BITS:
        raise ValueError("no footer")
    stream.seek(size - struct.calcsize(END) - blocks * struct.calcsize(CHECKPOINT))
    return list(struct.iter_unpack(CHECKPOINT, stream.read(blocks * struct.calcsize(CHECKPOINT))))


def block_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: how many ids all earlier blocks hold.

    Sums per file meet in one task, blocks only with those of their file.
    """
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("n"))
    parts = parts.select(F.col("part").alias("_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("inside", F.coalesce(F.sum("ids").over(inside), F.lit(0)))
    return placed.join(parts, F.col("part") == F.col("_part")).withColumn("start", F.col("inside") + F.col("before")).drop("_part", "inside", "before")


def read_tokens(manifest: DataFrame, folder: str, *, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, decoded block by block in parallel.

    ``ids`` are little-endian 32-bit numbers.
    """
    schema = [("doc_id", T.LongType()), ("start", T.LongType()), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(n, k) for n, k in schema[: 5 if with_ids else 4]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        tables = None
        for batch in batches:
            for row in batch.to_pylist():
                if tables is None:
                    with files.open_input_stream(f"{root}/frequencies") as stream:
                        tables = coder_tables(np.frombuffer(stream.read(), "<u4"))
                with files.open_input_file(f"{root}/{row['file']}") as stream:
                    doc_ids, lengths, ids, _ = unpack_block(stream.read_at(row["bytes"], row["at"]), tables)
                ends = np.cumsum(lengths.astype(np.int64))
                data = memoryview(ids.astype("<u4").tobytes())
                pieces = [data[4 * a: 4 * b] for a, b in zip((ends - lengths).tolist(), ends.tolist())]
                columns = [
                    pa.array(doc_ids, pa.int64()), pa.array(ends - lengths + row["start"]), pa.array(lengths.astype(np.int64)),
                    pa.array([zlib.crc32(p) for p in pieces], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in pieces], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    # the rows are few and the work is large: a number, so that they aren't put together by their size
    tasks = max(1, math.ceil(manifest.count() / BLOCKS_PER_TASK))
    return block_starts(manifest).repartition(tasks, "file", "block").mapInArrow(read, schema)


def token_folder(docs: DataFrame) -> str:
    return work_dir(docs.sparkSession, "tokens")
