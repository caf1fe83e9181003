"""Operator 8: exact round trips of ids and files."""

import io
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import rans

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("count", [1, 2, 63, 1000, 70_000])
def test_coder_round_trip(count):
    rng = np.random.default_rng(count)
    ids = np.minimum(rng.zipf(1.3, count) - 1, 49_000).astype(np.uint32)
    tables = rans.coder_tables(rans.scaled_frequencies(np.bincount(ids)))
    state, words = rans.encode_ids(ids, tables, rans.lanes_for(count))
    assert np.array_equal(rans.decode_ids(state, words, count, tables), ids)


def test_frequencies_add_up():
    counts = np.array([0, 1, 10**12, 0, 5, *[1] * 40_000])
    freq = rans.scaled_frequencies(counts)
    assert freq.sum() == 1 << rans.BITS and ((freq > 0) == (counts > 0)).all()
    one = rans.scaled_frequencies(np.array([0, 0, 7]))
    tables = rans.coder_tables(one)
    state, words = rans.encode_ids(np.full(500, 2, np.uint32), tables, 4)
    assert (rans.decode_ids(state, words, 500, tables) == 2).all()


def test_size_is_near_the_entropy():
    rng = np.random.default_rng(1)
    ids = rng.choice(300, 200_000, p=np.arange(1, 301) / np.arange(1, 301).sum()).astype(np.uint32)
    counts = np.bincount(ids)
    shares = counts[counts > 0] / counts.sum()
    best = -(shares * np.log2(shares)).sum() * len(ids) / 8
    _, words = rans.encode_ids(ids, rans.coder_tables(rans.scaled_frequencies(counts)), rans.LANES)
    assert words.nbytes < 1.01 * best


def test_damage_is_found():
    ids = np.arange(200, dtype=np.uint32) % 7
    tables = rans.coder_tables(rans.scaled_frequencies(np.bincount(ids)))
    data = bytearray(rans.pack_block([4, None], [150, 50], ids, 9, tables))
    names, lengths, back, first = rans.unpack_block(bytes(data), tables)
    assert names == [4, None] and lengths.tolist() == [150, 50] and (back == ids).all() and first == 9
    data[-30] ^= 1
    with pytest.raises(ValueError):
        rans.unpack_block(bytes(data), tables)


TEXTS = [
    "", None, " \n\t", "Plain words, and MORE words.", "it's we'll 'tis 1234 a1b2", "a\x1cb c d\x85e", "İstanbul İ. Σας ΟΔΟΣ é H̱x", "<|endoftext|> a<|startoftext|>b",
    "日本語 テスト ｆｕｌｌ", "x" * 3000, "́ start", "emoji 👩‍👩‍👧 #*$%", "\x00\x01 ctl", "word " * 5000,
]


def test_word_cache_gives_the_ids_of_whole_texts():
    tokenizer, tokens = Tokenizer.from_file(PATH), rans.WordTokens(PATH, limit=30)
    rng = random.Random(0)
    letters = "abcXYZ'’.,!?0123 éÉßİıΣσς̧́ \n\t<|>-_"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    for text in texts:
        wanted = tokenizer.encode(text or "", add_special_tokens=False).ids
        got = np.frombuffer(tokens.encode([(text or "").encode()])[0], tokens.kind).tolist()
        assert got == wanted, repr(text)


def test_another_tokenizer_gets_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, tokens = Tokenizer.from_file(path), rans.WordTokens(path)
    assert rans.WordTokens(PATH).by_word and not tokens.by_word
    for text in ("Hello, World!  It's 12 o'clock.", "é à ñ\n\nUPPER lower", "", "<|endoftext|> x"):
        assert np.frombuffer(tokens.encode([text.encode()])[0], tokens.kind).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_files_round_trip(spark, tmp_path):
    rows = [(k * 7 % 50, t, "s", 1) for k, t in enumerate(TEXTS * 3)] + [(None, "no id", "s", 1)] * 2 + [(5, "again", "s", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string, ids int").repartition(3)
    folder = str(tmp_path / "t")
    manifest = rans.write_tokens(docs, folder, identity=F.col("doc_id"), text=F.col("text"), tokenizer=PATH, end_id=2, block_ids=900)
    found = rans.read_tokens(manifest, folder).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(PATH)
    wanted = sorted((d is not None, d or 0, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,)) for d, t, _, _ in rows)
    got = [(r["doc_id"] is not None, r["doc_id"] or 0, tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in found]
    assert sorted(got) == wanted and [g[:2] for g in got] == sorted(g[:2] for g in got)
    start = 0
    for r in found:
        assert r["start"] == start and r["n_tokens"] * 4 == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(r["ids"])
        start += r["n_tokens"]
    assert manifest.count() > 3
    for row in manifest.select("file").distinct().collect():
        data = (tmp_path / "t" / row["file"]).read_bytes()
        blocks = rans.read_checkpoints(io.BytesIO(data), len(data))
        assert [(b[0], b[1]) for b in blocks] == [(r["at"], r["bytes"]) for r in manifest.where(F.col("file") == row["file"]).orderBy("block").collect()]


def test_no_rows(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    folder = str(tmp_path / "n")
    manifest = rans.write_tokens(docs, folder, identity=F.col("doc_id"), text=F.col("text"), tokenizer=PATH, end_id=2)
    assert rans.read_tokens(manifest, folder).count() == 0
