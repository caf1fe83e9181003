"""Operator 10 against a plain scan of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from pyspark.sql import functions as F

from millrace.llm import fmindex


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_hits(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, item_text in items:
        phrase = plain_words(item_text)
        if not phrase:
            continue
        size = min(10, len(phrase))
        for k in range(len(phrase) - size + 1):
            for at in range(len(words) - size + 1):
                if words[at: at + size] == phrase[k: k + size]:
                    hit.update(range(at, at + size))
                    if item is not None:
                        found.add(str(item))
    return words, hit, sorted(found)


def corpus():
    rng = random.Random(11)
    vocabulary = ["a", "B", "é", "x9", "the", "of"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([2, 5, 10, 14])))) for k in range(12)]
    items += [(100, None), (101, ""), (102, "..."), (None, "the of the"), (7, "x9 x9 x9 x9"), (3, items[4][1]), (20, items[4][1])]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for k in range(80)]
    rows += [(200 + k, f"start, {items[k][1]}! END of {items[(k + 1) % 12][1]}-tail") for k in range(12)]
    rows += [(300, None), (301, ""), (302, "?!"), (None, items[0][1]), (303, "the " * 5000)] + [rows[81]] * 6
    return rows, items


def tables(spark, rows, items):
    docs = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id bigint, text string, n_hit int, spans string")
    return docs, spark.createDataFrame(items, "item_id bigint, text string")


def test_against_plain_scan(spark, monkeypatch):
    rows, items = corpus()
    docs, benchmark = tables(spark, rows, items)
    found = fmindex.find_contamination(docs, benchmark, identity="doc_id", text="text").collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found if r["doc_id"] is not None)
    wanted = []
    for d, text in rows:
        words, hit, ids = plain_hits(text, items)
        if d is not None:
            wanted.append((d, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    assert got == sorted(wanted) and len(found) == len(rows)


def test_small_shards_and_phrase_blocks_agree(monkeypatch):
    rows, items = corpus()
    texts = [fmindex.text_words((t or "").encode()) for _, t in rows]
    known = [(None if i is None else str(i), (t or "").encode()) for i, t in items]
    monkeypatch.setattr(fmindex, "SHARD_WORDS", 37)
    blocks = [fmindex.Phrases(known[k: k + 4], 10) for k in range(0, len(known), 4)]
    for (_, text), (n, places, ids) in zip(rows, fmindex.search_documents(texts, lambda: iter(blocks), 10)):
        words, hit, wanted = plain_hits(text, items)
        assert (n, set(places.tolist()), ids) == (len(words), hit, wanted)


@pytest.mark.parametrize("seed", range(4))
def test_index_ranks_and_places(seed):
    rng = np.random.default_rng(seed)
    docs = [rng.integers(0, [2, 5, 50, 1000][seed], n).astype(np.int64) for n in (0, 1, 300, 40, 0, 7)]
    docs.append(docs[2].copy())
    index = fmindex.FMIndex(docs)
    text = np.concatenate([np.r_[d, -1] for d in docs])
    phrases = np.zeros((60, 10), np.int64)
    lengths = rng.integers(1, 11, 60)
    for k, m in enumerate(lengths):
        at = int(rng.integers(0, 290))
        phrases[k, :m] = docs[2][at: at + m]
        phrases[k, rng.integers(0, m)] += k % 2
    which, low, high = index.search(phrases, lengths)
    found = {k: set(index.locate(np.arange(a, b)).tolist()) for k, a, b in zip(which.tolist(), low.tolist(), high.tolist())}
    for k, m in enumerate(lengths.tolist()):
        wanted = {p for p in range(len(text) - m + 1) if np.array_equal(text[p: p + m], phrases[k, :m])}
        assert found.get(k, set()) == wanted


def test_spans_are_cut_out(spark):
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(1, f"Before, {item.upper()}. After é", 5, "x"), (2, item, 5, "x"), (3, "clean  text.", 5, "x"), (4, None, 5, "x"), (5, "", 5, "x"), (6, item.replace("six", "6"), 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars int, _cut string")
    for name in ("_text", "_gone", "own", "cut", "gone", "row"):
        docs = docs.withColumn(name, F.lit(name))
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    left = fmindex.decontaminate(docs, benchmark, text="text")
    assert left.columns == docs.columns and {(r["_cut"], r["_text"], r["gone"]) for r in left.collect()} == {("x", "_text", "gone")}
    found = {r["doc_id"]: r["text"] for r in left.collect()}
    assert found == {1: "Before, . After é", 3: "clean  text.", 4: None, 5: "", 6: rows[5][1]}
    assert {r[0] for r in fmindex.decontaminate(docs.select("text"), benchmark, text="text").collect()} == set(found.values())
    unnamed = spark.createDataFrame([(None, item)], benchmark.schema)
    hits = fmindex.find_contamination(docs, unnamed, identity="doc_id", text="text").where("contaminated").collect()
    assert sorted((r["doc_id"], r["n_hit"], r["n_items"]) for r in hits) == [(1, 11, 0), (2, 11, 0)]
    assert fmindex.decontaminate(docs.limit(0), benchmark, text="text").count() == 0
    assert fmindex.decontaminate(docs, benchmark.limit(0), text="text").count() == len(rows)
