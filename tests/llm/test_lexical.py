"""Operator 13: the same ranks as scoring every document, and bounds that keep every row that counts."""

import math
import random
import re
from collections import Counter

import numpy as np

from millrace.llm import lexical as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_ranks(docs, items, best=10):
    """[(item, rank, doc, score)] by scoring all pairs."""
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    sizes = [sum(b.values()) for _, b in bags]
    total, terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, b in bags for t in b)
    found = []
    for item, text in items:
        scored = []
        for k, ((d, bag), n) in enumerate(zip(bags, sizes)):
            m = 100 - 75 + 75 * n * total // terms if terms else 25
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in plain_terms(text) if bag[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0, k))
        found += [(item, r, None if none else d, -s) for r, (s, none, d, _) in enumerate(sorted(scored)[:best], 1)]
    return sorted(found, key=repr)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS number", "2 AS terms").repartition(4)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    found = L.search_documents(d, i, identity=d["doc_id"], text=d["text"], item=i["item_id"], item_text=i["text"], **settings)
    assert found.columns == ["item", "rank", "doc", "score"]
    return sorted((tuple(r) for r in found.collect()), key=repr)


def made_docs(rng, n):
    words = [f"w{k}" for k in range(60)] + ["Éa", "ÉA", "x1", "naïve"]
    return [(k, " ".join(rng.choices(words, [1 / (j + 1) for j in range(len(words))], k=rng.choice([0, 1, 5, 30, 200])))) for k in range(n)]


def test_same_as_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(L, "BUCKET_ROWS", 16)
    monkeypatch.setattr(L, "SEED_ROWS", 20)
    rng = random.Random(7)
    docs = made_docs(rng, 600)
    items = [(k, " ".join(t.split()[:12])) for k, t in made_docs(rng, 40)] + [(100, "W1, w1 w2;w3"), (101, "nowhere"), (102, "w59 W59 ÉA")]
    assert run(spark, docs, items) == plain_ranks(docs, items)
    assert run(spark, docs, items, best=3) == plain_ranks(docs, items, 3)
    monkeypatch.setattr(L, "QUERY_BYTES", 100)  # many passes
    assert run(spark, docs, items[:8] + items[-3:]) == plain_ranks(docs, items[:8] + items[-3:])


def test_nulls_ties_copies_long_texts_and_nothing(spark):
    docs = [(k, "one two three") for k in range(50)] + [(None, "one two three")] * 3 + [(7, "one two three"), (60, None), (61, ""), (62, "... !")]
    docs += [(63, "two " * 300_000 + "one"), (64, "TWO")]
    items = [(1, "one"), (1, "one"), (2, "two THREE two"), (None, "three"), (3, None), (4, "?!"), (5, "one " * 5000)]
    assert run(spark, docs, items) == plain_ranks(docs, items)
    assert run(spark, [], items) == [] and run(spark, docs, []) == [] and run(spark, [(1, None)], items) == []
    everywhere = [(k, "all") for k in range(2)]
    assert run(spark, everywhere, [(1, "all")]) == plain_ranks(everywhere, [(1, "all")])


def test_bounds_keep_every_row_of_the_floor():
    rng = np.random.default_rng(3)
    pruned = 0
    for _ in range(60):
        size = 12
        sizes = rng.integers(1, 7, 80)
        terms = np.concatenate([np.sort(rng.choice(size, s, replace=False)) for s in sizes])
        values = rng.integers(1, 1000, len(terms))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        squares = np.array([(values[a:b] ** 2).sum() for a, b in zip(bounds, bounds[1:])])
        bucket = L.Bucket(sizes, terms, values, squares, size)
        asked = np.sort(rng.choice(size, 4, replace=False))
        weights = rng.integers(0, 9000, 4)
        dense = np.zeros(size, np.int64)
        dense[asked] = weights
        exact = np.array([(values[a:b] * dense[terms[a:b]]).sum() for a, b in zip(bounds, bounds[1:])])
        assert np.array_equal(bucket.scores(np.arange(80), dense), exact)
        for floor in (1, int(np.sort(exact)[-10]), int(exact.max()), int(exact.max()) + 1):
            found = bucket.candidates(asked, weights, math.sqrt((weights.astype(float) ** 2).sum()), max(1, floor))
            assert set(np.flatnonzero(exact >= max(1, floor))) <= set(found)
            pruned += 80 - len(found)
    assert pruned > 60 * 80
