"""Operator 7 against plain fingerprints and all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash

SCHEMA = "doc_id bigint, text string, id string, fp string"


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k: k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 2:
            label[find(i)] = find(j)
    names = {}
    for k, (d, _) in enumerate(rows):
        names.setdefault(find(k), []).append(d)
    return [(d, f"{fp:016x}", min((n for n in names[find(k)] if n is not None), default=None)) for k, ((d, _), fp) in enumerate(zip(rows, fps))]


def test_groups_against_all_pairs(spark):
    rng = random.Random(7)
    words = [f"w{k}" for k in range(40)] + ["É", "a b"]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "one"), (4, "One"), (5, "one two"), (6, "x " * 3000), (None, "one"), (None, "lonely words here now")]
    for k in range(40):
        base = [rng.choice(words) for _ in range(rng.randint(3, 300))]
        rows.append((100 + 10 * k, " ".join(base)))
        for c in range(4):
            copy = list(base)
            for _ in range(c):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((100 + 10 * k + 5 - c, "\t".join(copy).upper()))
    rows += [rows[12]] * 25
    docs = spark.createDataFrame([(*r, "i", "f") for r in rows], SCHEMA)
    found = simhash.group_near_copies(docs, identity=F.col("doc_id"), text=F.col("text"))
    got = sorted((tuple(r) for r in found.select("id", simhash.hex_digits(F.col("fp")), "component_id").collect()), key=repr)
    assert got == sorted(plain_components(rows), key=repr)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_pairs(radius):
    rng = np.random.default_rng(radius)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) for _ in range(400)]
    values = np.unique(np.concatenate([centres[rng.integers(0, 30, 400)] ^ np.array(flips), rng.integers(0, 1 << 63, 300, dtype=np.uint64)]))
    found = {(int(a), int(b)) for i, j in simhash.close_pairs(values, radius) for a, b in zip(i, j)}
    wanted = {(i, j) for i, j in combinations(range(len(values)), 2) if (int(values[i]) ^ int(values[j])).bit_count() <= radius}
    assert found == wanted


def test_masks_lose_no_pair():
    rng = random.Random(2)
    masks = [0]
    for _ in range(3):
        child = [(m, c) for m in masks for c in simhash.agreeing_masks(m, 2)]
        for _ in range(300):
            m = rng.choice(masks)
            rest = [b for b in range(64) if not m >> b & 1]
            differ = sum(1 << b for b in rng.sample(rest, 2))
            assert any(p == m and not differ & c for p, c in child)
        masks = [c for _, c in child]


def test_hot_buckets_go_deeper(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 5)
    rng = np.random.default_rng(4)
    near = np.unique([np.uint64(0xABCDEF0123456789) ^ np.uint64((1 << int(a)) | (1 << int(b))) for a, b in rng.integers(0, 64, (80, 2))])
    far = rng.integers(0, 1 << 63, 200, dtype=np.uint64) & np.uint64(0xFFFF0000FFFF)
    values = np.unique(np.concatenate([near, far]))
    known = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp bigint")
    roots = {r["node"]: r["root"] for r in simhash.stars(simhash.find_links(known, 2)).collect()}
    wanted = {}
    for a, b in combinations(values.tolist(), 2):
        if (a ^ b).bit_count() <= 2:
            wanted.setdefault(a, set()).add(b)
            wanted.setdefault(b, set()).add(a)
    for value in values.tolist():
        seen, todo = {value}, [value]
        while todo:
            todo += [n for n in wanted.get(todo.pop(), ()) if not (n in seen or seen.add(n))]
        lowest = min(np.array(sorted(seen), np.uint64).view(np.int64).tolist())
        own = int(np.uint64(value).view(np.int64))
        assert roots.get(own, own) == lowest


def test_long_chain_and_no_rows(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in simhash.stars(chain).collect()} == {0}
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.group_near_copies(docs, identity=F.col("doc_id"), text=F.col("text")).count() == 0


def plain_similar(rows, least=0.8):
    """Numbers of the rows that stay, by all pairs of five-word sets."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append({b" ".join(words[k: k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both >= least * (len(sets[i]) + len(sets[j]) - both):
            label[find(i)] = find(j)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    return sorted((rows[min(g, key=lambda k: (rows[k][0] is None, rows[k][0] or 0))][0] for g in groups.values()), key=repr)


def test_similar_against_all_pairs(spark):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    licence = " ".join(rng.choice(words) for _ in range(30))
    rows = [(900, None), (901, ""), (902, "one two"), (903, "One  two"), (None, "one two")]
    for k in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(8, 250))]
        rows.append((10 * k, " ".join(base) + " " + licence))
        for c in range(3):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 60)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((10 * k + c + 1, " ".join(copy).upper() + "\n" + licence))
    crowd = [rng.choice(words) for _ in range(200)]
    for k in range(150):  # a chain of edits: a large component, not all pairs of which are links
        crowd[rng.randrange(200)] = rng.choice(words)
        rows.append((2000 + k, " ".join(crowd)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = simhash.drop_similar(docs, identity="doc_id", text="text")
    assert sorted((r["doc_id"] for r in found.collect()), key=repr) == plain_similar(rows)
    assert simhash.drop_similar(docs.limit(0), identity="doc_id", text="text").count() == 0


def test_near_dedup_stage_over_the_smallest_table(spark):
    import corpus_pipeline
    from conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = corpus_pipeline.drop_near_copies(spark, docs, DATA)
    assert found.columns == docs.columns
    assert sorted((r["doc_id"] for r in found.select("doc_id").collect()), key=repr) == plain_similar(rows)


def test_repeated_and_missing_ids_keep_one_row_of_a_group(spark):
    first, second, third = (" ".join(f"{c}{k}" for k in range(20)) for c in "abc")
    rows = [(1, first), (1, second), (1, first), (None, third), (None, third), (None, third.upper()), (2, second), (None, "lonely")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [tuple(r) for r in simhash.drop_similar(docs, identity="doc_id", text="text").collect()]
    assert sorted(d for d, _ in found if d is not None) == [1, 1]
    assert sorted(t.lower() for _, t in found) == sorted([first, second, third, "lonely"])


@pytest.mark.parametrize("words", [1, 8])
@pytest.mark.parametrize("radius", [0, 5, 9, 40])
def test_near_lanes_of_wide_values(words, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, (5, words), dtype=np.uint64)
    values = np.repeat(base, 30, axis=0)
    for row in values:
        for bit in rng.choice(64 * words, rng.integers(0, 25), replace=False).tolist():
            row[bit >> 6] ^= np.uint64(1 << (bit & 63))
    i, j = simhash.near_lanes(simhash.bit_planes(values), simhash.valid_lanes(len(values)), values[:70], radius)
    far = np.bitwise_count(values[:70, None, :] ^ values[None, :, :]).sum(axis=2)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(far <= radius))))


@pytest.mark.parametrize("limits", [{}, {"BUCKET_ROWS": 20}, {"PART_SHINGLES": 3000, "CANDIDATES": 1}, {"CANDIDATES": 2, "PIVOT_RADIUS": 0}])
def test_a_crowd_of_half_similar_texts(spark, monkeypatch, limits):
    """Members are 0.5 to 1 similar: most pairs are no links, and buckets are cut."""
    for name, value in limits.items():
        monkeypatch.setattr(simhash, name, value)
    rng = random.Random(21)
    words = [f"w{k}" for k in range(300)]
    base, rows = [rng.choice(words) for _ in range(150)], []
    for k in range(160):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(150)] = rng.choice(words)
        rows.append((k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = simhash.drop_similar(docs, identity="doc_id", text="text")
    assert sorted((r["doc_id"] for r in found.collect()), key=repr) == plain_similar(rows)
