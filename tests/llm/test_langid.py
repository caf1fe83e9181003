"""Operator 4: held-out accuracy, evidence and defined results."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import langid

SYLLABLES = {"en": "the th ing an er on re st nd", "de": "sch ei en ich ung er ge ver ß", "fr": "eau ou é que ai la les tion ç"}
SCHEMA = "doc_id bigint, text string, lang string, source string, language string"


def prose(rng, language, words):
    parts = SYLLABLES[language].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


def corpus(spark, wrong=()):
    rng, rows = random.Random(9), []
    for k in range(150):
        language = ["en", "de", "fr"][k % 3]
        rows.append((k, prose(rng, language, rng.randint(20, 80)), "en" if k in wrong else language, f"s{k % 5}", "old"))
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_held_out_accuracy(spark):
    rows, docs = corpus(spark)
    model = langid.fit_text_model(docs.where("doc_id < 75"), F.col("text"), F.col("lang"), F.col("doc_id"))
    assert model.languages == ["de", "en", "fr"]
    held = docs.where("doc_id >= 75").withColumn("lang", F.lit(None).cast("string"))
    found = langid.identify_documents(held, None, model=model).collect()
    assert all(r["language"] == rows[r["doc_id"]][2] and r["kept"] for r in found)


def test_wrong_labels_lose_against_text(spark):
    rows, docs = corpus(spark, wrong={1, 2, 4})
    found = {r["doc_id"]: r for r in langid.identify_documents(docs, None).collect()}
    assert [found[k]["language"] for k in (1, 2, 4)] == ["de", "fr", "de"]


def test_other_evidence_decides_where_text_is_poor(spark):
    rows, docs = corpus(spark)
    more = [(200, "er", None, "only-de", "x"), (201, "que er", "fr", "s0", "x"), (202, "que er", "de", "s0", "x")] + [(300 + k, prose(random.Random(k), "de", 40), "de", "only-de", "x") for k in range(40)]
    found = {r["doc_id"]: r for r in langid.identify_documents(docs.union(spark.createDataFrame(more, SCHEMA)), None, text_weight=1).collect()}
    assert [found[k]["language"] for k in (200, 201, 202)] == ["de", "fr", "de"]


def test_undetermined_rows_go(spark):
    rows, docs = corpus(spark)
    odd = [(400, None, "en", "s1", "x"), (401, "", None, None, "x"), (402, "123 ### $$", "en", None, "x"), (None, rows[0][1], None, None, "x"), (None, rows[0][1], None, None, "x"), (403, rows[0][1] * 200, "en", "s1", "x")]
    found = langid.identify_documents(docs.union(spark.createDataFrame(odd, SCHEMA)), None, carried=("lang",))
    assert found.columns == ["doc_id", "lang", "language", "confidence", "kept"]
    found = found.collect()
    assert len(found) == len(rows) + len(odd)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[k]["language"] == "und" and not by_id[k]["kept"] for k in (400, 401, 402))
    assert by_id[403]["kept"] and [r["language"] for r in found if r["doc_id"] is None] == ["en", "en"]
    assert langid.identify_documents(docs.limit(0), None).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    blank = unlabelled.withColumn("text", F.when(F.col("doc_id") > 5, F.col("text")))
    found = langid.identify_documents(blank, None).collect()
    assert {r["language"] for r in found} == {"und"} and {r["doc_id"] for r in found if not r["kept"]} == set(range(6))
    few = langid.identify_documents(docs.where("doc_id < 4"), None).collect()
    assert [r["language"] for r in sorted(few)] == ["en", "de", "fr", "en"] and all(r["kept"] for r in few)


def plain_fusion(facts, languages, text_weight=200, host_strength=10.0, domain_strength=50.0, least=0.5):
    """The posterior of every row in plain Python: [(language, confidence, kept)]."""
    size, sure = len(languages), [f for f in facts if f["sure"] is not None]
    sums = [sum(f["sure"] == k for f in sure) for k in range(size)]

    def counts(key, value):
        return [sum(f["sure"] == k and f[key] == value for f in sure) if value is not None else 0 for k in range(size)]

    found = []
    for f in facts:
        prior = [(n + 1) / (len(sure) + size) for n in sums]
        for key, strength in (("domain", domain_strength), ("host", host_strength)):
            n = counts(key, f[key])
            prior = [(c + strength * p) / (sum(n) + strength) for c, p in zip(n, prior)]
        value = [math.log(p) + min(f["trigrams"], text_weight) * s for p, s in zip(prior, f["scores"])]
        for key in ("declared", "suffix"):
            if f[key] is not None:
                kinds = len({g[key] for g in sure if g[key] is not None})
                value = [v + math.log((c + 0.5) / (n + 0.5 * (kinds + 1))) for v, c, n in zip(value, counts(key, f[key]), sums)]
        if not f["trigrams"] or max(f["scores"]) < -math.log(langid.CELLS):
            found.append(("und", 1.0, False))
            continue
        share = 1 / sum(math.exp(v - max(value)) for v in value)
        found.append((languages[value.index(max(value))], share, share >= least))
    return found


def test_fusion_against_plain_python(spark):
    rng, languages = random.Random(13), ["aa", "bb", "cc"]
    facts = []
    for k in range(300):
        scores = [-rng.uniform(4, 6) for _ in languages] if rng.random() < 0.9 else [-11.0] * 3
        facts.append({
            "id": k, "trigrams": rng.choice([0, 1, 3, 30, 900]), "scores": scores, "sure": rng.choice([None, 0, 0, 1, 2]),
            "declared": rng.choice([None, "aa", "bb", "xx"]), "suffix": rng.choice([None, "de", "fr"]), "host": rng.choice([None, "h1", "h2", "h3"]), "domain": rng.choice([None, "d1", "d2"]),
        })
    facts += [{**facts[0], "id": 900, "scores": [-5.0] * 3, "trigrams": 2, "declared": None, "suffix": None, "host": None, "domain": None, "sure": None}] * 2
    schema = "id bigint, trigrams bigint, scores array<double>, sure int, declared string, suffix string, host string, domain string"
    df = spark.createDataFrame([tuple(f.values()) for f in facts], schema).repartition(5)
    got = langid.fuse(df, langid.TextModel(languages, np.ones((3, langid.CELLS))), ["id"])
    wanted = sorted((f["id"], *p) for f, p in zip(facts, plain_fusion(facts, languages)))
    for (i, language, confidence, kept), r in zip(wanted, sorted(tuple(r) for r in got.collect())):
        assert (i, language, kept) == (r[0], r[1], r[3]) and abs(confidence - r[2]) < 1e-9


def test_page_evidence(spark):
    rows = [(2, "https://m.x.example.DE/de/17?p=1", '<!DOCTYPE html><HTML class="a" lang="de-DE"><p>'), (1, "http://other.org/17.html", "<html>"), (3, "no", None), (4, None, ""), (5, "http://h/abc", "<html lang=fr>"), (6, "http://localhost/9#top", "<html lang='fr'>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r["doc"]: tuple(r)[1:] for r in langid.page_evidence(pages).collect()}
    assert found == {17: (None, "org", "other.org", "other.org"), 9: ("fr", "localhost", "localhost", None)}


def test_page_and_source_join(spark):
    rows, docs = corpus(spark)
    pages = spark.createDataFrame([(k, f"http://h{k % 4}.site.de/{k}", '<html lang="xx">') for k in range(0, 150, 2)], "page_id bigint, url string, html string")
    found = langid.identify_documents(docs, pages).collect()
    assert len(found) == 150 and all(r["language"] == rows[r["doc_id"]][2] for r in found)


def test_cells_of_pieces():
    classes = langid.byte_classes()
    assert len(langid.trigram_cells(b"", classes)) == 0 and len(langid.trigram_cells(b"1 2 3", classes)) == 0
    assert np.array_equal(langid.trigram_cells(b"ABC", classes), langid.trigram_cells(b"abc", classes))
