"""Operator 6 against plain counting."""

import random
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import linefreq

WS = " \t\n\x0b\x0c\r"


def words_of(text):
    found, word = [], ""
    for c in text + " ":
        if c in WS:
            if word:
                found.append(word)
            word = ""
        else:
            word += c
    return found


def plain_base(text):
    text = text or ""
    words = words_of(text)
    grams = Counter(tuple(words[k: k + 8]) for k in range(len(words) - 7))
    hit = {k + j for k in range(len(words) - 7) if grams[tuple(words[k: k + 8])] > 1 for j in range(8)}
    lines = [line for line in text.split("\n") if words_of(line)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_base_counts():
    rng = random.Random(1)
    texts = [None, "", " \n ", "a", "é\x1cb c d", "x " * 400, ("# a*b " + "|" * 9 + "\n") * 5, "w " * 7, "w " * 8, "w " * 9]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 120))) for _ in range(200)]
    for text in texts:
        assert linefreq.text_facts(text or "")[:5] == plain_base(text), text


def test_frequent_lines_deplete(spark):
    body = " ".join(f"own{k}" for k in range(30))
    rows = [(k, "h", f"Shared  LINE number {k}\n" + " ".join(f"{chr(97 + k)}{chr(97 + j)}" for j in range(25))) for k in range(6)]
    rows += [(10, "h", "shared line number 7\n" + "a b c"), (11, "i", "shared line number 1\n" + body), (None, None, body), (None, None, body), (12, "h", None), (12, "h", "")]
    rows += [(0, "h", rows[0][2])] * 30
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    facts = linefreq.document_facts(docs, F.col("text"), F.col("source"), F.col("doc_id"))
    found = {}
    for r in linefreq.judge_documents(facts, least_docs=5, host_share=0.0, least_words=20, least_share=0.3).collect():
        found.setdefault(r["doc"], []).append(r)
    # seven documents of h share the line, repeated rows count once
    assert all(r["removed_words"] == 4 and r["kept"] for k in range(6) for r in found[k])
    assert found[10][0]["removed_words"] == 4 and not found[10][0]["kept"]
    assert found[11][0]["removed_words"] == 0 and found[11][0]["kept"]
    assert [r["kept"] for r in found[None]] == [True, True] and [r["base_failed"] for r in found[12]] == [True, True]
    limits = linefreq.judge_documents(facts, least_docs=7, host_share=0.0)
    assert limits.where("removed_words > 0").count() == 0
    assert linefreq.judge_documents(facts, least_docs=5, host_share=0.9).where("removed_words > 0").count() == 0


def test_cleaned_texts(spark):
    rows = [(k, "h", f"common words here {k}\nown text {'x' * k} of {k}\n\nend", "old") for k in range(4)] + [(9, None, None, "old")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string, kept string")
    found = linefreq.clean_documents(docs, text="text", host="source", identity="doc_id", least_docs=3, host_share=0.0, least_words=1)
    assert found.columns == ["doc_id", "source", "text", *linefreq.OUTPUTS]
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert texts[9] is None and texts[2] == "own text xx of 2\n"
    none = linefreq.clean_documents(docs.limit(0), text="text", host="source", identity="doc_id")
    assert none.count() == 0
