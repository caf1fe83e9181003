"""Operator 9 against a plain pass in order."""

import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import units


def plain_removals(rows, pattern, least):
    seen, removed = {}, []
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    found = []
    for k in order:
        for m in re.finditer(pattern, rows[k][1] or ""):
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group())
            words = tuple(re.findall(r"[^\x20\x09-\x0D]+", text))
            if len(words) >= least:
                found.append(((rows[k][0] is None, rows[k][0] or 0, m.start()), rows[k][0], m.start(), m.end(), words))
    for _, d, a, b, words in sorted(found, key=lambda f: f[0]):
        if words in seen:
            removed.append((d, a, b, len(words), *seen[words]))
        else:
            seen[words] = (d, a)
    return sorted(removed, key=repr)


@pytest.mark.parametrize("unit", sorted(units.UNITS))
def test_against_plain_pass(spark, unit):
    rng = random.Random(5)
    sentences = [" ".join(rng.choice(["Ab", "é", "c", "d1"]) for _ in range(rng.randint(1, 6))) + rng.choice([".", "!", "?!", "", "\n", "\n\n"]) for _ in range(40)]
    rows = [(k, "".join(rng.choice(sentences) + rng.choice([" ", ""]) for _ in range(rng.randint(0, 12)))) for k in range(60)]
    rows += [(None, rows[3][1]), (None, rows[3][1]), (70, None), (71, ""), (72, "a b c d. " * 500)] + [rows[5]] * 9
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = units.repeated_units(docs, identity=F.col("doc_id"), text=F.col("text"), unit=unit, least_words=3)
    got = [tuple(r) for r in found.select("id", "begins", "ends", "words", "first_id", "first_begins").collect()]
    assert sorted(got, key=repr) == plain_removals(rows, units.UNITS[unit], 3)


def test_units_tile_the_text():
    for pattern in units.UNITS.values():
        for text in ("", "\n\n", "a.b!\n\nc", "...", "é\n?x\n", "no end"):
            assert "".join(m.group() for m in re.finditer(pattern, text)) == text


def test_texts_are_cut_at_the_spans(spark):
    line = "this line has eight words in it now"
    rows = [(2, f"{line}\nown of two", 7), (1, f"head\n{line.upper()}\n", 7), (3, f"{line}\n{line}", 7), (4, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, removed int")
    found = {r["doc_id"]: r for r in units.remove_units(docs, identity="doc_id", text="text").collect()}
    assert found[1]["text"] == rows[1][1] and found[1]["removed"] == []
    assert found[2]["text"] == "own of two" and [tuple(s) for s in found[2]["removed"]] == [(0, 36)]
    assert found[3]["text"] == "" and found[4]["text"] is None
    assert units.remove_units(docs.limit(0), identity="doc_id", text="text").count() == 0


def test_short_units_are_compared_as_runs(spark):
    verse = "Roses are red.\nViolets are blue.\nSugar is sweet.\nAnd so are you.\n"
    rows = [(1, f"This opening sentence belongs to the first text only.\n{verse}"), (2, f"Another beginning.\n{verse}The end of it."), (3, "Roses are red.\nNothing else.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    plain = {r["doc_id"]: r["text"] for r in units.remove_units(docs, identity="doc_id", text="text", unit="sentence", runs=False).collect()}
    assert plain[2] == rows[1][1]
    found = {r["doc_id"]: r for r in units.remove_units(docs, identity="doc_id", text="text", unit="sentence").collect()}
    assert found[1]["text"] == rows[0][1] and found[3]["text"] == rows[2][1]
    assert found[2]["text"] == "Another beginning.\nThe end of it."
    assert [tuple(s) for s in found[2]["removed"]] == [(19, 19 + len(verse))]


def test_runs_begin_and_end_at_every_short_unit():
    text = "a b c. d e. f g h. i j. one two three four five six seven eight. k l."
    found = {(text[a:b].strip(), words) for a, b, words, *_ in units.text_runs(text, re.compile(units.UNITS["sentence"]), 8)}
    long = "one two three four five six seven eight."
    assert found == {
        ("a b c. d e. f g h.", 8), (f"d e. f g h. i j. {long}", 15), (f"f g h. i j. {long}", 13), (f"i j. {long}", 10),
        ("a b c. d e. f g h. i j.", 10), (long, 8), (f"{long} k l.", 10),
    }


def plain_run_removals(rows, pattern, least):
    """Every run of short units, by hand: from each unit rightwards and leftwards until it has enough words."""
    found = set()
    for at, (d, text) in enumerate(rows):
        pieces = []
        for m in re.finditer(pattern, text or ""):
            words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group()))
            if words:
                pieces.append((m.start(), m.end(), words))
        for k in range(len(pieces)):
            for ends in (range(k, len(pieces)), range(k, -1, -1)):
                for last in ends:
                    run = pieces[min(k, last): max(k, last) + 1]
                    words = [w for p in run for w in p[2]]
                    if len(words) >= least:
                        found.add(((d is None, d or 0, run[0][0], at), d, run[0][0], run[-1][1], tuple(words)))
                        break
    removed, first = [], {}
    for key, d, a, b, words in sorted(found, key=lambda f: (f[0], f[3])):
        first.setdefault(words, (key, d, a))
    for key, d, a, b, words in found:
        if (key[3], a) != (first[words][0][3], first[words][2]):
            removed.append((d, a, b, len(words), first[words][1], first[words][2]))
    return sorted(removed, key=repr)


def test_runs_against_a_plain_pass(spark):
    rng = random.Random(8)
    sentences = [" ".join(rng.choice(["Ab", "é", "c", "d1", "e"]) for _ in range(rng.randint(1, 5))) + rng.choice([".", "!", "\n"]) for _ in range(15)]
    rows = [(k, "".join(rng.choice(sentences) + " " for _ in range(rng.randint(0, 9)))) for k in range(50)]
    rows += [(None, rows[3][1]), (70, None), (71, ""), (72, "a. b. c. " * 100)] + [rows[5]] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = units.repeated_units(docs, identity=F.col("doc_id"), text=F.col("text"), unit="sentence", least_words=6, runs=True)
    got = [tuple(r) for r in found.select("id", "begins", "ends", "words", "first_id", "first_begins").collect()]
    assert sorted(got, key=repr) == plain_run_removals(rows, units.UNITS["sentence"], 6)
