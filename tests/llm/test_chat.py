"""Operator 12: spans of turns by rendering, escaped control strings, templates that rewrite."""

import hashlib
import random

import pytest

from millrace.llm import chat
from millrace.llm.chat import MarkedTemplate, Span, locate_turns

PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]", "<\\s>", "[\\\\/INST]", "<", "[", "\\", " ", "\n", "]", "é😀", "a", "s>", "INST]"]


def hard_text(rng):
    return "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_every_text_comes_back():
    rng, template = random.Random(3), MarkedTemplate()
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "system", "", hard_text(rng)]), hard_text(rng)) for _ in range(rng.randrange(6))]
        text = template.render(turns)
        assert list(template.parse(text)) == turns
        for _, body in turns:
            assert not any(c in template.escape(body) for c in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[TEXT]", "[/ROLE]"))
    with pytest.raises(ValueError, match="no turn"):
        list(template.parse("<s>[INST] open"))


def test_spans_are_those_of_the_texts():
    rng, template = random.Random(4), MarkedTemplate()
    for _ in range(500):
        turns = [(rng.choice(["user", "assistant", "tool"]), hard_text(rng) + rng.choice(["", "", ""])) for _ in range(5)]
        text, spans, rewritten = locate_turns(template.render, turns)
        assert rewritten is None and text == template.render(turns)
        for turn, s in zip(turns, spans):
            assert text[s.begin: s.end] == template.turn(*turn)
            assert template.unescape(text[s.content_begin: s.content_end]) == turn[1]


def test_other_black_boxes():
    turns = [("user", "a"), ("assistant", "b"), ("user", "a"), ("assistant", "c")]

    def closing(ts):  # text behind the last turn moves with every turn
        return "".join(f"<{r}>{t}" for r, t in ts) + "<end>"

    def forgetting(ts):  # keeps what it thought only in the last turn
        return "".join(f"<{r}>{t if k == len(ts) - 1 or r == 'user' else ''}" for k, (r, t) in enumerate(ts))

    def silent(ts):  # leaves user texts out
        return "".join(f"<{r}>{'' if r == 'user' else t}" for r, t in ts)

    assert locate_turns(closing, turns)[1:] == ([], 0)
    assert locate_turns(forgetting, turns)[1:] == ([], 2)
    assert locate_turns(silent, turns)[1][:2] == [Span(0, 6, 0, 0), Span(6, 18, 17, 18)]


def plain(rows):
    """Facts by conversation in plain Python."""
    template, found = MarkedTemplate(), {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{r[2] or ''}\n{r[3] or ''}".encode()).hexdigest())):
        found.setdefault(conv, []).append((role or "", text or ""))
    return {
        c: (len(ts), sha("".join(f"{r}\n{t}\n" for r, t in ts)), len(said := "".join(t for r, t in ts if r == "assistant")), sha(said), len(template.render(ts)))
        for c, ts in found.items()
    }


def run(df, **settings):
    blocks = chat.format_conversations(df, conversation=df["conv_id"], turn=df["turn"], role=df["role"], text=df["text"], **settings)
    return blocks, {r["conv"]: tuple(r)[1:6] for r in chat.read_back(blocks).collect()}


def test_long_conversations_nulls_ties_and_clashing_names(spark, conf):
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant"]), hard_text(rng)) for k in range(500)]
    rows += [(c, k, "user" if k % 2 == 0 else "assistant", hard_text(rng)) for c in range(2, 30) for k in range(c)]
    rows += [(31, k, "assistant", "x" * 200_000 + "</s>") for k in range(3)]
    rows += [(None, None, None, None), (None, 0, "user", "q"), (40, 1, "user", "same"), (40, 1, "user", "same"), (40, 1, "assistant", "</s>"), (41, 0, "system", "")]
    rows += [(50 + n, k, "user", "t") for n in (0, 1, 2) for k in range(chat.BLOCK_TURNS + n - 1)]
    df = spark.createDataFrame([(*r, 7, "own") for r in rows], "conv_id bigint, turn bigint, role string, text string, block int, spans string").repartition(5)
    blocks, found = run(df)
    assert found == plain(rows)
    assert blocks.where("rewritten IS NOT NULL").count() == 0
    assert blocks.where("conv = 1").count() == 500 // chat.BLOCK_TURNS + 1
    assert run(df.limit(0))[1] == {}


def test_templates_that_rewrite_have_no_spans(spark):
    class Late(MarkedTemplate):
        """Turns beside a question mark rewrite the first one."""

        def render(self, turns):
            text = super().render(turns)
            return text.replace("<s>", "<s> begun</s>", 1) if any("?" in t for _, t in turns) else text

    class Counting(MarkedTemplate):
        """Every turn says how many stand before it."""

        def turn(self, role, text):
            return f" {text}</s>"

        def render(self, turns):
            return self.begin + "".join(f" {k}: {t}</s>" for k, (_, t) in enumerate(turns))

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "what?"), (1, 3, "assistant", "c"), (2, 0, "user", "a"), (2, 1, "assistant", "b")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    blocks, found = run(df, template=Late())
    assert {(r["conv"], r["rewritten"], len(r["spans"])) for r in blocks.collect()} == {(1, 2, 0), (2, None, 2)}
    assert found[1][2] == 0 and found[2][2] == 1
    many = spark.createDataFrame([(3, k, "assistant", "t") for k in range(100)], df.schema)
    blocks, _ = run(many, template=Counting())
    assert [r["rewritten"] for r in blocks.orderBy("block").collect()] == [None, 32, 64, 96]
