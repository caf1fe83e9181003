"""Operator 12: conversations as training text; where each turn lies is seen by rendering one more turn at a time."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.scratch import stage

#: Turns that are rendered together; longer conversations are cut into such blocks.
BLOCK_TURNS = 32
#: Turns before a block that are rendered with it.
CONTEXT_TURNS = 2
#: Stands for a turn's text when the place of the text inside the turn is looked for.
PROBES = "\ue000\uf8ff"
Turn = tuple[str, str]


class MarkedTemplate:
    r"""Turns between control strings; look-alikes of these inside texts get a backslash more.

    ``[INST] text [/INST]`` is a user's turn, `` text</s>`` an assistant's, any
    other role is written out.  A text's ``<s>`` becomes ``<\s>`` and its ``<\s>``
    becomes ``<\\s>``, so taking one backslash away restores every text.
    """

    begin = "<s>"
    control = re.compile(r"([<\[]\\*)(/?s>|/?INST\]|/?ROLE\]|TEXT\])")
    escaped = re.compile(r"([<\[]\\*)\\(/?s>|/?INST\]|/?ROLE\]|TEXT\])")
    parts = re.compile(r"\[INST\] (.*?) \[/INST\]|\[ROLE\] (.*?) \[TEXT\] (.*?) \[/ROLE\]| (.*?)</s>", re.DOTALL)

    def escape(self, text: str) -> str:
        return self.control.sub(r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        return self.escaped.sub(r"\1\2", text)

    def turn(self, role: str, text: str) -> str:
        text = self.escape(text)
        if role == "user":
            return f"[INST] {text} [/INST]"
        if role == "assistant":
            return f" {text}</s>"
        return f"[ROLE] {self.escape(role)} [TEXT] {text} [/ROLE]"

    def render(self, turns: list[Turn]) -> str:
        return self.begin + "".join(self.turn(*t) for t in turns)

    def parse(self, text: str) -> Iterator[Turn]:
        """The turns of a rendered text, or of whole turns of it; anything else is an error."""
        at = len(self.begin) if text.startswith(self.begin) else 0
        while at < len(text):
            found = self.parts.match(text, at)
            if not found:
                raise ValueError(f"no turn begins at {at}")
            user, role, body, assistant = found.groups()
            if role is not None:
                yield self.unescape(role), self.unescape(body)
            else:
                yield ("user", self.unescape(user)) if user is not None else ("assistant", self.unescape(assistant))
            at = found.end()


@dataclass
class Span:
    """A turn's place in the text of its block, and that of its content."""

    begin: int
    end: int
    content_begin: int
    content_end: int


def common_prefix(a: str, b: str) -> int:
    return len(os.path.commonprefix([a, b]))


def locate_turns(render: Callable[[list[Turn]], str], turns: list[Turn], known: int = 0) -> tuple[str, list[Span], int | None]:
    """(text, spans of the turns from ``known`` on, first turn that rewrote what stood before, or None).

    ``render`` is a black box.  Its output for one turn more has to begin with
    its last output; what is added is the turn.  Where the content lies in there
    is seen by rendering the turn once more with a probe as its text.  If a
    render changes earlier text, spans of earlier turns would point elsewhere:
    the number of that turn is returned, and no spans.
    """
    text, spans = render(turns[:known]), []
    for k in range(known, len(turns)):
        longer = render(turns[: k + 1])
        if common_prefix(text, longer) < len(text):
            return longer, [], k
        role, body = turns[k]
        probe = next((p for p in PROBES if p not in body and p not in role and p not in longer), None) or PROBES * (1 + len(longer))
        tried = render([*turns[:k], (role, probe)])
        start = tried.find(probe, len(text)) if tried.startswith(text) else -1
        behind = len(tried) - start - len(probe)
        if start < 0:
            start, behind = len(text), len(longer) - len(text)  # the template leaves such texts out
        spans.append(Span(len(text), len(longer), start, len(longer) - behind))
        text = longer
    return text, spans, None


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) with place: 0, 1, ... in the order of turn and a digest of role and text.

    Rows are range partitioned and ranked inside a partition, shifted by what
    earlier partitions hold of the conversation: a long conversation is spread.
    """
    keys = ["conv", "turn", "tie", "row"]
    tie = F.md5(F.concat("role", F.lit("\n"), "text"))
    known = stage(rows.select("*", tie.alias("tie"), F.monotonically_increasing_id().alias("row")), "chat-rows")
    dealt = stage(known.repartitionByRange(*keys).withColumn("bucket", F.spark_partition_id()), "chat-order")
    sizes = dealt.groupBy("conv", "bucket").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("shift", F.sum("n").over(earlier)).where("shift IS NOT NULL")
    # only conversations that lie in several partitions have shifts
    shifts = stage(shifts.select(F.col("conv").alias("_conv"), F.col("bucket").alias("_bucket"), "shift"), "chat-shifts")
    rank = F.row_number().over(Window.partitionBy("conv", "bucket").orderBy(*keys[1:])) - 1
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("bucket") == F.col("_bucket"))
    placed = dealt.withColumn("rank", rank).join(shifts, same, "left")
    return placed.select("conv", "role", "text", (F.col("rank") + F.coalesce("shift", F.lit(0))).cast("bigint").alias("place"))


SPAN = "array<struct<begin:bigint,end:bigint,content_begin:bigint,content_end:bigint,loss:boolean>>"
BLOCKS = f"conv bigint, block bigint, text string, spans {SPAN}, rewritten bigint, first_check string, next_check string"


def groups_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows that agree in their first ``keys`` columns, over batch borders."""
    held, key = [], None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:keys] != key:
                if held:
                    yield key, held
                held, key = [], row[:keys]
            held.append(row[keys:])
    if held:
        yield key, held


def format_conversations(
    turns: DataFrame, *, conversation: Column, turn: Column, role: Column, text: Column, template=None, trained: tuple[str, ...] = ("assistant",)
) -> DataFrame:
    """(conv, block, text, spans, rewritten): the conversations rendered by ``template``, in blocks of ``BLOCK_TURNS`` turns.

    The texts of a conversation's blocks in order are its whole text.  ``spans``
    give every turn's place and its content's in the text of the block, in
    characters; ``loss`` is true for the contents of ``trained`` roles.

    A block is rendered with ``CONTEXT_TURNS`` turns before it and one behind it;
    the latter has to come out as it does in the next block.  ``rewritten`` is
    the first place at which the template changed earlier text or depended on
    turns farther back; such a block has no spans, so that nothing is trained on
    that may be elsewhere.  Every render is of a bounded number of turns,
    however long the conversation.

    Rows are ordered by turn, null first, ties by the MD5 of role and text;
    repeated rows are turns of their own.  Null roles and texts count as empty.  A null
    conversation is one of its own.  An empty table gives an empty one.
    """
    template = template or MarkedTemplate()
    rows = turns.select(
        conversation.cast("bigint").alias("conv"), turn.cast("bigint").alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    placed = numbered(rows)
    own = F.floor(F.col("place") / BLOCK_TURNS)
    inside = F.col("place") % BLOCK_TURNS
    # the last turns of a block are context of the next, its first turn is shown to the one before
    more = F.array_compact(F.array(
        own, F.when(inside >= BLOCK_TURNS - CONTEXT_TURNS, own + 1), F.when((inside == 0) & (own > 0), own - 1),
    ))
    dealt = placed.select("conv", F.explode(more).alias("block"), "place", "role", "text")
    tasks = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "conv", "block").sortWithinPartitions("conv", "block", "place")

    def digest(piece: str) -> str:
        return hashlib.md5(piece.encode("utf-8", "surrogatepass")).hexdigest()

    def one(conv, block, rows: list[tuple]) -> dict | None:
        first, last = block * BLOCK_TURNS, (block + 1) * BLOCK_TURNS
        if all(place < first for place, _, _ in rows):
            return None  # a whole last block: nothing follows
        before = sum(place < first for place, _, _ in rows)
        behind = sum(place >= last for place, _, _ in rows)
        given = [(r, t) for _, r, t in rows]
        known = max(0, before - 1)
        rendered, spans, rewritten = locate_turns(template.render, given, known)
        made = {"conv": conv, "block": block, "spans": [], "rewritten": None, "first_check": None, "next_check": None}
        if rewritten is not None:
            own_turns = given[before: len(given) - behind]
            start = template.render(given[:before]) if before else ""
            whole = template.render(given[:before] + own_turns)
            cut = common_prefix(start, whole)
            return made | {"text": whole[cut:], "rewritten": first + max(0, rewritten - before)}
        start = spans[before - known].begin if block else 0
        mine = spans[before - known: len(given) - behind - known]
        end = mine[-1].end
        places = [
            {"begin": s.begin - start, "end": s.end - start, "content_begin": s.content_begin - start, "content_end": s.content_end - start, "loss": r in trained}
            for s, (r, _) in zip(mine, given[before:])
        ]
        checks = {
            "first_check": digest(rendered[mine[0].begin: mine[0].end]) if block else None,
            "next_check": digest(rendered[spans[-1].begin: spans[-1].end]) if behind else None,
        }
        return made | {"text": rendered[start:end], "spans": places} | checks

    schema = T._parse_datatype_string(BLOCKS)
    span = pa.list_(pa.struct([(n, pa.int64()) for n in ("begin", "end", "content_begin", "content_end")] + [("loss", pa.bool_())]))
    kinds = pa.schema([("conv", pa.int64()), ("block", pa.int64()), ("text", pa.string()), ("spans", span), ("rewritten", pa.int64()), ("first_check", pa.string()), ("next_check", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for (conv, block), rows in groups_of(batches, 2):
            made = one(conv, block, rows)
            if made:
                held.append(made)
                size += len(made["text"])
            if size > 1 << 22 or len(held) >= 1000:
                yield pa.RecordBatch.from_pylist(held, schema=kinds)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=kinds)

    made = stage(dealt.mapInArrow(work, schema), "chat-blocks")
    # a turn that two blocks render differently depends on more than the context
    ahead = made.where("next_check IS NOT NULL").select(F.col("conv").alias("_conv"), (F.col("block") + 1).alias("_block"), F.col("next_check").alias("seen"))
    both = made.join(ahead, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")), "left")
    differs = F.col("seen") != F.col("first_check")
    return both.select(
        "conv", "block", "text", F.when(differs, F.array().cast(SPAN)).otherwise(F.col("spans")).alias("spans"),
        F.coalesce("rewritten", F.when(differs, F.col("block") * BLOCK_TURNS)).alias("rewritten"),
    )


FACTS = "conv bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, rewritten bigint"


def read_back(blocks: DataFrame, template=None) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewritten) of the output of :func:`format_conversations`.

    Turns come from parsing the texts, the trained text from the spans.  A
    digest runs over a conversation from its first to its last character, so one
    task passes its blocks, one at a time; only running digests are held.
    """
    template = template or MarkedTemplate()
    # blocks are never so few that one task should take many conversations
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks.select("conv", "block", "text", "spans", "rewritten").repartition(tasks, "conv").sortWithinPartitions("conv", "block")
    fields = [("conv", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewritten", pa.int64())]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, facts, digests, done = None, None, None, []

        def close() -> None:
            if facts is not None:
                done.append(facts | {"turns_sha256": digests[0].hexdigest(), "loss_sha256": digests[1].hexdigest()})

        for batch in batches:
            for conv, text, spans, rewritten in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3, 4))):
                if facts is None or conv != now:
                    close()
                    now, digests = conv, (hashlib.sha256(), hashlib.sha256())
                    facts = {"conv": conv, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "rewritten": None}
                facts["formatted_chars"] += len(text)
                if facts["rewritten"] is None:
                    facts["rewritten"] = rewritten
                for role, body in template.parse(text):
                    facts["n_turns"] += 1
                    digests[0].update(f"{role}\n{body}\n".encode())
                for s in spans:
                    if s["loss"]:
                        learned = template.unescape(text[s["content_begin"]: s["content_end"]])
                        facts["loss_chars"] += len(learned)
                        digests[1].update(learned.encode())
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema=pa.schema(fields))
                done = []
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema(fields))

    return dealt.mapInArrow(work, T._parse_datatype_string(FACTS))
