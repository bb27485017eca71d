"""Conversations as training texts, made and read with Spark expressions only.

The turns of a conversation are collected as structs and sorted.  Adjacent turns of one role become one block, whose texts
are kept apart by a mark, so the turns can be read back one by one:

    <turn>user<says>text<part>text</turn>\\n<turn>assistant<says>text</turn>\\n

Roles and texts are escaped: a backslash is doubled, and a control string gets one behind its first character.  No control
string has its first character a second time, so none can begin in a text and end in the template, and texts are found by
splitting.  The loss mask lists the spans of the UTF-8 text, in bytes, that hold the texts of the assistant.

Every step is linear in the length of a conversation: arrays are cut and joined, never grown turn by turn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, SAYS, PART, END = "<turn>", "<says>", "<part>", "</turn>\n"
_CONTROL = r"<(?=(?:/?turn|says|part)>)"
#: Running totals are made in stretches of so many values.
STRETCH = 512
SPANS = "array<struct<start:bigint,length:bigint>>"
TURNS = "array<struct<role:string,text:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also if ``use`` refers to it from a lambda function."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"<\\")


def unescaped(text: Column) -> Column:
    """The inverse of :func:`escaped`: a single backslash behind ``<`` is never one of a doubled pair's."""
    plain = F.regexp_replace(text, r"<\\(?=(?:/?turn|says|part)>)", "<")
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def _totals(lengths: Column) -> Column:
    """For every value of an array of longs the sum of those before it, and the whole sum at the end."""
    def running(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def use(values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), F.lit(STRETCH))
        inner = F.transform(starts, lambda i: running(F.slice(values, i + 1, STRETCH)))
        return _let(inner, lambda parts: _let(running(F.transform(parts, lambda p: F.element_at(p, -1))), lambda before: F.concat(
            F.flatten(F.transform(parts, lambda p, i: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: x + F.get(before, i)))),
            F.array(F.element_at(before, -1)))))

    return _let(lengths, use)


def _blocks(turns: Column) -> Column:
    """Sorted turns as blocks ``struct<role, texts>`` of adjacent turns of one role; all strings are escaped already."""
    def use(t: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(t) - 1), lambda i: (i == 0) | (F.get(t, i)["role"] != F.get(t, i - 1)["role"]))

        def cut(starts: Column) -> Column:
            return F.transform(starts, lambda at, k: F.struct(
                F.get(t, at)["role"].alias("role"),
                F.transform(F.slice(t, at + 1, F.coalesce(F.get(starts, k + 1), F.size(t)) - at), lambda x: x["text"]).alias("texts")))

        return _let(first, cut)

    return _let(turns, use)


def _head(role: Column) -> Column:
    return F.concat(F.lit(TURN), role, F.lit(SAYS))


def _text(blocks: Column) -> Column:
    one = lambda b: F.concat(_head(b["role"]), F.array_join(b["texts"], PART), F.lit(END))
    return F.array_join(F.transform(blocks, one), "")


def _spans(blocks: Column, role: str) -> Column:
    """Where the texts of ``role`` lie in the UTF-8 text.  Each text is preceded by the head of its block or by a mark, and the
    last one of a block is followed by the end mark, so starts are running totals of lengths."""
    size = lambda c: F.octet_length(c).cast("long")
    mark, end = F.lit(len(PART)).cast("long"), F.lit(len(END)).cast("long")

    def of_block(b: Column) -> Column:
        return F.transform(b["texts"], lambda x, i: F.struct(
            (b["role"] == role).alias("loss"),
            F.when(i == 0, size(_head(b["role"]))).otherwise(mark).alias("before"),
            size(x).alias("length"),
            F.when(i == F.size(b["texts"]) - 1, end).otherwise(F.lit(0).cast("long")).alias("after")))

    def use(pieces: Column) -> Column:
        total = _totals(F.transform(pieces, lambda p: p["before"] + p["length"] + p["after"]))
        placed = _let(total, lambda at: F.transform(pieces, lambda p, i: F.struct(
            p["loss"].alias("loss"), (F.get(at, i) + p["before"]).alias("start"), p["length"].alias("length"))))
        return F.transform(F.filter(placed, lambda p: p["loss"]), lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")))

    return _let(F.flatten(F.transform(blocks, of_block)), use).cast(SPANS)


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         learned: str = "assistant") -> DataFrame:
    """One row (id, formatted, loss_spans, n_blocks) for every conversation; ``loss_spans`` are the texts of ``learned``.

    Turns are sorted by turn, ties by role and text, so repeated rows stand beside each other and each is kept.  A null turn
    comes first, a null role or text is an empty string.  A row without a conversation is a conversation of its own, with
    a null id: nothing holds such rows together, however many there are.  Other columns don't matter; an empty table gives
    an empty result.
    """
    said = lambda c: F.coalesce(F.col(c), F.lit(""))
    of = turns.select(F.col(conv).alias("id"), F.struct(F.col(turn).alias("turn"), said(role).alias("role"), said(text).alias("text")).alias("t"))
    whole = of.where("id is not null").groupBy("id").agg(F.collect_list("t").alias("ts"))
    alone = of.where("id is null").select("id", F.array("t").alias("ts"))
    in_order = F.transform(F.array_sort("ts"), lambda t: F.struct(escaped(t["role"]).alias("role"), escaped(t["text"]).alias("text")))
    blocks = whole.union(alone).select("id", _blocks(in_order).alias("blocks"))
    return blocks.select("id", _text(F.col("blocks")).alias("formatted"), _spans(F.col("blocks"), learned).alias("loss_spans"),
                         F.size("blocks").cast("long").alias("n_blocks"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds, in order."""
    blocks = F.split(formatted, END)

    def turns(block: Column) -> Column:
        return _let(F.split(F.substr(block, F.lit(len(TURN) + 1)), SAYS, 2), lambda halves: _let(unescaped(F.get(halves, F.lit(0))), lambda role: F.transform(
            F.split(F.get(halves, F.lit(1)), PART), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))))

    return F.flatten(_let(blocks, lambda b: F.transform(F.slice(b, 1, F.size(b) - 1), turns))).cast(TURNS)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return _let(formatted.cast("binary"), lambda b: F.array_join(F.transform(
        spans, lambda s: unescaped(F.substr(b, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), ""))
