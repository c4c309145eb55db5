"""Conversations in reply order, by linking quotations to their originals.

A message's lines are parsed into quote levels (leading ``>`` marks, nested
ones counted).  Quoted passages are normalised (lower case, one space) and
hashed as a whole, by paragraph and by line; so is what each message says
itself.  A quoted passage is joined to the first message of the conversation
that says it, whatever its level; a message replies to the message that the
quotations of its shallowest matching level match in most characters, the
latest if equal.

Chains of such replies are followed by doubling.  Each thread hangs on the
message at its top; conversations are ordered by top message, then turn, so a
quoting reply stands in its thread and after what it quotes.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import running_before, saved

_MARKS = re.compile(r"[ \t]*((?:>[ \t]?)+)")
_ATTRIBUTION = re.compile(r"[ \t]*(?:on\b.*\bwrote|.*\b(?:wrote|writes|schrieb|a écrit|escribió))\s*:[ \t]*", re.I | re.S)
_UNITS = "level int, hash long, length int"


def quote_level(line: str) -> tuple[int, str]:
    """How deep a line is quoted, and what it says."""
    m = _MARKS.match(line)
    return (m[1].count(">"), line[m.end():]) if m else (0, line)


def parse(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """What a message says itself (lines that announce a quotation left out), and (level, passage) in its order."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    last = 0
    for line in (text or "").split("\n"):
        level, said = quote_level(line)
        if level == 0:
            own.append(line)
        else:
            if last == 0:
                while own and not own[-1].strip():
                    own.pop()
                if own and _ATTRIBUTION.fullmatch(own[-1]):
                    own.pop()
            if level != last:
                passages.append((level, []))
            passages[-1][1].append(said)
        last = level
    return "\n".join(own).strip("\n"), [(n, "\n".join(x)) for n, x in passages]


def _normal(text: str) -> str:
    return " ".join(text.lower().split())


def units(text: str) -> dict[int, int]:
    """Hash and length of a text as a whole, of its paragraphs and of its lines (normalised, empty ones left out)."""
    out = {}
    for part in (text, *re.split(r"\n[ \t]*\n", text), *text.split("\n")):
        if said := _normal(part):
            out[int.from_bytes(hashlib.blake2b(said.encode(), digest_size=8).digest(), "big", signed=True)] = len(said)
    return out


def _unit_rows(messages: DataFrame) -> DataFrame:
    """(__conv, __turn, level, hash, length): level 0 for what a message says, else the depth of the quotation."""
    def take(batches):
        for batch in batches:
            conv, turn, text = (batch.column(c).to_pylist() for c in ("__conv", "__turn", "text"))
            rows = []
            for c, t, x in zip(conv, turn, text, strict=True):
                own, quoted = parse(x)
                rows += [(c, t, 0, h, n) for h, n in units(own).items()]
                rows += [(c, t, level, h, n) for level, said in quoted for h, n in units(said).items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(v), kind) for v, kind in zip(zip(*rows, strict=True) if rows else [()] * 5,
                 (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int32()), strict=True)],
                names=["__conv", "__turn", "level", "hash", "length"])
    return messages.select("__conv", "__turn", "text").mapInArrow(take, f"__conv string, __turn long, {_UNITS}")


def reply_links(messages: DataFrame) -> DataFrame:
    """(__conv, __turn, __up): the turn that each quoting message replies to.

    One row for each quoted hash is joined to one row for the first message
    that says it; a passage that many messages repeat costs no more.
    """
    rows = saved(_unit_rows(messages), "quote-units")
    said = rows.where("level = 0").groupBy("__conv", "hash").agg(F.min("__turn").alias("__up"))
    quoted = rows.where("level > 0").select("__conv", "__turn", "level", "hash", "length").distinct()
    found = (quoted.join(said, ["__conv", "hash"]).where("__up < __turn")
             .groupBy("__conv", "__turn", "level", "__up").agg(F.sum("length").alias("length")))
    return (found.groupBy("__conv", "__turn").agg(F.max(F.struct(-F.col("level"), "length", "__up")).alias("best"))
            .select("__conv", "__turn", F.col("best.__up").alias("__up")))


def _tops(links: DataFrame) -> DataFrame:
    """(__conv, __turn, __up, __top, __depth): the message at the end of each chain of replies, and the steps to it."""
    state = saved(links.select("*", F.col("__up").alias("__top"), F.lit(1).cast("long").alias("__depth")), "quote-tops")
    while True:
        above = state.select("__conv", F.col("__turn").alias("__top"), F.col("__top").alias("__next"), F.col("__depth").alias("__more"))
        longer = saved(state.join(above, ["__conv", "__top"], "left").select(
            "__conv", "__turn", "__up", F.coalesce("__next", "__top").alias("__top"),
            (F.col("__depth") + F.coalesce("__more", F.lit(0))).alias("__depth"), F.col("__next").isNotNull().alias("__moved")), "quote-tops")
        state = longer.drop("__moved")
        if not longer.where("__moved").head(1):  # chains double in length each round
            return state


def _placed(turns: DataFrame) -> DataFrame:
    """``turns`` (__conv, __top, __turn, ...) with ``position`` in (__top, __turn) order of the conversation.

    Threads are placed by their sizes, then messages inside their thread, both
    in buckets of 256 turns, so neither a long conversation nor one long
    thread is sorted by a single task.
    """
    sizes = (turns.groupBy("__conv", "__top").agg(F.count(F.lit(1)).alias("__size"))
             .withColumn("__bucket", F.floor(F.col("__top") / 256)))
    starts = running_before(sizes, ["__conv"], "__bucket", ["__top"], "__size", "__start").select("__conv", "__top", "__start")
    inside = running_before(turns.withColumns({"__one": F.lit(1), "__bucket": F.floor(F.col("__turn") / 256)}),
                            ["__conv", "__top"], "__bucket", ["__turn"], "__one", "__inside")
    return (inside.join(starts, ["__conv", "__top"])
            .withColumn("position", F.col("__start") + F.col("__inside")).drop("__start", "__inside", "__one", "__bucket"))


def link_quotations(messages: DataFrame) -> DataFrame:
    """One row for each message: conv_id, turn, role, reply_to, depth, thread, position, text and chat.

    ``reply_to`` is the turn of the quoted message (null: quotes none known),
    ``depth`` the replies between the message and the top of its thread,
    ``thread`` the turn of that top, ``position`` the place of the turn in the
    conversation's reply order, ``text`` the message without quotations and
    ``chat`` that text with its role marker.  Rows that share conversation and
    turn share a place; a null turn comes first, a null conv_id is one
    conversation; null and empty texts say nothing.  Further columns are left
    out; an empty table gives an empty one.
    """
    least = -(1 << 63)
    keyed = messages.select(
        "conv_id", "turn", "role", "text",
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("__conv"),
        F.coalesce(F.col("turn").cast("long"), F.lit(least)).alias("__turn"))
    tops = _tops(reply_links(keyed))
    turns = (keyed.select("__conv", "__turn").distinct().join(tops, ["__conv", "__turn"], "left")
             .withColumns({"__top": F.coalesce("__top", "__turn"), "__depth": F.coalesce("__depth", F.lit(0))}))
    placed = _placed(saved(turns, "quote-turns"))

    @F.arrow_udf("string")
    def own_text(texts: pa.Array) -> pa.Array:
        return pa.array([parse(t.as_py())[0] for t in texts], pa.string())

    null_turn = lambda c: F.when(F.col(c) != least, F.col(c))
    return (keyed.join(placed, ["__conv", "__turn"]).withColumn("text", own_text(F.col("text")))
            .select("conv_id", "turn", "role", null_turn("__up").alias("reply_to"), F.col("__depth").alias("depth"),
                    null_turn("__top").alias("thread"), F.col("position").cast("long").alias("position"), "text",
                    F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.col("text"), F.lit("\n")).alias("chat")))
