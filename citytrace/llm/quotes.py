"""Chat formatting by quotation linking.

Quote marks at the start of lines are parsed into levels, quoted passages are hashed in a normalised
form and joined to the messages of the same conversation that hold them first, and conversations are
ordered so that replies follow what they answer, without the quotes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import ascii_lower, saved

#: Lines that announce a quotation.
ANNOUNCES = r"(?i)(wrote|writes|said|schrieb|schreibt|a écrit|écrit|escribió|escribe)\s*:\s*$"
RUN_WORDS = 5  #: words of a run that a part of a line has in common with its original
_MARKS = r"^((?:[ \t]{0,3}>)+)[ \t]?"
_SPACE = r"[\x09-\x0D\x20]+"


def lines_of(text: Column) -> Column:
    """Array of (level, body): the number of quote marks before a line, and the line without them."""
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), "\r\n?", "\n"), "\n", -1)

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 1)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.regexp_replace(line, _MARKS, "").alias("body"),
        )

    return F.transform(lines, parsed)


def own_text(lines: Column) -> Column:
    """Lines of level 0, without those that announce the quotation on the next line, and trimmed."""

    def stays(line: Column, place: Column) -> Column:
        following = F.coalesce(F.get(lines, place + 1)["level"], F.lit(0))
        return (line["level"] == 0) & ~(line["body"].rlike(ANNOUNCES) & (following > 0))

    bodies = F.transform(F.filter(lines, stays), lambda line: line["body"])
    return F.regexp_replace(F.array_join(bodies, "\n"), r"^\s+|\s+$", "")


def normalised(body: Column) -> Column:
    """A-Z lowered, white space as one space."""
    return F.trim(F.regexp_replace(ascii_lower(body), _SPACE, " "))


def _units(text: Column) -> Column:
    """What can be quoted of a text: all of it, its paragraphs and its lines; empty ones are left out."""
    parts = F.concat(F.array(text), F.split(text, r"\n[ \t]*\n", -1), F.split(text, "\n", -1))
    return F.array_distinct(F.filter(F.transform(parts, normalised), lambda part: part != ""))


def _fine_units(text: Column) -> Column:
    """What a part of a text has in common with it, however it is wrapped: sentences and runs of words."""

    def of(whole: Column) -> Column:
        words = F.split(whole, " ")
        runs = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(words) - RUN_WORDS, F.lit(0))),
            lambda k: F.array_join(F.slice(words, k + 1, RUN_WORDS), " "),
        )
        sentences = F.split(whole, r"(?<=[.!?]) ", -1)
        return F.concat(sentences, F.when(F.size(words) >= RUN_WORDS, runs).otherwise(F.array().cast("array<string>")))

    units = F.element_at(F.transform(F.array(normalised(text)), of), 1)
    return F.array_distinct(F.filter(units, lambda unit: unit != ""))


def passages(lines: Column) -> Column:
    """Array of (level, text): neighbouring lines of one level above 0, joined."""

    def add(state: Column, line: Column) -> Column:
        last = F.try_element_at(state, F.lit(-1))
        grown = F.struct(line["level"].alias("level"), F.concat_ws("\n", last["text"], line["body"]).alias("text"))
        begun = F.concat(state, F.array(F.struct(line["level"].alias("level"), line["body"].alias("text"))))
        goes_on = (F.size(state) > 0) & (last["level"] == line["level"])
        cut = F.slice(state, 1, F.greatest(F.size(state) - 1, F.lit(0)))
        return F.when(goes_on, F.concat(cut, F.array(grown))).otherwise(begun)

    empty = F.array().cast("array<struct<level:int,text:string>>")
    return F.filter(F.aggregate(lines, empty, add), lambda p: p["level"] > 0)


def hashed(unit: Column) -> Column:
    """128 bits of a unit, so that different passages don't meet."""
    return F.md5(unit.cast("binary"))


def _voted(quoting: DataFrame, parsed: DataFrame, units: Callable[[Column], Column], share: float) -> DataFrame:
    """(conv, turn, parent): of the shallowest quoted level with a known passage, the message with most.

    A unit belongs to the first message of the conversation that has it as its own; a quotation links only to
    an earlier turn, that holds at least that share of the level's units. Ties go to the latest message.
    """
    quoted = quoting.select("conv", "turn", F.explode(passages(F.col("lines"))).alias("passage"))
    quoted = quoted.select(
        "conv", "turn", F.col("passage.level").alias("level"), F.explode(units(F.col("passage.text"))).alias("unit")
    )
    quoted = quoted.select("conv", "turn", "level", hashed(F.col("unit")).alias("mark"))
    quoted = quoted.groupBy("conv", "turn", "mark").agg(F.min("level").alias("level"))
    conversations = quoting.select("conv").distinct().withColumnRenamed("conv", "quoting")
    candidates = parsed.join(conversations, F.col("conv") == F.col("quoting"), "left_semi")
    originals = candidates.select("conv", "turn", F.explode(units(F.col("own"))).alias("unit"))
    originals = originals.select(F.col("conv").alias("of"), "turn", hashed(F.col("unit")).alias("of_mark"))
    originals = originals.groupBy("of", "of_mark").agg(F.min("turn").alias("parent"))
    found = quoted.join(originals, (F.col("conv") == F.col("of")) & (F.col("mark") == F.col("of_mark")))
    found = found.filter(F.col("parent") < F.col("turn"))
    votes = found.groupBy("conv", "turn", "level", "parent").agg(F.count("*").alias("votes"))
    if share:
        sizes = quoted.groupBy("conv", "turn", "level").agg(F.count("*").alias("units"))
        votes = votes.join(sizes, ["conv", "turn", "level"]).filter(F.col("votes") >= F.col("units") * share)
    rank = F.struct((-F.col("level")).alias("level"), "votes", "parent")
    return votes.groupBy("conv", "turn").agg(F.max(rank).alias("best")).select("conv", "turn", F.col("best.parent"))


def _parents(parsed: DataFrame) -> DataFrame:
    """(conv, turn, parent) by whole texts, paragraphs and lines; where none is known, by parts of them."""
    quoting = parsed.filter(F.col("text").contains(">")).filter(F.exists("lines", lambda line: line["level"] > 0))
    exact = saved(_voted(quoting, parsed, _units, 0), "exact-parents")
    open_ = quoting.join(exact.select("conv", "turn"), ["conv", "turn"], "left_anti")
    return exact.union(_voted(open_, parsed, _fine_units, 0.5))


def _threads(parents: DataFrame) -> DataFrame:
    """(conv, turn, parent, thread, depth): the message a thread begins with, by pointer doubling."""
    known = saved(
        parents.select("conv", "turn", "parent", F.col("parent").alias("thread"), F.lit(1).cast("long").alias("depth")),
        "threads",
    )
    while True:
        step = known.select(
            F.col("conv").alias("of"), F.col("turn").alias("at"), F.col("thread").alias("further"), F.col("depth").alias("steps")
        )
        joined = known.join(step, (F.col("conv") == F.col("of")) & (F.col("thread") == F.col("at")), "left")
        if joined.filter("further is not null").isEmpty():
            return known
        known = saved(
            joined.select(
                "conv", "turn", "parent", F.coalesce("further", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("steps", F.lit(0))).alias("depth"),
            ),
            "threads",
        )


def reply_ordered(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text, parent_turn, thread_turn, depth) of every message, text without quotes.

    In the order of (conv_id, thread_turn, turn) every reply follows what it answers; a message that
    quotes nothing known begins a thread of its own, so a conversation without quotes keeps the order
    of turns. The frame is range-partitioned and sorted so, however long a conversation is. A null text
    is an empty one; messages without conversation or turn quote nothing and are quoted by none;
    repeated rows stay, with the same links.
    """
    names = {"conv": conv_id, "turn": turn, "role": role, "text": text}
    rows = conversations.select(*[F.col(f"`{name}`").alias(short) for short, name in names.items()])
    parsed = rows.withColumn("lines", lines_of(F.col("text"))).withColumn("own", own_text(F.col("lines")))
    threads = _threads(_parents(parsed.filter("conv is not null and turn is not null")))
    linked = threads.toDF("of", "at", "parent", "thread", "depth")
    found = parsed.select("conv", "turn", "role", "own").join(linked, (F.col("conv") == F.col("of")) & (F.col("turn") == F.col("at")), "left")
    ordered = found.select(
        F.col("conv").alias(conv_id),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        F.col("own").alias(text),
        F.col("parent").alias("parent_turn"),
        F.coalesce("thread", "turn").alias("thread_turn"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )
    keys = [conv_id, "thread_turn", turn]
    return ordered.repartitionByRange(*keys).sortWithinPartitions(*keys)
