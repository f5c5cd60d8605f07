"""Multi-party perspective rotation of dialogues.

For every participant the dialogue is rendered once with that speaker as the assistant and all others as named users, and a
mask marks what the assistant says: only that is to be learned.  System turns are context in every perspective and never a
participant.

A rendering is cut into parts of ``PART_TURNS`` turns by their position, so that a dialogue of any length is many rows of bounded size
and no task holds a whole one.  Positions are counted in three levels - runs of ``PART_TURNS`` turn numbers, a turn number and two hex digits
of a hash, and the turn - so that neither a long dialogue nor any number of turns without number, or of one number, meet in a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Turns in one part of a rendering.
PART_TURNS = 256
SYSTEM = "system"
#: How a turn begins and ends.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _header(role: Column, perspective: Column) -> Column:
    return F.when(role == SYSTEM, SYSTEM).when(role == perspective, "assistant").otherwise(F.concat(F.lit("user name="), role))


def positions(said: DataFrame, run: int = PART_TURNS) -> DataFrame:
    """``said`` (``conv_id, turn, role, text``) with ``position``: 0, 1, ... in each dialogue, by turn (NULL last), two hex digits of the MD5
    of role and text, role, text."""
    digits = F.substring(F.md5(F.concat_ws("|", "role", "text").cast("binary")), 1, 2)
    # NULL turns are the last run.
    dealt = said.withColumns({"run": F.coalesce(F.floor(F.col("turn") / run), F.lit(2**62)), "number": F.coalesce("turn", F.lit(0)), "digits": digits})
    before = lambda n, keys, order: F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    small = dealt.groupBy("conv_id", "run", "number", "digits").agg(F.count("*").alias("n"))
    runs = small.groupBy("conv_id", "run").agg(F.sum("n").alias("n")).withColumn("far", before("n", ["conv_id"], ["run"])).drop("n")
    small = small.withColumn("near", before("n", ["conv_id", "run"], ["number", "digits"])).drop("n").join(runs, ["conv_id", "run"])
    own = F.row_number().over(Window.partitionBy("conv_id", "run", "number", "digits").orderBy("role", "text")) - 1
    placed = dealt.withColumn("own", own).join(small, ["conv_id", "run", "number", "digits"])
    return placed.select("conv_id", "turn", "role", "text", (F.col("far") + F.col("near") + F.col("own")).alias("position"))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, perspective, part, n_turns, n_masked, rendered, mask`` for every participant of every dialogue.

    ``rendered`` is the part's text; ``mask`` lists the assistant's spans in it as ``start:end``, code points, end exclusive, each
    with its closing mark, and ``n_masked`` is their length.  Turns are in the order of ``positions``.  Exactly repeated rows count
    once; rows without dialogue or role are left out, a NULL text is empty.
    Dialogues in which only the system speaks have no participant and no row.
    """
    said = turns.select(F.col(id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    said = said.where("conv_id IS NOT NULL AND role IS NOT NULL").distinct()
    speakers = said.where(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("perspective")).distinct()
    lines = positions(said).join(speakers, "conv_id")
    head = F.concat(F.lit(OPEN), _header(F.col("role"), F.col("perspective")), F.lit("\n"))
    body = F.concat(F.col("text"), F.lit(CLOSE))
    lines = lines.select(
        "conv_id", "perspective", F.floor(F.col("position") / part_turns).cast("long").alias("part"),
        F.struct(
            "position", "role", head.alias("head"), body.alias("body"),
            ((F.col("role") == F.col("perspective")) & (F.col("role") != SYSTEM)).alias("learned"),
        ).alias("line"),
    )
    parts = lines.groupBy("conv_id", "perspective", "part").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("masked"), F.array().cast("array<string>").alias("spans"))

    def step(held: Column, line: Column) -> Column:
        low = held["at"] + F.length(line["head"])
        high = low + F.length(line["body"])
        span = F.array(F.concat_ws(":", low.cast("string"), high.cast("string")))
        return F.struct(
            high.alias("at"), (held["masked"] + F.when(line["learned"], high - low).otherwise(0)).alias("masked"),
            F.when(line["learned"], F.concat(held["spans"], span)).otherwise(held["spans"]).alias("spans"),
        )

    walked = F.aggregate("lines", start, step)
    parts = parts.withColumn("walked", walked)
    return parts.select(
        "conv_id", "perspective", "part", F.size("lines").cast("long").alias("n_turns"), F.col("walked.masked").alias("n_masked"),
        F.array_join(F.transform("lines", lambda x: F.concat(x["head"], x["body"])), "").alias("rendered"), F.array_join("walked.spans", ",").alias("mask"),
    )
