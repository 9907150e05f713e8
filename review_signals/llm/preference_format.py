"""Preference pairs as training text: the shared turns once as prompt, then two completions with loss masks. Native.

Chosen and rejected conversations come as rows of turns. Per side one aggregation gathers a conversation into its row
(a training example is one row, so a conversation has to fit into one); a join brings the two sides together. The
prompt is the longest run of turns from the start with equal role and text on both sides. Each completion is the text
of the other turns; its mask lists the character ranges [start, end) that bear loss: what the assistant says, with its
end mark.

Defined cases: null role or text counts as empty. Exactly repeated rows of a turn count once; turns with one number
are ordered by role, then text. A null turn number comes first. Rows without a pair id are left out. If one side of a
pair is missing, its completion is empty, the prompt too. Equal conversations are all prompt, with empty completions.
Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """A turn is ``before + role + between + text + after``; loss is on ``text + after`` of the roles in ``learned``."""

    before: str = "<|im_start|>"
    between: str = "\n"
    after: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)


def _conversations(turns: DataFrame, name: str) -> DataFrame:
    rows = turns.filter(F.col("pair_id").isNotNull()).select(
        "pair_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.groupBy("pair_id").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias(name))


def _without_number(turns: str) -> Column:
    """Turns as role and text, in the order of their numbers; a missing side has no turns."""
    nothing = F.expr("cast(array() as array<struct<role:string,text:string>>)")
    return F.coalesce(F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))), nothing)


def _render(turns: Column, template: Template) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(template.before), t["role"], F.lit(template.between), t["text"], F.lit(template.after))), "")


def _mask(turns: Column, template: Template) -> Column:
    """Ranges that bear loss: a fold over the turns that carries the place reached."""
    nothing = F.expr("cast(array() as array<struct<start:int,end:int>>)")

    def step(state: Column, turn: Column) -> Column:
        start = state["place"] + len(template.before) + F.char_length(turn["role"]) + len(template.between)
        end = start + F.char_length(turn["text"]) + len(template.after)
        found = F.when(turn["role"].isin(*template.learned), F.concat(state["found"], F.array(
            F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["found"])
        return F.struct(end.alias("place"), found.alias("found"))

    begin = F.struct(F.lit(0).alias("place"), nothing.alias("found"))
    return F.aggregate(turns, begin, step, lambda state: state["found"])


def format_pairs(chosen: DataFrame, rejected: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008 - frozen
    """One row per pair: ``n_prompt_turns``, ``prompt``, and text and mask of both completions."""
    pairs = _conversations(chosen, "__chosen").join(_conversations(rejected, "__rejected"), "pair_id", "full")
    pairs = pairs.select("pair_id", _without_number("__chosen").alias("c"), _without_number("__rejected").alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    differs = F.array_position(F.zip_with(F.slice("c", 1, shorter), F.slice("r", 1, shorter), lambda a, b: a == b), False)
    pairs = pairs.withColumn("n", F.when(differs > 0, differs.cast("int") - 1).otherwise(shorter))
    pairs = pairs.select(
        "pair_id", "n", F.slice("c", 1, F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c") - F.col("n")).alias("c"), F.slice("r", F.col("n") + 1, F.size("r") - F.col("n")).alias("r"),
    )
    return pairs.select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"), _render(F.col("p"), template).alias("prompt"),
        _render(F.col("c"), template).alias("chosen"), _mask(F.col("c"), template).alias("chosen_mask"),
        _render(F.col("r"), template).alias("rejected"), _mask(F.col("r"), template).alias("rejected_mask"),
    )


def branch_pairs(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs from plain conversations, one for each: the conversation itself is chosen. The rejected one leaves it at
    its last assistant turn and goes on with the turns of its neighbour (conv_id with the lowest bit flipped) from that
    number on."""
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    leaves = turns.filter("role = 'assistant'").groupBy("pair_id").agg(F.max("turn").alias("leave"))
    shared = turns.join(leaves, "pair_id", "left").filter(F.coalesce(F.col("turn") < F.col("leave"), F.lit(True))).drop("leave")
    neighbours = turns.withColumn("pair_id", F.col("pair_id").bitwiseXOR(F.lit(1)))
    other = neighbours.join(leaves, "pair_id").filter(F.col("turn") >= F.col("leave")).drop("leave")
    return turns, shared.unionByName(other)
