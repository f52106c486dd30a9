"""Preference formatting: shared turns once as the prompt, then both completions with their loss masks.

For each pair of a chosen and a rejected conversation the longest common prefix of turns (role and text equal) is rendered
as the prompt; what follows in either is its completion. A mask lists the code-point ranges, in prompt plus completion,
that count for the loss: text and end mark of the assistant's turns in the completion.

Turns stand in order of turn, then role, then text. A conversation's turns are one value, as its rendering is; nothing else
is collected. Pairing counts conversations in blocks of ids, so a first turn that a third of all conversations share is
never in one task.

Defined cases: turns without conv_id belong to no conversation. Null roles and texts render as empty and equal each other. Repeated
rows are turns of their own. If one conversation is the other's prefix its completion is empty; if they are equal, both are, and
the prompt holds all. A conversation without a partner is a row of its own: the prompt ends before its last assistant turn,
and the rejected side is null. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.llm.common import ranked

ASSISTANT = "assistant"
HEAD, MIDDLE, TAIL = "<|", "|>\n", "<|end|>\n"
BLOCK_IDS = 10_000


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): role and text of each turn, in order."""
    one = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    gathered = turns.where(F.col("conv_id").isNotNull()).groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(one)).alias("all"))
    return gathered.select("conv_id", F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))


def rivals(convs: DataFrame) -> DataFrame:
    """(chosen_id, rejected_id): conversations that open alike, two by two in order of id. The longer assistant side is chosen,
    on a tie the smaller id. rejected_id is null for one that is left over."""
    said = F.aggregate("turns", F.lit(0), lambda n, t: n + F.when(t["role"] == ASSISTANT, F.length(t["text"])).otherwise(0))
    opening = F.col("turns")[0]
    light = convs.select("conv_id", F.xxhash64(opening["role"], opening["text"]).alias("opening"), said.alias("said"), F.floor(F.col("conv_id") / BLOCK_IDS).alias("block"))
    seated = ranked(light, ["opening"], "block", ["conv_id"], "seat").withColumn("table", F.floor(F.col("seat") / 2))
    one = seated.where("seat % 2 = 0").select("opening", "table", F.col("conv_id").alias("a"), F.col("said").alias("sa"))
    two = seated.where("seat % 2 = 1").select("opening", "table", F.col("conv_id").alias("b"), F.col("said").alias("sb"))
    second = F.coalesce(F.col("sb") > F.col("sa"), F.lit(False))
    return one.join(two, ["opening", "table"], "left").select(
        F.when(second, F.col("b")).otherwise(F.col("a")).alias("chosen_id"), F.when(second, F.col("a")).otherwise(F.col("b")).alias("rejected_id")
    )


def with_other_endings(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a rival for each conversation: it stands under twice its id, and under the id behind that with the
    text of its last assistant turn replaced by that of the conversation whose id differs in the last bit.

    One that lacks an assistant turn, or whose neighbour does, stands alone. Of several last turns of one number the greatest text
    is handed over and all are replaced. Ids below 2^62.
    """
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    last = rows.where(F.col("role") == ASSISTANT).groupBy("conv_id").agg(F.max(F.struct("turn", "text")).alias("said"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("said.text").alias("other"))
    swap = last.select("conv_id", F.col("said.turn").alias("last")).join(other, "conv_id")
    ends = (F.col("role") == ASSISTANT) & F.col("turn").eqNullSafe(F.col("last"))
    rivals_of = rows.join(swap, "conv_id").select((F.col("conv_id") * 2 + 1).alias("conv_id"), "turn", "role", F.when(ends, F.col("other")).otherwise(F.col("text")).alias("text"))
    return rows.withColumn("conv_id", F.col("conv_id") * 2).unionByName(rivals_of)


def common_turns(one: Column, two: Column) -> Column:
    """Length of the longest common prefix of two arrays of turns."""
    same = F.zip_with(one, two, lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    step = lambda acc, s: F.struct((acc["n"] + F.when(acc["on"] & s, 1).otherwise(0)).alias("n"), (acc["on"] & s).alias("on"))
    return F.aggregate(same, start, step, lambda acc: acc["n"])


def rendered(t: Column) -> Column:
    return F.concat(F.lit(HEAD), t["role"], F.lit(MIDDLE), t["text"], F.lit(TAIL))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def _mask(prompt: Column, turns: Column) -> Column:
    """Ranges of the assistant's words in prompt + turns."""
    start = F.struct(F.length(prompt).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        end = acc["at"] + F.length(rendered(t))
        own = F.struct((acc["at"] + len(HEAD) + F.length(t["role"]) + len(MIDDLE)).alias("start"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(t["role"] == ASSISTANT, F.concat(acc["out"], F.array(own))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(turns, start, step, lambda acc: acc["out"])


def formatted(turns: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """(chosen_id, rejected_id, n_prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) per pair.

    `pairs` has chosen_id and rejected_id (null for none); without it, `rivals` pairs the conversations.
    """
    convs = conversations(turns)
    pairs = rivals(convs) if pairs is None else pairs.select("chosen_id", "rejected_id")
    chosen = pairs.join(convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c")), "chosen_id")
    others = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    # Rows without a partner, perhaps most of them, would all meet at the NULL key of the join.
    alone = chosen.where("rejected_id IS NULL").withColumn("r", F.lit(None).cast(others.schema["r"].dataType))
    both = chosen.where("rejected_id IS NOT NULL").join(others, "rejected_id", "left").unionByName(alone)
    last = F.array_max(F.transform("c", lambda t, i: F.when(t["role"] == ASSISTANT, i).otherwise(-1)))
    most = F.when(last >= 0, last).otherwise(F.size("c"))
    cut = both.withColumn("n", F.when(F.col("r").isNull(), most).otherwise(common_turns(F.col("c"), F.col("r"))))
    rest = lambda x: F.slice(x, F.col("n") + 1, F.greatest(F.size(x) - F.col("n"), F.lit(0)))
    split = cut.select("chosen_id", "rejected_id", "n", _text(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"), rest("c").alias("c"), F.when(F.col("r").isNotNull(), rest("r")).alias("r"))
    return split.select(
        "chosen_id", "rejected_id", F.col("n").alias("n_prompt_turns"), "prompt", _text(F.col("c")).alias("chosen"), _text(F.col("r")).alias("rejected"),
        _mask(F.col("prompt"), F.col("c")).alias("chosen_mask"), _mask(F.col("prompt"), F.col("r")).alias("rejected_mask"),
    )
