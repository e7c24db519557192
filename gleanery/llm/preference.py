"""Preference pairs of conversations, rendered as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REFUSAL = "I can't help with that."


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as role and text.

    Turns with equal numbers are ordered by role and text; repeated rows are turns each; a null turn number comes first, a null role or text
    is empty. A turn without a conv_id is a conversation of its own, so those are never gathered. No rows give no rows; other columns are ignored.
    """
    said = F.struct(F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    t = turns.select(F.col(id_col).alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), said["role"].alias("role"), said["text"].alias("text")).alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    whole = t.where(F.col("conv_id").isNotNull()).groupBy("conv_id").agg(ordered.alias("turns"))
    return whole.unionByName(t.where(F.col("conv_id").isNull()).select("conv_id", F.array(F.struct(F.col("t.role").alias("role"), F.col("t.text").alias("text"))).alias("turns")))


def self_negatives(convs: DataFrame, refusal: str = REFUSAL) -> DataFrame:
    """(pair_id, chosen, rejected) from conversations alone: up to and with the last answer, against the same with the answer before it,
    or ``refusal`` where there is none, in its place. A conversation without an answer, or without turns, is paired with itself; null and
    repeated ids come back as they are; no rows give no rows."""
    answer = F.transform("turns", lambda x: x["role"] == "assistant")
    c = convs.withColumn("last", F.size("turns") - F.array_position(F.reverse(answer), True).cast("int") + 1).withColumn("last", F.when(F.array_contains(answer, True), F.col("last")).otherwise(F.lit(0)))
    head = F.expr("slice(turns, 1, greatest(last - 1, 0))")
    earlier = F.filter(head, lambda x: x["role"] == "assistant")
    other = F.struct(F.lit("assistant").alias("role"), F.coalesce(F.try_element_at(earlier, F.lit(-1))["text"], F.lit(refusal)).alias("text"))
    return c.select(F.col("conv_id").alias("pair_id"), F.when(F.col("last") > 0, F.expr("slice(turns, 1, last)")).otherwise(F.col("turns")).alias("chosen"), F.when(F.col("last") > 0, F.concat(head, F.array(other))).otherwise(F.col("turns")).alias("rejected"))


def _clean(text: Column) -> Column:
    """Marks of the template within a text are broken up."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda x: F.concat(F.lit("<|"), _clean(x["role"]), F.lit("|>\n"), _clean(x["text"]), F.lit("<|end|>\n"))), "")


def _mask(turns: Column) -> Column:
    """Spans of code points that are learnt: each answer with its end mark."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(_clean(x["role"])) + 5
        end = start + F.length(_clean(x["text"])) + 7
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + 1).alias("at"), F.when(x["role"] == "assistant", F.concat(acc["spans"], own)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, zero, step, lambda acc: acc["spans"])


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, chosen, rejected) with turns as arrays of role and text -> pair_id, n_prompt_turns, prompt, and for both sides the completion
    and its mask, the spans of code points to learn.

    The prompt is the longest common prefix of turns, equal in role and text, rendered once; each completion is what follows
    it on its side, rendered by the same template, so prompt + completion is the whole conversation. In a completion answers and their end
    marks are learnt, other turns are not; nothing of the prompt is.

    Null turns count as none, a null role or text as empty. Equal conversations give two empty completions with empty masks; those with
    different first turns an empty prompt. Repeated pairs come back as often as they came; no pairs give no rows; other columns are ignored.
    """
    p = pairs.select("pair_id", *[F.coalesce(F.filter(c, lambda x: x.isNotNull()), F.array().cast("array<struct<role:string,text:string>>")).alias(c) for c in ("chosen", "rejected")])
    for c in ("chosen", "rejected"):
        p = p.withColumn(c, F.transform(c, lambda x: F.struct(F.coalesce(x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text"))))
    n = F.least(F.size("chosen"), F.size("rejected"))
    same = F.zip_with(F.slice("chosen", F.lit(1), n), F.slice("rejected", F.lit(1), n), lambda a, b: a == b)
    differ = F.array_position(same, False).cast("int")
    p = p.withColumn("n_prompt_turns", F.when(differ > 0, differ - 1).otherwise(n))
    p = p.withColumn("_c", F.expr("slice(chosen, n_prompt_turns + 1, size(chosen))")).withColumn("_r", F.expr("slice(rejected, n_prompt_turns + 1, size(rejected))"))
    return p.select(
        "pair_id", "n_prompt_turns", _render(F.expr("slice(chosen, 1, n_prompt_turns)")).alias("prompt"),
        _render(F.col("_c")).alias("chosen"), _mask(F.col("_c")).alias("chosen_mask"), _render(F.col("_r")).alias("rejected"), _mask(F.col("_r")).alias("rejected_mask"),
    )
