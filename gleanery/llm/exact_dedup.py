"""Exact deduplication by distributed most-significant-digit radix partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import heavy_join, materialize, whole_text

#: ASCII white space, deleted before texts are compared.
WHITE = r"[\x20\x09-\x0D]"


def radix_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", first: int = 64, factor: int = 8) -> DataFrame:
    """Groups of rows whose texts are equal once white space is deleted; one row per input row.

    The first digit is the byte length with the first ``first`` bytes; each further round splits
    the groups that are left by their next bytes, ``factor`` times as many as the round before.
    A row leaves as soon as its group has one row or its bytes have ended, so equality is decided
    by the bytes alone, without a digest. Only rows that still share all their bytes so far are
    read by a later round. Digits grow, so the rounds are as many as the logarithm of the longest text and not its length;
    a round ships the digit alone to its count, while rows stay with the bytes that they still have. A group is never gathered: a round
    counts (group, digit) with pre-aggregation and joins the counts back by sort-merge, whose hot keys Spark splits; the last join has
    few short columns and broadcasts the largest groups, fewer than four times the partitions.

    Returns doc_id, keep_id (of the row that stays: most code points in the original text, then
    smallest doc_id), group_size, kept, text_sha256 (of the text without white space).

    Null text counts as empty, and all empty texts are one group. Ids may be of any type that has an order; a null one loses to
    any other; rows repeated with the same doc_id count each, and exactly one row of a group is kept. No rows
    give no rows. Other columns are ignored, whatever their names.
    """
    text = whole_text(text_col)
    bare = F.regexp_replace(text, WHITE, "").cast("binary")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("n_cp"), bare.alias("rest"))
    rows = rows.select("doc_id", "n_cp", F.lit(0).cast("long").alias("gid"), F.octet_length("rest").alias("n"), F.sha2("rest", 256).alias("text_sha256"), "rest")
    done, seen, width, turn = [], 0, first, 0
    while True:
        keyed = rows.withColumn("digit", F.substring("rest", 1, width))
        split = keyed.groupBy("gid", "n", "digit").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        split = materialize(split.select("gid", "n", "digit", F.monotonically_increasing_id().alias("new")), "radix-groups")
        more = F.col("new").isNotNull() & (F.col("n") > seen + width)
        out = keyed.join(split.hint("merge"), ["gid", "n", "digit"], "left").select(
            "doc_id", "n_cp", "n", "text_sha256", F.col("new").alias("gid"), F.when(more, F.expr(f"substring(rest, {width + 1})")).alias("rest"), F.monotonically_increasing_id().alias("uid")
        )
        out = materialize(out, "radix-rows")
        ended = out.where("rest is null")
        done.append(ended.select("doc_id", "n_cp", "text_sha256", F.lit(turn).alias("turn"), "gid", "uid"))
        rows = out.where("rest is not null").drop("uid")
        if rows.isEmpty():
            break
        seen, width, turn = seen + width, width * factor, turn + 1
    ended = done[0]
    for part in done[1:]:
        ended = ended.unionByName(part)
    ended = materialize(ended, "radix-ended")
    alone = ended.where("gid is null").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    shared = ended.where("gid is not null")
    place = F.struct((-F.col("n_cp")).alias("neg"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col("uid").alias("u"))
    best = shared.groupBy("turn", "gid").agg(F.count(F.lit(1)).alias("group_size"), F.min(place).alias("best")).withColumn("c", F.col("group_size"))
    found = heavy_join(shared, materialize(best, "radix-best"), ["turn", "gid"])
    return alone.unionByName(found.select("doc_id", F.col("best.d").alias("keep_id"), "group_size", (F.col("uid") == F.col("best.u")).alias("kept"), "text_sha256"))
