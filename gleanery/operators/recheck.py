"""Rejected questions looked at once more: those unlike all kept ones, by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import recheck
from .planning import numbered
from .review import improved
from .state import outstanding


def prepare(questions: DataFrame, reviews: DataFrame, threshold: float = 0.86) -> DataFrame:
    """Rejected questions that are near no kept one, and no two near each other, the earlier first.

    ``questions`` has unique ids, seq, vector and area; ``reviews`` the latest review of each (id, keep). Those without a review are left out.
    """
    keep = reviews.select("id", F.coalesce("keep", F.lit(False)).alias("_keep"))
    all_ = questions.join(keep, "id")
    free = recheck(all_.where("not _keep").withColumn("rank", F.col("seq")), all_.where("_keep"), threshold)
    return questions.join(free.select("id"), "id", "left_semi")


def dump(ready: DataFrame, done: DataFrame, n: int = 200) -> DataFrame:
    """The next ``n`` by area, then seq, that are not ``done``, numbered from 1 as k; this table is the cursor that decisions refer to."""
    left = outstanding(ready, done, "id").orderBy("area", "seq", "id").limit(n)
    return numbered(left, [F.col("area"), F.col("seq"), F.col("id")]).withColumn("k", (F.col("n") + 1).cast("int")).drop("n")


def apply(dumped: DataFrame, decisions: DataFrame, reviewer: str = "manual-recheck") -> tuple[DataFrame, DataFrame]:
    """(restored, done): review rows (id, keep, reason, question, reviewer) for what decisions keep (k) or keep in other words (i), and the ids looked at.

    Questions without a decision, or with another one, stay rejected. The last decision on a number counts.
    """
    last = decisions.where(F.col("action").isin("k", "i")).groupBy("k").agg(F.max_by(F.struct("action", "rest"), "seq").alias("d"))
    x = dumped.join(last, "k")
    wording = F.col("d.rest") if "question" not in dumped.columns else improved(F.col("d.rest"), F.col("question"))
    restored = x.select("id", F.lit(True).alias("keep"), F.lit("restored").alias("reason"), F.when(F.col("d.action") == "i", wording).alias("question"), F.lit(reviewer).alias("reviewer"))
    return restored, dumped.select("id")
