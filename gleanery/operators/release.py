"""What is published: dataset rows, their metadata, counts; what is still to be judged or dumped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .planning import batches, numbered
from .selection import distributions, pooled
from .state import eligible, outstanding


def dataset_rows(taken: DataFrame) -> DataFrame:
    """(id, messages): question and answer as two turns."""
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return taken.select("id", F.array(turn("user", "question"), turn("assistant", "answer")).alias("messages"))


def meta_rows(taken: DataFrame, checks: DataFrame, code: DataFrame, overrides: DataFrame, version: str) -> DataFrame:
    """One row of metadata per example; ``verified`` is worked out from the tables of checks (id, hard), no row of code checks counting as passed."""
    own = checks.groupBy("id").agg(F.max(F.size("hard")).alias("_hard"))
    compiled = code.groupBy("id").agg(F.max(F.size("hard")).alias("_code"))
    manual = overrides.select("id", F.lit(True).alias("_manual")).distinct()
    x = taken.join(own, "id", "left").join(compiled, "id", "left").join(manual, "id", "left")
    verified = F.struct(
        F.coalesce(F.col("_hard") == 0, F.lit(False)).alias("deterministic_checks"), (F.coalesce("_code", F.lit(0)) == 0).alias("code_check"),
        F.col("judge"), F.col("verdict").alias("judge_verdict"), F.coalesce("_manual", F.lit(False)).alias("manual"),
    )
    return x.select("id", F.col("area").alias("topic"), "focus", "type", "difficulty", F.lit(version).alias("version"), F.col("source_key").alias("source"), F.col("sources").alias("grounding"), verified.alias("verified"))


def final_order(taken: DataFrame) -> DataFrame:
    """Sorted by area and id as people sort, not by code points; ids break ties."""
    return taken.orderBy(F.collate(F.concat("area", F.col("id").cast("string")), "UNICODE"), "id")


def metadata(taken: DataFrame, tokens_a_word: float = 1.4, created: Column | None = None) -> DataFrame:
    """One row: examples, words, tokens, the time of ``created`` (now, if asked for as ``F.current_timestamp()``), and the distributions of
    difficulty, type, area, judge and verdict as maps."""
    keys = ["difficulty", "type", "area", "judge", "verdict"]
    counts = taken.agg(F.count(F.lit(1)).alias("examples"), F.coalesce(F.sum(T.word_count(F.concat_ws(" ", "question", "answer"))), F.lit(0)).cast("long").alias("words"))
    by = distributions(taken.withColumn("area", pooled(F.col("area"))), keys)
    maps = by.agg(*[F.map_from_entries(F.array_sort(F.collect_list(F.when((F.col("key") == k) & F.col("value").isNotNull(), F.struct("value", "n"))))).alias(k) for k in keys])
    out = counts.join(maps, F.lit(True), "left").withColumn("tokens", T.js_round(F.col("words") * F.lit(tokens_a_word)))
    return out if created is None else out.withColumn("created", T.iso_time(created))


def write_release(taken: DataFrame, meta: DataFrame, path: str) -> None:
    """dataset, dataset.meta and metadata under ``path``, as JSON lines, each a new version of what is there."""
    dataset_rows(final_order(taken)).write.mode("overwrite").json(f"{path}/dataset")
    meta.write.mode("overwrite").json(f"{path}/dataset.meta")
    metadata(taken, created=F.current_timestamp()).write.mode("overwrite").json(f"{path}/metadata")


def judge_work(answers: DataFrame, judged: DataFrame, kept: DataFrame, checks: DataFrame, code: DataFrame, local: str | None = None) -> DataFrame:
    """Answers that are not judged, belong to a kept question and passed their checks (no row of code checks counts as passed).

    With ``local``, those that a model of that name's beginning wrote are left to other judges.
    """
    out = eligible(eligible(outstanding(answers, judged, "id"), kept, "id"), checks.where(F.size("hard") == 0), "id")
    out = out.join(code.where(F.size("hard") > 0).select("id").distinct(), "id", "left_anti")
    return out if local is None else out.where(~F.coalesce(F.startswith("model", F.lit(local)), F.lit(False)))


def judge_batches(work: DataFrame, size: int = 8, order: list | None = None, local: str = "local/") -> DataFrame:
    """Batches within the writer's model, those of local writers last: adds batch, pos and turn (0, then 1)."""
    w = work.withColumn("model", F.coalesce("model", F.lit("?")))
    return batches(w, size, order or [F.col("id")], ["model"]).withColumn("turn", F.startswith("model", F.lit(local)).cast("int"))


def take(work: DataFrame, order: list, limit: int | None = None, reverse: bool = False) -> DataFrame:
    """The first ``limit`` rows of a work list in order, or in reverse order; all of them without a limit."""
    ends = [_reversed(c) for c in order] if reverse else order
    return work.orderBy(*ends) if limit is None else work.orderBy(*ends).limit(limit)


def _reversed(c) -> Column:
    return F.desc(c) if isinstance(c, str) else c.desc()


def still_open(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows to be written whose key is not among ``done``, read anew just before the write: what others wrote meanwhile stays, one row per key."""
    return outstanding(rows, done, key).dropDuplicates([key])


def judge_for(writer: Column, judges: list[str]) -> Column:
    """The first judge that is not the writer, row by row; null if there is none."""
    return F.get(F.filter(F.array(*[F.lit(j) for j in judges]), lambda j: ~j.eqNullSafe(writer)), F.lit(0))


def dump(source: DataFrame, reviewed: DataFrame, n: int, seq: str = "seq") -> DataFrame:
    """The last ``n`` rows without a review, numbered from 1 as k, for people to decide on; this table is the cursor that their decisions refer to."""
    last = outstanding(source, reviewed, "id").orderBy(F.col(seq).desc(), F.col("id").desc()).limit(n)
    return numbered(last, [F.col(seq), F.col("id")]).withColumn("k", (F.col("n") + 1).cast("int")).drop("n")


def dump_lines(dumped: DataFrame) -> DataFrame:
    """k|type|first letter of the difficulty|question, in order."""
    return dumped.orderBy("k").select(F.concat_ws("|", F.col("k").cast("string"), "type", F.left("difficulty", F.lit(1)), "question").alias("value"))
