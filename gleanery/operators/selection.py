"""Gates, scores and capped selection of the final set."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import materialize

#: Shares of the target by area, of all pooled areas, of any other area, and by difficulty; most per page. Fixed values.
AREA_CAPS = {"errors": 0.11, "cms": 0.035, "deploy": 0.05, "tutorial": 0.015, "migrate-from": 0.015, "upgrade-old": 0.015, "experimental": 0.01, "legacy": 0.005}
POOL_CAP, OTHER_CAP, PAGE_CAP = 0.1, 0.2, 40
DIFFICULTY = {"foundational": 0.2, "intermediate": 0.3, "advanced": 0.3, "expert": 0.2}


def gates_ok(v: Column) -> Column:
    """Accuracy, version and usefulness 4 or more, concise 3 or more; a missing one fails."""
    return F.coalesce((v["accuracy"] >= 4) & (v["version"] >= 4) & (v["usefulness"] >= 4) & (v["concise"] >= 3), F.lit(False))


def score(v: Column, soft: Column, overridden: Column) -> Column:
    """2 accuracy + 2 version + 1.5 usefulness + concise + 1 for a pass - 0.75 for each soft label + 2 for a manual override."""
    num = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return (
        num(v["accuracy"]) * 2 + num(v["version"]) * 2 + num(v["usefulness"]) * 1.5 + num(v["concise"]) + F.when(v["verdict"] == "pass", 1.0).otherwise(0.0)
        - F.coalesce(F.size(soft), F.lit(0)) * 0.75 + F.when(overridden, 2.0).otherwise(0.0)
    )


def candidates(questions: DataFrame, answers: DataFrame, checks: DataFrame, judge: DataFrame, refine: DataFrame, fix_checks: DataFrame, fix_code: DataFrame, overrides: DataFrame) -> DataFrame:
    """The gate cascade: one row per judged or refined question that has an answer, with drop_reason (null for candidates), text, question, soft, score.

    The tables hold one row per id (see ``latest_by``). Reasons in order: manual-drop, refine-<status>, judge-reject, fix-failed-checks, low-scores.
    """
    keys = judge.select("id").unionByName(refine.select("id")).distinct()
    p = lambda df, name, *cols: df.select("id", F.struct(*cols).alias(name))
    verdict = ("verdict", "accuracy", "version", "usefulness", "concise")
    x = keys.join(questions, "id").join(p(answers, "a", "answer", "sources"), "id").join(p(judge, "j", *verdict, "fixed_answer"), "id", "left").join(p(refine, "r", "status", "answer", "soft", "verdict"), "id", "left")
    x = x.join(p(checks, "c", "soft"), "id", "left").join(p(fix_checks, "fc", "hard", "soft"), "id", "left").join(p(fix_code, "fk", "hard"), "id", "left").join(p(overrides, "o", "action", "answer", "question"), "id", "left")
    refined = F.col("r").isNotNull()
    fix = ~refined & (F.col("j.verdict") == "fix")
    fix_ok = (F.coalesce(F.col("j.fixed_answer"), F.lit("")) != "") & F.col("fc").isNotNull() & (F.coalesce(F.size("fc.hard"), F.lit(0)) < 1) & (F.coalesce(F.size("fk.hard"), F.lit(0)) < 1)
    v = F.when(refined, F.struct(*[F.col(f"r.verdict.{c}").alias(c) for c in verdict])).otherwise(F.struct(*[F.col(f"j.{c}").alias(c) for c in verdict]))
    soft = F.when(refined, F.col("r.soft")).when(fix, F.col("fc.soft")).otherwise(F.col("c.soft"))
    text = F.when(refined, F.col("r.answer")).when(fix, F.col("j.fixed_answer")).otherwise(F.col("a.answer"))
    reason = (
        F.when(F.col("o.action") == "drop", "manual-drop").when(refined & (F.col("r.status") != "accepted"), F.concat(F.lit("refine-"), F.col("r.status")))
        .when(~refined & (F.col("j.verdict") == "reject"), "judge-reject").when(fix & ~fix_ok, "fix-failed-checks").when(~gates_ok(v), "low-scores")
    )
    overridden = F.col("o.answer").isNotNull() | F.col("o.question").isNotNull()
    out = x.withColumn("_v", v).withColumn("drop_reason", reason)
    return out.select(*[c for c in questions.columns if c != "question"], F.coalesce("o.question", "question").alias("question"), "drop_reason", F.trim(F.coalesce("o.answer", text)).alias("text"), soft.alias("soft"), F.when(F.col("drop_reason").isNull(), score(F.col("_v"), soft, overridden)).alias("score"), F.col("_v.verdict").alias("verdict"))


def fixed_answers(answers: DataFrame, judge: DataFrame) -> DataFrame:
    """(id, answer, sources) of the answers that a reviewer corrected, with the corrected text, to go through the checks again."""
    j = judge.where((F.col("verdict") == "fix") & (F.coalesce("fixed_answer", F.lit("")) != "")).select("id", F.col("fixed_answer").alias("answer"))
    return j.join(answers.select("id", "sources"), "id")


def drop_histogram(cands: DataFrame) -> DataFrame:
    return cands.where(F.col("drop_reason").isNotNull()).groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n"))


def pooled(area: Column, pool: str = "spec") -> Column:
    """The area, those of a pool (``pool:...``) as one."""
    return F.when(F.startswith(area, F.lit(f"{pool}:")), F.lit(pool)).otherwise(area)


def cap_of(area: Column, n: int, area_caps: dict[str, float] = AREA_CAPS, pool_cap: float = POOL_CAP, other_cap: float = OTHER_CAP, pool: str = "spec") -> Column:
    """How many of an area may be taken: its share of ``n``, that of the pool for each of its areas, else that of any other area."""
    caps = F.create_map(*[x for k, c in {**area_caps, pool: pool_cap}.items() for x in (F.lit(k), F.lit(float(c * n)))])
    return F.coalesce(F.try_element_at(caps, pooled(area, pool)), F.lit(float(other_cap * n)))


def capped(cands: DataFrame, n: int, area_caps: dict[str, float] = AREA_CAPS, pool_cap: float = POOL_CAP, other_cap: float = OTHER_CAP, page_cap: int = PAGE_CAP, difficulty: dict[str, float] = DIFFICULTY, slack: float = 1.1, rank: str = "rank", pool: str = "spec") -> DataFrame:
    """Takes up to ``n`` of (id, rank, area, page, difficulty) in order of rank, which is unique: first under caps by area, page and difficulty, then
    what is left under those by area and page. Returns the rows with pass (1 or 2).

    Areas ``pool:*`` share one cap. A count at or above its cap refuses. What differs in rank only (a cell of area, page and difficulty) is taken in order
    in both passes, and a cell gives at most its area's and page's cap; only so many of each cell enter. The passes are sequential: one task reads
    the candidates in order, a batch at a time, holds the counters of what it took, and stops as soon as ``n`` are taken. Unique ids; null areas, pages
    and difficulties are values of their own.
    """
    c = cands.withColumn("_area", pooled(F.col("area"), pool)).withColumn("_cap", cap_of(F.col("area"), n, area_caps, pool_cap, other_cap, pool))
    cell = Window.partitionBy("_area", "page", "difficulty").orderBy(rank)
    c = c.withColumn("_k", F.row_number().over(cell)).where(F.col("_k") <= F.least(F.ceil("_cap"), F.lit(page_cap)))
    small = materialize(c.select("id", F.col(rank).alias("rank"), "_area", "_cap", "page", "difficulty"), "capped-cells")
    kind = cands.schema["id"].dataType.simpleString()
    taken: list[tuple] = []
    for turn in (1, 2):
        if len(taken) < n:
            have = [tuple(r) for r in taken]
            in_order = small.repartition(1).sortWithinPartitions("rank")
            found = in_order.mapInPandas(_fold(have, turn, n, page_cap, difficulty, slack), f"id {kind}, _area string, page string, difficulty string")
            taken += [tuple(r) + (turn,) for r in found.collect()]  # n at most
    took = cands.sparkSession.createDataFrame([(r[0], r[4]) for r in taken], f"id {kind}, pass int")
    return cands.join(F.broadcast(took), "id")


def _fold(have: list[tuple], turn: int, n: int, page_cap: int, difficulty: dict[str, float], slack: float):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: list[dict] = [{}, {}, {}]
        ids = {r[0] for r in have}

        def count(*keys) -> None:
            for d, k in zip(counts, keys):
                d[k] = d.get(k, 0) + 1

        for r in have:
            count(*r[1:4])
        total = len(have)
        for pdf in parts:
            out = []
            for i, _, a, cap, page, level in pdf[["id", "rank", "_area", "_cap", "page", "difficulty"]].itertuples(index=False):
                if total >= n:
                    break
                full = counts[0].get(a, 0) >= cap or counts[1].get(page, 0) >= page_cap
                if i in ids or full or (turn == 1 and counts[2].get(level, 0) >= difficulty.get(level, float("inf")) * n * slack):
                    continue
                count(a, page, level)
                total += 1
                out.append((i, a, page, level))
            yield pd.DataFrame(out, columns=["id", "_area", "page", "difficulty"])
            if total >= n:
                return

    return run


def distributions(df: DataFrame, keys: list[str]) -> DataFrame:
    """(key, value, n): one pass of grouping sets over several columns."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys])).alias("x"))
    return long.groupBy("x.key", "x.value").agg(F.count(F.lit(1)).alias("n"))
