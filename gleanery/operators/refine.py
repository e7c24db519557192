"""The refine loop: rewrite, check, compile, judge, decide, until accepted or given up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.tables import materialize
from .selection import gates_ok

#: What a failure label means to a writer, by what stands before the colon; {v} is the rest. Fixed kinds, own wording.
REASONS = {
    "insufficient": "The last reply was INSUFFICIENT; the context is wider now, answer from it.",
    "too-short": "The answer is too short to help.",
    "artifact": "It has a phrase that must not occur: of the context, of an AI, a placeholder or filler.",
    "bad-link": "The link {v} is none of the allowed pages; use an allowed one or none.",
    "bad-import": "The import {v} does not exist.",
    "unknown-apis": "These identifiers are documented nowhere: {v}.",
    "unclosed-fence": "A code block is left open.",
}
VERDICT = "struct<verdict:string,accuracy:double,version:double,usefulness:double,concise:double,issues:string,fixed_answer:string>"


def explain(hard: Column, code_hard: Column, verdict: Column | None = None, rules: dict[str, str] | None = None) -> Column:
    """Array of sentences for labels of checks and code, and a reviewer's verdict."""

    def one(h: Column) -> Column:
        kind = F.split_part(h, F.lit(":"), F.lit(1))
        v = F.substring(h, F.length(kind) + 2, F.length(h))
        out = None
        for k, s in REASONS.items():
            said = F.replace(F.lit(s), F.lit("{v}"), v)
            out = F.when(kind == k, said) if out is None else out.when(kind == k, said)
        why = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in rules.items() for x in kv]), v), F.concat(F.lit("It uses what is removed or deprecated: "), v)) if rules else F.concat(F.lit("It uses what is removed or deprecated: "), v)
        return out.when(kind == "stale", why).otherwise(h)

    none = F.array().cast("array<string>")
    parts = [F.transform(F.coalesce(hard, none), one), F.transform(F.coalesce(code_hard, none), lambda c: F.concat(F.lit("The code fails its type check: "), c))]
    if verdict is not None:
        said = F.format_string("Reviewer: %s (accuracy %.0f, version %.0f, usefulness %.0f, concise %.0f). %s", verdict["verdict"], verdict["accuracy"], verdict["version"], verdict["usefulness"], verdict["concise"], F.coalesce(verdict["issues"], F.lit("")))
        parts.append(F.when(verdict.isNotNull(), F.array(said)).otherwise(none))
    return F.concat(*parts)


def work_list(questions: DataFrame, answers: DataFrame, checks: DataFrame, code: DataFrame, judge: DataFrame, fix_checks: DataFrame, fix_code: DataFrame, refine: DataFrame) -> DataFrame:
    """What is to be refined from the current state, one row per id: answer, sources, model, problems, mode, round, low_use. All tables hold one row per id."""
    p = lambda df, name, *cols: df.select("id", F.struct(*cols).alias(name))
    none = F.array().cast("array<string>")
    j = ("verdict", "accuracy", "version", "usefulness", "concise", "issues", "fixed_answer")
    x = questions.select("id").join(p(refine, "r", "answer", "sources", "model", "problems", "status", "round", "low_use"), "id", "left").join(p(answers, "a", "answer", "sources", "model"), "id", "left").join(p(checks, "c", "hard"), "id", "left")
    x = x.join(p(code, "k", "hard"), "id", "left").join(p(judge, "j", *j), "id", "left").join(p(fix_checks, "fc", "hard"), "id", "left").join(p(fix_code, "fk", "hard"), "id", "left")
    hard, code_hard = F.coalesce("c.hard", none), F.coalesce("k.hard", none)
    v = F.col("j")
    ok = gates_ok(v)
    failed = (F.size(hard) > 0) | (F.size(code_hard) > 0)
    fix_ok = (F.coalesce(v["fixed_answer"], F.lit("")) != "") & F.col("fc").isNotNull() & (F.coalesce(F.size("fc.hard"), F.lit(0)) < 1) & (F.coalesce(F.size("fk.hard"), F.lit(0)) < 1)
    problems = (
        F.when(failed, explain(hard, code_hard)).when((v["verdict"] == "fix") & ~(fix_ok & ok), explain(F.col("fc.hard"), F.col("fk.hard"), v))
        .when(v.isNotNull() & (v["verdict"] != "fix") & ((v["verdict"] == "reject") | ~ok), explain(none, none, v))
    )
    going = F.col("r").isNotNull()
    x = x.withColumn("_p", F.when(~going & F.col("a").isNotNull() & F.col("c").isNotNull(), problems))
    x = x.where((going & F.col("r.status").isin("retry", "verify")) | F.col("_p").isNotNull())
    return x.select(
        "id", F.when(going, F.col("r.answer")).otherwise(F.col("a.answer")).alias("answer"), F.when(going, F.col("r.sources")).otherwise(F.col("a.sources")).alias("sources"), F.when(going, F.col("r.model")).otherwise(F.col("a.model")).alias("model"), F.when(going, F.col("r.problems")).otherwise(F.col("_p")).alias("problems"),
        F.when(going, F.col("r.status")).otherwise(F.lit("retry")).alias("mode"), F.when(going, F.col("r.round")).otherwise(F.lit(0)).cast("int").alias("round"),
        F.when(going, F.coalesce(F.col("r.low_use"), F.lit(0))).otherwise(F.when(v["usefulness"] <= 2, 1).otherwise(0)).cast("int").alias("low_use"),
    )


def decide(judged: DataFrame, max_rounds: int = 4) -> DataFrame:
    """The next state of rows with answer, sources, model, problems, round, low_use, hard, soft, code_hard, verdict and judge: accepted, verify, retry or gave-up."""
    none = F.array().cast("array<string>")
    v = F.col("verdict")
    clean = (F.size("hard") < 1) & (F.size("code_hard") < 1)
    accepted = F.coalesce(clean & (v["verdict"] == "pass") & gates_ok(v), F.lit(False))
    verify = F.coalesce(~accepted & (v["verdict"] == "fix") & (F.coalesce(v["fixed_answer"], F.lit("")) != "") & (v["usefulness"] >= 4), F.lit(False))
    low = F.when(accepted, F.col("low_use")).otherwise(F.col("low_use") + F.when(F.coalesce(v["usefulness"] <= 2, F.lit(False)), 1).otherwise(0))
    why = explain(F.col("hard"), F.col("code_hard"), v)
    d = judged.withColumns({"_ok": accepted, "_fix": verify, "_low": low, "_why": why})
    status = F.when(F.col("_ok"), "accepted").when((F.col("round") >= max_rounds) | (F.col("_low") >= 2), "gave-up").when(F.col("_fix"), "verify").otherwise("retry")
    return d.select(
        "id", "round", F.when(F.col("_fix") & (status == "verify"), v["fixed_answer"]).otherwise(F.col("answer")).alias("answer"), F.when(F.col("_fix") & (status == "verify"), F.col("judge")).otherwise(F.col("model")).alias("model"),
        "sources", "hard", "soft", "code_hard", "verdict", status.alias("status"), F.when(F.col("_ok"), none).when(~F.col("_fix") & (F.size("_why") > 0), F.col("_why")).otherwise(F.col("problems")).alias("problems"), F.col("_low").cast("int").alias("low_use"),
    )


Stage = Callable[[DataFrame], DataFrame]


def refine(items: DataFrame, rewrite: Stage, check: Stage, compile_code: Stage, judge: Stage, max_rounds: int = 4) -> DataFrame:
    """Runs the loop over a work list; returns every round's rows, with seq in order, so the latest per id is its state.

    ``rewrite`` gives (id, answer, model, and sources if it has new ones) for what it could write, of retry rows; what it could not waits unchanged. ``check`` gives (id, hard, and
    soft if it has any), ``compile_code`` (id, hard) of clean rows only, so no row keeps the code errors of an earlier text. ``judge`` gives (id, verdict, judge) of rows that passed both;
    without a verdict a row is retried. State is one row per id, written each round.
    """
    texts_of = "array<string>"
    none = F.array().cast(texts_of)
    if "sources" not in items.columns:
        items = items.withColumn("sources", F.lit(None).cast(texts_of))
    waiting, log = materialize(items, "refine-items"), None
    for turn in range(1, max_rounds + 1):
        if waiting.isEmpty():
            break
        todo = waiting.where("mode = 'retry'")
        new = rewrite(todo)
        said_sources = F.col("sources").cast(texts_of) if "sources" in new.columns else F.lit(None).cast(texts_of)
        new = materialize(new.select("id", F.col("answer").alias("_a"), F.col("model").alias("_m"), said_sources.alias("_s")), "refine-rewritten")
        texts = todo.join(new, "id").withColumns({"answer": F.col("_a"), "model": F.col("_m"), "sources": F.coalesce("_s", "sources")}).drop("_a", "_m", "_s").unionByName(waiting.where("mode = 'verify'")).withColumn("round", F.col("round") + 1)
        texts = materialize(texts, "refine-texts")
        checked = check(texts)
        soft = F.coalesce("soft", none) if "soft" in checked.columns else none
        x = materialize(texts.join(checked.select("id", "hard", soft.alias("soft")), "id", "left").withColumns({"hard": F.coalesce("hard", none), "soft": F.coalesce("soft", none)}), "refine-checked")
        built = compile_code(x.where(F.size("hard") < 1)).select("id", F.col("hard").alias("code_hard"))
        x = materialize(x.join(built, "id", "left").withColumn("code_hard", F.coalesce("code_hard", none)), "refine-built")
        said = judge(x.where((F.size("hard") < 1) & (F.size("code_hard") < 1))).select("id", F.col("verdict").cast(VERDICT).alias("verdict"), "judge")
        state = materialize(decide(x.join(said, "id", "left"), max_rounds).withColumn("seq", F.lit(turn)), "refine-state")
        log = state if log is None else log.unionByName(state)
        going = state.where(F.col("status").isin("retry", "verify")).select("id", "answer", "sources", "model", "problems", F.col("status").alias("mode"), "round", "low_use")
        waiting = materialize(going.unionByName(todo.join(new.select("id"), "id", "left_anti").select(*going.columns)), "refine-items")
    return log
