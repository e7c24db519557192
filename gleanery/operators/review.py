"""Questions, answers and verdicts of models: prompts, parsing, acceptance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..plans.tables import dealt
from .planning import batches
from .state import improved

#: Kinds and levels of questions, and words by which a question points at its source. Fixed values.
TYPES = ["how-to", "concept", "distinction", "debugging", "configuration", "migration", "when-not-to", "architecture", "edge-case"]
LEVELS = ["foundational", "intermediate", "advanced", "expert"]
SELF_REFERENCE = r"(?i)\b(the|this) (source|page|excerpt|documentation above)\b"
VERDICT = "array<struct<i:string,verdict:string,accuracy:string,version:string,usefulness:string,concise:string,issues:string,fixed_answer:string>>"


def valid_question(q: Column, kind: Column, level: Column) -> Column:
    n = F.length(q)
    return F.coalesce((n >= 25) & (n <= 600) & kind.isin(TYPES) & level.isin(LEVELS) & ~F.regexp_like(q, F.lit(SELF_REFERENCE)), F.lit(False))


def question_rows(replies: DataFrame) -> DataFrame:
    """(source_key, source_kind, area, model, n, reply) -> valid question rows, ``n`` at most per reply; the id is a hash of the untrimmed text."""
    items = F.from_json(T.loose_json(F.col("reply")), "array<struct<question:string,type:string,difficulty:string,focus:string>>")
    valid = F.filter(items, lambda q: valid_question(q["question"], q["type"], q["difficulty"]))
    # the outer form has no filter that would parse the reply again; null positions go by the comparison
    x = dealt(replies, "reply").select("source_key", "source_kind", "area", "model", "n", F.posexplode_outer(valid).alias("_p", "q")).where(F.col("_p") < F.col("n"))
    return x.select(F.concat(F.lit("q_"), T.content_hash(F.concat("source_key", "q.question"))).alias("id"), F.trim("q.question").alias("question"), "q.type", "q.difficulty", F.left("q.focus", F.lit(120)).alias("focus"), "area", "source_key", "source_kind", "model")


def prompts(items: DataFrame, head: str, line: Column, size: int, order: list, by: list[str] | None = None) -> DataFrame:
    """Batches of ``size`` items as one prompt each: batch keys, size and prompt, with the numbered lines in order."""
    b = batches(items.withColumn("_line", line), size, order, by)
    keys = [*(by or []), "batch"]
    lines = F.transform(F.array_sort(F.collect_list(F.struct("pos", "_line"))), lambda x: F.concat(x["pos"].cast("string"), F.lit(". "), x["_line"]))
    return b.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.concat(F.lit(head + "\n"), F.array_join(lines, "\n")).alias("prompt"))


def question_prompt(source: Column, prior: Column, n: Column, about: Column | None = None) -> Column:
    """What a generator is asked: its source, what was asked of it before (an array), and how many questions are wanted; ``about`` narrows them."""
    before = F.when(F.size(prior) > 0, F.concat(F.lit("Asked before, to be neither repeated nor reworded:\n"), F.array_join(F.transform(prior, lambda q: F.concat(F.lit("* "), q)), "\n"), F.lit("\n\n"))).otherwise("")
    more = F.lit("") if about is None else F.when(F.coalesce(about, F.lit("")) != "", F.concat(about, F.lit("\n"))).otherwise("")
    return F.concat(F.lit("Text:\n"), F.coalesce(source, F.lit("")), F.lit("\n\n"), before, more, F.lit("Ask "), n.cast("string"), F.lit(" questions of different types and levels that this text answers, as a JSON array of question, type, difficulty and focus."))


def _context(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda i: F.concat(F.lit("["), i["url"], F.lit("]\n"), i["content"])), "\n\n")


def answer_item(pos: Column, question: Column, links: Column, items: Column) -> Column:
    """One question of an answer prompt with its allowed links and its context, an array of (url, content)."""
    return F.concat(F.lit("# Question "), pos.cast("string"), F.lit("\n"), question, F.lit("\nLinks allowed: "), F.array_join(links, " "), F.lit("\nContext:\n"), _context(items))


def judge_item(pos: Column, question: Column, answer: Column, sources: Column, items: Column, k: int = 3, size: int = 3500) -> Column:
    """One answer of a judge's prompt: its sources and the beginning of its best ``k`` hits."""
    seen = F.left(_context(F.slice(items, 1, k)), F.lit(size))
    return F.concat(F.lit("# Item "), pos.cast("string"), F.lit("\nQuestion: "), question, F.lit("\nAnswer: "), answer, F.lit("\nSources: "), F.array_join(F.coalesce(sources, F.array().cast("array<string>")), " "), F.lit("\nContext:\n"), seen)


def rewrite_item(pos: Column, question: Column, answer: Column, problems: Column, links: Column, items: Column) -> Column:
    """One item of a rewrite prompt: the last answer, what is wrong with it, and its context."""
    wrong = F.array_join(F.transform(problems, lambda p: F.concat(F.lit("* "), p)), "\n")
    return F.concat(F.lit("# Item "), pos.cast("string"), F.lit("\nQuestion: "), question, F.lit("\nLast answer: "), answer, F.lit("\nTo be mended:\n"), wrong, F.lit("\nLinks allowed: "), F.array_join(links, " "), F.lit("\nContext:\n"), _context(items))


def verdicts(batched: DataFrame, replies: DataFrame, keys: list[str], judge: str = "model") -> DataFrame:
    """Joins the rows of a judge's reply to the items (keys, pos, id) by their index; numbers that are none are 0, other verdicts and indices are left out."""
    items = F.from_json(T.loose_json(F.col("reply")), VERDICT)
    v = dealt(replies, *keys).select(*keys, F.col(judge).alias("judge"), F.explode_outer(items).alias("v")).where(F.col("v.verdict").isin("pass", "fix", "reject"))
    num = lambda c: T.to_number(F.col(f"v.{c}")).alias(c)
    rows = v.select(*keys, F.col("v.i").try_cast("int").alias("pos"), "judge", "v.verdict", num("accuracy"), num("version"), num("usefulness"), num("concise"), F.left(F.coalesce("v.issues", F.lit("")), F.lit(400)).alias("issues"), F.when(F.col("v.verdict") == "fix", F.col("v.fixed_answer")).alias("fixed_answer"))
    return batched.select(*keys, "pos", "id").join(rows, [*keys, "pos"]).drop(*keys, "pos")


def usable_reviews(batched: DataFrame, replies: DataFrame, keys: list[str], share: float = 0.8) -> DataFrame:
    """Review rows (id, keep, reason, question, reviewer) of replies that have ``share`` of their batch's rows or more; keep is true only if it says so."""
    items = F.from_json(T.loose_json(F.col("reply")), "array<struct<i:string,keep:boolean,reason:string,question:string>>")
    enough = T.let(items, lambda x: F.when(F.size(x) >= F.col("size") * share, x))
    rows = dealt(replies, *keys).select(*keys, F.col("model").alias("reviewer"), F.explode_outer(enough).alias("v")).where("v is not null").select(*keys, "reviewer", F.col("v.i").try_cast("int").alias("pos"), "v.keep", "v.reason", F.col("v.question").alias("_new"))
    x = batched.select(*keys, "pos", "id", "question").join(rows, [*keys, "pos"])
    return x.select("id", F.coalesce("keep", F.lit(False)).alias("keep"), F.left(F.coalesce("reason", F.lit("")), F.lit(120)).alias("reason"), improved(F.col("_new"), F.col("question")).alias("question"), "reviewer")


def section_answers(batched: DataFrame, replies: DataFrame, keys: list[str], tag: str = "ANSWER") -> DataFrame:
    """Answers (id, answer, model) from replies with half of their batch's sections or more; items without a section are left for the next run."""
    enough = T.let(T.split_sections(F.col("reply"), tag), lambda s: F.when(F.size(s) >= F.ceil(F.col("size") / 2), s))
    rows = dealt(replies, *keys).select(*keys, "model", F.explode_outer(enough).alias("pos", "answer")).where("pos is not null")
    return batched.select(*keys, "pos", "id").join(rows, [*keys, "pos"]).where(F.trim("answer") != "").select("id", F.trim("answer").alias("answer"), "model")


def apply_decisions(dumped: DataFrame, decisions: DataFrame, reviewer: str = "manual") -> DataFrame:
    """Review rows for dumped questions (k, id, question) from decisions (k, action, rest, seq), the last of each k: d drops, i improves the wording, others keep."""
    last = decisions.groupBy("k").agg(F.max_by(F.struct("action", "rest"), "seq").alias("d"))
    x = dumped.join(last, "k", "left")
    return x.select("id", F.coalesce(F.col("d.action") != "d", F.lit(True)).alias("keep"), F.when(F.col("d.action") == "d", F.left("d.rest", F.lit(120))).otherwise(F.lit("")).alias("reason"), F.when(F.col("d.action") == "i", improved(F.col("d.rest"), F.col("question"))).alias("question"), F.lit(reviewer).alias("reviewer"))
