"""Queries of the curation steps: each runs an operator over rows built from the test tables and has its DuckDB SQL.

Rows that both engines need are written as one SELECT in the SQL that they share; what an operator makes of them is stated anew in DuckDB's.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import checks, code, planning, recheck, refine, release, retrieval, review, selection, state, validate
from .plans.progress import Progress
from .plans.stages import Plan
from .plans.tables import materialize, scratch
from .registry import SQL, as_duckdb, big, query, read, shared_sql
from .sources import jsonl, models, tools
from .streaming import streams

#: A question for every document, with its kind, level, area and source.
QUESTIONS = """SELECT lpad(CAST(doc_id AS STRING), 8, '0') AS id, doc_id AS seq,
CASE WHEN doc_id % 11 = 0 THEN 'Why so?' WHEN doc_id % 11 = 1 THEN 'What does this page say of item ' || CAST(doc_id AS STRING) || '?' ELSE '  How is item ' || CAST(doc_id AS STRING) || ' of ' || source || ' set up in ' || lang || '? ' END AS question,
CASE doc_id % 6 WHEN 0 THEN 'how-to' WHEN 1 THEN 'concept' WHEN 2 THEN 'debugging' WHEN 3 THEN 'migration' WHEN 4 THEN 'trivia' ELSE 'edge-case' END AS type,
CASE doc_id % 4 WHEN 0 THEN 'foundational' WHEN 1 THEN 'intermediate' WHEN 2 THEN 'advanced' ELSE 'expert' END AS difficulty,
CASE doc_id % 5 WHEN 0 THEN 'spec:net' WHEN 1 THEN 'spec:html' WHEN 2 THEN 'errors' WHEN 3 THEN 'guides' ELSE 'upgrade-old' END AS area,
'https://docs.test/' || source || '/' AS source_key, CASE WHEN doc_id % 5 <= 1 THEN 'spec' ELSE 'docs' END AS source_kind,
CASE doc_id % 3 WHEN 0 THEN 'local/a' WHEN 1 THEN 'm1' ELSE 'm2' END AS model, lang FROM {documents}"""
_Q = f"q AS ({as_duckdb(QUESTIONS)})"
_TYPES, _LEVELS = (", ".join(f"'{x}'" for x in xs) for xs in (review.TYPES, review.LEVELS))


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return shared_sql(spark, d, QUESTIONS)


def _texts(*labels: str) -> Column:
    return F.array(*[F.lit(x) for x in labels]).cast("array<string>")


def _none() -> Column:
    return F.array().cast("array<string>")


def _listed(rows: DataFrame, keys: list[str], item: Column) -> DataFrame:
    """A reply per key: the items in order of pos, as a model would write them around JSON."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("item")))), lambda x: x["item"]), ",")
    return rows.groupBy(*keys).agg(F.concat(F.lit("Here they are:\n```json\n["), lines, F.lit("]\n```")).alias("reply"), F.count(F.lit(1)).alias("size")).withColumn("model", F.lit("stub"))


# Questions and their review


@query(f"""WITH {_Q}, b AS (SELECT *, (row_number() OVER (PARTITION BY source_key ORDER BY seq) - 1) // 6 AS batch FROM q),
v AS (SELECT *, row_number() OVER (PARTITION BY source_key, batch ORDER BY seq) AS k FROM b WHERE length(question) BETWEEN 25 AND 600 AND type IN ({_TYPES}) AND difficulty IN ({_LEVELS})
      AND NOT regexp_matches(question, '(?i)\\b(the|this) (source|page|excerpt|documentation above)\\b'))
SELECT 'q_' || substr(sha256(source_key || question), 1, 10) AS id, trim(question) AS question, type, difficulty, 'focus ' || id AS focus, source_key FROM v WHERE k <= 3""")
def question_rows(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a stub that was asked for three questions and wrote six, of which some are no valid ones."""
    b = planning.batches(_questions(spark, d), 6, [F.col("seq")], ["source_key"])
    item = F.to_json(F.struct("question", "type", "difficulty", F.concat(F.lit("focus "), "id").alias("focus")))
    replies = _listed(b, ["source_key", "batch"], item).select("source_key", F.lit("docs").alias("source_kind"), F.lit("guides").alias("area"), "model", F.lit(3).alias("n"), "reply")
    return review.question_rows(replies).select("id", "question", "type", "difficulty", "focus", "source_key")


@query(f"""WITH {_Q}, r AS (SELECT id, seq * 4 AS seq, seq % 5 <> 0 AS keep, CASE WHEN seq % 7 = 0 THEN 'A better wording of ' || id END AS question FROM q
UNION ALL SELECT id, seq * 4 + 1, seq % 2 = 0, NULL FROM q WHERE seq % 3 = 0), l AS (SELECT id, arg_max(keep, seq) AS keep, arg_max(question, seq) FILTER (WHERE question IS NOT NULL) AS w FROM r GROUP BY id)
SELECT q.id, coalesce(l.w, q.question) AS question FROM q JOIN l ON l.id = q.id WHERE l.keep""")
def kept_questions(spark: SparkSession, d: str) -> DataFrame:
    q = _questions(spark, d)
    first = q.select("id", (F.col("seq") * 4).alias("seq"), (F.col("seq") % 5 != 0).alias("keep"), F.when(F.col("seq") % 7 == 0, F.concat(F.lit("A better wording of "), "id")).alias("question"))
    again = q.where("seq % 3 = 0").select("id", (F.col("seq") * 4 + 1).alias("seq"), (F.col("seq") % 2 == 0).alias("keep"), F.lit(None).cast("string").alias("question"))
    return state.kept_questions(q, first.unionByName(again)).select("id", "question")


@query(f"""WITH {_Q}, b AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY seq) - 1 AS n FROM q), c AS (SELECT *, n // 40 AS batch, n % 40 + 1 AS pos FROM b),
s AS (SELECT lang, batch, count(*) AS size, count(*) FILTER (WHERE NOT (batch % 2 = 1 AND pos % 3 = 0)) AS given FROM c GROUP BY ALL)
SELECT c.id, coalesce(c.seq % 4 <> 0, false) AS keep, left('reason ' || repeat('r', 200), 120) AS reason, CASE WHEN c.seq % 3 = 0 THEN 'A much better wording of ' || c.id END AS question FROM c JOIN s ON s.lang = c.lang AND s.batch = c.batch
WHERE s.given >= 0.8 * s.size AND NOT (c.batch % 2 = 1 AND c.pos % 3 = 0)""")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    """Reviews in batches of 40; a reply that leaves out a third of its batch is refused as a whole."""
    b = planning.batches(_questions(spark, d), 40, [F.col("seq")], ["lang"])
    wording = F.when(F.col("seq") % 3 == 0, F.concat(F.lit("A much better wording of "), "id")).when(F.col("seq") % 3 == 1, "too short").otherwise(F.col("question"))
    item = F.to_json(F.struct(F.col("pos").cast("string").alias("i"), (F.col("seq") % 4 != 0).alias("keep"), F.concat(F.lit("reason "), F.repeat(F.lit("r"), F.lit(200))).alias("reason"), wording.alias("question")))
    replies = _listed(b.where(~((F.col("batch") % 2 == 1) & (F.col("pos") % 3 == 0))), ["lang", "batch"], item)
    sizes = b.groupBy("lang", "batch").agg(F.count(F.lit(1)).alias("size"))
    out = review.usable_reviews(b, replies.drop("size").join(sizes, ["lang", "batch"]), ["lang", "batch"])
    return out.select("id", "keep", "reason", "question")


@query(f"""WITH {_Q}, l AS (SELECT * FROM q ORDER BY seq DESC LIMIT 150), k AS (SELECT *, row_number() OVER (ORDER BY seq) AS k FROM l)
SELECT id, k % 5 <> 0 AS keep, CASE WHEN k % 5 = 0 THEN 'vague ' || k ELSE '' END AS reason, CASE WHEN k % 5 = 1 THEN 'A wording by hand for number ' || k END AS question FROM k""")
def manual_decisions(spark: SparkSession, d: str) -> DataFrame:
    """A dump of the last 150 questions, a file of decisions on them, and what these make of it; the last decision on a number counts."""
    q = _questions(spark, d)
    dumped = materialize(release.dump(q, q.limit(0), 150), "dump")
    k = F.col("k").cast("string")
    line = F.when(F.col("k") % 5 == 0, F.concat(k, F.lit(" d vague "), k)).when(F.col("k") % 5 == 1, F.concat(k, F.lit(" i A wording by hand for number "), k)).when(F.col("k") % 5 == 2, F.concat(k, F.lit(" k"))).when(F.col("k") % 5 == 3, F.concat(F.lit("not "), k))
    early = dumped.select(F.concat(k, F.lit(" d at first")).alias("value"), F.lit(0).alias("o"), "k").where("k % 5 in (1, 2)")
    path = scratch(spark, "decisions")
    early.unionByName(dumped.select(line.alias("value"), F.lit(1).alias("o"), "k").where("value is not null")).repartition(1).sortWithinPartitions("o", "k").select("value").write.text(path)
    return review.apply_decisions(dumped, jsonl.read_decisions(spark, path)).select("id", "keep", "reason", "question")


@query(f"""WITH {_Q}, b AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY seq) - 1 AS n FROM q), c AS (SELECT *, n // 6 AS batch, n % 6 + 1 AS pos FROM b),
s AS (SELECT model, batch, count(*) AS size, count(*) FILTER (WHERE pos > batch % 5) AS given FROM c GROUP BY ALL)
SELECT c.id, 'Answer to ' || c.id || chr(10) || 'in two lines' AS answer FROM c JOIN s ON s.model = c.model AND s.batch = c.batch WHERE c.pos > c.batch % 5 AND s.given >= ceil(s.size / 2)""")
def section_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers in batches of six within the model; replies lack up to four sections, and those that lack over half are left for the next run."""
    b = planning.batches(_questions(spark, d), 6, [F.col("seq")], ["model"])
    section = F.concat(F.lit("=====ANSWER "), F.col("pos").cast("string"), F.lit("=====\nAnswer to "), "id", F.lit("\nin two lines\n"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", section.alias("s")))), lambda x: x["s"]), "\n")
    sizes = b.groupBy("model", "batch").agg(F.count(F.lit(1)).alias("size"))
    replies = b.where("pos > batch % 5").groupBy("model", "batch").agg(F.concat(F.lit("Well:\n"), said).alias("reply")).join(sizes, ["model", "batch"])
    return review.section_answers(b, replies, ["model", "batch"]).select("id", "answer")


# Prompts


@query(f"""WITH {_Q}, p AS (SELECT *, array_to_string(list_transform(list_slice(list(id) OVER (PARTITION BY source_key ORDER BY seq ROWS UNBOUNDED PRECEDING EXCLUDE CURRENT ROW), -3, -1), lambda x: '* ' || x), chr(10)) AS prior FROM q)
SELECT p.id, sha256('Text:' || chr(10) || d.text || chr(10) || chr(10) || CASE WHEN prior <> '' THEN 'Asked before, to be neither repeated nor reworded:' || chr(10) || prior || chr(10) || chr(10) ELSE '' END
|| CASE WHEN source_kind = 'spec' THEN 'Only of ' || area || chr(10) ELSE '' END || 'Ask ' || (seq % 6 + 1) || ' questions of different types and levels that this text answers, as a JSON array of question, type, difficulty and focus.') AS prompt_sha256
FROM p JOIN documents d ON d.doc_id = p.seq""")
def question_prompts(spark: SparkSession, d: str) -> DataFrame:
    """A prompt per document, with the last three questions of its source before it."""
    from pyspark.sql import Window

    before = Window.partitionBy("source_key").orderBy("seq").rowsBetween(-3, -1)
    x = _questions(spark, d).withColumn("prior", F.collect_list("id").over(before)).join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), "text"), "seq")
    about = F.when(F.col("source_kind") == "spec", F.concat(F.lit("Only of "), "area"))
    return x.select("id", F.sha2(review.question_prompt(F.col("text"), F.col("prior"), F.col("seq") % 6 + 1, about), 256).alias("prompt_sha256"))


@query(f"""WITH {_Q}, x AS (SELECT *, '[https://a.test/]' || chr(10) || 'One of ' || id || chr(10) || chr(10) || '[https://b.test/]' || chr(10) || repeat('two ', 1000) AS ctx FROM q)
SELECT id, sha256('# Question ' || (seq % 6) || chr(10) || question || chr(10) || 'Links allowed: https://a.test/ https://b.test/' || chr(10) || 'Context:' || chr(10) || ctx) AS answer_sha256,
sha256('# Item ' || (seq % 8) || chr(10) || 'Question: ' || question || chr(10) || 'Answer: It is ' || id || chr(10) || 'Sources: https://a.test/' || chr(10) || 'Context:' || chr(10) || left(ctx, 3500)) AS judge_sha256,
sha256('# Item ' || (seq % 4) || chr(10) || 'Question: ' || question || chr(10) || 'Last answer: It is ' || id || chr(10) || 'To be mended:' || chr(10) || '* too short' || chr(10) || '* ' || area || chr(10) || 'Links allowed: https://a.test/ https://b.test/' || chr(10) || 'Context:' || chr(10) || ctx) AS rewrite_sha256 FROM x""")
def item_prompts(spark: SparkSession, d: str) -> DataFrame:
    """The items of answer, judge and rewrite prompts with two pieces of context each."""
    piece = lambda url, text: F.struct(F.lit(url).alias("url"), text.alias("content"))
    items = F.array(piece("https://a.test/", F.concat(F.lit("One of "), "id")), piece("https://b.test/", F.repeat(F.lit("two "), F.lit(1000))))
    links, answer, q = _texts("https://a.test/", "https://b.test/"), F.concat(F.lit("It is "), "id"), F.col("question")
    made = {
        "answer_sha256": review.answer_item(F.col("seq") % 6, q, links, items), "judge_sha256": review.judge_item(F.col("seq") % 8, q, answer, _texts("https://a.test/"), items),
        "rewrite_sha256": review.rewrite_item(F.col("seq") % 4, q, answer, F.array(F.lit("too short"), F.col("area")), links, items),
    }
    return _questions(spark, d).select("id", *[F.sha2(c, 256).alias(n) for n, c in made.items()])


# Stages with models


class _Down:
    """A model that always fails."""

    name = "down"

    def generate(self, prompts: list[str]) -> list[str]:
        raise OSError("down")


class _Asker:
    """A stub that asks two good questions and a bad one about any text."""

    name = "asker"

    def generate(self, prompts: list[str]) -> list[str]:
        return [self._ask(hashlib.sha256(p.encode()).hexdigest()) for p in prompts]

    def _ask(self, h: str) -> str:
        asked = [f"How is {h[:8]} set up with it here?", "Why?", f"What of {h[8:16]} when it fails here?"]
        return "Sure.\n" + json.dumps([{"question": q, "type": "how-to", "difficulty": "expert", "focus": h[:6]} for q in asked])


@query(f"""WITH {_Q}, p AS (SELECT q.source_key, sha256('Text:' || chr(10) || d.text || chr(10) || chr(10) || 'Ask 3 questions of different types and levels that this text answers, as a JSON array of question, type, difficulty and focus.') AS h FROM q JOIN documents d ON d.doc_id = q.seq),
a AS (SELECT source_key, substr(h, 1, 6) AS focus, unnest(['How is ' || substr(h, 1, 8) || ' set up with it here?', 'What of ' || substr(h, 9, 8) || ' when it fails here?']) AS question FROM p)
SELECT 'q_' || substr(sha256(source_key || question), 1, 10) AS id, question, focus, 'asker' AS model FROM a""")
def generated_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions of a model about every whole document: prompt, reply, valid rows."""
    x = _questions(spark, d).join(read(spark, d, "documents").select(F.col("doc_id").alias("seq"), "text"), "seq")
    asked = x.select("source_key", "source_kind", "area", F.lit(3).alias("n"), review.question_prompt(F.col("text"), _none(), F.lit(3)).alias("prompt"))
    return review.question_rows(materialize(models.generate(asked, _Asker()), "asked")).select("id", "question", "focus", "model")


def _batch_prompts(b: DataFrame, keys: list[str], item: Column) -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct("pos", item.alias("item"))))
    return b.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["item"]), "\n\n").alias("prompt"), F.count(F.lit(1)).alias("size"))


def _context_of(id_col: str = "id") -> Column:
    return F.array(F.struct(F.lit("https://a.test/").alias("url"), F.concat(F.lit("About "), F.col(id_col)).alias("content")))


def _write_sections(prompt: str) -> str:
    found = re.findall(r"^# Question (\d+)\n(.*)$", prompt, re.M)
    return "\n".join(f"=====ANSWER {n}=====\n{hashlib.sha256(q.encode()).hexdigest()[:16]}" for n, q in found if n != "3")


@query(f"WITH {_Q}, b AS (SELECT *, (row_number() OVER (PARTITION BY lang ORDER BY seq) - 1) % 6 + 1 AS pos FROM q), s AS (SELECT *, count(*) OVER (PARTITION BY lang, batch) AS size FROM (SELECT *, (row_number() OVER (PARTITION BY lang ORDER BY seq) - 1) // 6 AS batch FROM b)) SELECT id, substr(sha256(question), 1, 16) AS answer, 'writer' AS model FROM s WHERE pos <> 3")
def generated_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a model in batches of six: prompts with context and links, replies in sections; it leaves out each third, which stays for the next run."""
    b = materialize(planning.batches(_questions(spark, d).drop("model"), 6, [F.col("seq")], ["lang"]), "batches")
    p = _batch_prompts(b, ["lang", "batch"], review.answer_item(F.col("pos"), F.col("question"), _texts("https://a.test/"), _context_of()))
    replies = materialize(models.generate(p, models.StubModel("writer", _write_sections)), "replies")
    return review.section_answers(b, replies, ["lang", "batch"]).select("id", "answer", "model")


def _judge_reply(prompt: str) -> str:
    found = re.findall(r"^# Item (\d+)\nQuestion: (.*)$", prompt, re.M)
    kinds = [(n, hashlib.sha256(q.encode()).hexdigest()[0]) for n, q in found]
    return json.dumps([{"i": n, "verdict": "pass" if h < "8" else "reject", "accuracy": 5, "version": "4", "usefulness": "high", "concise": 3, "issues": h * 500} for n, h in kinds])


@query(f"WITH {_Q} SELECT id, CASE WHEN substr(sha256(question), 1, 1) < '8' THEN 'pass' ELSE 'reject' END AS verdict, CAST(5 AS DOUBLE) AS accuracy, CAST(0 AS DOUBLE) AS usefulness, repeat(substr(sha256(question), 1, 1), 400) AS issues, true AS by_another FROM q")
def judged_answers(spark: SparkSession, d: str) -> DataFrame:
    """Verdicts on answers in batches of eight within the writer, by the first of three models that is up and not the writer."""
    q = _questions(spark, d).withColumnRenamed("model", "writer")
    b = materialize(planning.batches(q, 8, [F.col("seq")], ["writer"]), "batches")
    item = review.judge_item(F.col("pos"), F.col("question"), F.concat(F.lit("It is "), "id"), _texts("https://a.test/"), _context_of())
    failover = models.Failover([_Down(), models.StubModel("m1", _judge_reply), models.StubModel("m2", _judge_reply)], clock=lambda: 0.0, sleep=lambda s: None)
    asked = _batch_prompts(b, ["writer", "batch"], item)
    replies = materialize(models.generate(asked, failover, accept=lambda s: s.startswith("["), writer="writer"), "verdicts")
    out = review.verdicts(b, replies, ["writer", "batch"]).join(b.select("id", "writer"), "id")
    return out.select("id", "verdict", "accuracy", "usefulness", "issues", (F.col("judge") != F.col("writer")).alias("by_another"))


# Checks of answers

_BASE = "Set the option in the file and it is read at the start of each run, as the guide has it. "
_FENCE = "chr(10) || '```ts' || chr(10) || {0} || chr(10) || '```' || chr(10)"
#: Sixteen kinds of answers; what the checks say of each is stated in the SQL of the query.
ANSWERS = f"""SELECT lpad(CAST(doc_id AS STRING), 8, '0') AS id, doc_id AS seq, CASE WHEN doc_id % 16 = 5 THEN 'migration' ELSE 'how-to' END AS type, 'guides' AS area, CASE doc_id % 16
WHEN 0 THEN 'INSUFFICIENT' WHEN 1 THEN 'Short.' WHEN 2 THEN '{_BASE}See https://docs.test/known/ for more.' WHEN 3 THEN '{_BASE}See https://docs.test/known/#part, and https://else.test/x.'
WHEN 4 THEN '{_BASE}Call oldCall() here.' WHEN 5 THEN '{_BASE}The oldCall() was removed.' WHEN 6 THEN '{_BASE}' || chr(10) || '```ts' || chr(10) || 'x'
WHEN 7 THEN '{_BASE}' || {_FENCE.format("'import { start, Missing as M, /* Gone */ type Stop } from ' || chr(34) || 'engine:run' || chr(34)")}
WHEN 8 THEN '{_BASE}' || {_FENCE.format("'import any from ' || chr(34) || 'engine:none' || chr(34)")} WHEN 9 THEN '{_BASE}Use `base.path` and `unknownThing` there.'
WHEN 10 THEN '{_BASE}Use `firstThing` and `secondThing()` there.' WHEN 11 THEN '{_BASE}' || {_FENCE.format("'Engine.site(Engine.nothing)'")}
WHEN 12 THEN '{_BASE}As an AI I hope this helps.' WHEN 13 THEN repeat('{_BASE}', 40) WHEN 14 THEN '{_BASE}Dotted is `option.path.Stop` as its parts are words.'
ELSE '{_BASE}Not `src/a.ts`, `x.json`, `true`, `pkg@2`, `Engine.props.name` or https://localhost:80/ and `https://no.test/`.' END AS answer FROM {{documents}}"""
#: A corpus of one text for each page.
CORPUS = """SELECT page_id, 'The option base.path is read by Engine.site, in part ' || CAST(page_id AS STRING) || '. import Page' || CAST(page_id % 5 AS STRING) || ', { part' || CAST(page_id % 4 AS STRING) || ' as p } from ' || chr(34) || 'engine:m' || CAST(page_id % 3 AS STRING) || chr(34)
|| '; import { start, type Stop } from ' || chr(34) || 'engine:run' || chr(34) AS content FROM {pages}"""
DIALECT = checks.Dialect(modules=r"^engine:", owner="Engine", paths=r"^engine\b")
_LABELS = r"""CASE seq % 16 WHEN 0 THEN 'insufficient|too-short|artifact:\bINSUFFICIENT\b' WHEN 1 THEN 'too-short' WHEN 3 THEN 'bad-link:https://else.test/x' WHEN 4 THEN 'stale:old-call' WHEN 6 THEN 'unclosed-fence' WHEN 7 THEN 'bad-import:Missing from engine:run'
WHEN 8 THEN 'bad-import:engine:none (unknown module)' WHEN 10 THEN 'unknown-apis:firstThing,secondThing' WHEN 12 THEN 'artifact:\bas an ai\b|artifact:\bI hope this helps\b' ELSE '' END"""


def _checked(spark: SparkSession, d: str) -> DataFrame:
    corpus = materialize(shared_sql(spark, d, CORPUS), "corpus")
    urls = spark.createDataFrame([("https://docs.test/known/",)], "url string")
    return checks.check_answers(shared_sql(spark, d, ANSWERS), [("old-call", r"oldCall\s*\(")], urls, checks.known_imports(corpus), corpus, DIALECT)


@query(f"""WITH a AS ({as_duckdb(ANSWERS)}) SELECT id, {_LABELS} AS hard,
CASE seq % 16 WHEN 3 THEN 'multiple-links' WHEN 5 THEN 'stale-in-migration:old-call' WHEN 9 THEN 'unknown-api:unknownThing' WHEN 11 THEN 'unknown-api:Engine.nothing' WHEN 13 THEN 'long' ELSE '' END AS soft,
CAST(CASE seq % 16 WHEN 2 THEN 1 WHEN 3 THEN 2 ELSE 0 END AS BIGINT) AS links, CAST(CASE WHEN seq % 16 IN (7, 8, 11) THEN 1 ELSE 0 END AS BIGINT) AS code_blocks, length(answer) AS chars FROM a""")
def answer_checks(spark: SparkSession, d: str) -> DataFrame:
    """All checks of an answer, against the known pages, the corpus's imports and its vocabulary."""
    return _checked(spark, d).select("id", F.array_join("hard", "|").alias("hard"), F.array_join("soft", "|").alias("soft"), *big("links", "code_blocks", "chars"))


@query(f"""WITH a AS ({as_duckdb(ANSWERS)}) SELECT split_part(l, ':', 1) AS label, count(*) AS n FROM (SELECT unnest(string_split({_LABELS}, '|')) AS l FROM a) WHERE l <> '' GROUP BY 1""")
def answer_check_histogram(spark: SparkSession, d: str) -> DataFrame:
    return checks.histogram(_checked(spark, d), "hard")


@query("""SELECT 'engine:m' || (page_id % 3) AS module, array_to_string(list_sort(list_distinct(list_append(list('part' || (page_id % 4)), 'default'))), ',') AS names FROM pages GROUP BY 1
UNION ALL SELECT DISTINCT 'engine:run', 'Stop,start' FROM pages""")
def known_imports(spark: SparkSession, d: str) -> DataFrame:
    return checks.known_imports(shared_sql(spark, d, CORPUS)).select("module", F.array_join(F.array_sort("names"), ",").alias("names"))


@query(r"""SELECT lang, count(*) AS tokens, sum(length(token)) AS chars FROM (SELECT DISTINCT lang, unnest(regexp_extract_all(lower(text), '[\w$@][\w$.:/@-]*')) AS token FROM documents) GROUP BY lang""")
def vocabulary_by_language(spark: SparkSession, d: str) -> DataFrame:
    from .operators.vocabulary import vocabulary

    docs = read(spark, d, "documents")
    out = None
    for lang in sorted(r[0] for r in docs.select("lang").distinct().collect()):
        part = vocabulary(docs.where(F.col("lang") == lang), "text").agg(F.count(F.lit(1)).alias("tokens"), F.sum(F.length("token")).alias("chars")).where("tokens > 0").select(F.lit(lang).alias("lang"), "tokens", "chars")
        out = part if out is None else out.unionByName(part)
    return out


@query(r"""WITH t AS (SELECT DISTINCT unnest([lower(substr(text, 3, 7)), lower(substr(text, 9, 4)), lower(regexp_extract(text, '\w+')), 'nowhere-at-all']) AS token FROM benchmark), x AS (SELECT lower(text) AS t FROM documents)
SELECT token, EXISTS (SELECT 1 FROM x WHERE contains(x.t, token)) AS part, EXISTS (SELECT 1 FROM x WHERE contains(x.t, token) AND regexp_matches(' ' || x.t || ' ', '\b' || regexp_escape(token) || '\b')) AS word FROM t WHERE token <> ''""")
def contained_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Which pieces of benchmark items some document contains, anywhere and between word boundaries."""
    from .operators.vocabulary import contained

    b, docs = read(spark, d, "benchmark"), read(spark, d, "documents").select(F.col("text").alias("content"))
    cut = F.array(F.lower(F.substring("text", 3, 7)), F.lower(F.substring("text", 9, 4)), F.lower(F.regexp_extract("text", r"\w+", 0)), F.lit("nowhere-at-all"))
    t = materialize(b.select(F.explode(cut).alias("token")).where("token <> ''").distinct(), "tokens")
    part, word = (contained(t, docs, whole=w).withColumn(n, F.lit(True)) for w, n in ((False, "part"), (True, "word")))
    return t.join(part, "token", "left").join(word, "token", "left").select("token", F.coalesce("part", F.lit(False)).alias("part"), F.coalesce("word", F.lit(False)).alias("word"))


# Gates, refinement and selection


def _gates(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """State of the gate cascade and of refinement for every document: verdicts, corrections, rewrites, overrides."""
    q = _questions(spark, d)
    s = F.col("seq")
    num = lambda c: c.cast("double")
    grade = {"accuracy": num(F.lit(5)), "version": num(F.when(s % 13 == 0, 3).otherwise(5)), "usefulness": num(F.when(s % 17 == 0, 2).otherwise(4)), "concise": num(F.lit(4))}
    kind = F.when(s % 10 == 0, "reject").when(s % 10 <= 2, "fix").otherwise("pass")
    verdict = F.struct(F.lit("pass").alias("verdict"), *[num(F.lit(5)).alias(n) for n in grade])
    text = F.lit(None).cast("string")
    return {
        "questions": q,
        "answers": q.select("id", F.concat(F.lit(" Answer "), "id", F.lit(" ")).alias("answer"), F.array("source_key").alias("sources"), "model"),
        "checks": q.select("id", F.when(s % 31 == 0, _texts("too-short")).otherwise(_none()).alias("hard"), F.when(s % 2 == 0, _texts("long")).otherwise(_none()).alias("soft")),
        "code": q.where("seq % 37 = 0").select("id", _texts("ts1: x").alias("hard")),
        "judge": q.where("seq % 7 <> 6").select("id", kind.alias("verdict"), *[c.alias(n) for n, c in grade.items()], F.lit("as said").alias("issues"), F.when(s % 10 == 1, F.concat(F.lit("Fixed "), "id")).when(s % 10 == 2, "").alias("fixed_answer")),
        "fix_checks": q.where("seq % 10 = 1").select("id", F.when(s % 3 == 0, _texts("x")).otherwise(_none()).alias("hard"), _none().alias("soft")),
        "fix_code": q.where("seq % 10 = 1 and seq % 4 = 1").select("id", _texts("ts2: y").alias("hard")),
        "refine": q.where("seq % 19 = 0").select(
            "id", F.when(s % 2 == 0, "accepted").when(s % 3 == 0, "verify").otherwise("retry").alias("status"), F.concat(F.lit("Refined "), "id").alias("answer"), _none().alias("sources"), F.lit("m9").alias("model"),
            _texts("known").alias("problems"), F.lit(1).alias("round"), F.lit(1).alias("low_use"), _texts("long", "multiple-links").alias("soft"), verdict.alias("verdict"),
        ),
        "overrides": q.where("seq % 23 = 0 or seq % 29 = 0").select("id", F.when(s % 23 == 0, "drop").alias("action"), F.when(s % 29 == 0, F.concat(F.lit("By hand "), "id")).alias("answer"), text.alias("question")),
    }


_GATED = f"""{_Q}, c AS (SELECT *, seq % 19 = 0 AS refined, CASE WHEN seq % 10 = 0 THEN 'reject' WHEN seq % 10 <= 2 THEN 'fix' ELSE 'pass' END AS verdict FROM q WHERE seq % 7 <> 6 OR seq % 19 = 0),
r AS (SELECT *, CASE WHEN seq % 23 = 0 THEN 'manual-drop' WHEN refined AND seq % 2 <> 0 THEN 'refine-' || CASE WHEN seq % 3 = 0 THEN 'verify' ELSE 'retry' END WHEN NOT refined AND verdict = 'reject' THEN 'judge-reject'
WHEN NOT refined AND verdict = 'fix' AND (seq % 10 = 2 OR seq % 3 = 0 OR seq % 4 = 1) THEN 'fix-failed-checks' WHEN NOT refined AND (seq % 13 = 0 OR seq % 17 = 0) THEN 'low-scores' END AS reason FROM c)"""


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    g = _gates(spark, d)
    return selection.candidates(*[g[n] for n in ("questions", "answers", "checks", "judge", "refine", "fix_checks", "fix_code", "overrides")])


@query(f"""WITH {_GATED} SELECT id, reason AS drop_reason, CASE WHEN seq % 29 = 0 THEN 'By hand ' || id WHEN refined THEN 'Refined ' || id WHEN verdict = 'fix' THEN 'Fixed ' || id ELSE 'Answer ' || id END AS answer,
CASE WHEN refined THEN 5 + 5 + 5 + 5 + 7.5 + 5 + 1 - 1.5 ELSE 10 + 10 + 6 + 4 + CASE WHEN verdict = 'pass' THEN 1 ELSE 0 END - CASE WHEN verdict = 'pass' AND seq % 2 = 0 THEN 0.75 ELSE 0 END END + CASE WHEN seq % 29 = 0 THEN 2 ELSE 0 END AS score FROM r WHERE reason IS NULL
UNION ALL SELECT id, reason, NULL, NULL FROM r WHERE reason IS NOT NULL""")
def gate_cascade(spark: SparkSession, d: str) -> DataFrame:
    """Why each judged or refined question is dropped, or its text and score."""
    out = _candidates(spark, d)
    return out.select("id", "drop_reason", F.when(F.col("drop_reason").isNull(), F.col("text")).alias("answer"), F.round("score", 4).alias("score"))


@query(f"WITH {_GATED} SELECT reason AS drop_reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY 1")
def drop_reasons(spark: SparkSession, d: str) -> DataFrame:
    return selection.drop_histogram(_candidates(spark, d))


@query(f"WITH {_Q} SELECT id, 'Fixed ' || id AS answer, source_key AS sources FROM q WHERE seq % 7 <> 6 AND seq % 10 = 1")
def fixed_answers(spark: SparkSession, d: str) -> DataFrame:
    g = _gates(spark, d)
    return selection.fixed_answers(g["answers"], g["judge"]).select("id", "answer", F.array_join("sources", ",").alias("sources"))


_SAID = {k: refine.REASONS[k].replace("'", "''") for k in ("too-short",)}


@query(f"""WITH {_Q}, w AS (SELECT *, seq % 19 = 0 AS going, seq % 31 = 0 OR seq % 37 = 0 AS failed, seq % 7 <> 6 AS judged, CASE WHEN seq % 10 = 0 THEN 'reject' WHEN seq % 10 <= 2 THEN 'fix' ELSE 'pass' END AS v, NOT (seq % 13 = 0 OR seq % 17 = 0) AS ok,
seq % 10 = 1 AND seq % 3 <> 0 AND seq % 4 <> 1 AS fix_ok FROM q),
x AS (SELECT *, 'Reviewer: ' || v || ' (accuracy 5, version ' || CASE WHEN seq % 13 = 0 THEN 3 ELSE 5 END || ', usefulness ' || CASE WHEN seq % 17 = 0 THEN 2 ELSE 4 END || ', concise 4). as said' AS said FROM w),
y AS (SELECT *, CASE WHEN going THEN 'known' WHEN failed THEN concat_ws('|', CASE WHEN seq % 31 = 0 THEN '{_SAID["too-short"]}' END, CASE WHEN seq % 37 = 0 THEN 'The code fails its type check: ts1: x' END)
WHEN judged AND v = 'fix' AND NOT (fix_ok AND ok) THEN concat_ws('|', CASE WHEN seq % 10 = 1 AND seq % 3 = 0 THEN 'x' END, CASE WHEN seq % 10 = 1 AND seq % 4 = 1 THEN 'The code fails its type check: ts2: y' END, said)
WHEN judged AND v <> 'fix' AND (v = 'reject' OR NOT ok) THEN said END AS problems FROM x)
SELECT id, CASE WHEN going THEN 'Refined ' || id ELSE ' Answer ' || id || ' ' END AS answer, CASE WHEN going THEN '' ELSE source_key END AS sources, CASE WHEN going THEN 'm9' ELSE model END AS model, problems, CASE WHEN going AND seq % 3 = 0 THEN 'verify' ELSE 'retry' END AS mode,
CAST(CASE WHEN going THEN 1 ELSE 0 END AS BIGINT) AS round, CAST(CASE WHEN going OR (judged AND seq % 17 = 0) THEN 1 ELSE 0 END AS BIGINT) AS low_use FROM y WHERE (going AND seq % 2 <> 0) OR (NOT going AND problems IS NOT NULL)""")
def refine_work(spark: SparkSession, d: str) -> DataFrame:
    """What is to be rewritten or verified, with the reasons in words, from seven tables of state."""
    g = _gates(spark, d)
    out = refine.work_list(*[g[n] for n in ("questions", "answers", "checks", "code", "judge", "fix_checks", "fix_code", "refine")])
    return out.select("id", "answer", F.array_join("sources", ",").alias("sources"), "model", F.array_join("problems", "|").alias("problems"), "mode", *big("round", "low_use"))


_CAP_N = 200
_CAPS = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in {**selection.AREA_CAPS, "spec": selection.POOL_CAP}.items())


@query(f"WITH {_Q} SELECT DISTINCT area, round(CASE CASE WHEN starts_with(area, 'spec:') THEN 'spec' ELSE area END {_CAPS} ELSE CAST({selection.OTHER_CAP} AS DOUBLE) END * {_CAP_N}, 6) AS cap FROM q")
def area_caps(spark: SparkSession, d: str) -> DataFrame:
    return _questions(spark, d).select("area").distinct().select("area", F.round(selection.cap_of(F.col("area"), _CAP_N), 6).alias("cap"))


_ADMIT = f"""len(ids) < {_CAP_N} AND len(list_filter(areas, lambda x: x = c.pool)) < CASE c.pool {_CAPS} ELSE CAST({selection.OTHER_CAP} AS DOUBLE) END * {_CAP_N} AND len(list_filter(pages, lambda x: x = c.page)) < {selection.PAGE_CAP}"""
_DIFF = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in selection.DIFFICULTY.items())
_PUSH = "CASE WHEN ok THEN list_append(areas, pool) ELSE areas END AS areas, CASE WHEN ok THEN list_append(pages, page) ELSE pages END AS pages, CASE WHEN ok THEN list_append(levels, level) ELSE levels END AS levels, CASE WHEN ok THEN list_append(ids, id) ELSE ids END AS ids, CASE WHEN ok THEN list_append(mine, id) ELSE mine END AS mine"


@query(f"""WITH RECURSIVE {_Q}, c AS (SELECT id, CASE WHEN starts_with(area, 'spec:') THEN 'spec' ELSE area END AS pool, source_key AS page, difficulty AS level, row_number() OVER (ORDER BY (seq * 7919) % 1000, seq) AS r FROM q),
p1 AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS VARCHAR[]) AS areas, CAST([] AS VARCHAR[]) AS pages, CAST([] AS VARCHAR[]) AS levels, CAST([] AS VARCHAR[]) AS ids, CAST([] AS VARCHAR[]) AS mine
UNION ALL SELECT r, {_PUSH} FROM (SELECT c.r, c.id, c.pool, c.page, c.level, p.areas, p.pages, p.levels, p.ids, p.mine, {_ADMIT} AND len(list_filter(p.levels, lambda x: x = c.level)) < CASE c.level {_DIFF} END * {_CAP_N} * CAST(1.1 AS DOUBLE) AS ok FROM p1 p JOIN c ON c.r = p.r + 1)),
f1 AS (SELECT * FROM p1 WHERE r = (SELECT max(r) FROM p1)), c2 AS (SELECT id, pool, page, level, row_number() OVER (ORDER BY r) AS r FROM c WHERE id NOT IN (SELECT unnest(ids) FROM f1)),
p2 AS (SELECT CAST(0 AS BIGINT) AS r, areas, pages, levels, ids, CAST([] AS VARCHAR[]) AS mine FROM f1
UNION ALL SELECT r, {_PUSH} FROM (SELECT c.r, c.id, c.pool, c.page, c.level, p.areas, p.pages, p.levels, p.ids, p.mine, {_ADMIT} AS ok FROM p2 p JOIN c2 c ON c.r = p.r + 1))
SELECT unnest(mine) AS id, CAST(1 AS BIGINT) AS pass FROM f1 UNION ALL SELECT unnest(mine), CAST(2 AS BIGINT) FROM p2 WHERE r = (SELECT max(r) FROM p2)""")
def capped_pools(spark: SparkSession, d: str) -> DataFrame:
    """200 questions under the caps of areas, of all areas of the pool together, of pages and levels."""
    q = _questions(spark, d).select("id", "area", F.col("source_key").alias("page"), "difficulty", "seq")
    ranked = planning.numbered(q, [(F.col("seq") * 7919) % 1000, F.col("seq")], name="rank")
    return selection.capped(ranked, _CAP_N).select("id", F.col("pass").cast("long").alias("pass"))


# Work lists


@query(f"""WITH {_Q} SELECT id, CASE WHEN model = 'm1' THEN 'm2' ELSE 'm1' END AS judge FROM q WHERE seq % 7 = 6 AND seq % 31 <> 0 AND seq % 37 <> 0 AND NOT starts_with(model, 'local/')""")
def local_judge_work(spark: SparkSession, d: str) -> DataFrame:
    """What a local judge may take: answers not yet judged, checked and compiled, that no local model wrote; and the first judge that is not the writer."""
    g = _gates(spark, d)
    out = release.judge_work(g["answers"], g["judge"], g["questions"], g["checks"], g["code"], "local/")
    return out.select("id", release.judge_for(F.col("model"), ["m1", "m2"]).alias("judge"))


@query(f"WITH {_Q} SELECT id, 'new' AS verdict FROM q WHERE seq % 4 <> 0 AND seq % 6 <> 0")
def late_writes(spark: SparkSession, d: str) -> DataFrame:
    """Rows made for what was open at the start, held again against what others wrote meanwhile, just before the write."""
    q = _questions(spark, d)
    path = scratch(spark, "judged")
    q.where("seq % 4 = 0").select("id", F.lit("old").alias("verdict")).write.parquet(path)
    todo = materialize(state.outstanding(q, spark.read.parquet(path), "id"), "todo")
    made = todo.select("id", F.lit("new").alias("verdict"))
    q.where("seq % 6 = 0 and seq % 4 <> 0").select("id", F.lit("others").alias("verdict")).write.mode("append").parquet(path)
    return release.still_open(made.unionByName(made.where("id like '%5'")), spark.read.parquet(path))


@query(f"WITH {_Q} SELECT id, 'first' AS part FROM (SELECT id FROM q WHERE area IN ('errors', 'guides') ORDER BY seq LIMIT 40) UNION ALL SELECT id, 'last' FROM (SELECT id FROM q WHERE area IN ('errors', 'guides') ORDER BY seq DESC LIMIT 40)")
def limited_work(spark: SparkSession, d: str) -> DataFrame:
    """The first 40 of a work list of two areas, and the 40 that a worker from the other end takes."""
    q = planning.in_areas(_questions(spark, d), ["errors", "guides"])
    part = lambda name, reverse: release.take(q, [F.col("seq")], 40, reverse).select("id", F.lit(name).alias("part"))
    return part("first", False).unionByName(part("last", True))


@query(f"""WITH {_Q}, s AS (SELECT source_key, area, count(*) AS quota, count(*) FILTER (WHERE seq % 3 = 0) AS done FROM q GROUP BY ALL), x AS (SELECT *, CAST(ceil(done / 6.0) AS BIGINT) AS b, unnest(range(0, CAST(ceil((quota - done) / 6.0) AS BIGINT))) AS k FROM s WHERE quota > done AND area IN ('errors', 'spec:net'))
SELECT source_key, area, b + k AS batch, least(6, quota - done - k * 6) AS n FROM x""")
def area_jobs(spark: SparkSession, d: str) -> DataFrame:
    s = _questions(spark, d).groupBy("source_key", "area").agg(F.count(F.lit(1)).alias("quota"), F.count_if(F.col("seq") % 3 == 0).alias("done"))
    return planning.jobs(s, areas=["errors", "spec:net"]).select("source_key", "area", *big("batch", "n"))


@query("SELECT conv_id, array_to_string(list_slice(list(turn || '=' || role ORDER BY turn), -2, -1), ' ') AS last_turns FROM conversations GROUP BY conv_id")
def last_turns(spark: SparkSession, d: str) -> DataFrame:
    each = read(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    said = F.transform(planning.last_k(F.col("t"), 2), lambda x: F.concat(x["turn"].cast("string"), F.lit("="), x["role"]))
    return each.select("conv_id", F.array_join(said, " ").alias("last_turns"))


@query(f"WITH {_Q} SELECT id, array_to_string(list_slice(m, seq % 4 + 1, 4) || list_slice(m, 1, seq % 4), ',') AS models FROM (SELECT id, seq, ['a', 'b', 'c', 'd'] AS m FROM q)")
def rotated_models(spark: SparkSession, d: str) -> DataFrame:
    return _questions(spark, d).select("id", F.array_join(T.rotate(_texts("a", "b", "c", "d"), F.col("seq").cast("int")), ",").alias("models"))


@query(f"WITH {_Q} SELECT id, row_number() OVER (ORDER BY area || id, id) - 1 AS n FROM q")
def release_order(spark: SparkSession, d: str) -> DataFrame:
    """The place of each example in the published order, which is that of people and not of code points."""
    key = F.collate(F.concat("area", F.col("id")), "UNICODE")
    return planning.numbered(_questions(spark, d), [key, F.col("id")]).select("id", *big("n"))


@query(f"WITH {_Q}, t AS (SELECT area, count(DISTINCT source_key) AS topics FROM q WHERE starts_with(area, 'spec:') GROUP BY area) SELECT area, CAST(floor(greatest(2, floor(floor(6200 * CAST(0.1 AS DOUBLE) + 0.5) / topics + 0.5)) * 1.5 + 0.5) AS BIGINT) AS quota FROM t")
def topic_quotas(spark: SparkSession, d: str) -> DataFrame:
    """Questions wanted of each topic of the pool's areas: a tenth of the total over the topics, and half as many again."""
    t = _questions(spark, d).where("source_kind = 'spec'").groupBy("area").agg(F.count_distinct("source_key").alias("topics"))
    return t.select("area", planning.topic_quota(F.lit(6200), F.col("topics"), 0.5).alias("quota"))


@query(f"WITH {_Q}, l AS (SELECT *, row_number() OVER (ORDER BY seq) AS k FROM (SELECT * FROM q ORDER BY seq DESC LIMIT 150)) SELECT k || '|' || type || '|' || left(difficulty, 1) || '|' || question AS line FROM l")
def dumped_lines(spark: SparkSession, d: str) -> DataFrame:
    """The dump for people, a line per question, as it stands in the file."""
    q = _questions(spark, d)
    path = scratch(spark, "dump-lines")
    jsonl.write_lines(release.dump_lines(release.dump(q, q.limit(0), 150)), ["value"], path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# Texts and code


@query(r"""SELECT page_id, array_to_string(list_slice(list_filter(list_transform(regexp_extract_all(replace(html, 'h1', 'h2'), '(?s)<h2[^>]*>(.*?)</h2>', 1) || ['On this page', 'Part ' || page_id, ' '] || list_transform(range(0, 40), lambda i: 'Sub ' || i), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&[#a-zA-Z0-9]+;', ' ', 'g'))), lambda x: x <> '' AND lower(x) <> 'on this page'), 1, 25), '|') AS headings FROM pages""")
def sub_headings(spark: SparkSession, d: str) -> DataFrame:
    """Headings of the second and third level without empty and boilerplate ones, the first 25."""
    more = F.concat(F.lit("<h2>On this page</h2><h3 id='x'><b>Part "), F.col("page_id").cast("string"), F.lit("</b></h3><h2>&nbsp;</h2>" + "".join(f"<h3>Sub {i}</h3>" for i in range(40))))
    return read(spark, d, "pages").select("page_id", F.array_join(T.headings(F.concat(F.replace("html", F.lit("h1"), F.lit("h2")), more)), "|").alias("headings"))


@query(r"""SELECT page_id, '/p' || page_id || ' ' || 'https://x.test/' || (page_id % 3) AS targets, 'Title ' || page_id AS title, 'body ' || page_id AS rest, CAST(2 AS BIGINT) AS n FROM pages""")
def markdown_parts(spark: SparkSession, d: str) -> DataFrame:
    """Links of markdown in order, each target once, and a document's title and text without its front matter."""
    i = F.col("page_id").cast("string")
    md = F.concat(F.lit("[a](/p"), i, F.lit(") and [b](https://x.test/"), (F.col("page_id") % 3).cast("string"), F.lit(") and [c](/p"), i, F.lit(")"))
    doc = F.concat(F.lit("---\ntitle: 'Title "), i, F.lit("'\nkind: x\n---body "), i)
    x = read(spark, d, "pages").select("page_id", F.array_distinct(F.transform(T.markdown_links(md), lambda l: l["target"])).alias("t"), T.front_matter_title(doc).alias("title"), T.strip_front_matter(doc).alias("rest"))
    return x.select("page_id", F.array_join("t", " ").alias("targets"), "title", "rest", F.size("t").cast("long").alias("n"))


@query("""SELECT page_id, 's_' || page_id || '_0.ts' AS file, CAST(2300 + page_id % 7 AS BIGINT) AS code, CAST(page_id % 50 + 1 AS BIGINT) AS line, 'no member m' || page_id AS msg FROM pages
UNION ALL SELECT page_id, 's_' || page_id || '_1.ts', 7006, 9, 'implicitly any' FROM pages WHERE page_id % 2 = 0""")
def printed_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """The diagnostics that a checker printed, with colours and a banner, as rows."""
    i = F.col("page_id").cast("string")
    first = F.concat(F.lit("\x1b[31ms_"), i, F.lit("_0.ts("), (F.col("page_id") % 50 + 1).cast("string"), F.lit(",3): error TS"), (F.col("page_id") % 7 + 2300).cast("string"), F.lit(": no member m"), i, F.lit("\x1b[0m\n"))
    more = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("s_"), i, F.lit("_1.ts(9,1): error TS7006: implicitly any\n"))).otherwise("")
    out = F.concat(F.lit("a line of the tool: error\n> checker 1.0\n"), first, more, F.lit("2 errors"))
    x = read(spark, d, "pages").select("page_id", F.explode(T.diagnostics(T.strip_banner(out, "> checker"))).alias("g"))
    return x.select("page_id", "g.file", F.col("g.code").cast("long").alias("code"), F.col("g.line").cast("long").alias("line"), "g.msg")


def _compiled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("doc_id") % 4
    bad = F.when(k == 0, "bad").when(k == 1, "odd").otherwise("fine")
    block = F.concat(F.lit("```ts\nimport { "), bad, F.lit(" } from 'engine:x'\n```\n"))
    body = F.when(k == 3, F.lit("```sh\nimport none\n```")).otherwise(F.concat(F.lit("```sh\nls\n```\n"), block, F.lit("and ```js\ndefineThing()\n```")))
    answers = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), body.alias("answer"))
    files = materialize(code.snippets(answers), "snippets")

    def checker(batch: list[tuple[str, str]]) -> dict[str, list[dict]]:
        assert len(batch) <= 150
        said = {"bad": {"code": 2305, "line": 1, "msg": "has no exported member 'bad'"}, "odd": {"code": 7006, "line": 1, "msg": "implicitly any"}}
        return {f: [g for w, g in said.items() if w in c] for f, c in batch}

    return answers, materialize(models.check_snippets(files, checker), "diagnosed")


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 4 = 0 THEN 'ts2305: has no exported member ''bad''' ELSE '' END AS hard, CAST(CASE WHEN doc_id % 4 = 1 THEN 1 ELSE 0 END AS BIGINT) AS soft, CAST(CASE WHEN doc_id % 4 = 3 THEN 0 ELSE 2 END AS BIGINT) AS checked FROM documents""")
def compiled_snippets(spark: SparkSession, d: str) -> DataFrame:
    """Snippets sent to a checker in batches of 150, and what its diagnostics make of each answer."""
    answers, found = _compiled(spark, d)
    return code.roll_up(answers, found, code.invented(r"'engine:", "EngineProps", "Engine")).select("id", F.array_join("hard", "|").alias("hard"), *big("soft", "checked"))


@query("SELECT CAST(2 * count(*) FILTER (WHERE doc_id % 4 <> 3) AS BIGINT) AS snippets, count(*) FILTER (WHERE doc_id % 4 <= 1) AS with_errors FROM documents")
def failing_snippets(spark: SparkSession, d: str) -> DataFrame:
    return code.failing(_compiled(spark, d)[1])


@query("""SELECT c AS code, m AS msg, c IN (2305, 2724, 2614) OR (c = 2307 AND contains(m, 'engine:')) OR (c = 2339 AND contains(m, 'EngineProps')) OR (c IN (2353, 2561) AND contains(m, 'Engine')) AS invented
FROM (SELECT DISTINCT CAST(unnest([2305, 2724, 2614, 2307, 2339, 2353, 2561, 7006]) AS BIGINT) AS c FROM pages), (SELECT unnest(['module ''engine:x''', 'type EngineProps', 'an Engine option', 'else']) AS m)""")
def invented_names(spark: SparkSession, d: str) -> DataFrame:
    """Which diagnostics tell of an API that doesn't exist, for each code and kind of message."""
    codes, said = F.array(*[F.lit(c) for c in (2305, 2724, 2614, 2307, 2339, 2353, 2561, 7006)]), _texts("module 'engine:x'", "type EngineProps", "an Engine option", "else")
    x = read(spark, d, "pages").select(F.explode(codes).alias("code")).distinct().select("code", F.explode(said).alias("msg"))
    return x.select(F.col("code").cast("long").alias("code"), "msg", code.invented("engine:", "EngineProps", "Engine")(F.col("code"), F.col("msg")).alias("invented"))


# Release


_KINDS = """SELECT lpad(CAST(doc_id AS STRING), 8, '0') AS id, doc_id AS seq, 'What is ' || substr(sha2(CAST(doc_id AS STRING), 256), 1, 12) || ' for ' || substr(sha2(CAST(doc_id AS STRING), 256), 13, 12) || ' there?' AS q, 'It is explained by the guide in its part on item ' || CAST(doc_id AS STRING) || '. ' AS a FROM {documents}"""
_DUCK_KINDS = as_duckdb(_KINDS).replace("sha2(CAST(doc_id AS STRING), 256)", "sha256(CAST(doc_id AS STRING))")


def _release(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Examples that break a rule each, by the rest of their number by 16; metadata lack some rows and have some of another version."""
    x = shared_sql(spark, d, _KINDS)
    k = F.col("seq") % 16
    q = F.when(k == 1, F.concat(F.lit("Why "), F.col("seq").cast("string"), F.lit("?"))).when(k == 2, F.concat("q", F.lit(" As an AI I ask."))).otherwise(F.col("q"))
    a = (
        F.when(k == 3, "Too short.").when(k == 4, F.concat("a", F.lit("```ts"))).when(k == 5, F.concat("a", F.lit("This is a TODO."))).when(k == 6, F.concat("a", F.lit("See https://known.test/a/ and https://known.test/b/.")))
        .when(k == 7, F.concat("a", F.lit("See https://else.test/."))).when(k.isin(8, 9), F.concat("a", F.lit("Call oldCall() then."))).otherwise(F.col("a"))
    )
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    data = x.select("id", F.when(k == 10, F.array(turn("user", q))).otherwise(F.array(turn("user", q), turn("assistant", a))).alias("messages"), "seq", "q", "a")
    twice = data.where("seq % 16 = 11").select("id", F.array(turn("user", F.concat("q", F.lit(" Once more, with other words than before?"))), turn("assistant", F.col("a"))).alias("messages"))
    again = data.where("seq % 16 = 12").select(F.concat(F.lit("z"), "id").alias("id"), F.array(turn("user", F.concat(F.lit("  "), F.upper("q"))), turn("assistant", F.col("a"))).alias("messages"))
    meta = data.where("seq % 16 <> 13").select("id", F.when(k == 9, "migration").otherwise("how-to").alias("type"), F.lit("guides").alias("topic"), F.when(k == 14, "2").otherwise("1").alias("version"))
    meta = meta.unionByName(again.select("id", F.lit("how-to").alias("type"), F.lit("guides").alias("topic"), F.lit("1").alias("version")))
    return data.select("id", "messages").unionByName(twice).unionByName(again), meta


@query(f"""WITH x AS ({_DUCK_KINDS}), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE seq % 16 = 11) AS twice, count(*) FILTER (WHERE seq % 16 = 12) AS again, count(*) FILTER (WHERE seq % 16 = 13) AS lost FROM x),
b AS (SELECT CASE seq % 16 WHEN 1 THEN 'short-question' WHEN 3 THEN 'short-answer' WHEN 4 THEN 'unclosed-fence' WHEN 6 THEN 'links' WHEN 8 THEN 'stale' WHEN 10 THEN 'messages' WHEN 11 THEN 'duplicate-id' WHEN 13 THEN 'no-metadata' WHEN 14 THEN 'version' END AS rule, id,
CASE seq % 16 WHEN 6 THEN '2' WHEN 8 THEN 'old-call' WHEN 11 THEN '2' WHEN 14 THEN '2' ELSE '' END AS detail FROM x)
SELECT * FROM b WHERE rule IS NOT NULL UNION ALL SELECT 'artifact', id, CASE seq % 16 WHEN 2 THEN 'question speaks-as-model' ELSE 'answer unfinished' END FROM x WHERE seq % 16 IN (2, 5)
UNION ALL SELECT 'unknown-link', id, 'https://else.test/' FROM x WHERE seq % 16 = 7 UNION ALL SELECT 'duplicate-question', 'z' || id, id FROM x WHERE seq % 16 = 12 UNION ALL SELECT 'near-duplicate', 'z' || id, id FROM x WHERE seq % 16 = 12
UNION ALL SELECT 'count', NULL, CAST(n + twice + again AS VARCHAR) FROM n WHERE n + twice + again <> 7 UNION ALL SELECT 'meta-count', NULL, CAST(n - lost + again AS VARCHAR) FROM n WHERE twice + lost > 0
UNION ALL SELECT 'keys', id, 'extra,id,messages' FROM x WHERE seq % 16 = 15 UNION ALL SELECT 'summary-count', NULL, '5' FROM n WHERE n + twice + again <> 5 UNION ALL SELECT 'summary-version', NULL, '0' FROM n UNION ALL SELECT 'missing-file', NULL, 'metadata.json' FROM n""")
def release_failures(spark: SparkSession, d: str) -> DataFrame:
    """Every rule of acceptance, over examples that break each of them."""
    data, meta = (materialize(t, "release") for t in _release(spark, d))
    urls = spark.createDataFrame([("https://known.test/a/",), ("https://known.test/b/",)], "url string")
    out = validate.failures(data, meta, 7, [("old-call", r"oldCall\s*\(")], urls, "1")
    lines = shared_sql(spark, d, _KINDS).select("seq", F.to_json(F.struct("id", F.array("q").alias("messages"))).alias("line"))
    lines = lines.select(F.when(F.col("seq") % 16 == 15, F.replace("line", F.lit('{"id"'), F.lit('{"extra":1,"id"'))).otherwise(F.col("line")).alias("line"))
    folder = scratch(spark, "release")
    data.limit(1).write.json(f"{folder}/dataset.jsonl")
    summary = spark.createDataFrame([(5, "0")], "examples long, version string")
    parts = [validate.key_failures(lines, ["id", "messages"]), validate.summary_failures(data, summary, "1"), validate.missing_files(spark, folder, ["dataset.jsonl", "metadata.json"])]
    for p in parts:
        out = out.unionByName(p)
    return out


@query(f"""WITH f AS ({SQL["release_failures"]}), n AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY id NULLS FIRST, detail) AS k FROM f),
s AS (SELECT rule, id, detail FROM n WHERE rule <> 'near-duplicate' OR k <= 10 UNION ALL SELECT 'near-duplicates', NULL, (count(*) - 10) || ' more' FROM f WHERE rule = 'near-duplicate' HAVING count(*) > 10)
SELECT * FROM s ORDER BY rule, id NULLS FIRST, detail LIMIT 40""")
def failure_report(spark: SparkSession, d: str) -> DataFrame:
    """The failures as they are listed for people."""
    return validate.report(materialize(release_failures(spark, d), "failures"))


@query("SELECT true AS passes, CAST(0 AS BIGINT) AS failures, count(*) AS examples FROM documents")
def clean_release(spark: SparkSession, d: str) -> DataFrame:
    """A release that breaks no rule is accepted."""
    x = shared_sql(spark, d, _KINDS)
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    data = materialize(x.select("id", F.array(turn("user", "q"), turn("assistant", "a")).alias("messages")), "clean")
    meta = data.select("id", F.lit("how-to").alias("type"), F.lit("guides").alias("topic"), F.lit("1").alias("version"))
    passes, failed = validate.accept(data, meta, data.count(), [("old-call", r"oldCall\s*\(")], version="1")
    return data.agg(F.count(F.lit(1)).alias("examples")).join(failed.agg(F.count(F.lit(1)).alias("failures"))).select(F.lit(passes).alias("passes"), "failures", "examples")


_FILTERED = """WITH x AS (SELECT lpad(CAST(doc_id AS VARCHAR), 8, '0') AS id, doc_id % 8 AS k FROM documents)"""


def _filtered(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 8
    body = F.when(k == 0, "It is in the training data.").when(k == 1, "INSUFFICIENT").when(k == 2, "```ts\nleft open").when(k == 3, "See https://a.test/ and https://b.test/ for it.").when(k == 4, "Fine-tune the dataset: https://a.test/ https://b.test/").otherwise("All well here.")
    rows = read(spark, d, "documents").select(F.lpad(F.col("doc_id").cast("string"), 8, "0").alias("id"), body.alias("answer"))
    return checks.content_filter(rows, F.col("answer"))


@query(_FILTERED + " SELECT label, count(*) AS n FROM (SELECT unnest(CASE k WHEN 0 THEN ['speaks-of-training'] WHEN 1 THEN ['left-over'] WHEN 2 THEN ['open-fence'] WHEN 3 THEN ['several-links'] WHEN 4 THEN ['speaks-of-training', 'several-links'] ELSE [] END) AS label FROM x) GROUP BY label")
def content_filter_hits(spark: SparkSession, d: str) -> DataFrame:
    return checks.histogram(_filtered(spark, d), "why")


@query(_FILTERED + " SELECT 'dataset' AS part, id FROM x WHERE k > 4 UNION ALL SELECT 'meta', id FROM x WHERE k > 4 AND k <> 7")
def content_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Data and metadata without the examples that break a content rule, written as new versions beside the old."""
    f = materialize(_filtered(spark, d), "filtered")
    folder = scratch(spark, "rewrite")
    f.select("id", "answer").write.json(f"{folder}/dataset")
    f.where("id not like '%7' or cast(id as long) % 8 <> 7").where("cast(id as long) % 8 <> 7").select("id").write.json(f"{folder}/meta")
    bad = f.where(F.size("why") > 0)
    data, meta = (jsonl.read_jsonl(spark, f"{folder}/{n}", "id string") for n in ("dataset", "meta"))
    kept = validate.filter_examples(data, meta, bad)
    out = []
    for name, old, new in zip(("dataset", "meta"), (data, meta), kept):
        where = jsonl.rewrite(old, f"{folder}/{name}", lambda _, new=new: new)
        out.append(jsonl.read_jsonl(spark, where, "id string").select(F.lit(name).alias("part"), "id"))
    return out[0].unionByName(out[1])


@query("SELECT count(*) AS rows, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents")
def progress_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts taken while the rows pass, without a pass of their own."""
    p = Progress("documents")
    p.watch(read(spark, d, "documents"), chars=F.col("n_chars")).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(p.counts()["rows"], p.counts()["chars"])], "rows long, chars long")


@query("""WITH v AS (SELECT vec_id AS id, label % 2 = 0 AS keep, 'area' || (label % 3) AS area, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), r AS (SELECT * FROM v WHERE NOT keep AND NOT EXISTS (SELECT 1 FROM v k WHERE k.keep AND list_cosine_similarity(k.e, v.e) > CAST(0.35 AS DOUBLE))),
n AS (SELECT a.id, row_number() OVER (ORDER BY a.id) AS rn, coalesce(list(b.id) FILTER (WHERE b.id IS NOT NULL), []) AS nb FROM r a LEFT JOIN r b ON b.id < a.id AND list_cosine_similarity(a.e, b.e) > CAST(0.35 AS DOUBLE) GROUP BY a.id),
g AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT n.rn, CASE WHEN list_has_any(g.kept, n.nb) THEN g.kept ELSE list_append(g.kept, n.id) END FROM g JOIN n ON n.rn = g.rn + 1),
c AS (SELECT v.id, v.area FROM v WHERE v.id IN (SELECT unnest(kept) FROM g WHERE rn = (SELECT max(rn) FROM g))), t AS (SELECT *, row_number() OVER (ORDER BY area, id) AS k FROM (SELECT * FROM c WHERE id % 5 <> 0 ORDER BY area, id LIMIT 60))
SELECT id, k, k % 3 = 1 AS restored, CASE WHEN k % 6 = 1 THEN 'A wording by hand for ' || k END AS question FROM t""".replace("WITH v AS", "WITH RECURSIVE v AS"))
def recheck_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Rejected questions apart from all kept ones and from each other, by area; the next 60 that were not looked at; and those restored by hand."""
    v = read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("vec_id").alias("seq"), F.col("embedding").alias("vector"), (F.col("label") % 2 == 0).alias("keep"), F.concat(F.lit("area"), (F.col("label") % 3).cast("string")).alias("area"))
    ready = recheck.prepare(v.drop("keep"), v.select("id", "keep"), 0.35)
    dumped = materialize(recheck.dump(ready, v.where("id % 5 = 0").select("id"), 60), "recheck-dump")
    k = F.col("k").cast("string")
    line = F.when(F.col("k") % 6 == 1, F.concat(k, F.lit(" i A wording by hand for "), k)).when(F.col("k") % 3 == 1, F.concat(k, F.lit(" k"))).otherwise(F.concat(k, F.lit(" d no")))
    path = scratch(spark, "recheck")
    dumped.select(line.alias("value")).coalesce(1).write.text(path)
    restored, done = recheck.apply(dumped, jsonl.read_decisions(spark, path))
    out = dumped.join(done, "id").join(restored.select("id", "question", F.col("keep").alias("_k")), "id", "left")
    return out.select("id", *big("k"), F.coalesce("_k", F.lit(False)).alias("restored"), "question")


# Retrieval

_TOPICS = "SELECT DISTINCT 'https://s.test/spec/' || lang || '/' || source || '/' AS url, lang, source FROM {documents}"


@query(r"""WITH RECURSIVE i AS (SELECT item_id AS id, text AS question, CASE WHEN item_id % 3 = 0 THEN 'spec' ELSE 'docs' END AS kind, 'https://docs.test/' || (item_id % 5) AS key, list_distinct(regexp_extract_all(lower(text), '[a-z0-9:._-]{4,}')) AS w FROM benchmark),
h AS (SELECT id, doc_id, row_number() OVER (PARTITION BY id ORDER BY hits DESC, doc_id) AS rank FROM (SELECT i.id, d.doc_id, len(list_filter(i.w, lambda x: contains(lower(d.text), x))) AS hits FROM i, documents d) WHERE hits > 0),
c AS (SELECT i.id, p.page_id, p.text, row_number() OVER (PARTITION BY i.id ORDER BY len(list_filter(i.w, lambda x: contains(lower(p.text), x))) DESC, p.page_id) AS rank FROM i JOIN (SELECT doc_id * 100000 + w AS page_id, 'https://docs.test/' || (doc_id % 5) AS url, substr(text, CAST(w * 900 + 1 AS BIGINT), 900) AS text FROM (SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil(length(text) / 900.0) AS BIGINT)))) AS w FROM documents)) p ON p.url = i.key AND i.kind = 'docs'),
l AS (SELECT id, 0 AS o, rank, 'https://d.test/' || h.doc_id AS url, d.text AS content FROM h JOIN documents d ON d.doc_id = h.doc_id WHERE rank <= 4 UNION ALL SELECT id, 1, rank, key, text FROM (SELECT c.*, i.key FROM c JOIN i ON i.id = c.id) WHERE rank <= 2),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY o, rank) AS r FROM l), t AS (SELECT i.id, 'https://docs.test/' || (i.id % 5) AS url, 'Topic: T' || (i.id % 5) || chr(10) || left('body ' || repeat('word ', 700), 2500) AS content FROM i WHERE i.id % 5 < 2),
g AS (SELECT i.id, CAST(0 AS BIGINT) AS r, CASE WHEN t.id IS NULL THEN 0 ELSE 2500 END AS used, CAST([] AS VARCHAR[]) AS seen, CASE WHEN t.id IS NULL THEN CAST([] AS VARCHAR[]) ELSE [t.url] END AS urls, coalesce(t.content, '') AS body FROM i LEFT JOIN t ON t.id = i.id
UNION ALL SELECT id, r, CASE WHEN ok THEN used + length(content) ELSE used END, CASE WHEN ok THEN list_append(seen, left(content, 120)) ELSE seen END, CASE WHEN ok THEN list_append(urls, url) ELSE urls END, CASE WHEN ok THEN body || '|' || content ELSE body END
FROM (SELECT g.id, n.r, g.used, g.seen, g.urls, g.body, n.url, n.content, NOT list_contains(g.seen, left(n.content, 120)) AND g.used + length(n.content) <= 8000 AS ok FROM g JOIN n ON n.id = g.id AND n.r = g.r + 1))
SELECT id AS item_id, array_to_string(list_distinct_in_order, ' ') AS links, sha256(ltrim(body, '|')) AS context_sha256 FROM (SELECT id, body, list_filter(urls, lambda x, i: list_position(urls, x) = i) AS list_distinct_in_order, row_number() OVER (PARTITION BY id ORDER BY r DESC) AS k FROM g) WHERE k = 1""")
def answer_context(spark: SparkSession, d: str) -> DataFrame:
    """The context of every benchmark item as a question: its topic, its best four documents, the best two chunks of 900 characters of its page, first fit to 8,000 characters."""
    key = lambda c: F.concat(F.lit("https://docs.test/"), (F.col(c) % 5).cast("string"))
    items, docs = read(spark, d, "benchmark"), read(spark, d, "documents")
    q = materialize(items.select(F.col("item_id").alias("id"), F.col("text").alias("question"), F.when(F.col("item_id") % 3 == 0, "spec").otherwise("docs").alias("source_kind"), key("item_id").alias("source_key")), "asked")
    best = retrieval.top_overlap(q.select(F.col("id").alias("query_id"), F.col("question").alias("query_text")), docs.select(F.col("doc_id").alias("key"), F.col("text").alias("content")), 4)
    # four rows an item: the texts of all others stay where they are
    hits = docs.select(F.col("doc_id").alias("key"), F.col("text").alias("content")).join(F.broadcast(materialize(best, "best")), "key")
    hits = hits.select(F.col("query_id").alias("id"), F.lit(0).alias("query"), "rank", F.concat(F.lit("https://d.test/"), F.col("key").cast("string")).alias("url"), "content")
    chunks = planning.text_windows(docs.select("doc_id", "text"), "text", 900).select(key("doc_id").alias("url"), (F.col("doc_id") * 100000 + F.col("window")).alias("seq"), F.col("part").alias("content"))
    body = F.concat(F.lit("---\ntitle: x\n---body "), F.repeat(F.lit("word "), F.lit(700)))
    topics = q.where("id % 5 < 2").select(F.col("source_key").alias("url"), F.concat(F.lit("T"), (F.col("id") % 5).cast("string")).alias("title"), body.alias("content")).distinct()
    out = retrieval.context_for(q, materialize(hits, "hits"), chunks, topics)
    return out.select(F.col("id").alias("item_id"), F.array_join("links", " ").alias("links"), F.sha2(F.array_join(F.transform("items", lambda i: i["content"]), "|"), 256).alias("context_sha256"))


# Sources


@query("SELECT doc_id, lang, n_chars, CAST(1 AS BIGINT) AS part FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT doc_id, lang, n_chars, 2 FROM documents WHERE doc_id % 2 = 1 UNION ALL SELECT count(*), 'all', CAST(sum(n_chars) AS BIGINT), 3 FROM documents")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Rows written and appended as JSON lines, a document with their counts, and all read again; a missing table is empty, a missing document its fallback."""
    docs = read(spark, d, "documents").select("doc_id", "lang", "n_chars")
    folder = scratch(spark, "jsonl")
    part = lambda k, n: docs.where(F.col("doc_id") % 2 == k).withColumn("part", F.lit(n).cast("long"))
    jsonl.write_jsonl(docs.limit(1).withColumn("part", F.lit(9).cast("long")), f"{folder}/rows")
    jsonl.write_jsonl(part(0, 1), f"{folder}/rows")
    jsonl.append_jsonl(part(1, 2), f"{folder}/rows")
    jsonl.write_json(docs.agg(F.count(F.lit(1)).alias("doc_id"), F.lit("all").alias("lang"), F.sum("n_chars").alias("n_chars")), f"{folder}/summary")
    schema = "doc_id long, lang string, n_chars long, part long"
    summary = jsonl.read_json(spark, f"{folder}/summary", "doc_id long, lang string, n_chars long").withColumn("part", F.lit(3).cast("long"))
    fallback = jsonl.read_json(spark, f"{folder}/none", "doc_id long, lang string, n_chars long", {"doc_id": -1, "lang": "x", "n_chars": 0})
    return jsonl.read_jsonl(spark, f"{folder}/rows", schema).unionByName(jsonl.read_jsonl(spark, f"{folder}/none", schema)).unionByName(summary).join(fallback.select(F.col("doc_id").alias("_f")), F.col("doc_id") == F.col("_f"), "left_anti")


@query("""SELECT CAST(doc_id AS BIGINT) AS key, 'row' AS kind, lang AS value FROM documents WHERE doc_id % 9 NOT IN (0, 1) UNION ALL SELECT rn, 'bad', 'no json ' || doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE doc_id % 9 = 0""")
def jsonl_malformed(spark: SparkSession, d: str) -> DataFrame:
    """The rows of a file of JSON lines and, with their line numbers, what is no JSON; blank lines count as lines."""
    k = F.col("doc_id") % 9
    line = F.when(k == 0, F.concat(F.lit("no json "), F.col("doc_id").cast("string"))).when(k == 1, "").otherwise(F.to_json(F.struct("doc_id", "lang")))
    path = scratch(spark, "lines")
    read(spark, d, "documents").repartition(1).sortWithinPartitions("doc_id").select(line.alias("value")).write.text(path)
    rows, bad = jsonl.read_jsonl_tolerant(spark, path, "doc_id long, lang string")
    return rows.select(F.col("doc_id").alias("key"), F.lit("row").alias("kind"), F.col("lang").alias("value")).unionByName(bad.select(F.col("line").alias("key"), F.lit("bad").alias("kind"), F.col("text").alias("value")))


@query("SELECT DISTINCT regexp_replace(regexp_replace(url, '#.*$', ''), '/$', '') || '/' AS url FROM pages")
def sitemap_pages(spark: SparkSession, d: str) -> DataFrame:
    """The pages that sitemaps of at most 50 entries list."""
    p = planning.batches(read(spark, d, "pages").select("page_id", "url"), 50, [F.col("page_id")])
    entry = F.concat(F.lit("<url><loc> "), "url", F.lit("\n</loc><lastmod>2024-01-01</lastmod></url>"))
    xml = p.groupBy("batch").agg(F.concat(F.lit("<?xml version='1.0'?><urlset>"), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))
    return jsonl.sitemap(xml)


@query("""SELECT 'p' || page_id AS package, CASE WHEN page_id % 5 <> 0 THEN '7.' || (page_id % 3) || '.0' END AS latest, page_id % 5 <> 0 AND page_id % 3 = 1 AS same, page_id % 5 <> 0 AS same_major FROM pages""")
def registry_guard(spark: SparkSession, d: str) -> DataFrame:
    """The latest versions of packages, from a registry that doesn't know some, against the one wanted."""
    wanted = read(spark, d, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("package"), F.lit("7.1.0").alias("wanted"))
    out = tools.version_guard(tools.registry_versions(wanted, _registry), wanted)
    return out.select("package", "latest", "same", "same_major")


def _registry(package: str) -> str:
    n = int(package[1:])
    if n % 5 == 0:
        raise KeyError(package)
    return json.dumps({"name": package, "version": f"7.{n % 3}.0"})


@query("""SELECT 't' || page_id AS slug, CASE WHEN page_id % 2 = 0 THEN 'Title ' || page_id ELSE 't' || page_id END AS title, 'c' || (page_id % 4) AS category, CASE WHEN page_id % 3 = 0 THEN 'draft' ELSE 'stable' END AS status FROM pages""")
def topic_listing(spark: SparkSession, d: str) -> DataFrame:
    """The topics of a listing with their documents; the title is that of the front matter, else the slug."""
    i = F.col("page_id").cast("string")
    p = read(spark, d, "pages")
    line = F.concat(F.lit("- **[Any](https://s.test/spec/c"), (F.col("page_id") % 4).cast("string"), F.lit("/t"), i, F.lit("/)** — "), F.when(F.col("page_id") % 3 == 0, "draft").otherwise("stable"), F.lit(", more"))
    listing = p.groupBy((F.col("page_id") % 7).alias("g")).agg(F.array_join(F.collect_list(line), "\n").alias("text"))
    docs = p.select(F.concat(F.lit("t"), i).alias("slug"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("---\ntitle: \"Title "), i, F.lit("\"\n---\nx"))).otherwise("no front matter").alias("content"))
    return tools.topic_rows(tools.topics(listing), docs).select("slug", "title", "category", "status")


def _stub_post(url: str, body: dict, timeout: float) -> dict:
    said = body["messages"][0]["content"]
    if said.endswith("7"):
        raise OSError("down")
    return {"choices": [{"message": {"content": "" if said.endswith("5") else said.upper()}}]}


def _replies(spark: SparkSession, d: str) -> DataFrame:
    model = models.ChatModel("chat", "http://none.test/", seed=1, post=_stub_post, tries=2, sleep=lambda s: None)
    prompts = read(spark, d, "documents").select("doc_id", F.concat(F.lit("item "), F.col("doc_id").cast("string")).alias("prompt"))
    return models.generate(prompts, model, accept=lambda s: not s.endswith("3"))


@query("""SELECT doc_id, CASE WHEN doc_id % 10 NOT IN (3, 5, 7) THEN 'ITEM ' || doc_id END AS reply, 'chat' AS model, CASE doc_id % 10 WHEN 3 THEN 'the reply was refused' WHEN 5 THEN 'ValueError: an empty reply' WHEN 7 THEN 'OSError: down' END AS error FROM documents""")
def chat_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a chat endpoint that is down for some prompts, empty for some, and refused for others; no failure stops another row."""
    return _replies(spark, d).select("doc_id", "reply", "model", "error")


@query("SELECT 'chat' AS model, count(*) AS calls, count(*) FILTER (WHERE doc_id % 10 IN (3, 5, 7)) AS failed, 2 * count(*) FILTER (WHERE doc_id % 10 NOT IN (3, 5, 7)) AS words, CAST(floor(2 * count(*) FILTER (WHERE doc_id % 10 NOT IN (3, 5, 7)) * CAST(1.4 AS DOUBLE) + 0.5) AS BIGINT) AS tokens FROM documents")
def call_totals(spark: SparkSession, d: str) -> DataFrame:
    return models.call_statistics(_replies(spark, d)).select("model", "calls", "failed", "words", "tokens")


@query("SELECT n_nationkey, upper(n_name) AS reply FROM nation")
def command_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies of a model behind a command."""
    n = read(spark, d, "nation").select("n_nationkey", F.col("n_name").alias("prompt")).coalesce(1)
    return models.generate(n, models.CommandModel("tr", ["tr", "a-z", "A-Z"])).select("n_nationkey", F.upper("reply").alias("reply"))


@query("SELECT item_id, CAST(length(text) + 3 AS DOUBLE) AS chars, CAST(length(text) - length(replace(text, 'e', '')) AS DOUBLE) AS es FROM benchmark")
def embedded_texts(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of an embeddings endpoint, 64 texts a call."""
    def post(url: str, body: dict, timeout: float) -> dict:
        assert len(body["input"]) <= 64
        return {"data": [{"embedding": [float(len(t)), float(t.count("e"))]} for t in body["input"]]}

    out = models.embed(read(spark, d, "benchmark").select("item_id", "text"), models.EmbeddingModel("e", "http://none.test/", prefix="c: ", post=post), "text")
    return out.select("item_id", F.col("vector")[0].alias("chars"), F.col("vector")[1].alias("es"))


def _last_letter(prompt: str) -> str:
    return f"reply {prompt[-1]}"


@query(f"WITH {_Q} SELECT id, CASE WHEN seq % 10 = 4 THEN NULL ELSE 'reply ' || (seq % 10) END AS reply, seq % 10 <> 4 AS by_another FROM q")
def failover_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies by the first model that is up and not the writer, one of three being down; a reply that none gives usably is an error."""
    # the clock stands still, so a model that failed stays in its cooldown for the whole task
    failover = models.Failover([_Down(), models.StubModel("m1", _last_letter), models.StubModel("m2", _last_letter)], clock=lambda: 0.0, sleep=lambda s: None)
    asked = _questions(spark, d).select("id", F.col("model").alias("writer"), F.col("seq").cast("string").alias("prompt"))
    out = models.generate(asked, failover, accept=lambda s: not s.endswith("4"), writer="writer")
    return out.select("id", "reply", (F.col("model") != F.col("writer")).alias("by_another")).fillna({"by_another": False})


@query("""SELECT props, len(string_split(props, ',')) AS n, 'k' AS keys FROM events GROUP BY props""")
def key_signatures(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "events").select("props").distinct()
    return p.select("props", F.size(F.split("props", ",")).cast("long").alias("n"), T.key_signature(F.col("props")).alias("keys"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS at, array_to_string(list_filter(list_transform(string_split(' a, ,' || event_type || ' ,b', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS options FROM events")
def times_and_options(spark: SparkSession, d: str) -> DataFrame:
    e = read(spark, d, "events")
    at = T.iso_time(F.date_trunc("second", F.col("ts")))
    return e.select("event_id", at.alias("at"), F.array_join(T.option_list(F.concat(F.lit(" a, ,"), "event_type", F.lit(" ,b"))), "|").alias("options"))


# A run of all stages


@query(f"""WITH {_Q}, k AS (SELECT * FROM q WHERE area IN ('errors', 'guides') AND seq % 5 <> 0), t AS (SELECT * FROM k ORDER BY seq LIMIT 300) SELECT id, CASE WHEN seq % 4 = 0 THEN 'reject' ELSE 'pass' END AS verdict, 'Answer ' || id AS answer FROM t WHERE seq % 3 <> 0""")
def staged_run(spark: SparkSession, d: str) -> DataFrame:
    """A run of the stages from questions to verdicts, then once more from the answers on, which finds nothing left to do."""
    plan, folder = Plan(), scratch(spark, "run")
    table = lambda name, schema: jsonl.read_jsonl(spark, f"{folder}/{name}", schema)

    @plan.stage("questions")
    def _(s: dict) -> None:
        jsonl.append_jsonl(planning.in_areas(_questions(spark, d), s["areas"]).select("id", "seq"), f"{folder}/questions")

    @plan.stage("review")
    def _(s: dict) -> None:
        jsonl.append_jsonl(state.outstanding(table("questions", "id string, seq long"), table("reviews", "id string, keep boolean"), "id").select("id", (F.col("seq") % 5 != 0).alias("keep")), f"{folder}/reviews")

    @plan.stage("answers")
    def _(s: dict) -> None:
        kept = state.eligible(table("questions", "id string, seq long"), table("reviews", "id string, keep boolean").where("keep"), "id")
        todo = state.outstanding(release.take(kept, [F.col("seq")], s["limit"]), table("answers", "id string, seq long, answer string"), "id")
        jsonl.append_jsonl(todo.select("id", "seq", F.concat(F.lit("Answer "), "id").alias("answer")), f"{folder}/answers")

    @plan.stage("judge")
    def _(s: dict) -> None:
        clean = table("answers", "id string, seq long, answer string").where("seq % 3 <> 0")
        todo = state.outstanding(clean, table("verdicts", "id string, verdict string"), "id")
        jsonl.append_jsonl(todo.select("id", F.when(F.col("seq") % 4 == 0, "reject").otherwise("pass").alias("verdict")), f"{folder}/verdicts")

    @plan.stage("validate", always=True)
    def _(s: dict) -> None:
        s["seen"] = s.get("seen", 0) + 1

    options = {"areas": ["errors", "guides"], "limit": 300}
    ran = plan.run(options) + plan.run(options, "answers")
    assert ran == ["questions", "review", "answers", "judge", "validate", "answers", "judge", "validate"] and options["seen"] == 2
    return table("verdicts", "id string, verdict string").join(table("answers", "id string, seq long, answer string").select("id", "answer"), "id")


# Streams


def _events(spark: SparkSession, d: str, name: str) -> tuple[DataFrame, str, str]:
    from .catalog import _drained

    return _drained(spark, d, name)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_seen(spark: SparkSession, d: str) -> DataFrame:
    """Each user and type once, as the stream first shows it."""
    s, table, checkpoint = _events(spark, d, "first-seen")
    streams.drain_to_table(streams.first_seen(s.select("user_id", "event_type"), ["user_id", "event_type"]), table, checkpoint)
    return spark.read.parquet(table)


@query("""WITH w AS (SELECT date_trunc('hour', ts) AS h, event_type, count(*) AS n FROM events GROUP BY ALL) SELECT strftime(h, '%Y-%m-%d %H') AS hour, event_type, n FROM w WHERE h + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_closed_windows(spark: SparkSession, d: str) -> DataFrame:
    """Hourly counts of the windows that the watermark has closed, in append mode: state holds open windows only, the last hours are still to come."""
    s, table, checkpoint = _events(spark, d, "closed")
    counts = streams.windowed_counts(s.select("ts", "event_type"), "ts", ["event_type"], "1 hour", late="1 hour")
    streams.drain_to_table(counts, table, checkpoint)
    return spark.read.parquet(table).select(F.date_format("window_start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n")
