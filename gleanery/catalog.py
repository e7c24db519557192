"""The query catalogue: each query of the engine's own operators with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text as T
from .operators import checks, code, dedup, planning, refine, release, retrieval, review, selection, state, validate
from .plans.tables import materialize, scratch
from .registry import QUERIES, SQL, big, query, read
from .sources import tools
from .streaming import streams

# State


@query("""SELECT user_id, event_id, event_type, round(value, 6) AS value, first_event FROM (
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn, min(event_id) OVER (PARTITION BY user_id) AS first_event FROM events) WHERE rn = 1""")
def latest_event_per_user(spark: SparkSession, d: str) -> DataFrame:
    out = state.latest_by(read(spark, d, "events"), "user_id", "event_id")
    return out.select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"), F.col("first_seq").alias("first_event"))


@query("SELECT substr(sha256(text), 1, 16) AS key, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_seen_text(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select(T.content_hash(F.col("text"), 16).alias("key"), "doc_id")
    return state.first_by(rows, "key", "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resume_unlabeled_docs(spark: SparkSession, d: str) -> DataFrame:
    return state.outstanding(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def labeled_docs_semi(spark: SparkSession, d: str) -> DataFrame:
    return state.eligible(read(spark, d, "documents").select("doc_id", "lang"), read(spark, d, "labels").where("quality = 1"), "doc_id")


@query("""WITH e AS (SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic, coalesce(e.event_id, -1) AS event_id, coalesce(e.event_type, 'none') AS event_type
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN e ON e.user_id = d.doc_id""")
def latest_state_multijoin(spark: SparkSession, d: str) -> DataFrame:
    last = state.latest_by(read(spark, d, "events").select("user_id", "event_id", "event_type"), "user_id", "event_id").withColumnRenamed("user_id", "doc_id").drop("first_seq")
    x = read(spark, d, "documents").select("doc_id").join(read(spark, d, "labels"), "doc_id", "left").join(last, "doc_id", "left")
    return x.select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic"), F.coalesce("event_id", F.lit(-1).cast("long")).alias("event_id"), F.coalesce("event_type", F.lit("none")).alias("event_type"))


@query("""SELECT k.doc_id, l.doc_id IS NOT NULL AS labelled, d.doc_id IS NOT NULL AS present
FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels) k LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = k.doc_id LEFT JOIN documents d ON d.doc_id = k.doc_id""")
def keyset_union_gate(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = read(spark, d, "documents").select("doc_id"), read(spark, d, "labels").select("doc_id")
    k = state.key_union(docs, labels, key="doc_id")
    return k.join(labels.distinct().withColumn("_l", F.lit(True)), "doc_id", "left").join(docs.withColumn("_d", F.lit(True)), "doc_id", "left").select("doc_id", F.col("_l").isNotNull().alias("labelled"), F.col("_d").isNotNull().alias("present"))


# Pages and planning

_URL = "regexp_replace(regexp_replace({0}, '(?s)#.*$', ''), '/$', '') || '/'"
_PATH = "regexp_replace(regexp_replace(regexp_replace(url, '(?s)[#?].*$', ''), '^[a-z]+://[^/]*/?', ''), '/$', '')"
LANG_RULES = [("^en/[0-4]", "english-low", 28), ("^en/", "english", 16), ("^fr/", "french", 6), ("^de/", "german", 5)]
_AREA = f"CASE WHEN regexp_matches({_PATH}, '^en/[0-4]') THEN 'english-low' WHEN regexp_matches({_PATH}, '^en/') THEN 'english' WHEN regexp_matches({_PATH}, '^fr/') THEN 'french' WHEN regexp_matches({_PATH}, '^de/') THEN 'german' ELSE 'basics' END"
_WEIGHT = "CASE area WHEN 'english-low' THEN 28 WHEN 'english' THEN 16 WHEN 'french' THEN 6 WHEN 'german' THEN 5 ELSE 18 END"


@query(f"SELECT page_id, {_URL.format('url')} AS url FROM pages")
def url_normalize(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", T.normalize_url(F.col("url")).alias("url"))


@query(f"SELECT page_id, area, CAST({_WEIGHT} AS BIGINT) AS weight FROM (SELECT page_id, {_AREA} AS area FROM pages)")
def url_classify_area(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", planning.classify(T.url_path(F.col("url")), LANG_RULES).alias("a")).select("page_id", "a.area", F.col("a.weight").cast("long").alias("weight"))


@query(f"""WITH p AS (SELECT page_id, {_AREA} AS area, len(regexp_extract_all(html, '<p>')) AS chunks FROM pages), w AS (SELECT *, {_WEIGHT} AS weight FROM p),
q AS (SELECT area, CASE WHEN chunks > 0 THEN greatest(1, floor(weight / CAST((SELECT sum(weight) FROM w WHERE chunks > 0) AS DOUBLE) * CAST(6200 AS DOUBLE) * CAST(0.9 AS DOUBLE) + CAST(0.5 AS DOUBLE))) ELSE 0 END AS quota FROM w)
SELECT area, CAST(sum(quota) AS BIGINT) AS quota, count(*) AS pages FROM q GROUP BY area""")
def quota_by_area(spark: SparkSession, d: str) -> DataFrame:
    pages = read(spark, d, "pages")
    chunks = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<p>"), F.lit(0))))
    p = pages.select("page_id", planning.classify(T.url_path(F.col("url")), LANG_RULES).alias("a")).select("page_id", "a.*")
    return planning.allocate(planning.chunk_counts(p, chunks, "page_id")).groupBy("area").agg(F.sum("quota").alias("quota"), F.count(F.lit(1)).alias("pages"))


@query(r"""SELECT page_id, array_to_string(list_filter(list_transform(regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), lambda x: trim(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&[#a-zA-Z0-9]+;', ' ', 'g'))), lambda x: x <> ''), '|') AS headings FROM pages""")
def page_headings(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", F.array_join(T.headings(F.col("html"), "1"), "|").alias("headings"))


@query(f"SELECT page_id, translate(CASE WHEN len(p) > 1 THEN p[-2] || ' ' || p[-1] ELSE p[-1] END, '-_', '  ') AS words FROM (SELECT page_id, string_split({_PATH}, '/') AS p FROM pages)")
def path_to_query(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", T.path_query(T.url_path(F.col("url"))).alias("words"))


@query(f"""WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href, regexp_extract(url, '^[a-z]+://[^/]*') AS host FROM pages)
SELECT page_id, {_URL.format("CASE WHEN starts_with(href, '/') THEN host || href ELSE href END")} AS target, count(*) AS n FROM h GROUP BY ALL""")
def href_extract(spark: SparkSession, d: str) -> DataFrame:
    h = read(spark, d, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://[^/]*", 0).alias("host"), F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href"))
    full = F.when(F.startswith("href", F.lit("/")), F.concat("host", "href")).otherwise(F.col("href"))
    return h.groupBy("page_id", T.normalize_url(full).alias("target")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT doc_id, w AS window, sha256(substr(text, CAST(w * 9000 + 1 AS BIGINT), 9000)) AS part_sha256 FROM (
SELECT doc_id, text, unnest(range(0, greatest(1, CAST(ceil(length(text) / 9000.0) AS BIGINT)))) AS w FROM documents)""")
def doc_windows(spark: SparkSession, d: str) -> DataFrame:
    return planning.text_windows(read(spark, d, "documents").select("doc_id", "text"), "text").select("doc_id", F.col("window").cast("long").alias("window"), F.sha2("part", 256).alias("part_sha256"))


@query("SELECT doc_id, lang, (n - 1) // 40 AS batch, (n - 1) % 40 + 1 AS pos FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents)")
def doc_batches(spark: SparkSession, d: str) -> DataFrame:
    return planning.batches(read(spark, d, "documents").select("doc_id", "lang"), 40, [F.col("doc_id")], ["lang"]).select("doc_id", "lang", *big("batch", "pos"))


@query("SELECT doc_id, (n - 1) % 7 AS slot FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents)")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    return planning.round_robin(read(spark, d, "documents").select("doc_id"), 7, [F.col("doc_id")]).select("doc_id", *big("slot"))


@query("""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS n FROM documents), t AS (SELECT count(*) AS t FROM documents),
i AS (SELECT DISTINCT CAST(floor(i * (SELECT t FROM t) / CAST(100 AS DOUBLE)) AS BIGINT) AS n FROM range(0, 100) x(i)) SELECT r.doc_id, r.n FROM r JOIN i ON i.n = r.n""")
def systematic_sample(spark: SparkSession, d: str) -> DataFrame:
    return planning.systematic_sample(read(spark, d, "documents").select("doc_id"), 100, [F.col("doc_id")]).select("doc_id", *big("n"))


@query("""WITH q AS (SELECT source, CAST(count(*) AS BIGINT) AS quota, CAST(count(*) FILTER (WHERE lang <> 'en') AS BIGINT) AS done FROM documents GROUP BY source),
x AS (SELECT source, quota - done AS remaining, CAST(ceil(done / 6.0) AS BIGINT) AS first_batch, unnest(range(0, CAST(ceil((quota - done) / 6.0) AS BIGINT))) AS k FROM q WHERE quota > done)
SELECT source, first_batch + k AS batch, least(6, remaining - k * 6) AS n FROM x""")
def job_expansion(spark: SparkSession, d: str) -> DataFrame:
    q = read(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("quota"), F.count_if(F.col("lang") != "en").alias("done"))
    return planning.jobs(q).select("source", *big("batch", "n"))


@query("SELECT source, array_to_string(list_slice(list(doc_id ORDER BY doc_id), greatest(1, len(list(doc_id)) - 11), len(list(doc_id))), ',') AS last_ids FROM documents GROUP BY source")
def prior_list(spark: SparkSession, d: str) -> DataFrame:
    """The last 12 documents of each source, as the list a generator is told to avoid."""
    rows = planning.numbered(read(spark, d, "documents").select("source", "doc_id"), [F.desc("doc_id")], ["source"]).where("n < 12")
    return rows.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("last_ids"))


@query("SELECT doc_id, 'd_' || substr(sha256(source || text), 1, 10) AS id, CAST(('0x' || substr(sha256(text), 1, 8)) AS BIGINT) AS seed FROM documents")
def content_hash_id(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.concat(F.lit("d_"), T.content_hash(F.concat("source", "text"))).alias("id"), T.seed(F.col("text")).alias("seed"))


# Checks

DOC_RULES = [("shouting", "[A-Z]{4,}!!"), ("marks", r"[a-z][$%&#*]{3}"), ("bars", r"\| [a-z]+ \|"), ("license", "licen[cs]e"), ("secret", "(api|secret)[_-]?key"), ("mail", r"[a-z0-9._-]+@[a-z0-9-]+\.[a-z]+")]
DOC_ARTIFACTS = ["(?i)(todo|fixme|lorem ipsum)", "(?i)idiot", "(?i)worthless", "(?i)copyright"]
_CHECKS = "list_filter([" + ", ".join([
    "CASE WHEN length(text) < 60 THEN 'too-short' END", "CASE WHEN (length(text) - length(replace(text, '```', ''))) // 3 % 2 = 1 THEN 'unclosed-fence' END",
    *[f"CASE WHEN regexp_matches(text, '{p}') THEN 'artifact:{p.removeprefix('(?i)')[:24]}' END" for p in DOC_ARTIFACTS],
    *[f"CASE WHEN regexp_matches(text, '(?i){p}') THEN 'stale:{i}' END" for i, p in DOC_RULES],
]) + "], lambda x: x IS NOT NULL)"


def _doc_checks(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    docs = read(spark, d, "documents").select("doc_id", "text")
    hard = F.concat(checks.labels((F.length(t) < 60, "too-short"), (T.unclosed_fence(t), "unclosed-fence")), checks.artifact_labels(t, DOC_ARTIFACTS), F.transform(checks.rule_labels(t, DOC_RULES), lambda i: F.concat(F.lit("stale:"), i)))
    return docs.select("doc_id", hard.alias("hard"))


@query(f"SELECT doc_id, array_to_string({_CHECKS}, '|') AS hard FROM documents")
def text_checks(spark: SparkSession, d: str) -> DataFrame:
    return _doc_checks(spark, d).select("doc_id", F.array_join("hard", "|").alias("hard"))


@query(f"SELECT split_part(l, ':', 1) AS label, count(*) AS n FROM (SELECT unnest({_CHECKS}) AS l FROM documents) GROUP BY 1")
def check_histogram(spark: SparkSession, d: str) -> DataFrame:
    return checks.histogram(_doc_checks(spark, d), "hard")


@query("SELECT r.rule_id, count(*) AS hits, min(d.doc_id) AS first_doc FROM documents d, (VALUES " + ", ".join(f"('{i}', '{p}')" for i, p in DOC_RULES) + ") r(rule_id, re) WHERE regexp_matches(d.text, '(?i)' || r.re) GROUP BY r.rule_id")
def rule_hits(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(DOC_RULES, "rule_id string, re string")
    return checks.rule_hits(read(spark, d, "documents").select("doc_id", "text"), rules).groupBy("rule_id").agg(F.count(F.lit(1)).alias("hits"), F.min("doc_id").alias("first_doc"))


_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


@query(rf"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{_MAIL}')) AS BIGINT) AS mails, CAST(len(regexp_extract_all(text, 'https?://[^\s)>\]"]+')) AS BIGINT) AS links FROM documents
WHERE regexp_matches(text, '{_MAIL}') OR regexp_matches(text, 'https?://')""")
def pii_link_scan(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "documents").select("doc_id", F.regexp_count("text", F.lit(_MAIL)).cast("long").alias("mails"), F.size(T.links(F.col("text"))).cast("long").alias("links"))
    return x.where((F.col("mails") > 0) | (F.col("links") > 0))


@query("""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN l.toxic = 1 THEN 'toxic' WHEN l.quality = 0 THEN 'low-quality' WHEN length(d.text) < 200 THEN 'too-short' ELSE 'kept' END AS reason
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) GROUP BY reason""")
def gate_reasons(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    ok, low = F.lit(5.0), F.lit(1.0)
    text = "string"
    questions = x.select(F.col("doc_id").alias("id"), F.lit("q").alias("question"))
    answers = x.select(F.col("doc_id").alias("id"), F.col("text").alias("answer"), F.array().cast("array<string>").alias("sources"))
    verdict = F.when(F.col("quality") == 0, "reject").otherwise("pass")
    judge = x.select(F.col("doc_id").alias("id"), verdict.alias("verdict"), ok.alias("accuracy"), ok.alias("version"), F.when(F.length("text") < 200, low).otherwise(ok).alias("usefulness"), ok.alias("concise"), F.lit(None).cast(text).alias("fixed_answer"))
    none = x.limit(0).select(F.col("doc_id").alias("id"))
    checks_ = none.select("id", F.array().cast("array<string>").alias("hard"), F.array().cast("array<string>").alias("soft"))
    grade = F.struct(F.lit("").alias("verdict"), ok.alias("accuracy"), ok.alias("version"), ok.alias("usefulness"), ok.alias("concise"))
    refined = x.where(F.col("quality").isNull() & F.col("toxic").isNull()).select(F.col("doc_id").alias("id"), F.lit("retry").alias("status"), F.lit("").alias("answer"), F.array().cast("array<string>").alias("soft"), grade.alias("verdict"))
    manual = x.where("toxic = 1").select(F.col("doc_id").alias("id"), F.lit("drop").alias("action"), F.lit(None).cast(text).alias("answer"), F.lit(None).cast(text).alias("question"))
    out = selection.candidates(questions, answers, checks_, judge, refined, checks_, checks_.select("id", "hard"), manual)
    names = {"refine-retry": "unlabelled", "manual-drop": "toxic", "judge-reject": "low-quality", "low-scores": "too-short"}
    renamed = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])
    dropped = selection.drop_histogram(out).select(renamed[F.col("drop_reason")].alias("reason"), "n")
    return dropped.unionByName(out.where("drop_reason is null").agg(F.count(F.lit(1)).alias("n")).where("n > 0").select(F.lit("kept").alias("reason"), "n"))


_GRADES = "CAST(CASE WHEN l.quality = 1 THEN 5 ELSE 2 END AS DOUBLE) AS accuracy, CAST(CASE WHEN l.toxic = 0 THEN 5 ELSE 1 END AS DOUBLE) AS version, CAST(d.n_chars % 3 + 3 AS DOUBLE) AS usefulness, CAST(CASE WHEN length(d.text) < 6000 THEN 4 ELSE 2 END AS DOUBLE) AS concise"


def _graded(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id")
    grade = F.struct(
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "pass").otherwise("fix").alias("verdict"), F.when(F.col("quality") == 1, 5.0).otherwise(2.0).alias("accuracy"), F.when(F.col("toxic") == 0, 5.0).otherwise(1.0).alias("version"),
        (F.col("n_chars") % 3 + 3).cast("double").alias("usefulness"), F.when(F.length("text") < 6000, 4.0).otherwise(2.0).alias("concise"),
    )
    return x.select("doc_id", "text", "lang", "source", "n_chars", grade.alias("v"))


@query(f"""SELECT doc_id, accuracy >= 4 AND version >= 4 AND usefulness >= 4 AND concise >= 3 AS ok,
round(2 * accuracy + 2 * version + 1.5 * usefulness + concise + CASE WHEN accuracy = 5 AND version = 5 THEN 1 ELSE 0 END - 0.75 * soft, 4) AS score
FROM (SELECT d.doc_id, {_GRADES}, CASE WHEN length(d.text) > 2600 THEN 1 ELSE 0 END AS soft FROM documents d JOIN labels l ON l.doc_id = d.doc_id)""")
def score_candidates(spark: SparkSession, d: str) -> DataFrame:
    soft = checks.labels((F.length("text") > 2600, "long"))
    return _graded(spark, d).select("doc_id", selection.gates_ok(F.col("v")).alias("ok"), F.round(selection.score(F.col("v"), soft, F.lit(False)), 4).alias("score"))


# Near-duplicates

_SHINGLES = "list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))"
_WORDS = "string_split(trim(regexp_replace(lower({0}), '[^a-z0-9:./@-]+', ' ', 'g')), ' ')"


@query(f"""WITH s AS (SELECT doc_id, {_SHINGLES} AS sh FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents)),
r AS (SELECT min(doc_id) AS rep, sh, len(sh) AS n FROM s WHERE len(sh) >= 4 GROUP BY sh), e AS (SELECT rep, n, unnest(sh) AS g FROM r),
c AS (SELECT x.rep AS a, y.rep AS b, x.n AS na, y.n AS nb, count(*) AS k FROM e x JOIN e y ON x.g = y.g AND x.rep < y.rep GROUP BY ALL)
SELECT a, b, round(k / CAST(na + nb - k AS DOUBLE), 6) AS jaccard FROM c WHERE k / CAST(na + nb - k AS DOUBLE) > CAST(0.7 AS DOUBLE)""")
def shingle_jaccard_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of class representatives; ``shingle_membership`` tells which documents each stands for."""
    return dedup.jaccard_pairs(dedup.shingle_sets(read(spark, d, "documents"), "doc_id", "text")).select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query(f"WITH s AS (SELECT doc_id, {_SHINGLES} AS sh FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents)) SELECT doc_id, min(doc_id) OVER (PARTITION BY sh) AS rep, CAST(len(sh) AS BIGINT) AS n_shingles FROM s")
def shingle_membership(spark: SparkSession, d: str) -> DataFrame:
    return dedup.shingle_classes(read(spark, d, "documents"), "doc_id", "text").select(F.col("id").alias("doc_id"), "rep", F.col("n").cast("long").alias("n_shingles"))


@query(f"""WITH i AS (SELECT item_id, {_SHINGLES} AS sh FROM (SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark)), e AS (SELECT item_id, len(sh) AS n, unnest(sh) AS g FROM i),
s AS (SELECT doc_id, unnest({_SHINGLES}) AS g FROM (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents))
SELECT doc_id, item_id, round(count(*) / CAST(max(n) AS DOUBLE), 6) AS share FROM s JOIN e ON s.g = e.g GROUP BY doc_id, item_id HAVING count(*) >= 0.5 * max(n)""")
def benchmark_overlap(spark: SparkSession, d: str) -> DataFrame:
    out = retrieval.held_shares(read(spark, d, "documents"), read(spark, d, "benchmark"), 0.5)
    return out.select("doc_id", "item_id", F.round("share", 6).alias("share"))


_PAIRS = "SELECT x.vec_id AS a, y.vec_id AS b, list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) AS c FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])) > CAST(0.35 AS DOUBLE)"


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("vec_id").alias("rank"), "label")


@query(f"SELECT a, b, round(c, 5) AS cosine FROM ({_PAIRS})")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    return dedup.cosine_pairs(_vectors(spark, d), 0.35).select("a", "b", F.round("cosine", 5).alias("cosine"))


_GREEDY = """n AS (SELECT k.id, row_number() OVER (ORDER BY k.id) AS r, coalesce(list(p.o) FILTER (WHERE p.o IS NOT NULL), []) AS nb FROM {0} k LEFT JOIN (SELECT a AS s, b AS o FROM p UNION ALL SELECT b, a FROM p) p ON p.s = k.id GROUP BY k.id),
g AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS kept UNION ALL SELECT n.r, CASE WHEN list_has_any(g.kept, n.nb) THEN g.kept ELSE list_append(g.kept, n.id) END FROM g JOIN n ON n.r = g.r + 1)
SELECT unnest(kept) AS id FROM g WHERE r = (SELECT max(r) FROM g)"""


@query(f"WITH RECURSIVE p AS ({_PAIRS}), " + _GREEDY.format("(SELECT vec_id AS id FROM embeddings)"))
def greedy_semantic_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.greedy_vectors(_vectors(spark, d), 0.35).select("id")


@query(f"WITH RECURSIVE p AS ({_PAIRS}), k AS (SELECT vec_id AS id FROM embeddings WHERE label % 2 = 0), f AS (SELECT vec_id AS id FROM embeddings WHERE label % 2 = 1 AND vec_id NOT IN (SELECT a FROM p WHERE b IN (SELECT id FROM k)) AND vec_id NOT IN (SELECT b FROM p WHERE a IN (SELECT id FROM k))), " + _GREEDY.format("f"))
def recheck_dedup(spark: SparkSession, d: str) -> DataFrame:
    v = _vectors(spark, d)
    return dedup.recheck(v.where("label % 2 = 1"), v.where("label % 2 = 0"), 0.35).select("id")


# Selection

SELECT_N, SELECT_AREA, SELECT_PAGE, SELECT_LEVELS = 120, 0.4, 9, {"short": 0.2, "medium": 0.4, "long": 0.3}
_LEVEL = "CASE WHEN n_chars < 800 THEN 'short' WHEN n_chars < 3000 THEN 'medium' ELSE 'long' END"
_OK = f"len(areas) < {SELECT_N} AND len(list_filter(areas, lambda x: x = area)) < CAST({SELECT_AREA} AS DOUBLE) * {SELECT_N} AND len(list_filter(pages, lambda x: x = page)) < {SELECT_PAGE}"
_STEP = "CASE WHEN ok THEN list_append(areas, area) ELSE areas END AS areas, CASE WHEN ok THEN list_append(pages, page) ELSE pages END AS pages, CASE WHEN ok THEN list_append(levels, level) ELSE levels END AS levels, CASE WHEN ok THEN list_append(ids, doc_id) ELSE ids END AS ids"
_LIMIT = " ".join(f"WHEN '{k}' THEN {v}" for k, v in SELECT_LEVELS.items())


@query(f"""WITH RECURSIVE u AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY trim(regexp_replace(lower(text), '[ \\t-\\r]+', ' ', 'g'))),
s AS (SELECT d.doc_id, d.lang AS area, d.source AS page, {_LEVEL} AS level, round(2 * 5 + 2 * 5 + 1.5 * CAST(d.n_chars % 3 + 3 AS DOUBLE) + 4 + 1 - CASE WHEN length(d.text) > 2600 THEN 0.75 ELSE 0 END, 4) AS score
      FROM documents d JOIN labels l ON l.doc_id = d.doc_id JOIN u ON u.doc_id = d.doc_id WHERE l.quality = 1 AND l.toxic = 0 AND d.n_chars % 3 >= 1 AND length(d.text) < 6000),
c AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS r FROM s),
p1 AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS VARCHAR[]) AS areas, CAST([] AS VARCHAR[]) AS pages, CAST([] AS VARCHAR[]) AS levels, CAST([] AS BIGINT[]) AS ids
       UNION ALL SELECT r, {_STEP} FROM (SELECT c.r, c.area, c.page, c.level, c.doc_id, p.areas, p.pages, p.levels, p.ids, {_OK} AND len(list_filter(p.levels, lambda x: x = c.level)) < CASE c.level {_LIMIT} END * CAST({SELECT_N} AS DOUBLE) * CAST(1.1 AS DOUBLE) AS ok FROM p1 p JOIN c ON c.r = p.r + 1)),
f1 AS (SELECT * FROM p1 WHERE r = (SELECT max(r) FROM p1)),
c2 AS (SELECT doc_id, area, page, level, row_number() OVER (ORDER BY r) AS r FROM c WHERE doc_id NOT IN (SELECT unnest(ids) FROM f1)),
p2 AS (SELECT CAST(0 AS BIGINT) AS r, areas, pages, levels, CAST([] AS BIGINT[]) AS ids FROM f1
       UNION ALL SELECT r, {_STEP} FROM (SELECT c2.r, c2.area, c2.page, c2.level, c2.doc_id, p.areas, p.pages, p.levels, p.ids, {_OK} AS ok FROM p2 p JOIN c2 ON c2.r = p.r + 1))
SELECT unnest(ids) AS doc_id, CAST(1 AS BIGINT) AS pass FROM f1 UNION ALL SELECT unnest(ids) AS doc_id, CAST(2 AS BIGINT) AS pass FROM p2 WHERE r = (SELECT max(r) FROM p2)""")
def capped_selection(spark: SparkSession, d: str) -> DataFrame:
    """Gates, score, exact deduplication of normalised texts and two passes under caps over labelled documents."""
    first = state.first_by(read(spark, d, "documents").select(F.sha2(F.trim(F.regexp_replace(F.lower("text"), r"[ \t-\r]+", " ")), 256).alias("key"), "doc_id"), "key", "doc_id").select("doc_id")
    g = _graded(spark, d).where((F.col("v.verdict") == "pass") & selection.gates_ok(F.col("v"))).join(first, "doc_id", "left_semi")
    soft = checks.labels((F.length("text") > 2600, "long"))
    level = F.when(F.col("n_chars") < 800, "short").when(F.col("n_chars") < 3000, "medium").otherwise("long")
    c = g.select(F.col("doc_id").alias("id"), F.col("lang").alias("area"), F.col("source").alias("page"), level.alias("difficulty"), F.round(selection.score(F.col("v"), soft, F.lit(False)), 4).alias("score"))
    c = planning.numbered(c, [F.desc("score"), F.col("id")], name="rank")
    took = selection.capped(c, SELECT_N, {}, other_cap=SELECT_AREA, page_cap=SELECT_PAGE, difficulty=SELECT_LEVELS)
    return took.select(F.col("id").alias("doc_id"), F.col("pass").cast("long").alias("pass"))


@query(f"""SELECT key, value, count(*) AS n FROM (SELECT unnest([{{'key': 'lang', 'value': d.lang}}, {{'key': 'source', 'value': d.source}}, {{'key': 'level', 'value': {_LEVEL}}}, {{'key': 'quality', 'value': CAST(l.quality AS VARCHAR)}}]) AS x
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) t(x), LATERAL (SELECT x.key AS key, x.value AS value) GROUP BY key, value""")
def distributions(spark: SparkSession, d: str) -> DataFrame:
    level = F.when(F.col("n_chars") < 800, "short").when(F.col("n_chars") < 3000, "medium").otherwise("long")
    x = read(spark, d, "documents").select("doc_id", "lang", "source", level.alias("level")).join(read(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return selection.distributions(x, ["lang", "source", "level", "quality"])


@query("SELECT lang, CAST(sum(w) AS BIGINT) AS words, CAST(floor(sum(w) * CAST(1.4 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS tokens FROM (SELECT lang, len(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')) AS w FROM documents) GROUP BY lang")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    x = read(spark, d, "documents").groupBy("lang").agg(F.sum(T.word_count(F.col("text"))).alias("words"))
    return x.select("lang", "words", T.js_round(F.col("words") * F.lit(1.4)).alias("tokens"))


# Retrieval

_QW = "list_distinct(regexp_extract_all(lower({0}), '[a-z0-9:._-]{{4,}}'))"


@query(f"""WITH q AS (SELECT item_id, {_QW.format('text')} AS w FROM benchmark), s AS (SELECT q.item_id, d.doc_id, len(list_filter(q.w, lambda x: contains(lower(d.text), x))) AS hits FROM q, documents d)
SELECT item_id, doc_id, CAST(hits AS BIGINT) AS hits, rk FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY hits DESC, doc_id) AS rk FROM s WHERE hits > 0) WHERE rk <= 4""")
def overlap_topk(spark: SparkSession, d: str) -> DataFrame:
    q = read(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    c = read(spark, d, "documents").select(F.col("doc_id").alias("key"), F.col("text").alias("content"))
    return retrieval.top_overlap(q, c, 4).select(F.col("query_id").alias("item_id"), F.col("key").alias("doc_id"), *big("hits"), F.col("rank").cast("long").alias("rk"))


@query("""WITH RECURSIVE h AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents WHERE n_chars <= 8000),
g AS (SELECT DISTINCT source, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS used, CAST(NULL AS BIGINT) AS doc_id, false AS ok FROM h
      UNION ALL SELECT g.source, h.r, CASE WHEN g.used + h.n_chars <= 8000 THEN g.used + h.n_chars ELSE g.used END, h.doc_id, g.used + h.n_chars <= 8000 FROM g JOIN h ON h.source = g.source AND h.r = g.r + 1)
SELECT source, doc_id FROM g WHERE ok""")
def budget_pack(spark: SparkSession, d: str) -> DataFrame:
    """First fit of each source's documents, in order of their ids, to 8,000 characters."""
    return retrieval.first_fit_rows(read(spark, d, "documents").select("source", "doc_id", "n_chars"), "source", "doc_id", "n_chars", 8000).select("source", "doc_id")


# Conversations and models


def _chat(spark: SparkSession, d: str) -> DataFrame:
    """The first user turn of a conversation with the answer that follows it."""
    t = read(spark, d, "conversations")
    u = t.where("role = 'user'").groupBy("conv_id").agg(F.min("turn").alias("turn"))
    q = t.join(u, ["conv_id", "turn"]).where("role = 'user'").select("conv_id", "turn", F.col("text").alias("q"))
    a = t.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a"))
    return q.join(a, ["conv_id", "turn"]).select(F.col("conv_id").cast("string").alias("id"), F.array(F.struct(F.lit("user").alias("role"), F.col("q").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content"))).alias("messages"))


_CHAT = "SELECT q.conv_id, q.text AS q, a.text AS a FROM conversations q JOIN (SELECT conv_id, min(turn) AS t FROM conversations WHERE role = 'user' GROUP BY conv_id) f ON f.conv_id = q.conv_id AND f.t = q.turn AND q.role = 'user' JOIN conversations a ON a.conv_id = q.conv_id AND a.turn = q.turn + 1 AND a.role = 'assistant'"


@query(f"SELECT CAST(conv_id AS VARCHAR) AS id, sha256(q) AS question_sha256, sha256(a) AS answer_sha256 FROM ({_CHAT})")
def chat_pair_export(spark: SparkSession, d: str) -> DataFrame:
    return _chat(spark, d).select("id", F.sha2(F.col("messages")[0]["content"], 256).alias("question_sha256"), F.sha2(F.col("messages")[1]["content"], 256).alias("answer_sha256"))


@query(f"""WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS id, q, a, trim(regexp_replace(lower(q), '[ \\t-\\r]+', ' ', 'g')) AS n FROM ({_CHAT})), s AS (SELECT id, {_SHINGLES} AS sh FROM (SELECT id, {_WORDS.format('q')} AS w FROM c)),
r AS (SELECT min(id) AS rep, sh, len(sh) AS n FROM s GROUP BY sh), e AS (SELECT rep, n, unnest(sh) AS g FROM r WHERE n >= 4), k AS (SELECT x.rep AS a, y.rep AS b, x.n AS na, y.n AS nb, count(*) AS k FROM e x JOIN e y ON x.g = y.g AND x.rep < y.rep GROUP BY ALL)
SELECT 'short-question' AS rule, id, '' AS detail FROM c WHERE length(trim(q)) < 15 UNION ALL SELECT 'short-answer', id, '' FROM c WHERE length(trim(a)) < 40
UNION ALL SELECT 'duplicate-question', id, first FROM (SELECT id, min(id) OVER (PARTITION BY n) AS first FROM c) WHERE id <> first
UNION ALL SELECT 'near-duplicate', b, a FROM k WHERE k / CAST(na + nb - k AS DOUBLE) > CAST(0.7 AS DOUBLE)
UNION ALL SELECT 'near-duplicate', s.id, r.rep FROM s JOIN r ON r.sh = s.sh WHERE s.id <> r.rep AND r.n >= 4""")
def chat_validate(spark: SparkSession, d: str) -> DataFrame:
    data = materialize(_chat(spark, d), "chat")
    meta = data.select("id", F.lit("how-to").alias("type"), F.lit("basics").alias("topic"), F.lit("1").alias("version"))
    return validate.failures(data, meta, version="1")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def loose_json_props(spark: SparkSession, d: str) -> DataFrame:
    """Properties that a model might have wrapped in prose and a fence, found again."""
    wrapped = F.concat(F.lit("Here it is:\n```json\n"), "props", F.lit("\n```\nthat is all"))
    return read(spark, d, "events").select("event_id", F.get_json_object(T.loose_json(wrapped), "$.k").cast("long").alias("k"))


_STUB = "CASE WHEN n_chars % 5 = 0 THEN 'reject' WHEN n_chars % 5 = 1 THEN 'fix' ELSE 'pass' END"


def _stub_replies(b: DataFrame, keys: list[str]) -> DataFrame:
    """A reply per batch as a judge would write it; a deterministic stub."""
    item = F.to_json(F.struct(F.col("pos").cast("string").alias("i"), F.when(F.col("n_chars") % 5 == 0, "reject").when(F.col("n_chars") % 5 == 1, "fix").otherwise("pass").alias("verdict"), (F.col("n_chars") % 3 + 3).cast("string").alias("accuracy"), F.lit("5").alias("version"), F.when(F.col("n_chars") % 7 == 0, "n/a").otherwise("4").alias("usefulness"), F.lit("4").alias("concise"), F.lit("").alias("issues"), F.lit("better").alias("fixed_answer")))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", item.alias("item")))), lambda x: x["item"]), ",")
    return b.groupBy(*keys).agg(F.concat(F.lit("Sure:\n["), lines, F.lit("]")).alias("reply")).withColumn("model", F.lit("stub"))


@query(f"SELECT doc_id, {_STUB} AS verdict, CAST(n_chars % 3 + 3 AS DOUBLE) AS accuracy, CAST(CASE WHEN n_chars % 7 = 0 THEN 0 ELSE 4 END AS DOUBLE) AS usefulness FROM documents")
def judge_stub_verdicts(spark: SparkSession, d: str) -> DataFrame:
    b = planning.batches(read(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars"), 8, [F.col("id")], ["lang"])
    return review.verdicts(b, _stub_replies(b, ["lang", "batch"]), ["lang", "batch"]).select(F.col("id").alias("doc_id"), "verdict", "accuracy", "usefulness")


@query("""SELECT doc_id, CASE WHEN k = 3 THEN 'gave-up' ELSE 'accepted' END AS status, CAST(CASE WHEN k = 0 THEN 1 ELSE 2 END AS BIGINT) AS rounds FROM (SELECT doc_id, doc_id % 4 AS k FROM documents)""")
def refine_loop_stub(spark: SparkSession, d: str) -> DataFrame:
    """Four fates of a draft: accepted at once; after another rewrite; by a reviewer's fix, checked as it is; useless twice and given up."""
    items = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit("draft 0").alias("answer"), F.lit("writer").alias("model"), F.array(F.lit("first")).alias("problems"), F.lit("retry").alias("mode"), F.lit(0).alias("round"), F.lit(0).alias("low_use"))
    k = F.col("id").cast("long") % 4

    def judge(x: DataFrame) -> DataFrame:
        fixed = F.startswith("answer", F.lit("fixed"))
        kind = F.when((k == 0) | fixed | ((k == 1) & (F.col("round") >= 2)), "pass").when(k == 2, "fix").otherwise("reject")
        grade = F.when(k == 3, 1.0).otherwise(5.0)
        return x.select("id", F.struct(kind.alias("verdict"), F.lit(5.0).alias("accuracy"), F.lit(5.0).alias("version"), grade.alias("usefulness"), F.lit(5.0).alias("concise"), F.lit("").alias("issues"), F.when(kind == "fix", "fixed text").alias("fixed_answer")).alias("verdict"), F.lit("judge").alias("judge"))

    none = F.array().cast("array<string>")
    log = refine.refine(items, lambda x: x.select("id", F.lit("draft").alias("answer"), F.lit("writer").alias("model")), lambda x: x.select("id", none.alias("hard")), lambda x: x.select("id", none.alias("hard")), judge)
    last = state.latest_by(log.select("id", "seq", "status", "round"), "id", "seq")
    return last.select(F.col("id").cast("long").alias("doc_id"), "status", F.col("round").cast("long").alias("rounds"))


@query("SELECT doc_id, CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS hard, CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS soft, CAST(CASE WHEN doc_id % 3 = 2 THEN 0 ELSE 1 END AS BIGINT) AS checked FROM documents")
def code_roll_up(spark: SparkSession, d: str) -> DataFrame:
    """Snippets of answers, a stub's diagnostics for each, and their roll-up."""
    k = F.col("doc_id") % 3
    body = F.when(k == 0, "```ts\nimport { gone } from 'engine:x'\n```").when(k == 1, "```ts\nimport { here } from 'engine:x'\n```").otherwise("no code")
    answers = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), body.alias("answer"))
    found = F.array(F.struct(F.lit(2305).alias("code"), F.lit(1).alias("line"), F.lit("has no exported member 'gone'").alias("msg")), F.struct(F.lit(7006).alias("code"), F.lit(1).alias("line"), F.lit("implicitly any").alias("msg")))
    checked = code.snippets(answers).withColumn("diagnostics", F.when(F.contains("content", F.lit("gone")), found).otherwise(F.array().cast(found_type)))
    out = code.roll_up(answers, checked, code.invented(r"'engine", "EngineProps", "Engine"))
    return out.select(F.col("id").cast("long").alias("doc_id"), F.size("hard").cast("long").alias("hard"), *big("soft", "checked"))


found_type = "array<struct<code:int,line:int,msg:string>>"


@query("""SELECT d.doc_id, d.source AS model, CAST(row_number() OVER (PARTITION BY d.source ORDER BY d.doc_id) - 1 AS BIGINT) // 8 AS batch, CAST(CASE WHEN d.source LIKE 'w%' THEN 1 ELSE 0 END AS BIGINT) AS turn FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND d.lang = 'en' AND length(d.text) >= 60 AND NOT contains(d.text, '|')""")
def judge_work_batches(spark: SparkSession, d: str) -> DataFrame:
    """Unlabelled English documents that pass length and table-mark checks, in batches within their source."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), "lang", F.col("source").alias("model"), "text")
    failed = lambda bad, label: F.when(bad, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")).alias("hard")
    checked, compiled = docs.select("id", failed(F.length("text") < 60, "too-short")), docs.select("id", failed(F.contains("text", F.lit("|")), "ts1"))
    judged, kept = read(spark, d, "labels").select(F.col("doc_id").alias("id")), docs.where("lang = 'en'")
    out = release.judge_batches(release.judge_work(docs.drop("text"), judged, kept, checked, compiled), 8, local="w")
    return out.select(F.col("id").alias("doc_id"), "model", *big("batch", "turn"))


@query("""SELECT CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS k, doc_id FROM (SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY doc_id DESC LIMIT 150)""")
def review_dump(spark: SparkSession, d: str) -> DataFrame:
    """The last 150 documents without a label, numbered for people to decide on."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("seq"))
    out = release.dump(docs, read(spark, d, "labels").select(F.col("doc_id").alias("id")), 150)
    return out.select(*big("k"), F.col("id").alias("doc_id"))


@query("""WITH t AS (SELECT d.*, l.quality, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'lang' AS key, lang AS value, count(*) AS n FROM t GROUP BY ALL UNION ALL SELECT 'source', source, count(*) FROM t GROUP BY ALL UNION ALL SELECT 'quality', CAST(quality AS VARCHAR), count(*) FROM t GROUP BY ALL
UNION ALL SELECT 'examples', '', count(*) FROM t UNION ALL SELECT 'words', '', CAST(sum(len(list_filter(regexp_split_to_array(text, '[ \t-\r]+'), lambda w: w <> ''))) AS BIGINT) FROM t""")
def release_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Counts and distributions of the labelled documents, as they would be published."""
    t = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id")
    taken = t.select(F.col("doc_id").alias("id"), F.lit("").alias("question"), F.col("text").alias("answer"), F.col("lang").alias("area"), F.lit("x").alias("difficulty"), F.col("source").alias("type"), F.lit("j").alias("judge"), F.col("quality").cast("string").alias("verdict"))
    m = materialize(release.metadata(taken), "metadata")
    parts = [m.select(F.lit(name).alias("key"), F.explode(c).alias("value", "n")) for name, c in (("lang", "area"), ("source", "type"), ("quality", "verdict"))]
    out = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.lit("").alias("value"), F.col(c).alias("n")) for c in ("examples", "words")])).alias("x")).select("x.*")
    for p in parts:
        out = out.unionByName(p)
    return out


@query("""SELECT page_id, CAST(r AS INT) AS rank, 'https://x.org/' || page_id || CASE WHEN r = 0 THEN '/' ELSE '/more/' END AS url, 'https://x.org/' || page_id || CASE WHEN r = 0 THEN '' ELSE '/more/#top' END AS anchor FROM pages, (SELECT unnest([0, 1]) AS r)""")
def tool_search_hits(spark: SparkSession, d: str) -> DataFrame:
    """A search call per page through a stub transport that answers as server-sent events, and its hits."""
    calls = read(spark, d, "pages").select("page_id", F.lit("search").alias("tool"), F.to_json(F.struct(F.col("page_id").cast("string").alias("query"))).alias("arguments"))
    replies = tools.call_tools(calls, _stub_transport)
    hits = tools.search_hits(calls.join(replies, ["tool", "arguments"]), ["page_id"])
    return hits.select("page_id", "rank", "url", "anchor")


def _stub_transport(tool: str, arguments: str) -> str:
    import json

    base = f"https://x.org/{json.loads(arguments)['query']}"
    hits = {"search_results": [{"source_url": u, "title": "t", "content": "c"} for u in (base, f"{base}/more/#top")]}
    return "event: message\ndata: " + json.dumps({"result": {"content": [{"text": json.dumps(hits)}]}}) + "\n"


# Streams


def _drained(spark: SparkSession, d: str, name: str) -> tuple[DataFrame, str, str]:
    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    folder = scratch(spark, name)
    return streams.read_stream(spark, path if _is_folder(spark, path) else path.rsplit("/", 1)[0] + "/events*.parquet", schema), f"{folder}/table", f"{folder}/checkpoint"


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def stream_upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    s, table, checkpoint = _drained(spark, d, "upsert")
    streams.upsert_latest(s.select("user_id", "event_id", "event_type"), "user_id", "event_id", table, checkpoint)
    return streams.latest_view(spark, table, "user_id", "event_id").select("user_id", "event_id", "event_type")


@query("SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark: SparkSession, d: str) -> DataFrame:
    s, table, checkpoint = _drained(spark, d, "windows")
    counts = streams.windowed_counts(s.select("ts", "event_type"), "ts", ["event_type"], "1 day")
    _complete(counts, table, checkpoint)
    return spark.read.parquet(table).select("day", "event_type", "n")


def _complete(counts: DataFrame, table: str, checkpoint: str) -> None:
    """All windows, those still open too, as the last batch has them."""

    def each(batch: DataFrame, number: int) -> None:
        batch.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n").write.mode("overwrite").parquet(table)

    q = counts.writeStream.foreachBatch(each).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_counts(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of each user: events that follow each other within half an hour."""
    out = streams.sessions(read(spark, d, "events").select("ts", "user_id"), "ts", ["user_id"], "30 minutes")
    return out.select("user_id", F.date_format("session_start", "yyyy-MM-dd HH:mm:ss").alias("session_start"), "n")


@query("SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type")
def first_seen_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The first event of each user and type."""
    e = read(spark, d, "events").select("event_id", "user_id", "event_type")
    return e.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))


from . import catalog_curation  # noqa: E402, F401  registers the queries of the curation steps
