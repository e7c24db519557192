"""Deterministic checks of texts as arrays of labels; patterns are native, names are joined with tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .vocabulary import contained

#: Patterns of generation artifacts in answers, in order; the label has a pattern's first 24 characters. Fixed values.
ANSWER_ARTIFACTS = [
    r"(?i)\bas an ai\b",
    r"(?i)\b(the|this) (context|excerpt|provided (documentation|docs|text))\b",
    r"\bINSUFFICIENT\b",
    r"(?i)\b(TODO|FIXME|TBD|lorem ipsum)\b",
    r"(?i)<(your|placeholder)[^>]*>",
    r"(?i)\bI hope this helps\b",
    r"(?i)\bIn conclusion\b",
    r"(?i)\b(this|the|training|fine-tuning) dataset\b|\btraining example\b|\bgenerated answer\b",
]
#: Words that are no identifiers of an API. Fixed values.
COMMON_WORDS = "true false null undefined async await const let export import default return response request fetch url headers json string number boolean object array promise map set date error console".split(" ")
#: Words by which an answer presents an API as old, and endings of file names. Fixed values.
PAST = r"(?i)\b(removed|deprecated|renamed|replace|no longer|instead|previously|old)\b"
FILES = r"(?i)\.(md|mdx|mdoc|ts|tsx|js|jsx|mjs|cjs|json|ya?ml|css|scss|svelte|vue|html|png|jpe?g|svg|webp|avif|txt)\z"
#: Content rules that drop finished examples; the patterns are fixed values, the labels our own.
CONTENT_RULES = [(r"(?i)\b(dataset|training (data|example)|fine-?tun)", "speaks-of-training"), (r"\bINSUFFICIENT\b", "left-over")]
#: Rules that one expression holds; more go in further ones.
RULES_AT_ONCE = 200


@dataclass(frozen=True)
class Dialect:
    """What the engine that answers are about calls its own; there is no default for any product."""

    modules: str  #: pattern of its module names
    owner: str  #: object whose members are its API
    paths: str  #: pattern of identifiers with a slash that are names of its, not files
    files: str = FILES  #: pattern of file names
    pages: str = r"a^"  #: pattern of further allowed links, normalised


def labels(*conditions: tuple[Column, Column | str]) -> Column:
    """The labels whose condition holds, in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(v) if isinstance(v, str) else v) for c, v in conditions]))


def artifact_labels(text: Column, patterns: list[str] = ANSWER_ARTIFACTS) -> Column:
    return labels(*[(F.regexp_like(text, F.lit(p)), "artifact:" + p.removeprefix("(?i)")[:24]) for p in patterns])


def rule_labels(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Ids of the (id, pattern) rules that a text hits, without case."""
    return labels(*[(F.regexp_like(text, F.lit("(?i)" + p)), i) for i, p in rules])


def rule_hits(texts: DataFrame, rules: DataFrame, text: str = "text") -> DataFrame:
    """A row per text and rule hit, with the rule's columns; rules (rule_id, re, ...) have unique ids.

    The patterns are the query: they become literals, so each is compiled once for a task, and a pass over the texts asks ``RULES_AT_ONCE``
    of them. A null text hits nothing.
    """
    asked = [(r[0], r[1]) for r in rules.select("rule_id", "re").collect()]
    out = texts.withColumn("rule_id", F.lit(None).cast(rules.schema["rule_id"].dataType)).limit(0)
    for at in range(0, len(asked), RULES_AT_ONCE):
        hit = F.array_compact(F.array(*[F.when(F.regexp_like(F.col(text), F.lit("(?i)" + p)), F.lit(i)) for i, p in asked[at : at + RULES_AT_ONCE]]))
        part = texts.withColumn("rule_id", F.explode(hit))
        out = part if at == 0 else out.unionByName(part)
    return out.join(F.broadcast(rules), "rule_id")


def _listed(rows: DataFrame, name: str) -> DataFrame:
    """(id, order..., label) -> (id, labels in order)."""
    order = [c for c in rows.columns if c.startswith("_o")]
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, "label"))), lambda x: x["label"]).alias(name))


def import_rows(answers: DataFrame, dialect: Dialect, text: str = "answer") -> DataFrame:
    """(id, _o1, module, names) of the first-party imports in the code of answers, in order."""
    every = F.flatten(F.transform(T.fenced_blocks(F.col(text)), lambda b: T.imports(b["body"])))
    return answers.select("id", F.posexplode(every).alias("_o1", "i")).where(F.regexp_like("i.module", F.lit(dialect.modules))).select("id", "_o1", "i.module", "i.names")


def identifier_rows(answers: DataFrame, dialect: Dialect, text: str = "answer") -> DataFrame:
    """(id, _o1, _o2, token, asked) of what looks like an API in answers: identifiers in inline code of the prose, then members of the owner in code."""
    marked = F.transform(F.regexp_extract_all(T.prose(F.col(text)), F.lit(r"`([^`\n]{2,60})`"), F.lit(1)), lambda x: F.regexp_replace(F.trim(x), r"\(\)\z", ""))
    t = F.col("token")
    own = answers.select("id", F.lit(0).alias("_o1"), F.posexplode(marked).alias("_o2", "token")).where(
        F.regexp_like(t, F.lit(r"^[A-Za-z_$@][\w$.:/@-]*\z")) & ~F.lower(t).isin(COMMON_WORDS) & ~(F.contains(t, F.lit("/")) & ~F.regexp_like(t, F.lit(dialect.paths)))
        & ~F.regexp_like(t, F.lit(dialect.files)) & ~F.startswith(t, F.lit(f"{dialect.owner}.props.")) & ~F.regexp_like(t, F.lit(r"@\d"))
    )
    used = F.flatten(F.transform(T.fenced_blocks(F.col(text)), lambda b: T.members(b["body"], dialect.owner)))
    member = answers.select("id", F.lit(1).alias("_o1"), F.posexplode(used).alias("_o2", "m")).select("id", "_o1", "_o2", F.concat(F.lit(f"{dialect.owner}."), "m").alias("token"))
    return own.unionByName(member).withColumn("asked", F.lower("token"))


def _unknown(found: DataFrame, corpus: DataFrame) -> DataFrame:
    """Of (..., asked) rows those that no text of the corpus contains; of a dotted identifier in prose, each part a word of some text will do."""
    known = contained(found.select(F.col("asked").alias("token")).distinct(), corpus)
    left = found.join(known.withColumnRenamed("token", "asked"), "asked", "left_anti")
    dotted = left.where((F.col("_o1") == 0) & F.contains("asked", F.lit("."))).select("asked").distinct()
    parts = dotted.select("asked", F.explode(F.split("asked", r"\.")).alias("token"))
    words = contained(parts.select("token").where("token <> ''").distinct(), corpus, whole=True).withColumn("_w", F.lit(True))
    whole = parts.join(words, "token", "left").groupBy("asked").agg(F.min(F.coalesce("_w", F.lit(False))).alias("_w")).where("_w").select("asked", F.lit(0).alias("_o1"))
    return left.join(whole, ["asked", "_o1"], "left_anti")


def check_answers(answers: DataFrame, rules: list[tuple[str, str]] = (), known_urls: DataFrame | None = None, imports: DataFrame | None = None, corpus: DataFrame | None = None, dialect: Dialect | None = None, text: str = "answer") -> DataFrame:
    """Adds hard, soft, links, code_blocks, chars to answers with unique ids, type and area.

    Hard: insufficient, too-short, unclosed-fence, artifact:, bad-link:, stale:, bad-import:, unknown-apis:.
    Soft: long, multiple-links, stale-in-migration:, unknown-api:. ``known_urls`` (url, normalised), ``imports`` (module, names; see
    ``known_imports``) and ``corpus`` (content) are tables, joined and never collected; the last two need a ``dialect``. A null text has no labels but
    those that its absence gives: none.
    """
    t = F.col(text)
    none = F.array().cast("array<string>")
    out = answers.withColumn("_links", T.links(t))
    bad = F.col("_bad")
    if known_urls is not None:
        pages = dialect.pages if dialect else r"a^"
        each = out.select("id", F.explode(F.array_distinct("_links")).alias("_l")).withColumn("_b", T.normalize_url(F.col("_l")))
        lost = each.join(known_urls.select(F.col("url").alias("_b")).distinct(), "_b", "left_anti").where(~F.regexp_like("_b", F.lit(pages)))
        out = out.join(lost.groupBy("id").agg(F.collect_set("_l").alias("_bad")), "id", "left")
    else:
        out = out.withColumn("_bad", none)
    bad_links = F.transform(F.filter("_links", lambda x: F.array_contains(F.coalesce(bad, none), x)), lambda x: F.concat(F.lit("bad-link:"), F.left(x, F.lit(80))))
    migration = (F.col("type") == "migration") | F.startswith(F.col("area"), F.lit("upgrade"))
    migration = F.coalesce(migration, F.lit(False)) & F.regexp_like(t, F.lit(PAST))
    stale = rule_labels(t, list(rules)) if rules else none

    if dialect is not None and imports is not None:
        known = imports.select("module", F.col("names").alias("_known"))
        used = import_rows(answers, dialect, text).join(known, "module", "left")
        strange = used.where("_known is null").select("id", "_o1", F.lit(0).alias("_o2"), F.concat("module", F.lit(" (unknown module)")).alias("label"))
        missing = used.where("_known is not null").select("id", "_o1", F.posexplode(T.imported_names(F.col("names"))).alias("_o2", "n"), "module", "_known").where(~F.array_contains("_known", F.col("n")))
        missing = missing.select("id", "_o1", "_o2", F.concat("n", F.lit(" from "), "module").alias("label"), F.lower("n").alias("token"))
        if corpus is not None:
            missing = missing.join(contained(missing.select("token").distinct(), corpus), "token", "left_anti")
        out = out.join(_listed(strange.unionByName(missing.drop("token")), "_imports"), "id", "left")
    else:
        out = out.withColumn("_imports", none)
    if dialect is not None and corpus is not None:
        out = out.join(_listed(_unknown(identifier_rows(answers, dialect, text), corpus).select("id", "_o1", "_o2", F.col("token").alias("label")), "_unknown"), "id", "left")
    else:
        out = out.withColumn("_unknown", none)
    out = out.withColumns({"_imports": F.coalesce("_imports", none), "_unknown": F.coalesce("_unknown", none)})

    hard = F.concat(
        labels((F.regexp_like(F.trim(t), F.lit(r"^INSUFFICIENT\b")), "insufficient"), (F.length(t) < 60, "too-short"), (T.unclosed_fence(t), "unclosed-fence")),
        artifact_labels(t), bad_links, F.when(migration, none).otherwise(F.transform(stale, lambda i: F.concat(F.lit("stale:"), i))),
        F.transform("_imports", lambda b: F.concat(F.lit("bad-import:"), b)), labels((F.size("_unknown") >= 2, F.concat(F.lit("unknown-apis:"), F.array_join(F.slice("_unknown", 1, 4), ",")))),
    )
    soft = F.concat(
        labels((F.length(t) > 2600, "long"), (F.size("_links") > 1, "multiple-links")), F.when(migration, F.transform(stale, lambda i: F.concat(F.lit("stale-in-migration:"), i))).otherwise(none),
        labels((F.size("_unknown") == 1, F.concat(F.lit("unknown-api:"), F.get("_unknown", F.lit(0))))),
    )
    return out.withColumns({"hard": F.coalesce(hard, none), "soft": F.coalesce(soft, none), "links": F.size("_links"), "code_blocks": F.size(T.fenced_blocks(t)), "chars": F.length(t)}).drop("_links", "_bad", "_imports", "_unknown")


def histogram(df: DataFrame, column: str) -> DataFrame:
    """Counts of labels by what stands before the colon."""
    return df.select(F.explode(column).alias("_l")).groupBy(F.split_part("_l", F.lit(":"), F.lit(1)).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def known_imports(corpus: DataFrame, text: str = "content") -> DataFrame:
    """(module, names) that import statements anywhere in a corpus name; a default import counts as the name default."""
    used = corpus.select(F.explode(T.imports(F.col(text))).alias("i"))
    names = F.concat(T.imported_names(F.col("i.names"), comments=False), F.when(F.col("i.default") != "", F.array(F.lit("default"))).otherwise(F.array().cast("array<string>")))
    return used.select("i.module", F.explode_outer(names).alias("name")).groupBy("module").agg(F.collect_set("name").alias("names"))


def content_filter(rows: DataFrame, text: Column, rules: list[tuple[str, str]] = CONTENT_RULES) -> DataFrame:
    """Adds ``why``: labels of the content rules that a row breaks; rows to keep have none."""
    return rows.withColumn("why", labels(*[(F.regexp_like(text, F.lit(p)), v) for p, v in rules], (T.unclosed_fence(text), "open-fence"), (F.size(T.links(text)) > 1, "several-links")))
