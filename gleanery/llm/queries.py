"""One query per operator of this subpackage, over its whole table, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunks, decontaminate, exact_dedup, line_dedup, packing, preference, quality, simhash, suffix, warc

TOKENIZER = "byte_bpe_50k.json"
#: Chunks so small that a repeated passage of 50 words holds whole ones.
CHUNKS = {"least": 16, "bits": 4, "most": 64}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_read(spark, sf_dir, "documents"), min_lines=2)  # as its SQL has it
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.col("n_removed").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.round_trip(_read(spark, sf_dir, "pages")).where("last")
    return rows.select(F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix.repeated_passages(_read(spark, sf_dir, "documents"), contents=False)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op6_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.radix_groups(_read(spark, sf_dir, "documents"))


def op7_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chunks.dedup_chunks(_read(spark, sf_dir, "documents"), **CHUNKS)
    return out.select("doc_id", "n_bytes", "n_removed", F.col("n_spans").cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = preference.format_pairs(preference.self_negatives(preference.conversations(_read(spark, sf_dir, "conversations"))))
    learnt = lambda c: F.aggregate(c, F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return out.select(
        F.col("pair_id").alias("conv_id"), F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"), F.sha2("prompt", 256).alias("prompt_sha256"),
        F.sha2("chosen", 256).alias("chosen_sha256"), F.sha2("rejected", 256).alias("rejected_sha256"), learnt("chosen_mask").alias("chosen_learnt"), learnt("rejected_mask").alias("rejected_learnt"),
    )


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path())


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_simhash, op3_warc, op4_quality, op5_suffix_array, op6_exact, op7_chunks, op8_preference, op9_decontaminate, op10_packing)}

#: ASCII white space, as a class for DuckDB's patterns.
_W = r"[\x20\x09-\x0D]"

SQL = {
    "op1_line_dedup": rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS raw, regexp_replace(ls[i], '^{_W}+|{_W}+$', '', 'g') AS s
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
nb AS (SELECT doc_id, i, s, lead(s) OVER (PARTITION BY doc_id ORDER BY i) AS s2, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS i2 FROM l WHERE s <> ''),
w AS (SELECT doc_id, i, i2, row_number() OVER (PARTITION BY s, s2 ORDER BY doc_id, i) AS rn FROM nb WHERE s2 IS NOT NULL),
gone AS (SELECT doc_id, i FROM w WHERE rn > 1 UNION SELECT doc_id, i2 FROM w WHERE rn > 1)
SELECT l.doc_id, count(*) FILTER (WHERE l.s <> '') AS n_lines, count(g.i) AS n_removed,
       sha256(coalesce(string_agg(l.raw, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id""",
    "op6_exact": rf"""
WITH b AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{_W}', '', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id) = 1 AS kept, sha256(t) AS text_sha256 FROM b""",
    "op8_preference": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations),
a AS (SELECT conv_id, max(i) FILTER (WHERE role = 'assistant') AS last FROM t GROUP BY conv_id),
e AS (SELECT t.conv_id, max(t.i) AS before FROM t JOIN a ON t.conv_id = a.conv_id WHERE t.role = 'assistant' AND t.i < a.last GROUP BY t.conv_id),
r AS (SELECT t.conv_id, t.i, t.role, t.text, a.last, coalesce(p.text, '{preference.REFUSAL.replace("'", "''")}') AS other
      FROM t JOIN a ON t.conv_id = a.conv_id LEFT JOIN e ON e.conv_id = t.conv_id LEFT JOIN t p ON p.conv_id = e.conv_id AND p.i = e.before),
c AS (SELECT conv_id, i, last, text = other AS same, '<|' || replace(role, '<|', '< |') || '|>' || chr(10) AS head,
      replace(text, '<|', '< |') || '<|end|>' AS own, replace(other, '<|', '< |') || '<|end|>' AS alt FROM r),
f AS (SELECT conv_id, last, coalesce(string_agg(head || own || chr(10), '' ORDER BY i) FILTER (WHERE last IS NULL OR i < last OR (i = last AND same)), '') AS prompt,
      count(*) FILTER (WHERE last IS NULL OR i < last OR (i = last AND same)) AS n_prompt_turns,
      coalesce(max(head || own || chr(10)) FILTER (WHERE i = last AND NOT same), '') AS chosen, coalesce(max(head || alt || chr(10)) FILTER (WHERE i = last AND NOT same), '') AS rejected,
      coalesce(max(length(own)) FILTER (WHERE i = last AND NOT same), 0) AS chosen_learnt, coalesce(max(length(alt)) FILTER (WHERE i = last AND NOT same), 0) AS rejected_learnt
      FROM c GROUP BY conv_id, last)
SELECT conv_id, n_prompt_turns, sha256(prompt) AS prompt_sha256, sha256(chosen) AS chosen_sha256, sha256(rejected) AS rejected_sha256, chosen_learnt, rejected_learnt FROM f""",
}
