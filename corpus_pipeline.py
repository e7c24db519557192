"""The corpus pipeline: quality, lines, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept. All but the last return the columns of
``documents``, whatever others there are and however they are named; run() applies them to the whole table, writing each stage's rows to
the shared folder. In all stages a null text counts as empty and no rows give no rows.
"""

from __future__ import annotations

from gleanery.llm import decontaminate, line_dedup, near_copies, packing, quality
from gleanery.llm.common import bounded_batches, materialize
from gleanery.llm.queries import tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from ``labels``, gives a score of 0.3 or more.

    Each row is scored by its whole text alone: repeated rows fare alike, equal scores too; an empty text gets the score of zero features; a null id is
    scored like any other. The ids to learn from are 20,000 at most, so they are broadcast and the texts stay where they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    table = quality.feature_table(docs.join(F.broadcast(quality.training_ids(labels)), "doc_id", "left_semi"))
    model = quality.learn(materialize(table, "features"), labels)
    bounded_batches(spark)
    return docs.where(quality.scorer(model)("text") >= 0.3)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier, single ones too; n_chars follows the text, and a document that has lost lines and of which
    nothing but white space is left goes.

    Earlier is by doc_id, null ones last, then by line. Rows that repeat id and text fare alike and don't remove each other; of one id for several texts the
    order is that of the texts' hash. A document that loses nothing, an empty one too, stays as it is.
    """
    out = line_dedup.dedup_lines(docs)
    new = {"text": F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text")), "n_chars": F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("row.n_chars"))}
    left = out.where((F.col("n_removed") == 0) | F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")))
    return left.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id; links are five-word similarities of 0.8 or more.

    Fingerprints at 4 bits, op2's contract, reach few of those, so bands of least hashes give candidates too. Null and empty texts are
    one group; of rows that repeat id and text one stays; a null doc_id stays only in a group without others.
    """
    return near_copies.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its whole text alone: repeated rows, equal and null ids fare alike; an empty text holds nothing; without items all stay.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents that are left, placed in sequences of 1024: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    An empty text is its end id alone; null ids and repeated rows are packed as often as they come; a text of any length is cut, never dropped.
    """
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("lines", drop_repeated_lines), ("near_duplicates", drop_near_duplicates), ("benchmark", drop_contaminated), ("packing", pack)]

#: SQL can express neither the classifier nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialize(docs, f"stage-{name}")
    return docs
