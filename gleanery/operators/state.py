"""State of append logs: latest and first rows, what is outstanding, gates over several tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(log: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row per key by ``seq``, which must be unique within a key, with the key's first seq as first_seq.

    One pre-aggregated maximum of a struct, no sort.
    """
    rest = [c for c in log.columns if c != key]
    best = F.max(F.struct(F.col(seq).alias("_o"), *[F.col(c).alias(f"c_{i}") for i, c in enumerate(rest)]))
    if any(t.startswith("map") for _, t in log.dtypes):
        best = F.max_by(F.struct(F.col(seq).alias("_o"), *[F.col(c).alias(f"c_{i}") for i, c in enumerate(rest)]), F.col(seq))
    return log.groupBy(key).agg(best.alias("_b"), F.min(seq).alias("first_seq")).select(key, *[F.col(f"_b.c_{i}").alias(c) for i, c in enumerate(rest)], "first_seq")


def first_by(rows: DataFrame, key: Column | str, seq: str) -> DataFrame:
    """The first row per key by ``seq``."""
    key = F.col(key) if isinstance(key, str) else key
    return rows.groupBy(key.alias("_k")).agg(F.min_by(F.struct(*rows.columns), F.col(seq)).alias("_r")).select("_r.*")


def outstanding(source: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of which nothing is done yet."""
    return source.join(done.select(key).distinct(), key, "left_anti")


def eligible(source: DataFrame, gates: DataFrame, key: str) -> DataFrame:
    return source.join(gates.select(key).distinct(), key, "left_semi")


def kept_questions(questions: DataFrame, reviews: DataFrame) -> DataFrame:
    """Questions whose latest review keeps them, with its improved wording if it has one; a wording of an earlier review outlives a restoring one."""
    wording = reviews.where(F.col("question").isNotNull()).groupBy("id").agg(F.max_by("question", "seq").alias("_new"))
    last = latest_by(reviews, "id", "seq").where(F.coalesce(F.col("keep"), F.lit(False))).select("id")
    return questions.join(last, "id").join(wording, "id", "left").withColumn("question", F.coalesce("_new", "question")).drop("_new")


def improved(new: Column, old: Column) -> Column:
    """An improved wording, if it is longer than 20 code points and differs."""
    return F.when((F.length(new) > 20) & (new != old), new)


def key_union(*tables: DataFrame, key: str) -> DataFrame:
    out = tables[0].select(key)
    for t in tables[1:]:
        out = out.unionByName(t.select(key))
    return out.distinct()
