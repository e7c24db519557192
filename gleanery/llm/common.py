"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.tables import materialize, scratch, shared_dir

__all__ = ["bounded_batches", "heavy_join", "materialize", "scratch", "shared_dir", "small_reads", "whole_text", "wide"]


def whole_text(name: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def wide(spark: SparkSession) -> int:
    """Partitions for an exchange dealt by hand: as many as Spark's own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get to 4 MB; a row count alone doesn't bound long texts.

    Frames are lazy, so the session keeps this setting; it is the same for all operators, and which came last makes no difference.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


@contextmanager
def small_reads(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Within it, Parquet is read ``rows`` rows at once at most: columns of 4,096 long texts are arrays so large that the heap grows by hundreds of MB.

    Holds for what is executed within it, not for frames executed later; the session's own setting comes back.
    """
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def heavy_join(rows: DataFrame, found: DataFrame, on: list[str], count: str = "c", how: str = "inner", share: int = 4) -> DataFrame:
    """``rows`` joined with ``found``, a table of one row per key that counts the rows of its key.

    A key that has over one in ``share * partitions`` of all counted rows is joined by broadcast, so its rows stay where they are; there
    are fewer than ``share * partitions`` of those, whatever the data. All other keys are joined by sort-merge. ``found`` should be a written table,
    as it is read more than once; the count doesn't come back. ``how`` is inner, left or left_semi.
    """
    total = found.agg(F.sum(count)).first()[0] or 0
    most = total / (share * wide(rows.sparkSession))
    heavy, light = found.where(F.col(count) > most).drop(count), found.where(F.col(count) <= most).drop(count)
    if heavy.isEmpty():
        return rows.join(light.hint("merge"), on, how)
    own = rows.join(F.broadcast(heavy), on, "inner" if how == "left" else how)
    rest = rows.join(F.broadcast(heavy.select(*on)), on, "left_anti").join(light.hint("merge"), on, how)
    return own.unionByName(rest)
