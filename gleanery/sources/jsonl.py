"""JSON-lines and JSON sources and sinks with fixed schemas."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions import text as T


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of a JSON-lines table; a missing path is an empty table, a malformed line stops the read."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema)


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed): malformed has file, line (from 1, blank ones counted) and text of what is no JSON.

    Splits of a file number their lines on their own and add those of the splits before.
    """
    kind = spark.createDataFrame([], schema).schema
    full = StructType([*kind.fields]).add("_corrupt", StringType())
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    parsed = lines.select("file", "start", "at", "value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"))
    rows = parsed.where((F.trim("value") != "") & F.col("r._corrupt").isNull()).select(*[F.col(f"r.`{f.name}`") for f in kind.fields])
    size = lines.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    size = size.select("file", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    bad = parsed.where((F.trim("value") != "") & F.col("r._corrupt").isNotNull())
    return rows, bad.join(size, ["file", "start"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), F.col("value").alias("text"))


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, fallback: dict | None = None) -> DataFrame:
    """A document as a one-row table, or the fallback if there is none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if not _missing(e) or fallback is None:
            raise
        return spark.createDataFrame([fallback], schema)


def write_json(df: DataFrame, path: str) -> None:
    """A one-row table as a document: a folder with one JSON file, in place of what was there."""
    df.coalesce(1).write.mode("overwrite").json(path)


def sitemap(documents: DataFrame, xml: str = "xml") -> DataFrame:
    """(url): the distinct locations that sitemap documents list, normalised."""
    return documents.select(F.explode(T.sitemap_urls(F.col(xml))).alias("u")).select(T.normalize_url(F.col("u")).alias("url")).distinct()


def rewrite(df: DataFrame, path: str, keep) -> str:
    """Writes the rows that ``keep`` leaves as a new version beside ``path``, never over what is being read; returns where."""
    out = f"{path.rstrip('/')}.v-{uuid.uuid4().hex[:12]}"
    keep(df).write.json(out)
    return out


def write_lines(df: DataFrame, columns: list[str], path: str) -> None:
    """Pipe-separated dump for human readers."""
    df.select(F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")).write.mode("overwrite").text(path)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    """Decision lines as (k, action, rest, seq), seq rising with the lines of a file; malformed lines are left out."""
    return spark.read.text(path).select(T.decision(F.col("value")).alias("d"), F.monotonically_increasing_id().alias("seq")).select("d.*", "seq").where("k is not null")
