"""The register of queries: what each computes with Spark, and its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


_TABLES = ("nation", "documents", "pages", "events", "benchmark", "labels", "conversations", "embeddings")


def shared_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Rows of a SELECT that both engines understand, over tables named in braces; other braces stand for themselves."""
    names = [t for t in _TABLES if "{" + t + "}" in text]
    text = text.replace("{", "{{").replace("}", "}}")
    for t in names:
        text = text.replace("{{" + t + "}}", "{" + t + "}")
    return spark.sql(text, **{t: read(spark, sf_dir, t) for t in names})


def as_duckdb(text: str) -> str:
    """The same SELECT for DuckDB, where the tables are views."""
    for t in _TABLES:
        text = text.replace("{" + t + "}", t)
    return text
