"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Used only where a local session, as in tests, names no shared folder.
FALLBACK_DIR = "/tmp/checkpoints/gleanery"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``. A cluster has to name one; only a local master may do without."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return FALLBACK_DIR


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches that Python workers get to 4 MB; a row count alone doesn't bound long texts.

    Frames are lazy, so the session keeps this setting; it is the same for all operators, and which came last makes no difference.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def clear_scratch(spark: SparkSession) -> None:
    """Deletes what this application has written to the shared folder. Frames that operators returned read from there, so call it
    once their rows are written elsewhere; without it, the folder's owner cleans up by application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dealt(rows: DataFrame, *by: Column | str) -> DataFrame:
    """Rows dealt over all shuffle partitions by what is given, for steps whose work is large and whose bytes are few: adaptive execution
    would merge such rows into one task, and leave them so where they are grouped by the same columns, hence the hash."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), F.xxhash64(*by))


def scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back, which cuts its lineage.

    The rows outlive lost executors, and what follows never recomputes what came before.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
