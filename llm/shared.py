"""Helpers of the operators: tables in the shared folder, bounded Arrow batches, column choice."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.session import checkpoint_root

ARROW_ROWS = 1000                 # rows of one Arrow batch at most
ARROW_BYTES = 32 << 20            # bytes of one Arrow batch, checked after each row


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches end at ``ARROW_BYTES`` (or ``ARROW_ROWS`` rows), so a Python worker holds a few
    tens of MB of text (plus one row, however long)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{ARROW_BYTES}b")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir`` (shared by the driver and all executors)."""
    return f"{checkpoint_root(spark)}/pulse-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, by: list[str] | None = None, **options) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and read back: later plans start from
    the files, so a lost executor costs a reread and not the work before it.  ``by`` makes it a
    table of folders, one for each value."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    writer = df.write.options(**options)
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, text)`` alone, as ``_id`` long and ``_text`` string: other columns, whatever their
    names, cannot clash with an operator's own."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("_id"), F.col(f"`{text}`").cast("string").alias("_text"))
