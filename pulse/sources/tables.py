"""Parquet tables and the post views derived from them.

Every view is lazy: column selection and filters written on top reach the
parquet scan (``ReadSchema`` / ``PushedFilters``), and the scalars a view needs
(number of documents, newest event time) are scalar subqueries inside the plan,
never values collected to the driver.
"""

from __future__ import annotations

import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOUNDED_ROWS = 1000             # rows whose texts are broadcast
BROADCAST_KEYS = 1_000_000      # rows whose keys (about 16 MB) are broadcast
POST_COLUMNS = ["id", "created_at", "username", "timestamp", "event_id", "doc_id"]


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def doc_count(docs: DataFrame) -> Column:
    """Number of documents, as a scalar subquery (metadata-only count on parquet)."""
    return docs.select(F.count(F.lit(1))).scalar()


def as_of(events: DataFrame, ts: str = "ts") -> Column:
    """The newest event time, as a scalar subquery: the "now" of the registered queries."""
    return events.select(F.max(ts)).scalar()


def _deflated(raw: pd.Series) -> pd.Series:
    return raw.map(lambda b: None if b is None else zlib.compress(b))


def _inflated(packed: pd.Series) -> pd.Series:
    return packed.map(lambda held: [None if b is None else zlib.decompress(b) for b in held])


def pack_text(text: Column) -> Column:
    """A text's bytes, deflated (null stays null), for texts that cross a shuffle once for each row that shows them."""
    return F.pandas_udf(_deflated, "binary")(text.cast("binary"))


def unpack_texts(packed: Column) -> Column:
    """The texts of short lists of what ``pack_text`` makes."""
    return F.pandas_udf(_inflated, "array<binary>")(packed).cast("array<string>")


def posts_view(spark: SparkSession, sf_dir: str, with_text: bool = False,
               extra: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """Posts over the test tables.

    ``id`` = event id as text, ``created_at`` = ``yyyy-MM-dd HH:mm:ss`` of the event
    time, ``username`` = ``user_<user_id>``, ``timestamp`` = event time (NTZ, as
    stored), and the post text is the document ``doc_id = event_id % n_docs``.
    The text is joined only when asked for: most queries need only the document's
    score, which is computed once per document and joined on ``doc_id``.
    ``extra`` carries more event columns (e.g. ``event_type``) through.  ``packed`` as in ``attach_text``.
    """
    events = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", *extra)
    docs = read_table(spark, sf_dir, "documents", "doc_id")
    events = events.withColumn("doc_id", F.col("event_id") % doc_count(docs))
    if with_text:           # joined before ids, times and names become text, so the events cross the shuffle as they are stored
        events = attach_text(spark, sf_dir, events, packed=packed)
    return events.select(
        F.col("event_id").cast("string").alias("id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("username"),
        F.col("ts").alias("timestamp"),
        F.col("event_id"),
        F.col("doc_id"),
        *[F.col(c) for c in extra],
        *(["text"] if with_text else []),
    )


def attach_text(spark: SparkSession, sf_dir: str, df: DataFrame, on: str = "doc_id",
                bounded_rows: int | None = None, packed: bool = False) -> DataFrame:
    """Join the document text to rows carrying ``doc_id``.  Call it as late as
    possible (after filters and limits) so texts are not shuffled for rows that
    are dropped later.

    ``bounded_rows``: the caller's proven bound on ``df`` (a LIMIT or a count); up to
    ``BROADCAST_KEYS`` its keys are broadcast to the texts' scan (a left semi join,
    which Spark can build on that side), so only the texts of those rows leave the
    scan, and up to ``BOUNDED_ROWS`` those texts are broadcast in turn.  Otherwise both
    sides shuffle on ``doc_id`` (AQE splits a hot document's partition).  ``packed=True`` joins the texts as ``pack_text`` makes
    them, once for each document; the caller unpacks them behind its last shuffle.
    """
    texts = read_table(spark, sf_dir, "documents", "doc_id", "text").withColumnRenamed("doc_id", "_td")
    if packed:
        texts = texts.withColumn("text", pack_text(F.col("text")))
    if bounded_rows is not None and bounded_rows <= BROADCAST_KEYS:
        keys = df.select(F.col(on).alias("_k")).distinct()
        texts = texts.join(F.broadcast(keys), F.col("_td") == F.col("_k"), "left_semi")
        texts = F.broadcast(texts) if bounded_rows <= BOUNDED_ROWS else texts
    return df.join(texts, df[on] == F.col("_td"), "left").drop("_td")
