"""Schemas of the post stream and of the API envelope it is cut from."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, LongType, StringType, StructField, StructType, TimestampType,
)

# --- fixed values (must equal the reference: the wire format) -----------------
# One post on the wire.  All nullable.
POST_SCHEMA = StructType([
    StructField("id", StringType(), True),
    StructField("created_at", StringType(), True),
    StructField("text", StringType(), True),
    StructField("username", StringType(), True),
    StructField("timestamp", TimestampType(), True),
])

# A post as the search API returns it: every field name variant, all nullable.
# Ids are read as strings (a JSON number id is kept as its text).
RAW_POST_SCHEMA = StructType([
    StructField("id", StringType(), True),
    StructField("tweet_id", StringType(), True),
    StructField("text", StringType(), True),
    StructField("full_text", StringType(), True),
    StructField("username", StringType(), True),
    StructField("user", StructType([StructField("screen_name", StringType(), True)]), True),
    StructField("created_at", StringType(), True),
    StructField("timestamp", StringType(), True),
])

# One API response: posts under ``tweets`` or, when that key is absent, ``data``.
ENVELOPE_SCHEMA = StructType([
    StructField("tweets", ArrayType(RAW_POST_SCHEMA), True),
    StructField("data", ArrayType(RAW_POST_SCHEMA), True),
])

# ------------------------------------------------------------------------------

LEXICON_SCHEMA = StructType([
    StructField("word", StringType(), False),
    StructField("polarity_hundredths", LongType(), False),
])
