"""Text lines <-> posts: the JSON wire format and the API's response envelope.

The reference pushes one JSON document per line over a socket.  Here a line
source is any Spark source with a ``value`` string column - files (tests,
backfill) or Kafka (live) - and parsing is ``from_json`` with an explicit
schema, so a malformed line becomes an all-null row instead of failing a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from pulse.schema import ENVELOPE_SCHEMA, POST_SCHEMA

# --- fixed values (must equal the reference) ---------------------------------
API_TIME_FORMAT = "EEE MMM dd HH:mm:ss +0000 yyyy"   # e.g. "Wed Oct 10 20:19:24 +0000 2018"
ENVELOPE_KEYS = ("tweets", "data")                    # first key wins when present
# ------------------------------------------------------------------------------

_JSON_OPTS = {"ignoreNullFields": "false"}


def read_lines(spark: SparkSession, path: str | None = None, fmt: str = "text",
               stream: bool = True, **options) -> DataFrame:
    """A (streaming) DataFrame of ``value STRING`` lines.

    ``fmt="text"`` reads files (one line per row; pair with ``maxFilesPerTrigger``
    to bound a micro-batch); ``fmt="kafka"`` reads a topic (pass
    ``kafka.bootstrap.servers`` / ``subscribe``; ``maxOffsetsPerTrigger`` bounds a
    batch).  Both sources are replayable, which the checkpointed queries rely on.
    Kafka needs the connector on the classpath (``spark-submit --packages
    org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``); it is not
    bundled with PySpark.
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.format(fmt).options(**options)
    df = reader.load(path) if path is not None else reader.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"),
                       F.col("timestamp").alias("arrived_at"))
    return df


def parse_posts(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON line -> ``id, created_at, text, username, timestamp`` (all nullable).

    A malformed or empty line gives an all-null row; a bad ``timestamp`` nulls
    that field only; a JSON number id reads as its text and an object in ``text``
    is kept as its JSON text.
    """
    keep = keep or []
    return (lines.select(*keep, F.from_json(F.col(value), POST_SCHEMA).alias("_post"))
            .select(*keep, "_post.*"))


def reject_lines(lines: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Lines that are not a JSON object (``from_json`` in permissive mode keeps
    the raw text of a malformed record in a corrupt-record column), with
    ``reason = "not_json"``.  ``parse_posts`` turns such lines into all-null rows;
    this is the side output that keeps them visible."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType(POST_SCHEMA.fields + [StructField("_corrupt", StringType(), True)])
    parsed = F.from_json(F.col(value), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return (lines.select(*(keep or []), F.col(value), parsed["_corrupt"].alias("_bad"))
            .filter(F.col("_bad").isNotNull() | F.col(value).isNull() | (F.trim(F.col(value)) == F.lit("")))
            .select(*(keep or []), F.col(value), F.lit("not_json").alias("reason")))


def _time_as_text(c: Column, dtype) -> Column:
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return c.cast("string")
    return c


def to_lines(posts: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Row -> one JSON line in ``value``: fields in the given order, nulls written
    as ``null``, times as text (``yyyy-MM-dd HH:mm:ss[.ffffff]``)."""
    columns = columns or [f.name for f in POST_SCHEMA.fields]
    types = {f.name: f.dataType for f in posts.schema.fields}
    fields = [_time_as_text(F.col(c), types[c]).alias(c) for c in columns]
    return posts.select(*(keep or []), F.to_json(F.struct(*fields), _JSON_OPTS).alias("value"))


def unwrap_envelope(lines: DataFrame, value: str = "value", cap: int | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """API response line -> one row per raw post, with its position ``pos`` (0-based).

    Posts come from ``tweets``; ``data`` is used only when the key ``tweets`` is
    absent (a present-but-null or empty ``tweets`` gives no rows).  ``cap`` keeps
    the first ``cap`` posts of each response, before any clean-up, as the
    reference's per-request slice did.
    """
    keep = keep or []
    # parse once: the envelope and the key test become columns, so the plan does
    # not repeat the JSON parse in each expression (or in an inferred filter)
    has_tweets = F.coalesce(F.array_contains(F.json_object_keys(F.col(value)), F.lit(ENVELOPE_KEYS[0])),
                            F.lit(False))
    parsed = lines.select(*keep, F.from_json(F.col(value), ENVELOPE_SCHEMA).alias("_env"),
                          has_tweets.alias("_has"))
    posts = F.when(F.col("_has"), F.col("_env")[ENVELOPE_KEYS[0]]).otherwise(F.col("_env")[ENVELOPE_KEYS[1]])
    if cap is not None:
        posts = cap_posts(posts, cap)
    return (parsed.select(*keep, F.posexplode_outer(posts).alias("pos", "_raw"))
            .filter(F.col("pos").isNotNull())
            .select(*keep, "pos", "_raw.*"))


def cap_posts(posts: Column, n: int) -> Column:
    """First ``n`` elements of a response's post array."""
    return F.slice(posts, 1, int(n))
