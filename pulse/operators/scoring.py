"""Sentiment scoring as Spark jobs.

Lexicon polarity (F1) is a join, not a per-row library call: texts are split
into lower-case ``a-z`` tokens, tokens are joined to the lexicon, and the
matched values are averaged per text.  Explode, join probe and the partial
aggregate run in one codegen stage, so only one narrow row per text and task
(``key, sum, hits``) crosses the shuffle - never the text.

The lexicon is broadcast only after its row count has been checked against
``broadcast_max_rows``; a bigger lexicon is joined by shuffle on the token, with
AQE splitting the partitions of very common tokens.

A plug-in scorer (U2) is one Arrow-batched pandas UDF; bands and scores are then
the same native expressions as for the lexicon.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions.sentiment import label, score
from pulse.schema import LEXICON_SCHEMA
from pulse.session import stored

# --- fixed values --------------------------------------------------------------
TOKEN_PATTERN = "[^a-z]+"       # token separator after lower-casing
HUNDREDTHS = 100                 # lexicon values are integer hundredths in [-100, 100]
# ------------------------------------------------------------------------------

BROADCAST_TEXTS = 500_000        # different texts whose scores are broadcast (about 100 bytes each)
BROADCAST_MAX_ROWS = 2_000_000   # ~2 M words x ~40 bytes stays well under 100 MB


def lexicon_frame(spark: SparkSession, entries: Iterable[tuple[str, int]]) -> DataFrame:
    """A small inline lexicon DataFrame (``word``, ``polarity_hundredths``) from pairs.

    Built as a SQL ``VALUES`` relation, so it is a JVM-side local table (no Python
    RDD behind it).  Large lexicons belong in a table: ``read_lexicon``.
    """
    pairs = [(str(w), int(v)) for w, v in entries]
    if not pairs:
        return spark.createDataFrame([], LEXICON_SCHEMA)
    values = ", ".join("('{}', {})".format(w.replace("'", "''"), v) for w, v in pairs)
    return spark.sql(f"SELECT CAST(word AS STRING) AS word, CAST(p AS BIGINT) AS polarity_hundredths "
                     f"FROM VALUES {values} AS lex(word, p)")


def read_lexicon(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """A lexicon stored as a table with columns ``word`` and ``polarity_hundredths``."""
    df = spark.read.format(fmt).options(**options).load(path)
    return df.select(F.lower(F.col("word")).alias("word"),
                     F.col("polarity_hundredths").cast("long").alias("polarity_hundredths"))


def lexicon_fits(lexicon: DataFrame, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    # size check on the lexicon alone (a small action), never on the texts
    return lexicon.count() <= broadcast_max_rows


def tokens(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, token``: lower-case ``a-z`` runs of each text; a null text gives one null token."""
    return texts.select(F.col(key), F.explode_outer(F.split(F.lower(F.col(text)), TOKEN_PATTERN)).alias("token"))


def lexicon_polarity(texts: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text",
                     broadcast_max_rows: int = BROADCAST_MAX_ROWS, broadcast: bool | None = None) -> DataFrame:
    """Per ``key``: ``hits`` (matched tokens), ``polarity_sum`` (hundredths),
    ``polarity`` = mean matched value in [-1, 1] (0.0 when nothing matches or the
    text is null) and ``unscored`` (the text was null: nothing could be scored,
    kept visible rather than hidden in the neutral band).  Every key of
    ``texts`` gets a row.

    Identical texts under one key score the same as one copy (sum and hits scale
    together), so ``key`` needs to identify a text, not a row.  ``broadcast``:
    a decision already taken (e.g. once per stream) instead of the row check.
    """
    lex = lexicon.select("word", "polarity_hundredths")
    if broadcast if broadcast is not None else lexicon_fits(lex, broadcast_max_rows):
        # explode -> broadcast probe -> partial aggregate, all in one stage
        matched = (tokens(texts, key, text)
                   .join(F.broadcast(lex), F.col("token") == lex["word"], "left")
                   .groupBy(key)
                   .agg(F.count("polarity_hundredths").alias("hits"),
                        F.coalesce(F.sum("polarity_hundredths"), F.lit(0)).cast("long").alias("polarity_sum"),
                        F.max(F.col("token").isNull()).alias("unscored")))
    else:
        # lexicon too big to broadcast: count each (text, token) first so a word
        # repeated in a text crosses the shuffle once, then join on the token
        # (the empty token, one for each text's edge, and null texts never reach the join)
        counts = (tokens(texts, key, text).filter("token <> ''")
                  .groupBy(key, "token").agg(F.count(F.lit(1)).alias("_n")))
        v = F.col("polarity_hundredths")
        found = (counts.join(lex, counts["token"] == lex["word"])
                 .groupBy(F.col(key).alias("_fk")).agg(F.sum("_n").alias("_hits"), F.sum(F.col("_n") * v).alias("_sum")))
        keys = texts.groupBy(key).agg(F.max(F.col(text).isNull()).alias("unscored"))
        matched = (keys.join(found, F.col(key).eqNullSafe(F.col("_fk")), "left")
                   .select(key, F.coalesce("_hits", F.lit(0)).cast("long").alias("hits"),
                           F.coalesce("_sum", F.lit(0)).cast("long").alias("polarity_sum"), "unscored"))
    polarity = (F.when(F.col("hits") > 0,
                       F.col("polarity_sum").cast("double") / (F.col("hits") * HUNDREDTHS).cast("double"))
                .otherwise(F.lit(0.0)))
    return matched.select(key, "hits", "polarity_sum", polarity.alias("polarity"), "unscored")


def with_bands(df: DataFrame, rule: str = "strict", polarity: str = "polarity") -> DataFrame:
    """Add ``sentiment_label`` and ``sentiment_score`` from ``polarity``."""
    return df.withColumn("sentiment_label", label(polarity, rule)).withColumn(
        "sentiment_score", score(polarity, rule))


def score_documents(docs: DataFrame, lexicon: DataFrame, rule: str = "strict", key: str = "doc_id",
                    text: str = "text", broadcast_max_rows: int = BROADCAST_MAX_ROWS,
                    broadcast: bool | None = None) -> DataFrame:
    """``key, hits, polarity_sum, polarity, sentiment_label, sentiment_score`` per document."""
    return with_bands(lexicon_polarity(docs, lexicon, key, text, broadcast_max_rows, broadcast), rule)


def attach_scores(posts: DataFrame, doc_scores: DataFrame, on: str = "doc_id",
                  broadcast_scores: bool = False) -> DataFrame:
    """Join per-document scores to posts that reference a document.  Both sides
    are narrow.  ``broadcast_scores``: the caller has checked the number of
    documents (one score row each) against a bound, so the scores are broadcast
    and the posts are not shuffled; otherwise both sides shuffle on ``doc_id``
    and AQE splits skewed partitions (a document shown by very many posts)."""
    cols = [c for c in ("polarity", "sentiment_label", "sentiment_score", "unscored") if c in doc_scores.columns]
    scores = doc_scores.select(F.col(on).alias("_sk"), *cols)
    if broadcast_scores:
        scores = F.broadcast(scores)
    joined = posts.join(scores, posts[on] == scores["_sk"], "left").drop("_sk")
    # a post whose document is missing is scored like a null text: neutral, and flagged
    return joined.select(
        *[c for c in posts.columns],
        *[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in
          (("polarity", 0.0), ("sentiment_label", "NEUTRAL"), ("sentiment_score", 0.0), ("unscored", True)) if c in cols],
    )


def score_texts(df: DataFrame, lexicon: DataFrame, text: str = "text", rule: str = "strict",
                broadcast_max_rows: int = BROADCAST_MAX_ROWS, broadcast: bool | None = None) -> DataFrame:
    """Score rows that carry their own text (e.g. one micro-batch).  Each *text* is
    scored once, under a digest of the whole text (null has its own), and the score
    joined back, so rows that share a ``key`` but not a text keep their own scores and
    rows without a key are scored too.  Adds ``polarity, sentiment_label,
    sentiment_score, unscored``."""
    digest = F.coalesce(F.sha2(F.col(text), 256), F.lit("null"))
    rows = df.withColumn("_digest", digest)
    texts = rows.groupBy("_digest").agg(F.first(text).alias(text))
    scores = score_documents(texts, lexicon, rule, "_digest", text, broadcast_max_rows, broadcast)
    return attach_scores(rows, scores.drop("hits", "polarity_sum"), on="_digest").drop("_digest")


def score_placed_texts(df: DataFrame, lexicon: DataFrame, text: str = "text", rule: str = "strict",
                       broadcast_max_rows: int = BROADCAST_MAX_ROWS, broadcast: bool | None = None) -> DataFrame:
    """``score_texts`` for rows that keep their places between passes (a persisted micro-batch, a stored table), where no text
    crosses a shuffle: digests and places alone are grouped, the first row of each digest is tokenized where
    it lies, and scores go back by digest.  Up to ``BROADCAST_TEXTS`` different texts (counted) the places and the scores
    are broadcast; more are joined by shuffle."""
    rows = df.withColumn("_digest", F.coalesce(F.sha2(F.col(text), 256), F.lit("null"))).withColumn("_place", F.monotonically_increasing_id())
    places = stored(rows.groupBy("_digest").agg(F.min("_place").alias("_first")).select("_first"), "text-places")
    few = places.count() <= BROADCAST_TEXTS
    texts = rows.join(F.broadcast(places) if few else places, F.col("_place") == F.col("_first"), "left_semi").select("_digest", text)
    scores = score_documents(texts, lexicon, rule, "_digest", text, broadcast_max_rows, broadcast)
    return attach_scores(rows, scores.drop("hits", "polarity_sum"), on="_digest", broadcast_scores=few).drop("_digest", "_place")


def lexicon_scorer(entries: Iterable[tuple[str, int]]) -> Callable[[str], float]:
    """A ``str -> float`` scorer with the same result as ``lexicon_polarity`` (same
    tokens, same mean of hundredths), for ``with_scorer`` / streams, where the
    join-and-aggregate form would need state.  Meant for lexicons that fit in a
    Python dict on every executor; larger ones use the join in batch."""
    import re

    table = {str(w): int(v) for w, v in entries}
    split = re.compile(TOKEN_PATTERN).split

    def score_text(text: str) -> float:
        vals = [table[w] for w in split(text.lower()) if w in table]
        return sum(vals) / (HUNDREDTHS * len(vals)) if vals else 0.0
    return score_text


def with_batch_scorer(df: DataFrame, load: Callable[[], Callable[[pd.Series], pd.Series]], text: str = "text",
                      rule: str = "strict") -> DataFrame:
    """Score texts with a model that takes whole batches.

    ``load`` runs once in each Python worker and returns a function from a Series of texts
    (never null) to a Series of polarities, so a model is loaded once and sees Arrow
    batches.  A batch on which it fails is tried again by halves, down to single texts: only null texts and
    those that fail alone get polarity 0.0 and ``unscored = true``.  A failing ``load`` fails the query.
    """
    held: list = []

    def _parts(texts: pd.Series) -> list[float]:
        try:
            got = pd.Series(held[0](texts)).astype("float64").tolist()
            if len(got) == len(texts):
                return got
        except Exception:  # noqa: BLE001 - a scorer fault marks its texts, never the query
            pass
        half = len(texts) // 2
        return _parts(texts.iloc[:half]) + _parts(texts.iloc[half:]) if half else [float("nan")]

    def _score(s: pd.Series) -> pd.Series:
        out = pd.Series(float("nan"), index=s.index, dtype="float64")
        there = s.notna()
        if there.any():
            if not held:
                held.append(load())
            out[there] = _parts(s[there])
        return out

    raw = F.pandas_udf(_score, "double")(F.col(text))
    out = df.withColumn("_p", F.nanvl(raw, F.lit(None).cast("double")))
    out = out.withColumn("unscored", F.col("_p").isNull()).withColumn(
        "polarity", F.coalesce(F.col("_p"), F.lit(0.0))).drop("_p")
    return with_bands(out, rule)


def with_scorer(df: DataFrame, fn: Callable[[str], float], text: str = "text", rule: str = "strict") -> DataFrame:
    """Score each text with a user function ``str -> float`` (e.g. an outside
    sentiment library) in one Arrow-batched pandas UDF, then band it natively.

    A text the function fails on (or a null text) gets polarity 0.0 and
    ``unscored = true`` so faults stay visible instead of hiding as NEUTRAL.
    """
    def _safe(t):
        if t is None:
            return None
        try:
            v = fn(t)
            return None if v is None else float(v)
        except Exception:  # noqa: BLE001 - a scorer fault marks the row, never the batch
            return None

    @F.pandas_udf("double")
    def _score(s: pd.Series) -> pd.Series:
        return s.map(_safe).astype("float64")

    raw = _score(F.col(text))
    out = df.withColumn("_p", raw)
    out = out.withColumn("unscored", F.col("_p").isNull()).withColumn(
        "polarity", F.coalesce(F.col("_p"), F.lit(0.0))).drop("_p")
    return with_bands(out, rule)
