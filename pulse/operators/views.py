"""The dashboard's questions about the last few minutes, as DataFrame operators.

Every "now" is an ``as_of`` argument: a timestamp, a column or a scalar
subquery (``pulse.sources.as_of``); spans are interval strings ("5 minutes").
The time bound is a plain comparison on the event-time column, so over a
stored table it reaches the scan as a pushed filter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.sentiment import NEGATIVE, POSITIVE, VERY_NEGATIVE, VERY_POSITIVE, emoji
from pulse.functions.text import age_text, clock, fixed, headline

# --- fixed values (must equal the reference) ---------------------------------
SPAN = "5 minutes"
RECENT_POSTS_LIMIT = 50
WINDOWED_STATS_LIMIT = 30
LATEST_WINDOWS = 10
POST_LIST_LIMIT = 30
POST_COLUMNS = ["username", "text", "sentiment_label", "polarity", "sentiment_score", "timestamp"]
# ------------------------------------------------------------------------------


def _as_of(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        return F.lit(as_of)
    return F.lit(as_of).cast("timestamp")


def since(as_of, span: str = SPAN) -> Column:
    """``as_of - span``."""
    return _as_of(as_of) - F.expr(f"INTERVAL {span}")


def in_span(df: DataFrame, as_of, span: str = SPAN, ts: str = "timestamp") -> DataFrame:
    """Rows with ``ts >= as_of - span`` (the reference has no upper bound)."""
    return df.filter(F.col(ts) >= since(as_of, span))


def recent_posts(scored: DataFrame, as_of, span: str = SPAN, limit: int | None = RECENT_POSTS_LIMIT,
                 ts: str = "timestamp", tie: str = "id", columns: list[str] | None = None) -> DataFrame:
    """Newest posts of the span, newest first (ties by id), at most ``limit``."""
    cols = [c for c in (columns or POST_COLUMNS) if c in scored.columns]
    out = in_span(scored, as_of, span, ts).orderBy(F.col(ts).desc(), F.col(tie).desc())
    if limit is not None:
        out = out.limit(int(limit))
    return out.select(*cols, *([tie] if tie not in cols else []))


def posts_in_span(scored: DataFrame, as_of, span: str = SPAN, ts: str = "timestamp",
                  tie: str = "id", columns: list[str] | None = None) -> DataFrame:
    """All posts of the span, newest first."""
    return recent_posts(scored, as_of, span, None, ts, tie, columns)


def windowed_stats(windowed: DataFrame, as_of, span: str = SPAN, limit: int | None = WINDOWED_STATS_LIMIT,
                   label: str = "sentiment_label") -> DataFrame:
    """``window_start, window_end, sentiment_label, tweet_count, avg_sentiment`` of
    windows starting in the span, newest first (ties by band), at most ``limit``."""
    out = (windowed.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                           F.col(label), "tweet_count", "avg_sentiment")
           .filter(F.col("window_start") >= since(as_of, span))
           .orderBy(F.col("window_start").desc(), F.col(label).asc()))
    return out.limit(int(limit)) if limit is not None else out


def latest_windows(windowed: DataFrame, n: int = LATEST_WINDOWS, label: str = "sentiment_label") -> DataFrame:
    """The newest ``n`` window rows as the console printed them: ``HH:mm:ss`` start
    and end, band, count, mean with 3 decimals."""
    top = windowed.orderBy(F.col("window.start").desc(), F.col(label).asc()).limit(int(n))
    return top.select(F.col("window.start").alias("window_start"),
                      clock(F.col("window.start")).alias("start_clock"),
                      clock(F.col("window.end")).alias("end_clock"),
                      F.col(label), "tweet_count",
                      fixed(F.col("avg_sentiment"), 3).alias("avg_text"))


def _n(weight: str | None) -> Column:
    return F.lit(1).cast("long") if weight is None else F.col(weight)


def _rows(scored: DataFrame, as_of, span, ts: str) -> DataFrame:
    return in_span(scored, as_of, span, ts) if as_of is not None and span else scored


def overall_stats(scored: DataFrame, as_of, span: str | None = SPAN, ts: str = "timestamp",
                  label: str = "sentiment_label", score: str = "sentiment_score",
                  weight: str | None = None) -> DataFrame:
    """Per band and in total over the span: ``sentiment_label`` (null on the total
    row), ``is_total``, ``tweet_count``, ``avg_sentiment``.

    One pass with grouping sets ((band), ()).  The reference read the total from
    the first band's row; this gives the true total.  ``weight``: a column of
    post counts, for rows that already stand for several posts (e.g. posts
    counted per document before joining the document's score); with
    ``as_of=None`` the rows are taken as already inside the span.
    """
    n = _n(weight)
    return (_rows(scored, as_of, span, ts)
            .rollup(label)
            .agg(F.sum(n).alias("tweet_count"),
                 (F.sum(n * F.col(score)) / F.sum(F.when(F.col(score).isNotNull(), n))).alias("avg_sentiment"),
                 F.grouping(label).cast("boolean").alias("is_total")))


def throughput(scored: DataFrame, as_of, start, span: str | None = SPAN, ts: str = "timestamp") -> DataFrame:
    """``total_tweets``, ``elapsed_seconds`` (as_of - start) and ``tweets_per_second``
    (0 when elapsed is not positive).  As in the reference, the count covers the
    span while the time runs from ``start``."""
    rows = in_span(scored, as_of, span, ts) if span else scored
    elapsed = (F.unix_micros(_as_of(as_of).cast("timestamp")) -
               F.unix_micros(_as_of(start).cast("timestamp"))) / F.lit(1e6)
    total = rows.agg(F.count(F.lit(1)).alias("total_tweets"))
    return total.select(
        "total_tweets", elapsed.alias("elapsed_seconds"),
        F.when(elapsed > 0, F.col("total_tweets") / elapsed).otherwise(F.lit(0.0)).alias("tweets_per_second"))


def positive_negative(scored: DataFrame, as_of=None, span: str | None = SPAN, ts: str = "timestamp",
                      label: str = "sentiment_label", weight: str | None = None) -> DataFrame:
    """One row: ``positive`` (POSITIVE + VERY_POSITIVE) and ``negative`` counts; 0 if absent."""
    n = _n(weight)
    lbl = F.col(label)
    return _rows(scored, as_of, span, ts).agg(
        F.coalesce(F.sum(F.when(lbl.isin(POSITIVE, VERY_POSITIVE), n)), F.lit(0)).cast("long").alias("positive"),
        F.coalesce(F.sum(F.when(lbl.isin(NEGATIVE, VERY_NEGATIVE), n)), F.lit(0)).cast("long").alias("negative"))


def distribution(scored: DataFrame, as_of=None, span: str | None = SPAN, ts: str = "timestamp",
                 label: str = "sentiment_label", weight: str | None = None) -> DataFrame:
    """``sentiment_label, tweet_count``, largest first; rows without a band left out."""
    return (_rows(scored, as_of, span, ts).filter(F.col(label).isNotNull()).groupBy(label)
            .agg(F.sum(_n(weight)).cast("long").alias("tweet_count"))
            .orderBy(F.col("tweet_count").desc(), F.col(label).asc()))


def post_list(posts: DataFrame, as_of, n: int = POST_LIST_LIMIT, ts: str = "timestamp", tie: str = "id",
              label: str = "sentiment_label", score: str = "sentiment_score",
              username: str = "username") -> DataFrame:
    """The first ``n`` posts (newest first) with ``headline`` (``🟢 @user - BAND
    (Score: 0.60)``) and ``age`` (``3m 4s ago`` relative to ``as_of``)."""
    top = posts.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(int(n))
    return top.select(
        *top.columns,
        headline(emoji(F.col(label), "dots"), F.col(username), F.col(label), F.col(score)).alias("headline"),
        age_text(F.col(ts), _as_of(as_of)).alias("age"),
    )


def kpis(scored: DataFrame, as_of, start, span: str | None = SPAN, ts: str = "timestamp",
         label: str = "sentiment_label", score: str = "sentiment_score", weight: str | None = None) -> DataFrame:
    """The dashboard's metric row in one aggregate pass: ``total_tweets``,
    ``avg_sentiment`` and its 3-decimal text, ``tweets_per_second`` (posts of the
    span / seconds since ``start``) and its 1-decimal text, ``positive``,
    ``negative``.  The mean is over all posts of the span (the reference showed the
    first band's mean)."""
    n = _n(weight)
    lbl = F.col(label)
    elapsed = (F.unix_micros(_as_of(as_of).cast("timestamp")) -
               F.unix_micros(_as_of(start).cast("timestamp"))) / F.lit(1e6)
    agg = _rows(scored, as_of if span else None, span, ts).agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("total_tweets"),
        (F.sum(n * F.col(score)) / F.sum(F.when(F.col(score).isNotNull(), n))).alias("avg_sentiment"),
        F.coalesce(F.sum(F.when(lbl.isin(POSITIVE, VERY_POSITIVE), n)), F.lit(0)).cast("long").alias("positive"),
        F.coalesce(F.sum(F.when(lbl.isin(NEGATIVE, VERY_NEGATIVE), n)), F.lit(0)).cast("long").alias("negative"))
    tps = F.when(elapsed > 0, F.col("total_tweets") / elapsed).otherwise(F.lit(0.0))
    return agg.select(
        "total_tweets", "avg_sentiment",
        fixed(F.coalesce(F.col("avg_sentiment"), F.lit(0.0)), 3).alias("avg_text"),
        tps.alias("tweets_per_second"), fixed(tps, 1).alias("tps_text"), "positive", "negative")
