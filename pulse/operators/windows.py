"""Event-time windows: sliding sentiment windows, samples, trend, series, lateness."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.text import time_floor
from pulse.operators.prefix import BLOCK_ROWS, equal_depth, running

# --- fixed values (must equal the reference) ---------------------------------
WINDOW_SIZE = "10 seconds"
WINDOW_SLIDE = "5 seconds"
TREND_EVERY = "10 seconds"
SAMPLE_TEXTS = 3
# ------------------------------------------------------------------------------


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int | None:
    """Seconds in a simple interval string ("10 seconds", "1 hour"); None otherwise."""
    m = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day|week)s?\s*", text.lower())
    return int(m.group(1)) * _UNIT_SECONDS[m.group(2)] if m else None


def _use_panes(panes: bool | None, size: str, slide: str) -> bool:
    """Panes by default when size/slide > 2; asked for, they need size a multiple of slide."""
    size_s, slide_s = interval_seconds(size), interval_seconds(slide)
    can = bool(size_s and slide_s and size_s % slide_s == 0)
    if panes and not can:
        raise ValueError(f"panes need a size that is a multiple of the slide, not {size!r} and {slide!r}")
    return can and size_s // slide_s > 2 if panes is None else panes


def windowed_sentiment(scored: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                       ts: str = "timestamp", label: str = "sentiment_label",
                       score: str = "sentiment_score", order: str | None = "asc",
                       panes: bool | None = None) -> DataFrame:
    """Sliding windows x band: ``window, sentiment_label, tweet_count, avg_sentiment``.

    Each row counts in size/slide windows, starts aligned to the epoch; rows
    without a time are skipped.  Count and mean are partial aggregates combined
    map-side, so a window holding a third of all rows still shuffles one row per
    task.  The reference's unbounded ``collect_list`` of texts is left out of the
    aggregate (its state never shrinks); ``window_samples`` gives a bounded sample.
    ``order``: ``"asc"`` (windowed script), ``"desc"`` (dashboard) or ``None``.

    ``panes``: aggregate rows once per ``slide`` pane and expand only the pane
    aggregates into their windows, instead of expanding every row into size/slide
    copies.  Default: on when size/slide > 2 (e.g. 1 hour sliding by 1 minute
    copies each row 60 times the plain way); needs size a multiple of slide.
    """
    size_s, slide_s = interval_seconds(size), interval_seconds(slide)
    panes = _use_panes(panes, size, slide)
    if panes:
        out = _windowed_by_panes(scored, size_s, slide_s, ts, label, score)
    else:
        out = (scored.groupBy(F.window(F.col(ts), size, slide).alias("window"), F.col(label).alias(label))
               .agg(F.count(F.lit(1)).alias("tweet_count"), F.avg(score).alias("avg_sentiment")))
    if order == "asc":
        out = out.orderBy(F.col("window").asc())
    elif order == "desc":
        out = out.orderBy(F.col("window").desc())
    return out


def _windowed_by_panes(scored: DataFrame, size_s: int, slide_s: int, ts: str, label: str,
                       score: str) -> DataFrame:
    per_pane = (scored.groupBy(F.window(F.col(ts), f"{slide_s} seconds")["start"].alias("_pane"),
                               F.col(label).alias(label))
                .agg(F.count(F.lit(1)).alias("_n"), F.sum(score).alias("_s"), F.count(score).alias("_c")))
    k = F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1))).alias("_k")
    start = F.col("_pane") - F.make_dt_interval(secs=F.col("_k") * F.lit(slide_s))
    windowed = (per_pane.select("*", k)
                .select(F.struct(start.alias("start"), (start + F.make_dt_interval(secs=F.lit(size_s)))
                                 .alias("end")).alias("window"), label, "_n", "_s", "_c"))
    return (windowed.groupBy("window", label)
            .agg(F.sum("_n").alias("tweet_count"), (F.sum("_s") / F.sum("_c")).alias("avg_sentiment")))


def window_samples(scored: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                   n: int = SAMPLE_TEXTS, ts: str = "timestamp", label: str = "sentiment_label",
                   tie: str = "id", panes: bool | None = None) -> DataFrame:
    """The newest ``n`` rows of each (window, band), with ``sample_rank`` 1..n.

    ``row_number() <= n`` is planned with a per-task group limit before the
    shuffle, so at most ``n`` rows per group and task move, however hot a window
    is.  With ``panes`` (default when size/slide > 2) each slide-sized pane keeps
    its newest ``n`` first and only those rows are copied into their windows: a
    window's newest ``n`` are among its panes' newest ``n``.  Attach texts
    afterwards (only the sampled rows need them).
    """
    size_s, slide_s = interval_seconds(size), interval_seconds(slide)
    panes = _use_panes(panes, size, slide)
    newest = [F.col(ts).desc(), F.col(tie).desc()]
    if panes:
        pane = F.window(F.col(ts), f"{slide_s} seconds")["start"]
        in_pane = Window.partitionBy("_pane", label).orderBy(*newest)
        top = (scored.withColumn("_pane", pane).withColumn("_r", F.row_number().over(in_pane))
               .filter(F.col("_r") <= F.lit(int(n))))
        k = F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1))).alias("_k")
        start = F.col("_pane") - F.make_dt_interval(secs=F.col("_k") * F.lit(slide_s))
        expanded = (top.select("*", k)
                    .select(F.struct(start.alias("start"), (start + F.make_dt_interval(secs=F.lit(size_s)))
                                     .alias("end")).alias("window"), *scored.columns))
    else:
        expanded = scored.select(F.window(F.col(ts), size, slide).alias("window"), *scored.columns)
    w = Window.partitionBy("window", label).orderBy(*newest)
    return (expanded.withColumn("sample_rank", F.row_number().over(w))
            .filter(F.col("sample_rank") <= F.lit(int(n))))


def window_texts(scored: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE, ts: str = "timestamp",
                 label: str = "sentiment_label", columns: tuple[str, ...] = ("id", "text")) -> DataFrame:
    """Every row of each (window, band), in long form: ``window, sentiment_label`` and ``columns``.

    The reference gathered all texts of a window into one list; the same rows are given
    here one by one, so no window is ever put together in a task.  ``window_samples``
    is the bounded variant.  Rows without a time are in no window."""
    return scored.select(F.window(F.col(ts), size, slide).alias("window"), F.col(label), *columns)


def sample_lists(samples: DataFrame, text: str = "text", label: str = "sentiment_label") -> DataFrame:
    """``window, sentiment_label, sample_tweets`` (array, newest first) from ``window_samples``;
    each list has at most ``n`` entries."""
    return (samples.groupBy("window", label)
            .agg(F.array_sort(F.collect_list(F.struct("sample_rank", text))).alias("_s"))
            .select("window", label, F.transform("_s", lambda s: s[text]).alias("sample_tweets")))


def trend(scored: DataFrame, every: str = TREND_EVERY, ts: str = "timestamp",
          score: str = "sentiment_score") -> DataFrame:
    """Tumbling ``every`` buckets: ``bucket_start, avg_sentiment, tweet_count``;
    rows without a time are left out and empty buckets are not filled."""
    return (scored.groupBy(time_floor(ts, every).alias("bucket_start"))
            .agg(F.avg(score).alias("avg_sentiment"), F.count(F.lit(1)).alias("tweet_count")))


def window_series(windowed: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """Long form for a grouped bar chart: ``window_start, sentiment_label, tweet_count``."""
    return windowed.select(F.col("window.start").alias("window_start"), F.col(label), F.col("tweet_count"))


def late_report(posts: DataFrame, delay: str = "30 seconds", feed: str = "feed", arrival: str = "arrival",
                ts: str = "timestamp", tie: str = "id", block_size: int | None = None,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """On-time and late rows per feed, the batch view of a watermark.

    A row's lateness is the newest event time that arrived before it in the
    feed (arrival order, ties by id) minus its own time; it is late when that
    exceeds ``delay``.  The running max is blocked, so a feed holding a third of all rows, or a burst of
    arrivals, is still spread over many tasks: by blocks of about ``block_rows`` rows (``equal_depth``), or
    by ``arrival div block_size`` where that is given.
    Output: ``feed, rows, on_time, late, max_lateness_seconds``.
    """
    # the epoch instant plus the delay, read back in microseconds (no session zone involved)
    delay_us = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {delay})")
    base = posts.select(F.col(feed).alias("feed"), F.col(arrival).alias("_arr"), F.col(tie).alias("_tie"),
                        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"))
    order = [F.col("_arr"), F.col("_tie")]
    if block_size is None:
        # equal rows in all columns are alike, so any of them may come first
        base, blk = equal_depth(base, [*order, "_us"], ["feed"], block_rows), F.col("_depth")
    else:
        blk = F.floor(F.col("_arr") / F.lit(block_size))
    scanned = running(base, "_us", "max", order, blk, partition=["feed"], inclusive=False, out="_prev")
    lateness = F.col("_prev") - F.col("_us")
    flagged = scanned.select("feed", lateness.alias("_late_us"))
    return (flagged.groupBy("feed")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(~F.coalesce(F.col("_late_us") > delay_us, F.lit(False))).alias("on_time"),
                 F.count_if(F.coalesce(F.col("_late_us") > delay_us, F.lit(False))).alias("late"),
                 (F.max(F.greatest(F.col("_late_us"), F.lit(0))) / F.lit(1e6)).alias("max_lateness_seconds")))


def windowed_with_samples(scored: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                          n: int = SAMPLE_TEXTS, ts: str = "timestamp", label: str = "sentiment_label",
                          score: str = "sentiment_score", text: str = "text", tie: str = "id") -> DataFrame:
    """The reference's window row - ``window, sentiment_label, tweet_count,
    avg_sentiment, sample_tweets`` - with ``sample_tweets`` holding the newest
    ``n`` texts instead of every text: counts come from the partial aggregate,
    samples from the per-task group limit, joined on (window, band)."""
    counts = windowed_sentiment(scored, size, slide, ts, label, score, order=None)
    samples = sample_lists(window_samples(scored, size, slide, n, ts, label, tie), text, label)
    samples = samples.select(F.col("window").alias("_w"), F.col(label).alias("_l"), "sample_tweets")
    on = (F.col("window") == F.col("_w")) & F.col(label).eqNullSafe(F.col("_l"))
    return counts.join(samples, on, "left").drop("_w", "_l")
