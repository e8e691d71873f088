"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

They run the library's operators over the whole test tables (no id subsets, no
row caps; limits appear only where the top-k is the feature).  Output columns
are aliased to the names used by the SQL in ``pulse.plans.oracle``; means are
rounded to 6 places and times are returned as TIMESTAMP_NTZ (UTC wall clock).

Two keys run real Structured Streaming queries (``stream_windowed_sentiment``,
``stream_scored_posts``): they write the posts as JSON lines under the
session's checkpoint folder, drain them with an ``availableNow`` trigger, and
return the stored result, which must equal the same SQL as the batch form.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from pulse.functions.sentiment import display_label, emoji, label
from pulse.functions.text import age_parts, age_text, card_line, fixed, preview, short_time
from pulse.operators import ingest, views, windows
from pulse.operators.scoring import attach_scores, lexicon_scorer, with_scorer
from pulse.plans.fixtures import api_lines, overlapping_polls
from pulse.plans.inputs import (
    SPAN_ALL, SPANS, TEST_LEXICON, doc_scores, event_count, newest_event, oldest_event, scored_posts,
)
from pulse.session import ensure_utc, stored
from pulse.sources.lines import parse_posts, to_lines, unwrap_envelope
from pulse.sources.tables import attach_text, posts_view, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _register(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return _ntz(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _register_spans(name: str):
    """The query over the whole table (``name``) and over spans that cut (``name_7d``, ``name_5m``)."""
    def deco(fn):
        for suffix, span in SPANS.items():
            def of_span(spark, sf, span=span):
                return fn(spark, sf, span)
            of_span.__doc__ = fn.__doc__
            _register(name + suffix)(of_span)
        return fn
    return deco


def _ntz(df: DataFrame) -> DataFrame:
    """Session-zone timestamps as UTC wall-clock TIMESTAMP_NTZ (the session is UTC)."""
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def _r6(c) -> Column:
    # "+ 0.0" turns a negative zero into zero
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


def _window_cols(df: DataFrame) -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


# ---------------------------------------------------------------- scoring

@_register("polarity")
def _polarity(spark, sf):
    """Lexicon polarity per document, 0.0 without a match."""
    s = doc_scores(spark, sf)
    return s.select("doc_id", "hits", "polarity_sum", "polarity", "unscored")


@_register("label_strict")
def _label_strict(spark, sf):
    """Strict bands and scores."""
    s = doc_scores(spark, sf, "strict")
    return s.select("doc_id", "polarity", "sentiment_label", "sentiment_score")


@_register("label_wide")
def _label_wide(spark, sf):
    """wide bands and scores."""
    s = doc_scores(spark, sf, "wide")
    return s.select("doc_id", "polarity", "sentiment_label", "sentiment_score")


@_register("emoji")
def _emoji(spark, sf):
    """faces on the strict band, dots on the wide band, printer text."""
    s = doc_scores(spark, sf, "strict")
    strict = F.col("sentiment_label")
    wide = label("polarity", "wide")
    return s.select("doc_id", strict.alias("strict_label"), emoji(strict, "faces").alias("face"),
                    display_label(strict).alias("display"), wide.alias("wide_label"),
                    emoji(wide, "dots").alias("dot"))


@_register("plugin_scorer")
def _plugin_scorer(spark, sf):
    """A plug-in scorer (the lexicon as a Python scorer) through one pandas UDF."""
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    out = with_scorer(docs, lexicon_scorer(TEST_LEXICON), rule="strict")
    return out.select("doc_id", "polarity", "sentiment_label", "sentiment_score",
                      "unscored")


# ---------------------------------------------------------------- windows

def _windowed(spark, sf, rule, size=windows.WINDOW_SIZE, slide=windows.WINDOW_SLIDE):
    return windows.windowed_sentiment(scored_posts(spark, sf, rule), size, slide, order=None)


def _windowed_out(w: DataFrame) -> DataFrame:
    return w.select(*_window_cols(w), "sentiment_label", "tweet_count",
                    _r6("avg_sentiment").alias("avg_sentiment"))


@_register("windowed_sentiment")
def _windowed_sentiment(spark, sf):
    """A1: 10 s windows sliding by 5 s x strict band."""
    return _windowed_out(_windowed(spark, sf, "strict"))


@_register("windowed_sentiment_hourly")
def _windowed_sentiment_hourly(spark, sf):
    """A1 with 1 h windows sliding by 30 min (groups of many posts)."""
    return _windowed_out(_windowed(spark, sf, "strict", "1 hour", "30 minutes"))


@_register("windowed_sentiment_panes")
def _windowed_sentiment_panes(spark, sf):
    """A1 with 1 h windows sliding by 10 min: six windows per post, computed from
    10-minute pane aggregates instead of six copies of every row."""
    return _windowed_out(_windowed(spark, sf, "strict", "1 hour", "10 minutes"))


def _stream_root(spark, name):
    import uuid

    from pulse.session import checkpoint_root

    tag = uuid.uuid4().hex
    return f"{checkpoint_root(spark)}/registry/{name}-{tag}", f"{name}_{tag[:8]}"


def _finish(q):
    """Wait until an availableNow query has drained its source; a failure is raised, never cut short."""
    try:
        q.awaitTermination()
    finally:
        q.stop()


LINES_PER_FILE = 10_000          # a compressed file is read by one task
FILES_PER_BATCH = 50             # of queries that score: half a million texts a batch, so places and scores fit a broadcast


def _put_lines(lines, root, per_file=LINES_PER_FILE, level="DEFAULT_COMPRESSION"):
    """Append lines to ``root/lines``, compressed.  ``level``: of zlib; ``BEST_SPEED`` takes a third to half of the time, and 14 to 34 % more bytes."""
    lines.write.mode("append").option("compression", "gzip").option("zlib.compress.level", level).option("maxRecordsPerFile", per_file).text(f"{root}/lines")


def _write_lines(spark, sf, root, posts=None):
    """The posts as JSON lines, in files of an eighth of them or ``LINES_PER_FILE`` (more files where more tasks write)."""
    posts = posts_view(spark, sf, with_text=True) if posts is None else posts
    eighth = (read_table(spark, sf, "events", "event_id").count() + 7) // 8 or 1
    _put_lines(to_lines(posts), root, min(eighth, LINES_PER_FILE))


def _files_of_quarter(spark, sf):
    """How many files of ``_write_lines`` make a quarter of the posts, two at least and ``FILES_PER_BATCH`` at most."""
    n = read_table(spark, sf, "events", "event_id").count()
    return min(max(2, n // (4 * min((n + 7) // 8 or 1, LINES_PER_FILE))), FILES_PER_BATCH)


def _scored_table(spark, sf, root, name):
    """Posts as a file stream, scored once per micro-batch by the lexicon join, into ``root/scored``."""
    from pulse.operators.scoring import lexicon_frame
    from pulse.streaming import post_stream, score_batches, trigger_options

    posts = post_stream(spark, f"{root}/lines", max_files_per_trigger=_files_of_quarter(spark, sf))
    _finish(score_batches(posts, lexicon_frame(spark, TEST_LEXICON), f"{root}/scored", f"{name}_rows", rule="strict",
                          trigger=trigger_options(available_now=True), checkpoint=f"{root}/checkpoint-rows", placed=True))
    return spark.read.parquet(f"{root}/scored")


@_register("stream_windowed_sentiment")
def _stream_windowed_sentiment(spark, sf):
    """The flagship windows computed by Structured Streaming.

    Whole posts arrive as JSON lines; one stream parses and scores them (native lexicon
    join, each text once) into a table; a second stream reads that table and keeps
    10 s / 5 s windows in update mode without a watermark, so late rows count and only
    changed windows are written.  The table must equal ``windowed_sentiment``.
    """
    from pulse.streaming import read_updates, scored_windows, trigger_options, write_updates

    root, name = _stream_root(spark, "stream_windowed")
    _write_lines(spark, sf, root)
    scored = _scored_table(spark, sf, root, name)
    w = scored_windows(spark, f"{root}/scored", scored.schema, windows.WINDOW_SIZE, windows.WINDOW_SLIDE, max_files_per_trigger=3)
    _finish(write_updates(w, f"{root}/windows", f"{name}_windows", trigger_options(available_now=True),
                          checkpoint=f"{root}/checkpoint-windows"))
    out = read_updates(spark, f"{root}/windows", ["window_start", "window_end", "sentiment_label"])
    return out.select("window_start", "window_end", "sentiment_label", "tweet_count", _r6("avg_sentiment").alias("avg_sentiment"))


@_register("stream_scored_posts")
def _stream_scored_posts(spark, sf):
    """S4, F1 in a stream: the posts as a file stream, scored per micro-batch by the
    lexicon join (``score_batches``), each batch written to its own folder.  The
    stored rows must equal every post with its document's score."""
    root, name = _stream_root(spark, "stream_scored")
    _write_lines(spark, sf, root)
    return _scored_table(spark, sf, root, name).select("id", "polarity", "sentiment_label", "sentiment_score")


def _drained(spark, sf, root, parts, start, posts=None, **lines):
    """Write each part (a filter on the posts) as JSON lines by many tasks and drain it with the queries of ``start()``, so that a
    stream reads the parts one after the other.  More than two parts take the posts from a stored table, so that texts are joined,
    and shuffled, once and not for each part.  ``lines`` as in ``_put_lines``."""
    from pulse.streaming.sinks import TEXT_TABLE

    whole = posts_view(spark, sf, with_text=True) if posts is None else attach_text(spark, sf, posts)
    if len(parts) > 2:
        whole.write.options(**TEXT_TABLE).parquet(f"{root}/whole")
        whole = spark.read.schema(whole.schema).parquet(f"{root}/whole")
    for part in parts:
        _put_lines(to_lines(whole.filter(part)), root, **lines)
        for query in start():
            _finish(query)


def _scoring(spark, root, name, columns=None):
    """A query that scores new lines by the lexicon join into ``root/scored`` (all columns, unless some are named)."""
    from pulse.operators.scoring import lexicon_frame
    from pulse.streaming import post_stream, score_batches, trigger_options

    return score_batches(post_stream(spark, f"{root}/lines", max_files_per_trigger=FILES_PER_BATCH), lexicon_frame(spark, TEST_LEXICON),
                         f"{root}/scored", f"{name}_rows", rule="strict", trigger=trigger_options(available_now=True),
                         checkpoint=f"{root}/checkpoint-rows", placed=True, columns=columns)


def _quarters(spark, sf):
    n = read_table(spark, sf, "events", "event_id").count()
    return [f"event_id >= {n * k // 4} AND event_id < {n * (k + 1) // 4}" for k in range(4)]


@_register("stream_since_id")
def _stream_since_id(spark, sf):
    """I7-I9 in a stream: the mark moves with each batch.  Quarters of the posts by id arrive in the
    order 2, 1, 4, 3, so the first and third quarter fall behind the mark."""
    from pulse.streaming import post_stream, since_id_stream, trigger_options

    root, name = _stream_root(spark, "stream_since")
    q = _quarters(spark, sf)
    _drained(spark, sf, root, [q[1], q[0], q[3], q[2]], lambda: [since_id_stream(
        post_stream(spark, f"{root}/lines"), f"{root}/out", f"{root}/marks", name, trigger=trigger_options(available_now=True),
        checkpoint=f"{root}/checkpoint", placed=True)])
    return spark.read.parquet(f"{root}/out").select("id", "timestamp")


@_register("stream_dedup")
def _stream_dedup(spark, sf):
    """T6 in a stream: every post arrives twice, its second copy a quarter later; the
    memory of 60 days of event time covers them all."""
    from pulse.streaming import dedup_stream, post_stream, to_table, trigger_options

    root, name = _stream_root(spark, "stream_dedup")
    q = _quarters(spark, sf)
    _drained(spark, sf, root, [q[0], f"({q[0]}) OR ({q[1]})", f"({q[1]}) OR ({q[2]})", f"({q[2]}) OR ({q[3]})", q[3]], lambda: [to_table(
        dedup_stream(post_stream(spark, f"{root}/lines"), ttl="60 days", columns=["id", "username", "timestamp"]), name, "append", trigger_options(available_now=True),
        checkpoint=f"{root}/checkpoint", fmt="parquet", path=f"{root}/out")], level="BEST_SPEED")
    return spark.read.parquet(f"{root}/out").select("id", "username", "timestamp")


@_register("stream_dedup_hour")
def _stream_dedup_hour(spark, sf):
    """T6 in a stream, with the hour's memory over whole posts (``dedup_tables``).  The later half of the days arrives first, so all of the
    earlier half is late.  Some posts come again 50 minutes on (dropped), two hours on or edited (kept).  Then the late half
    comes a second time, and the newest half hour (dropped), and posts three hours on, late again (kept).
    Each part is written by many tasks and drained by a run of its own."""
    from pulse.streaming import dedup_tables, kept_posts, post_stream, trigger_options

    root, name = _stream_root(spark, "stream_dedup_hour")
    span = read_table(spark, sf, "events", "ts").agg(F.min("ts").alias("a"), F.max("ts").alias("top")).select(
        F.expr("date_trunc('DAY', a + (top - a) / 2)").cast("string").alias("m"), F.col("top").cast("string").alias("top")).first()
    late, top = f"timestamp < timestamp_ntz'{span['m']}'", f"timestamp_ntz'{span['top']}'"
    half = f"IF({late}, 2, 1)"
    again = f"timestamp < {top} - INTERVAL 1 DAY AND event_id % 10"
    copies = [("true", half, 0), (f"{again} = 1", half, 50), (f"{again} = 2", half, 120), (f"{again} = 3", half, 5),
              (f"({late}) OR timestamp > {top} - INTERVAL 30 MINUTES", 3, 0), (f"NOT ({late}) AND {again} = 5", 3, 180)]
    copies = ", ".join(f"IF({when}, named_struct('part', {part}, 'minutes', {minutes}), NULL)" for when, part, minutes in copies)
    for part in (1, 2, 3):
        sent = (posts_view(spark, sf).withColumn("copy", F.explode(F.expr(f"array_compact(array({copies}))"))).filter(F.col("copy.part") == part)
                .withColumn("timestamp", F.expr("timestamp + make_dt_interval(0, 0, copy.minutes)")))
        text = F.coalesce("text", F.lit(""))
        sent = attach_text(spark, sf, sent).withColumn("text", F.when(F.col("copy.minutes") == 5, F.concat(F.lit("edited "), text)).otherwise(text))
        _put_lines(to_lines(sent, ["id", "text", "username", "timestamp"]), root, level="BEST_SPEED")
        for query in dedup_tables(post_stream(spark, f"{root}/lines"), root, name, trigger=trigger_options(available_now=True)):
            _finish(query)
    return kept_posts(spark, root, ["id", "username", "timestamp", F.md5("text").alias("text_md5")])


@_register("stream_restart")
def _stream_restart(spark, sf):
    """Hourly windows x band in update mode over scored rows, by queries that stop after half of the posts and are
    started again from their checkpoints; the changed windows of both runs, folded, equal the windows of all posts."""
    from pulse.streaming import fold_updates, read_updates, scored_windows, trigger_options, write_updates

    root, name = _stream_root(spark, "stream_restart")
    keys = ["window_start", "window_end", "sentiment_label"]
    q = _quarters(spark, sf)

    def start():
        yield _scoring(spark, root, name)
        w = scored_windows(spark, f"{root}/scored", spark.read.parquet(f"{root}/scored").schema, "1 hour", "1 hour")
        yield write_updates(w, f"{root}/out", name, trigger_options(available_now=True), checkpoint=f"{root}/checkpoint")

    for half in (f"({q[0]}) OR ({q[1]})", f"({q[2]}) OR ({q[3]})"):
        _drained(spark, sf, root, [half], start)
        fold_updates(spark, f"{root}/out", keys, 1)
    out = read_updates(spark, f"{root}/out", keys)
    return out.select("window_start", "sentiment_label", "tweet_count", _r6("avg_sentiment").alias("avg_sentiment"))


@_register("stream_append_late")
def _stream_append_late(spark, sf):
    """Append mode drops late rows.  Later half of the days first, then the earlier half, all of it behind the
    watermark; finished hourly windows x band are those of the later half that the watermark has passed."""
    from pulse.streaming import scored_windows, to_table, trigger_options

    root, name = _stream_root(spark, "stream_append")
    mid = read_table(spark, sf, "events", "ts").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(
        F.expr("date_trunc('DAY', a + (b - a) / 2)").cast("string").alias("m")).first()["m"]
    late, new = f"timestamp < timestamp_ntz'{mid}'", f"timestamp >= timestamp_ntz'{mid}'"

    def start():
        yield _scoring(spark, root, name)
        w = scored_windows(spark, f"{root}/scored", spark.read.parquet(f"{root}/scored").schema, "1 hour", "1 hour", "1 hour")
        yield to_table(w, name, "append", trigger_options(available_now=True), checkpoint=f"{root}/checkpoint", fmt="parquet", path=f"{root}/out")

    _drained(spark, sf, root, [new, late], start)
    return spark.read.parquet(f"{root}/out").select("window_start", "sentiment_label", "tweet_count", _r6("avg_sentiment").alias("avg_sentiment"))


@_register("window_samples")
def _window_samples(spark, sf):
    """A2: newest 3 texts of each 1 h / 30 min window x band.  The samples are stored and counted, so that
    only the texts of sampled documents leave the scan."""
    s = stored(windows.window_samples(scored_posts(spark, sf, "strict"), "1 hour", "30 minutes", n=3), "window-samples")
    s = attach_text(spark, sf, s, bounded_rows=s.count())
    return s.select(*_window_cols(s), "sentiment_label", F.col("sample_rank").cast("long").alias("sample_rank"),
                    "id", "text")


@_register("window_texts")
def _window_texts(spark, sf):
    """A2: every text of each 1 h / 30 min window x band, in long form (a digest stands for each text)."""
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    digests = docs.select(F.col("doc_id").alias("_d"), F.md5("text").alias("text_md5"))
    rows = scored_posts(spark, sf, "strict")
    rows = rows.join(digests, rows["doc_id"] == digests["_d"], "left")
    t = windows.window_texts(rows, "1 hour", "30 minutes", columns=("id", "text_md5"))
    return t.select(*_window_cols(t), "sentiment_label", "id", "text_md5")


@_register("trend")
def _trend(spark, sf):
    """Tumbling 10 s mean score."""
    t = windows.trend(scored_posts(spark, sf, "wide"))
    return t.select("bucket_start", _r6("avg_sentiment").alias("avg_sentiment"), "tweet_count")


@_register("trend_hourly")
def _trend_hourly(spark, sf):
    """A9 with 1 h buckets."""
    t = windows.trend(scored_posts(spark, sf, "wide"), "1 hour")
    return t.select("bucket_start", _r6("avg_sentiment").alias("avg_sentiment"), "tweet_count")


@_register("window_series")
def _window_series(spark, sf):
    """A10: window start x band -> count."""
    return windows.window_series(_windowed(spark, sf, "wide"))


@_register("late_report")
def _late_report(spark, sf):
    """On-time / late rows per feed (event type) over overlapping polls, delay 30 s."""
    polls = overlapping_polls(spark, sf, extra=("event_type",))
    return windows.late_report(polls, "30 seconds", feed="event_type")


@_register("late_report_null_feed")
def _late_report_null_feed(spark, sf):
    """T7 where a feed has no name: rows of a null feed are one feed, with blocks of 500 arrivals."""
    polls = overlapping_polls(spark, sf, extra=("event_type",))
    polls = polls.withColumn("feed", F.when(F.col("event_type") != "view", F.col("event_type")))
    return windows.late_report(polls, "30 seconds", feed="feed", block_size=500)


# ---------------------------------------------------------------- views

def _span_counts_by_doc(spark, sf, span, rule="wide"):
    """Posts of the span counted per document, then given the document's score:
    the aggregate runs before the join, so the join sees one row per document
    instead of one per post (a band total needs only the count per band)."""
    posts = views.in_span(posts_view(spark, sf), newest_event(spark, sf), span)
    per_doc = posts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    # the same rule for a missing document as everywhere else
    return attach_scores(per_doc, doc_scores(spark, sf, rule).drop("hits", "polarity_sum"))


@_register_spans("overall_stats")
def _overall_stats(spark, sf, span=SPAN_ALL):
    """A4/A5: per band and total, over the span before the newest event."""
    o = views.overall_stats(_span_counts_by_doc(spark, sf, span), None, None, weight="n")
    return o.select("sentiment_label", "is_total", "tweet_count", _r6("avg_sentiment").alias("avg_sentiment"))


@_register_spans("throughput")
def _throughput(spark, sf, span=SPAN_ALL):
    """Posts per second between the oldest and newest event (no score needed)."""
    t = views.throughput(posts_view(spark, sf), newest_event(spark, sf), oldest_event(spark, sf), span)
    return t.select("total_tweets", _r6("elapsed_seconds").alias("elapsed_seconds"),
                    _r6("tweets_per_second").alias("tweets_per_second"))


@_register_spans("kpis")
def _kpis(spark, sf, span=SPAN_ALL):
    """The dashboard's metric row over the span, posts per second since the oldest event."""
    k = views.kpis(_span_counts_by_doc(spark, sf, span), newest_event(spark, sf), oldest_event(spark, sf), None,
                   weight="n")
    return k.select("total_tweets", _r6("avg_sentiment").alias("avg_sentiment"), "avg_text",
                    _r6("tweets_per_second").alias("tweets_per_second"), "tps_text", "positive", "negative")


@_register_spans("positive_negative")
def _positive_negative(spark, sf, span=SPAN_ALL):
    """Positive and negative counts over the span."""
    return views.positive_negative(_span_counts_by_doc(spark, sf, span), weight="n")


@_register_spans("distribution")
def _distribution(spark, sf, span=SPAN_ALL):
    """Count per band over the span."""
    return views.distribution(_span_counts_by_doc(spark, sf, span), weight="n")


@_register_spans("recent_posts")
def _recent_posts(spark, sf, span=SPAN_ALL):
    """V1: newest 50 posts of the span; texts joined after the top-k (a broadcast of 50 rows)."""
    top = views.recent_posts(scored_posts(spark, sf, "wide"), newest_event(spark, sf), span,
                             columns=["username", "sentiment_label", "polarity", "sentiment_score",
                                      "timestamp", "doc_id"])
    top = attach_text(spark, sf, top, bounded_rows=views.RECENT_POSTS_LIMIT)
    return top.select("id", "username", "text", "sentiment_label", "polarity",
                      "sentiment_score", "timestamp").orderBy(F.col("timestamp").desc(), F.col("id").desc())


@_register_spans("posts_in_span")
def _posts_in_span(spark, sf, span=SPAN_ALL):
    """V2: every post of the span with its text, newest first.  The span filter is
    pushed below the text join; the one sort runs on the joined rows."""
    rows = attach_text(spark, sf, scored_posts(spark, sf, "wide"))
    rows = views.posts_in_span(rows, newest_event(spark, sf), span,
                               columns=["username", "text", "sentiment_label", "polarity", "sentiment_score",
                                        "timestamp"])
    return rows.select("id", "username", "text", "sentiment_label", "polarity",
                       "sentiment_score", "timestamp")


@_register_spans("windowed_stats")
def _windowed_stats(spark, sf, span=SPAN_ALL):
    """Newest 30 window rows of the span (dashboard windows, wide bands)."""
    return views.windowed_stats(_windowed(spark, sf, "wide"), newest_event(spark, sf), span).select(
        "window_start", "window_end", "sentiment_label", "tweet_count",
        _r6("avg_sentiment").alias("avg_sentiment"))


@_register("latest_windows")
def _latest_windows(spark, sf):
    """Newest 10 window rows as printed (strict bands)."""
    return views.latest_windows(_windowed(spark, sf, "strict"))


@_register_spans("post_list")
def _post_list(spark, sf, span=SPAN_ALL):
    """First 30 posts of the span with headline and age."""
    now = newest_event(spark, sf)
    rows = views.posts_in_span(scored_posts(spark, sf, "wide"), now, span,
                               columns=["username", "sentiment_label", "sentiment_score", "timestamp"])
    return views.post_list(rows, now).select("id", "timestamp", "headline", "age")


@_register("previews")
def _previews(spark, sf):
    """Console card line, short time, polarity and score texts per post."""
    s = scored_posts(spark, sf, "strict")
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    # only the first 80 characters are shown: cut them per document, not per post
    heads = docs.select(F.col("doc_id").alias("_d"), F.substring("text", 1, 80).alias("_head"))
    s = s.join(heads, s["doc_id"] == heads["_d"], "left")
    return s.select("id", card_line(F.col("created_at"), F.col("username"), F.col("_head")).alias("card"),
                    short_time("created_at").alias("short_time"),
                    fixed("polarity", 4).alias("polarity_text"),
                    fixed("sentiment_score", 2).alias("score_text"),
                    display_label("sentiment_label").alias("display"))


@_register("post_age")
def _post_age(spark, sf):
    """age of each post relative to the newest event."""
    p = posts_view(spark, sf)
    now = newest_event(spark, sf)
    minutes, seconds = age_parts(F.col("timestamp"), now)
    return p.select("id", minutes.alias("age_minutes"), seconds.alias("age_seconds"),
                    age_text(F.col("timestamp"), now).alias("age"))


# ---------------------------------------------------------------- lines and ingest

def _posts_with_text(spark, sf, extra=(), packed=False):
    return posts_view(spark, sf, with_text=True, extra=extra, packed=packed)


@_register("to_lines")
def _to_lines(spark, sf):
    """S3: each post as one JSON line."""
    return to_lines(_posts_with_text(spark, sf), keep=["id"])


@_register("parse_posts")
def _parse_posts(spark, sf):
    """S2 (with S3): posts -> JSON lines -> parsed posts."""
    lines = to_lines(_posts_with_text(spark, sf))
    return parse_posts(lines)


def _api_raw(spark, sf, cap=None):
    lines = api_lines(_posts_with_text(spark, sf, extra=("event_type",), packed=True))
    return unwrap_envelope(lines, cap=cap, keep=["page"])


@_register("unwrap_envelope")
def _unwrap_envelope(spark, sf):
    """API response lines -> raw posts with their field-name variants."""
    raw = _api_raw(spark, sf)
    return raw.select("page", F.col("pos").cast("long").alias("pos"), "id", "tweet_id", "text", "full_text",
                      "username",
                      F.col("user.screen_name").alias("screen_name"), "created_at", "timestamp")


@_register("normalize_posts")
def _normalize_posts(spark, sf):
    """Clean-up of raw posts (drops rows without id)."""
    return ingest.normalize_posts(_api_raw(spark, sf))


@_register("rejected_posts")
def _rejected_posts(spark, sf):
    """The raw posts dropped for a missing id, kept as their own output."""
    raw = _api_raw(spark, sf).withColumn("pos", F.col("pos").cast("long"))
    return ingest.rejected_posts(raw, keep=["page", "pos"])


@_register("cap_posts")
def _cap_posts(spark, sf):
    """Only the first 5 posts of each response, capped before clean-up."""
    return ingest.normalize_posts(_api_raw(spark, sf, cap=5), keep=["page", "pos"]).select(
        "page", F.col("pos").cast("long").alias("pos"), "id", "username")


@_register("parse_event_time")
def _parse_event_time(spark, sf):
    """Event time from the API time texts (API form or ISO with Z)."""
    return ingest.normalize_posts(_api_raw(spark, sf)).select("id", "created_at", "timestamp")


def _polls(spark, sf, with_text=False):
    return overlapping_polls(spark, sf, with_text=with_text)


def _half_events(spark, sf) -> Column:
    return (event_count(spark, sf) / F.lit(2)).cast("long")


@_register("since_id")
def _since_id(spark, sf):
    """Polls after the mark (half the number of events), compared as numbers."""
    return ingest.since_id(_polls(spark, sf), _half_events(spark, sf)).select("id", "arrival")


@_register("high_water")
def _high_water(spark, sf):
    """I8: new mark = max(previous mark, largest id)."""
    mark = ingest.high_water(_polls(spark, sf), _half_events(spark, sf))
    return mark.select(F.col("hwm").cast("long").alias("hwm"))


@_register("catch_up")
def _catch_up(spark, sf):
    """Polls after a given id (a quarter of the events), no mark moved."""
    return ingest.catch_up(_polls(spark, sf), (event_count(spark, sf) / F.lit(4)).cast("long")).select(
        "id", "arrival")


def _with_text_head(spark, sf, df):
    # the dedup key reads the first 100 characters of the text; cut them per document
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    heads = docs.select(F.col("doc_id").alias("_d"), F.substring("text", 1, ingest.DEDUP_TEXT_CHARS).alias("text"))
    return df.join(heads, df["doc_id"] == heads["_d"], "left").drop("_d")


@_register("dedup_key")
def _dedup_key(spark, sf):
    """md5 key of id and text head per post."""
    p = _with_text_head(spark, sf, posts_view(spark, sf))
    return p.select("id", ingest.dedup_key("id", "text").alias("dedup_key"))


@_register("dedup_posts")
def _dedup_posts(spark, sf):
    """Overlapping polls back to the posts, first arrival kept."""
    polls = _with_text_head(spark, sf, _polls(spark, sf))
    d = ingest.dedup_posts(polls)
    return d.select("id", "created_at", "username", "timestamp", "arrival")


@_register("dedup_posts_ttl")
def _dedup_posts_ttl(spark, sf):
    """I11 with the one-hour memory: copies seen 1 minute, 50 minutes, 2 hours, and 50 and 110 minutes after the first."""
    posts = posts_view(spark, sf)
    copies = [("event_id % 10 = 0", 1), ("event_id % 10 = 1", 50), ("event_id % 10 IN (2, 4)", 120),
              ("event_id % 10 IN (3, 4)", 50), ("event_id % 10 IN (3, 4)", 110)]
    seen = posts.withColumn("seen", F.col("timestamp")).withColumn("arrival", F.lit(0).cast("long"))
    for k, (which, minutes) in enumerate(copies, 1):
        seen = seen.unionByName(posts.filter(which).withColumn("seen", F.col("timestamp") + F.expr(f"INTERVAL {minutes} minutes"))
                                .withColumn("arrival", F.lit(k).cast("long")))
    return ingest.dedup_posts(seen, key="id", ttl=ingest.DEDUP_TTL, seen="seen").select("id", "seen", "arrival")


@_register("dedup_posts_ttl_hot")
def _dedup_posts_ttl_hot(spark, sf):
    """I11 with the one-hour memory where a third of all posts share one key: about one post an hour of it is kept."""
    posts = posts_view(spark, sf).withColumn("arrival", F.col("event_id"))
    key = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("id"))
    return ingest.dedup_posts(posts, key=key, ttl=ingest.DEDUP_TTL).select("id", "timestamp")


@_register("late_report_burst")
def _late_report_burst(spark, sf):
    """T7 with nine tenths of the arrivals in a hundredth of the span, in blocks of 5,000 rows by quantiles."""
    polls = overlapping_polls(spark, sf, extra=("event_type",))
    polls = polls.withColumn("arrival", F.when(F.col("event_id") % 10 == 0, F.col("arrival") * 1000).otherwise(F.col("arrival")))
    return windows.late_report(polls, "30 seconds", feed="event_type", block_rows=5_000)


def _odd_ids(spark, sf):
    """Raw posts whose ids are 0, words, wider than 64 bits, missing, or plain numbers."""
    e = read_table(spark, sf, "events", "event_id")
    text = F.col("event_id").cast("string")
    kind = F.col("event_id") % 6
    return e.select(
        "event_id",
        F.when(kind == 0, "0").when(kind == 1, F.concat(F.lit("x"), text)).when(kind == 2, F.concat(F.lit("99999999999999999999"), text))
        .when(kind == 3, F.lit("")).when(kind == 4, F.lit(None).cast("string")).otherwise(text).alias("id"),
        F.when(kind == 0, F.concat(F.lit("7"), text)).when(kind == 3, "0").alias("tweet_id"))


@_register("odd_ids")
def _odd_ids_clean(spark, sf):
    """A zero id falls through to tweet_id; numbers wider than 64 bits pass the mark; the rest is told apart."""
    raw = _odd_ids(spark, sf)
    clean = ingest.normalize_posts(raw, keep=["event_id"])
    return ingest.since_id(clean, _half_events(spark, sf)).select("event_id", "id")


@_register("odd_ids_rejected")
def _odd_ids_rejected(spark, sf):
    """Rows without an id and rows whose id is no number, each with its reason."""
    return ingest.rejected_posts(_odd_ids(spark, sf), keep=["event_id"]).select("event_id", "reason")


@_register("odd_times")
def _odd_times(spark, sf):
    """Dated texts parse; a bare time, a bare year and a broken text stay null and their posts stay."""
    e = read_table(spark, sf, "events", "event_id", "ts")
    kind = F.col("event_id") % 5
    day = F.date_format("ts", "yyyy-MM-dd")
    created = (F.when(kind == 0, F.date_format("ts", "HH:mm:ss")).when(kind == 1, F.date_format("ts", "yyyy")).when(kind == 2, day)
               .when(kind == 3, F.concat(day, F.lit("T25:00:00Z"))).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    raw = e.select((F.col("event_id") + 1).cast("string").alias("id"), created.alias("created_at"))
    return ingest.normalize_posts(raw).select("id", "timestamp")


@_register("chunks_and_report_without_time")
def _chunks_without_time(spark, sf):
    """Posts without a time are chunked and counted in a null interval."""
    posts = posts_view(spark, sf).withColumn("timestamp", F.when(F.col("event_id") % 7 != 0, F.col("timestamp")))
    chunks = ingest.chunk_posts(posts).groupBy("chunk_start").agg(F.max("pos").alias("posts"), F.max("chunk").alias("last_chunk"))
    report = ingest.fetch_report(posts).select(F.col("interval_start").alias("_i"), F.col("posts").alias("reported"), "total_posts")
    return (chunks.join(report, F.col("chunk_start").eqNullSafe(F.col("_i")))
            .select("chunk_start", "posts", "last_chunk", "reported", "total_posts"))


@_register("shared_id_scores")
def _shared_id_scores(spark, sf):
    """Rows that share an id (or have none) keep their own text's score; missing texts are flagged."""
    from pulse.operators.scoring import score_texts
    from pulse.plans.inputs import fixture_lexicon

    docs = read_table(spark, sf, "documents", "doc_id", "text")
    rows = docs.select("doc_id", F.when(F.col("doc_id") % 5 != 0, F.floor(F.col("doc_id") / 2)).cast("string").alias("id"),
                       F.when(F.col("doc_id") % 11 != 0, F.col("text")).alias("text"))
    return score_texts(rows, fixture_lexicon(spark)).select("doc_id", "id", "polarity", "sentiment_label", "unscored")


@_register("unscored_posts")
def _unscored_posts(spark, sf):
    """posts whose document is missing are neutral and flagged, in rows and in band counts alike."""
    posts = posts_view(spark, sf).withColumn("doc_id", F.when(F.col("event_id") % 9 == 0, -1).otherwise(F.col("doc_id")))
    rows = attach_scores(posts, doc_scores(spark, sf, "wide").drop("hits", "polarity_sum"))
    return rows.groupBy("sentiment_label", "unscored").agg(F.count(F.lit(1)).alias("posts"))


def _search(spark, sf, lang, **how):
    docs = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    hits = ingest.search(docs, lang=lang, **how).select("doc_id")
    p = posts_view(spark, sf)
    # filter the documents once, then keep the posts showing a matching document
    return p.join(hits, "doc_id", "left_semi").select("id", "username", "timestamp", "doc_id")


@_register("search")
def _search_any(spark, sf):
    """The reference's terms, whole phrase and any case, any language, no reposts."""
    return _search(spark, sf, None)


@_register("search_en")
def _search_en(spark, sf):
    """I12 with the reference's language (English)."""
    return _search(spark, sf, "en")


@_register("search_phrase")
def _search_phrase(spark, sf):
    """I12 with terms that occur in the English documents, one of them of two words, and a repost prefix that occurs."""
    return _search(spark, sf, "en", terms=("of the", "Thatin"), repost_prefix="The ")


@_register("latest_n")
def _latest_n(spark, sf):
    """The newest 1000 posts."""
    return ingest.latest_n(posts_view(spark, sf), 1000).select("id", "timestamp")


@_register("recent")
def _recent(spark, sf):
    """The newest 50 posts, oldest first."""
    return ingest.recent(posts_view(spark, sf), 50).select("id", "timestamp")


@_register("chunk_posts")
def _chunk_posts(spark, sf):
    """Chunks of 5 consecutive posts within each hour."""
    return ingest.chunk_posts(posts_view(spark, sf)).select("id", "chunk_start", "pos", "chunk")


@_register("conversation_chunks")
def _conversation_chunks(spark, sf):
    """I15 on conversations: chunks of 5 consecutive turns within each conversation."""
    conv = read_table(spark, sf, "conversations", "conv_id", "turn", "role")
    out = ingest.chunk_rows(conv, 5, ["conv_id"], ["turn"], F.floor(F.col("turn") / F.lit(1000)))
    return out.select("conv_id", "turn", "role", "pos", "chunk")


@_register("conversation_previews")
def _conversation_previews(spark, sf):
    """F7 on conversations: 80-character preview of every turn, and its full length."""
    conv = read_table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    return conv.select("conv_id", "turn", "role", preview("text").alias("preview"),
                       F.length("text").cast("long").alias("n_chars"))


def _report(spark, sf):
    return ingest.fetch_report(posts_view(spark, sf), "1 hour")


@_register("fetch_report")
def _fetch_report(spark, sf):
    """I16: hourly posts, credits, running totals and held rows."""
    return _report(spark, sf).select("interval_start", "posts", "credits", "total_posts", "total_credits",
                                     "held")


@_register("low_volume_streaks")
def _low_volume_streaks(spark, sf):
    """Low-volume streaks and back-off level over the hourly report."""
    return ingest.low_volume_streaks(_report(spark, sf)).select("interval_start", "posts", "is_low", "streak",
                                                                "poll_seconds")
