"""Registered queries over what streams keep: window samples, the newest posts, the pane store, remembered scores; and searches
for many terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.operators import views
from pulse.operators.ingest import stamp_ingest
from pulse.operators.scoring import lexicon_frame, lexicon_scorer, score_placed_texts, with_batch_scorer
from pulse.operators.terms import search_terms, term_matches
from pulse.operators.windows import windowed_sentiment
from pulse.plans.inputs import TEST_LEXICON, newest_event, scored_posts
from pulse.plans.registry import (
    FILES_PER_BATCH, _drained, _files_of_quarter, _finish, _quarters, _r6, _register, _scoring, _stream_root, _windowed_out, _write_lines,
)
from pulse.sources.lines import parse_posts, read_lines
from pulse.sources.tables import posts_view, read_table
from pulse.streaming import (
    SpanStore, latest_stream, post_stream, read_complete, read_updates, sample_rows, score_batches_once, store_batches, trigger_options,
    window_samples_stream, write_updates,
)


def _once():
    return trigger_options(available_now=True)


@_register("stream_window_samples")
def _stream_window_samples(spark, sf):
    """A2 in a stream: the newest 3 texts of each 1 h / 30 min window x band.  The later half of the posts comes first and the
    newest quarter twice; state holds three times and ids a window.  Scored rows are stored without their texts, which lie in the
    lines and are read there for the samples alone."""
    root, name = _stream_root(spark, "stream_samples")
    q = _quarters(spark, sf)

    def start():
        yield _scoring(spark, root, name, ["id", "timestamp", "sentiment_label"])
        stored_rows = spark.readStream.schema(spark.read.parquet(f"{root}/scored").schema).parquet(f"{root}/scored")
        yield write_updates(window_samples_stream(stored_rows, "1 hour", "30 minutes", 3), f"{root}/samples", f"{name}_samples", _once(),
                            checkpoint=f"{root}/checkpoint-samples")

    _drained(spark, sf, root, [f"({q[2]}) OR ({q[3]})", f"({q[0]}) OR ({q[1]}) OR ({q[3]})"], start)
    samples = read_updates(spark, f"{root}/samples", ["window_start", "window_end", "sentiment_label"])
    return sample_rows(samples, parse_posts(read_lines(spark, f"{root}/lines", stream=False)), ["text"])


@_register("stream_latest_n")
def _stream_latest_n(spark, sf):
    """I13 in a stream: the newest 1000 posts, after late quarters and one that comes twice."""
    root, name = _stream_root(spark, "stream_latest")
    q = _quarters(spark, sf)
    _drained(spark, sf, root, [q[2], q[3], f"({q[0]}) OR ({q[3]})", q[1]], lambda: [latest_stream(
        post_stream(spark, f"{root}/lines"), f"{root}/held", name, 1000, trigger=_once(), checkpoint=f"{root}/checkpoint",
        placed=True)])
    return read_complete(spark, f"{root}/held").select("id", "timestamp")


@_register("stream_recent")
def _stream_recent(spark, sf):
    """I14 in a stream: the newest 50 posts of those held, oldest first."""
    root, name = _stream_root(spark, "stream_recent")
    q = _quarters(spark, sf)
    _drained(spark, sf, root, [f"({q[1]}) OR ({q[3]})", f"({q[0]}) OR ({q[2]})"], lambda: [latest_stream(
        post_stream(spark, f"{root}/lines"), f"{root}/held", name, 50, trigger=_once(), checkpoint=f"{root}/checkpoint",
        placed=True)])
    return read_complete(spark, f"{root}/held").select("id", "timestamp").orderBy("timestamp", "id")


def _store(spark, sf, name):
    """A store filled by a stream of all posts in two parts, the later one first, scored by the lexicon join (wide bands)."""
    root, query = _stream_root(spark, name)
    q = _quarters(spark, sf)
    lexicon = lexicon_frame(spark, TEST_LEXICON)
    _drained(spark, sf, root, [f"({q[2]}) OR ({q[3]})", f"({q[0]}) OR ({q[1]})"], lambda: [store_batches(
        post_stream(spark, f"{root}/lines", max_files_per_trigger=FILES_PER_BATCH), f"{root}/store", query, score=lambda batch: score_placed_texts(batch, lexicon, rule="wide", broadcast=True),
        trigger=_once(), checkpoint=f"{root}/checkpoint", placed=True)])
    return SpanStore(spark, f"{root}/store")


def _register_store(name, span):
    def deco(fn):
        def query(spark, sf):
            return fn(_store(spark, sf, name), span)
        query.__doc__ = fn.__doc__
        _register(name)(query)
        return fn
    return deco


@_register_store("store_kpis_5m", "5 minutes")
@_register_store("store_kpis_7d", "7 days")
def _store_kpis(store, span):
    """A4-A7/F9 over the store: panes of the span and the posts of the pane it cuts."""
    k = views.kpis(store.weights(span), store.as_of(), store.start(), None, weight="n")
    return k.select("total_tweets", _r6("avg_sentiment").alias("avg_sentiment"), "avg_text",
                    _r6("tweets_per_second").alias("tweets_per_second"), "tps_text", "positive", "negative")


@_register_store("store_overall_stats_7d", "7 days")
def _store_overall_stats(store, span):
    """A4/A5 over the store."""
    o = views.overall_stats(store.weights(span), None, None, weight="n")
    return o.select("sentiment_label", "is_total", "tweet_count", _r6("avg_sentiment").alias("avg_sentiment"))


@_register_store("store_distribution_5m", "5 minutes")
def _store_distribution(store, span):
    """A8 over the store."""
    return views.distribution(store.weights(span), weight="n")


@_register_store("store_recent_posts_7d", "7 days")
def _store_recent_posts(store, span):
    """V1 over the store: only the hours that hold the newest 50 posts are opened."""
    limit = views.RECENT_POSTS_LIMIT
    top = views.recent_posts(store.newest_rows(limit, span), store.as_of(), span,
                             columns=["username", "text", "sentiment_label", "polarity", "sentiment_score", "timestamp"])
    return top.select("id", "username", "text", "sentiment_label", "polarity", "sentiment_score", "timestamp")


@_register("stream_scored_once")
def _stream_scored_once(spark, sf):
    """F1, U2 in a stream: a batch model asked once for each different text, though every post's text comes about ten times and in
    every batch.  The rows equal ``stream_scored_posts``."""
    root, name = _stream_root(spark, "stream_once")
    _write_lines(spark, sf, root)

    def load():
        one = lexicon_scorer(TEST_LEXICON)
        return lambda texts: texts.map(one)

    posts = post_stream(spark, f"{root}/lines", max_files_per_trigger=_files_of_quarter(spark, sf))
    _finish(score_batches_once(posts, lambda new: with_batch_scorer(new, load), f"{root}/scored", f"{root}/memo", name, trigger=_once(),
                               checkpoint=f"{root}/checkpoint", placed=True))
    return spark.read.parquet(f"{root}/scored").select("id", "polarity", "sentiment_label", "sentiment_score")


@_register("dashboard_windows_native")
def _dashboard_windows_native(spark, sf):
    """The dashboard's two queries with the lexicon as scorer and a store for its views; its windows are those of
    ``dashboard`` bands."""
    from pulse.streaming import start_dashboard

    root, name = _stream_root(spark, "dashboard")
    _write_lines(spark, sf, root)
    for q in start_dashboard(spark, f"{root}/lines", lexicon_frame(spark, TEST_LEXICON), root, name=name, trigger=_once(), store=True,
                             max_files_per_trigger=FILES_PER_BATCH):
        _finish(q)
    out = read_updates(spark, f"{root}/windowed_aggregates", ["window_start", "window_end", "sentiment_label"])
    return out.select("window_start", "window_end", "sentiment_label", "tweet_count", _r6("avg_sentiment").alias("avg_sentiment"))


@_register("batch_scorer")
def _batch_scorer(spark, sf):
    """A model that takes whole batches of texts, loaded once in each worker."""
    def load():
        one = lexicon_scorer(TEST_LEXICON)
        return lambda texts: texts.map(one)
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    return with_batch_scorer(docs, load).select("doc_id", "polarity", "sentiment_label", "sentiment_score", "unscored")


@_register("windowed_sentiment_newest_first")
def _windowed_newest_first(spark, sf):
    """A1, A3: the windows in the order of the console, newest first."""
    return _windowed_out(windowed_sentiment(scored_posts(spark, sf, "strict"), order="desc"))


@_register("stream_rows_watermark")
def _stream_rows_watermark(spark, sf):
    """T5: stateless rows of a stream with a watermark are all kept, however late: the later half comes first."""
    from pulse.streaming import to_table

    root, name = _stream_root(spark, "stream_rows")
    q = _quarters(spark, sf)
    _drained(spark, sf, root, [f"({q[2]}) OR ({q[3]})", f"({q[0]}) OR ({q[1]})"], lambda: [to_table(
        post_stream(spark, f"{root}/lines", watermark="15 seconds").select("id", "timestamp", F.length("text").cast("long").alias("n_chars")),
        name, "append", _once(), checkpoint=f"{root}/checkpoint", fmt="parquet", path=f"{root}/out")])
    return spark.read.parquet(f"{root}/out")


@_register("ingest_stamp")
def _ingest_stamp(spark, sf):
    """Posts stamped with a time of ingest (here the newest event, so that the rows can be compared), and how long after their own."""
    rows = stamp_ingest(posts_view(spark, sf), now=newest_event(spark, sf).cast("timestamp"))
    seconds = F.unix_seconds("fetched_at") - F.unix_seconds(F.col("timestamp").cast("timestamp"))
    return rows.select("id", "fetched_at", seconds.alias("seconds"))


def _terms(spark, sf):
    """Terms that the documents themselves give: the third word of every document, and the fourth and fifth of the French ones."""
    docs = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    t = docs.select("lang", F.filter(F.split(F.lower("text"), "[^a-z0-9]+"), lambda x: x != "").alias("t"))
    one = t.select(F.get("t", F.lit(2)).alias("term"))
    two = t.filter("lang = 'fr'").select(F.concat_ws(" ", F.get("t", F.lit(3)), F.get("t", F.lit(4))).alias("term"))
    return one.unionByName(two).filter("length(term) > 1").distinct()


@_register("term_matches")
def _term_matches(spark, sf):
    """I12 for many terms: how many of the documents' own terms each document holds as whole phrases."""
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    return term_matches(docs, _terms(spark, sf)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("terms"))


@_register("search_terms")
def _search_terms(spark, sf):
    """I12 by a table of terms: the posts of ``search_phrase``."""
    docs = read_table(spark, sf, "documents", "doc_id", "text", "lang")
    terms = spark.sql("SELECT term FROM VALUES ('of the'), ('Thatin') AS t(term)")
    hits = search_terms(docs, terms, "en", key="doc_id", repost_prefix="The ").select("doc_id")
    return posts_view(spark, sf).join(hits, "doc_id", "left_semi").select("id", "username", "timestamp", "doc_id")
