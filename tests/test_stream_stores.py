"""Samples, newest posts, the pane store and remembered scores of a stream."""

import os

import pytest
from pyspark.sql import functions as F

from pulse.operators import views
from pulse.operators.scoring import with_batch_scorer
from pulse.operators.windows import window_samples
from pulse.streaming import (
    SpanStore, latest_stream, post_stream, read_complete, read_updates, sample_rows, score_batches_once, store_batches, trigger_options,
    window_samples_stream, write_updates,
)
from tests.test_streaming import _run, write_batches

ONCE = trigger_options(available_now=True)


def _posts(n, step=7, start=0):
    return [{"id": str(i), "text": f"text {i % 5}", "username": f"u{i % 3}",
             "timestamp": f"2024-01-{1 + (i * step) // 1440:02d}T{(i * step) // 60 % 24:02d}:{(i * step) % 60:02d}:{i % 60:02d}Z"} for i in range(start, start + n)]


def _banded(df):
    n = F.col("id").cast("int") % 3
    return df.withColumn("sentiment_label", F.when(n == 0, "POSITIVE").when(n == 1, "NEGATIVE")).withColumn("sentiment_score", F.when(n == 0, 0.6).otherwise(-0.6))


def test_window_samples_stream(spark, scratch):
    """Late rows, rows sent twice and rows without a band: as the batch operator over the different rows; state is n rows a window."""
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    rows = _posts(300)
    write_batches(src, [rows[150:], rows[:150] + rows[280:]])
    scored = _banded(post_stream(spark, src, max_files_per_trigger=1))
    q = write_updates(window_samples_stream(scored, "1 hour", "30 minutes", 2), out, "samples", ONCE, checkpoint=os.path.join(scratch, "c"))
    _run(q)
    got = sample_rows(read_updates(spark, out, ["window_start", "window_end", "sentiment_label"]), spark.read.json(src), ["text"])
    batch = _banded(spark.createDataFrame(rows).withColumn("timestamp", F.to_timestamp("timestamp")))
    want = window_samples(batch, "1 hour", "30 minutes", 2).select("window.start", "window.end", "sentiment_label", "sample_rank", "id", "text")
    key = lambda r: tuple(str(x) for x in r)      # noqa: E731
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))
    windows = batch.select(F.window("timestamp", "1 hour", "30 minutes").start.alias("s"), "sentiment_label").distinct().count()
    held = max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"])
    assert held <= 4 * windows                    # two rows a window, and the list's own counters


def test_window_samples_stream_evicts(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "c"))
    for i, rows in enumerate((_posts(40), _posts(5, start=2000), _posts(1, start=3))):
        write_batches(src, [rows], start=i)
        q = write_updates(window_samples_stream(_banded(post_stream(spark, src)), "1 hour", "1 hour", 2, watermark="1 hour"), out, "evicting", ONCE, checkpoint=ckpt)
        _run(q)
    assert sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress for op in p["stateOperators"]) == 1     # behind the watermark
    assert min(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]) <= 20                 # windows of the first rows are gone
    assert read_updates(spark, out, ["window_start", "window_end", "sentiment_label"]).filter("window_start < '2024-01-02'").count() > 0


def test_latest_stream(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "c"))
    rows = _posts(60)
    untimed = {"id": "x", "text": "t", "timestamp": None}
    for i, part in enumerate((rows[20:50] + [untimed], rows[:20], rows[40:50], rows[50:])):
        write_batches(src, [part], start=i)
        _run(latest_stream(post_stream(spark, src), out, "latest", 12, trigger=ONCE, checkpoint=ckpt))
    assert sorted((r.id for r in read_complete(spark, out).collect()), key=int) == [r["id"] for r in rows[-12:]]
    assert len([d for d in os.listdir(out) if d.startswith("version=")]) == 2


def test_store_reads_its_span_only(spark, scratch):
    """Ten days of posts: a five-minute view opens under a hundredth of the files, and views equal those over all rows."""
    src, root = os.path.join(scratch, "in"), os.path.join(scratch, "store")
    rows = _posts(2050) + [{"id": "9", "text": "no time", "timestamp": None}]
    write_batches(src, [rows[1000:], rows[:1000]])
    scored = _banded(post_stream(spark, src, max_files_per_trigger=1))
    _run(store_batches(scored, root, "store", trigger=ONCE, checkpoint=os.path.join(scratch, "c")))
    store = SpanStore(spark, root)
    every = _banded(spark.createDataFrame(rows).withColumn("timestamp", F.to_timestamp("timestamp")))
    for span in ("5 minutes", "3 hours", "7 days", "30 days"):
        got = views.kpis(store.weights(span), store.as_of(), store.start(), None, weight="n").first()
        want = views.kpis(every, store.as_of(), store.start(), span).first()
        assert got == want or [round(x, 9) if isinstance(x, float) else x for x in got] == [round(x, 9) if isinstance(x, float) else x for x in want]
        assert {r.id for r in store.rows(span).collect()} == {r.id for r in views.in_span(every, store.as_of(), span).collect()}
    files = len(spark.read.parquet(f"{root}/rows").inputFiles())
    assert len(set(store.weights("5 minutes").inputFiles())) <= 4 and files > 240
    assert len(store.newest_rows(20, "7 days").inputFiles()) < files / 20
    assert [r.id for r in views.recent_posts(store.newest_rows(20, "7 days"), store.as_of(), "7 days", 20, columns=["id"]).collect()] == \
        [r.id for r in views.recent_posts(every, store.as_of(), "7 days", 20, columns=["id"]).collect()]
    assert store.weights("5 minutes").agg(F.sum("n")).first()[0] == 1


def test_store_without_a_batch(spark, scratch):
    with pytest.raises(ValueError):
        SpanStore(spark, os.path.join(scratch, "none"))


def test_model_sees_each_text_once(spark, scratch):
    """Two drains of the same texts: the model is asked once for each different one; null texts and failures are remembered too."""
    src, out, memo, seen, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "memo", "seen", "c"))
    os.makedirs(seen)

    def load():
        import uuid

        def model(texts):
            if any(t == "text 4" for t in texts):
                raise ValueError("cannot")
            with open(os.path.join(seen, uuid.uuid4().hex), "w") as f:
                f.write("\n".join(texts))
            return texts.str.len() / 10.0
        return model

    rows = _posts(30) + [{"id": "null", "text": None, "timestamp": None}]
    for i, part in enumerate((rows, rows)):
        write_batches(src, [part], start=i)
        _run(score_batches_once(post_stream(spark, src), lambda new: with_batch_scorer(new, load), out, memo, "once", trigger=ONCE, checkpoint=ckpt))
    asked = [t for name in os.listdir(seen) for t in open(os.path.join(seen, name)).read().split("\n")]
    assert sorted(asked) == [f"text {i}" for i in range(4)]
    got = spark.read.parquet(out).groupBy("text").agg(F.count("*").alias("n"), F.max("polarity").alias("p"), F.max("unscored").alias("u")).collect()
    assert sorted(((r.text or "", r.n, r.p, r.u) for r in got)) == [("", 2, 0.0, True)] + [(f"text {i}", 12, 0.6 if i < 4 else 0.0, i == 4) for i in range(5)]


def test_dashboard_with_a_lexicon_a_model_and_a_function(spark, scratch):
    """The same windows whoever scores; with a store the views read panes."""
    from pulse.operators.scoring import lexicon_frame, lexicon_scorer
    from pulse.streaming import BatchModel, start_dashboard

    words = [("text", 80), ("4", -100)]
    src = os.path.join(scratch, "in")
    write_batches(src, [_posts(40), _posts(40, start=40) + [{"id": "n", "text": None, "timestamp": "2024-01-01T00:00:00Z"}]])

    def load():
        one = lexicon_scorer(words)
        return lambda texts: texts.map(one)

    got = []
    for k, (scorer, more) in enumerate([(lexicon_scorer(words), {}), (BatchModel(load), {}), (lexicon_frame(spark, words), {}),
                                        (lexicon_frame(spark, words), {"store": True})]):
        root = os.path.join(scratch, f"out{k}")
        for q in start_dashboard(spark, src, scorer, root, trigger=ONCE, name=f"dash{k}", **more):
            _run(q)
        out = read_updates(spark, f"{root}/windowed_aggregates", ["window_start", "window_end", "sentiment_label"])
        got.append(sorted((str(r.window_start), r.sentiment_label, r.tweet_count, round(r.avg_sentiment, 9)) for r in out.collect()))
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) > 80
    assert SpanStore(spark, os.path.join(scratch, "out3", "store")).weights("30 days").agg(F.sum("n")).first()[0] == 81
    with pytest.raises(ValueError):
        start_dashboard(spark, src, len, scratch, store=True)
