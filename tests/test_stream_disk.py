"""What streams of whole texts keep on disk: compressed lines, batches that are not persisted, texts that stay where they lie."""

import glob
import os

from pyspark.sql import functions as F

from pulse.plans import QUERIES, registry
from pulse.plans.registry import _put_lines
from pulse.session import checkpoint_root
from pulse.streaming import (
    SpanStore, kept_posts, latest_stream, post_stream, read_complete, sample_rows, since_id_stream, store_batches, trigger_options,
)
from pulse.streaming.sinks import write_batches

ONCE = trigger_options(available_now=True)


def _lines(spark, rows, root):
    _put_lines(spark.createDataFrame([(r,) for r in rows], "value string"), root, 2)
    return f"{root}/lines"


def _post(i, text="t", minute=0):
    return f'{{"id": "{i}", "text": "{text}", "username": "u", "timestamp": "2024-01-01T00:{minute:02d}:00Z"}}'


def test_lines_are_compressed_and_whole(spark, scratch):
    rows = [_post(i, "long text " * 50) for i in range(9)]
    path = _lines(spark, rows, scratch)
    assert glob.glob(f"{path}/*.gz") and sorted(r.value for r in spark.read.text(path).collect()) == sorted(rows)
    assert all(spark.read.text(f).count() <= 2 for f in glob.glob(f"{path}/*.gz"))


def test_placed_batch_is_not_persisted(spark, scratch):
    path, seen = _lines(spark, [_post(i) for i in range(9)], scratch), []

    def fn(batch, batch_id):
        places = batch.select("id", F.monotonically_increasing_id().alias("place"))
        seen.append((batch.storageLevel.useMemory or batch.storageLevel.useDisk, sorted(map(tuple, places.collect())) == sorted(map(tuple, places.collect()))))
    write_batches(post_stream(spark, path), fn, "placed", trigger=ONCE, checkpoint=os.path.join(scratch, "c"), placed=True).awaitTermination()
    assert seen == [(False, True)]


def test_since_id_and_latest_of_placed_batches(spark, scratch):
    """An id that comes three times gives its least row, the others themselves; the newest posts are whole, one for each sent again."""
    rows = [_post(1, "b", 1), _post(1, "a", 1), _post(1, "c", 1), _post(2, "x", 2), _post(3, "y", 3)]
    path, out, held = _lines(spark, rows, scratch), os.path.join(scratch, "out"), os.path.join(scratch, "held")
    since_id_stream(post_stream(spark, path), out, os.path.join(scratch, "marks"), "placed_since", trigger=ONCE, checkpoint=os.path.join(scratch, "c1"),
                    placed=True).awaitTermination()
    assert sorted((r.id, r.text) for r in spark.read.parquet(out).collect()) == [("1", "a"), ("2", "x"), ("3", "y")]
    latest_stream(post_stream(spark, path), held, "placed_latest", 2, trigger=ONCE, checkpoint=os.path.join(scratch, "c2"), placed=True).awaitTermination()
    assert sorted((r.id, r.text) for r in read_complete(spark, held).collect()) == [("2", "x"), ("3", "y")]


def test_texts_of_samples_alone_are_grouped(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("id"), F.timestamp_seconds("id").alias("timestamp"), F.lit("t").alias("text"))
    samples = rows.filter("id < 3").select(F.col("timestamp").alias("window_start"), F.col("timestamp").alias("window_end"), F.lit("a").alias("sentiment_label"),
                                           F.array(F.struct(F.unix_micros("timestamp").alias("at"), "id")).alias("samples"))
    out = sample_rows(samples, rows, ["text"])
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.id, r.text) for r in out.collect()) == [("0", "t"), ("1", "t"), ("2", "t")]


def test_kept_columns_are_taken_before_the_join(spark, scratch):
    spark.createDataFrame([("r1", "k", "1", "text"), ("r2", "k", "2", None)], "row_id string, dedup_key string, id string, text string").write.parquet(f"{scratch}/posts")
    spark.createDataFrame([("r1",)], "row_id string").write.parquet(f"{scratch}/kept")
    assert kept_posts(spark, scratch).columns == ["id", "text"]
    out = kept_posts(spark, scratch, ["id", F.length("text").alias("n")])
    assert [tuple(r) for r in out.collect()] == [("1", 4)]


def test_store_shuffles_no_text(spark, scratch):
    """Rows by the hour hold no text; whole posts lie once beside them, and views of either size get each post its own text."""
    path, root = _lines(spark, [_post(i, f"text {i % 4}", i) for i in range(9)] + ['{"id": "none"}'], scratch), f"{scratch}/store"
    scored = post_stream(spark, path, max_files_per_trigger=2).withColumn("sentiment_label", F.lit("a")).withColumn("sentiment_score", F.lit(0.5))
    store_batches(scored, root, "narrow", trigger=ONCE, checkpoint=os.path.join(scratch, "c"), placed=True).awaitTermination()
    assert "text" not in spark.read.parquet(f"{root}/rows").columns and spark.read.parquet(f"{root}/posts").count() == 10
    store = SpanStore(spark, root)
    every = [(str(i), f"text {i % 4}", "u") for i in range(9)]
    assert sorted((r.id, r.text, r.username) for r in store.rows("1 hour").collect()) == every
    newest = store.newest_rows(3, "3 minutes")
    assert "Broadcast" in newest._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.text, r.username) for r in newest.collect()) == every[5:]


def test_many_parts_join_texts_once(spark, scratch, monkeypatch):
    """Three parts of a stream: every line is there, and no part joins the texts anew."""
    sf, plans, put = "/root/testdata/sf0.001", [], registry._put_lines

    def spy(lines, root):
        plans.append(lines._jdf.queryExecution().optimizedPlan().toString())
        put(lines, root)
    monkeypatch.setattr(registry, "_put_lines", spy)
    registry._drained(spark, sf, scratch, ["event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"], list)
    assert len(plans) == 3 and not [p for p in plans if "Join" in p]
    want = registry.to_lines(registry.posts_view(spark, sf, with_text=True))
    assert sorted(r.value for r in spark.read.text(f"{scratch}/lines").collect()) == sorted(r.value for r in want.collect())


def test_scored_samples_store_no_text(spark):
    """The scored rows of the samples hold no text; each sample has the text of its post all the same."""
    sf, there = "/root/testdata/sf0.001", f"{checkpoint_root(spark)}/registry/stream_samples-*"
    seen = set(glob.glob(there))
    got = QUERIES["stream_window_samples"](spark, sf).collect()
    root, = set(glob.glob(there)) - seen
    assert set(spark.read.parquet(f"{root}/scored").columns) == {"id", "timestamp", "sentiment_label", "batch"}
    text = {r.id: r.text for r in registry.posts_view(spark, sf, with_text=True).collect()}
    assert got and all(r.text == text[r.id] for r in got)
