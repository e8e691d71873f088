import datetime as dt
import json
import os

import pytest
import time

from pyspark.sql import functions as F

from pulse.operators.scoring import lexicon_frame, score_texts
from pulse.operators.windows import windowed_sentiment
from pulse.sources.lines import parse_posts, read_lines
from pulse.streaming import (
    dedup_stream, dedup_tables, kept_posts, post_stream, read_updates, score_batches, scored_stream, to_table, trigger_options,
    windowed_stream, write_updates,
)
from pulse.streaming.queries import output_mode

T0 = dt.datetime(2024, 1, 1)

LATE_BATCHES = [
    [{"id": "a", "text": "x", "timestamp": "2024-01-01T00:00:00Z"}],
    [{"id": "b", "text": "x", "timestamp": "2024-01-01T00:10:00Z"}],
    [{"id": "c", "text": "x", "timestamp": "2024-01-01T00:10:01Z"}],
    [{"id": "late", "text": "x", "timestamp": "2024-01-01T00:00:01Z"}],
    [{"id": "n", "text": "x", "timestamp": None}],
    [{"id": "z", "text": "x", "timestamp": "2024-01-01T00:20:00Z"}],
]


def write_batches(folder, batches, start=0):
    """One JSON-lines file per micro-batch, file times 10 s apart (the file source
    takes files in modification-time order)."""
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 10_000
    for i, rows in enumerate(batches, start=start):
        path = os.path.join(folder, f"batch-{i:03d}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(r) for r in rows) + "\n")
        os.utime(path, (base + 10 * i, base + 10 * i))


def _run(q):
    q.processAllAvailable()
    q.awaitTermination(60)
    return q


def _neutral(posts):
    return scored_stream(posts, lambda t: 0.0, rule="strict")


def _windows(spark, table):
    return sorted((r.window.start.replace(tzinfo=None), r.tweet_count)
                  for r in spark.sql(f"SELECT * FROM {table}").collect())


def test_late_rows_append_vs_complete(spark, scratch):
    src = os.path.join(scratch, "in")
    write_batches(src, LATE_BATCHES)
    once = trigger_options(available_now=True)

    posts = post_stream(spark, src, max_files_per_trigger=1)
    q1 = _run(to_table(windowed_stream(_neutral(posts), watermark="30 seconds"), "late_append",
                       output_mode("drop"), once, fmt="memory"))
    assert _windows(spark, "late_append") == [
        (T0 - dt.timedelta(seconds=5), 1), (T0, 1),
        (T0 + dt.timedelta(minutes=10, seconds=-5), 2), (T0 + dt.timedelta(minutes=10), 2)]
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q1.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 2

    posts = post_stream(spark, src, max_files_per_trigger=1)
    _run(to_table(windowed_stream(_neutral(posts), watermark="30 seconds"), "late_complete",
                  output_mode("keep"), once, fmt="memory"))
    assert _windows(spark, "late_complete") == [
        (T0 - dt.timedelta(seconds=5), 2), (T0, 2),
        (T0 + dt.timedelta(minutes=10, seconds=-5), 2), (T0 + dt.timedelta(minutes=10), 2),
        (T0 + dt.timedelta(minutes=20, seconds=-5), 1), (T0 + dt.timedelta(minutes=20), 1)]

    posts = post_stream(spark, src, max_files_per_trigger=1)
    _run(to_table(windowed_stream(_neutral(posts), watermark="30 seconds", order="desc"), "late_sorted",
                  output_mode("keep"), once, fmt="memory"))
    starts = [r.window.start for r in spark.sql("SELECT * FROM late_sorted").collect()]
    assert starts == sorted(starts, reverse=True) and len(starts) == 6

    posts = post_stream(spark, src, watermark="30 seconds", max_files_per_trigger=1)
    _run(to_table(_neutral(posts), "late_rows", "append", once, fmt="memory"))
    assert sorted(r.id for r in spark.sql("SELECT id FROM late_rows").collect()) == \
        ["a", "b", "c", "late", "n", "z"]


def test_dedup_stream(spark, scratch):
    src = os.path.join(scratch, "in")
    write_batches(src, [
        [{"id": "a", "text": "x", "timestamp": "2024-01-01T00:00:00Z"},
         {"id": "a", "text": "x", "timestamp": "2024-01-01T00:00:05Z"}],
        [{"id": "n", "text": "x", "timestamp": None}, {"id": "n", "text": "x", "timestamp": None},
         {"id": "a", "text": "x", "timestamp": "2024-01-01T00:00:20Z"}],
    ])
    posts = post_stream(spark, src, max_files_per_trigger=1)
    _run(to_table(dedup_stream(posts, key="id"), "dedup_out", "append", trigger_options(available_now=True),
                  fmt="memory"))
    assert sorted(r.id for r in spark.sql("SELECT id FROM dedup_out").collect()) == ["a", "n"]


def test_dedup_stream_keeps_late_posts_and_the_hour_of_each_key(spark, scratch):
    def post(i, time, n=None):
        return {"id": i, "text": "x", "timestamp": time and f"2024-01-01T{time}:00Z", "username": str(n)}

    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    batches = [
        [post("a", "12:50", 1), post("a", "12:00", 0), post("a", "13:00", 2), post("n", None, 0), post("n", None, 0)],
        [post("late", "05:00", 0), post("late", "05:10", 1), post("late", "09:00", 2), post("n", None, 1)],   # first seen 8 hours behind
        [post("late", "05:20", 3), post("a", "13:59", 3), post("a", "14:00", 4), post("b", "14:00", 0)],
    ]
    got = []
    for i, rows in enumerate(batches):
        write_batches(src, [rows], start=i)
        _run(to_table(dedup_stream(post_stream(spark, src)), "dedup_late", "append", trigger_options(available_now=True),
                      checkpoint=ckpt, fmt="parquet", path=out))
        got.append(spark.read.parquet(out).select("id", "username").collect())
    assert sorted(map(tuple, got[-1])) == [("a", "0"), ("a", "2"), ("a", "4"), ("b", "0"), ("late", "0"), ("late", "2"), ("n", "0")]


def test_dedup_tables_and_state_that_grows_with_the_batch(spark, scratch):
    """Whole posts come back; a batch writes the state of its own keys, however many are remembered."""
    src, root = os.path.join(scratch, "in"), os.path.join(scratch, "tables")
    hour = [{"id": f"k{i}", "text": f"text {i}", "timestamp": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z"} for i in range(600)]
    later = [{**hour[5], "timestamp": "2024-01-01T00:20:00Z"}, {**hour[6], "timestamp": "2024-01-01T01:00:06Z"},
             {"id": "new", "text": "y", "timestamp": None}, {"id": "k7", "text": None, "timestamp": "2024-01-01T00:00:07Z"}]
    written = []
    for i, rows in enumerate((hour, later)):
        write_batches(src, [rows], start=i)
        queries = dedup_tables(post_stream(spark, src), root, "tables", trigger=trigger_options(available_now=True))
        for q in queries:
            _run(q)
        written.append(max(op["numRowsUpdated"] for p in queries[1].recentProgress for op in p["stateOperators"]))
    got = kept_posts(spark, root).select("id", "text", "username").collect()
    assert sorted((r.id, r.text or "") for r in got) == sorted(
        [(r["id"], r["text"]) for r in hour] + [("k6", "text 6"), ("new", "y"), ("k7", "")])
    assert written[0] >= 600 and written[1] <= 3 * len(later)


def test_restart_from_checkpoint_no_duplicates(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    rows = [[{"id": str(i), "text": "x", "timestamp": f"2024-01-01T00:00:{i:02d}Z"}] for i in range(6)]
    write_batches(src, rows[:3])
    once = trigger_options(available_now=True)

    def start():
        posts = post_stream(spark, src, max_files_per_trigger=1)
        return to_table(posts, "rows_to_files", "append", once, checkpoint=ckpt, fmt="parquet", path=out)

    _run(start())
    write_batches(src, rows[3:], start=3)
    _run(start())
    ids = sorted(r.id for r in spark.read.parquet(out).collect())
    assert ids == [str(i) for i in range(6)]


def test_windowed_updates_carry_on_after_restart(spark, scratch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("in", "upd", "ckpt"))
    rows = [[{"id": str(i), "text": "x", "timestamp": f"2024-01-01T00:00:0{i}Z"}] for i in range(4)]
    write_batches(src, rows[:2])
    once = trigger_options(available_now=True)

    def start():
        posts = post_stream(spark, src, max_files_per_trigger=1)
        w = windowed_stream(_neutral(posts), watermark="1 hour").select(
            F.col("window.start").alias("window_start"), "sentiment_label", "tweet_count")
        return write_updates(w, out, "upd", once, checkpoint=ckpt)

    _run(start())
    write_batches(src, rows[2:], start=2)
    _run(start())
    got = sorted((r.window_start.replace(tzinfo=None), r.tweet_count)
                 for r in read_updates(spark, out, ["window_start", "sentiment_label"]).collect())
    assert got == [(T0 - dt.timedelta(seconds=5), 4), (T0, 4)]


def test_stream_equals_batch_and_lexicon_batches(spark, scratch):
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "scored")
    texts = ["good day", "bad bad day", "good and bad", "nothing", "good good good"]
    batches = [[{"id": str(i), "text": t, "timestamp": f"2024-01-01T00:00:{3 * i:02d}Z"}]
               for i, t in enumerate(texts)]
    write_batches(src, batches)
    lex = lexicon_frame(spark, [("good", 80), ("bad", -60)])
    once = trigger_options(available_now=True)
    posts = post_stream(spark, src, max_files_per_trigger=2)
    _run(score_batches(posts, lex, out, "lex_batches", trigger=once))
    streamed = spark.read.parquet(out)
    assert streamed.select("batch").distinct().count() == 3
    batch_lines = read_lines(spark, src, stream=False)
    batch_scored = score_texts(parse_posts(batch_lines), lex)
    key = ["id", "sentiment_label", "sentiment_score"]
    assert sorted(tuple(r) for r in streamed.select(*key).collect()) == \
        sorted(tuple(r) for r in batch_scored.select(*key).collect())
    # windows over the stored stream output equal windows over the batch rows
    w_stream = windowed_sentiment(streamed.withColumn("timestamp", F.col("timestamp")), order=None)
    w_batch = windowed_sentiment(batch_scored, order=None)
    assert sorted(tuple(r) for r in w_stream.collect()) == sorted(tuple(r) for r in w_batch.collect())


def test_dashboard_queries(spark, scratch):
    from pulse.operators import views
    from pulse.streaming import start_dashboard, stop_all
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    batches = [[{"id": str(i), "text": "good" if i % 2 else "bad", "username": f"u{i}",
                 "timestamp": f"2024-01-01T00:00:{2 * i:02d}Z"}] for i in range(8)]
    write_batches(src, batches)
    scorer = lambda t: 0.8 if t == "good" else -0.8
    for late, asked in (("drop", {"late": "drop"}), ("keep", {})):     # keeping late rows is the default
        target = os.path.join(out, late)
        qs = start_dashboard(spark, src, scorer, target, **asked, max_files_per_trigger=2,
                             trigger=trigger_options(available_now=True), name=f"dash_{late}")
        for q in qs:
            _run(q)
        stop_all(qs)
        rows = spark.read.parquet(f"{target}/raw_tweets")
        assert rows.count() == 8
        wins = (read_updates(spark, f"{target}/windowed_aggregates", ["window_start", "window_end", "sentiment_label"])
                if late == "keep" else spark.read.parquet(f"{target}/windowed_aggregates"))
        total = wins.agg(F.sum("tweet_count")).first()[0] or 0
        # append mode emits only windows the watermark (15 s behind 00:00:14) has passed
        assert total == (16 if late == "keep" else 0)
        stats = views.overall_stats(rows, dt.datetime(2024, 1, 1, 0, 0, 20)).collect()
        assert {(r.sentiment_label, r.tweet_count) for r in stats} == {
            ("VERY_POSITIVE", 4), ("VERY_NEGATIVE", 4), (None, 8)}


def test_console_and_empty_batches_skipped(spark, scratch):
    from pulse.streaming import console, write_batches as start_batches
    src = os.path.join(scratch, "in")
    write_batches(src, [[{"id": str(i), "text": "x", "timestamp": "2024-01-01T00:00:00Z"}] for i in range(3)])
    once = trigger_options(available_now=True)
    posts = post_stream(spark, src, max_files_per_trigger=1)
    _run(console(posts, "console_rows", mode="append", rows=5, trigger=once))
    seen = []
    only_two = post_stream(spark, src, max_files_per_trigger=1).filter(F.col("id") != "1")
    _run(start_batches(only_two, lambda df, bid: seen.append((bid, df.count())), "skip_empty", trigger=once))
    assert sorted(seen) == [(0, 1), (2, 1)]  # batch 1 had no rows and was skipped


def test_since_id_stream_moves_the_mark(spark, scratch):
    from pulse.streaming import since_id_stream
    src, out, marks = (os.path.join(scratch, d) for d in ("in", "out", "marks"))
    ids = [["5", "3", "9"], ["7", "10", "2", "10"], ["11", "x"], ["4"]]
    write_batches(src, [[{"id": i, "text": "t", "timestamp": "2024-01-01T00:00:00Z"} for i in b] for b in ids])
    posts = post_stream(spark, src, max_files_per_trigger=1)
    _run(since_id_stream(posts, out, marks, "since_id_stream", trigger=trigger_options(available_now=True)))
    got = sorted((r.batch, r.id) for r in spark.read.parquet(out).collect())
    assert got == [(0, "3"), (0, "5"), (0, "9"), (1, "10"), (2, "11")]
    assert spark.read.parquet(marks).agg(F.max("hwm")).first()[0] == 11


def test_late_row_right_after_the_advance_still_counts(spark, scratch):
    """Spark applies a new watermark from the batch after next: without batch 2 the
    late row comes one batch after the advance and is still counted."""
    src = os.path.join(scratch, "in")
    write_batches(src, [b for i, b in enumerate(LATE_BATCHES) if i != 2])
    posts = post_stream(spark, src, max_files_per_trigger=1)
    q = _run(to_table(windowed_stream(_neutral(posts), watermark="30 seconds"), "late_lag",
                      output_mode("drop"), trigger_options(available_now=True), fmt="memory"))
    assert _windows(spark, "late_lag") == [
        (T0 - dt.timedelta(seconds=5), 2), (T0, 2),
        (T0 + dt.timedelta(minutes=10, seconds=-5), 1), (T0 + dt.timedelta(minutes=10), 1)]
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0) for p in q.recentProgress
                  if p.get("stateOperators"))
    assert dropped == 0


def test_tables_need_a_format_and_a_path(spark, scratch):
    src = os.path.join(scratch, "in")
    write_batches(src, [[{"id": "1", "text": "x", "timestamp": "2024-01-01T00:00:00Z"}]])
    posts = post_stream(spark, src)
    with pytest.raises(ValueError, match="path"):
        to_table(posts, "no_path", fmt="parquet")
    with pytest.raises(TypeError):
        to_table(posts, "no_format")


def test_complete_tables_have_versions_and_readers_see_finished_ones(spark, scratch):
    from pulse.streaming import read_complete, write_complete

    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "complete")
    write_batches(src, [[{"id": str(i), "text": "x", "timestamp": f"2024-01-01T00:00:0{i}Z"}] for i in range(4)])
    w = windowed_stream(_neutral(post_stream(spark, src, max_files_per_trigger=1)), watermark=None).select(
        F.col("window.start").alias("window_start"), "tweet_count")
    _run(write_complete(w, out, "versions", trigger_options(available_now=True), checkpoint=os.path.join(scratch, "c")))
    assert sorted(d for d in os.listdir(out) if d.startswith("version=")) == ["version=2", "version=3"]
    os.makedirs(os.path.join(out, "version=9"))                       # a write that never finished
    assert sorted(r.tweet_count for r in read_complete(spark, out).collect()) == [4, 4]


def test_folds_replace_batches_under_a_reader(spark, scratch):
    from pulse.streaming import fold_updates

    out = os.path.join(scratch, "upd")

    def put(batch, rows):
        spark.createDataFrame(rows, "k string, v long").write.parquet(f"{out}/batch={batch}")

    def folders():
        return sorted(d for d in os.listdir(out) if "=" in d), sorted(os.listdir(f"{out}/_folds"))

    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("b", 2)], [("c", 3)]]):
        put(batch, rows)
    reader = read_updates(spark, out, ["k"])                          # has listed the batches
    fold_updates(spark, out, ["k"], 2)
    put(3, [("a", 4)])
    assert folders() == (["batch=0", "batch=1", "batch=2", "batch=3"], ["upto=2"])
    assert sorted(map(tuple, reader.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    want = [("a", 4), ("b", 2), ("c", 3)]
    assert sorted(map(tuple, read_updates(spark, out, ["k"]).collect())) == want
    os.makedirs(f"{out}/_folds/upto=3")                               # a fold that never finished
    assert sorted(map(tuple, read_updates(spark, out, ["k"]).collect())) == want
    fold_updates(spark, out, ["k"], 3)
    assert folders() == (["batch=3"], ["upto=2", "upto=3"])
    fold_updates(spark, out, ["k"], 3)                                # nothing new
    assert sorted(map(tuple, read_updates(spark, out, ["k"]).collect())) == want


def test_start_mark_is_written_once(spark, scratch):
    from pulse.streaming import since_id_stream

    src, out, marks, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "marks", "ckpt"))
    line = lambda i: [{"id": i, "text": "t", "timestamp": "2024-01-01T00:00:00Z"}]
    write_batches(src, [line("6"), line("99999999999999999999")])
    for start_mark in (5, 10 ** 30):                                 # the second call is a restart
        posts = post_stream(spark, src, max_files_per_trigger=1)
        _run(since_id_stream(posts, out, marks, "start_mark", start_mark=start_mark, trigger=trigger_options(available_now=True), checkpoint=ckpt))
        write_batches(src, [line("7"), line("100000000000000000000")], start=2)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["100000000000000000000", "6", "99999999999999999999"]
