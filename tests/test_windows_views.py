import datetime as dt

from pyspark.sql import functions as F

from pulse.operators import views, windows

T0 = dt.datetime(2024, 1, 1)


def _scored(spark, rows):
    return spark.createDataFrame(
        rows, "id string, username string, timestamp timestamp_ntz, sentiment_label string, "
              "sentiment_score double, polarity double")


def test_each_row_in_size_over_slide_windows(spark):
    rows = [(str(i), "u", T0 + dt.timedelta(seconds=7 * i), "NEUTRAL", 0.0, 0.0) for i in range(50)]
    rows.append(("x", "u", None, "NEUTRAL", 0.0, 0.0))  # no time: skipped by windows
    w = windows.windowed_sentiment(_scored(spark, rows), order="asc")
    assert w.agg(F.sum("tweet_count")).first()[0] == 100
    first = w.first()
    # a post at 00:00:00 is in [23:59:55, 00:00:05) and [00:00:00, 00:00:10)
    assert first.window.start == T0 - dt.timedelta(seconds=5)


def test_window_at_seven_seconds(spark):
    df = _scored(spark, [("a", "u", T0 + dt.timedelta(seconds=7), "POSITIVE", 0.5, 0.1)])
    starts = sorted(r.window.start for r in windows.windowed_sentiment(df, order=None).collect())
    assert starts == [T0, T0 + dt.timedelta(seconds=5)]


def test_samples_are_bounded_and_newest(spark):
    rows = [(str(i), "u", T0 + dt.timedelta(seconds=i), "NEUTRAL", 0.0, 0.0) for i in range(40)]
    s = windows.window_samples(_scored(spark, rows), "1 minute", "1 minute", n=3)
    got = [(r.sample_rank, r.id) for r in s.orderBy("sample_rank").collect()]
    assert got == [(1, "39"), (2, "38"), (3, "37")]
    lists = windows.sample_lists(s.withColumn("text", F.concat(F.lit("t"), "id"))).first()
    assert lists.sample_tweets == ["t39", "t38", "t37"]


def test_trend_and_series(spark):
    rows = [("a", "u", T0 + dt.timedelta(seconds=1), "POSITIVE", 0.6, 0.3),
            ("b", "u", T0 + dt.timedelta(seconds=9), "NEGATIVE", -0.6, -0.3),
            ("c", "u", T0 + dt.timedelta(seconds=11), "POSITIVE", 0.6, 0.3),
            ("d", "u", None, "NEUTRAL", 0.0, 0.0)]
    t = {r.bucket_start: (r.avg_sentiment, r.tweet_count) for r in windows.trend(_scored(spark, rows)).collect()}
    assert t == {T0: (0.0, 2), T0 + dt.timedelta(seconds=10): (0.6, 1)}
    series = windows.window_series(windows.windowed_sentiment(_scored(spark, rows), order=None))
    assert series.columns == ["window_start", "sentiment_label", "tweet_count"]


def test_overall_stats_true_totals(spark):
    now = T0 + dt.timedelta(minutes=10)
    rows = [("a", "u", now - dt.timedelta(minutes=1), "POSITIVE", 0.6, 0.3),
            ("b", "u", now - dt.timedelta(minutes=2), "POSITIVE", 0.6, 0.3),
            ("c", "u", now - dt.timedelta(minutes=3), "NEGATIVE", -0.6, -0.3),
            ("d", "u", now - dt.timedelta(minutes=9), "NEGATIVE", -0.6, -0.3)]  # outside 5 minutes
    o = {(r.sentiment_label, r.is_total): (r.tweet_count, round(r.avg_sentiment, 9))
         for r in views.overall_stats(_scored(spark, rows), now).collect()}
    assert o[(None, True)] == (3, 0.2)
    assert o[("POSITIVE", False)] == (2, 0.6) and o[("NEGATIVE", False)] == (1, -0.6)
    pn = views.positive_negative(_scored(spark, rows), now).first()
    assert (pn.positive, pn.negative) == (2, 1)
    d = [(r.sentiment_label, r.tweet_count) for r in views.distribution(_scored(spark, rows), now).collect()]
    assert d == [("POSITIVE", 2), ("NEGATIVE", 1)]
    tp = views.throughput(_scored(spark, rows), now, now - dt.timedelta(seconds=60)).first()
    assert tp.total_tweets == 3 and tp.tweets_per_second == 3 / 60
    tp0 = views.throughput(_scored(spark, rows), now, now).first()
    assert tp0.tweets_per_second == 0.0


def test_recent_posts_and_post_list(spark):
    now = T0 + dt.timedelta(minutes=10)
    rows = [(str(i), f"u{i}", now - dt.timedelta(seconds=20 * i), "POSITIVE", 0.6, 0.3) for i in range(40)]
    r = views.recent_posts(_scored(spark, rows), now, limit=5).collect()
    assert [x.id for x in r] == ["0", "1", "2", "3", "4"]
    assert len(views.posts_in_span(_scored(spark, rows), now).collect()) == 16  # 0..300 s
    pl = views.post_list(_scored(spark, rows), now, n=30).collect()
    assert len(pl) == 30 and pl[0].headline == "🟢 @u0 - POSITIVE (Score: 0.60)" and pl[0].age == "0s ago"
    assert pl[4].age == "1m 20s ago"


def test_windowed_stats_and_latest(spark):
    rows = [(str(i), "u", T0 + dt.timedelta(seconds=3 * i), "NEUTRAL" if i % 2 else "POSITIVE",
             0.0 if i % 2 else 0.6, 0.0) for i in range(100)]
    w = windows.windowed_sentiment(_scored(spark, rows), order=None)
    now = T0 + dt.timedelta(seconds=300)
    ws = views.windowed_stats(w, now, "1 minute").collect()
    expected = set()
    for start in range(240, 300, 5):  # window starts inside the last minute
        for i in range(100):
            if start <= 3 * i < start + 10:
                expected.add((start, "NEUTRAL" if i % 2 else "POSITIVE"))
    assert len(ws) == len(expected) and ws[0].window_start >= ws[-1].window_start
    assert all(x.window_start >= now - dt.timedelta(minutes=1) for x in ws)
    lw = views.latest_windows(w).collect()
    assert len(lw) == 10 and lw[0].start_clock == "00:04:55" and lw[0].end_clock == "00:05:05"


def test_late_report_brute_force(spark):
    import random
    rnd = random.Random(3)
    rows = []
    for i in range(300):
        ts = T0 + dt.timedelta(seconds=10 * i + rnd.choice([0, 0, 0, -45, -120]))
        rows.append((str(i), rnd.choice("pq"), i, ts))
    df = spark.createDataFrame(rows, "id string, feed string, arrival long, timestamp timestamp_ntz")
    got = {r.feed: (r.rows, r.on_time, r.late) for r in windows.late_report(df, "30 seconds", block_size=17).collect()}
    for feed in "pq":
        seq = sorted([(a, i, ts) for i, f, a, ts in rows if f == feed])
        newest, late = None, 0
        for _, _, ts in seq:
            if newest is not None and (newest - ts).total_seconds() > 30:
                late += 1
            newest = ts if newest is None else max(newest, ts)
        assert got[feed] == (len(seq), len(seq) - late, late)


def test_weighted_views_equal_row_views(spark):
    now = T0 + dt.timedelta(minutes=10)
    groups = [("d1", "POSITIVE", 0.6, 3), ("d2", "NEGATIVE", -0.6, 2), ("d3", "VERY_POSITIVE", 1.0, 4),
              ("d4", "NEUTRAL", 0.0, 1)]
    weighted = spark.createDataFrame([(d, l, s, n) for d, l, s, n in groups],
                                     "doc_id string, sentiment_label string, sentiment_score double, n long")
    rows = _scored(spark, [(f"{d}-{i}", "u", now, l, s, 0.0) for d, l, s, n in groups for i in range(n)])

    def norm(df):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()),
                      key=str)
    assert norm(views.overall_stats(weighted, None, None, weight="n")) == norm(views.overall_stats(rows, now))
    assert norm(views.distribution(weighted, weight="n")) == norm(views.distribution(rows, now))
    assert norm(views.positive_negative(weighted, weight="n")) == norm(views.positive_negative(rows, now))
    start = now - dt.timedelta(seconds=20)
    k = views.kpis(weighted, now, start, None, weight="n").first()
    assert norm(views.kpis(weighted, now, start, None, weight="n")) == norm(views.kpis(rows, now, start))
    assert (k.total_tweets, k.positive, k.negative, k.tps_text) == (10, 7, 2, "0.5")
    assert k.avg_text == "0.460"


def test_windowed_with_samples(spark):
    rows = [(str(i), "u", T0 + dt.timedelta(seconds=i), "NEUTRAL", 0.0, 0.0) for i in range(6)]
    df = _scored(spark, rows).withColumn("text", F.concat(F.lit("t"), "id"))
    out = {r.window.start: (r.tweet_count, r.sample_tweets)
           for r in windows.windowed_with_samples(df, "10 seconds", "5 seconds", n=2).collect()}
    assert out[T0] == (6, ["t5", "t4"])
    assert out[T0 + dt.timedelta(seconds=5)] == (1, ["t5"])


def test_panes_equal_plain_windows(spark):
    import random
    rnd = random.Random(5)
    rows = [(str(i), "u", T0 + dt.timedelta(seconds=rnd.randint(0, 4000)), rnd.choice(["A", "B"]),
             rnd.choice([0.6, -0.6, 0.0, None]), 0.0) for i in range(600)]
    rows.append(("n", "u", None, "A", 0.6, 0.0))
    df = _scored(spark, rows)
    for size, slide in (("10 seconds", "5 seconds"), ("1 minute", "10 seconds"), ("1 hour", "5 minutes")):
        a = windows.windowed_sentiment(df, size, slide, order=None, panes=True)
        b = windows.windowed_sentiment(df, size, slide, order=None, panes=False)
        assert a.schema.simpleString() == b.schema.simpleString()

        def rows_of(x):
            return sorted((r.window.start, r.window.end, r.sentiment_label, r.tweet_count,
                           None if r.avg_sentiment is None else round(r.avg_sentiment, 9)) for r in x.collect())
        assert rows_of(a) == rows_of(b), (size, slide)


def test_pane_samples_equal_plain_samples(spark):
    import random
    rnd = random.Random(9)
    rows = [(str(i), "u", T0 + dt.timedelta(seconds=rnd.randint(0, 3000)), rnd.choice(["A", "B"]), 0.0, 0.0)
            for i in range(500)]
    df = _scored(spark, rows)
    for size, slide in (("1 minute", "10 seconds"), ("10 minutes", "1 minute")):
        a = windows.window_samples(df, size, slide, 3, panes=True)
        b = windows.window_samples(df, size, slide, 3, panes=False)

        def rows_of(x):
            return sorted((r.window.start, r.sentiment_label, r.sample_rank, r.id) for r in x.collect())
        assert rows_of(a) == rows_of(b)


def test_panes_need_a_multiple_of_the_slide(spark):
    import pytest

    from pulse.operators import window_samples, windowed_sentiment

    df = spark.createDataFrame([], "id string, timestamp timestamp, sentiment_label string, sentiment_score double")
    for fn in (windowed_sentiment, window_samples):
        with pytest.raises(ValueError, match="multiple"):
            fn(df, "10 seconds", "4 seconds", panes=True)


def test_all_texts_of_a_window_and_a_null_band_keeps_its_samples(spark):
    import datetime as dt

    from pulse.operators import window_texts, windowed_with_samples

    t0 = dt.datetime(2024, 1, 1)
    rows = [(str(i), t0 + dt.timedelta(seconds=1), None if i < 5 else "POSITIVE", 0.5, f"t{i}") for i in range(9)] + [("n", None, "POSITIVE", 0.5, "no time")]
    df = spark.createDataFrame(rows, "id string, timestamp timestamp, sentiment_label string, sentiment_score double, text string")
    texts = window_texts(df).collect()
    assert len(texts) == 18 and {r.text for r in texts} == {f"t{i}" for i in range(9)}
    out = windowed_with_samples(df).collect()
    assert {(r.sentiment_label, r.tweet_count, len(r.sample_tweets)) for r in out} == {(None, 5, 3), ("POSITIVE", 4, 3)}
