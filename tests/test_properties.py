
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse.functions.timeparse import parse_event_time
from pulse.operators import windows
from pulse.plans import QUERIES
from tests.conftest import SF_SMALL

times = st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2090, 1, 1))


@settings(max_examples=5, deadline=None)
@given(st.lists(times, min_size=1, max_size=30))
def test_time_texts_round_trip(spark, values):
    values = [v.replace(microsecond=0) for v in values]
    rows = [(v.strftime("%a %b %d %H:%M:%S +0000 %Y"), v.strftime("%Y-%m-%dT%H:%M:%SZ"), v) for v in values]
    df = spark.createDataFrame(rows, "api string, iso string, want timestamp_ntz")
    got = df.select(parse_event_time("api").cast("timestamp_ntz").alias("a"),
                    parse_event_time("iso").cast("timestamp_ntz").alias("b"), "want").collect()
    assert all(r.a == r.want and r.b == r.want for r in got)


@settings(max_examples=5, deadline=None)
@given(st.lists(times, min_size=1, max_size=40), st.sampled_from([(10, 5), (60, 20), (3600, 1800)]))
def test_each_row_in_size_over_slide_windows(spark, values, shape):
    size, slide = shape
    df = spark.createDataFrame([(str(i), v, "NEUTRAL", 0.0) for i, v in enumerate(values)],
                               "id string, timestamp timestamp_ntz, sentiment_label string, sentiment_score double")
    w = windows.windowed_sentiment(df, f"{size} seconds", f"{slide} seconds", order=None)
    assert w.agg(F.sum("tweet_count")).first()[0] == len(values) * (size // slide)


def test_band_counts_sum_to_total(spark):
    rows = QUERIES["overall_stats"](spark, SF_SMALL).collect()
    total = [r.tweet_count for r in rows if r.is_total]
    assert len(total) == 1 and sum(r.tweet_count for r in rows if not r.is_total) == total[0]
    dist = QUERIES["distribution"](spark, SF_SMALL).collect()
    assert sum(r.tweet_count for r in dist) == total[0]
    pn = QUERIES["positive_negative"](spark, SF_SMALL).first()
    by_band = {r.sentiment_label: r.tweet_count for r in dist}
    assert pn.positive == by_band.get("POSITIVE", 0) + by_band.get("VERY_POSITIVE", 0)


def test_dedup_of_polls_gives_back_the_posts(spark):
    d = QUERIES["dedup_posts"](spark, SF_SMALL)
    assert d.count() == d.select("id").distinct().count() == 1000
    assert d.filter(F.col("arrival") != F.col("id").cast("long")).count() == 0
