"""The physical plans the operators are meant to get, and results under a hot key."""

import datetime as dt

from pyspark.sql import functions as F

from pulse.operators import ingest, views, windows
from pulse.operators.scoring import attach_scores, lexicon_frame, lexicon_polarity
from pulse.plans.inputs import fixture_lexicon
from pulse.sources.tables import posts_view, read_table
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lexicon_scoring_is_broadcast_probe_and_partial_aggregate(spark):
    docs = read_table(spark, SF_SMALL, "documents", "doc_id", "text")
    p = plan(lexicon_polarity(docs, fixture_lexicon(spark)))
    assert "BroadcastHashJoin" in p and "partial_count" in p and "partial_sum" in p
    assert "struct<doc_id:bigint,text:string>" in p  # only the two columns are read


def test_dedup_is_an_aggregate_not_a_window(spark):
    polls = posts_view(spark, SF_SMALL).withColumn("arrival", F.col("event_id")).withColumn("text", F.lit("t"))
    p = plan(ingest.dedup_posts(polls))
    assert "Window" not in p and "partial_min_by" in p


def test_samples_limit_each_group_before_the_shuffle(spark):
    rows = spark.createDataFrame([(str(i), T0 + dt.timedelta(seconds=i), "NEUTRAL") for i in range(50)],
                                 "id string, timestamp timestamp_ntz, sentiment_label string")
    assert "WindowGroupLimit" in plan(windows.window_samples(rows, "1 minute", "1 minute", 3))


def test_top_k_and_pushed_time_bound(spark):
    posts = posts_view(spark, SF_SMALL)
    p = plan(views.recent_posts(posts.withColumn("sentiment_label", F.lit("NEUTRAL")),
                                as_of=dt.datetime(2024, 1, 30), span="1 day", columns=["id", "timestamp"]))
    assert "TakeOrderedAndProject" in p
    assert "GreaterThanOrEqual(ts," in p  # the span bound reached the parquet scan


def test_hot_keys_stay_correct(spark):
    """A third of all rows share one document, one window and one dedup key."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 3000
        posts = [(str(i), T0 + dt.timedelta(seconds=(0 if i % 3 == 0 else i)), 0 if i % 3 == 0 else i % 50,
                  "hot" if i % 3 == 0 else f"k{i}", i) for i in range(n)]
        df = spark.createDataFrame(posts, "id string, timestamp timestamp_ntz, doc_id long, key string, arrival long")
        docs = spark.createDataFrame([(d, "good" if d % 2 else "bad") for d in range(50)], "doc_id long, text string")
        lex = lexicon_frame(spark, [("good", 80), ("bad", -60)])
        scores = lexicon_polarity(docs, lex).withColumn("sentiment_label", F.lit("X")).withColumn(
            "sentiment_score", F.col("polarity"))
        scored = attach_scores(df, scores)
        got = {r.id: r.polarity for r in scored.collect()}
        assert len(got) == n
        assert all(got[str(i)] == (0.8 if (0 if i % 3 == 0 else i % 50) % 2 else -0.6) for i in range(n))
        w = windows.windowed_sentiment(scored, "10 seconds", "5 seconds", order=None)
        assert w.agg(F.sum("tweet_count")).first()[0] == 2 * n
        hot = w.filter(F.col("window.start") == F.lit(T0)).agg(F.sum("tweet_count")).first()[0]
        assert hot == sum(1 for i in range(n) if (0 if i % 3 == 0 else i) < 10)
        d = ingest.dedup_posts(df, key=F.col("key"))
        assert d.count() == n - (n // 3) + 1
        assert d.filter(F.col("key") == "hot").first().arrival == 0
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_recent_posts_shuffle_no_text_and_guards_count_plainly(spark):
    """Only the texts of the top rows leave the scan: a semi join on broadcast keys, no exchange below it."""
    import re

    from pulse.plans import QUERIES
    from tests.conftest import SF_SMALL

    df = QUERIES["recent_posts"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    for m in re.finditer(r"\(\d+\) (Exchange|ShuffleQueryStage)\nInput \[\d+\]: \[([^\]]*)\]", plan):
        assert "text#" not in m[2], m[0]
    assert "LeftSemi" in plan
