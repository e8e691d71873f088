import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulse.functions import sentiment as S
from pulse.functions.text import age_text, card_line, clock, fixed, headline, preview, short_time
from pulse.functions.timeparse import parse_event_time

EDGES = [1.0, 0.51, 0.5, 0.21, 0.2, 0.01, 0.0, -0.01, -0.2, -0.21, -0.5, -0.51, -1.0, None]

STRICT = {1.0: ("VERY_POSITIVE", 1.0), 0.51: ("VERY_POSITIVE", 1.0), 0.5: ("POSITIVE", 0.5),
          0.21: ("POSITIVE", 0.5), 0.2: ("POSITIVE", 0.5), 0.01: ("POSITIVE", 0.5),
          0.0: ("NEUTRAL", 0.0), None: ("NEUTRAL", 0.0), -0.01: ("NEGATIVE", -0.5),
          -0.2: ("NEGATIVE", -0.5), -0.21: ("NEGATIVE", -0.5), -0.5: ("VERY_NEGATIVE", -1.0),
          -0.51: ("VERY_NEGATIVE", -1.0), -1.0: ("VERY_NEGATIVE", -1.0)}
WIDE = {1.0: ("VERY_POSITIVE", 1.0), 0.51: ("VERY_POSITIVE", 1.0), 0.5: ("POSITIVE", 0.6),
        0.21: ("POSITIVE", 0.6), 0.2: ("NEUTRAL", 0.0), 0.01: ("NEUTRAL", 0.0), 0.0: ("NEUTRAL", 0.0),
        None: ("NEUTRAL", 0.0), -0.01: ("NEUTRAL", 0.0), -0.2: ("NEGATIVE", -0.6),
        -0.21: ("NEGATIVE", -0.6), -0.5: ("VERY_NEGATIVE", -1.0), -0.51: ("VERY_NEGATIVE", -1.0),
        -1.0: ("VERY_NEGATIVE", -1.0)}


@pytest.mark.parametrize("rule,expected", [("strict", STRICT), ("wide", WIDE)])
def test_band_edges(spark, rule, expected):
    df = spark.createDataFrame([(p,) for p in EDGES], "p double")
    rows = df.select("p", S.label("p", rule).alias("l"), S.score("p", rule).alias("s")).collect()
    for r in rows:
        assert (r.l, r.s) == expected[r.p], (rule, r.p)


def test_emoji_and_display(spark):
    df = spark.createDataFrame([(l,) for l in S.LABELS + ["OTHER", None]], "l string")
    rows = {r.l: r for r in df.select("l", S.emoji("l", "faces").alias("f"), S.emoji("l", "dots").alias("d"),
                                      S.display_label("l").alias("t")).collect()}
    assert [rows[l].f for l in S.LABELS] == ["😍", "🙂", "😐", "😕", "😡"]
    assert [rows[l].d for l in S.LABELS] == ["🟢", "🟢", "🟡", "🔴", "🔴"]
    assert rows["OTHER"].d == "⚪" and rows[None].d == "⚪"
    assert rows["POSITIVE"].t == "🟢 POSITIVE" and rows["VERY_POSITIVE"].t == "🔴 VERY POSITIVE"


def test_text_formats(spark):
    long_text = "x" * 100
    df = spark.createDataFrame(
        [("2024-01-01T00:00:01.123456Z", "bob", long_text, 0.123456, -0.6),
         (None, None, None, None, 0.0), ("", "amy", "hi", 1.0, 1.0)],
        "created_at string, username string, text string, p double, s double")
    rows = df.select(preview("text").alias("pv"), short_time("created_at").alias("st"),
                     card_line("created_at", "username", "text").alias("card"),
                     fixed("p", 4).alias("p4"), fixed("s", 2).alias("s2"),
                     headline(F.lit("🟢"), F.col("username"), F.lit("POSITIVE"), F.col("s")).alias("h")).collect()
    assert rows[0].pv == "x" * 80 + "..."
    assert rows[0].st == "2024-01-01T00:00:01"
    assert rows[0].card == "[2024-01-01T00:00:01.123456Z] @bob: " + "x" * 80 + "..."
    assert rows[0].p4 == "0.1235" and rows[0].s2 == "-0.60"
    assert rows[0].h == "🟢 @bob - POSITIVE (Score: -0.60)"
    assert rows[1].pv == "..." and rows[1].st == "N/A" and rows[1].card == "[?] @?: ..."
    assert rows[2].pv == "hi..." and rows[2].st == "N/A"


def test_age_text(spark):
    now = dt.datetime(2024, 1, 1, 0, 10, 0)
    cases = [(dt.datetime(2024, 1, 1, 0, 6, 56), "3m 4s ago"), (dt.datetime(2024, 1, 1, 0, 9, 56), "4s ago"),
             (dt.datetime(2024, 1, 1, 0, 10, 0), "0s ago"),
             (dt.datetime(2024, 1, 1, 0, 10, 30, 500000), "29s ago")]  # 30.5 s in the future
    df = spark.createDataFrame([(t,) for t, _ in cases], "ts timestamp_ntz")
    got = [r.a for r in df.select(age_text(F.col("ts"), F.lit(now)).alias("a")).collect()]
    assert got == [e for _, e in cases]


def test_clock(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 5, 9),)], "ts timestamp_ntz")
    assert df.select(clock("ts").alias("c")).first().c == "13:05:09"


def test_parse_event_time(spark):
    texts = ["Wed Oct 10 20:19:24 +0000 2018", "2024-01-01T00:00:01Z", "2024-01-01T00:00:01.5+02:00",
             "2024-01-01 00:00:01", "garbage", None, "Wed Oct 10 20:19:24 +0200 2018"]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [r.t for r in df.select(parse_event_time("c").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2018, 10, 10, 20, 19, 24), dt.datetime(2024, 1, 1, 0, 0, 1),
                   dt.datetime(2023, 12, 31, 22, 0, 1, 500000), dt.datetime(2024, 1, 1, 0, 0, 1), None, None,
                   dt.datetime(2018, 10, 10, 18, 19, 24)]
    fb = df.select(parse_event_time("c", None, F.lit(dt.datetime(2000, 1, 1))).cast("timestamp_ntz").alias("t"))
    assert [r.t for r in fb.collect()][4:6] == [dt.datetime(2000, 1, 1)] * 2


def test_times_without_a_date_are_null(spark):
    from pulse.functions.timeparse import parse_event_time

    texts = ["12:30:00", "2018", "2018-03", "2018-03-04", "2018-03-04 05:06:07", "2018-03-04T05:06:07Z", "Wed Oct 10 20:19:24 +0000 2018", "x" * 70000, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.p for r in df.select("i", parse_event_time("t").alias("p")).collect()}
    assert [i for i in got if got[i] is not None] == [3, 4, 5, 6]
