import datetime as dt
import random

from pyspark.sql import functions as F

from pulse.operators import ingest
from pulse.operators.prefix import running

T0 = dt.datetime(2024, 1, 1)


def _posts(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, timestamp timestamp_ntz, arrival bigint")


def test_since_id_compares_numbers(spark):
    df = _posts(spark, [("9", "a", T0, 1), ("10", "b", T0, 2), ("100", "c", T0, 3), ("x", "d", T0, 4)])
    assert sorted(r.id for r in ingest.since_id(df, 9).collect()) == ["10", "100"]
    assert ingest.since_id(df, None).count() == 4
    assert ingest.high_water(df, 5).first().hwm == 100
    assert ingest.high_water(df, 500).first().hwm == 500
    assert sorted(r.id for r in ingest.catch_up(df, 10).collect()) == ["100"]


def test_dedup_first_arrival_and_idempotent(spark):
    rows = [("a", "t", T0, 5), ("a", "t", T0 + dt.timedelta(seconds=5), 1), ("b", "t", T0, 2),
            ("b", "u", T0, 3), ("c", None, None, 4), ("c", None, None, 6)]
    df = _posts(spark, rows)
    once = ingest.dedup_posts(df)
    got = sorted((r.id, r.text, r.arrival) for r in once.collect())
    assert got == [("a", "t", 1), ("b", "t", 2), ("b", "u", 3), ("c", None, 4)]
    twice = ingest.dedup_posts(once)
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_dedup_key_matches_python(spark):
    import hashlib
    df = _posts(spark, [("1", "é" * 150, T0, 1), ("2", None, T0, 2)])
    got = {r.id: r.k for r in df.select("id", ingest.dedup_key().alias("k")).collect()}
    assert got["1"] == hashlib.md5(("1_" + "é" * 100).encode()).hexdigest()
    assert got["2"] == hashlib.md5(b"2_").hexdigest()


def test_search(spark):
    df = spark.createDataFrame([
        ("1", "Grok is here", "en"), ("2", "about AI.", "en"), ("3", "RT @x: AI news", "en"),
        ("4", "said elon  musk", "en"), ("5", "Elon Musk!", "en"), ("6", "ai", "fr"), ("7", "gaiety", "en"),
        ("8", None, "en")], "id string, text string, lang string")
    assert sorted(r.id for r in ingest.search(df).collect()) == ["1", "2", "5"]
    assert sorted(r.id for r in ingest.search(df, lang=None).collect()) == ["1", "2", "5", "6"]


def test_latest_and_recent(spark):
    rows = [(str(i), "t", T0 + dt.timedelta(seconds=i), i) for i in range(20)]
    df = _posts(spark, rows)
    assert [r.id for r in ingest.latest_n(df, 3).collect()] == ["19", "18", "17"]
    assert [r.id for r in ingest.recent(df, 3).collect()] == ["17", "18", "19"]
    assert ingest.recent(df, 0).count() == 0


def test_running_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = [(rnd.choice("xyz"), i, rnd.randint(-50, 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "p string, o long, v long")
    for how in ("sum", "max", "count"):
        for inclusive in (True, False):
            out = running(df, "v", how, [F.col("o")], F.floor(F.col("o") / 37), partition=["p"],
                          inclusive=inclusive, out="r")
            got = {(r.p, r.o): r.r for r in out.collect()}
            for p in "xyz":
                seq = [(o, v) for q, o, v in rows if q == p]
                acc = []
                for o, v in seq:
                    prev = acc if not inclusive else acc + [v]
                    if how == "sum":
                        exp = sum(prev)
                    elif how == "count":
                        exp = len(prev)
                    else:
                        exp = max(prev) if prev else None
                    assert got[(p, o)] == exp, (how, inclusive, p, o)
                    acc.append(v)


def test_chunks(spark):
    rows = [(str(i), "t", T0 + dt.timedelta(minutes=7 * i), i) for i in range(30)]
    out = ingest.chunk_posts(_posts(spark, rows)).collect()
    by_id = {r.id: r for r in out}
    # 60 / 7 -> hours hold 9 or 8 posts; chunk = (place - 1) div 5
    hours = {}
    for i in range(30):
        hours.setdefault((7 * i) // 60, []).append(str(i))
    for ids in hours.values():
        for place, pid in enumerate(ids, start=1):
            assert by_id[pid].pos == place and by_id[pid].chunk == (place - 1) // 5


def test_fetch_report_and_streaks(spark):
    counts = [12, 3, 4, 0, 5, 20, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 9, 10]
    rows, k = [], 0
    for h, n in enumerate(counts):
        for j in range(n):
            rows.append((str(k), "t", T0 + dt.timedelta(hours=h, seconds=j), k))
            k += 1
    rep = ingest.fetch_report(_posts(spark, rows), "1 hour")
    streaks = ingest.low_volume_streaks(rep).orderBy("interval_start").collect()
    present = [n for n in counts if n > 0]
    assert [r.posts for r in streaks] == present
    total, streak = 0, 0
    for r, n in zip(streaks, present):
        total += n
        streak = streak + 1 if n < 10 else 0
        assert r.total_posts == total and r.held == min(total, 1000) and r.credits == n * 15
        assert r.streak == streak
        assert r.poll_seconds == (min(60, 5 * 2 ** (streak // 3)) if streak else 5)


def test_rejects_and_stamp(spark):
    import json
    from pulse.sources.lines import unwrap_envelope
    lines = spark.createDataFrame([(json.dumps({"data": [{"id": "1"}, {"id": ""}, {"tweet_id": "0"}, {}]}),)],
                                  "value string")
    raw = unwrap_envelope(lines)
    assert sorted(r.pos for r in ingest.rejected_posts(raw, keep=["pos"]).collect()) == [1, 2, 3]
    stamped = ingest.stamp_ingest(raw, now=T0).select("fetched_at").distinct().collect()
    assert [r.fetched_at for r in stamped] == [T0]


def test_chunk_rows_hot_key(spark):
    rows = [("hot", t) for t in range(900)] + [(f"c{i % 50}", i) for i in range(1800)]
    df = spark.createDataFrame(rows, "k string, turn long")
    out = ingest.chunk_rows(df, 5, ["k"], ["turn"], F.floor(F.col("turn") / F.lit(37)))
    got = {(r.k, r.turn): (r.pos, r.chunk) for r in out.collect()}
    by_key = {}
    for k, t in rows:
        by_key.setdefault(k, []).append(t)
    for k, turns in by_key.items():
        for place, t in enumerate(sorted(turns), start=1):
            assert got[(k, t)] == (place, (place - 1) // 5)


def test_ids_fall_through_field_by_field(spark):
    df = spark.createDataFrame([("0", "77"), ("", "0"), (None, "5"), ("x9", None), ("99999999999999999999", None), ("1.5", None), ("0", None)],
                               "id string, tweet_id string")
    assert [r.id for r in ingest.normalize_posts(df).collect()] == ["77", "5", "x9", "99999999999999999999", "1.5"]
    assert sorted((r.reason, r.id) for r in ingest.rejected_posts(df).collect()) == [
        ("bad_id", "1.5"), ("bad_id", "x9"), ("no_id", ""), ("no_id", "0")]
    posts = ingest.normalize_posts(df)
    assert [r.id for r in ingest.since_id(posts, 70).collect()] == ["77", "99999999999999999999"]
    assert ingest.high_water(posts).first().hwm == 99999999999999999999


def test_null_keys_carry_over_blocks(spark):
    df = spark.createDataFrame([(None if i % 2 else "a", i) for i in range(12)], "k string, turn long")
    rows = ingest.chunk_rows(df, 2, ["k"], ["turn"], F.floor(F.col("turn") / F.lit(4))).orderBy("turn").collect()
    assert [(r.k, r.pos, r.chunk) for r in rows if r.k is None] == [(None, p, (p - 1) // 2) for p in range(1, 7)]
    assert [r.pos for r in rows if r.k == "a"] == list(range(1, 7))


def test_dedup_ttl_counts_from_the_last_kept_copy(spark):
    import datetime as dt
    import random

    rnd, t0 = random.Random(3), dt.datetime(2024, 1, 1)
    rows = [(f"k{i % 4}" if i % 9 else None, t0 + dt.timedelta(minutes=rnd.randrange(0, 900)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, timestamp timestamp, arrival long")
    want, last = [], {}
    for k, at, i in sorted(rows, key=lambda r: (r[1], r[2])):
        if k not in last or at - last[k] >= dt.timedelta(hours=1):
            last[k] = at
            want.append(i)
    got = ingest.dedup_posts(df, key="id", ttl="1 hour").collect()
    assert sorted(r.arrival for r in got) == sorted(want)
    assert ingest.dedup_posts(df, key="id").count() == 5 and ingest.dedup_posts(df.limit(0), key="id", ttl="1 hour").count() == 0
