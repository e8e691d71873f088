"""Equal-depth blocks, TTL dedup by pointer doubling and searches for many terms, against plain Python."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from pulse.operators import ingest, windows
from pulse.operators.prefix import equal_depth, running
from pulse.operators.terms import search_terms, term_matches

T0 = dt.datetime(2024, 1, 1)


def test_blocks_of_a_burst(spark):
    """Nine tenths of the rows in a hundredth of the span, one feed with most of them: no block holds twice the rows asked for."""
    rnd = random.Random(5)
    rows = [("a" if i % 4 else rnd.choice(["b", None]), 50_000 + i // 90 if i % 10 else i * 100, i, rnd.randrange(1000)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "feed string, arrival long, id long, v long")
    blocks = equal_depth(df, ["arrival", "id"], ["feed"], 1000)
    sizes = [r["count"] for r in blocks.groupBy("_depth").count().collect()]
    assert max(sizes) < 2000 and sum(sizes) == len(rows)
    got = running(blocks, "v", "max", [F.col("arrival"), F.col("id")], "_depth", ["feed"], inclusive=False, out="m").select("id", "m").collect()
    want, newest = {}, {}
    for feed, _, i, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i] = newest.get(feed)
        newest[feed] = max(v, newest.get(feed, v))
    assert dict(map(tuple, got)) == want


def test_small_and_empty_tables_are_one_block(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id long, v long")
    assert [r._depth for r in equal_depth(df, ["id"]).collect()] == [0, 0]
    assert equal_depth(df.limit(0), ["id"]).count() == 0


@pytest.mark.parametrize("block_rows", [40, 10_000])
def test_chunks_and_late_rows_do_not_depend_on_blocks(spark, block_rows):
    rnd = random.Random(7)
    rows = [(str(i), None if i % 50 == 0 else T0 + dt.timedelta(seconds=rnd.randrange(60) if i % 3 else rnd.randrange(86400)), i // 3, rnd.choice("xy")) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, timestamp timestamp_ntz, arrival long, feed string")
    got = {(r.id, r.pos, r.chunk) for r in ingest.chunk_posts(df, block_rows=block_rows).collect()}
    place, want = {}, set()
    for i, t, _, _ in sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0, r[0])):
        h = t and t.replace(minute=0, second=0)
        place[h] = place.get(h, 0) + 1
        want.add((i, place[h], (place[h] - 1) // 5))
    assert got == want
    report = {r.feed: (r.rows, r.late) for r in windows.late_report(df, "30 seconds", block_rows=block_rows).collect()}
    for feed in "xy":
        newest, late, n = None, 0, 0
        for i, t, _, _ in sorted((r for r in rows if r[3] == feed), key=lambda r: (r[2], r[0])):
            n += 1
            late += bool(newest and t and (newest - t).total_seconds() > 30)
            newest = max(newest, t) if newest and t else newest or t
        assert report[feed] == (n, late)


def _kept(rows, ttl):
    out, last = [], {}
    for key, at, arrival, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or T0, r[2], r[3])):
        if key not in last or (at is not None and (last[key] is None or at - last[key] >= ttl)):
            last[key] = at
            out.append(i)
    return sorted(out)


def test_ttl_dedup_of_hourly_copies_takes_few_rounds(spark, monkeypatch):
    """A key with 1,000 hourly copies, one with a copy a minute, others with ties and without times."""
    rnd = random.Random(9)
    rows = [("hourly", T0 + dt.timedelta(hours=i), i, f"h{i}") for i in range(1000)]
    rows += [("often", T0 + dt.timedelta(minutes=i), i, f"o{i}") for i in range(600)]
    rows += [(rnd.choice(["x", "y", None]), rnd.choice([None, T0 + dt.timedelta(minutes=10 * rnd.randrange(60))]), rnd.randrange(3), f"r{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k string, seen timestamp_ntz, arrival long, id string")
    tables = []
    real = ingest.stored
    monkeypatch.setattr(ingest, "stored", lambda d, name: tables.append(name) or real(d, name))
    monkeypatch.setattr(ingest, "BLOCK_ROWS", 300)
    got = ingest.dedup_posts(df, key="k", ttl="1 hour", seen="seen")
    assert sorted(r.id for r in got.collect()) == _kept(rows, dt.timedelta(hours=1))
    assert tables.count("dedup-kept") <= 12
    assert got.columns == df.columns


def test_ttl_dedup_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id string, text string, timestamp timestamp, arrival long")
    assert ingest.dedup_posts(df, ttl="1 hour").count() == 0


def _holds(text, term):
    return text is not None and re.search("(^|[^a-z0-9])" + re.escape(term.lower()) + "([^a-z0-9]|$)", text.lower()) is not None


def test_terms_against_the_pattern(spark):
    texts = ["The AI of the year", "ai", "said aim", "of, the", "of the", None, "", "Elon Musk's AI", "ELON  MUSK", "x #ai!", "I \U0001f642 you", "c++ is c", "a.b a b",
             "\\E and \\Q", "über den", "the the the"]
    terms = ["AI", "of the", "Elon Musk", "#ai", "\U0001f642", "c++", "c", "a.b", "a b", "\\E", "the the", "über", "", None, "of", "!", "Ai"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = term_matches(rows, spark.createDataFrame([(t,) for t in terms], "term string"))
    want = {(i, t.lower()) for i, x in enumerate(texts) for t in terms if t and _holds(x, t)}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert term_matches(rows, spark.createDataFrame([], "term string")).count() == 0
    assert term_matches(rows.limit(0), spark.createDataFrame([("a",)], "term string")).count() == 0


def test_fifty_thousand_terms(spark):
    """As many terms as that: the plan has no pattern over them, and the posts are those of the pattern."""
    words = [f"w{i:05d}" for i in range(60_000)]
    rnd = random.Random(11)
    texts = [(i, " ".join(rnd.choices(words, k=20)), "en" if i % 2 else "de") for i in range(300)] + [(300, "RT @x w00001 w00002", "en")]
    rows = spark.createDataFrame(texts, "id long, text string, lang string")
    terms = words[:45_000:2] + [f"{a} {b}" for a, b in zip(words[:27_500], words[1:])]
    found = search_terms(rows, spark.createDataFrame([(t,) for t in terms], "term string"), "en")
    wanted = set(terms)
    want = [i for i, x, lang in texts if lang == "en" and not x.startswith("RT @")
            and (wanted & set(x.split()) or wanted & {f"{a} {b}" for a, b in zip(x.split(), x.split()[1:])})]
    assert sorted(r.id for r in found.collect()) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "w00002|" not in plan and len(plan) < 100_000


def test_plain_terms_look_at_no_text_again(spark):
    """Terms that begin and end with a token are found by n-grams alone, blanks and punctuation between the tokens included; where
    each text holds many of them, a pattern for each would be quadratic in its length."""
    texts = ["a-b c", "a b  c", "!a b, c.", "ab c", "a b", None, "x a-b"]
    terms = ["a b", "a-b", "b  c", "b, c", "a b, c", "c", "a-b c"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = term_matches(rows, spark.createDataFrame([(t,) for t in terms], "term string"))
    assert sorted(map(tuple, found.collect())) == sorted((i, t) for i, x in enumerate(texts) for t in terms if _holds(x, t))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "collect_set" not in plan
