import datetime as dt
import json

from pyspark.sql import functions as F

from pulse.operators.ingest import normalize_posts
from pulse.sources.lines import parse_posts, to_lines, unwrap_envelope
from tests.conftest import SF_SMALL


def _lines(spark, docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def test_envelope_keys(spark):
    lines = _lines(spark, [
        {"tweets": [{"id": "1"}]},                         # tweets only
        {"data": [{"id": "2"}]},                           # data only
        {"tweets": [{"id": "3"}], "data": [{"id": "x"}]},  # both: tweets wins
        {"tweets": None, "data": [{"id": "y"}]},           # tweets present but null: nothing
        {"tweets": [], "data": [{"id": "z"}]},             # tweets empty: nothing
        {"other": 1},                                      # neither key
        "not json", "",
    ])
    got = sorted(r.id for r in unwrap_envelope(lines).collect())
    assert got == ["1", "2", "3"]


def test_envelope_cap_before_cleanup(spark):
    posts = [{"id": ""}] + [{"id": str(i)} for i in range(1, 30)]
    lines = _lines(spark, [{"tweets": posts}])
    capped = unwrap_envelope(lines, cap=5)
    assert capped.count() == 5
    clean = normalize_posts(capped)
    assert sorted(r.id for r in clean.collect()) == ["1", "2", "3", "4"]


def test_normalize_variants(spark):
    posts = [
        {"id": 7, "text": "a", "username": "u7", "created_at": "Wed Oct 10 20:19:24 +0000 2018"},
        {"tweet_id": "8", "full_text": "b", "user": {"screen_name": "s8"}, "timestamp": "2024-01-01T00:00:01Z"},
        {"id": "", "tweet_id": "9", "text": "", "full_text": "c", "username": "", "user": {"screen_name": ""}},
        {"id": "10", "text": None, "user": None},
        {"id": "11", "text": "d"},
        {"id": 0, "text": "zero"},
        {"text": "no id"},
        {"id": "12", "created_at": "", "timestamp": "garbage"},
    ]
    lines = _lines(spark, [{"data": posts}])
    rows = {r.id: r for r in normalize_posts(unwrap_envelope(lines)).collect()}
    assert set(rows) == {"7", "8", "9", "10", "11", "12"}
    assert rows["7"].text == "a" and rows["7"].username == "u7"
    assert rows["7"].timestamp.replace(tzinfo=None) == dt.datetime(2018, 10, 10, 20, 19, 24)
    assert rows["8"].text == "b" and rows["8"].username == "s8" and rows["8"].created_at == "2024-01-01T00:00:01Z"
    assert rows["9"].text == "c" and rows["9"].username == ""
    assert rows["10"].text == "" and rows["10"].username == "unknown"
    assert rows["11"].username == "unknown"
    assert rows["12"].created_at == "garbage" and rows["12"].timestamp is None


def test_parse_post_lines(spark):
    lines = _lines(spark, [
        {"id": "1", "created_at": "c", "text": "t", "username": "u", "timestamp": "2024-01-01 00:00:01"},
        {"id": 2, "text": {"a": 1}, "timestamp": "2024-01-01T00:00:01Z"},
        {"id": "3", "timestamp": "bad"},
        "not json", "",
    ])
    rows = parse_posts(lines).collect()
    assert rows[0].id == "1" and rows[0].timestamp is not None
    assert rows[1].id == "2" and json.loads(rows[1].text) == {"a": 1}
    assert rows[2].id == "3" and rows[2].timestamp is None
    assert all(v is None for v in rows[3]) and all(v is None for v in rows[4])


def test_lines_round_trip(spark):
    df = spark.createDataFrame(
        [("1", "2024", 'he said "hi"\nbye', "u", dt.datetime(2024, 1, 1, 0, 0, 7, 179575)),
         ("2", None, None, None, None)],
        "id string, created_at string, text string, username string, timestamp timestamp_ntz")
    lines = to_lines(df)
    first = json.loads(lines.first().value)
    assert list(first) == ["id", "created_at", "text", "username", "timestamp"]
    assert first["timestamp"] == "2024-01-01 00:00:07.179575"
    back = parse_posts(lines).collect()
    assert back[0].text == 'he said "hi"\nbye'
    assert back[0].timestamp.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert back[1].id == "2" and back[1].text is None


def test_fallback_time_is_flagged(spark):
    lines = _lines(spark, [{"data": [{"id": "1", "created_at": "2024-01-01T00:00:01Z"},
                                     {"id": "2", "created_at": "garbage"}]}])
    fb = dt.datetime(2030, 1, 1)
    from pyspark.sql import functions as F
    rows = {r.id: r for r in normalize_posts(unwrap_envelope(lines), fallback_time=F.lit(fb)).collect()}
    assert rows["1"].time_fallback is False and rows["2"].time_fallback is True
    assert rows["2"].timestamp.replace(tzinfo=None) == fb


def test_reject_lines(spark):
    from pulse.sources.lines import reject_lines
    lines = _lines(spark, [{"id": "1"}, "not json", "", "{}", '{"id": 2', "[1, 2]"])
    bad = sorted(r.value for r in reject_lines(lines).collect())
    assert bad == sorted(["not json", "", '{"id": 2', "[1, 2]"])  # an array is not a post either


def test_packed_texts_make_the_same_pages(spark):
    """Texts that go to their page deflated: the same lines, whatever the text; the queries join them so and build JSON on the page."""
    from pulse.plans import QUERIES
    from pulse.plans.fixtures import api_lines
    from pulse.sources.tables import pack_text, posts_view

    texts = [None, "", "plain", "ünï \U0001f600  ", 'q"\\/\n\t\x00', "long " * 5000]
    kinds = ["view", "click", "signup", "purchase", "error"]
    rows = [(i, str(i), f"u{i}", texts[i % 6], kinds[i % 5]) for i in range(60)]
    posts = spark.createDataFrame(rows, "event_id long, id string, username string, text string, event_type string").withColumn(
        "timestamp", F.expr("timestamp_ntz'2024-01-01 00:00:00.000001' + make_dt_interval(0, 0, event_id)"))
    posts = posts.withColumn("text", F.when(F.col("event_id") == 7, F.expr("cast(x'61ff62' as string)")).otherwise(F.col("text")))   # no UTF-8
    raw = F.col("value").cast("binary").alias("value")
    want = api_lines(posts).select("page", raw).collect()
    got = api_lines(posts.withColumn("text", pack_text(F.col("text")))).select("page", raw).collect()
    assert len(want) == 3 and sorted(map(tuple, got)) == sorted(map(tuple, want))
    for name in ("unwrap_envelope", "rejected_posts"):
        above, below = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString().split("partial_collect_list", 1)
        assert "_inflated" in above and "_deflated" in below and "StructsToJson" not in below
    view = posts_view(spark, SF_SMALL, with_text=True, extra=("event_type",))
    small = api_lines(posts_view(spark, SF_SMALL, with_text=True, extra=("event_type",), packed=True))
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, api_lines(view).collect()))
