"""DuckDB SQL for each registered query, written from the definitions, not from
the Spark plans.  Tables are the pre-registered views ``events``, ``documents``...

Conventions shared with ``pulse.plans.registry``: means rounded to 6 places;
polarity = sum / (100 * hits) in DOUBLE; window starts aligned to the epoch;
fixed-point texts follow Spark's formatter (half-up on the shortest decimal
form of the double).
"""

from __future__ import annotations

from pulse.plans.inputs import SPANS, TEST_LEXICON

SPAN_SQL = "INTERVAL '30 days'"
ASOF = "(SELECT max(ts) FROM events)"

_LEX = "lex(word, polarity_hundredths) AS (VALUES " + ", ".join(
    f"('{w}', {v})" for w, v in TEST_LEXICON) + ")"

_POSTS = """posts AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
         'user_' || CAST(user_id AS VARCHAR) AS username,
         ts AS "timestamp", event_id,
         event_id % (SELECT count(*) FROM documents) AS doc_id,
         event_type
  FROM events)"""

_DSCORE = """toks AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS token FROM documents),
dmatch AS (
  SELECT t.doc_id, count(*) AS hits, sum(l.polarity_hundredths) AS s
  FROM toks t JOIN lex l ON t.token = l.word GROUP BY t.doc_id),
dscore AS (
  SELECT d.doc_id, CAST(coalesce(m.hits, 0) AS BIGINT) AS hits,
         CAST(coalesce(m.s, 0) AS BIGINT) AS polarity_sum,
         CASE WHEN coalesce(m.hits, 0) > 0 THEN CAST(m.s AS DOUBLE) / CAST(100 * m.hits AS DOUBLE)
              ELSE 0.0 END AS polarity,
         d.text IS NULL AS unscored
  FROM documents d LEFT JOIN dmatch m ON d.doc_id = m.doc_id)"""

_POLLS = """polls AS (
  SELECT *, event_id AS arrival FROM posts
  UNION ALL
  SELECT *, event_id + 15 AS arrival FROM posts WHERE event_id % 10 = 0)"""


def band(p: str, rule: str) -> str:
    if rule == "strict":
        return (f"CASE WHEN {p} IS NULL THEN 'NEUTRAL' WHEN {p} > 0.5::DOUBLE THEN 'VERY_POSITIVE' "
                f"WHEN {p} > 0.0::DOUBLE THEN 'POSITIVE' WHEN {p} = 0.0::DOUBLE THEN 'NEUTRAL' "
                f"WHEN {p} > -0.5::DOUBLE THEN 'NEGATIVE' ELSE 'VERY_NEGATIVE' END")
    return (f"CASE WHEN {p} IS NULL THEN 'NEUTRAL' WHEN {p} > 0.5::DOUBLE THEN 'VERY_POSITIVE' "
            f"WHEN {p} > 0.2::DOUBLE THEN 'POSITIVE' WHEN {p} > -0.2::DOUBLE THEN 'NEUTRAL' "
            f"WHEN {p} > -0.5::DOUBLE THEN 'NEGATIVE' ELSE 'VERY_NEGATIVE' END")


def band_score(p: str, rule: str) -> str:
    if rule == "strict":
        return (f"CAST(CASE WHEN {p} IS NULL THEN 0.0 WHEN {p} > 0.5::DOUBLE THEN 1.0 "
                f"WHEN {p} > 0.0::DOUBLE THEN 0.5 WHEN {p} = 0.0::DOUBLE THEN 0.0 "
                f"WHEN {p} > -0.5::DOUBLE THEN -0.5 ELSE -1.0 END AS DOUBLE)")
    return (f"CAST(CASE WHEN {p} IS NULL THEN 0.0 WHEN {p} > 0.5::DOUBLE THEN 1.0 "
            f"WHEN {p} > 0.2::DOUBLE THEN 0.6 WHEN {p} > -0.2::DOUBLE THEN 0.0 "
            f"WHEN {p} > -0.5::DOUBLE THEN -0.6 ELSE -1.0 END AS DOUBLE)")


def fmt(x: str, d: int) -> str:
    """``%.{d}f`` as Spark prints it: round half-up the shortest decimal form."""
    return (f"(CASE WHEN {x} IS NULL THEN NULL ELSE (CASE WHEN {x} < 0 THEN '-' ELSE '' END) || "
            f"CAST(CAST(round(CAST(CAST(abs({x}) AS VARCHAR) AS DECIMAL(38,18)), {d}) AS DECIMAL(38,{d})) "
            f"AS VARCHAR) END)")


def r6(x: str) -> str:
    """Round to 6 places as Spark does for a double: half-up on its shortest
    decimal form (DuckDB's own round works on the binary value, so a tie such as
    -0.0640625 would go the other way); ``+ 0.0`` turns -0.0 into 0.0."""
    return f"(CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 6) AS DOUBLE) + 0.0)"


def _scored(rule: str) -> str:
    return f"""scored_{rule} AS (
  SELECT p.*, s.polarity, {band('s.polarity', rule)} AS sentiment_label,
         {band_score('s.polarity', rule)} AS sentiment_score
  FROM posts p LEFT JOIN dscore s ON p.doc_id = s.doc_id)"""


def _sliding(name: str, src: str, size_s: int, slide_s: int) -> str:
    return f"""{name} AS (
  SELECT x.*, time_bucket(to_seconds({slide_s}), x."timestamp", TIMESTAMP '1970-01-01 00:00:00')
              - to_seconds(r.k * {slide_s}) AS window_start,
         time_bucket(to_seconds({slide_s}), x."timestamp", TIMESTAMP '1970-01-01 00:00:00')
              - to_seconds(r.k * {slide_s}) + to_seconds({size_s}) AS window_end
  FROM {src} x CROSS JOIN (SELECT range AS k FROM range(0, {size_s // slide_s})) r
  WHERE x."timestamp" IS NOT NULL)"""


def _windowed(name: str, src: str, size_s: int, slide_s: int) -> str:
    return _sliding(f"{name}_rows", src, size_s, slide_s) + f""",
{name} AS (
  SELECT window_start, window_end, sentiment_label, count(*) AS tweet_count,
         avg(sentiment_score) AS avg_sentiment
  FROM {name}_rows GROUP BY window_start, window_end, sentiment_label)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_SCORE_CTES = (_LEX, _DSCORE)
_POST_CTES = (_LEX, _POSTS, _DSCORE)
_SPAN = f'"timestamp" >= {ASOF} - {SPAN_SQL}'
_AGE_US = f'(epoch_us({ASOF}) - epoch_us("timestamp"))'
_AGE_MIN = f"({_AGE_US} // 60000000)"
_AGE_SEC = f"(((({_AGE_US} % 60000000) + 60000000) % 60000000) // 1000000)"
_AGE_TEXT = (f"CASE WHEN {_AGE_MIN} > 0 THEN CAST({_AGE_MIN} AS VARCHAR) || 'm ' || CAST({_AGE_SEC} AS VARCHAR) "
             f"|| 's ago' ELSE CAST({_AGE_SEC} AS VARCHAR) || 's ago' END")

_FACE = ("CASE sentiment_label WHEN 'VERY_POSITIVE' THEN '😍' WHEN 'POSITIVE' THEN '🙂' WHEN 'NEUTRAL' THEN '😐' "
         "WHEN 'NEGATIVE' THEN '😕' WHEN 'VERY_NEGATIVE' THEN '😡' ELSE '😐' END")
_DISPLAY = ("CASE sentiment_label WHEN 'VERY_POSITIVE' THEN '🔴 VERY POSITIVE' WHEN 'POSITIVE' THEN '🟢 POSITIVE' "
            "WHEN 'NEUTRAL' THEN '⚪ NEUTRAL' WHEN 'NEGATIVE' THEN '🟡 NEGATIVE' "
            "WHEN 'VERY_NEGATIVE' THEN '🔴 VERY NEGATIVE' ELSE sentiment_label END")


def _dot(lbl: str) -> str:
    return (f"CASE {lbl} WHEN 'VERY_POSITIVE' THEN '🟢' WHEN 'POSITIVE' THEN '🟢' WHEN 'NEUTRAL' THEN '🟡' "
            f"WHEN 'NEGATIVE' THEN '🔴' WHEN 'VERY_NEGATIVE' THEN '🔴' ELSE '⚪' END")


_API_TIME = """strftime("timestamp", '%a %b %d %H:%M:%S +0000 %Y')"""
_ISO_TIME = """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%fZ')"""
_RAW = f"""raw AS (
  SELECT p.event_id // 20 AS page,
         row_number() OVER (PARTITION BY p.event_id // 20 ORDER BY p.event_id) - 1 AS pos,
         CASE p.event_type WHEN 'view' THEN p.id WHEN 'click' THEN NULL WHEN 'signup' THEN p.id
              WHEN 'purchase' THEN p.id ELSE '' END AS id,
         CASE p.event_type WHEN 'click' THEN p.id END AS tweet_id,
         CASE p.event_type WHEN 'click' THEN NULL WHEN 'signup' THEN '' ELSE d.text END AS text,
         CASE p.event_type WHEN 'click' THEN d.text WHEN 'signup' THEN d.text END AS full_text,
         CASE p.event_type WHEN 'click' THEN NULL WHEN 'signup' THEN '' ELSE p.username END AS username,
         CASE p.event_type WHEN 'click' THEN p.username WHEN 'signup' THEN p.username END AS screen_name,
         CASE p.event_type WHEN 'view' THEN {_API_TIME.replace('"timestamp"', 'p."timestamp"')}
              WHEN 'click' THEN {_API_TIME.replace('"timestamp"', 'p."timestamp"')}
              WHEN 'purchase' THEN {_ISO_TIME.replace('"timestamp"', 'p."timestamp"')} END AS created_at,
         CASE p.event_type WHEN 'signup' THEN {_ISO_TIME.replace('"timestamp"', 'p."timestamp"')} END
              AS "timestamp",
         p.event_type, p."timestamp" AS ts
  FROM posts p LEFT JOIN documents d ON p.doc_id = d.doc_id)"""
_CLEAN = """clean AS (
  SELECT page, pos, coalesce(nullif(id, ''), nullif(tweet_id, '')) AS id,
         coalesce(nullif(created_at, ''), nullif("timestamp", '')) AS created_at,
         coalesce(nullif(text, ''), full_text, '') AS text,
         coalesce(nullif(username, ''), screen_name, 'unknown') AS username,
         CASE WHEN event_type IN ('view', 'click') THEN date_trunc('second', ts) ELSE ts END AS "timestamp"
  FROM raw WHERE event_type IN ('view', 'click', 'signup', 'purchase'))"""

_REPORT = """report AS (
  SELECT time_bucket(INTERVAL '1 hour', "timestamp", TIMESTAMP '1970-01-01 00:00:00') AS interval_start,
         count(*) AS posts
  FROM posts WHERE "timestamp" IS NOT NULL GROUP BY 1),
report_run AS (
  SELECT interval_start, posts, posts * 15 AS credits,
         CAST(sum(posts) OVER (ORDER BY interval_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              AS BIGINT) AS total_posts
  FROM report)"""

_SEARCH_RE = "(^|[^a-z0-9])(ai|grok|elon musk)([^a-z0-9]|$)"


def _search_sql(lang: str | None) -> str:
    cond = f" AND d.lang = '{lang}'" if lang else ""
    return _with(_POSTS) + f"""SELECT p.id, p.username, p."timestamp", p.doc_id
FROM posts p JOIN documents d ON p.doc_id = d.doc_id
WHERE regexp_matches(lower(d.text), '{_SEARCH_RE}') AND NOT coalesce(starts_with(d.text, 'RT @'), false){cond}"""


ORACLE: dict[str, str] = {
    # ------------------------------------------------------------ scoring
    "polarity": _with(*_SCORE_CTES)
    + "SELECT doc_id, hits, polarity_sum, polarity, unscored FROM dscore",
    "label_strict": _with(*_SCORE_CTES)
    + f"SELECT doc_id, polarity, {band('polarity', 'strict')} AS sentiment_label, "
      f"{band_score('polarity', 'strict')} AS sentiment_score FROM dscore",
    "label_wide": _with(*_SCORE_CTES)
    + f"SELECT doc_id, polarity, {band('polarity', 'wide')} AS sentiment_label, "
      f"{band_score('polarity', 'wide')} AS sentiment_score FROM dscore",
    "emoji": _with(*_SCORE_CTES)
    + f"""SELECT doc_id, sentiment_label AS strict_label, {_FACE} AS face, {_DISPLAY} AS display,
       wide_label, {_dot('wide_label')} AS dot
FROM (SELECT doc_id, {band('polarity', 'strict')} AS sentiment_label, {band('polarity', 'wide')} AS wide_label
      FROM dscore)""",
    "plugin_scorer": _with(*_SCORE_CTES)
    + f"SELECT doc_id, polarity, {band('polarity', 'strict')} AS sentiment_label, "
      f"{band_score('polarity', 'strict')} AS sentiment_score, unscored FROM dscore",
    # ------------------------------------------------------------ windows
    "windowed_sentiment": _with(*_POST_CTES, _scored("strict"), _windowed("w", "scored_strict", 10, 5))
    + f"SELECT window_start, window_end, sentiment_label, tweet_count, {r6('avg_sentiment')} AS avg_sentiment "
      "FROM w",
    "windowed_sentiment_hourly": _with(*_POST_CTES, _scored("strict"), _windowed("w", "scored_strict", 3600, 1800))
    + f"SELECT window_start, window_end, sentiment_label, tweet_count, {r6('avg_sentiment')} AS avg_sentiment "
      "FROM w",
    "stream_windowed_sentiment": _with(*_POST_CTES, _scored("strict"), _windowed("w", "scored_strict", 10, 5))
    + f"SELECT window_start, window_end, sentiment_label, tweet_count, {r6('avg_sentiment')} AS avg_sentiment "
      "FROM w",
    "stream_scored_posts": _with(*_POST_CTES, _scored("strict"))
    + "SELECT id, polarity, sentiment_label, sentiment_score FROM scored_strict",
    "windowed_sentiment_panes": _with(*_POST_CTES, _scored("strict"), _windowed("w", "scored_strict", 3600, 600))
    + f"SELECT window_start, window_end, sentiment_label, tweet_count, {r6('avg_sentiment')} AS avg_sentiment "
      "FROM w",
    "window_samples": _with(*_POST_CTES, _scored("strict"), _sliding("wr", "scored_strict", 3600, 1800))
    + """SELECT s.window_start, s.window_end, s.sentiment_label, s.sample_rank, s.id, d.text
FROM (SELECT wr.*, row_number() OVER (PARTITION BY window_start, sentiment_label
                                      ORDER BY "timestamp" DESC, id DESC) AS sample_rank FROM wr) s
LEFT JOIN documents d ON s.doc_id = d.doc_id
WHERE s.sample_rank <= 3""",
    "trend": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT time_bucket(INTERVAL '10 seconds', "timestamp", TIMESTAMP '1970-01-01 00:00:00') AS bucket_start,
       {r6('avg(sentiment_score)')} AS avg_sentiment, count(*) AS tweet_count
FROM scored_wide WHERE "timestamp" IS NOT NULL GROUP BY 1""",
    "trend_hourly": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT time_bucket(INTERVAL '1 hour', "timestamp", TIMESTAMP '1970-01-01 00:00:00') AS bucket_start,
       {r6('avg(sentiment_score)')} AS avg_sentiment, count(*) AS tweet_count
FROM scored_wide WHERE "timestamp" IS NOT NULL GROUP BY 1""",
    "window_series": _with(*_POST_CTES, _scored("wide"), _windowed("w", "scored_wide", 10, 5))
    + "SELECT window_start, sentiment_label, tweet_count FROM w",
    "late_report": _with(_POSTS, _POLLS)
    + """, lat AS (
  SELECT event_type AS feed,
         max(epoch_us("timestamp")) OVER (PARTITION BY event_type ORDER BY arrival, id
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         - epoch_us("timestamp") AS late_us
  FROM polls)
SELECT feed, count(*) AS rows,
       count(*) FILTER (WHERE NOT coalesce(late_us > 30000000, false)) AS on_time,
       count(*) FILTER (WHERE coalesce(late_us > 30000000, false)) AS late,
       max(CASE WHEN late_us > 0 THEN late_us ELSE 0 END) / 1e6 AS max_lateness_seconds
FROM lat GROUP BY feed""",
    # ------------------------------------------------------------ views
    "overall_stats": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT sentiment_label, grouping(sentiment_label) = 1 AS is_total, count(*) AS tweet_count,
       {r6('avg(sentiment_score)')} AS avg_sentiment
FROM scored_wide WHERE {_SPAN} GROUP BY GROUPING SETS ((sentiment_label), ())""",
    "throughput": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT total_tweets, {r6('elapsed')} AS elapsed_seconds,
       {r6('CASE WHEN elapsed > 0 THEN total_tweets / elapsed ELSE 0.0 END')} AS tweets_per_second
FROM (SELECT count(*) AS total_tweets,
             (epoch_us({ASOF}) - epoch_us((SELECT min(ts) FROM events))) / 1e6 AS elapsed
      FROM scored_wide WHERE {_SPAN})""",
    "kpis": _with(*_POST_CTES, _scored("wide"))
    + f""", k AS (
  SELECT count(*) AS total_tweets, avg(sentiment_score) AS avg_sentiment,
         count(*) FILTER (WHERE sentiment_label IN ('POSITIVE', 'VERY_POSITIVE')) AS positive,
         count(*) FILTER (WHERE sentiment_label IN ('NEGATIVE', 'VERY_NEGATIVE')) AS negative,
         (epoch_us({ASOF}) - epoch_us((SELECT min(ts) FROM events))) / 1e6 AS elapsed
  FROM scored_wide WHERE {_SPAN}),
k2 AS (SELECT *, CASE WHEN elapsed > 0 THEN total_tweets / elapsed ELSE 0.0 END AS tps FROM k)
SELECT total_tweets, {r6('avg_sentiment')} AS avg_sentiment,
       {fmt('coalesce(avg_sentiment, 0.0)', 3)} AS avg_text,
       {r6('tps')} AS tweets_per_second, {fmt('tps', 1)} AS tps_text, positive, negative
FROM k2""",
    "positive_negative": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT count(*) FILTER (WHERE sentiment_label IN ('POSITIVE', 'VERY_POSITIVE')) AS positive,
       count(*) FILTER (WHERE sentiment_label IN ('NEGATIVE', 'VERY_NEGATIVE')) AS negative
FROM scored_wide WHERE {_SPAN}""",
    "distribution": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT sentiment_label, count(*) AS tweet_count FROM scored_wide
WHERE {_SPAN} AND sentiment_label IS NOT NULL GROUP BY sentiment_label""",
    "recent_posts": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT s.id, s.username, d.text, s.sentiment_label, s.polarity,
       s.sentiment_score, s."timestamp"
FROM scored_wide s LEFT JOIN documents d ON s.doc_id = d.doc_id
WHERE {_SPAN.replace('"timestamp"', 's."timestamp"')}
ORDER BY s."timestamp" DESC, s.id DESC LIMIT 50""",
    "posts_in_span": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT s.id, s.username, d.text, s.sentiment_label, s.polarity,
       s.sentiment_score, s."timestamp"
FROM scored_wide s LEFT JOIN documents d ON s.doc_id = d.doc_id
WHERE {_SPAN.replace('"timestamp"', 's."timestamp"')}""",
    "windowed_stats": _with(*_POST_CTES, _scored("wide"), _windowed("w", "scored_wide", 10, 5))
    + f"""SELECT window_start, window_end, sentiment_label, tweet_count, {r6('avg_sentiment')} AS avg_sentiment
FROM w WHERE window_start >= {ASOF} - {SPAN_SQL}
ORDER BY window_start DESC, sentiment_label ASC LIMIT 30""",
    "latest_windows": _with(*_POST_CTES, _scored("strict"), _windowed("w", "scored_strict", 10, 5))
    + f"""SELECT window_start, strftime(window_start, '%H:%M:%S') AS start_clock,
       strftime(window_end, '%H:%M:%S') AS end_clock, sentiment_label, tweet_count,
       {fmt('avg_sentiment', 3)} AS avg_text
FROM w ORDER BY window_start DESC, sentiment_label ASC LIMIT 10""",
    "post_list": _with(*_POST_CTES, _scored("wide"))
    + f"""SELECT id, "timestamp",
       {_dot('sentiment_label')} || ' @' || username || ' - ' || sentiment_label || ' (Score: '
         || {fmt('sentiment_score', 2)} || ')' AS headline,
       {_AGE_TEXT} AS age
FROM scored_wide WHERE {_SPAN} ORDER BY "timestamp" DESC, id DESC LIMIT 30""",
    "previews": _with(*_POST_CTES, _scored("strict"))
    + f"""SELECT s.id,
       '[' || coalesce(s.created_at, '?') || '] @' || coalesce(s.username, '?') || ': '
         || substring(coalesce(d.text, ''), 1, 80) || '...' AS card,
       coalesce(substring(nullif(s.created_at, ''), 1, 19), 'N/A') AS short_time,
       {fmt('s.polarity', 4)} AS polarity_text,
       {fmt('s.sentiment_score', 2)} AS score_text,
       {_DISPLAY.replace('sentiment_label', 's.sentiment_label')} AS display
FROM scored_strict s LEFT JOIN documents d ON s.doc_id = d.doc_id""",
    "post_age": _with(_POSTS)
    + f"""SELECT id, {_AGE_MIN} AS age_minutes, {_AGE_SEC} AS age_seconds, {_AGE_TEXT} AS age FROM posts""",
    # ------------------------------------------------------------ lines and ingest
    "to_lines": _with(_POSTS)
    + """SELECT p.id, CAST(to_json({'id': p.id, 'created_at': p.created_at, 'text': d.text,
                              'username': p.username, 'timestamp': CAST(p."timestamp" AS VARCHAR)}) AS VARCHAR)
       AS value
FROM posts p LEFT JOIN documents d ON p.doc_id = d.doc_id""",
    "parse_posts": _with(_POSTS)
    + """SELECT p.id, p.created_at, d.text, p.username, p."timestamp"
FROM posts p LEFT JOIN documents d ON p.doc_id = d.doc_id""",
    "unwrap_envelope": _with(_POSTS, _RAW)
    + """SELECT page, pos, id, tweet_id, text, full_text, username, screen_name, created_at, "timestamp" FROM raw""",
    "normalize_posts": _with(_POSTS, _RAW, _CLEAN)
    + """SELECT id, created_at, text, username, "timestamp" FROM clean""",
    "rejected_posts": _with(_POSTS, _RAW)
    + """SELECT page, pos, id, tweet_id, 'no_id' AS reason FROM raw
WHERE coalesce(nullif(id, ''), nullif(tweet_id, '')) IS NULL
   OR coalesce(nullif(id, ''), nullif(tweet_id, '')) = '0'""",
    "cap_posts": _with(_POSTS, _RAW, _CLEAN) + "SELECT page, pos, id, username FROM clean WHERE pos < 5",
    "parse_event_time": _with(_POSTS, _RAW, _CLEAN) + """SELECT id, created_at, "timestamp" FROM clean""",
    "since_id": _with(_POSTS, _POLLS)
    + "SELECT id, arrival FROM polls WHERE event_id > (SELECT count(*) // 2 FROM events)",
    "high_water": _with(_POSTS, _POLLS)
    + "SELECT greatest(max(event_id), (SELECT count(*) // 2 FROM events)) AS hwm FROM polls",
    "catch_up": _with(_POSTS, _POLLS)
    + "SELECT id, arrival FROM polls WHERE event_id > (SELECT count(*) // 4 FROM events)",
    "dedup_key": _with(_POSTS)
    + """SELECT p.id, md5(p.id || '_' || substring(coalesce(d.text, ''), 1, 100)) AS dedup_key
FROM posts p LEFT JOIN documents d ON p.doc_id = d.doc_id""",
    "dedup_posts": _with(_POSTS)
    + """SELECT id, created_at, username, "timestamp", event_id AS arrival FROM posts""",
    "search": _search_sql(None),
    "search_en": _search_sql("en"),
    "latest_n": _with(_POSTS)
    + """SELECT id, "timestamp" FROM posts ORDER BY "timestamp" DESC, id DESC LIMIT 1000""",
    "recent": _with(_POSTS)
    + """SELECT id, "timestamp" FROM posts ORDER BY "timestamp" DESC, id DESC LIMIT 50""",
    "chunk_posts": _with(_POSTS)
    + """SELECT id, chunk_start, pos, (pos - 1) // 5 AS chunk
FROM (SELECT id, time_bucket(INTERVAL '1 hour', "timestamp", TIMESTAMP '1970-01-01 00:00:00') AS chunk_start,
             row_number() OVER (PARTITION BY time_bucket(INTERVAL '1 hour', "timestamp",
                                                         TIMESTAMP '1970-01-01 00:00:00')
                                ORDER BY "timestamp", id) AS pos
      FROM posts WHERE "timestamp" IS NOT NULL)""",
    "conversation_chunks": """SELECT conv_id, turn, role, pos, (pos - 1) // 5 AS chunk
FROM (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos
      FROM conversations)""",
    "conversation_previews": """SELECT conv_id, turn, role, substring(coalesce(text, ''), 1, 80) || '...' AS preview,
       CAST(length(text) AS BIGINT) AS n_chars
FROM conversations""",
    "fetch_report": _with(_POSTS, _REPORT)
    + """SELECT interval_start, posts, credits, total_posts, total_posts * 15 AS total_credits,
       least(total_posts, 1000) AS held FROM report_run""",
    "low_volume_streaks": _with(_POSTS, _REPORT)
    + """, lows AS (
  SELECT interval_start, posts, posts < 10 AS is_low,
         sum(CASE WHEN posts < 10 THEN 1 ELSE 0 END) OVER (ORDER BY interval_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n_low
  FROM report),
marks AS (
  SELECT *, max(CASE WHEN NOT is_low THEN n_low END) OVER (ORDER BY interval_start
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS at_reset
  FROM lows)
SELECT interval_start, posts, is_low, CAST(n_low - coalesce(at_reset, 0) AS BIGINT) AS streak,
       CAST(CASE WHEN n_low - coalesce(at_reset, 0) > 0
                 THEN least(60.0, 5 * pow(2.0, (n_low - coalesce(at_reset, 0)) // 3)) ELSE 5 END AS BIGINT)
         AS poll_seconds
FROM marks""",
}


SPAN_QUERIES = ["overall_stats", "throughput", "kpis", "positive_negative", "distribution", "recent_posts", "posts_in_span",
                "windowed_stats", "post_list"]
for _name in SPAN_QUERIES:
    for _suffix, _span in SPANS.items():
        ORACLE[_name + _suffix] = ORACLE[_name].replace(SPAN_SQL, f"INTERVAL '{_span}'")

_QUARTER = "(SELECT count(*) FROM events) * {} // 4"
_LATE_SQL = ORACLE["late_report"]

ORACLE |= {
    "window_texts": _with(*_POST_CTES, _scored("strict"), _sliding("wr", "scored_strict", 3600, 1800))
    + """SELECT window_start, window_end, sentiment_label, wr.id, md5(d.text) AS text_md5
FROM wr LEFT JOIN documents d ON wr.doc_id = d.doc_id""",
    "late_report_null_feed": _LATE_SQL.replace("SELECT event_type AS feed,", "SELECT nullif(event_type, 'view') AS feed,")
    .replace("PARTITION BY event_type", "PARTITION BY nullif(event_type, 'view')"),
    "search_phrase": _search_sql("en").replace(_SEARCH_RE, "(^|[^a-z0-9])(of the|thatin)([^a-z0-9]|$)").replace("'RT @'", "'The '"),
    "dedup_posts_ttl": """WITH RECURSIVE copies AS (
  SELECT event_id, ts AS seen, 0 AS arrival FROM events
  UNION ALL SELECT event_id, ts + to_minutes(m), k FROM events JOIN (VALUES (0, 1, 1), (1, 50, 2), (2, 120, 3), (4, 120, 3),
    (3, 50, 4), (4, 50, 4), (3, 110, 5), (4, 110, 5)) AS c(r, m, k) ON event_id % 10 = r),
kept(event_id, seen, arrival) AS (
  SELECT event_id, seen, arrival FROM copies WHERE arrival = 0
  UNION ALL
  SELECT event_id, seen, arrival FROM (
    SELECT c.*, row_number() OVER (PARTITION BY c.event_id ORDER BY c.seen, c.arrival) AS r
    FROM kept JOIN copies c ON c.event_id = kept.event_id AND c.seen >= kept.seen + INTERVAL '1 hour') WHERE r = 1)
SELECT CAST(event_id AS VARCHAR) AS id, seen, CAST(arrival AS BIGINT) AS arrival FROM kept""",
    "dedup_posts_ttl_hot": """WITH RECURSIVE hot AS (SELECT event_id, ts FROM events WHERE event_id % 3 = 0),
kept(event_id, ts) AS (
  SELECT * FROM (SELECT event_id, ts FROM hot ORDER BY ts, event_id LIMIT 1)
  UNION ALL
  SELECT n.event_id, n.ts FROM (SELECT arg_min(h.event_id, (h.ts, h.event_id)) AS event_id, min(h.ts) AS ts
                                FROM kept k JOIN hot h ON h.ts >= k.ts + INTERVAL '1 hour') n WHERE n.ts IS NOT NULL)
SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp" FROM kept
UNION ALL SELECT CAST(event_id AS VARCHAR), ts FROM events WHERE event_id % 3 <> 0""",
    "late_report_burst": _LATE_SQL.replace("ORDER BY arrival", "ORDER BY CASE WHEN event_id % 10 = 0 THEN arrival * 1000 ELSE arrival END"),
    "odd_ids": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN '7' || event_id WHEN 2 THEN '99999999999999999999' || event_id
       ELSE CAST(event_id AS VARCHAR) END AS id FROM events
WHERE CASE event_id % 6 WHEN 0 THEN CAST('7' || event_id AS HUGEINT) WHEN 2 THEN CAST('99999999999999999999' || event_id AS HUGEINT)
      WHEN 5 THEN event_id END > (SELECT count(*) // 2 FROM events)""",
    "odd_ids_rejected": """SELECT event_id, CASE event_id % 6 WHEN 1 THEN 'bad_id' ELSE 'no_id' END AS reason FROM events
WHERE event_id % 6 IN (1, 3, 4)""",
    "odd_times": """SELECT CAST(event_id + 1 AS VARCHAR) AS id, CASE event_id % 5 WHEN 2 THEN date_trunc('day', ts) WHEN 4 THEN date_trunc('second', ts) END
       AS "timestamp" FROM events""",
    "chunks_and_report_without_time": """WITH p AS (SELECT CASE WHEN event_id % 7 <> 0 THEN time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01 00:00:00') END AS h
  FROM events), g AS (SELECT h, count(*) AS n FROM p GROUP BY h)
SELECT h AS chunk_start, n AS posts, (n - 1) // 5 AS last_chunk, n AS reported,
       CAST(sum(n) OVER (ORDER BY h NULLS FIRST) AS BIGINT) AS total_posts FROM g""",
    "shared_id_scores": _with(*_SCORE_CTES)
    + f"""SELECT doc_id, id, polarity, {band('polarity', 'strict')} AS sentiment_label, unscored
FROM (SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN CAST(doc_id // 2 AS VARCHAR) END AS id,
             CASE WHEN doc_id % 11 = 0 THEN 0.0 ELSE polarity END AS polarity, doc_id % 11 = 0 OR unscored AS unscored FROM dscore)""",
    "unscored_posts": _with(*_POST_CTES)
    + f"""SELECT sentiment_label, unscored, count(*) AS posts FROM (
  SELECT CASE WHEN event_id % 9 = 0 THEN 'NEUTRAL' ELSE {band('polarity', 'wide')} END AS sentiment_label,
         event_id % 9 = 0 OR unscored AS unscored FROM posts JOIN dscore USING (doc_id)) GROUP BY ALL""",
    "stream_since_id": f"""SELECT CAST(event_id AS VARCHAR) AS id, ts AS "timestamp" FROM events
WHERE (event_id >= {_QUARTER.format(1)} AND event_id < {_QUARTER.format(2)}) OR event_id >= {_QUARTER.format(3)}""",
    "stream_dedup": """SELECT CAST(event_id AS VARCHAR) AS id, 'user_' || user_id AS username, ts AS "timestamp" FROM events""",
    "stream_dedup_hour": _with(_POSTS)
    + """, span AS (SELECT date_trunc('day', min(ts) + (max(ts) - min(ts)) / 2) AS m, max(ts) AS top FROM events),
whole AS (SELECT p.event_id, p.id, username, "timestamp", coalesce(text, '') AS text, m, "timestamp" < top - INTERVAL '1 day' AS old
          FROM posts p LEFT JOIN documents d ON p.doc_id = d.doc_id, span),
kept AS (
  SELECT id, username, "timestamp", text FROM whole
  UNION ALL SELECT id, username, "timestamp" + INTERVAL '2 hours', text FROM whole WHERE event_id % 10 = 2 AND old
  UNION ALL SELECT id, username, "timestamp" + INTERVAL '5 minutes', 'edited ' || text FROM whole WHERE event_id % 10 = 3 AND old
  UNION ALL SELECT id, username, "timestamp" + INTERVAL '3 hours', text FROM whole
    WHERE event_id % 10 = 5 AND old AND "timestamp" >= m)
SELECT id, username, "timestamp", md5(text) AS text_md5 FROM kept""",
    "stream_restart": _with(*_POST_CTES, _scored("strict"), _windowed("w", "scored_strict", 3600, 3600))
    + f"""SELECT window_start, sentiment_label, tweet_count, {r6("avg_sentiment")} AS avg_sentiment FROM w""",
    "stream_append_late": _with(*_POST_CTES, _scored("strict"),
                                """mid AS (SELECT date_trunc('day', min(ts) + (max(ts) - min(ts)) / 2) AS m, max(ts) AS top FROM events),
later AS (SELECT s.* FROM scored_strict s, mid WHERE "timestamp" >= m)""", _windowed("w", "later", 3600, 3600))
    + f"""SELECT window_start, sentiment_label, tweet_count, {r6("avg_sentiment")} AS avg_sentiment FROM w, mid
WHERE window_end <= top - INTERVAL '1 hour'""",
}

_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[^a-z0-9]+'), lambda x: x <> '')"

ORACLE |= {
    "stream_window_samples": ORACLE["window_samples"],
    "stream_latest_n": ORACLE["latest_n"],
    "stream_recent": ORACLE["recent"],
    "store_kpis_5m": ORACLE["kpis_5m"],
    "store_kpis_7d": ORACLE["kpis_7d"],
    "store_overall_stats_7d": ORACLE["overall_stats_7d"],
    "store_distribution_5m": ORACLE["distribution_5m"],
    "store_recent_posts_7d": ORACLE["recent_posts_7d"],
    "stream_scored_once": ORACLE["stream_scored_posts"],
    "dashboard_windows_native": _with(*_POST_CTES, _scored("wide"), _windowed("w", "scored_wide", 10, 5))
    + f"""SELECT window_start, window_end, sentiment_label, tweet_count, {r6("avg_sentiment")} AS avg_sentiment FROM w""",
    "batch_scorer": ORACLE["plugin_scorer"],
    "windowed_sentiment_newest_first": ORACLE["windowed_sentiment"],
    "stream_rows_watermark": _with(_POSTS)
    + """SELECT p.id, "timestamp", CAST(length(text) AS BIGINT) AS n_chars FROM posts p LEFT JOIN documents d ON p.doc_id = d.doc_id""",
    "ingest_stamp": f"""SELECT CAST(event_id AS VARCHAR) AS id, {ASOF} AS fetched_at,
       CAST(floor(epoch_us({ASOF}) / 1e6) - floor(epoch_us(ts) / 1e6) AS BIGINT) AS seconds FROM events""",
    "term_matches": f"""WITH t AS (SELECT lang, {_TOKENS} AS t FROM documents),
terms AS (SELECT DISTINCT term FROM (SELECT t[3] AS term FROM t UNION ALL SELECT concat_ws(' ', t[4], t[5]) FROM t WHERE lang = 'fr') WHERE length(term) > 1)
SELECT doc_id, count(*) AS terms FROM documents, terms
WHERE regexp_matches(lower(text), '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY doc_id""",
    "search_terms": ORACLE["search_phrase"],
}
