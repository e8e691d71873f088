"""Ingest: clean-up of raw API posts, id marks, dedup, search, newest-n, chunks and
the fetch report.  All are DataFrame -> DataFrame and run on any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions.timeparse import parse_event_time, time_text
from pulse.operators.prefix import BLOCK_ROWS, equal_depth, running
from pulse.session import stored

# --- fixed values (must equal the reference) ---------------------------------
UNKNOWN_USER = "unknown"
DEDUP_TEXT_CHARS = 100           # dedup key: md5 of "<id>_<first 100 chars of text>"
DEDUP_TTL = "1 hour"             # a key seen less than 3600 s ago is a repeat
LATEST_KEEP = 1000               # recent cache size (100 in the windowed script)
RECENT_LIMIT = 50
CHUNK_SIZE = 5
CREDITS_PER_POST = 15
HELD_MAX = 1000
LOW_VOLUME_THRESHOLD = 10        # fewer new posts than this counts as a low poll
POLL_MIN_SECONDS = 5
POLL_MAX_SECONDS = 60
LOW_POLLS_PER_STEP = 3           # interval doubles every 3 consecutive low polls
SEARCH_TERMS = ("AI", "Grok", "Elon Musk")
SEARCH_LANG = "en"
REPOST_PREFIX = "RT @"
ID_NUMBER = "decimal(38,0)"      # ids may be wider than 64 bits
# ------------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def post_id(raw: DataFrame) -> Column:
    """First of ``id`` / ``tweet_id`` that is not null, empty or ``0``.

    Each field is tested on its own, so an id of 0 falls through to ``tweet_id``.
    Ids are read from JSON as text, where the number 0 and the string ``"0"`` look
    the same; both count as missing (the reference kept the string)."""
    cols = [c for c in ("id", "tweet_id") if c in raw.columns]
    return F.coalesce(*[F.nullif(_blank_to_null(F.col(c)), F.lit("0")) for c in cols])


def normalize_posts(raw: DataFrame, fallback_time=None, keep: list[str] | None = None) -> DataFrame:
    """Raw API posts -> ``id, created_at, text, username, timestamp``.

    First non-empty of each field pair (the reference's Python ``or``): ``id`` /
    ``tweet_id``, ``text`` / ``full_text`` (else ``""``), ``username`` /
    ``user.screen_name`` (else ``unknown``), ``created_at`` / ``timestamp``.
    Rows without an id (null, ``""`` or ``0``) are dropped.  ``timestamp`` is the
    parsed event time, else ``fallback_time`` (the reference used the wall clock;
    with no fallback it stays null and the row is kept).  With a fallback, a
    ``time_fallback`` column flags the rows whose time is the fallback.
    """
    cols = set(raw.columns)

    def field(name):
        return F.col(name) if name in cols else F.lit(None).cast("string")

    screen_name = F.col("user.screen_name") if "user" in cols else F.lit(None).cast("string")
    created = time_text(field("created_at"), field("timestamp"))
    flag = [] if fallback_time is None else [
        parse_event_time(created).isNull().alias("time_fallback")]
    out = raw.select(
        *(keep or []),
        post_id(raw).alias("id"),
        created.alias("created_at"),
        F.coalesce(_blank_to_null(field("text")), field("full_text"), F.lit("")).alias("text"),
        F.coalesce(_blank_to_null(field("username")), screen_name, F.lit(UNKNOWN_USER)).alias("username"),
        parse_event_time(created, None, fallback_time).alias("timestamp"),
        *flag,
    )
    return out.filter(F.col("id").isNotNull())


def rejected_posts(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The raw posts that fall out later, with a ``reason``: ``no_id`` (id and
    tweet_id null, empty or 0: clean-up drops them) and ``bad_id`` (the id is no
    whole number of up to 38 digits: clean-up keeps them, id marks pass them over).
    The reference lost such rows silently (or the whole batch, on a bad id); here
    they are a table of their own."""
    ident = post_id(raw)
    reason = F.when(ident.isNull(), "no_id").when(numeric_id(ident).isNull(), "bad_id")
    return (raw.withColumn("_reason", reason).filter(F.col("_reason").isNotNull())
            .select(*(keep or []), *[c for c in ("id", "tweet_id") if c in raw.columns],
                    F.col("_reason").alias("reason")))


def stamp_ingest(df: DataFrame, column: str = "fetched_at", now=None) -> DataFrame:
    """Add the ingest time (``current_timestamp()`` unless ``now`` is given)."""
    t = F.current_timestamp() if now is None else (now if isinstance(now, Column) else F.lit(now))
    return df.withColumn(column, t)


def numeric_id(id_col="id") -> Column:
    """Post id as a whole number of up to 38 digits (ids compare as numbers: as
    text ``'9' > '10'``); null for any other text (``rejected_posts`` lists those)."""
    c = _col(id_col).cast("string")
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast(ID_NUMBER))


def since_id(posts: DataFrame, mark, id_col: str = "id") -> DataFrame:
    """Posts whose id is above the high-water mark ``mark`` (a number, a column or
    a scalar subquery), compared as numbers.  A null mark keeps everything."""
    m = mark if isinstance(mark, Column) else F.lit(mark)
    return posts.filter(m.isNull() | (numeric_id(id_col) > m.cast(ID_NUMBER)))


def high_water(posts: DataFrame, prev=None, id_col: str = "id") -> DataFrame:
    """One row, ``hwm`` = max(previous mark, largest numeric id), as ``ID_NUMBER``."""
    p = (prev if isinstance(prev, Column) else F.lit(prev)).cast(ID_NUMBER)
    return posts.agg(F.greatest(F.max(numeric_id(id_col)), p).alias("hwm"))


def catch_up(posts: DataFrame, from_id, id_col: str = "id") -> DataFrame:
    """Posts after ``from_id`` without moving any stored mark (same filter as ``since_id``)."""
    return since_id(posts, from_id, id_col)


def dedup_key(id_col="id", text="text") -> Column:
    """md5 of ``<id>_<first 100 characters of text>`` (null text counts as empty)."""
    return F.md5(F.concat_ws("_", _col(id_col).cast("string"),
                             F.substring(F.coalesce(_col(text), F.lit("")), 1, DEDUP_TEXT_CHARS)))


def dedup_posts(posts: DataFrame, key: Column | str | None = None, arrival: str = "arrival",
                tie_break: str | None = "id", ttl: str | None = None, seen: str = "timestamp") -> DataFrame:
    """Keep the first arrival of each key (default key: ``dedup_key(id, text)``).

    With ``ttl`` (``DEDUP_TTL`` is the reference's hour) a key is forgotten again: a
    copy is also kept when the last copy *kept* was seen (column ``seen``) at least
    ``ttl`` before it.  Copies without a ``seen`` time count as seen first.
    Kept copies are found by pointer doubling: a blocked scan gives every copy its
    next one (the first of its key ``ttl`` or more after it), then each round doubles
    the length of the steps and of the chain that starts at the key's first copy, so a key with n kept
    copies takes log2(n) rounds.  Keys whose copies all lie within one ``ttl`` need none.
    Rounds join row numbers only, as tables in the shared folder; the rows are read again at the end.

    Batch form of the reference's seen-key memory.  It is an aggregate
    (``min_by`` on the arrival; Spark plans it as a sort aggregate with a partial
    step in each task), not a window, so a key repeated in a third of all rows
    is collapsed map-side before the shuffle instead of landing whole in one
    task.  Running it twice changes nothing.  Without ``ttl`` every repeat is dropped.
    The streaming form is ``pulse.streaming.dedup_stream`` (event-time TTL).
    """
    k = dedup_key() if key is None else _col(key)
    cols = posts.columns
    if ttl is not None:
        return _dedup_with_ttl(posts, k, arrival, tie_break, ttl, seen)
    order = F.struct(F.col(arrival), *([F.col(tie_break)] if tie_break else []))
    return (posts.withColumn("_key", k)
            .groupBy("_key")
            .agg(F.min_by(F.struct(*[F.col(c) for c in cols]), order).alias("_first"))
            .select("_first.*"))


def _dedup_with_ttl(posts: DataFrame, key: Column, arrival: str, tie_break: str | None, ttl: str, seen: str) -> DataFrame:
    spark = posts.sparkSession
    ttl_us = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {ttl})")
    rows = stored(posts.select(
        F.struct(*[F.col(f"`{c}`") for c in posts.columns]).alias("_row"), F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")).alias("_key"),
        F.unix_micros(F.col(seen).cast("timestamp")).alias("_at"),
        F.struct(F.col(arrival), *([F.col(tie_break)] if tie_break else [])).alias("_order"),
        F.monotonically_increasing_id().alias("_id")), "dedup-rows")
    narrow = rows.select("_key", "_at", "_order", "_id")
    place = F.struct("_at", "_order", "_id")
    keys = stored(narrow.groupBy("_key").agg(
        F.min(place).alias("first"), F.min(F.when(F.col("_at").isNotNull(), place)).alias("timed"), F.max("_at").alias("last")), "dedup-keys")
    # the first copy of each key, and the first with a time where that is another
    starts = keys.select(F.explode(F.array_distinct(F.array_compact(F.array("first._id", "timed._id")))).alias("_id"))
    busy = keys.filter(F.col("last") >= F.col("timed._at") + ttl_us).select("_key")
    copies = stored(narrow.filter("_at IS NOT NULL").join(busy, "_key", "left_semi"), "dedup-copies")
    kept = [stored(starts, "dedup-kept")]
    step = _next_copies(copies, ttl_us)
    while not step.isEmpty():
        known = kept[0]
        for k in kept[1:]:
            known = known.unionByName(k)
        kept.append(stored(known.join(step, known["_id"] == step["a"]).select(F.col("b").alias("_id")), "dedup-kept"))
        on = step.select(F.col("a").alias("_m"), F.col("b").alias("c"))
        step = stored(step.join(on, F.col("b") == F.col("_m")).select("a", F.col("c").alias("b")), "dedup-step")
    known = kept[0]
    for k in kept[1:]:
        known = known.unionByName(k)
    return rows.join(known, "_id", "left_semi").select("_row.*")


def _next_copies(copies: DataFrame, ttl_us: Column) -> DataFrame:
    """``a, b``: each copy and the first of its key at least ``ttl`` after it.  Copies and the times at which they are forgotten are
    sorted into one sequence, where the copy after a forgetting is the least place behind it."""
    ends = copies.select("_key", (F.col("_at") + ttl_us).alias("_t"), F.lit(0).alias("_copy"), F.lit(None).cast(copies.schema["_order"].dataType).alias("_order"), "_id")
    both = ends.unionByName(copies.select("_key", F.col("_at").alias("_t"), F.lit(1).alias("_copy"), "_order", "_id"))
    by = ["_key", "_t", "_copy", "_order", "_id"]
    total = copies.count()
    parts = max(1, -(-2 * total // BLOCK_ROWS))
    placed = stored(both.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("_seq", F.monotonically_increasing_id())
                    .withColumn("_blk", -F.shiftright("_seq", 33)), "dedup-places")
    ahead = running(placed, F.when(F.col("_copy") == 1, F.struct("_seq", "_id")), "min", [F.col("_seq").desc()], "_blk", partition=["_key"], out="_next")
    return stored(ahead.filter("_copy = 0 AND _next IS NOT NULL").select(F.col("_id").alias("a"), F.col("_next._id").alias("b")), "dedup-step")


def search_predicate(text="text", terms=SEARCH_TERMS, lang_col="lang", lang: str | None = SEARCH_LANG,
                     exclude_reposts: bool = True, repost_prefix: str = REPOST_PREFIX) -> Column:
    """Any of ``terms`` as a whole phrase in any case (bounded by a non ``[a-z0-9]``
    character or the text edge), in language ``lang``, not a repost (``RT @``)."""
    import re
    alts = "|".join(re.escape(t.lower()) for t in terms)
    pattern = f"(^|[^a-z0-9])({alts})([^a-z0-9]|$)"
    t = _col(text)
    cond = F.lower(t).rlike(pattern)
    if lang is not None:
        cond = cond & (_col(lang_col) == F.lit(lang))
    if exclude_reposts:
        cond = cond & ~F.coalesce(t.startswith(repost_prefix), F.lit(False))
    return cond


def search(posts: DataFrame, terms=SEARCH_TERMS, lang: str | None = SEARCH_LANG,
           exclude_reposts: bool = True, text: str = "text", lang_col: str = "lang",
           newest_first: bool = False, ts: str = "timestamp", repost_prefix: str = REPOST_PREFIX) -> DataFrame:
    """The search the remote API ran, as a filter (pushed into the scan's stage)."""
    out = posts.filter(search_predicate(text, terms, lang_col, lang, exclude_reposts, repost_prefix))
    return out.orderBy(F.col(ts).desc_nulls_last()) if newest_first else out


def latest_n(posts: DataFrame, n: int = LATEST_KEEP, ts: str = "timestamp", tie: str = "id") -> DataFrame:
    """The newest ``n`` posts (ties broken by id): a top-k, planned as
    ``TakeOrderedAndProject`` (k rows per task, then k overall)."""
    return posts.orderBy(F.col(ts).desc_nulls_last(), F.col(tie).desc()).limit(int(n))


def recent(posts: DataFrame, limit: int = RECENT_LIMIT, ts: str = "timestamp", tie: str = "id") -> DataFrame:
    """The newest ``limit`` posts, oldest first.  ``limit=0`` gives none (the
    reference's ``[-0:]`` returned all)."""
    return latest_n(posts, limit, ts, tie).orderBy(F.col(ts).asc_nulls_first(), F.col(tie).asc())


def chunk_rows(df: DataFrame, size: int, partition: list[str] | None, order: list, block=None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Consecutive chunks of ``size`` rows in ``order`` within each ``partition``
    value: adds ``pos`` (1-based place) and ``chunk`` (0-based chunk number).

    The place is a blocked running count, so a partition value holding a third of all rows is still spread
    out: by blocks of about ``block_rows`` rows (``equal_depth``), or by ``block`` (non-decreasing along
    ``order``, e.g. a minute, or ``turn div 1000``) where that is given.
    ``order`` must be a total order within a partition value.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    if block is None:
        df = equal_depth(df, order, partition, block_rows, out="_depth")
        return chunk_rows(df, size, partition, order, "_depth").drop("_depth")
    ranked = running(df, F.lit(1), "count", order, _col(block), partition=list(partition or []), inclusive=True,
                     out="pos")
    return ranked.withColumn("chunk", F.floor((F.col("pos") - 1) / F.lit(size)).cast("long"))


def _bucket(posts: DataFrame, ts: str, every: str) -> Column:
    """Start of the epoch-aligned ``every`` bucket of ``ts``, in its type; null for a null time
    (``F.window`` would drop the row)."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    width = F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {every})")
    return F.timestamp_micros(us - F.pmod(us, width)).cast(posts.schema[ts].dataType)


def chunk_posts(posts: DataFrame, size: int = CHUNK_SIZE, ts: str = "timestamp", tie: str = "id",
                every: str = "1 hour", block: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Consecutive chunks of ``size`` posts, in time order, restarting every ``every``.

    Adds ``chunk_start`` (the ``every`` bucket), ``pos`` (1-based place in it) and
    ``chunk`` (0-based chunk number in it).  The place is a blocked running count, so no task holds a whole bucket, however
    bursty: blocks of about ``block_rows`` rows, or of a time ``block`` (e.g. ``"1 minute"``) where that is given.
    Posts without a time are chunked too, in a null bucket of their own, by ``tie``.
    """
    base = posts.withColumn("chunk_start", _bucket(posts, ts, every))
    if block is None:
        return chunk_rows(base, size, ["chunk_start"], [ts, tie], block_rows=block_rows)
    return chunk_rows(base.withColumn("_sub", _bucket(posts, ts, block)), size, ["chunk_start"], [ts, tie], "_sub").drop("_sub")


def fetch_report(posts: DataFrame, every: str = "1 hour", ts: str = "timestamp", block: str = "1 day") -> DataFrame:
    """Per ``every`` interval: ``posts``, ``credits`` (15 per post), running
    ``total_posts`` / ``total_credits`` and ``held`` = min(total, 1000) (the
    recent cache).  The running totals are a blocked prefix sum over intervals.
    Posts without a time are counted in a null interval, which comes first."""
    per = (posts
           .groupBy(_bucket(posts, ts, every).alias("interval_start"))
           .agg(F.count(F.lit(1)).alias("posts")))
    per = per.withColumn("credits", F.col("posts") * F.lit(CREDITS_PER_POST))
    blk = _bucket(per, "interval_start", block)
    rep = running(per, "posts", "sum", [F.col("interval_start").asc_nulls_first()], blk, out="total_posts")
    return (rep.withColumn("total_credits", F.col("total_posts") * F.lit(CREDITS_PER_POST))
            .withColumn("held", F.least(F.col("total_posts"), F.lit(HELD_MAX))))


def low_volume_streaks(report: DataFrame, threshold: int = LOW_VOLUME_THRESHOLD, n: str = "posts",
                       order: str = "interval_start", block: str = "1 day") -> DataFrame:
    """Runs of low intervals in a fetch report.

    An interval with fewer than ``threshold`` posts extends the low streak, a full
    one resets it; intervals without posts are absent and leave it as it is.
    ``poll_seconds`` = min(60, 5 * 2^(streak div 3)), 5 after a reset, is the back-off
    that the reference's polling would have reached.  The streak
    is (low intervals so far) - (low intervals so far at the last reset), two
    blocked prefix passes.
    """
    blk = _bucket(report, order, block)
    r = report.withColumn("is_low", F.col(n) < F.lit(threshold))
    r = running(r, F.col("is_low").cast("long"), "sum", [F.col(order).asc_nulls_first()], blk, out="_lows")
    r = r.withColumn("_at_reset", F.when(~F.col("is_low"), F.col("_lows")))
    r = running(r, "_at_reset", "max", [F.col(order).asc_nulls_first()], blk, out="_last_reset")
    streak = (F.col("_lows") - F.coalesce(F.col("_last_reset"), F.lit(0))).cast("long")
    step = F.floor(streak / F.lit(LOW_POLLS_PER_STEP))
    poll = F.least(F.lit(POLL_MAX_SECONDS).cast("double"),
                   F.lit(POLL_MIN_SECONDS) * F.pow(F.lit(2.0), step)).cast("long")
    return (r.withColumn("streak", streak)
            .withColumn("poll_seconds", F.when(F.col("streak") > 0, poll).otherwise(F.lit(POLL_MIN_SECONDS)))
            .drop("_lows", "_at_reset", "_last_reset"))
