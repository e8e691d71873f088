"""Streaming queries: parsed posts, scoring, watermarked windows and dedup.

Late data: ``late="keep"`` (the default of the dashboard) keeps every window's
state and so never drops a row, as the reference's complete-mode queries did,
watermark or not: update mode without a watermark writes only the windows a batch
changed, complete mode all of them.  ``late="drop"``, which has to be asked for,
runs append mode: a window is final once the watermark passes its end, its state
is evicted, and rows behind the watermark are dropped (Spark applies the new
watermark from the next batch on, so a late row in the batch right after the
advance still counts).
"""

from __future__ import annotations

from struct import Struct

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (
    BooleanType, DateType, NumericType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from pulse.operators.ingest import DEDUP_TTL, ID_NUMBER, dedup_key
from pulse.operators.scoring import lexicon_fits, score_placed_texts, with_scorer
from pulse.sources.lines import parse_posts, read_lines
from pulse.sources.tables import BROADCAST_KEYS
from pulse.streaming.sinks import TEXT_TABLE, TRIGGER_DASHBOARD, checkpoint_for, write_batches

# --- fixed values (must equal the reference) ---------------------------------
WATERMARK_WINDOWED = "30 seconds"
WATERMARK_DASHBOARD = "15 seconds"
# ------------------------------------------------------------------------------
DEDUP_LATENESS = "1 hour"        # posts this far behind the newest still find every copy of the last TTL
DEDUP_BUCKETS = 1 << 12          # groups of keys whose state is read and written at once
MOST_ITEMS = 64                  # of a bucket's list; when there would be more, they are packed into one
COPY = Struct("<16sqq")          # digest of the key, time, when it is forgotten
NO_TIME = -(1 << 62)


def post_stream(spark: SparkSession, path: str | None = None, fmt: str = "text",
                watermark: str | None = None, max_files_per_trigger: int | None = None,
                max_offsets_per_trigger: int | None = None, **options) -> DataFrame:
    """Lines -> parsed posts (``id, created_at, text, username, timestamp``).

    ``timestamp`` is cast to TIMESTAMP (watermarks need it).  The per-batch
    bounds replace the reference's per-request row cap.
    """
    if max_files_per_trigger is not None:
        options["maxFilesPerTrigger"] = max_files_per_trigger
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = max_offsets_per_trigger
    posts = parse_posts(read_lines(spark, path, fmt, stream=True, **options))
    posts = posts.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return posts.withWatermark("timestamp", watermark) if watermark else posts


def scored_stream(posts: DataFrame, scorer, rule: str = "strict") -> DataFrame:
    """Stateless scoring with a plug-in scorer (one pandas UDF per batch of rows)."""
    return with_scorer(posts, scorer, rule=rule)


def score_batches(posts: DataFrame, lexicon: DataFrame, path: str, name: str, rule: str = "strict",
                  text: str = "text", trigger: dict | None = None, checkpoint: str | None = None, placed: bool = False,
                  columns: list[str] | None = None):
    """Lexicon scoring of each micro-batch (a join + aggregate, which would be
    stateful inside the stream), written to ``path/batch=<id>`` so a replayed
    batch overwrites its own folder.  Scores belong to texts, not ids: rows that share an id keep
    their own, and ``unscored`` flags null texts.  ``placed`` as in ``write_batches``.  ``columns``: those stored, all unless given;
    where the lines stay, texts need not be stored again."""
    fits = lexicon_fits(lexicon)  # decided once for the life of the query

    def run(batch: DataFrame, batch_id: int) -> None:
        scored = score_placed_texts(batch, lexicon, text=text, rule=rule, broadcast=fits).select(*(columns or ["*"]))
        scored.write.mode("overwrite").options(**TEXT_TABLE).parquet(f"{path}/batch={batch_id}")
    return write_batches(posts, run, name, trigger=trigger,
                         checkpoint=checkpoint or checkpoint_for(posts.sparkSession, name), placed=placed)


def windowed_stream(scored: DataFrame, size: str = "10 seconds", slide: str = "5 seconds",
                    watermark: str | None = WATERMARK_WINDOWED, ts: str = "timestamp",
                    label: str = "sentiment_label", score: str = "sentiment_score",
                    order: str | None = None) -> DataFrame:
    """Sliding window x band with count and mean, over a watermarked stream.

    State per window is a count and a sum (not the texts), so it stays small;
    with append/update output the watermark also evicts finished windows.
    ``order`` (``"asc"`` / ``"desc"`` by window) is for complete output only,
    where Spark can sort the whole result of each batch.
    """
    src = scored.withWatermark(ts, watermark) if watermark else scored
    out = (src.groupBy(F.window(F.col(ts), size, slide).alias("window"), F.col(label))
           .agg(F.count(F.lit(1)).alias("tweet_count"), F.avg(score).alias("avg_sentiment")))
    if order == "asc":
        out = out.orderBy(F.col("window").asc())
    elif order == "desc":
        out = out.orderBy(F.col("window").desc())
    return out


def output_mode(late: str) -> str:
    """``late="drop"`` -> append, ``late="keep"`` -> complete."""
    if late not in ("drop", "keep"):
        raise ValueError("late must be 'drop' or 'keep'")
    return "append" if late == "drop" else "complete"


def dedup_stream(posts: DataFrame, ttl: str = DEDUP_TTL, key=None, ts: str = "timestamp",
                 lateness: str = DEDUP_LATENESS, columns: list[str] | None = None, buckets: int = DEDUP_BUCKETS) -> DataFrame:
    """Drop a post if a copy *kept* of its key lies less than ``ttl`` of event time from it, before or after.
    Default key: ``dedup_key(id, text)``.  No other post is dropped, however late it comes.

    The state holds the times of each key's kept copies, each until the watermark (``lateness`` behind the newest
    post) passes the copy's time + ``ttl``, when a timer forgets it.  Keys (by a digest of 128 bits) lie in ``buckets`` by their hash, each with a
    list and a timer: Python asks for a bucket's state once a batch, and adds to it once, not for each key.  So a batch reads the buckets
    of its own keys, writes its own copies, and sees to the buckets where some expire, whatever else is remembered; ``buckets`` stays the same
    in the life of a checkpoint.  Repeats that come up to ``lateness`` behind the newest post are
    all found.  A post further behind is kept unless its key is still remembered, and is then remembered until the
    watermark has moved on by ``ttl``; only a repeat that comes later than that gets through a second time.
    A copy without a time is kept if nothing is remembered of its key, and hides no copy with a time (as in ``dedup_posts``).

    ``columns`` (default: all) are those of the result; no others leave the JVM.  ``dedup_tables`` passes a row id alone.
    Append mode; keyed state needs the RocksDB state store, which ``keyed_state`` sets for the session.  Times of the output carry no
    watermark: windows over it are a query of their own over the stored rows, as in ``start_dashboard``.  All copies of a
    bucket in a batch go to one task, which holds those that no earlier batch covers, one for each key and time.
    """
    k = dedup_key() if key is None else (F.col(key) if isinstance(key, str) else key)
    spark = posts.sparkSession
    keyed_state(spark)
    fields = [f for f in posts.schema.fields if columns is None or f.name in columns]
    posts = posts.withColumn("dedup_key", k)
    as_text = {f.name for f in fields if isinstance(f.dataType, (NumericType, BooleanType, DateType, TimestampType, TimestampNTZType))}

    def packed(f):      # numbers and times travel as text, so that Python rounds none
        c = F.col(f"`{f.name}`")
        return (F.unix_micros(c) if isinstance(f.dataType, TimestampType) else c).cast("string") if f.name in as_text else c

    def unpacked(f):
        c = F.col(f"`{f.name}`")
        return F.timestamp_micros(c.cast("long")) if isinstance(f.dataType, TimestampType) else c.cast(f.dataType) if f.name in as_text else c

    # Spark drops rows that are late by the watermark's column.  A row's time moves the watermark in a copy of the row,
    # which goes no further; the row itself has no time there, and so is never late.
    at = F.col(f"`{ts}`").cast("timestamp")
    none = F.lit(None).cast("timestamp")
    digest = F.unhex(F.left(F.sha2(F.coalesce(F.concat(F.lit("="), F.col("dedup_key").cast("string")), F.lit("")).cast("binary"), 256), F.lit(32)))
    rows = (posts.select(
        *[packed(f).alias(f.name) for f in fields], digest.alias("_key"),
        F.coalesce(F.unix_micros(at), F.lit(NO_TIME)).alias("_at"),
        F.explode(F.when(at.isNull(), F.array(none)).otherwise(F.array(none, at))).alias("_clock"))
        .withWatermark("_clock", lateness).filter("_clock IS NULL")
        .withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")))
    out = StructType([StructField(f.name, StringType() if f.name in as_text else f.dataType) for f in fields])
    kept = rows.groupBy("_bucket").transformWithState(FirstCopies(_micros(spark, ttl), out.names), out, "append", "EventTime")
    return kept.select(*[unpacked(f).alias(f.name) for f in fields])


def keyed_state(spark: SparkSession) -> None:
    """State of each key apart, in RocksDB; a checkpoint gets the changes of a batch, not the whole store.  A store takes no disk
    ahead of what it writes (4 MB for each partition and start of a query, otherwise)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL {interval})")).first()[0]


class FirstCopies(StatefulProcessor):
    """State of ``dedup_stream`` for a bucket of keys: a list of packed copies, each with the digest of its key, its time, and when it is
    forgotten (0: not said yet, as the watermark has not started).  ``upto``: copies due before then are forgotten, though still
    in the list; it is packed anew once half of it is such copies, or at ``MOST_ITEMS`` items.  One timer a bucket waits for its next copy that is due."""

    def __init__(self, ttl_us: int, columns: list[str]):
        self.ttl, self.columns = ttl_us, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.copies = handle.getListState("copies", "packed binary, upto long")

    def _held(self) -> tuple[list[tuple[bytes, int, int]], int, int]:
        """The copies remembered, how many there are in the list, forgotten ones too, and how many items it has."""
        items = list(self.copies.get())
        upto = max((u for _, u in items), default=0)
        every = [c for packed, _ in items for c in COPY.iter_unpack(packed)]
        return [c for c in every if not c[2] or c[2] >= upto], len(every), len(items)

    def _covered(self, times, t: int) -> bool:
        return any(abs(t - k) < self.ttl for k in times) or (t == NO_TIME and len(times) > 0)

    def handleInputRows(self, key, rows, timerValues):
        now = max(timerValues.getCurrentWatermarkInMs(), 0) * 1000
        held, _, items = self._held()
        times: dict[bytes, list[int]] = {}
        for k, t, _ in held:
            times.setdefault(k, []).append(t)
        first: dict[tuple[bytes, int], Row] = {}
        for row in rows:
            copy = bytes(row["_key"]), row["_at"]
            if copy not in first and not self._covered(times.get(copy[0], ()), copy[1]):
                first[copy] = row
        kept, new = [], []
        for k, t in sorted(first):
            if not self._covered(times.setdefault(k, []), t):
                since = max(t, now)             # a post without a time, or behind the watermark, counts from now
                times[k].append(t)
                new.append((k, t, since + self.ttl if since > 0 else 0))
                kept.append(first[k, t])
        if new:
            if items + len(new) <= MOST_ITEMS:
                self.copies.appendList([(COPY.pack(*c), 0) for c in new])
            else:
                self.copies.put([(_packed(held + new), 0)])
            due = min(until for _, _, until in new)
            if not held or due < min(until for _, _, until in held):    # else the timer that waits comes first, and sets the next
                self.handle.registerTimer(max(due, now) // 1000 + 1)
        result = Row(*self.columns)
        for row in kept:
            yield result(*[row[c] for c in self.columns])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held, n, items = self._held()
        left = [(k, t, until or now + self.ttl) for k, t, until in held if not until or until >= now]
        if not left:
            self.copies.clear()
        elif 2 * len(left) <= n + items or any(not until for _, _, until in held):
            self.copies.put([(_packed(left), 0)])
        elif len(left) < len(held):
            self.copies.appendValue((b"", now))
        if left:
            self.handle.registerTimer(min(until for _, _, until in left) // 1000 + 1)
        return iter([])


def _packed(copies: list[tuple[bytes, int, int]]) -> bytes:
    return b"".join(COPY.pack(*c) for c in copies)


def dedup_tables(posts: DataFrame, root: str, name: str, ttl: str = DEDUP_TTL, key=None, ts: str = "timestamp",
                 lateness: str = DEDUP_LATENESS, trigger: dict | None = None):
    """``dedup_stream`` for whole posts at scale: ``<name>_posts`` appends every post once, with a ``row_id``, to ``root/posts``, and
    ``<name>_kept`` reads key, time and row id of that table alone and appends the row ids kept to ``root/kept``.  Texts neither
    cross a shuffle nor reach Python.  ``kept_posts`` joins the two.  Both resume from checkpoints under
    ``root``; with an ``availableNow`` trigger the posts are drained first.  Returns the started queries."""
    from pulse.streaming.sinks import to_table

    spark = posts.sparkSession
    k = dedup_key() if key is None else (F.col(key) if isinstance(key, str) else key)
    whole = posts.withColumn("dedup_key", k).withColumn("row_id", F.expr("uuid()"))
    first = to_table(whole, f"{name}_posts", "append", trigger, f"{root}/checkpoint-posts", fmt="parquet", path=f"{root}/posts", options=TEXT_TABLE)
    if "availableNow" in (trigger or {}):
        first.awaitTermination()
    narrow = spark.readStream.schema(whole.schema).parquet(f"{root}/posts").select("row_id", "dedup_key", ts)
    kept = dedup_stream(narrow, ttl, "dedup_key", ts, lateness, columns=["row_id"])
    return [first, to_table(kept, f"{name}_kept", "append", trigger, f"{root}/checkpoint-kept", fmt="parquet", path=f"{root}/kept")]


def kept_posts(spark: SparkSession, root: str, columns: list | None = None) -> DataFrame:
    """The posts that ``dedup_tables`` kept.  ``columns``: names and expressions of the result, taken where the posts lie,
    so that a text that is only counted or digested does not cross the join's shuffle."""
    kept = spark.read.parquet(f"{root}/kept").select(F.col("row_id").alias("_kept"))
    posts = spark.read.parquet(f"{root}/posts")
    columns = [c for c in posts.columns if c not in ("row_id", "dedup_key")] if columns is None else columns
    rows = posts.select(F.col("row_id").alias("_row_id"), *columns)
    return rows.join(kept, F.col("_row_id") == F.col("_kept"), "left_semi").drop("_row_id")


def start_dashboard(spark: SparkSession, source: str, scorer, out_root: str, rule: str = "wide",
                    watermark: str = WATERMARK_DASHBOARD, size: str = "10 seconds", slide: str = "5 seconds",
                    late: str = "keep", trigger: dict | None = None, fmt: str = "text",
                    max_files_per_trigger: int | None = None, name: str = "dashboard", store: bool = False, **source_options):
    """Start the dashboard's two named queries:

    - ``<name>_rows``: every post, parsed and scored once, appended to ``out_root/raw_tweets``;
    - ``<name>_windows``: window x band counts and means over that table's rows.  ``late="keep"`` (default)
      writes the windows each batch changes to ``out_root/windowed_aggregates`` (read them with
      ``read_updates(..., ["window_start", "window_end", "sentiment_label"])``) and drops nothing;
      ``late="drop"`` appends finished windows and drops rows behind the watermark, with bounded state.

    ``scorer`` is a lexicon (a DataFrame: the native join, each text of a batch once), a ``BatchModel`` (each different text once
    in the life of the query, remembered under ``out_root/scores``), or a function ``str -> float`` (a call for each post).
    ``store=True`` keeps the rows by the hour with their panes instead, and their texts beside them, in ``out_root/store``, where
    ``SpanStore`` gives the dashboard views their span without the history; it needs one of the first two.

    Each query has its own checkpoint under the shared checkpoint folder, so both
    resume after a restart.  The dashboard views (``pulse.operators.views``) then
    run as batch queries over the two tables.  With an ``availableNow`` trigger the rows are drained
    before the windows start.  Returns the started queries.
    """
    from pulse.streaming.memo import BatchModel, score_batches_once
    from pulse.streaming.panes import store_batches
    from pulse.streaming.sinks import to_table, trigger_options, write_updates

    if late not in ("keep", "drop"):
        raise ValueError("late must be 'keep' or 'drop'")
    trigger = trigger or trigger_options(TRIGGER_DASHBOARD)
    posts = post_stream(spark, source, fmt=fmt, max_files_per_trigger=max_files_per_trigger, **source_options)
    schema = scored_stream(posts, float, rule=rule).schema       # scored rows look alike, whoever scores them
    raw = f"{out_root}/raw_tweets"
    if isinstance(scorer, DataFrame):
        fits = lexicon_fits(scorer)
        if store:
            rows = store_batches(posts, f"{out_root}/store", f"{name}_rows", trigger=trigger, placed=True,
                                 score=lambda batch: score_placed_texts(batch, scorer, rule=rule, broadcast=fits))
        else:
            rows = score_batches(posts, scorer, raw, f"{name}_rows", rule=rule, trigger=trigger, placed=True)
    elif isinstance(scorer, BatchModel):
        if store:
            raise ValueError("a store is filled by a lexicon; store scored rows with store_batches")
        rows = score_batches_once(posts, scorer.score, raw, f"{out_root}/scores", f"{name}_rows", rule=rule, trigger=trigger, placed=True)
    else:
        if store:
            raise ValueError("a store is filled by a lexicon; store scored rows with store_batches")
        rows = to_table(scored_stream(posts, scorer, rule=rule), f"{name}_rows", "append", trigger, fmt="parquet", path=raw)
    if "availableNow" in trigger:
        rows.awaitTermination()
    windows = scored_windows(spark, f"{out_root}/store/rows" if store else raw, schema, size, slide, watermark if late == "drop" else None)
    if late == "drop":
        win = to_table(windows, f"{name}_windows", "append", trigger, fmt="parquet", path=f"{out_root}/windowed_aggregates")
    else:
        win = write_updates(windows, f"{out_root}/windowed_aggregates", f"{name}_windows", trigger)
    return [rows, win]


def scored_windows(spark: SparkSession, path: str, schema, size: str = "10 seconds", slide: str = "5 seconds",
                   watermark: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """The window stream over a stored table of scored rows: no parsing and no scoring again."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    windows = windowed_stream(reader.parquet(path), size, slide, watermark)
    return windows.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          "sentiment_label", "tweet_count", "avg_sentiment")


def since_id_stream(posts: DataFrame, out_path: str, marks_path: str, name: str, start_mark: int | None = None,
                    id_col: str = "id", trigger: dict | None = None, checkpoint: str | None = None,
                    dedup_in_batch: bool = True, placed: bool = False):
    """Keep only posts whose id is above the high-water mark of all earlier
    batches (ids compared as numbers), and move the mark.

    The mark is a small table: batch ``b`` writes ``marks_path/batch=b`` with the
    new mark, and starts from the newest one before it (a scalar subquery, nothing
    collected).  The last two are kept: a replayed batch reads
    the same mark and overwrites its own folders, so output stays exactly-once.
    The reference's mark moved only after a whole response, so repeats inside
    one response got through; ``dedup_in_batch`` (default) keeps one row per id
    within a micro-batch instead (``dedup_in_batch=False`` keeps them all).  Only rows whose id comes more
    than once in the batch are compared whole, through a shuffle; up to ``BROADCAST_KEYS`` such ids (counted) are
    broadcast, and all other rows stay where they lie.  ``placed`` as in ``write_batches``.
    """
    from pulse.operators.ingest import high_water, since_id

    from pulse.streaming.sinks import _delete, _finished

    spark = posts.sparkSession
    # the table must exist before the first batch reads it: batch -1 holds the start mark, as first given
    if not _finished(spark, marks_path, "batch"):
        (spark.range(1).select(F.lit(start_mark).cast(ID_NUMBER).alias("hwm"))
         .write.mode("overwrite").parquet(f"{marks_path}/batch=-1"))

    def run(batch: DataFrame, batch_id: int) -> None:
        before = [b for b in _finished(spark, marks_path, "batch") if b < batch_id]
        prev = spark.read.parquet(f"{marks_path}/batch={before[-1]}").select(F.max("hwm")).scalar()
        kept = since_id(batch, prev, id_col)
        if dedup_in_batch:      # the same row on every replay: the least in the order of all columns
            row = F.struct(*kept.columns)
            many = kept.groupBy(F.col(id_col).alias("_many")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_many")
            n = many.count()
            if n:
                many = F.broadcast(many) if n <= BROADCAST_KEYS else many
                same = F.col(id_col).eqNullSafe(F.col("_many"))
                least = kept.join(many, same, "left_semi").groupBy(F.col(id_col).alias("_id")).agg(F.min(row).alias("_row")).select("_row.*")
                kept = kept.join(many, same, "left_anti").unionByName(least)
        kept.write.mode("overwrite").options(**TEXT_TABLE).parquet(f"{out_path}/batch={batch_id}")
        high_water(batch, prev, id_col).write.mode("overwrite").parquet(f"{marks_path}/batch={batch_id}")
        for b in before[:-1]:
            _delete(spark, f"{marks_path}/batch={b}")
    return write_batches(posts, run, name, trigger=trigger,
                         checkpoint=checkpoint or checkpoint_for(spark, name), placed=placed)
