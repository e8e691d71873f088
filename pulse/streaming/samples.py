"""Bounded newest rows of a stream: samples per window and band, and the newest posts of all."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pulse.operators.ingest import LATEST_KEEP, latest_n
from pulse.operators.windows import SAMPLE_TEXTS, WINDOW_SIZE, WINDOW_SLIDE
from pulse.sources.tables import BROADCAST_KEYS
from pulse.streaming.queries import keyed_state
from pulse.streaming.sinks import _delete, _finished, checkpoint_for, write_batches

SAMPLE = "start long, stop long, band string, samples array<struct<at:long,id:string>>"


class NewestRows(StatefulProcessor):
    """State of a window and band: its newest ``n`` rows as ``(at, id)``, in a heap whose least row goes first.  With a watermark a timer
    at the window's end evicts it."""

    def __init__(self, n: int, evicts: bool):
        self.n, self.evicts = n, evicts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "at long, id string")

    def handleInputRows(self, key, rows, timerValues):
        start, stop, band = key
        before = sorted((c[0], c[1]) for c in self.held.get()) if self.held.exists() else []
        heap, there = list(before), set(before)
        for row in rows:
            new = (row["at"], row["id"])
            if new in there:                    # a row sent again
                continue
            if len(heap) < self.n:
                heapq.heappush(heap, new)
                there.add(new)
            elif new > heap[0]:
                there.discard(heapq.heappushpop(heap, new))
                there.add(new)
        if sorted(heap) != before:
            if self.evicts and not before:
                self.handle.registerTimer(stop // 1000)
            self.held.put(heap)
            yield Row("start", "stop", "band", "samples")(start, stop, band, [Row("at", "id")(*x) for x in sorted(heap, reverse=True)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.held.clear()
        return iter([])


def window_samples_stream(scored: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE, n: int = SAMPLE_TEXTS, ts: str = "timestamp",
                          label: str = "sentiment_label", tie: str = "id", watermark: str | None = None) -> DataFrame:
    """The newest ``n`` rows of each sliding window and band of a stream: ``window_start, window_end, sentiment_label, samples``
    (an array of ``at``, ``id``, newest first), in update mode (``write_updates`` keeps the last of each window).

    State is at most ``n`` times and ids a window, never a text: texts are joined from the stored rows, or lines, by ``sample_rows``.
    Each Arrow batch sends only its own newest ``n`` of a window, so a hot window is thinned before the
    shuffle.  Without a watermark all windows are kept and late rows count; with one, rows behind it are
    dropped and a window's state goes when the watermark passes its end."""
    keyed_state(scored.sparkSession)
    src = scored.withWatermark(ts, watermark) if watermark else scored
    rows = src.select(F.window(F.col(ts), size, slide).alias("window"), F.unix_micros(F.col(ts).cast("timestamp")).alias("at"),
                      F.coalesce(F.col(tie).cast("string"), F.lit("")).alias("id"), F.coalesce(F.concat(F.lit("="), F.col(label)), F.lit("")).alias("band"))
    if not watermark:                           # (a watermark's column would be lost in Python)
        rows = rows.select(F.unix_micros("window.start").alias("start"), F.unix_micros("window.end").alias("stop"), "band", "at", "id")
        rows = rows.mapInPandas(lambda frames: _thinned(frames, n), "start long, stop long, band string, at long, id string")
    else:
        rows = rows.select("window", F.unix_micros("window.start").alias("start"), F.unix_micros("window.end").alias("stop"), "band", "at", "id")
    out = rows.groupBy("start", "stop", "band").transformWithState(NewestRows(n, bool(watermark)), SAMPLE, "update",
                                                                   "EventTime" if watermark else "None")
    return out.select(F.timestamp_micros("start").alias("window_start"), F.timestamp_micros("stop").alias("window_end"),
                      F.when(F.col("band") != "", F.expr("substring(band, 2)")).alias("sentiment_label"), "samples")


def _thinned(frames, n: int):
    for frame in frames:
        newest = frame.sort_values(["at", "id"], ascending=False, kind="stable")
        yield newest.groupby(["start", "stop", "band"], sort=False).head(n)


def sample_rows(samples: DataFrame, rows: DataFrame, columns: list[str], tie: str = "id") -> DataFrame:
    """One row for each sample, with ``sample_rank`` and ``columns`` of the stored row, or parsed line, of that id."""
    flat = samples.select("window_start", "window_end", "sentiment_label", F.posexplode("samples").alias("_p", "_s"))
    keys = flat.select(F.col("_s.id").alias("_ki"), F.col("_s.at").alias("_ka")).distinct()
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    wanted = rows.select(F.coalesce(F.col(tie).cast("string"), F.lit("")).alias("_id"), F.unix_micros(F.col("timestamp").cast("timestamp")).alias("_at"), *columns)
    wanted = wanted.join(keys, (F.col("_id") == F.col("_ki")) & (F.col("_at") == F.col("_ka")), "left_semi")     # texts of samples alone leave the scan
    on = (F.col("_s.id") == F.col("_id")) & (F.col("_s.at") == F.col("_at"))
    return flat.join(wanted.dropDuplicates(["_id", "_at"]), on, "left").select(
        "window_start", "window_end", "sentiment_label", (F.col("_p") + 1).cast("long").alias("sample_rank"), F.col("_s.id").alias("id"), *columns)


def latest_stream(posts: DataFrame, path: str, name: str, n: int = LATEST_KEEP, ts: str = "timestamp", tie: str = "id",
                  trigger: dict | None = None, checkpoint: str | None = None, placed: bool = False):
    """The newest ``n`` posts held so far, as a versioned table (``read_complete`` reads the newest version): each batch merges its own
    newest ``n`` with the last version's.  A post sent again (same time and ``tie``) counts once, late posts take their
    place, and a replayed batch starts from the version before it.  The last two versions are kept.  Times and ``tie`` alone are
    sorted; whole posts are taken, and compared where one was sent again, only of the newest ``n``.  ``placed`` as in
    ``write_batches``."""
    spark = posts.sparkSession

    def once(df: DataFrame) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in posts.columns])
        return df.groupBy(F.col(ts).alias("_t"), F.col(tie).alias("_i")).agg(F.min(row).alias("_row")).select("_row.*")

    def newest(df: DataFrame) -> DataFrame:
        keys = latest_n(df.select(F.col(ts).alias("_kt"), F.col(tie).alias("_ki")).distinct(), n, "_kt", "_ki")
        keys = F.broadcast(keys) if n <= BROADCAST_KEYS else keys
        return once(df.join(keys, F.col(ts).eqNullSafe(F.col("_kt")) & F.col(tie).eqNullSafe(F.col("_ki")), "left_semi"))

    def run(batch: DataFrame, batch_id: int) -> None:
        held = batch
        old = [v for v in _finished(spark, path, "version") if v < batch_id]
        if old:
            held = held.unionByName(spark.read.schema(posts.schema).parquet(f"{path}/version={old[-1]}"))
        newest(held).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        for v in old[:-1]:
            _delete(spark, f"{path}/version={v}")
    return write_batches(posts, run, name, trigger=trigger, checkpoint=checkpoint or checkpoint_for(spark, name), placed=placed)
