"""A store of scored posts by the hour, with pane aggregates: dashboard views that read their span and nothing else.

``root/posts/batch=<b>``           the whole posts, in files as the batch's tasks hold them, each with its ``place`` in the batch
``root/rows/hour=<h>/batch=<b>``   the posts by the hour: every column but the texts, which are found by ``batch`` and ``place``
``root/panes/hour=<h>/batch=<b>``  per pane (a minute) and band: ``pane, sentiment_label, sentiment_score, n``
``root/edges/batch=<b>``           one row: oldest and newest time of the batches up to ``b``

A view takes the panes that lie inside its span, and the posts of the cut pane at the span's edge.  It opens the folders of the
span's hours by name, so a view of five minutes lists and reads two hours at most, however long the history.  Texts cross no
shuffle on their way into the store, and leave it only for the posts that a view shows.  A replayed batch overwrites its own folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.operators.windows import interval_seconds
from pulse.streaming.sinks import TEXT_TABLE, _delete, _finished, _fs, checkpoint_for, write_batches

PANE = "1 minute"
HOUR = "yyyy-MM-dd-HH"
NO_HOUR = "none"                     # the folder of posts without a time
TEXT_COLUMNS = ("text",)             # kept in ``posts`` alone
BROADCAST_ROWS = 100_000             # rows without texts (about 200 bytes each) that are broadcast


def _pane(ts: str, pane: str) -> Column:
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return F.timestamp_micros(us - F.pmod(us, F.lit(interval_seconds(pane) * 1_000_000)))


def store_batches(scored: DataFrame, root: str, name: str, score=None, ts: str = "timestamp", pane: str = PANE, trigger: dict | None = None,
                  checkpoint: str | None = None, placed: bool = False):
    """Append a stream of posts to the store.  ``score``: a function from a batch to its scored rows (e.g. the lexicon join), where
    the stream itself is not scored.  ``placed`` as in ``write_batches``."""
    spark = scored.sparkSession

    def put(df: DataFrame, part: str) -> None:
        (df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **TEXT_TABLE).partitionBy("hour", "batch").parquet(f"{root}/{part}"))

    def run(batch: DataFrame, batch_id: int) -> None:
        whole = (score(batch) if score else batch).withColumn("place", F.monotonically_increasing_id())
        whole.write.mode("overwrite").options(**TEXT_TABLE).parquet(f"{root}/posts/batch={batch_id}")
        at = F.col(ts).cast("timestamp")
        # scored once: everything else reads the stored posts, so that places hold whatever the batch does when read again
        written = spark.read.schema(whole.schema).parquet(f"{root}/posts/batch={batch_id}").drop(*TEXT_COLUMNS)
        written = (written.withColumn("hour", F.coalesce(F.date_format(at, HOUR), F.lit(NO_HOUR))).withColumn("batch", F.lit(batch_id)))
        put(written.repartition("hour"), "rows")
        panes = (written.filter(F.col(ts).isNotNull()).groupBy("hour", "batch", _pane(ts, pane).alias("pane"), "sentiment_label", "sentiment_score")
                 .agg(F.count(F.lit(1)).alias("n")))
        put(panes.repartition("hour"), "panes")
        edge = written.agg(F.min(at).alias("oldest"), F.max(at).alias("newest"))
        old = [b for b in _finished(spark, f"{root}/edges", "batch") if b < batch_id]
        if old:
            edge = edge.unionByName(spark.read.schema(edge.schema).parquet(f"{root}/edges/batch={old[-1]}")).agg(
                F.min("oldest").alias("oldest"), F.max("newest").alias("newest"))
        edge.coalesce(1).write.mode("overwrite").parquet(f"{root}/edges/batch={batch_id}")
        for b in old[:-1]:
            _delete(spark, f"{root}/edges/batch={b}")
    return write_batches(scored, run, name, trigger=trigger, checkpoint=checkpoint or checkpoint_for(spark, name), placed=placed)


class SpanStore:
    """Reads a store.  ``weights(span)`` and ``rows(span)`` cover ``ts >= newest - span``, like ``pulse.operators.views.in_span``."""

    def __init__(self, spark: SparkSession, root: str, ts: str = "timestamp", pane: str = PANE):
        self.spark, self.root, self.ts, self.pane = spark, root, ts, pane
        last = _finished(spark, f"{root}/edges", "batch")
        if not last:
            raise ValueError(f"no finished batch under {root}")
        edge = spark.read.parquet(f"{root}/edges/batch={last[-1]}")
        self.oldest, self.newest = edge.select(F.unix_micros("oldest"), F.unix_micros("newest")).first()     # one row

    def as_of(self) -> Column:
        return F.timestamp_micros(F.lit(self.newest))

    def start(self) -> Column:
        return F.timestamp_micros(F.lit(self.oldest))

    def _hours(self, part: str, low: int, high: int) -> list[str]:
        """The folders of the hours between two times that exist (times in microseconds)."""
        day, out = dt.datetime(1970, 1, 1), []
        fs, base = _fs(self.spark, f"{self.root}/{part}")
        first, last = low // 3_600_000_000, high // 3_600_000_000
        if last - first > 1000:                 # a long span: the names of all hours in one listing
            names = [s.getPath().getName()[5:] for s in fs.listStatus(base) if s.getPath().getName().startswith("hour=")]
            a, b = ((day + dt.timedelta(hours=h)).strftime("%Y-%m-%d-%H") for h in (first, last))
            return [f"{self.root}/{part}/hour={n}" for n in names if n != NO_HOUR and a <= n <= b]
        for h in range(first, last + 1):
            path = f"{self.root}/{part}/hour={(day + dt.timedelta(hours=h)).strftime('%Y-%m-%d-%H')}"
            if fs.exists(_fs(self.spark, path)[1]):
                out.append(path)
        return out

    def _read(self, part: str, low: int, high: int) -> DataFrame:
        folders = self._hours(part, low, high)
        reader = self.spark.read.option("basePath", f"{self.root}/{part}")
        if folders:
            return reader.parquet(*folders)
        return reader.parquet(f"{self.root}/{part}").limit(0)

    def _from(self, span: str) -> int:
        return self.newest - interval_seconds(span) * 1_000_000

    def rows(self, span: str) -> DataFrame:
        """The posts of the span."""
        low = self._from(span)
        return self.with_texts(self._read("rows", low, self.newest).filter(F.unix_micros(F.col(self.ts).cast("timestamp")) >= low))

    def with_texts(self, rows: DataFrame, bounded_rows: int | None = None) -> DataFrame:
        """Rows of the store with the texts of their posts.  ``bounded_rows``: the caller's bound on them; up to ``BROADCAST_ROWS``
        are broadcast to the posts' scan, so texts of those rows alone leave it.  More are joined by shuffle."""
        posts = self.spark.read.option("basePath", f"{self.root}/posts").parquet(f"{self.root}/posts")
        texts = [c for c in TEXT_COLUMNS if c in posts.columns]
        if not texts:
            return rows
        posts = posts.select(F.col("batch").alias("_tb"), F.col("place").alias("_tp"), *texts)
        on = (F.col("batch") == F.col("_tb")) & (F.col("place") == F.col("_tp"))       # every row has its post
        rows = F.broadcast(rows) if bounded_rows is not None and bounded_rows <= BROADCAST_ROWS else rows
        return posts.join(rows, on).drop("_tb", "_tp")

    def weights(self, span: str) -> DataFrame:
        """The span as ``sentiment_label, sentiment_score, n``: whole panes, and the posts of the pane that the span's start cuts.
        The views take it with ``weight="n"`` and no span of their own."""
        low, width = self._from(span), interval_seconds(self.pane) * 1_000_000
        whole = -(-low // width) * width        # the first pane that lies inside
        panes = self._read("panes", whole, self.newest).filter(F.unix_micros("pane") >= whole).select("sentiment_label", "sentiment_score", "n")
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        cut = (self._read("rows", low, min(whole, self.newest)).filter((us >= low) & (us < whole))
               .select("sentiment_label", "sentiment_score", F.lit(1).cast("long").alias("n")))
        return panes.unionByName(cut)

    def newest_rows(self, limit: int, span: str) -> DataFrame:
        """Rows among which are the span's newest ``limit``: panes say how far back they reach, so older hours are not opened."""
        low = self._from(span)
        back, width = 3_600_000_000, interval_seconds(self.pane) * 1_000_000
        pane = F.unix_micros("pane")
        while True:
            at = max(low, self.newest - back)
            held, most = self._read("panes", at, self.newest).agg(     # without and with the pane that ``at`` cuts
                F.sum(F.when(pane >= at, F.col("n"))), F.sum(F.when(pane > at - width, F.col("n")))).first()
            if (held or 0) >= limit or at == low:
                break
            back *= 4
        us = F.unix_micros(F.col(self.ts).cast("timestamp"))
        return self.with_texts(self._read("rows", at, self.newest).filter(us >= max(low, at)), most or 0)
