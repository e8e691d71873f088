"""Scoring that remembers texts: a model sees each different text once in the life of a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.operators.scoring import BROADCAST_TEXTS, attach_scores, with_bands, with_batch_scorer
from pulse.session import stored
from pulse.streaming.sinks import TEXT_TABLE, _finished, checkpoint_for, write_batches

class BatchModel:
    """A model for ``start_dashboard`` that takes whole batches of texts; ``load`` as in ``with_batch_scorer``."""

    def __init__(self, load):
        self.load = load

    def score(self, texts: DataFrame) -> DataFrame:
        return with_batch_scorer(texts, self.load)


def score_batches_once(posts: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, memo: str, name: str, rule: str = "strict",
                       text: str = "text", trigger: dict | None = None, checkpoint: str | None = None, placed: bool = False):
    """Score each micro-batch into ``path/batch=<id>``, asking ``score`` only for texts that no earlier batch had.

    ``score`` takes ``_digest, text`` and adds ``polarity`` and ``unscored`` (``with_batch_scorer``, a lexicon join, ...).  The table
    at ``memo`` holds ``_digest, polarity, unscored`` in a folder for each batch; a batch reads the digests of the folders before
    its own, so a replayed batch overwrites its folder and scores the same texts.  Digests are narrow: a text leaves its
    row only if it is new, once: up to ``BROADCAST_TEXTS`` different texts a batch (counted) their places are broadcast.
    ``placed`` as in ``write_batches``."""
    spark = posts.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_digest", F.coalesce(F.sha2(F.col(text), 256), F.lit("null")))
        old = [f"{memo}/batch={b}" for b in _finished(spark, memo, "batch") if b < batch_id]
        # one row to score for each new digest: that with the least number in its batch
        numbered = rows.withColumn("_row", F.monotonically_increasing_id())
        mine = stored(numbered.groupBy("_digest").agg(F.min("_row").alias("_first")), "stream-digests")
        few = mine.count() <= BROADCAST_TEXTS
        first = mine
        known = spark.read.schema("_digest string, polarity double, unscored boolean").parquet(*old) if old else None
        if known is not None:
            first = first.join(known.select(F.col("_digest").alias("_k")), F.col("_digest") == F.col("_k"), "left_anti")
        places = first.select("_first")
        new = numbered.join(F.broadcast(places) if few else places, numbered["_row"] == F.col("_first"), "left_semi").select("_digest", F.col(text).alias("text"))
        score(new).select("_digest", "polarity", "unscored").write.mode("overwrite").parquet(f"{memo}/batch={batch_id}")
        seen = spark.read.schema("_digest string, polarity double, unscored boolean").parquet(*old, f"{memo}/batch={batch_id}")
        scores = with_bands(seen.join(mine.select(F.col("_digest").alias("_m")), F.col("_digest") == F.col("_m"), "left_semi"), rule)
        out = attach_scores(rows, scores, on="_digest", broadcast_scores=few).drop("_digest")
        out.write.mode("overwrite").options(**TEXT_TABLE).parquet(f"{path}/batch={batch_id}")
    return write_batches(posts, run, name, trigger=trigger, checkpoint=checkpoint or checkpoint_for(spark, name), placed=placed)
