"""Operator 8: token counts kept as delta-maintained rollups.

A store is a folder that all machines share, with three tables, each in folders ``batch=<id>``:

* ``ledger``: the state of every (document, tokenizer version) that the batch touched: its source, language and count,
  or that it is deleted; in folders ``bucket=<b>`` inside the batch's, by blocks of ``BLOCK`` ids;
* ``deltas``: signed sums of documents and tokens by source, language and version: what the batch adds and takes away;
* ``commits``: one row, written last.

A batch holds signed changes: an insert, a revised count, source or language (an insert of something that is there) or a delete.
Its delta is the new state less the committed one, so totals are sums of deltas and no total is ever recounted.  Of the
ledger a batch reads the buckets of its own documents, so a small batch costs what it touches, not the history.  Batches
are idempotent: a committed id is left alone, and an attempt that ended before its commit is overwritten.  Only
committed folders are read.  ``fold`` sums old batches into one, so the number of folders stays bounded.

Defined cases: of several changes to one (document, version) in a batch the highest ``seq`` wins, ties by the larger values; a
delete of what is not there changes nothing; changes with a null document are left out (nothing could revise them); a null source,
language, version or count is a value of its own, a null count adding 0 tokens; an empty batch commits an empty
delta; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.rank_bpe import encoder as byte_encoder
from llm.shared import bounded_batches
from llm.wordbpe import column_slices
from llm.wordbpe import encoder as word_encoder

BUCKETS, BLOCK = 256, 1024        # ledger folders of a batch at most, and ids in a row that share one
GROUP = ["source", "lang", "version"]
STATE = "doc_id long, version string, source string, lang string, tokens long, live boolean"
DELTA = "source string, lang string, version string, docs long, tokens long"


class Rollup:
    """One store at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, name: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def committed(self) -> list[int]:
        """Ids of the committed batches that still count, one number each."""
        if not self._exists("commits"):
            return []
        rows = self.spark.read.schema("covers array<long>, batch long").parquet(f"{self.path}/commits").collect()
        folded = {b for r in rows for b in r["covers"] if b != r["batch"]}
        return sorted(r["batch"] for r in rows if r["batch"] not in folded)

    def _known(self) -> set[int]:
        if not self._exists("commits"):
            return set()
        rows = self.spark.read.schema("covers array<long>, batch long").parquet(f"{self.path}/commits").collect()
        return {b for r in rows for b in [*r["covers"], r["batch"]]}

    def _read(self, name: str, schema: str) -> DataFrame:
        ids = self.committed()
        folders = [f"{self.path}/{name}/batch={b}" for b in ids]
        if not folders:
            return self.spark.createDataFrame([], f"{schema}, batch long")
        return self.spark.read.schema(f"{schema}, batch long").option("basePath", f"{self.path}/{name}").parquet(*folders)

    def ledger(self, buckets: list[int] | None = None) -> DataFrame:
        """The committed ledger, or its folders of some ``buckets``."""
        rows = self._read("ledger", f"{STATE}, bucket int")
        return rows if buckets is None else rows.filter(F.col("bucket").isin(buckets))

    def state(self, buckets: list[int] | None = None) -> DataFrame:
        """The newest committed state of every (document, version), deleted ones included."""
        row = F.struct("source", "lang", "tokens", "live")
        return (self.ledger(buckets).groupBy("doc_id", "version").agg(F.max_by(row, "batch").alias("s"))
                .select("doc_id", "version", "s.*"))

    def apply(self, batch: int, changes: DataFrame) -> bool:
        """Commit ``changes`` (``doc_id, version, source, lang, tokens, delete boolean, seq long``) as ``batch``; False if it
        was committed before.  Batches are applied in the order of their ids."""
        known = self._known()
        if batch in known:
            return False
        if known and batch < max(known):
            raise ValueError(f"batch {batch} is older than the committed batch {max(known)}")
        value = F.struct(F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                         F.col("tokens").cast("long").alias("tokens"), (~F.coalesce("delete", F.lit(False))).alias("live"))
        last = (changes.filter("doc_id is not null")
                .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("version").cast("string").alias("version"), "seq", value.alias("n"))
                .groupBy("doc_id", "version").agg(F.max(F.struct("seq", "n")).alias("m"))
                .select("doc_id", "version", "m.n.*"))
        self._write_ledger(last, batch)
        new = self.spark.read.schema(f"{STATE}, bucket int").parquet(f"{self.path}/ledger/batch={batch}")
        mine = [r["bucket"] for r in new.select("bucket").distinct().collect()]          # BUCKETS numbers at most
        old = self.state(mine).filter("live")
        touched = old.join(new.select(F.col("doc_id").alias("d"), F.col("version").alias("v")),
                           (F.col("doc_id") == F.col("d")) & F.col("version").eqNullSafe(F.col("v")), "left_semi")
        signed = (self._signed(new.filter("live"), F.lit(1)).unionByName(self._signed(touched, F.lit(-1)))
                  .groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                  .filter("docs <> 0 or tokens <> 0"))
        signed.write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        self._commit(batch, [batch])
        return True

    def _write_ledger(self, rows: DataFrame, batch: int) -> None:
        bucket = F.pmod(F.xxhash64(F.floor(F.col("doc_id") / BLOCK)), F.lit(BUCKETS)).cast("int")
        (rows.withColumn("bucket", bucket).repartition("bucket", F.pmod(F.xxhash64("doc_id", "version"), F.lit(BLOCK)) % 8)
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/ledger/batch={batch}"))

    @staticmethod
    def _signed(rows: DataFrame, sign: Column) -> DataFrame:
        return rows.select(*GROUP, sign.cast("long").alias("docs"), (sign * F.coalesce("tokens", F.lit(0))).cast("long").alias("tokens"))

    def _commit(self, batch: int, covers: list[int]) -> None:
        (self.spark.range(1).select(F.array(*[F.lit(b).cast("long") for b in covers]).alias("covers"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch}"))

    def fold(self, batch: int) -> bool:
        """Sum all committed batches into one with the new id ``batch``; False if that is committed already."""
        if batch in self._known():
            return False
        old = self.committed()
        self._write_ledger(self.state(), batch)
        self.totals().write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch}")
        self._commit(batch, [*old, batch])
        return True

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens``: sums of the committed deltas."""
        return (self._read("deltas", DELTA).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter("docs <> 0 or tokens <> 0"))


def changes(rows: DataFrame, version: str, tokens: Column, source: Column | None = None, delete: bool = False, seq: int = 0,
            key: str = "doc_id") -> DataFrame:
    """Changes of all ``rows`` to one version."""
    return rows.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.lit(version).alias("version"),
                       (F.col("source") if source is None else source).cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       tokens.cast("long").alias("tokens"), F.lit(delete).alias("delete"), F.lit(seq).cast("long").alias("seq"))


def word_tokens(text: str = "text") -> Column:
    """Version ``words``: runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))


def quarter_tokens(text: str = "text") -> Column:
    """Version ``quarters``: one token for each four code points begun."""
    return F.ceil(F.coalesce(F.char_length(F.col(text)), F.lit(0)) / 4)


def _token_counts(batches, word_file: str, byte_file: str, pattern: str):
    words, pieces = word_encoder(word_file), byte_encoder(byte_file, pattern)
    for batch in batches:
        texts = batch.column(batch.num_columns - 1)
        for a, b in column_slices(texts):
            part = texts.slice(a, b - a)
            ends = words.column(part)[1]
            byte_ids = pieces.encode_all(part.to_pylist())
            yield pa.RecordBatch.from_arrays(
                [c.slice(a, b - a) for c in batch.columns[:-1]] + [pa.array(np.diff(ends, prepend=0)), pa.array([len(x) // 4 for x in byte_ids], pa.int64())],
                names=["doc_id", "lang", "source", "word_bpe", "byte_bpe"])


def model_tokens(docs: DataFrame, word_file: str, byte_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang, source, word_bpe, byte_bpe``: each text's tokens by the encoders of operators 1 and 2 (null: none), in one pass."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(lambda it: _token_counts(it, word_file, byte_file, pattern),
                           "doc_id long, lang string, source string, word_bpe long, byte_bpe long")
