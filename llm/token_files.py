"""Operator 1: token ids as a Parquet data set that can be read in part.

Layout of a data set at ``path``:

* ``ids/part-*.parquet``: one row per document in ascending ``(doc_id, text)`` order over the files by
  name: ``doc_id, part, part_start, n_tokens, ids array<int>``.  ``ids`` is dictionary encoded (a
  vocabulary fits a dictionary page, so a token takes 16 bits before compression); ``doc_id``,
  ``part_start`` and ``n_tokens`` are delta encoded.  Row groups and pages have set sizes and each
  column has a page index, so a range of ``doc_id`` reads only its pages and a metadata read leaves
  the ids alone.
* ``parts/part-*.parquet``: ``part, base, tokens``, the number of ids in all parts before, one row per file.

A document's place in the one long sequence of ids is ``base + part_start``.

Defined cases: a null text is empty; an empty text holds the end id alone; null ids sort first; equal
ids are ordered by their text, and both stay; an empty table gives an empty data set; other columns of
the input are not written.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from llm.shared import bounded_batches, text_of
from llm.wordbpe import ID, column_slices, encoder, ended

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000
DOCS_PER_PART = 20_000
FILE_OPTIONS = {
    "compression": "zstd", "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES), "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS), "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false", "parquet.enable.dictionary#part_start": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}
IDS_SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
PARTS_SCHEMA = "part int, base long, tokens long"


def _encode(batches, path: str, end_id: int):
    enc, part, at = encoder(path), TaskContext.get().partitionId(), 0
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
    for batch in batches:
        keys, texts = batch.column(0), batch.column(1)
        for a, b in column_slices(texts):
            ids, ends = ended(*enc.column(texts.slice(a, b - a)), end_id)
            starts = np.concatenate([[0], ends[:-1]])
            lists = pa.ListArray.from_arrays(pa.array(np.append(starts, ends[-1]).astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [keys.slice(a, b - a), pa.array(np.full(b - a, part, np.int32)), pa.array(at + starts),
                 pa.array(ends - starts), lists], schema=schema)
            at += int(ends[-1])
    enc.rest()


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, key: str = "doc_id",
                 text: str = "text", docs_per_part: int = DOCS_PER_PART) -> None:
    """Encode every document and write the data set at ``path`` (a folder that all machines share).

    One shuffle, by ranges of the key, carries the texts; the ids go straight from the encoder to
    the files.  A very long run of one key is a run of equal keys, ordered by text; it is spread by
    adding a hash of the text to the ranges."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = text_of(docs, key, text).withColumn("_h", F.xxhash64("_text"))
    parts = max(1, -(-docs.count() // docs_per_part), spark.sparkContext.defaultParallelism)
    ordered = (rows.repartitionByRange(parts, F.col("_id").asc_nulls_first(), F.col("_h"))
               .sortWithinPartitions(F.col("_id").asc_nulls_first(), "_h", "_text").select("_id", "_text"))
    ids = ordered.mapInArrow(lambda it: _encode(it, tokenizer, end_id), IDS_SCHEMA)
    ids.write.options(**FILE_OPTIONS).parquet(f"{path}/ids")
    totals = (read_ids(spark, path).groupBy("part")
              .agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("tokens")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per file
    (totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"), "tokens")
     .coalesce(1).write.parquet(f"{path}/parts"))


def read_ids(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """The rows of the documents ``first..last`` (both in; none: all).  The range reaches the files
    as a pushed filter, so row groups and pages outside it are not read; nor are columns not asked for."""
    rows = spark.read.schema(IDS_SCHEMA).parquet(f"{path}/ids")
    if first is not None:
        rows = rows.filter(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.filter(F.col("doc_id") <= last)
    return rows


def read_places(spark: SparkSession, path: str, columns: list[str] | None = None, **span) -> DataFrame:
    """``doc_id, start, n_tokens`` and whatever ``columns`` of ``read_ids``.  One row per file is broadcast."""
    parts = spark.read.schema(PARTS_SCHEMA).parquet(f"{path}/parts").select("part", "base")
    rows = read_ids(spark, path, **span)
    return (rows.join(F.broadcast(parts), "part")
            .select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", *(columns or [])))


def _crc(batches):
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("ids"))
        at = ids.offsets.to_numpy()
        data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype(ID).tobytes())
        crc = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(3)] + [pa.array(crc, pa.int64())],
                                         names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (CRC of the ids as little-endian unsigned 32-bit) from the files."""
    return read_places(spark, path, ["ids"]).mapInArrow(
        _crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
