"""Sinks, triggers and query lifecycle.

Every started query gets a checkpoint under the session's shared checkpoint
folder (``spark.checkpoint.dir``), so a restarted query resumes from its last
committed batch.  Batch writers are idempotent per batch id (each batch
overwrites its own folder), which together with a replayable source gives
exactly-once output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulse.session import checkpoint_root

# --- fixed values (must equal the reference) ---------------------------------
CONSOLE_ROWS = 20
TRIGGER_ROWS = "10 seconds"      # row printer
TRIGGER_WINDOWS = "5 seconds"    # windowed script
TRIGGER_DASHBOARD = "2 seconds"  # dashboard
# ------------------------------------------------------------------------------
TEXT_TABLE = {"compression": "zstd"}     # of stored tables that hold whole texts


def checkpoint_for(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/streams/{name}"


def trigger_options(every: str | None = None, available_now: bool = False, once: bool = False) -> dict:
    """``every`` -> processing-time trigger; ``available_now`` -> drain what is there
    in bounded batches and stop (tests, backfill)."""
    if available_now:
        return {"availableNow": True}
    if once:
        return {"once": True}
    return {"processingTime": every} if every else {}


def _writer(df: DataFrame, name: str, mode: str, trigger: dict | None, checkpoint: str | None):
    w = df.writeStream.queryName(name).outputMode(mode)
    if trigger:
        w = w.trigger(**trigger)
    return w.option("checkpointLocation", checkpoint or checkpoint_for(df.sparkSession, name))


def write_batches(df: DataFrame, fn: Callable[[DataFrame, int], None], name: str,
                  mode: str = "append", trigger: dict | None = None,
                  checkpoint: str | None = None, placed: bool = False) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` for each non-empty micro-batch.

    Emptiness is checked with ``isEmpty()`` (one row looked at), never ``count()``;
    ``fn`` should write a table keyed by ``batch_id`` so a replayed batch
    overwrites instead of duplicating.  The batch is persisted while ``fn`` runs, so
    several actions on it parse (and score) its rows once; lost blocks are recomputed.
    ``placed=True``: the stream only reads and maps files or offsets (``post_stream``), so a batch read again has the same rows in the
    same places.  Then it is not persisted, each action parses it again, and its texts take no disk.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if not placed:
            batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                fn(batch, batch_id)
        finally:
            if not placed:
                batch.unpersist()
    return _writer(df, name, mode, trigger, checkpoint).foreachBatch(run).start()


def to_table(df: DataFrame, name: str, mode: str = "append", trigger: dict | None = None,
             checkpoint: str | None = None, *, fmt: str, path: str | None = None,
             partition_by: Iterable[str] | None = None, options: dict | None = None) -> StreamingQuery:
    """A named, queryable result in a format that has to be named.

    ``fmt="parquet"`` (or any file format) appends to ``path``, which it needs;
    ``fmt="table"`` appends to the catalog table ``name``; ``fmt="memory"`` keeps the
    result in the driver (for tests: it is not fault tolerant and grows with the
    output).  Complete mode needs ``memory`` or ``write_complete``.
    """
    if fmt not in ("table", "memory") and not path:
        raise ValueError(f"a {fmt} table needs a path")
    w = _writer(df, name, mode, trigger, checkpoint).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "table":
        return w.toTable(name)
    w = w.format(fmt)
    return w.start(path) if path else w.start()


def console(df: DataFrame, name: str, mode: str = "complete", rows: int = CONSOLE_ROWS,
            trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Print each result: ``rows`` rows, no truncation (the windowed script's console)."""
    return (_writer(df, name, mode, trigger, checkpoint).format("console")
            .option("numRows", rows).option("truncate", False).start())


def write_complete(df: DataFrame, path: str, name: str, trigger: dict | None = None,
                   checkpoint: str | None = None) -> StreamingQuery:
    """Complete-mode result kept as a table: batch ``b`` writes ``path/version=b`` whole, and
    ``read_complete`` reads the newest finished version, so readers never see a
    missing or half-written table.  The version before the newest is kept, older ones go."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        for old in _finished(df.sparkSession, path, "version")[:-2]:
            _delete(df.sparkSession, f"{path}/version={old}")
    return _writer(df, name, "complete", trigger, checkpoint).foreachBatch(run).start()


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version of a ``write_complete`` table."""
    versions = _finished(spark, path, "version")
    if not versions:
        raise ValueError(f"no finished version under {path}")
    return spark.read.parquet(f"{path}/version={versions[-1]}")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _finished(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers of the ``column=<n>`` folders under ``path`` whose write has finished, ascending."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    names = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p)]
    return sorted(int(n.split("=")[1]) for n, full in names if n.startswith(f"{column}=")
                  and fs.exists(_fs(spark, f"{full}/_SUCCESS")[1]))


def write_updates(df: DataFrame, path: str, name: str, trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Update-mode result as a table: the rows changed by batch ``b`` go to
    ``path/batch=b`` (overwritten on replay).  Read with ``read_updates``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)     # two actions, one pass through the state
        try:
            if not batch.isEmpty():
                batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()
    return _writer(df, name, "update", trigger, checkpoint).foreachBatch(run).start()


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest value per key of a ``write_updates`` table (``max_by`` on the batch id,
    an aggregate with a partial step per task: no key is gathered whole).  The folders are the newest finished fold
    and the finished batches after it."""
    df = _live(spark, path)
    if df is None:
        raise ValueError(f"no finished batch under {path}")
    cols = [c for c in df.columns if c != "batch" and c not in keys]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*cols), F.col("batch")).alias("_v"))
            .select(*keys, "_v.*"))


def _folds(path: str) -> str:
    return f"{path}/_folds"


def _live(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    folds = [f for f in _finished(spark, _folds(path), "upto") if upto is None or f <= upto]
    batches = [b for b in _finished(spark, path, "batch") if (not folds or b > folds[-1]) and (upto is None or b <= upto)]
    parts = [spark.read.parquet(f"{_folds(path)}/upto={folds[-1]}")] if folds else []
    if batches:
        parts.append(spark.read.option("basePath", path).parquet(*[f"{path}/batch={b}" for b in batches]))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def fold_updates(spark: SparkSession, path: str, keys: list[str], upto: int) -> None:
    """Fold the batches up to ``upto`` of a ``write_updates`` table into one folder with the newest value
    per key, so the number of folders stays bounded.  Run it as maintenance, for batches no
    replay can touch any more.

    The fold counts from the moment its ``_SUCCESS`` file is there, which is the last thing written, and what it replaces goes
    only with the next fold: a reader that has listed its folders before finds them all.  An interrupted fold is written anew by
    the next call."""
    old = _finished(spark, _folds(path), "upto")
    batches = [b for b in _finished(spark, path, "batch") if b <= upto]
    if not [b for b in batches if not old or b > old[-1]]:
        return
    upto = batches[-1]
    df = _live(spark, path, upto)
    cols = [c for c in df.columns if c != "batch" and c not in keys]
    row = F.struct(*cols, F.col("batch").cast("int").alias("batch"))
    (df.groupBy(*keys).agg(F.max_by(row, F.col("batch")).alias("_v")).select(*keys, "_v.*")
     .write.mode("overwrite").parquet(f"{_folds(path)}/upto={upto}"))
    for f in old[:-1]:
        _delete(spark, f"{_folds(path)}/upto={f}")
    for b in batches:
        if old and b <= old[-1]:
            _delete(spark, f"{path}/batch={b}")


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the query's state operators have dropped as behind the watermark, over its recent progress."""
    return sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in (p.get("stateOperators") or []))


def stop_all(queries: Iterable[StreamingQuery] | None = None, spark: SparkSession | None = None) -> None:
    """Stop the given queries (or every active query of ``spark``)."""
    qs = list(queries) if queries is not None else (spark.streams.active if spark else [])
    for q in qs:
        if q.isActive:
            q.stop()
