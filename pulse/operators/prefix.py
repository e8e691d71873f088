"""Running values over an ordered sequence without one global (or one hot) partition.

A window ``partitionBy(p).orderBy(o).rowsBetween(unboundedPreceding, ...)`` puts a
whole partition in one task; when ``p`` is empty, or one value of ``p`` holds a
third of the rows, that task holds all of it.  Here the sequence is cut into
blocks by a column that never decreases along the order (an arrival range, a
minute, a day, or ``equal_depth``'s blocks of a set number of rows).  Running values are then

    carry-in of the block  (a running value over the small per-block aggregate)
  + running value inside the block  (a window partitioned by (p, block))

so each task holds one block, and only one row per block is ever windowed
across blocks.  The carry table is joined back on (p, block), null partition
values and blocks included; AQE makes that a broadcast when it is small at run
time.

The block totals are a second, narrow pass over the input (only ``partition``,
``block`` and ``value`` are read).  Over stored tables that is a column-pruned
scan; hand in a stored table where the input is costly to compute.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.session import stored

BLOCK_ROWS = 200_000      # rows of an equal-depth block, about

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    if how == "max":
        return F.greatest(a, b)
    return F.least(a, b)


def equal_depth(df: DataFrame, order: list, partition: list[str] | None = None, rows: int = BLOCK_ROWS,
                out: str = "_depth") -> DataFrame:
    """``df`` with ``out``, a block number for ``running``: blocks of about ``rows`` rows (never twice as many, but for what
    sampling misses), however the order's values are spread.

    The edges are the quantiles that Spark samples for a range partitioning of ``partition`` and ``order`` (a total order), so a
    burst gets as many blocks as it has rows for.  The numbered rows are a stored table, so every later pass sees the same
    edges.  Up to ``rows`` rows are one block, without a table of their own."""
    total = df.count()
    if total <= rows:
        return df.withColumn(out, F.lit(0))
    by = [F.col(p).asc_nulls_first() for p in partition or []] + [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    parts = -(-4 * total // (3 * rows))         # a third more than needed, as sampled edges are not exact
    return stored(df.repartitionByRange(parts, *by).withColumn(out, F.spark_partition_id()), "blocks")


def running(df: DataFrame, value: Column | str, how: str, order: list, block: Column | str,
            partition: list[str] | None = None, inclusive: bool = True, out: str = "running") -> DataFrame:
    """Add ``out`` = running ``how`` (sum | max | min | count) of ``value`` along
    ``order`` within ``partition``; ``inclusive`` includes the current row.

    ``block`` must be non-decreasing along ``order`` within a partition (null first); ``order``
    must be a total order (add a unique tie-break).  ``how="count"`` counts rows
    (``value`` ignored).
    """
    partition = list(partition or [])
    value_c = F.lit(1) if how == "count" else (F.col(value) if isinstance(value, str) else value)
    agg = "sum" if how == "count" else how
    block_c = F.col(block) if isinstance(block, str) else block

    base = df.withColumn("_blk", block_c).withColumn("_val", value_c)

    # running value inside each block (one shuffle of the rows, on (partition, block))
    within = (Window.partitionBy(*partition, "_blk").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    rows = base.withColumn("_in", _AGG[agg]("_val").over(within))
    per_block = base.groupBy(*partition, "_blk").agg(_AGG[agg]("_val").alias("_bagg"))
    across = Window.orderBy(F.col("_blk").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    if partition:
        across = across.partitionBy(*partition)
    names = [f"_p{i}" for i in range(len(partition))]
    carry = per_block.select(*[F.col(p).alias(n) for p, n in zip(partition, names)], F.col("_blk").alias("_cblk"),
                             _AGG[agg]("_bagg").over(across).alias("_carry"))

    # null partition values and blocks carry like any other
    on = F.col("_blk").eqNullSafe(F.col("_cblk"))
    for p, n in zip(partition, names):
        on = on & F.col(p).eqNullSafe(F.col(n))
    joined = rows.join(carry, on, "left").drop("_cblk", *names)
    result = _combine(agg, F.col("_carry"), F.col("_in"))
    if how == "count":
        result = result.cast("long")
    return joined.withColumn(out, result).drop("_blk", "_val", "_in", "_carry")
