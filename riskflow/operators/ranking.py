"""Positions and prefix sums in a global order, without one task seeing all rows.

A global ``row_number()`` or a running sum over an un-partitioned window
pulls every row into one task. Here the rows are range-partitioned on the
order, sorted inside each partition, tagged with partition id and
in-partition index, and written once as a table in the shared checkpoint
folder (so every later pass sees the same layout; range bounds come from
sampling). Then:

  * per-partition counts/sums are a tiny table (one row per partition);
  * exclusive offsets over that table are a window over <= P rows;
  * a row's position = offset of its partition + its index inside it, where
    the index comes from ``monotonically_increasing_id`` (partition id in
    the upper bits, row index in the lower 33 bits), computed in the same
    stage as the sort - no extra shuffle.

The order must be total (add a unique key as the last column) for results
to be deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.session import default_parallelism, ensure_checkpoint_dir, materialize

PID, MID, LOCAL = "_rf_pid", "_rf_mid", "_rf_local"


def _cols(order):
    return [F.col(o) if isinstance(o, str) else o for o in order]


def range_layout(df: DataFrame, order, partitions: int | None = None) -> DataFrame:
    """Range-partition + sort within partitions, materialized once; adds pid and local index."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or default_parallelism(spark)
    order = _cols(order)
    laid = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn(PID, F.spark_partition_id())
        .withColumn(MID, F.monotonically_increasing_id())
        .withColumn(LOCAL, F.col(MID) - F.shiftleft(F.col(PID).cast("long"), 33))
        .drop(MID)
    )
    # Partition id and in-partition index become data, so nothing later depends
    # on how the written table is split when read back.
    return materialize(laid, "range-layout")


def _exclusive_offsets(per_part: DataFrame, cols) -> DataFrame:
    w = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)  # <= P rows
    return per_part.select(PID, *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"_off_{c}") for c in cols])


def global_positions(df: DataFrame, order, pos_col: str = "position", partitions: int | None = None,
                     with_total: bool = False):
    """Adds ``pos_col``: the 0-based position of each row in ``order``.

    ``with_total``: also return the row count (read from the per-partition counts).
    """
    laid = range_layout(df, order, partitions)
    counts = materialize(laid.groupBy(PID).agg(F.count(F.lit(1)).alias("_n")), "range-counts")  # <= P rows
    offsets = _exclusive_offsets(counts, ["_n"])
    out = (
        laid.join(F.broadcast(offsets), PID, "inner")  # one row per partition
        .withColumn(pos_col, F.col("_off__n") + F.col(LOCAL))
        .drop(PID, LOCAL, "_off__n")
    )
    if not with_total:
        return out
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return out, int(total)


def running_sums(df: DataFrame, order, cols, prefix: str = "cum_", partitions: int | None = None) -> DataFrame:
    """Adds inclusive prefix sums ``cum_<c>`` of ``cols`` in ``order``."""
    laid = range_layout(df, order, partitions)
    totals = laid.groupBy(PID).agg(*[F.sum(c).alias(c) for c in cols])
    offsets = _exclusive_offsets(totals, cols)
    within = Window.partitionBy(PID).orderBy(LOCAL).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = laid.join(F.broadcast(offsets), PID, "inner")
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_off_{c}") + F.sum(c).over(within))
    return out.drop(PID, LOCAL, *[f"_off_{c}" for c in cols])


def group_positions(df: DataFrame, groups, order, pos_col: str = "position", partitions: int | None = None
                    ) -> DataFrame:
    """Adds ``pos_col``: 1-based position of each row inside its group under ``order``.

    Same result as ``row_number() over (partition by groups order by order)``
    but a group larger than one partition is spread over several tasks.
    """
    groups = [groups] if isinstance(groups, str) else list(groups)
    laid = range_layout(df, [*groups, *_cols(order)], partitions)
    blocks = laid.groupBy(PID, *groups).agg(F.min(LOCAL).alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*groups).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)  # <= P rows per group
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    blocks = materialize(blocks, "group-blocks")
    return (
        laid.join(blocks, [PID, *groups], "inner")
        .withColumn(pos_col, F.col("_before") + (F.col(LOCAL) - F.col("_first")) + F.lit(1))
        .drop(PID, LOCAL, "_first", "_before")
    )
