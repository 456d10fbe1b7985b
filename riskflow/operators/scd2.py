"""Type-2 slowly changing dimension and the point-in-time join.

Dimension rows: (key, attrs..., valid_from, valid_to, is_current); the open
row has valid_to NULL. Ranges are half open: [valid_from, valid_to).

``scd2_apply``: one batch of snapshots in a single pass. Only current rows
meet the batch (one full-outer join on the key, both sides at most one row
per key); each joined row emits 0..2 output rows through one
``explode(array(struct...))``; history rows pass through without a shuffle.

``scd2_rebuild``: the same final state from a whole history of batches in one
job: latest snapshot per (key, batch) -> drop batches whose attributes equal
the previous batch's -> valid_to = next valid_from. Equal to applying the
batches one by one in order (each unchanged batch is a no-op).

Decisions (D6): attributes compare null-safe (``<=>``); a snapshot not newer
than the current row's valid_from is stale and ignored; equal snapshot times
are ordered by an explicit tie column.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.errors import ConfigError
from riskflow.operators.dedupe import latest_per_key
from riskflow.operators.skew import salted_join
from riskflow.session import materialize, scratch_path

VALID_FROM, VALID_TO, IS_CURRENT = "valid_from", "valid_to", "is_current"


def dim_columns(key: str = "wallet_id", attrs=("risk_tier",)) -> list:
    return [key, *attrs, VALID_FROM, VALID_TO, IS_CURRENT]


def empty_dimension(spark: SparkSession, key: str = "wallet_id", attrs=("risk_tier",),
                    ts_type: T.DataType = T.TimestampNTZType()) -> DataFrame:
    schema = T.StructType(
        [T.StructField(key, T.StringType())]
        + [T.StructField(a, T.StringType()) for a in attrs]
        + [
            T.StructField(VALID_FROM, ts_type),
            T.StructField(VALID_TO, ts_type),
            T.StructField(IS_CURRENT, T.BooleanType()),
        ]
    )
    return spark.createDataFrame([], schema)


def latest_snapshots(updates: DataFrame, keys, ts: str = "snapshot_ts", tie: str | None = None) -> DataFrame:
    """Latest snapshot per ``keys`` (ties: ``tie`` descending)."""
    order = [F.col(ts).desc_nulls_last()] + ([F.col(tie).desc_nulls_last()] if tie else [])
    return latest_per_key(updates, keys, order)


def scd2_step(current: DataFrame, updates: DataFrame, key: str = "wallet_id", attrs=("risk_tier",),
              ts: str = "snapshot_ts", tie: str | None = None, reduced: bool = False) -> DataFrame:
    """Rows emitted by one batch against the *current* rows only.

    Output: kept current rows, rows closed by the batch (is_current false) and
    rows opened by it. ``reduced``: updates already hold one row per key.
    """
    attrs = list(attrs)
    cols = dim_columns(key, attrs)
    ts_type = dict(current.dtypes)[VALID_FROM]
    upd = updates.where(F.col(key).isNotNull())
    if not reduced:
        upd = latest_snapshots(upd, [key], ts, tie)
    cur = current.where(F.col(IS_CURRENT)).select(*cols, F.lit(True).alias("_c"))
    u = upd.select(key, *[F.col(a).alias(f"_u_{a}") for a in attrs], F.col(ts).cast(ts_type).alias("_u_ts"),
                   F.lit(True).alias("_u"))
    j = cur.join(u, key, "full_outer")

    has_c = F.coalesce(F.col("_c"), F.lit(False))
    has_u = F.coalesce(F.col("_u"), F.lit(False))
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.col(f"_u_{a}"))
    stale = F.coalesce(F.col("_u_ts") <= F.col(VALID_FROM), F.lit(False))
    keep = has_c & (~has_u | same | stale)
    change = has_c & has_u & ~same & ~stale
    brand_new = ~has_c & has_u

    def row(attr_cols, vf, vt, cur_flag):
        return F.struct(
            *[c.alias(a) for c, a in zip(attr_cols, attrs)],
            vf.alias(VALID_FROM),
            vt.alias(VALID_TO),
            F.lit(cur_flag).alias(IS_CURRENT),
        )

    null_ts = F.lit(None).cast(ts_type)
    kept_row = F.struct(*[F.col(a).alias(a) for a in attrs], F.col(VALID_FROM), F.col(VALID_TO), F.col(IS_CURRENT))
    closed_row = row([F.col(a) for a in attrs], F.col(VALID_FROM), F.col("_u_ts"), False)
    opened_row = row([F.col(f"_u_{a}") for a in attrs], F.col("_u_ts"), null_ts, True)
    emitted = (
        F.when(keep, F.array(kept_row))
        .when(change, F.array(closed_row, opened_row))
        .when(brand_new, F.array(opened_row))
    )
    return j.select(key, F.explode(emitted).alias("_r")).select(key, "_r.*").select(*cols)


def scd2_apply(dims: DataFrame, updates: DataFrame, key: str = "wallet_id", attrs=("risk_tier",),
               ts: str = "snapshot_ts", tie: str | None = None) -> DataFrame:
    """New full state of the dimension after one batch of snapshots."""
    cols = dim_columns(key, list(attrs))
    hist = dims.where(~F.col(IS_CURRENT)).select(*cols)
    return hist.unionByName(scd2_step(dims, updates, key, attrs, ts, tie))


def scd2_apply_batches(dims: DataFrame, updates: DataFrame, batch_col: str, key: str = "wallet_id",
                       attrs=("risk_tier",), ts: str = "snapshot_ts", tie: str | None = None) -> DataFrame:
    """Apply batches in ``batch_col`` order; equal to calling ``scd2_apply`` once per batch.

    Updates are reduced to one row per (key, batch) in one job and written
    partitioned by batch, so each step reads only its own batch. Each step
    meets only the current rows and is written to ``_batch=<b>`` of one steps
    table (lineage cut per batch); closed rows never re-enter later steps.
    The result is one scan of that table: every closed row, plus the current
    rows of the last batch. Only the distinct batch ids reach the driver.
    """
    spark = dims.sparkSession
    cols = dim_columns(key, list(attrs))
    reduced = latest_snapshots(updates.where(F.col(key).isNotNull()), [key, batch_col], ts, tie)
    reduced = materialize(reduced, "scd2-reduced", partition_by=batch_col)
    batches = [r[0] for r in reduced.select(batch_col).distinct().orderBy(batch_col).collect()]
    history = dims.where(~F.col(IS_CURRENT)).select(*cols)
    if not batches:
        return dims.select(*cols)
    dim_schema = dims.select(*cols).schema
    root = scratch_path(spark, "scd2-steps")
    current = dims.where(F.col(IS_CURRENT)).select(*cols)
    for b in batches:
        step = scd2_step(current, reduced.where(F.col(batch_col) == F.lit(b)), key, attrs, ts, tie, reduced=True)
        step.write.mode("overwrite").parquet(f"{root}/_batch={b}")
        current = spark.read.schema(dim_schema).parquet(f"{root}/_batch={b}").where(F.col(IS_CURRENT))
    steps_schema = T.StructType(dim_schema.fields + [T.StructField("_batch", reduced.schema[batch_col].dataType)])
    steps = spark.read.schema(steps_schema).parquet(root)
    last = F.lit(batches[-1]).cast(reduced.schema[batch_col].dataType)
    final = steps.where(~F.col(IS_CURRENT) | (F.col("_batch") == last)).select(*cols)
    return history.unionByName(final)


def scd2_rebuild(updates: DataFrame, batch_col: str, key: str = "wallet_id", attrs=("risk_tier",),
                 ts: str = "snapshot_ts", tie: str | None = None) -> DataFrame:
    """Final dimension from all batches at once (no per-batch rewrite), equal to applying them in order.

    Every (key, batch) is first reduced to one row; a key's rows are then folded
    in batch order with the rule of ``scd2_step``: a snapshot opens a version if
    its attributes differ from the open one's and it is newer. A key's array
    holds at most one entry per batch.
    """
    attrs = list(attrs)
    latest = latest_snapshots(updates.where(F.col(key).isNotNull()), [key, batch_col], ts, tie)
    entry = F.struct(F.col(batch_col).alias("batch"), F.col(ts).alias("since"), F.struct(*attrs).alias("attrs"))
    per_key = latest.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("_seen"))

    def fold(versions, x):
        last = F.get(versions, F.size(versions) - 1)
        stale = F.coalesce(x["since"] <= last["since"], F.lit(False))
        opens = (F.size(versions) == 0) | (~x["attrs"].eqNullSafe(last["attrs"]) & ~stale)
        return F.when(opens, F.concat(versions, F.array(x))).otherwise(versions)

    versions = per_key.withColumn("_kept", F.aggregate("_seen", F.slice("_seen", 1, 0), fold))
    rows = versions.select(key, "_kept", F.posexplode("_kept").alias("_at", "_v"))
    return rows.select(
        key,
        *[F.col(f"_v.attrs.{a}").alias(a) for a in attrs],
        F.col("_v.since").alias(VALID_FROM),
        F.get("_kept", F.col("_at") + 1)["since"].alias(VALID_TO),
        (F.col("_at") == F.size("_kept") - 1).alias(IS_CURRENT),
    )


def time_range(rows: DataFrame, ts: str = "event_ts") -> DataFrame:
    """One row (first, last) of a time column; over a Parquet scan the footers answer it."""
    return rows.agg(F.min(ts).alias("first"), F.max(ts).alias("last"))


# Bins of rows without a time lie far below any real one.
_NO_TIME = 1 << 40
_NO_TIME_BINS = 1 << 16


def _bin(ts: Column, width: dt.timedelta) -> Column:
    """Number of the time bin: monotonic in time, so a version covers all bins from its first to its last."""
    micros, step = F.unix_micros(ts.cast("timestamp")), F.lit(width // dt.timedelta(microseconds=1)).cast("long")
    return F.call_function("div", micros - F.pmod(micros, step), step)


def _binned_join(facts: DataFrame, versions: DataFrame, key: str, ts: str, cond, width: dt.timedelta, span: DataFrame) -> DataFrame:
    first, last = span.first()
    if first is None:  # no fact has a time, so none meets a version
        first = last = dt.datetime(1970, 1, 1)
        versions = versions.where(F.lit(False))
    kind = dict(versions.dtypes)[VALID_FROM]
    first, last = (F.lit(t).cast(kind) for t in (first, last))
    end = F.least(F.coalesce(F.col(VALID_TO), last), last)
    low, high = _bin(F.greatest(F.col(VALID_FROM), first), width), _bin(end, width)
    covered = versions.where((F.col(VALID_FROM) <= last) & (end >= first)).withColumn(
        "_bin", F.explode(F.when(low <= high, F.sequence(low, high))))
    spread = -F.lit(_NO_TIME) - F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(_NO_TIME_BINS))
    binned = facts.withColumn("_bin", F.coalesce(_bin(F.col(ts), width), spread))
    f, d = binned.alias("_f"), covered.hint("shuffle_hash").alias("_d")  # its size is not that of the versions: never broadcast
    on = (F.col(f"_f.{key}") == F.col(f"_d.{key}")) & (F.col("_f._bin") == F.col("_d._bin")) & cond("_f", "_d")
    return f.join(d, on, "left").select(*[F.col(f"_f.{c}") for c in facts.columns],
                                        *[F.col(f"_d.{c}") for c in versions.columns if c != key])


def _keyed_join(facts: DataFrame, versions: DataFrame, key: str, cond) -> DataFrame:
    # An expression of the key: the versions are dealt by the join itself, whatever they were dealt by before.
    dealt = F.greatest(F.col(f"_d.{key}"), F.col(f"_d.{key}"))
    f, d = facts.alias("_f"), versions.hint("shuffle_hash").alias("_d")
    return f.join(d, (F.col(f"_f.{key}") == dealt) & cond("_f", "_d"), "left").select(
        *[F.col(f"_f.{c}") for c in facts.columns], *[F.col(f"_d.{c}") for c in versions.columns if c != key])


def point_in_time_join(facts: DataFrame, dims: DataFrame, key: str = "wallet_id", ts: str = "event_ts",
                       attrs=("risk_tier",), rename: dict | None = None, skew_min_rows: int | None = None,
                       skew_share: float | None = None, bin_width: dt.timedelta | None = None,
                       span: DataFrame | None = None) -> DataFrame:
    """Left join each fact to the dimension version valid at its event time.

    Condition: same key, ``valid_from <= ts`` and (``valid_to`` NULL or
    ``ts < valid_to``). Facts without a version keep NULL attributes.

    ``bin_width``: join on (key, time bin) with the range as a residual. A
    version is copied to every bin of this width that it covers between the
    first and the last fact (``span``, else found from the facts; both ends may
    also lie further out), so a key's copies are at most its versions plus the
    bins. A hot key is dealt over its bins without being counted first. Facts
    without a time meet no version and are spread by their hash. Meant for few
    keys over many bins: the copies are keys times bins.

    Without it the join is on the key alone: each version is sent once, to one
    task per share of its key and never to the driver, and the facts are not
    sorted. Both sides are exchanges of the join's own, so AQE splits a hot
    key's facts. With ``skew_min_rows`` (or ``skew_share`` of all facts) hot
    keys are salted first (see operators.skew).
    """
    rename = rename or {}
    d = dims.select(key, *attrs, VALID_FROM, VALID_TO)

    def cond(b, s):
        t = F.col(f"{b}.{ts}")
        return (t >= F.col(f"{s}.{VALID_FROM}")) & (F.col(f"{s}.{VALID_TO}").isNull() | (t < F.col(f"{s}.{VALID_TO}")))

    if bin_width is not None:
        if bin_width <= dt.timedelta(0):
            raise ConfigError("bin_width must be positive")
        out = _binned_join(facts, d, key, ts, cond, bin_width, span if span is not None else time_range(facts, ts))
    elif skew_min_rows or skew_share:
        out = salted_join(facts, d, [key], "left", cond, min_rows=skew_min_rows, share=skew_share)
    else:
        out = _keyed_join(facts, d, key, cond)
    out = out.drop(VALID_FROM, VALID_TO)
    for a, new in rename.items():
        out = out.withColumnRenamed(a, new)
    return out
