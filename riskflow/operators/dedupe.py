"""Keep one row per key: the first by a total order.

Written as ``row_number() over (partition by key order by ...) = 1``. Spark
plans this with a *partial* WindowGroupLimit before the shuffle, so each map
task already keeps only its best row per key; a key holding a third of all
rows ships at most one row per input partition, never the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_rf_rn"


def _as_order(order) -> list:
    out = []
    for o in order:
        out.append(F.col(o) if isinstance(o, str) else o)
    return out


def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (list of Columns/names)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*_as_order(order))
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def dedupe_transactions(
    df: DataFrame,
    key: str = "tx_id",
    event_time: str = "event_ts",
    tie_breaks=("wallet_id",),
    against: DataFrame | None = None,
) -> DataFrame:
    """Latest ``event_time`` per key; ties by ``tie_breaks`` ascending.

    ``against``: already-published rows; keys present there are dropped
    (global uniqueness across days, decision D8). Off by default, as the
    daily job dedupes within one day's batch.
    """
    order = [F.col(event_time).desc()] + [F.col(c).asc() for c in tie_breaks]
    out = latest_per_key(df, [key], order)
    if against is not None:
        out = out.join(against.select(key).distinct(), key, "left_anti")
    return out


def collapse_upsert_keys(df: DataFrame, keys=("wallet_id", "window_start"), order: list | None = None) -> DataFrame:
    """One row per upsert key so a MERGE can never match twice.

    Default order keeps the highest ``tx_count``; the remaining columns break
    ties so reruns keep the same row.
    """
    if order is None:
        order = [F.col("tx_count").desc(), F.col("total_value").desc(), F.col("max_single_value").desc()]
    return latest_per_key(df, list(keys), order)
