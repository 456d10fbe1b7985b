"""Run metrics as data, and the alarm rules as queries over them.

Metrics rows: (metric_name, metric_value, metric_date, source, written_at);
names must be in ``METRIC_NAMES`` (a typo would never alarm). The batch job
writes its rows after it has published, the stream one row per micro-batch
(observed while the batch is written). The rules: freshness (age of the last
silver write against an injected now; no metric at all is a breach) and
zero-row days (a day spine left-joined to daily sums; a missing day is a
breach).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.errors import ConfigError
from riskflow.sinks.keyed import KeyedTable

# Metric names the alarms watch, and the alarm limits.
METRIC_NAMES = (
    "silver_rows_written",
    "quarantine_rows_written",
    "silver_age_hours",
    "gold_rows_written",
    "stream_batch_rows",
    "dag_task_duration_seconds",
)
FRESHNESS_LIMIT_HOURS = 26
ZERO_ROW_LIMIT = 1

# ``source`` tells writers of one metric and date apart: "batch", or a stream with the number of its micro-batch.
METRICS_SCHEMA = "metric_name string, metric_value double, metric_date date, source string, written_at timestamp_ntz"


def check_metric_name(name: str) -> str:
    if name not in METRIC_NAMES:
        raise ConfigError(f"unknown metric name {name!r}")
    return name


def metrics_table(spark: SparkSession, root: str) -> KeyedTable:
    """The stored metrics: a writer replaces its own value of a metric and date, and no other."""
    return KeyedTable(spark, root, ["metric_name", "metric_date", "source"], "metric_date", buckets=1)


def metric_rows(per_date: DataFrame, names, written_at: _dt.datetime | None = None, source: str = "batch") -> DataFrame:
    """Metric rows of a frame (metric_date, one column per metric name); a missing value is no row.

    ``written_at`` is the time of the run unless given.
    """
    stamp = F.lit(written_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).cast("timestamp_ntz")
    pairs = F.array(*[F.struct(F.lit(check_metric_name(n)).alias("metric_name"), F.col(n).cast("double").alias("metric_value"))
                      for n in names])
    return (per_date.select(F.explode(pairs).alias("m"), "metric_date")
            .select("m.*", "metric_date", F.lit(source).alias("source"), stamp.alias("written_at")).where("metric_value IS NOT NULL"))


def daily_trend(metrics: DataFrame) -> DataFrame:
    """(metric_date, silver_rows, quarantine_rows) per day."""
    return metrics.groupBy("metric_date").agg(
        F.sum(F.when(F.col("metric_name") == "silver_rows_written", F.col("metric_value"))).cast("long")
        .alias("silver_rows"),
        F.sum(F.when(F.col("metric_name") == "quarantine_rows_written", F.col("metric_value"))).cast("long")
        .alias("quarantine_rows"),
    )


def freshness(metrics: DataFrame, now: _dt.datetime, metric: str = "silver_rows_written",
              limit_hours: float = FRESHNESS_LIMIT_HOURS) -> DataFrame:
    """One row: last_written_at, age_hours, breach (no metric counts as a breach)."""
    last = metrics.where(F.col("metric_name") == metric).agg(F.max("written_at").alias("last_written_at"))
    now_lit = F.lit(now).cast("timestamp_ntz")
    age = (F.unix_micros(now_lit.cast("timestamp")) - F.unix_micros(F.col("last_written_at").cast("timestamp"))) \
        / F.lit(3_600_000_000.0)
    return last.select(
        now_lit.alias("checked_at"),
        "last_written_at",
        F.round(age, 3).alias("age_hours"),
        F.coalesce(age > F.lit(float(limit_hours)), F.lit(True)).alias("breach"),
    )


def zero_row_days(metrics: DataFrame, until: _dt.date, metric: str = "silver_rows_written",
                  limit: float = ZERO_ROW_LIMIT, since: _dt.date | None = None) -> DataFrame:
    """(day, rows, breach) for every day from ``since`` to ``until``.

    Without ``since`` the days begin with the first metric day; with it, days
    are breaches even where no metric was ever written.
    """
    m = metrics.where(F.col("metric_name") == metric)
    daily = m.groupBy(F.col("metric_date").alias("day")).agg(F.sum("metric_value").alias("rows"))
    first = F.min("metric_date") if since is None else F.lit(since).cast("date")
    spine = m.agg(F.count(F.lit(1)), first.alias("d0")).select(
        F.explode(F.sequence(F.col("d0"), F.lit(until).cast("date"))).alias("day")
    )
    return spine.join(daily, "day", "left").select(
        "day",
        F.coalesce(F.col("rows"), F.lit(0.0)).cast("long").alias("rows"),
        (F.coalesce(F.col("rows"), F.lit(0.0)) < F.lit(float(limit))).alias("breach"),
    )
