"""Keys that were published on other days, stored so that looking them up does not shuffle them.

The table is bucketed by the key and partitioned by day. An anti join against
it deals only the new rows by the key; the stored side is read bucket by bucket
as it lies. Recording a day replaces that day's keys, so a rerun neither meets
its own keys nor leaves those of an earlier extract behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.dedupe import dedupe_transactions
from riskflow.sources.files import path_exists


class SeenKeys:
    """``table`` in the session catalog over the files under ``root`` (found again by a new session)."""

    def __init__(self, spark: SparkSession, table: str, root: str, key: str = "tx_id", day: str = "ingest_date", buckets: int = 32):
        self.spark, self.table, self.key, self.day, self.buckets = spark, table, key, day, buckets
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (`{key}` STRING, `{day}` DATE) USING parquet PARTITIONED BY (`{day}`) "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{root}'")
        if path_exists(spark, root):
            spark.sql(f"MSCK REPAIR TABLE {table}")

    def record(self, rows: DataFrame) -> None:
        """Store the keys of the days in ``rows`` in place of what these days held: one file per day and bucket."""
        keys = rows.select(F.col(self.key).cast("string"), F.col(self.day).cast("date")).where(F.col(self.key).isNotNull())
        (keys.repartition(self.buckets, self.key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .insertInto(self.table))

    def elsewhere(self, days) -> DataFrame:
        """Keys held by days other than these."""
        return self.spark.table(self.table).where(~F.col(self.day).isin(list(days))).select(self.key)

    def unseen(self, rows: DataFrame, days, event_time: str = "event_ts", tie_breaks=("wallet_id",)) -> DataFrame:
        """Rows of ``days`` reduced to the latest per key, less those whose key another day holds."""
        return dedupe_transactions(rows, self.key, event_time, tie_breaks, against=self.elsewhere(days))
