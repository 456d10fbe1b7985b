"""Writers: partition overwrite, catalog registration, SCD2 batch tables, keyed upsert.

All writes go through Spark's writer API. Reruns are safe:
  * ``overwrite_partitions`` replaces exactly the partitions present in the
    frame (dynamic overwrite), so landing a date twice gives the same rows and
    leaves other dates alone;
  * ``Scd2Table`` writes each applied batch's closed and current rows under
    ``batch=<id>``; a rerun of a batch overwrites the same folders;
  * ``upsert_frame`` is the pure form of a keyed upsert; stored tables take
    upserts as appends (``sinks.keyed``).

Single writer per table is assumed (as for any file table without a lock).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskflow.errors import ConfigError
from riskflow.session import materialize
from riskflow.sources.files import list_dirs, partition_value, remove


def overwrite_partitions(df: DataFrame, root: str, partition_cols, fmt: str = "parquet",
                         rebalance: bool = True, count_rows: bool = False):
    """Replace the partitions present in ``df`` under ``root``; keep all others.

    ``rebalance``: shuffle rows by the partition columns first (REBALANCE hint), so
    each date gets a few right-sized files instead of one file per task and date;
    AQE splits a hot date over several tasks and merges small ones.
    ``count_rows``: return the number of rows written, observed during the write
    (no second pass). The observer sits above the rebalance so an empty input,
    which AQE collapses, still reports 0.
    """
    cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
    if rebalance:
        df = df.hint("rebalance", *cols)
    obs = None
    if count_rows:
        obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*cols)
        .format(fmt)
        .save(root)
    )
    return int(obs.get["rows"]) if obs is not None else None


def date_or_null(col):
    """The date of a column; NULL where its text is no date."""
    return col.try_cast("date")


def land_partition(df: DataFrame, root: str, logical_date=None, partition_col: str = "ingest_date",
                   date_from: str | None = None) -> str:
    """Land an extract into date partitions; rerun = same result.

    With ``logical_date`` the whole frame lands in that one partition; with
    ``date_from`` each row lands by the date of that column (multi-day backfill
    in one write); rows whose text is no date land in the NULL partition.
    """
    if logical_date is not None:
        out = df.withColumn(partition_col, F.lit(partition_value(logical_date)).cast("date"))
    elif date_from is not None:
        out = df.withColumn(partition_col, date_or_null(F.col(date_from)))
    else:
        raise ValueError("land_partition needs logical_date or date_from")
    overwrite_partitions(out, root, partition_col)
    return root if logical_date is None else f"{root.rstrip('/')}/{partition_col}={partition_value(logical_date)}"


def partition_clause(value, partition_col: str) -> str:
    """``PARTITION (...)`` of one value; None is the NULL partition."""
    return f"PARTITION ({partition_col} = {'NULL' if value is None else repr(partition_value(value))})"


def register_partitions(spark: SparkSession, table: str, locations: dict, partition_col: str = "ingest_date") -> None:
    """Add the partitions of ``{value: location}`` to a catalog table by one statement; existing ones are fine."""
    if locations:
        parts = " ".join(f"{partition_clause(v, partition_col)} LOCATION '{place}'" for v, place in locations.items())
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def register_partition(spark: SparkSession, table: str, logical_date, location: str,
                       partition_col: str = "ingest_date") -> None:
    """Add one partition to a catalog table; an existing partition is fine."""
    register_partitions(spark, table, {logical_date: location}, partition_col)


def create_partitioned_table(spark: SparkSession, table: str, root: str, schema_ddl: str,
                             partition_col: str = "ingest_date") -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({schema_ddl}, {partition_col} DATE) USING parquet "
        f"PARTITIONED BY ({partition_col}) LOCATION '{root}'"
    )


def materialize_view(df: DataFrame, name: str, as_table: bool = False) -> DataFrame:
    """Expose a model as a temp view, or as a table in the session catalog."""
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def upsert_frame(target: DataFrame, updates: DataFrame, keys) -> DataFrame:
    """Insert-or-replace whole rows by ``keys`` (pure DataFrame form)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


class Scd2Table:
    """An SCD2 dimension stored per applied batch, never rewriting history.

    ``<root>/updates/batch=<id>`` that batch's snapshots, one row per key
    ``<root>/closed/batch=<id>``  rows closed by that batch (history grows by appends)
    ``<root>/current/batch=<id>`` the current rows after that batch

    ``apply(updates, batch_id)`` reads only the current rows of the latest
    batch before ``batch_id``, so its cost follows the number of current rows
    and the batch size, not the history. Closed rows are written first; a
    batch counts as committed once its current folder exists. Rerunning a
    batch id recomputes from the same predecessor and overwrites the same
    folders, so reruns are idempotent. Batch ids must sort in apply order
    (e.g. ISO dates or zero-padded numbers).

    A committed batch always stands on the committed ones before it: where an
    older batch comes late, or its rerun leaves other current rows than
    before, the later batches are uncommitted first and folded again from
    their stored snapshots. An interrupted run is taken up by the next
    ``apply``. To rewrite a long history use ``scd2_rebuild``: here every
    changed batch costs one step per later batch.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "wallet_id", attrs=("risk_tier",)):
        self.spark, self.root = spark, root.rstrip("/")
        self.key, self.attrs = key, tuple(attrs)

    def _ids(self, kind: str) -> list:
        return sorted(n.split("=", 1)[1] for n in list_dirs(self.spark, f"{self.root}/{kind}")
                      if n.startswith("batch="))

    def batches(self) -> list:
        return self._ids("current")

    def _schema(self):
        from riskflow.operators.scd2 import empty_dimension

        return empty_dimension(self.spark, self.key, self.attrs).schema

    def _current(self, before: str | None = None) -> DataFrame:
        from riskflow.operators.scd2 import empty_dimension

        ids = [b for b in self.batches() if before is None or b < before]
        if not ids:
            return empty_dimension(self.spark, self.key, self.attrs)
        return self.spark.read.schema(self._schema()).parquet(f"{self.root}/current/batch={ids[-1]}")

    def read(self, as_of: str | None = None) -> DataFrame:
        """Full dimension (history + current) as of the latest committed batch <= ``as_of``.

        One scan of the closed rows (batch folders pruned by ``batch <= last``)
        plus the current rows of the last committed batch.
        """
        from pyspark.sql import types as T

        ids = [b for b in self.batches() if as_of is None or b <= as_of]
        if not ids:
            from riskflow.operators.scd2 import empty_dimension

            return empty_dimension(self.spark, self.key, self.attrs)
        last = ids[-1]
        cur = self.spark.read.schema(self._schema()).parquet(f"{self.root}/current/batch={last}")
        if not self._ids("closed"):
            return cur
        with_batch = T.StructType(self._schema().fields + [T.StructField("batch", T.StringType())])
        closed = (
            self.spark.read.schema(with_batch).parquet(f"{self.root}/closed")
            .where(F.col("batch") <= F.lit(last))
            .drop("batch")
        )
        return cur.unionByName(closed)

    def apply(self, updates: DataFrame, batch_id: str, ts: str = "snapshot_ts", tie: str | None = None) -> None:
        from riskflow.operators.scd2 import VALID_FROM, latest_snapshots

        lost = [b for b in self.batches() if b > batch_id and b not in self._ids("updates")]
        if lost:
            raise ConfigError(f"batches {lost} hold no snapshots to fold again after {batch_id}")
        reduced = latest_snapshots(updates.where(F.col(self.key).isNotNull()), [self.key], ts, tie)
        reduced.select(self.key, *self.attrs, F.col(ts).cast(self._schema()[VALID_FROM].dataType).alias(VALID_FROM)) \
            .write.mode("overwrite").parquet(f"{self.root}/updates/batch={batch_id}")
        for b in self._ids("updates"):  # one step each for this batch and those not committed
            if b == batch_id or b not in self.batches():
                self._fold(b)

    def _fold(self, batch_id: str) -> None:
        from riskflow.operators.scd2 import IS_CURRENT, VALID_FROM, scd2_step

        schema = self._schema()
        fields = [schema[c] for c in (self.key, *self.attrs, VALID_FROM)]
        updates = self.spark.read.schema(type(schema)(fields)).parquet(f"{self.root}/updates/batch={batch_id}")
        updates = updates.withColumnRenamed(VALID_FROM, "snapshot_ts")
        step = scd2_step(self._current(before=batch_id), updates, self.key, self.attrs, reduced=True)
        step = materialize(step, "scd2-step")  # one computation feeds both writes
        later = [b for b in self.batches() if b > batch_id]
        if later and self._moved(batch_id, step.where(F.col(IS_CURRENT))):
            for b in reversed(later):
                remove(self.spark, f"{self.root}/current/batch={b}")
        step.where(~F.col(IS_CURRENT)).write.mode("overwrite").parquet(f"{self.root}/closed/batch={batch_id}")
        step.where(F.col(IS_CURRENT)).write.mode("overwrite").parquet(f"{self.root}/current/batch={batch_id}")

    def _moved(self, batch_id: str, current: DataFrame) -> bool:
        """Whether the batch's committed current rows, if any, differ from ``current``."""
        if batch_id not in self.batches():
            return True
        held = self.spark.read.schema(self._schema()).parquet(f"{self.root}/current/batch={batch_id}")
        both = held.withColumn("_n", F.lit(1)).unionByName(current.withColumn("_n", F.lit(-1)))
        return not both.groupBy(*held.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0").isEmpty()
