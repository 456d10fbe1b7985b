"""Jobs composed from the operators: daily batch (write-audit-publish), backfill, stream.

``run_batch``: land -> audit (halt) -> silver + quarantine -> SCD2 dimension ->
point-in-time fact -> table tests (halt) -> day states -> feature mart ->
publish -> run metrics. Tables are staged in folders of the run and published
together by one switch (``sinks.lake``): a run that fails anywhere leaves the
old tables whole, and a rerun of the same dates replaces them and leaves other
dates alone. With ``logical_date=None`` one run covers every date in the extract
(one pass per stage instead of one job per day).

Lake layout under ``lake_root``:
  bronze/transactions/ingest_date=...      landed extract
  _runs/<run>/<table>/...                  staged tables of a run
  _published/<number>                      which staged partitions are visible
  gold/dim_wallet/{updates,closed,current}/batch=  SCD2 dimension, history appended per batch
  ops/run_metrics/                         counts per run, keyed

Published tables (``lake_table``): silver, quarantine, fact (by ingest_date),
wallet_day_states (by ingest_date), wallet_features (the mart, by as_of).
"""

from __future__ import annotations

import datetime as _dt
import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.errors import DataQualityError
from riskflow.operators import checks as K
from riskflow.operators import contract as C
from riskflow.operators import features as FE
from riskflow.operators import opsmetrics as OM
from riskflow.operators import scd2 as S
from riskflow.operators.dedupe import latest_per_key
from riskflow.sinks import tables as TB
from riskflow.sinks.lake import PublishedLake
from riskflow.sources import files as FS

PARTITION = "ingest_date"
MART_PARTITION = "as_of"
SILVER, QUARANTINE, FACT, STATES, MART = "silver", "quarantine", "fact", "wallet_day_states", "wallet_features"


@dataclass
class BatchResult:
    dates: list = field(default_factory=list)
    audit: Row | None = None
    silver_rows: int = 0
    quarantine_rows: int = 0
    fact_rows: int = 0
    mart_rows: int = 0
    dim_version: str | None = None
    published: int = 0
    run: str = ""


class LakePaths:
    def __init__(self, root: str):
        self.root = root.rstrip("/")
        self.bronze = f"{self.root}/bronze/transactions"
        self.dim = f"{self.root}/gold/dim_wallet"
        self.metrics = f"{self.root}/ops/run_metrics"


def _audited(df: DataFrame, contract: C.Contract, now, n_dates: int) -> Row:
    """Audit of a run; the contract's row bound holds for each landed day on its own."""
    if n_dates == 1 or contract.row_count_max is None:
        return C.audit(df, contract, now=now, halt=True)
    report = C.audit(df, replace(contract, row_count_max=None), now=now, halt=True)
    over = df.groupBy(PARTITION).count().where(F.col("count") > contract.row_count_max).orderBy(PARTITION)
    days = [str(r[PARTITION]) for r in over.collect()]  # at most the run's days
    if days:
        raise DataQualityError(f"more than {contract.row_count_max} rows on {', '.join(days)}", report)
    return report


def _table_tests(fact: DataFrame, dim: DataFrame) -> None:
    """Raise if what would be published breaks a table test. Not-null and unique come from one grouped pass."""
    per_key = fact.groupBy("tx_id", PARTITION).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("wallet_id").isNull()).alias("_null_wallet"))
    flags = per_key.agg(
        F.count_if(F.col("tx_id").isNull() | (F.col("_null_wallet") > 0)).alias("nulls"),
        F.count_if(F.col("_n") > 1).alias("dups"),
    ).first()
    failures = []
    if flags["nulls"]:
        failures.append("fact_transaction: NULL tx_id/wallet_id")
    if flags["dups"]:
        failures.append("fact_transaction: tx_id not unique")
    if not K.scd2_breaches(dim).isEmpty():
        failures.append("dim_wallet: overlapping ranges or several current rows")
    if failures:
        raise DataQualityError(f"mart tests failed: {failures}")


def run_batch(spark: SparkSession, extract_path: str, lake_root: str, logical_date=None,
              contract: C.Contract = C.TX_CONTRACT, updates: DataFrame | None = None, now=None,
              fmt: str = "parquet", date_from: str = "event_ts", tie: str | None = "tie",
              written_at: _dt.datetime | None = None, audit_on: str = "raw",
              extract_schema=None, extract_options: dict | None = None, labels: DataFrame | None = None,
              exact_distinct: bool = False) -> BatchResult:
    """``audit_on``: 'raw' audits the landed rows (duplicates/negatives halt the day, as the
    original job does); 'silver' audits what would be published, after quarantine and dedupe.
    ``fmt`` / ``extract_schema`` / ``extract_options``: how the raw extract is read (an explicit
    schema avoids an inference pass over text extracts).
    ``labels`` (tx_id, fraud_label) and ``exact_distinct`` are those of the feature mart; all runs
    of a lake use the same, as their day states are folded together."""
    started = time.monotonic()
    paths, store = LakePaths(lake_root), PublishedLake(spark, lake_root)
    run = store.new_run()
    result = BatchResult(run=run)

    # 1. land (validated, rerun-safe)
    extract = FS.read_extract(spark, extract_path, fmt, extract_schema, extract_options)
    TB.land_partition(extract, paths.bronze, logical_date, PARTITION, None if logical_date else date_from)

    # The dates of this run, once: bounded by the calendar. None: rows without a readable date.
    if logical_date is not None:
        landed = [_dt.date.fromisoformat(FS.partition_value(logical_date))]
    else:
        landed = [r[0] for r in extract.select(TB.date_or_null(F.col(date_from))).distinct().collect()]
    dates = sorted(d for d in landed if d is not None)
    result.dates = dates
    mine = F.col(PARTITION).isin(dates) if dates else F.lit(False)
    if None in landed:
        mine = mine | F.col(PARTITION).isNull()

    # 2. normalize once: audit, silver and quarantine read the typed columns they need
    bronze = FS.read_partition(spark, paths.bronze, logical_date, PARTITION).where(mine)
    norm = C.normalize(bronze, contract)
    norm.write.parquet(store.place(run, "normalized"))
    norm = store.staged(run, "normalized", norm.schema)
    if audit_on == "raw":  # a breach halts before anything is staged
        result.audit = _audited(norm, contract, now, len(landed))

    # 3. silver + quarantine (dedupe within each day's batch), counts observed on the writes
    clean, quarantine = C.split_quarantine(norm, contract)
    order = [F.col(contract.event_time).desc()] + [F.col(c).asc() for c in ("wallet_id",) if c in clean.columns]
    silver = latest_per_key(clean, [*contract.key, PARTITION], order)
    if audit_on == "silver":
        result.audit = _audited(silver, contract, now, len(landed))
    result.silver_rows = store.stage(run, SILVER, silver, PARTITION)
    result.quarantine_rows = store.stage(run, QUARANTINE, quarantine, PARTITION)
    silver_rows = store.staged(run, SILVER, silver.schema)

    # 4. SCD2 dimension: one batch of snapshots per run, keyed by the run's last date
    dim_table = TB.Scd2Table(spark, paths.dim)
    batch_id = str(max(dates)) if dates else None
    if updates is not None and batch_id is not None:
        # Only what was known by the end of the run's last date: a backfill never sees later tiers.
        end = F.lit(max(dates)).cast("date") + F.expr("INTERVAL 1 DAY")
        known = updates.where(F.col("snapshot_ts") < end.cast("timestamp_ntz"))
        dim_table.apply(known, batch_id, tie=tie if tie in updates.columns else None)
    result.dim_version = batch_id
    dim = dim_table.read(as_of=batch_id)

    # 5. fact rows, staged once; table tests on what would be published
    fact = S.point_in_time_join(silver_rows, dim, rename={"risk_tier": "wallet_risk_tier_at_event"})
    result.fact_rows = store.stage(run, FACT, fact, PARTITION)
    staged_fact = store.staged(run, FACT, fact.schema)
    _table_tests(staged_fact, dim)

    # 6. day states of this run's silver rows, and the mart folded from the states of all dates up to the last one
    tables = {SILVER: (silver.schema, PARTITION, landed), QUARANTINE: (quarantine.schema, PARTITION, landed),
              FACT: (fact.schema, PARTITION, landed)}
    if dates:
        states = FE.day_states(silver_rows, labels, exact_distinct, keep=[PARTITION])
        store.stage(run, STATES, states, PARTITION)
        known_states = store.staged(run, STATES, states.schema)
        if store.has(STATES):
            earlier = store.read(STATES).where((F.col(PARTITION) <= F.lit(max(dates))) & ~F.col(PARTITION).isin(dates))
            known_states = known_states.unionByName(earlier)
        mart = FE.fold_states(known_states).withColumn(MART_PARTITION, F.lit(max(dates)).cast("date"))
        result.mart_rows = store.stage(run, MART, mart, MART_PARTITION)
        tables |= {STATES: (states.schema, PARTITION, dates), MART: (mart.schema, MART_PARTITION, [max(dates)])}

    # 7. publish: one switch for all tables
    result.published = store.publish(run, tables)

    # 8. run metrics per day (a count per staged partition; a rerun replaces its own rows)
    stamp = written_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    _write_metrics(spark, paths, silver_rows, store.staged(run, QUARANTINE, quarantine.schema), staged_fact, contract, dates, stamp,
                   started)
    FS.remove(spark, store.place(run, "normalized"))
    return result


def _write_metrics(spark: SparkSession, paths: LakePaths, silver: DataFrame, quarantine: DataFrame, fact: DataFrame,
                   contract: C.Contract, dates: list, written_at: _dt.datetime, started: float) -> None:
    """Every date of the run has its row counts, 0 where a table has none; rows without a date, and the run's seconds, count for the last."""
    day = F.coalesce(F.col(PARTITION), F.lit(max(dates) if dates else None).cast("date")).alias("metric_date")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(day).agg(F.count(F.lit(1)).alias(name))

    counts = {"silver_rows_written": silver, "quarantine_rows_written": quarantine, "gold_rows_written": fact}
    age = (F.unix_micros(F.lit(written_at).cast("timestamp")) - F.unix_micros(F.max(contract.event_time).cast("timestamp"))) / F.lit(3.6e9)
    per_day = spark.createDataFrame([(d,) for d in dates], "metric_date date")
    for name, df in counts.items():
        per_day = per_day.join(counted(df, name), "metric_date", "left")
    per_day = per_day.na.fill(0, list(counts)).join(silver.groupBy(day).agg(age.alias("silver_age_hours")), "metric_date", "left")
    seconds = F.when(F.col("metric_date") == F.lit(max(dates) if dates else None), F.lit(time.monotonic() - started))
    per_day = per_day.withColumn("dag_task_duration_seconds", seconds)
    OM.metrics_table(spark, paths.metrics).upsert(
        OM.metric_rows(per_day, [*counts, "silver_age_hours", "dag_task_duration_seconds"], written_at))


def backfill(spark: SparkSession, extracts: dict, lake_root: str, **kwargs) -> list:
    """Run ``run_batch`` for each (date -> extract path) in date order; rerun-safe per date."""
    return [run_batch(spark, extracts[d], lake_root, logical_date=d, **kwargs) for d in sorted(extracts)]


def lake_table(spark: SparkSession, lake_root: str, table: str) -> DataFrame:
    """A published table."""
    return PublishedLake(spark, lake_root).read(table)


def published_fact(spark: SparkSession, lake_root: str) -> DataFrame:
    return lake_table(spark, lake_root, FACT)


def feature_mart(spark: SparkSession, lake_root: str, as_of) -> DataFrame:
    """The mart that the run ending on ``as_of`` wrote."""
    day = F.lit(FS.partition_value(as_of)).cast("date")
    return lake_table(spark, lake_root, MART).where(F.col(MART_PARTITION) == day).drop(MART_PARTITION)


def run_metrics(spark: SparkSession, lake_root: str) -> DataFrame:
    """The metrics the runs wrote (none before the first run)."""
    table = OM.metrics_table(spark, LakePaths(lake_root).metrics)
    return table.read() if table.exists() else spark.createDataFrame([], T.StructType.fromDDL(OM.METRICS_SCHEMA))
