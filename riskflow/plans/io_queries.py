"""Registered queries that go through files: landing, CSV, JSON payloads, upserts, streams.

Each writes its inputs/outputs under a fresh folder in the session's shared
checkpoint location (never a machine-local temp folder on a cluster).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from riskflow.operators import contract as C
from riskflow.operators import opsmetrics as OM
from riskflow.operators.dedupe import collapse_upsert_keys
from riskflow.operators.velocity import velocity_features
from riskflow.plans import domain as D
from riskflow.plans import jobs as J
from riskflow.plans.queries import (
    SQL_LABELS,
    SQL_NORM,
    SQL_RAW,
    SQL_TIER,
    SQL_TX,
    SQL_TX_BREACH,
    _estimated_velocity_sql,
    _events_tx,
    _feature_sql,
    _velocity_sql,
    _with,
    held_to_exact,
)
from riskflow.plans.registry import register
from riskflow.session import scratch_path
from riskflow.sinks import tables as T
from riskflow.sinks.seen import SeenKeys
from riskflow.sources import events as EVS
from riskflow.sources import files as FS
from riskflow.sources import graph as G
from riskflow.streaming import velocity_stream as VS

SPLIT_DAY = "2024-01-15 00:00:00"


@register(
    "bronze_land_and_scan",
    "A1 A2 A5 (land by date twice, scan all partitions)",
    _with(SQL_RAW.replace("FROM events)", ", CAST(ts AS DATE) AS ingest_date FROM events)")) + "SELECT * FROM raw",
)
def bronze_land_and_scan(spark, sf):
    work = scratch_path(spark, "bronze")
    D.raw_transactions(D.table(spark, sf, "events")).write.parquet(f"{work}/extract")
    extract = FS.read_extract(spark, f"{work}/extract")
    for _ in range(2):  # rerun lands the same rows
        T.land_partition(extract, f"{work}/bronze", date_from="event_ts")
    return FS.read_partition(spark, f"{work}/bronze")


@register(
    "bronze_catalog_partitions",
    "A4 A5 A20 (partitions registered in the session catalog, read through the table)",
    _with(SQL_RAW.replace("FROM events)", ", CAST(ts AS DATE) AS ingest_date FROM events)")) + "SELECT * FROM raw",
)
def bronze_catalog_partitions(spark, sf):
    import uuid

    work = scratch_path(spark, "bronze-catalog")
    raw = D.raw_transactions(D.table(spark, sf, "events"))
    T.land_partition(raw, f"{work}/bronze", date_from="event_ts")
    table = f"bronze_tx_{uuid.uuid4().hex[:8]}"
    T.create_partitioned_table(spark, table, f"{work}/bronze", ", ".join(f"{c} string" for c in raw.columns))
    # Partition values come from the landed folders (one per date), registered twice: a rerun is a no-op.
    landed = [d.split("=", 1)[1] for d in FS.list_dirs(spark, f"{work}/bronze") if d.startswith("ingest_date=")]
    for _ in range(2):
        T.register_partitions(spark, table, {v: f"{work}/bronze/ingest_date={v}" for v in landed})
    return spark.table(table)


@register(
    "dedupe_across_days",
    "E1 C5 (ids unique across days: the second half brings rows of the first again)",
    _with(SQL_TX) + "SELECT *, CAST(event_ts AS DATE) AS ingest_date FROM tx",
)
def dedupe_across_days(spark, sf):
    import uuid

    work = scratch_path(spark, "seen-keys")
    seen = SeenKeys(spark, f"seen_tx_{uuid.uuid4().hex[:8]}", f"{work}/keys")
    tx = _events_tx(spark, sf).withColumn("ingest_date", F.to_date("event_ts"))
    cut = F.lit(SPLIT_DAY).cast("date")
    late = F.col("event_ts") + F.expr("INTERVAL 31 DAYS")  # redelivered a month later, under another day
    again = tx.where((F.col("ingest_date") < cut) & (F.col("asset") == "PURCHASE")).withColumns(
        {"event_ts": late, "ingest_date": F.to_date(late)})
    for i, half in enumerate((tx.where(F.col("ingest_date") < cut), tx.where(F.col("ingest_date") >= cut).unionByName(again))):
        T.land_partition(half.drop("ingest_date"), f"{work}/landed{i}", date_from="event_ts")
        landed = FS.read_partition(spark, f"{work}/landed{i}")
        days = [r[0] for r in landed.select("ingest_date").distinct().collect()]  # bounded by the calendar
        T.overwrite_partitions(seen.unseen(landed, days), f"{work}/silver", "ingest_date")
        silver = FS.read_partition(spark, f"{work}/silver")
        seen.record(silver.where(F.col("ingest_date").isin(days)))
    return silver


SQL_GRAPH_TX = """
  g AS (SELECT CAST(event_id AS VARCHAR) AS tx_id,
               datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day_offset,
               value - 100.0::DOUBLE AS f0
        FROM events)
SELECT tx_id,
       'w-' || CAST(CAST(concat('0x', substr(md5(tx_id), 1, 15)) AS BIGINT) % 5000 AS VARCHAR) AS wallet_id,
       'w-' || CAST(CAST(concat('0x', substr(md5(tx_id || 'cp'), 1, 15)) AS BIGINT) % 5000 AS VARCHAR)
         AS counterparty_id,
       TIMESTAMP '2026-01-01 00:00:00' + to_days(CAST(day_offset AS INTEGER))
         + to_seconds(CAST(concat('0x', substr(md5(tx_id), 1, 15)) AS BIGINT) % 86400) AS event_ts,
       CAST(round(abs(f0) * 1000 + 1, 2) AS DECIMAL(38,8)) AS value,
       'BTC' AS asset
FROM g"""


def _graph(spark, sf):
    work = scratch_path(spark, "graph")
    ev = D.table(spark, sf, "events")
    D.graph_feature_rows(ev).write.option("header", False).csv(f"{work}/features")
    D.graph_class_rows(ev).write.option("header", True).csv(f"{work}/classes")
    return G.load_labelled_graph(spark, f"{work}/features", f"{work}/classes")


@register("csv_adapt_graph", "A6 B10 H7 H8 H9 H10 H11 H12", "WITH " + SQL_GRAPH_TX)
def csv_adapt_graph(spark, sf):
    tx, _ = _graph(spark, sf)
    return C.normalize(tx, C.TX_CONTRACT)


@register(
    "label_map",
    "A7 B11",
    """SELECT CAST(event_id AS VARCHAR) AS tx_id,
       CASE WHEN event_type = 'error' THEN 'ILLICIT' WHEN event_type = 'purchase' THEN 'LICIT'
            ELSE 'UNKNOWN' END AS fraud_label
    FROM events""",
)
def label_map(spark, sf):
    _, labels = _graph(spark, sf)
    return labels


SQL_PAYLOADS = """p AS (
    SELECT event_type,
           '{"tx_id":"tx-' || event_id || '","wallet_id":"w-' || user_id || '","counterparty_id":"w-'
           || ((event_id * 7 + 3) % 150) || '","value":' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)
           || ',"asset":"' || upper(event_type) || '","event_ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
           || '","produced_ts":"' || strftime(ts + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS body
    FROM events),
  r AS (SELECT CASE WHEN event_type = 'error' THEN substr(body, 1, 30) ELSE body END AS raw FROM p)"""

SQL_PARSED = _with(SQL_PAYLOADS) + """
SELECT j.tx_id, j.wallet_id, j.counterparty_id, TRY_CAST(j.value AS DECIMAL(38,8)) AS value, j.asset,
       TRY_CAST(j.event_ts AS TIMESTAMP) AS event_ts, TRY_CAST(j.produced_ts AS TIMESTAMP) AS produced_ts,
       j.tx_id IS NULL AS _corrupt, raw AS _raw
FROM (SELECT raw,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.tx_id') END AS tx_id,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.wallet_id') END AS wallet_id,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.counterparty_id') END AS counterparty_id,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.value') END AS value,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.asset') END AS asset,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.event_ts') END AS event_ts,
             CASE WHEN json_valid(raw) THEN json_extract_string(raw, '$.produced_ts') END AS produced_ts
      FROM r) j"""


@register("json_event_parse", "B8 H14 H15 H16 A18 B7", SQL_PARSED)
def json_event_parse(spark, sf):
    payloads = D.event_payloads(D.table(spark, sf, "events"), cut_errors=True)
    return EVS.parse_events(payloads.select(F.col("value").cast("binary").alias("value")))  # bytes, as a broker carries them


@register(
    "upsert_merge",
    "A12 C6 (copy-on-write upsert, pure form)",
    """WITH upd AS (
      SELECT s_suppkey, s_name, s_nationkey, s_acctbal + 100.0::DOUBLE AS s_acctbal FROM supplier WHERE s_acctbal > 0
      UNION ALL
      SELECT -s_suppkey, s_name, s_nationkey, 0.0 FROM supplier WHERE s_acctbal < 0)
    SELECT * FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM upd)
    UNION ALL SELECT * FROM upd""",
)
def upsert_merge(spark, sf):
    sup = D.table(spark, sf, "supplier")
    changed = sup.where("s_acctbal > 0").withColumn("s_acctbal", F.col("s_acctbal") + F.lit(100.0))
    new = sup.where("s_acctbal < 0").select(
        (-F.col("s_suppkey")).alias("s_suppkey"), "s_name", "s_nationkey", F.lit(0.0).alias("s_acctbal"))
    return T.upsert_frame(sup, changed.unionByName(new), ["s_suppkey"])


@register(
    "upsert_key_collapse",
    "E3 (collapse duplicate upsert keys, keep highest tx_count)",
    # Collapsing (early batch U full aggregate) by key keeps the full aggregate: the velocity twin.
    _velocity_sql("10 minutes"),
)
def upsert_key_collapse(spark, sf):
    tx = _events_tx(spark, sf)
    early = velocity_features(tx.where(F.col("event_ts") < F.lit(SPLIT_DAY).cast("timestamp_ntz")),
                              "10 minutes", exact_distinct=True)
    full = velocity_features(tx, "10 minutes", exact_distinct=True)
    return collapse_upsert_keys(early.unionByName(full))


@register(
    "velocity_upsert_replay",
    "A12 I6 (keyed upsert by appends, batch applied twice, one date compacted)",
    "SELECT *, CAST(window_start AS DATE) AS window_date FROM (" + _velocity_sql("10 minutes") + ")",
)
def velocity_upsert_replay(spark, sf):
    tx = _events_tx(spark, sf)
    cut = F.lit(SPLIT_DAY).cast("timestamp_ntz")
    first = velocity_features(tx.where(F.col("event_ts") < cut), "10 minutes", exact_distinct=True)
    later = velocity_features(tx.where(F.col("event_ts") >= cut - F.expr("INTERVAL 5 DAYS")), "10 minutes",
                              exact_distinct=True)
    table = VS.velocity_table(spark, scratch_path(spark, "upsert"))
    for batch in (first, later, later):  # the same batch twice: replay is a no-op
        table.upsert(batch.withColumn("window_date", F.to_date("window_start")))
    table.compact(F.col("window_date") >= F.lit(SPLIT_DAY).cast("date"))
    return table.read()


@register(
    "score_table_upsert",
    "A16 A12 (scores keyed by wallet and model version, rescored wallets replaced)",
    """WITH w1 AS (SELECT DISTINCT 'w-' || user_id AS wallet_id FROM events),
      w2 AS (SELECT DISTINCT 'w-' || o_custkey AS wallet_id FROM orders),
      s1 AS (SELECT wallet_id,
                    CAST(CAST(concat('0x', substr(md5(wallet_id), 1, 15)) AS BIGINT) % 1000 AS DOUBLE)
                      / 1000.0::DOUBLE AS fraud_score, 'hash-v1' AS model_version FROM w1),
      s2 AS (SELECT wallet_id,
                    CAST(CAST(concat('0x', substr(md5(wallet_id || '#2'), 1, 15)) AS BIGINT) % 1000 AS DOUBLE)
                      / 1000.0::DOUBLE AS fraud_score, 'hash-v1' AS model_version FROM w2)
    SELECT * FROM s1 WHERE wallet_id NOT IN (SELECT wallet_id FROM s2)
    UNION ALL SELECT * FROM s2""",
)
def score_table_upsert(spark, sf):
    from riskflow.functions.hashing import md5_unit
    from riskflow.operators.serving import publish_scores, score_table

    work = scratch_path(spark, "scores")
    first = D.wallet_scores(_events_tx(spark, sf).select("wallet_id").distinct())
    od = D.table(spark, sf, "orders")
    rescored = od.select(F.concat(F.lit("w-"), F.col("o_custkey").cast("string")).alias("wallet_id")).distinct() \
        .select("wallet_id", md5_unit(F.concat(F.col("wallet_id"), F.lit("#2")), 1000).alias("fraud_score"),
                F.lit("hash-v1").alias("model_version"))
    publish_scores(spark, first, work)
    publish_scores(spark, rescored, work)
    return score_table(spark, work).read()


# ---------------------------------------------------------------------------
# Streams (their estimated distinct count is held against the exact one)
# ---------------------------------------------------------------------------

STREAM_GROUPS = 3
FILES_PER_GROUP = 4


def _write_stream_input(spark, sf, path: str, duplicate_purchases: bool = False, order=None,
                        cut_errors: bool = False) -> None:
    """Payload files by time group: group g (a third of the days, the outer ones without a bound) is written as exactly
    FILES_PER_GROUP files after the previous group, so each micro-batch is one whole group.
    ``order`` changes the arrival order of the groups (late data)."""
    pl = D.event_payloads(D.table(spark, sf, "events"), cut_errors=cut_errors)
    if duplicate_purchases:  # redelivered messages
        pl = pl.unionByName(pl.where(F.col("event_type") == "purchase"))
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    grp = F.greatest(F.least(F.floor(day / F.lit(31.0 / STREAM_GROUPS)), F.lit(STREAM_GROUPS - 1)), F.lit(0))
    for g in (order or range(STREAM_GROUPS)):
        (pl.where(grp == g).select("value").repartition(FILES_PER_GROUP)
         .write.mode("append").text(path))


def _run_stream(spark, sf, dedupe_key=None, duplicate=False, dead_letter=False, order=None):
    work = scratch_path(spark, "stream")
    _write_stream_input(spark, sf, f"{work}/in", duplicate, order, cut_errors=dead_letter)
    _start_stream(spark, work, dedupe_key, dead_letter).await_all()
    return work


def _start_stream(spark, work, dedupe_key=None, dead_letter=False):
    raw = EVS.event_stream(spark, f"{work}/in", max_files_per_trigger=FILES_PER_GROUP)
    return VS.run_stream(raw, f"{work}/velocity", f"{work}/ckpt", f"{work}/dead" if dead_letter else None,
                         available_now=True, dedupe_key=dedupe_key, metrics_root=f"{work}/metrics")


def _stream_table(spark, work):
    """The table the stream wrote, with wall-clock windows."""
    return VS.read_velocity_table(spark, f"{work}/velocity").withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


_GROUP_SQL = (f"least(greatest(floor(date_diff('day', DATE '2024-01-01', CAST(window_start AS DATE)) / (31.0 / {STREAM_GROUPS})), 0), "
              f"{STREAM_GROUPS - 1})")


STREAM_SQL = _estimated_velocity_sql("10 minutes")
FLAGGED_STREAM_SQL = _estimated_velocity_sql("10 minutes", flagged=True)


def _held_stream(spark, sf, work, flagged=True):
    """The stream's table, its estimated counts held against those of the batch operator."""
    exact = velocity_features(_events_tx(spark, sf), "10 minutes", exact_distinct=True)
    return held_to_exact(_stream_table(spark, work), exact, ["window_start", "wallet_id"], flagged)


@register("stream_velocity", "I1 I2 I3 I4 I6 I7 I8 I10 A9 A19 N5", FLAGGED_STREAM_SQL)
def stream_velocity(spark, sf):
    return _held_stream(spark, sf, _run_stream(spark, sf))


@register("stream_velocity_dedupe", "I1 I3 D5 (redelivered events dropped by key)", FLAGGED_STREAM_SQL)
def stream_velocity_dedupe(spark, sf):
    return _held_stream(spark, sf, _run_stream(spark, sf, dedupe_key="tx_id", duplicate=True))


LATE_SQL = f"SELECT * FROM ({STREAM_SQL}) WHERE {_GROUP_SQL} <> 1"


@register("stream_velocity_late", "I5 I1 (days arrive out of order; those behind the watermark are dropped)", LATE_SQL)
def stream_velocity_late(spark, sf):
    # Arrival: last third of the days, then the first, then the middle third. The watermark
    # takes effect one batch late, so the first third still counts; the middle third arrives
    # behind the watermark set by the last third and is dropped.
    return _held_stream(spark, sf, _run_stream(spark, sf, order=[2, 0, 1]), flagged=False)


@register("stream_velocity_restart", "I3 I7 A19 (stopped after the first files, started again from its checkpoint)",
          _velocity_sql("10 minutes").replace("count(DISTINCT counterparty_id) AS distinct_counterparties,", ""))
def stream_velocity_restart(spark, sf):
    work = scratch_path(spark, "stream-restart")
    for g in range(STREAM_GROUPS):  # one query per group: each takes up state and offsets where the last one ended
        _write_stream_input(spark, sf, f"{work}/in", order=[g])
        _start_stream(spark, work).await_all()
    return _stream_table(spark, work).drop("distinct_counterparties")


@register("stream_dead_letter", "A18 I9 (corrupt payloads kept)",
          _with(SQL_PAYLOADS) + "SELECT raw AS _raw FROM r WHERE NOT json_valid(raw)")
def stream_dead_letter(spark, sf):
    work = _run_stream(spark, sf, dead_letter=True)
    return spark.read.parquet(f"{work}/dead")


# ---------------------------------------------------------------------------
# The daily batch job over every date of the extract (write-audit-publish)
# ---------------------------------------------------------------------------


JOB_NOW = "2024-02-01 00:00:00"


_SQL_SILVER = f""",
  silver AS (
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, CAST(event_ts AS DATE) AS ingest_date,
             row_number() OVER (PARTITION BY tx_id, CAST(event_ts AS DATE) ORDER BY event_ts DESC, wallet_id) AS rn
      FROM norm WHERE {SQL_TX_BREACH} = '') WHERE rn = 1)"""


def _run_job(spark, sf, parts=(None,), **options):
    """Runs of the batch job over ``events``, one per condition of ``parts``; (last result, lake root)."""
    work = scratch_path(spark, "batch-job")
    now = dt.datetime.fromisoformat(JOB_NOW)
    raw = D.raw_transactions(D.table(spark, sf, "events"))
    updates = D.tier_updates(D.table(spark, sf, "orders"))
    for i, part in enumerate(parts):
        (raw if part is None else raw.where(part)).write.parquet(f"{work}/extract{i}")
        result = J.run_batch(spark, f"{work}/extract{i}", f"{work}/lake", None, D.EVENTS_CONTRACT, updates, now=now,
                             written_at=now, **options)
    return result, f"{work}/lake"


@register(
    "feature_mart_sink",
    "A17 N1 K7 D14a (feature mart of two runs: the second folds the stored states of the first's dates)",
    _with(SQL_RAW, SQL_NORM) + _SQL_SILVER + ",\n  "
    + _feature_sql("tx AS (SELECT * FROM silver)", SQL_LABELS)
    + "\nSELECT *, (SELECT count(*) FROM feats) AS rows_observed FROM feats",
)
def feature_mart_sink(spark, sf):
    day = F.col("event_ts").try_cast("date")
    cut = F.lit(SPLIT_DAY).cast("date")
    result, lake = _run_job(spark, sf, parts=(day < cut, day >= cut), exact_distinct=True,
                            labels=D.transaction_labels(D.table(spark, sf, "events")))
    return J.feature_mart(spark, lake, max(result.dates)).withColumn("rows_observed", F.lit(result.mart_rows).cast("long"))


@register(
    "batch_job_fact",
    "N1 N2 N3 N4 A1 A10 A11 A15 J7 M1 (published fact after all gates)",
    _with(SQL_RAW, SQL_NORM) + _SQL_SILVER + f""",
  upd AS (SELECT 'w-' || o_custkey AS wallet_id, {SQL_TIER} AS risk_tier, o_orderdate AS snapshot_ts,
                 o_orderkey AS tie FROM orders),
  latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wallet_id
               ORDER BY snapshot_ts DESC, tie DESC) AS rn FROM upd) WHERE rn = 1)
SELECT s.*, l.risk_tier AS wallet_risk_tier_at_event
FROM silver s LEFT JOIN latest l ON l.wallet_id = s.wallet_id AND s.event_ts >= l.snapshot_ts""",
)
def batch_job_fact(spark, sf):
    _, lake = _run_job(spark, sf)
    return J.published_fact(spark, lake)


# ---------------------------------------------------------------------------
# Run metrics and alarm rules, over what a run of the batch job wrote
# ---------------------------------------------------------------------------

METRICS_NOW = dt.datetime(2024, 2, 1, 12, 0, 0)
# Days watched: the first ones lie before any run, the last ones behind it.
METRICS_SINCE, METRICS_UNTIL = dt.date(2023, 12, 30), dt.date(2024, 2, 3)


def _metrics(spark, sf):
    return J.run_metrics(spark, _run_job(spark, sf)[1])


SQL_METRICS = _with(SQL_RAW, SQL_NORM) + _SQL_SILVER + f""",
  daily AS (
    SELECT d.metric_date, coalesce(s.n, 0) AS silver_rows, coalesce(q.n, 0) AS quarantine_rows
    FROM (SELECT DISTINCT CAST(event_ts AS DATE) AS metric_date FROM norm) d
    LEFT JOIN (SELECT ingest_date, count(*) AS n FROM silver GROUP BY 1) s ON s.ingest_date = d.metric_date
    LEFT JOIN (SELECT CAST(event_ts AS DATE) AS day, count(*) AS n FROM norm WHERE {SQL_TX_BREACH} <> '' GROUP BY 1) q
      ON q.day = d.metric_date)
"""


@register("quarantine_trend", "M1 M4 D14a", SQL_METRICS + "SELECT * FROM daily")
def quarantine_trend_q(spark, sf):
    return OM.daily_trend(_metrics(spark, sf))


@register(
    "freshness_check",
    "M2",
    SQL_METRICS + f"""
SELECT TIMESTAMP '{METRICS_NOW}' AS checked_at, TIMESTAMP '{JOB_NOW}' AS last_written_at,
       round(date_diff('microsecond', TIMESTAMP '{JOB_NOW}', TIMESTAMP '{METRICS_NOW}') / 3600000000.0, 3) AS age_hours,
       date_diff('microsecond', TIMESTAMP '{JOB_NOW}', TIMESTAMP '{METRICS_NOW}') / 3600000000.0 > 26 AS breach
FROM (SELECT count(*) AS n FROM daily) WHERE n > 0""",
)
def freshness_check_q(spark, sf):
    return OM.freshness(_metrics(spark, sf), METRICS_NOW)


@register(
    "zero_row_days",
    "M3",
    SQL_METRICS + f""",
  spine AS (SELECT CAST(unnest(generate_series(TIMESTAMP '{METRICS_SINCE}', TIMESTAMP '{METRICS_UNTIL}', INTERVAL 1 DAY)) AS DATE) AS day)
SELECT s.day, CAST(coalesce(d.silver_rows, 0) AS BIGINT) AS rows, coalesce(d.silver_rows, 0) < 1 AS breach
FROM spine s LEFT JOIN daily d ON d.metric_date = s.day""",
)
def zero_row_days_q(spark, sf):
    return OM.zero_row_days(_metrics(spark, sf), METRICS_UNTIL, since=METRICS_SINCE)
