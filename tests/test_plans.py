"""Plan-shape checks: pushdown, pruning, partial aggregation before shuffles, no Python UDFs."""

import datetime as dt

from pyspark.sql import functions as F

from riskflow.operators.dedupe import latest_per_key
from riskflow.plans import domain as D
from riskflow.sinks import tables as T
from riskflow.sources import files as FS

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_groups_before_shuffle(spark):
    li = D.table(spark, SF, "lineitem")
    p = plan(latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc(), "l_partkey"]))
    assert "Partial" in p and "WindowGroupLimit" in p
    assert p.index("Partial") > p.index("Exchange")  # partial limit sits below (before) the exchange


def test_filters_and_columns_reach_the_scan(spark):
    ev = D.table(spark, SF, "events").where(F.col("event_type") == "click").select("event_id")
    p = plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in p


def test_partition_pruning(spark, work):
    T.land_partition(spark.range(3).withColumnRenamed("id", "x"), f"{work}/b", dt.date(2026, 7, 1))
    T.land_partition(spark.range(3).withColumnRenamed("id", "x"), f"{work}/b", dt.date(2026, 7, 2))
    p = plan(FS.read_partition(spark, f"{work}/b", dt.date(2026, 7, 2)))
    assert "PartitionFilters: [isnotnull(ingest_date" in p


def test_clean_rows_build_no_reasons(spark):
    from riskflow.operators import contract as C

    norm = C.normalize(D.raw_transactions(D.table(spark, SF, "events")), D.EVENTS_CONTRACT)
    clean, bad = C.split_quarantine(norm, D.EVENTS_CONTRACT)
    for word in ("concat_ws", "array_join", "null_tx_id"):
        assert word not in plan(clean)
    assert "array_join" in plan(bad)


def test_no_range_exchange_carries_fact_text(spark, monkeypatch):
    """Positions are found on narrow rows: what is laid out by range has no text of facts."""
    from riskflow.operators import evidence as EV
    from riskflow.operators import ranking as R
    from riskflow.plans import queries as Q

    laid, layout = [], R.range_layout

    def spy(df, order, partitions=None):
        laid.append((df.columns, plan(df)))
        return layout(df, order, partitions)

    monkeypatch.setattr(R, "range_layout", spy)
    _, feats, dims, scores, alerts = Q._evidence_inputs(spark, SF)
    facts = EV.evidence_facts(feats, dims, scores, alerts)
    assert len(laid) == 2  # history and alerts
    for columns, text in laid:
        assert "fact" not in columns and "risk_tier  from" not in text and "alert: window" not in text
    assert "rangepartitioning" not in plan(facts)


def test_seen_keys_are_not_shuffled(spark, work):
    from riskflow.sinks.seen import SeenKeys

    seen = SeenKeys(spark, "seen_plan", f"{work}/keys")
    rows = spark.range(2000).selectExpr("cast(id as string) tx_id", "'w' wallet_id", "timestamp_ntz'2026-07-01 10:00:00' event_ts",
                                        "date'2026-07-01' ingest_date")
    seen.record(rows)
    seen.record(rows)  # a rerun of the day replaces its keys
    assert spark.table("seen_plan").count() == 2000
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        new = rows.withColumn("ingest_date", F.lit(dt.date(2026, 7, 2))).where("cast(tx_id as int) >= 1500").unionByName(
            rows.selectExpr("concat('n', tx_id) tx_id", "wallet_id", "event_ts", "date'2026-07-02' ingest_date"))
        kept = seen.unseen(new, [dt.date(2026, 7, 2)])
        joined = plan(kept)
        side = joined[joined.index("SortMergeJoin"):].split("FileScan parquet spark_catalog.default.seen_plan")[0]
        # The stored side lies after the last exchange of the plan's text: only the new rows are dealt.
        assert "Bucketed: true" in joined and "Exchange" not in side.rsplit("Range (", 1)[1]
        assert kept.count() == 2000 and seen.unseen(rows, [dt.date(2026, 7, 1)]).count() == 2000
    finally:
        spark.conf.set(limit, before)
        spark.sql("DROP TABLE seen_plan")
