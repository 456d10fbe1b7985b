import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.errors import DataQualityError
from riskflow.operators.contract import TX_CONTRACT
from riskflow.plans import jobs as J
from riskflow.plans.registry import all_queries
from riskflow.sinks.lake import PublishedLake

RAW = "tx_id string, wallet_id string, counterparty_id string, event_ts string, value string, asset string"
UPD = "wallet_id string, risk_tier string, snapshot_ts timestamp_ntz, tie long"
NOW = dt.datetime(2026, 8, 1)


def extract(spark, path, rows):
    spark.createDataFrame(rows, RAW).write.mode("overwrite").parquet(path)
    return path


def day1(spark, work):
    return extract(spark, f"{work}/x1", [
        ("t1", "w1", "c1", "2026-07-01 10:00:00", "10", "btc"),
        ("t1", "w1", "c1", "2026-07-01 11:00:00", "99", "BTC"),   # duplicate: latest wins
        ("t2", "w2", "c2", "2026-07-01 12:00:00", "5", "DOGE"),   # quarantined
    ])


def test_backfill_rerun_and_publish(spark, work):
    updates = spark.createDataFrame([("w1", "LOW", dt.datetime(2026, 6, 1), 1)], UPD)
    x2 = extract(spark, f"{work}/x2", [("t3", "w1", "c1", "2026-07-02 09:00:00", "7", "ETH")])
    lake = f"{work}/lake"
    kw = dict(updates=updates, now=NOW, written_at=NOW, audit_on="silver")
    J.backfill(spark, {dt.date(2026, 7, 1): day1(spark, work), dt.date(2026, 7, 2): x2}, lake, **kw)
    res = J.run_batch(spark, f"{work}/x1", lake, dt.date(2026, 7, 1), **kw)  # rerun of day 1
    assert (res.silver_rows, res.quarantine_rows) == (1, 1)
    fact = {r.tx_id: r for r in J.published_fact(spark, lake).collect()}
    assert set(fact) == {"t1", "t3"} and float(fact["t1"].value) == 99.0
    assert fact["t3"].wallet_risk_tier_at_event == "LOW"
    m = J.run_metrics(spark, lake).where("metric_name IN ('silver_rows_written', 'quarantine_rows_written')")
    assert m.count() == 4  # 2 metrics x 2 days, not duplicated by the rerun
    q = J.lake_table(spark, lake, "quarantine").first()
    assert q.breach_reasons == "unaccepted_asset"
    # The mart of a day knows the silver rows up to that day, also when the day is rerun later.
    for day, n, total in ((1, 1, 99.0), (2, 2, 106.0)):
        mart = J.feature_mart(spark, lake, dt.date(2026, 7, day)).collect()
        assert [(r.wallet_id, r.tx_count, r.total_value, r.active_days) for r in mart] == [("w1", n, total, day)]


def test_audit_breach_halts_before_publish(spark, work):
    x = extract(spark, f"{work}/bad", [("t1", "w1", "c1", "2027-01-01 00:00:00", "1", "BTC")])
    with pytest.raises(DataQualityError):
        J.run_batch(spark, x, f"{work}/lake", dt.date(2026, 7, 1), TX_CONTRACT, now=NOW)
    assert not PublishedLake(spark, f"{work}/lake").has("silver")
    assert not PublishedLake(spark, f"{work}/lake").has("fact")


def test_raw_audit_halts_on_duplicates(spark, work):
    with pytest.raises(DataQualityError) as e:
        J.run_batch(spark, day1(spark, work), f"{work}/lake", dt.date(2026, 7, 1), now=NOW)
    assert "tx_id not unique: 1 duplicate rows" in e.value.report.breaches


def test_run_only_touches_its_dates(spark, work):
    lake = f"{work}/lake"
    x1 = extract(spark, f"{work}/a", [("t1", "w1", "c1", "2026-07-01 10:00:00", "1", "BTC")])
    x2 = extract(spark, f"{work}/b", [("t2", "w1", "c1", "2026-07-02 10:00:00", "2", "BTC"),
                                      ("t3", "w1", "c1", "2026-07-02 11:00:00", "3", "DOGE")])
    J.run_batch(spark, x1, lake, None, now=NOW, written_at=NOW)
    res = J.run_batch(spark, x2, lake, None, now=NOW, written_at=NOW)
    assert res.dates == [dt.date(2026, 7, 2)] and res.fact_rows == 1  # day 1 not republished
    m = {(r.metric_name, str(r.metric_date)): r.metric_value
         for r in J.run_metrics(spark, lake).collect()}
    assert m[("silver_rows_written", "2026-07-01")] == 1.0
    assert m[("quarantine_rows_written", "2026-07-01")] == 0.0
    assert (m[("silver_rows_written", "2026-07-02")], m[("quarantine_rows_written", "2026-07-02")]) == (1.0, 1.0)
    assert J.published_fact(spark, lake).count() == 2


def test_mart_tests_halt_on_duplicate_fact_rows(spark, work):
    # Two rows with the same tx_id on the same day survive only if dedupe is bypassed:
    # audit_on="silver" with a contract whose key is not tx_id lets them through to the fact.
    from riskflow.operators.contract import with_rules

    x = extract(spark, f"{work}/dup", [("t1", "w1", "c1", "2026-07-01 10:00:00", "1", "BTC"),
                                       ("t1", "w2", "c1", "2026-07-01 10:00:00", "2", "BTC")])
    loose = with_rules(TX_CONTRACT, key=("tx_id", "wallet_id"))
    with pytest.raises(DataQualityError) as e:
        J.run_batch(spark, x, f"{work}/lake", dt.date(2026, 7, 1), loose, now=NOW, audit_on="silver")
    assert "tx_id not unique" in str(e.value)
    assert not PublishedLake(spark, f"{work}/lake").has("fact")


def test_csv_extract_with_schema(spark, work):
    import os

    from riskflow.session import local_path

    p = local_path(f"{work}/csv")
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/day.csv", "w") as fh:
        fh.write("tx_id,wallet_id,counterparty_id,event_ts,value,asset\n"
                 "t1,w1,c1,2026-07-01 10:00:00,10,btc\nt2,w2,c2,2026-07-01 11:00:00,-1,BTC\n")
    res = J.run_batch(spark, f"{work}/csv", f"{work}/lake", dt.date(2026, 7, 1), now=NOW, audit_on="silver",
                      fmt="csv", extract_schema=RAW, extract_options={"header": "true"})
    assert (res.silver_rows, res.quarantine_rows, res.fact_rows) == (1, 1, 1)


def test_unreadable_times_are_quarantined_and_corrected_rerun_leaves_nothing(spark, work):
    lake = f"{work}/lake"
    rows = [("t1", "w1", "c1", "2026-07-01 10:00:00", "1", "BTC"), ("t2", "w1", "c1", None, "1", "BTC"),
            ("t3", "w1", "c1", "garbage", "1", "BTC"), ("t4", "w1", "c1", "2026-07-02 10:00:00", "1", "DOGE")]
    kw = dict(now=NOW, written_at=NOW, audit_on="silver")
    res = J.run_batch(spark, extract(spark, f"{work}/a", rows), lake, **kw)
    assert (res.silver_rows, res.quarantine_rows, res.fact_rows) == (1, 3, 1)  # rows in = clean + quarantine
    # Corrected extract: the bad rows of the same dates are gone, one date has a clean row now.
    fixed = [rows[0], ("t2", "w1", "c1", "2026-07-01 11:00:00", "1", "BTC"), ("t4", "w1", "c1", "2026-07-02 10:00:00", "1", "ETH"),
             ("t5", "w1", "c1", None, "1", "ETH")]
    res = J.run_batch(spark, extract(spark, f"{work}/b", fixed), lake, **kw)
    assert (res.silver_rows, res.quarantine_rows) == (3, 1)
    quarantine = J.lake_table(spark, lake, "quarantine")
    assert [r.tx_id for r in quarantine.collect()] == ["t5"]
    # A date whose rows all turn bad loses its published rows.
    res = J.run_batch(spark, extract(spark, f"{work}/c", [
        ("t4", "w1", "c1", "2026-07-02 10:00:00", "1", "DOGE"), ("t9", "w1", "c1", "2026-07-03 10:00:00", "1", "BTC")]), lake, **kw)
    assert (res.silver_rows, res.quarantine_rows) == (1, 1)
    assert {r.tx_id for r in J.published_fact(spark, lake).collect()} == {"t1", "t2", "t9"}


def test_backfill_does_not_see_later_tiers(spark, work):
    updates = spark.createDataFrame([("w1", "LOW", dt.datetime(2023, 1, 1), 1), ("w1", "HIGH", dt.datetime(2026, 7, 2), 2)], UPD)
    days = {dt.date(2026, 7, d): extract(spark, f"{work}/d{d}", [(f"t{d}", "w1", "c1", f"2026-07-0{d} 10:00:00", "1", "BTC")])
            for d in (1, 2)}
    J.backfill(spark, days, f"{work}/lake", updates=updates, now=NOW, written_at=NOW)
    got = {r.tx_id: r.wallet_risk_tier_at_event for r in J.published_fact(spark, f"{work}/lake").collect()}
    assert got == {"t1": "LOW", "t2": "HIGH"}


def test_row_bound_holds_per_day(spark, work):
    from dataclasses import replace

    x = extract(spark, f"{work}/x", [(f"t{i}", "w1", "c1", f"2026-07-0{1 + i % 2} 10:00:00", "1", "BTC") for i in range(4)])
    J.run_batch(spark, x, f"{work}/ok", contract=replace(TX_CONTRACT, row_count_max=2), now=NOW)
    with pytest.raises(DataQualityError):
        J.run_batch(spark, x, f"{work}/over", contract=replace(TX_CONTRACT, row_count_max=1), now=NOW)


class Lost(Exception):
    pass


def _visible(spark, lake):
    store = PublishedLake(spark, lake)
    return {t: sorted(map(str, store.read(t).collect())) for t in (J.SILVER, J.QUARANTINE, J.FACT, J.STATES, J.MART)}


def test_a_run_that_fails_anywhere_leaves_the_old_day_whole(spark, work, monkeypatch):
    lake = f"{work}/lake"
    kw = dict(now=NOW, written_at=NOW, audit_on="silver",
              updates=spark.createDataFrame([("w1", "LOW", dt.datetime(2026, 6, 1), 1)], UPD))
    J.run_batch(spark, day1(spark, work), lake, dt.date(2026, 7, 1), **kw)
    before = _visible(spark, lake)
    again = extract(spark, f"{work}/x2", [("t7", "w9", "c1", "2026-07-01 10:00:00", "7", "ETH"),
                                          ("t8", "w9", "c1", "2026-07-01 10:00:00", "7", "DOGE")])

    def fail(*args, **kwargs):
        raise Lost

    stage = PublishedLake.stage
    for at in ("silver", "quarantine", "dimension", "fact", "tests", "wallet_day_states", "wallet_features", "publish"):
        with monkeypatch.context() as m:
            if at == "dimension":
                m.setattr(J.TB.Scd2Table, "apply", fail)
            elif at == "tests":
                m.setattr(J, "_table_tests", fail)
            elif at == "publish":
                m.setattr(PublishedLake, "publish", fail)
            else:
                m.setattr(PublishedLake, "stage", lambda self, run, table, rows, col, at=at: (
                    fail() if table == at else stage(self, run, table, rows, col)))
            with pytest.raises(Lost):
                J.run_batch(spark, again, lake, dt.date(2026, 7, 1), **kw)
        assert _visible(spark, lake) == before, at
    J.run_batch(spark, again, lake, dt.date(2026, 7, 1), **kw)
    assert [r.tx_id for r in J.published_fact(spark, lake).collect()] == ["t7"]


def test_the_fact_is_written_once_and_old_runs_are_vacuumed(spark, work):
    lake = f"{work}/lake"
    for _ in range(2):
        J.run_batch(spark, day1(spark, work), lake, dt.date(2026, 7, 1), now=NOW, written_at=NOW, audit_on="silver")
    before, store = _visible(spark, lake), PublishedLake(spark, lake)
    plan = store.read(J.FACT)._jdf.queryExecution().executedPlan().toString()
    assert "CatalogFileIndex" in plan or "InMemoryFileIndex" in plan
    assert store.vacuum() > 0 and _visible(spark, lake) == before and store.vacuum() == 0


def test_a_new_session_finds_the_published_tables(spark, work):
    from riskflow.sinks import lake as L

    lake = f"{work}/lake"
    J.run_batch(spark, day1(spark, work), lake, dt.date(2026, 7, 1), now=NOW, written_at=NOW, audit_on="silver")
    before = _visible(spark, lake)
    L._CATALOG.clear()  # what another driver would know
    assert _visible(spark, lake) == before


def test_the_mart_of_a_later_run_reads_states_not_silver(spark, work, monkeypatch):
    lake, seen = f"{work}/lake", []
    J.run_batch(spark, extract(spark, f"{work}/a", [("t1", "w1", "c1", "2026-07-01 10:00:00", "1", "BTC")]), lake, None, now=NOW, written_at=NOW)
    stage = PublishedLake.stage

    def spy(self, run, table, rows, col):
        if table == J.MART:
            seen.append((run, rows.inputFiles()))
        return stage(self, run, table, rows, col)

    monkeypatch.setattr(PublishedLake, "stage", spy)
    J.run_batch(spark, extract(spark, f"{work}/b", [("t2", "w1", "c2", "2026-07-02 10:00:00", "2", "BTC")]), lake, None, now=NOW, written_at=NOW)
    (run, files), = seen
    assert files and all(f"/{J.STATES}/" in f for f in files)  # the fold scans states alone
    mart = J.feature_mart(spark, lake, dt.date(2026, 7, 2)).first()
    assert (mart.tx_count, mart.total_value, mart.active_days, mart.distinct_counterparties) == (2, 3.0, 2, 2)


def test_metrics_of_a_run(spark, work):
    lake = f"{work}/lake"
    J.run_batch(spark, day1(spark, work), lake, dt.date(2026, 7, 1), now=NOW, written_at=NOW, audit_on="silver")
    m = {r.metric_name: (r.metric_value, r.written_at) for r in J.run_metrics(spark, lake).collect()}
    assert m.pop("dag_task_duration_seconds")[0] > 0
    assert {k: v[0] for k, v in m.items() if k != "silver_age_hours"} == {
        "silver_rows_written": 1.0, "quarantine_rows_written": 1.0, "gold_rows_written": 1.0}
    assert m["silver_age_hours"] == ((NOW - dt.datetime(2026, 7, 1, 11)).total_seconds() / 3600, NOW)
    assert J.run_metrics(spark, f"{work}/none").count() == 0


def test_row_bound_names_the_days(spark, work):
    from dataclasses import replace

    x = extract(spark, f"{work}/x", [(f"t{i}", "w1", "c1", f"2026-07-0{1 + i % 2} 10:00:00", "1", "BTC") for i in range(3)])
    with pytest.raises(DataQualityError, match="2026-07-01"):
        J.run_batch(spark, x, f"{work}/over", contract=replace(TX_CONTRACT, row_count_max=1), now=NOW)


def test_the_fact_join_of_a_run_copies_and_broadcasts_no_versions(spark, work, monkeypatch):
    plans, stage = {}, PublishedLake.stage

    def spy(self, run, table, rows, col):
        plans[table] = rows._jdf.queryExecution().executedPlan().toString()
        return stage(self, run, table, rows, col)

    monkeypatch.setattr(PublishedLake, "stage", spy)
    x = extract(spark, f"{work}/x", [(f"t{k}", f"w{k % 3}", "c1", f"2026-07-{k:02d} 10:00:00", "1", "BTC") for k in range(1, 29)])
    updates = spark.createDataFrame([(f"w{k}", "LOW", dt.datetime(2026, 6, 1), k) for k in range(3)], UPD)
    J.run_batch(spark, x, f"{work}/lake", None, updates=updates, now=NOW, written_at=NOW)
    assert "Generate" not in plans[J.FACT] and "BroadcastHashJoin" not in plans[J.FACT]
    assert {r.wallet_risk_tier_at_event for r in J.published_fact(spark, f"{work}/lake").collect()} == {"LOW"}


@pytest.mark.parametrize("name, want", [
    ("freshness_check", [(dt.datetime(2024, 2, 1, 12), dt.datetime(2024, 2, 1), 12.0, False)]),
    ("quarantine_trend", [(dt.date(2024, 1, k), 1, int(k % 2 == 0)) for k in range(1, 29)]),
])
def test_a_query_on_run_metrics_broadcasts_no_table_of_the_run(spark, work, monkeypatch, name, want):
    plans, stage = {}, PublishedLake.stage

    def spy(self, run, table, rows, col):
        plans[table] = rows._jdf.queryExecution().executedPlan().toString()
        return stage(self, run, table, rows, col)

    monkeypatch.setattr(PublishedLake, "stage", spy)
    events = [(k, dt.datetime(2024, 1, k, 10), k % 3, "click", 1.0) for k in range(1, 29)]
    events += [(100 + k, dt.datetime(2024, 1, k, 11), k % 3, "error", 1.0) for k in range(2, 29, 2)]  # quarantined
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double") \
        .write.parquet(f"{work}/events.parquet")
    spark.createDataFrame([(k, k, dt.datetime(2023, 6, 1), "1-URGENT") for k in range(3)],
                          "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{work}/orders.parquet")
    got = all_queries()[name].build(spark, work)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {J.SILVER, J.QUARANTINE, J.FACT, J.STATES, J.MART} == set(plans)
    assert not [t for t, plan in plans.items() if "Broadcast" in plan]
