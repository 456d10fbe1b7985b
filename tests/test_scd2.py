import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.operators import checks as K
from riskflow.operators import scd2 as S

UPD = "wallet_id string, risk_tier string, snapshot_ts timestamp_ntz, tie long"


def d(m, day=1):
    return dt.datetime(2026, m, day)


def upd(spark, rows):
    return spark.createDataFrame([(w, t, ts, i) for i, (w, t, ts) in enumerate(rows)], UPD)


def apply_all(spark, batches):
    state = S.empty_dimension(spark)
    for b in batches:
        state = S.scd2_apply(state, upd(spark, b), tie="tie").checkpoint(eager=True)
    return state


def rows(df):
    return sorted((r.wallet_id, r.risk_tier, r.valid_from, r.valid_to, r.is_current) for r in df.collect())


def test_two_changes_three_rows(spark):
    st = apply_all(spark, [[("w1", "LOW", d(1))], [("w1", "MEDIUM", d(2))], [("w1", "HIGH", d(3))]])
    assert rows(st) == [("w1", "HIGH", d(3), None, True), ("w1", "LOW", d(1), d(2), False),
                        ("w1", "MEDIUM", d(2), d(3), False)]


def test_no_change_is_noop(spark):
    st = apply_all(spark, [[("w1", "LOW", d(1))], [("w1", "LOW", d(2))]])
    assert rows(st) == [("w1", "LOW", d(1), None, True)]


def test_latest_in_batch_wins(spark):
    st = apply_all(spark, [[("w1", "LOW", d(1, 1)), ("w1", "HIGH", d(1, 2))]])
    assert rows(st) == [("w1", "HIGH", d(1, 2), None, True)]


def test_untouched_wallets_keep_rows(spark):
    st = apply_all(spark, [[("w1", "LOW", d(1)), ("w2", "HIGH", d(1))], [("w1", "MEDIUM", d(2))]])
    assert rows(st) == [("w1", "LOW", d(1), d(2), False), ("w1", "MEDIUM", d(2), None, True),
                        ("w2", "HIGH", d(1), None, True)]


def test_same_batch_twice_and_stale_snapshot(spark):
    b = [("w1", "LOW", d(1)), ("w1", "HIGH", d(2))]
    once = apply_all(spark, [[b[0]], [b[1]]])
    twice = apply_all(spark, [[b[0]], [b[1]], [b[1]]])
    stale = apply_all(spark, [[b[0]], [b[1]], [("w1", "MEDIUM", d(1, 15))]])
    assert rows(once) == rows(twice) == rows(stale)


def test_null_tier_and_equal_times(spark):
    st = apply_all(spark, [[("w1", None, d(1))], [("w1", None, d(2))]])
    assert rows(st) == [("w1", None, d(1), None, True)]
    tie = apply_all(spark, [[("w2", "LOW", d(1)), ("w2", "HIGH", d(1))]])  # higher tie value wins
    assert rows(tie) == [("w2", "HIGH", d(1), None, True)]


def test_rebuild_equals_incremental(spark):
    batches = [[("w1", "LOW", d(1)), ("w2", "LOW", d(1))], [("w1", "LOW", d(2)), ("w2", "HIGH", d(2))],
               [("w1", "HIGH", d(3)), ("w3", "MEDIUM", d(3))], [("w2", "LOW", d(4))]]
    inc = apply_all(spark, batches)
    flat = [(w, t, ts, b) for b, batch in enumerate(batches) for (w, t, ts) in batch]
    u = spark.createDataFrame([(w, t, ts, i, b) for i, (w, t, ts, b) in enumerate(flat)], UPD + ", batch int")
    assert rows(S.scd2_rebuild(u, "batch", tie="tie")) == rows(inc)


def test_checks_flag_overlap_and_multi_current(spark):
    st = apply_all(spark, [[("w1", "LOW", d(1))], [("w1", "HIGH", d(2))]])
    assert K.scd2_breaches(st).count() == 0
    first = apply_all(spark, [[("w1", "LOW", d(1))]])
    bad = {(r.wallet_id, r.breach) for r in K.scd2_breaches(st.unionByName(first)).collect()}
    assert bad == {("w1", "overlapping_range"), ("w1", "multiple_current_rows")}


def test_point_in_time_edges(spark):
    dim = apply_all(spark, [[("w1", "LOW", d(1))], [("w1", "HIGH", d(2))]])
    facts = spark.createDataFrame(
        [("before", "w1", d(1) - dt.timedelta(days=1)), ("at_from", "w1", d(1)), ("inside", "w1", d(1, 15)),
         ("at_to", "w1", d(2)), ("missing", "w9", d(3))],
        "tx_id string, wallet_id string, event_ts timestamp_ntz",
    )
    out = {r.tx_id: r.risk_tier for r in S.point_in_time_join(facts, dim).collect()}
    assert out == {"before": None, "at_from": "LOW", "inside": "LOW", "at_to": "HIGH", "missing": None}


def test_salted_join_equals_plain(spark):
    dim = apply_all(spark, [[("w1", "LOW", d(1)), ("w2", "LOW", d(1))], [("w1", "HIGH", d(2))]])
    facts = spark.range(0, 3000).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("tx_id"),
        F.when(F.col("id") < 2000, "w1").otherwise(F.concat(F.lit("w"), (F.col("id") % 5).cast("string")))
        .alias("wallet_id"),
        (F.lit(d(1)).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id") % 1000)).alias("event_ts"),
    )
    plain = S.point_in_time_join(facts, dim).collect()
    salted = S.point_in_time_join(facts, dim, skew_min_rows=200).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, salted))


def test_hot_keys_by_share(spark):
    from riskflow.operators.skew import N_SALT, hot_keys

    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 30 + [(f"c{i}",) for i in range(20)], "k string")
    assert {r.k: r[N_SALT] for r in hot_keys(df, "k", share=0.2).collect()} == {"a": 3, "b": 2}
    assert hot_keys(df.where("false"), "k", share=0.2).isEmpty()


def test_scd2_table_batches_and_rerun(spark, work):
    from riskflow.sinks.tables import Scd2Table

    t = Scd2Table(spark, f"{work}/dim")
    b1 = upd(spark, [("w1", "LOW", d(1)), ("w2", "HIGH", d(1))])
    b2 = upd(spark, [("w1", "MEDIUM", d(2))])
    t.apply(b1, "2026-01-01", tie="tie")
    t.apply(b2, "2026-02-01", tie="tie")
    want = rows(apply_all(spark, [[("w1", "LOW", d(1)), ("w2", "HIGH", d(1))], [("w1", "MEDIUM", d(2))]]))
    assert rows(t.read()) == want
    t.apply(b2, "2026-02-01", tie="tie")  # rerun of the last batch
    t.apply(b1, "2026-01-01", tie="tie")  # rerun of an earlier batch recomputes from its predecessor
    assert rows(t.read()) == want
    assert rows(t.read(as_of="2026-01-15")) == [("w1", "LOW", d(1), None, True), ("w2", "HIGH", d(1), None, True)]


def test_scd2_table_folds_later_batches_again(spark, work):
    from riskflow.sinks.tables import Scd2Table

    first, second, third = [("w1", "LOW", d(1))], [("w1", "HIGH", d(2)), ("w2", "LOW", d(2))], [("w1", "LOW", d(3))]
    t = Scd2Table(spark, f"{work}/dim-again")
    for batch_id, batch in (("1", first), ("3", third), ("2", second)):  # the second comes late
        t.apply(upd(spark, batch), batch_id, tie="tie")
    assert rows(t.read()) == rows(apply_all(spark, [first, second, third]))
    first = [("w1", "HIGH", d(1)), ("w3", "LOW", d(1))]
    t.apply(upd(spark, first), "1", tie="tie")  # corrected rerun
    assert rows(t.read()) == rows(apply_all(spark, [first, second, third]))
    assert rows(t.read(as_of="1")) == [("w1", "HIGH", d(1), None, True), ("w3", "LOW", d(1), None, True)]


def test_scd2_table_takes_up_an_interrupted_replay(spark, work, monkeypatch):
    from riskflow.sinks.tables import Scd2Table

    first, second, third = [("w1", "LOW", d(1))], [("w1", "HIGH", d(2))], [("w1", "LOW", d(3))]
    t = Scd2Table(spark, f"{work}/dim-cut")
    for batch_id, batch in (("1", first), ("2", second), ("3", third)):
        t.apply(upd(spark, batch), batch_id, tie="tie")
    first = [("w1", "HIGH", d(1))]
    fold = t._fold

    def cut(batch_id):
        if batch_id == "2":
            raise RuntimeError("lost")
        fold(batch_id)

    monkeypatch.setattr(t, "_fold", cut)
    with pytest.raises(RuntimeError):
        t.apply(upd(spark, first), "1", tie="tie")
    assert t.batches() == ["1"]
    Scd2Table(spark, f"{work}/dim-cut").apply(upd(spark, []), "4", tie="tie")
    assert rows(t.read()) == rows(apply_all(spark, [first, second, third]))


def test_apply_batches_keeps_history_out_of_the_loop(spark):
    batches = [[("w1", "LOW", d(1))], [("w1", "HIGH", d(2))], [("w1", "LOW", d(3))]]
    flat = [(w, t, ts, b) for b, batch in enumerate(batches) for (w, t, ts) in batch]
    u = spark.createDataFrame([(w, t, ts, i, b) for i, (w, t, ts, b) in enumerate(flat)], UPD + ", batch int")
    assert rows(S.scd2_apply_batches(S.empty_dimension(spark), u, "batch", tie="tie")) == rows(apply_all(spark, batches))


FACT = "tx_id string, wallet_id string, event_ts timestamp_ntz"
DIM = "wallet_id string, risk_tier string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def _tiers(spark, facts, dims, **how):
    return sorted((r.tx_id, r.risk_tier) for r in S.point_in_time_join(facts, dims, **how).collect())


@pytest.mark.parametrize("hours", [1, 36, 24 * 90])
def test_binned_join_equals_the_join_on_the_key(spark, hours):
    import random

    rng = random.Random(hours)
    times = [dt.datetime(1969, 12, 1) + dt.timedelta(hours=rng.randint(0, 2400)) for _ in range(200)]
    facts = spark.createDataFrame([(f"t{i}", rng.choice(["w1", "w2", "w3", None]), rng.choice([t, t, t, None])) for i, t in enumerate(times)], FACT)
    bounds = [dt.datetime(1969, 11, 1) + dt.timedelta(hours=400 * k) for k in range(9)]
    versions = [("w1", f"v{k}", a, b, b is None) for k, (a, b) in enumerate(zip(bounds, [*bounds[1:], None], strict=True))]
    versions += [("w2", "late", dt.datetime(2030, 1, 1), None, True), ("w2", "early", dt.datetime(1900, 1, 1), dt.datetime(1969, 12, 20), False),
                 ("w3", "empty", bounds[3], bounds[3], False), ("w3", "odd", None, None, True), ("w3", "back", bounds[5], bounds[4], False)]
    dims = spark.createDataFrame(versions, DIM)
    plain = _tiers(spark, facts, dims)
    assert _tiers(spark, facts, dims, bin_width=dt.timedelta(hours=hours)) == plain
    wide = spark.createDataFrame([(dt.datetime(1960, 1, 1), dt.datetime(1971, 1, 1))], "first timestamp_ntz, last timestamp_ntz")
    assert _tiers(spark, facts, dims, bin_width=dt.timedelta(hours=hours * 24), span=wide) == plain
    assert _tiers(spark, facts.where("false"), dims, bin_width=dt.timedelta(hours=hours)) == []
    timeless = facts.withColumn("event_ts", F.lit(None).cast("timestamp_ntz"))
    assert {t for _, t in _tiers(spark, timeless, dims, bin_width=dt.timedelta(hours=hours))} == {None}


def test_a_hot_wallet_is_dealt_over_its_bins(spark):
    n = 40_000
    day = F.make_dt_interval(days=(F.col("id") % 365).cast("int"))
    facts = spark.range(n).select(
        F.col("id").cast("string").alias("tx_id"),
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("w"), F.col("id").cast("string"))).alias("wallet_id"),
        (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz") + day).alias("event_ts"))
    # Fresh from a shuffle, as a rebuilt dimension is.
    dims = S.scd2_rebuild(facts.select("wallet_id", F.lit("LOW").alias("risk_tier"), F.lit(dt.datetime(2023, 1, 1)).cast("timestamp_ntz")
                                       .alias("snapshot_ts"), F.lit(1).alias("batch")).distinct(), "batch")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    aqe = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set(aqe, "false")
    try:
        joined = S.point_in_time_join(facts, dims, bin_width=dt.timedelta(days=1))
        assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == n and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        plain = S.point_in_time_join(facts, dims)
        sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) > 0.7 * n  # what the join on the key alone does
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset(aqe)


def test_bin_width_must_be_positive(spark):
    from riskflow.errors import ConfigError

    with pytest.raises(ConfigError):
        S.point_in_time_join(spark.createDataFrame([], FACT), S.empty_dimension(spark), bin_width=dt.timedelta(0))


def test_the_join_on_the_key_sends_each_version_once_and_none_to_the_driver(spark):
    facts = spark.createDataFrame([("t1", "w1", d(5)), ("t2", "w1", d(1)), ("t3", None, d(5)), ("t4", "w2", None), ("t5", "w9", d(5))], FACT)
    u = spark.createDataFrame([("w1", "LOW", d(2), 1, 1), ("w1", "HIGH", d(4), 2, 2), ("w2", "LOW", d(2), 3, 1)], UPD + ", batch int")
    joined = S.point_in_time_join(facts, S.scd2_rebuild(u, "batch", tie="tie"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    top = plan[:plan.index("ShuffledHashJoin")] + plan[plan.index("ShuffledHashJoin"):].split("HashAggregate")[0]
    assert "BroadcastHashJoin" not in plan and "_bin" not in plan
    assert plan.count("hashpartitioning(greatest") == 1 and "Sort " not in top  # an exchange of its own, also behind one on the key
    assert sorted((r.tx_id, r.risk_tier) for r in joined.collect()) == [("t1", "HIGH"), ("t2", None), ("t3", None), ("t4", None), ("t5", None)]


def test_binned_copies_are_not_broadcast(spark):
    facts = spark.createDataFrame([("t1", "w1", d(5))], FACT)
    dims = spark.createDataFrame([("w1", "LOW", d(1), None, True)], DIM)
    joined = S.point_in_time_join(facts, dims, bin_width=dt.timedelta(hours=1))
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert [r.risk_tier for r in joined.collect()] == ["LOW"]
