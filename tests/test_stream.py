import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from riskflow.operators.dedupe import collapse_upsert_keys
from riskflow.operators.velocity import velocity_features
from riskflow.session import local_path
from riskflow.sources.events import event_stream, parse_events
from riskflow.streaming.velocity_stream import make_upsert, read_velocity_table, run_stream


def payload(tx, wallet, ts, value=10.0, cp="c1"):
    return json.dumps({"tx_id": tx, "wallet_id": wallet, "counterparty_id": cp, "value": value,
                       "asset": "BTC", "event_ts": ts, "produced_ts": ts})


def test_parse_flags_corrupt_and_keeps_raw(spark):
    raw = spark.createDataFrame([(bytearray(payload("t1", "w1", "2026-07-01 10:01:00").encode()),),
                                 (bytearray(b"not-json{"),)], "value binary")
    out = {r._raw: r for r in parse_events(raw).collect()}
    assert out["not-json{"]._corrupt is True and out["not-json{"].tx_id is None
    good = [r for r in out.values() if not r._corrupt][0]
    assert good.tx_id == "t1" and str(good.value) == "10.00000000"


def test_window_math(spark):
    rows = [("t1", "w1", "2026-07-01 10:01:00", 10.0), ("t2", "w1", "2026-07-01 10:04:00", 20.0),
            ("t3", "w1", "2026-07-01 10:09:59", 30.0), ("t4", "w1", "2026-07-01 10:11:00", 5.0)]
    df = spark.createDataFrame(
        [(payload(a, b, c, v),) for a, b, c, v in rows], "value string")
    out = {r.window_start.strftime("%H:%M"): r for r in velocity_features(parse_events(df)).collect()}
    assert out["10:00"].tx_count == 3 and float(out["10:00"].total_value) == 60.0
    assert float(out["10:00"].max_single_value) == 30.0 and out["10:10"].tx_count == 1


def test_key_collapse(spark):
    df = spark.createDataFrame(
        [("w1", dt.datetime(2026, 7, 1, 10), 3, 1.0, 1.0), ("w1", dt.datetime(2026, 7, 1, 10), 5, 1.0, 1.0),
         ("w2", dt.datetime(2026, 7, 1, 10), 1, 1.0, 1.0)],
        "wallet_id string, window_start timestamp, tx_count long, total_value double, max_single_value double")
    out = {r.wallet_id: r.tx_count for r in collapse_upsert_keys(df).collect()}
    assert out == {"w1": 5, "w2": 1}


def _write_batches(folder, batches):
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(batches):
        with open(os.path.join(folder, f"b{i:03d}.txt"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        t = time.time() + i  # strictly increasing modification times
        os.utime(os.path.join(folder, f"b{i:03d}.txt"), (t, t))


def _run(spark, work, batches, **kw):
    _write_batches(local_path(f"{work}/in"), batches)
    raw = event_stream(spark, f"{work}/in", max_files_per_trigger=1)
    run_stream(raw, f"{work}/out", f"{work}/ckpt", f"{work}/dead", **kw).await_all()
    return {(r.wallet_id, r.window_start.strftime("%H:%M")): r.tx_count
            for r in read_velocity_table(spark, f"{work}/out").collect()}


def test_late_event_filter_lags_one_batch(spark, work):
    out = _run(spark, work, [[payload("a", "w1", "2026-07-01 10:40:00")],
                             [payload("b", "w1", "2026-07-01 10:12:00")],
                             [payload("c", "w1", "2026-07-01 10:13:00")],
                             [payload("d", "w1", "2026-07-01 10:41:00")]])
    assert out[("w1", "10:10")] == 1  # 10:12 kept, 10:13 dropped as late
    assert out[("w1", "10:40")] == 2


def test_duplicates_counted_unless_deduped(spark, work):
    b = [[payload("a", "w1", "2026-07-01 10:01:00"), payload("a", "w1", "2026-07-01 10:01:00")]]
    assert _run(spark, work + "-x", b)[("w1", "10:00")] == 2
    assert _run(spark, work + "-y", b, dedupe_key="tx_id")[("w1", "10:00")] == 1


def test_replayed_batch_is_noop(spark, work):
    df = spark.createDataFrame([(payload("a", "w1", "2026-07-01 10:01:00"),)], "value string")
    batch = velocity_features(parse_events(df, ts_type="timestamp"))
    up = make_upsert(f"{work}/t", f"{work}/s")
    up(batch, 0)
    first = sorted(map(tuple, read_velocity_table(spark, f"{work}/t").collect()))
    up(batch, 0)
    assert sorted(map(tuple, read_velocity_table(spark, f"{work}/t").collect())) == first


def test_stream_equals_batch_on_ordered_input(spark, work):
    lines = [payload(f"t{i}", f"w{i % 3}", f"2026-07-01 10:{i:02d}:00", float(i)) for i in range(40)]
    out = _run(spark, work, [lines[:20], lines[20:]])
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    batch = {(r.wallet_id, r.window_start.strftime("%H:%M")): r.tx_count
             for r in velocity_features(parse_events(df)).collect()}
    assert out == batch


def test_registered_late_stream_drops_exactly_the_late_days(spark):
    import __spark_entry__ as E

    sf = "/root/testdata/sf0.001"
    q = E.queries()
    key = ("wallet_id", "window_start", "tx_count", "total_value", "max_single_value")
    in_order = {tuple(r) for r in q["stream_velocity"](spark, sf).select(*key).collect()}
    late = {tuple(r) for r in q["stream_velocity_late"](spark, sf).select(*key).collect()}
    group = lambda ts: min(int((ts.date() - dt.date(2024, 1, 1)).days // (31.0 / 3)), 2)
    assert late == {r for r in in_order if group(r[1]) != 1}


SF = "/root/testdata/sf0.001"


def _exact(spark):
    from riskflow.plans import domain as D

    return velocity_features(D.transactions(D.table(spark, SF, "events")), "10 minutes", exact_distinct=True)


def _close(estimated, exact, keys):
    """The estimate is within three standard errors of five per cent, and one; every other column is exact."""
    rest = [c for c in exact.columns if c != "distinct_counterparties"]
    assert sorted(map(str, estimated.select(*rest).collect())) == sorted(map(str, exact.select(*rest).collect()))
    both = estimated.select(*keys, F.col("distinct_counterparties").alias("e")).join(
        exact.select(*keys, F.col("distinct_counterparties").alias("x")), keys)
    assert both.where("abs(e - x) > 1 + 0.15 * x").isEmpty() and both.count() == exact.count()


def test_registered_streams_equal_the_batch_operator(spark):
    import __spark_entry__ as E

    for name in ("stream_velocity", "stream_velocity_dedupe"):
        _close(E.queries()[name](spark, SF), _exact(spark), ["wallet_id", "window_start"])
    late = E.queries()["stream_velocity_late"](spark, SF)
    kept = late.select("wallet_id", "window_start")
    _close(late, _exact(spark).join(kept, ["wallet_id", "window_start"], "left_semi").select(*late.columns), ["wallet_id", "window_start"])


def test_estimates_of_the_batch_queries_are_close(spark):
    import __spark_entry__ as E

    q = E.queries()
    _close(q["velocity_10min_hll"](spark, SF), _exact(spark), ["wallet_id", "window_start"])
    _close(q["wallet_features_hll"](spark, SF), q["wallet_features"](spark, SF), ["wallet_id"])


def test_a_query_stopped_at_work_goes_on_from_its_checkpoint(spark, work):
    lines = [payload(f"t{i}", f"w{i % 3}", f"2026-07-01 10:{i:02d}:00", float(i)) for i in range(40)]
    _write_batches(local_path(f"{work}/in"), [lines[k:k + 5] for k in range(0, 40, 5)])
    raw = event_stream(spark, f"{work}/in", max_files_per_trigger=1)
    running = run_stream(raw, f"{work}/out", f"{work}/ckpt", available_now=False, metrics_root=f"{work}/metrics")
    deadline = time.time() + 120
    while running.features.lastProgress is None and time.time() < deadline:
        time.sleep(0.2)
    running.stop()  # in the middle of the files
    state = local_path(f"{work}/ckpt/velocity/state")
    written = [f for _, _, files in os.walk(state) for f in files]
    assert any(f.endswith(".changelog") for f in written)
    run_stream(raw, f"{work}/out", f"{work}/ckpt", metrics_root=f"{work}/metrics").await_all()
    got = {(r.wallet_id, r.window_start.strftime("%H:%M")): r.tx_count for r in read_velocity_table(spark, f"{work}/out").collect()}
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert got == {(r.wallet_id, r.window_start.strftime("%H:%M")): r.tx_count for r in velocity_features(parse_events(df)).collect()}

    from riskflow.operators.opsmetrics import metrics_table

    rows = metrics_table(spark, f"{work}/metrics").read().collect()
    assert {r.metric_name for r in rows} == {"stream_batch_rows"}
    assert len({r.source for r in rows}) >= 8  # one value per micro-batch


def test_the_session_keeps_its_state_store_setting(spark, work):
    from riskflow.streaming.velocity_stream import STATE_SETTINGS

    before = {k: spark.conf.get(k, None) for k in STATE_SETTINGS}
    _run(spark, work, [[payload("a", "w1", "2026-07-01 10:01:00")]])
    assert {k: spark.conf.get(k, None) for k in STATE_SETTINGS} == before


def test_an_estimate_that_is_not_close_gives_way_to_the_exact_count(spark):
    from riskflow.plans.queries import held_to_exact

    cols = "wallet_id string, tx_count long, distinct_counterparties long"
    estimated = spark.createDataFrame([("a", 9, 11), ("b", 9, 20), (None, 9, 30), ("d", 9, 5)], cols)
    exact = spark.createDataFrame([("a", 9, 10), ("b", 9, 10), (None, 9, 10)], cols)
    got = {r.wallet_id: r.distinct_counterparties for r in held_to_exact(estimated, exact, ["wallet_id"]).collect()}
    assert got == {"a": 11, "b": 10, None: 10, "d": 5}


def test_estimates_have_twins_that_give_them_digit_by_digit(spark):
    """More counterparties per group than the tables have in ten minutes: the registers' collisions show."""
    import duckdb

    from riskflow.plans.queries import SQL_TX, _registers_sql, _with

    ids = spark.range(150).select(F.concat(F.lit("w-"), F.col("id").cast("string")).alias("counterparty_id"))
    rows = ids.crossJoin(spark.range(1, 40).withColumnRenamed("id", "g")).where(F.pmod(F.xxhash64("counterparty_id", "g"), F.lit(40)) < F.col("g"))
    want = {r.g: (r.e, r.x) for r in rows.groupBy("g").agg(F.approx_count_distinct("counterparty_id").alias("e"), F.count("*").alias("x")).collect()}
    assert any(e != x for e, x in want.values())
    con = duckdb.connect()
    con.execute("CREATE TABLE pairs (g INT, counterparty_id VARCHAR)")
    con.executemany("INSERT INTO pairs VALUES (?, ?)", [(r.g, r.counterparty_id) for r in rows.collect()])
    sql = _with(SQL_TX.replace(SQL_TX, "tx AS (SELECT DISTINCT counterparty_id FROM pairs)"), _registers_sql()) + (
        "SELECT g, CAST(round(512 * ln(512 / (512 - count(DISTINCT register)))) AS BIGINT) FROM pairs JOIN registers USING (counterparty_id) GROUP BY g")
    assert {g: e for g, e in con.execute(sql).fetchall()} == {g: e for g, (e, _) in want.items()}


def test_estimates_come_with_whether_they_are_close(spark):
    import __spark_entry__ as E
    from riskflow.plans.queries import held_to_exact

    cols = "wallet_id string, distinct_counterparties long"
    estimated = spark.createDataFrame([("a", 11), ("b", 20), (None, 30), ("d", 5)], cols)
    exact = spark.createDataFrame([("a", 10), ("b", 10), (None, 30)], cols)
    got = {r.wallet_id: r[1:] for r in held_to_exact(estimated, exact, ["wallet_id"], flagged=True).collect()}
    assert got == {"a": (11, True), "b": (10, False), None: (30, True), "d": (5, False)}
    for name in ("wallet_features_hll", "stream_velocity", "stream_velocity_dedupe"):
        assert E.queries()[name](spark, SF).columns[-1] == "distinct_counterparties_close"
