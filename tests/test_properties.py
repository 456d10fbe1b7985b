"""Property tests: invariants that must hold for any input (few examples; each is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskflow.operators import contract as C
from riskflow.operators import scd2 as S
from riskflow.operators.ranking import group_positions

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

raw_row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["t1", " t2 ", "t3", ""])),
    st.one_of(st.none(), st.sampled_from(["w1", "w2"])),
    st.one_of(st.none(), st.sampled_from(["2026-07-01 10:00:00", "not-a-time", "2026-07-02"])),
    st.one_of(st.none(), st.sampled_from(["10", "-1", "abc", "0", "3.25"])),
    st.one_of(st.none(), st.sampled_from(["btc", " ETH ", "DOGE", ""])),
)


@SETTINGS
@given(st.lists(raw_row, max_size=25))
def test_every_row_lands_in_exactly_one_output(spark, rows):
    df = spark.createDataFrame([(a, b, None, c, d, e) for a, b, c, d, e in rows],
                               "tx_id string, wallet_id string, counterparty_id string, event_ts string, "
                               "value string, asset string")
    clean, bad = C.split_quarantine(C.normalize(df))
    c, b = clean.collect(), bad.collect()
    assert len(c) + len(b) == len(rows)
    for r in c:
        assert None not in (r.tx_id, r.wallet_id, r.event_ts, r.value, r.asset)
        assert r.value >= 0 and r.asset in ("BTC", "ETH")
    assert all(r.breach_reasons for r in b)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 50)),
                min_size=1, max_size=60))
def test_group_positions_equal_row_number(spark, pairs):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(pairs)], "id long, g string, v long")
    got = {r.id: r.position for r in group_positions(df, ["g"], ["v", "id"], partitions=5).collect()}
    w = Window.partitionBy("g").orderBy("v", "id")
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
    assert got == want


snapshot = st.tuples(st.sampled_from(["w1", "w2", "w3"]), st.sampled_from(["LOW", "MEDIUM", "HIGH"]),
                     st.integers(0, 3))


@SETTINGS
@given(st.lists(st.lists(snapshot, min_size=1, max_size=4), min_size=1, max_size=4), st.permutations(range(4)))
def test_incremental_scd2_equals_rebuild(spark, batches, months):
    rows, tie = [], 0
    for b, batch in enumerate(batches):
        for w, t, day in batch:
            # a batch's snapshots fall in one month; batches may arrive in any order of time
            rows.append((w, t, dt.datetime(2026, months[b] + 1, 1 + day), tie, b))
            tie += 1
    u = spark.createDataFrame(rows, "wallet_id string, risk_tier string, snapshot_ts timestamp_ntz, tie long, "
                                    "batch int")

    def norm(df):
        return sorted(tuple(r) for r in df.select(*S.dim_columns()).collect())

    inc = S.scd2_apply_batches(S.empty_dimension(spark), u, "batch", tie="tie")
    assert norm(inc) == norm(S.scd2_rebuild(u, "batch", tie="tie"))
    cur = inc.where("is_current").groupBy("wallet_id").count().where("count > 1").count()
    assert cur == 0


version = st.tuples(st.sampled_from(["w1", "w2"]), st.sampled_from(["LOW", "HIGH"]), st.integers(0, 20))
fact = st.tuples(st.sampled_from(["w1", "w2", "w3"]), st.integers(-2, 25))


@SETTINGS
@given(st.lists(st.lists(version, min_size=1, max_size=3), min_size=1, max_size=3),
       st.lists(fact, min_size=1, max_size=15))
def test_point_in_time_join_equals_brute_force(spark, batches, facts):
    base = dt.datetime(2026, 1, 1)
    dim = S.empty_dimension(spark)
    for b, batch in enumerate(batches):
        rows = [(w, t, base + dt.timedelta(days=b * 30 + d), i) for i, (w, t, d) in enumerate(batch)]
        u = spark.createDataFrame(rows, "wallet_id string, risk_tier string, snapshot_ts timestamp_ntz, tie long")
        dim = S.scd2_apply(dim, u, tie="tie")
    dims = [tuple(r) for r in dim.collect()]
    fr = [(f"t{i}", w, base + dt.timedelta(days=d * 4)) for i, (w, d) in enumerate(facts)]
    fdf = spark.createDataFrame(fr, "tx_id string, wallet_id string, event_ts timestamp_ntz")
    got = sorted((r.tx_id, r.risk_tier) for r in S.point_in_time_join(fdf, dim).collect())
    want = []
    for tx, w, ts in fr:
        hits = [t for (dw, t, vf, vt, _) in dims if dw == w and vf <= ts and (vt is None or ts < vt)]
        want += [(tx, t) for t in hits] or [(tx, None)]
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["a", "b", "c"])), max_size=12),
       st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["x", "y"])), max_size=8, unique_by=lambda r: r[0]))
def test_upsert_is_idempotent_and_keyed(spark, target, updates):
    from riskflow.sinks.tables import upsert_frame

    t = spark.createDataFrame(list({k: (k, v) for k, v in target}.values()), "k long, v string")
    u = spark.createDataFrame(updates, "k long, v string")
    once = upsert_frame(t, u, "k")
    twice = upsert_frame(once, u, "k")
    a, b = sorted(map(tuple, once.collect())), sorted(map(tuple, twice.collect()))
    assert a == b
    assert len({k for k, _ in a}) == len(a)
    assert {k: v for k, v in a} == {**{k: v for k, v in target}, **{k: v for k, v in updates}}
