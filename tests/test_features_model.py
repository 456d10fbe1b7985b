import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskflow.errors import ModelError
from riskflow.operators import features as FE
from riskflow.operators import model as M

TX = "tx_id string, wallet_id string, counterparty_id string, event_ts timestamp_ntz, value decimal(38,8)"


def test_wallet_features(spark):
    t = lambda d, h: dt.datetime(2026, 1, d, h)
    tx = spark.createDataFrame(
        [("t1", "w1", "c1", t(1, 10), 10), ("t2", "w1", "c2", t(1, 11), 30), ("t3", "w1", "c1", t(2, 10), 20),
         ("t4", "w2", "c9", t(5, 10), 5), ("t5", "w3", "c9", t(5, 10), 5)],
        TX.replace("decimal(38,8)", "int")).withColumn("value", F.col("value").cast("decimal(38,8)"))
    labels = spark.createDataFrame([("t1", "ILLICIT"), ("t2", "LICIT"), ("t4", "LICIT"), ("t5", "UNKNOWN")],
                                   "tx_id string, fraud_label string")
    out = {r.wallet_id: r for r in FE.wallet_features(tx, labels, exact_distinct=True).collect()}
    w1 = out["w1"]
    assert (w1.tx_count, w1.total_value, w1.max_value, w1.active_days, w1.label) == (3, 60.0, 30.0, 2, 1)
    assert w1.distinct_counterparties == 2 and w1.avg_value == 20.0
    assert out["w2"].label == 0 and out["w3"].label is None


def test_wallet_features_read_rows_once(spark):
    rows = spark.range(500).select(
        F.col("id").cast("string").alias("tx_id"), F.lit("w").alias("wallet_id"), (F.col("id") % 7).cast("string").alias("counterparty_id"),
        (F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 11).cast("int"))).alias("event_ts"),
        F.col("id").cast("decimal(38,8)").alias("value"))
    for exact in (True, False):
        out = FE.wallet_features(rows, exact_distinct=exact)
        r = out.first()
        assert (r.tx_count, r.distinct_counterparties, r.active_days, r.avg_value) == (500, 7, 11, 249.5)
        assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_wallet_features_of_missing_values(spark):
    rows = spark.createDataFrame([("t1", "w", None, None, None), ("t2", "w", None, None, None)], TX)
    for exact in (True, False):
        r = FE.wallet_features(rows, exact_distinct=exact).first()
        assert (r.tx_count, r.total_value, r.avg_value, r.distinct_counterparties, r.active_days) == (2, None, None, 0, 0)
    assert FE.wallet_features(rows.limit(0)).count() == 0


def mart(spark, n=400):
    base = dt.datetime(2026, 1, 1)
    ids = spark.range(n)
    pos = F.pmod(F.xxhash64("id"), F.lit(100)) < 15
    noise = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10)).cast("double")
    return ids.select(
        F.concat(F.lit("w-"), F.col("id").cast("string")).alias("wallet_id"),
        (F.lit(5) + F.when(pos, 30).otherwise(0) + noise).cast("long").alias("tx_count"),
        (F.lit(100.0) + F.when(pos, 900.0).otherwise(0.0) + noise * 10).alias("total_value"),
        (F.lit(20.0) + noise).alias("avg_value"),
        (F.lit(50.0) + F.when(pos, 400.0).otherwise(0.0)).alias("max_value"),
        (F.lit(2) + F.when(pos, 15).otherwise(0)).cast("long").alias("distinct_counterparties"),
        (F.lit(1) + F.pmod(F.col("id"), F.lit(20))).cast("long").alias("active_days"),
        (F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("id"))).alias("first_seen_ts"),
        F.when(pos, 1).otherwise(0).alias("label"),
    )


def test_time_split_no_leakage(spark):
    train, test, info = M.time_split(mart(spark), test_fraction=0.3)
    assert (train.count(), test.count()) == (280, 120)
    assert train.agg(F.max("first_seen_ts")).first()[0] <= test.agg(F.min("first_seen_ts")).first()[0]


def test_time_split_degenerate(spark):
    with pytest.raises(ModelError):
        M.time_split(mart(spark, 10), test_fraction=0.0)


def test_precision_at_k(spark):
    df = spark.createDataFrame([("a", 1, .9), ("b", 0, .8), ("c", 1, .7), ("d", 0, .2), ("e", 0, .1)],
                               "wallet_id string, label int, score double")
    assert M.precision_at_k(df, 2).first().precision_at_k == 0.5
    assert abs(M.precision_at_k(df, 3).first().precision_at_k - 2 / 3) < 1e-12
    assert M.precision_at_k(df, 50).first().k == 5


def test_average_precision_with_ties(spark):
    df = spark.createDataFrame([(1, .9), (0, .9), (1, .5), (0, .3), (1, .3)], "label int, score double")
    r = M.average_precision(df).first()
    assert abs(r.average_precision - 53 / 90) < 1e-12 and r.n_pos == 3


def test_model_beats_base_rate_and_scores(spark):
    feats = mart(spark)
    model, report = M.train_and_evaluate(feats, k=30, max_iter=10)
    base = feats.agg(F.avg("label")).first()[0]
    assert report.pr_auc > 0.5 > base
    assert (report.n_train, report.n_test, report.k) == (280, 120, 30)
    scores = M.score(model, feats, "gbt-v1", dt.datetime(2026, 2, 1))
    agg = scores.agg(F.count(F.lit(1)), F.min("fraud_score"), F.max("fraud_score")).first()
    assert agg[0] == 400 and 0.0 <= agg[1] <= agg[2] <= 1.0


def test_two_classes_required(spark):
    with pytest.raises(ModelError):
        M.train_and_evaluate(mart(spark).withColumn("label", F.lit(1)))


def _tree(node):
    """A function of the features from a tree's node of the Java model."""
    if node.getClass().getSimpleName() == "LeafNode":
        value = node.prediction()
        return lambda x: value
    split, left, right = node.split(), _tree(node.leftChild()), _tree(node.rightChild())
    at, threshold = split.featureIndex(), split.threshold()
    return lambda x: left(x) if x[at] <= threshold else right(x)


def test_scores_are_those_of_the_trees_and_survive_storage(spark, work):
    import math

    feats = mart(spark)
    model, _ = M.train_and_evaluate(feats, k=30, max_iter=4)
    M.save_model(model, f"{work}/models", "v1")
    loaded = M.load_model(f"{work}/models", "v1")
    gbt = loaded.stages[-1]
    trees = [(_tree(t._java_obj.rootNode()), w) for t, w in zip(gbt.trees, gbt.treeWeights, strict=True)]
    scored = {r.wallet_id: r.fraud_score for r in M.score(loaded, feats, "v1", dt.datetime(2026, 2, 1)).collect()}
    for r in feats.select("wallet_id", *FE.FEATURE_COLUMNS).collect():
        margin = sum(w * f([float(r[c]) for c in FE.FEATURE_COLUMNS]) for f, w in trees)
        assert abs(scored[r.wallet_id] - 1 / (1 + math.exp(-2 * margin))) < 1e-12


def test_scores_go_through_their_table_into_evidence(spark, work):
    from riskflow.operators import evidence as EV
    from riskflow.operators import serving as SV
    from riskflow.operators.scd2 import empty_dimension

    feats = mart(spark, 60)
    model, _ = M.train_and_evaluate(feats, k=30, max_iter=2)
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    for version in ("v1", "v2"):
        SV.publish_scores(spark, M.score(model, feats, version), work)
    SV.publish_scores(spark, M.score(model, feats.limit(10), "v2"), work)  # rescored wallets replace their rows
    table = SV.score_table(spark, work).read()
    assert table.count() == 120
    assert table.agg(F.min("scored_at")).first()[0] >= started - dt.timedelta(seconds=1)  # the time of the run
    facts = EV.evidence_facts(feats, empty_dimension(spark), table).where("fact LIKE 'fraud_score%'").collect()
    scores = {r.wallet_id: r.fraud_score for r in table.where("model_version = 'v2'").collect()}
    assert {r.wallet_id: (r.fact_no, r.fact) for r in facts} == {
        w: (7, f"fraud_score = {s:.3f} (model v2)") for w, s in scores.items()}


def test_states_of_two_days_fold_to_the_whole(spark):
    rows = spark.range(300).select(
        F.col("id").cast("string").alias("tx_id"), (F.col("id") % 3).cast("string").alias("wallet_id"),
        (F.col("id") % 7).cast("string").alias("counterparty_id"),
        (F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("id") % 90).cast("int"))).alias("event_ts"),
        F.col("id").cast("decimal(38,8)").alias("value"), F.when(F.col("id") % 50 == 0, "ILLICIT").otherwise("LICIT").alias("fraud_label"))
    early = F.col("event_ts") < F.lit(dt.datetime(2026, 1, 2, 12)).cast("timestamp_ntz")  # a day that lies in both parts
    for exact in (True, False):
        parts = FE.day_states(rows.where(early), exact_distinct=exact).unionByName(FE.day_states(rows.where(~early), exact_distinct=exact))
        assert sorted(FE.fold_states(parts).collect()) == sorted(FE.wallet_features(rows, exact_distinct=exact).collect())


def test_the_customer_meets_the_orders_before_the_line_items(spark):
    from riskflow.plans import domain as D

    li = spark.createDataFrame([(1, 1, 7, dt.datetime(2024, 1, 1), 5.0), (1, 2, 7, dt.datetime(2024, 1, 2), 5.0), (2, 1, 7, dt.datetime(2024, 1, 1), 5.0),
                                (3, 1, 7, dt.datetime(2024, 1, 1), 5.0), (9, 1, 7, dt.datetime(2024, 1, 1), 5.0)],
                               "l_orderkey long, l_linenumber int, l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double")
    od = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "o_orderkey long, o_custkey long")
    cu = spark.createDataFrame([(10, -1.0, "BUILDING"), (12, 1.0, "BUILDING")], "c_custkey long, c_acctbal double, c_mktsegment string")
    out = D.labelled_fact_transactions(li, od, cu)
    assert sorted((r.tx_id, r.wallet_id or "", r.fraud_label or "") for r in out.collect()) == [
        ("1-1", "w-10", "ILLICIT"), ("1-2", "w-10", "ILLICIT"), ("2-1", "w-11", ""), ("3-1", "", "")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("Join LeftOuter")  # the customer lies below


def test_a_label_feed_is_never_broadcast(spark):
    cols = "tx_id string, wallet_id string, event_ts timestamp_ntz, value decimal(38,8), counterparty_id string"
    at = dt.datetime(2026, 1, 1)
    rows = spark.createDataFrame([("a", "w", at, None, "x"), ("b", "w", at, None, "y"), (None, "v", at, None, "x")], cols)
    labels = spark.createDataFrame([("a", "ILLICIT"), ("a", "LICIT"), (None, "ILLICIT")], "tx_id string, fraud_label string")
    out = FE.with_labels(rows, labels)
    assert sorted((r.tx_id or "", r.fraud_label or "") for r in out.collect()) == [("", ""), ("a", "ILLICIT"), ("a", "LICIT"), ("b", "")]
    for df in (out, FE.day_states(rows, labels, exact_distinct=True), FE.wallet_features(rows, labels)):
        assert "BroadcastHashJoin" not in df._jdf.queryExecution().executedPlan().toString()
