import datetime as dt

from riskflow.operators import evidence as EV
from riskflow.operators.scd2 import empty_dimension


def inputs(spark):
    feats = spark.createDataFrame(
        [("w-1", 42, 9000.0, "SECRET-CP", 1, dt.datetime(2026, 1, 1))],
        "wallet_id string, tx_count long, total_value double, counterparty_id string, label int, "
        "first_seen_ts timestamp_ntz")
    dims = spark.createDataFrame(
        [("w-1", "HIGH", dt.datetime(2026, 2, 1), None, True),
         ("w-1", "LOW", dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1), False)],
        empty_dimension(spark).schema)
    scores = spark.createDataFrame([("w-1", 0.87, "gbt-v1")], "wallet_id string, fraud_score double, model_version string")
    alerts = spark.createDataFrame([("w-1", dt.datetime(2026, 2, 3, 10, 0), 12, 3000.0)],
                                   "wallet_id string, window_start timestamp_ntz, tx_count long, total_value double")
    wallets = spark.createDataFrame([("w-1",), ("w-404",)], "wallet_id string")
    return wallets, feats, dims, scores, alerts


def test_facts_exact_and_ordered(spark):
    _, feats, dims, scores, alerts = inputs(spark)
    facts = [r.fact for r in EV.evidence_facts(feats, dims, scores, alerts).orderBy("fact_no").collect()]
    assert facts == [
        "feature tx_count = 42",
        "feature total_value = 9000.0",
        "risk_tier LOW from 2026-01-01 00:00:00 to 2026-02-01 00:00:00",
        "risk_tier HIGH from 2026-02-01 00:00:00 to now",
        "fraud_score = 0.870 (model gbt-v1)",
        "alert: window 2026-02-03 10:00:00 tx_count=12 total_value=3000.0",
    ]
    assert not any("SECRET-CP" in f for f in facts)


def test_report_and_refusal(spark):
    wallets, feats, dims, scores, alerts = inputs(spark)
    summary = EV.wallet_evidence(wallets, feats, dims, scores, alerts)
    lines = EV.report_lines(summary, EV.evidence_facts(feats, dims, scores, alerts))
    text = EV.report_text(lines, ["w-1", "w-404"])
    assert text["w-404"] == EV.REFUSAL
    rep = text["w-1"].split("\n")
    assert rep[0] == "Analysis for wallet w-1:" and rep[1] == "  [1] feature tx_count = 42"
    assert rep[-2] == "Question: Why was this wallet flagged?" and rep[-1] == EV.REPORT_CLOSING
    assert "SECRET-CP" not in text["w-1"] and len(rep) == 9


def test_found_needs_features_or_dimension(spark):
    wallets, feats, dims, scores, alerts = inputs(spark)
    only_score = spark.createDataFrame([("w-7", 0.5, "v")], "wallet_id string, fraud_score double, model_version string")
    w = spark.createDataFrame([("w-7",)], "wallet_id string")
    r = EV.wallet_evidence(w, feats, dims, only_score, alerts).first()
    assert r.found is False and r.has_score is True


def test_explain_named_wallets(spark):
    _, feats, dims, scores, alerts = inputs(spark)
    out = EV.explain(["w-1", "w-404"], feats, dims, scores, alerts, question="Why?")
    assert out["w-404"] == EV.REFUSAL
    assert out["w-1"].split("\n")[-2] == "Question: Why?"
    assert "  [5] fraud_score = 0.870 (model gbt-v1)" in out["w-1"]


def test_numbers_are_printed_in_full(spark):
    from riskflow.functions.text import double_text
    from pyspark.sql import functions as F

    known = {9000.0: "9000.0", 47.2133333333: "47.2133333333", 12345678.9: "12345678.9", 1e7: "10000000.0", 0.0001: "0.0001",
             0.00012345: "0.00012345", 123456789012345.6: "123456789012345.6", -2.5e8: "-250000000.0", 1e17: "1.0E17", 0.0: "0.0"}
    rows = spark.createDataFrame([(x,) for x in known], "x double").select("x", double_text(F.col("x")).alias("t"))
    assert {r.x: r.t for r in rows.collect()} == known


def test_places_follow_the_sections_of_each_wallet(spark):
    _, feats, dims, scores, alerts = inputs(spark)
    more = spark.createDataFrame([("w-2", dt.datetime(2026, 2, 3, k), k, 1.0) for k in (5, 3, 4)], alerts.schema)
    only_score = spark.createDataFrame([("w-3", 0.5, "v")], scores.schema)
    facts = EV.evidence_facts(feats, dims, scores.unionByName(only_score), alerts.unionByName(more)).collect()
    of = lambda w: [f for _, f in sorted((r.fact_no, r.fact) for r in facts if r.wallet_id == w)]
    assert [r.fact_no for r in sorted(facts, key=lambda r: r.fact_no) if r.wallet_id == "w-2"] == [1, 2, 3]
    assert [f[-24:-22] for f in of("w-2")] == ["03", "04", "05"] or [" tx_count=3 " in f for f in of("w-2")] == [True, False, False]
    assert of("w-3") == ["fraud_score = 0.500 (model v)"] and len(of("w-1")) == 6
