"""Analyst-facing views: masked tables, risk tiers, top-risk list, headline numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.scoring import HIGH_RISK_THRESHOLD, risk_tier
from riskflow.operators.model import top_k
from riskflow.sinks.keyed import KeyedTable

# Columns hidden from analysts per table.
FACT_MASK = ("wallet_id", "counterparty_id")
DIM_MASK = ("wallet_id",)
TOP_RISK_K = 15


def masked_view(df: DataFrame, masked) -> DataFrame:
    """The table without ``masked`` columns (a projection: pruned at the scan)."""
    return df.drop(*[c for c in masked if c in df.columns])


def register_masked_views(spark, fact: DataFrame, dim: DataFrame, prefix: str = "analyst_") -> None:
    """Analyst-safe views: the fact without wallet/counterparty ids, the dimension without wallet ids."""
    from riskflow.sinks.tables import materialize_view

    materialize_view(masked_view(fact, FACT_MASK), f"{prefix}fact_transaction")
    materialize_view(masked_view(dim, DIM_MASK), f"{prefix}dim_wallet")


def with_risk_tier(scores: DataFrame, score: str = "fraud_score", threshold: float = HIGH_RISK_THRESHOLD
                   ) -> DataFrame:
    return scores.withColumn("risk_tier", risk_tier(F.col(score), threshold))


def top_risk(scores: DataFrame, k: int = TOP_RISK_K, score: str = "fraud_score", key: str = "wallet_id"
             ) -> DataFrame:
    return top_k(scores, k, score, key)


def score_table(spark, root: str) -> KeyedTable:
    """Scores keyed (wallet_id, model_version); each model version is one partition."""
    return KeyedTable(spark, root, ["wallet_id", "model_version"], "model_version")


def publish_scores(spark, scores: DataFrame, root: str) -> int:
    """Upsert scores into the score table; rows written."""
    return score_table(spark, root).upsert(scores)


def kpis(scores: DataFrame, report=None) -> DataFrame:
    """Headline numbers in one row: wallets scored, plus the evaluation report's
    pr_auc, precision_at_k, k, n_train, n_test, split_ts when ``report`` (an EvalReport) is given."""
    counted = scores.agg(F.count_distinct("wallet_id").alias("wallets_scored"))
    if report is None:
        return counted
    return counted.select(
        F.lit(report.pr_auc).cast("double").alias("pr_auc"),
        F.lit(report.precision_at_k).cast("double").alias("precision_at_k"),
        F.lit(report.k).cast("int").alias("k"),
        "wallets_scored",
        F.lit(report.n_train).cast("long").alias("n_train"),
        F.lit(report.n_test).cast("long").alias("n_test"),
        F.lit(report.split_ts).alias("split_ts"),
    )
