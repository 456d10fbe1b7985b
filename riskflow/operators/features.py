"""Per-wallet feature mart: one row per wallet, the same function for training and serving.

Two aggregations. The first goes through the calendar: one row per wallet and
day (and counterparty, for exact counts) with partial measures, so a hot wallet
is spread over its days and counterparties. The second combines them per
wallet. Active days are then a count of days, and no row is copied for a
second distinct count. The rows of the first (``day_states``) can be stored and
folded later (``fold_states``), so a growing history is not read again. Labels come from a join on tx_id or from a column.

Label rule (code wins over the prose of the original): any ILLICIT
transaction -> 1, else any LICIT -> 0, else NULL (left out of training).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators import measures as ME
from riskflow.operators.measures import Measure

# Feature names and order.
FEATURE_COLUMNS = [
    "tx_count",
    "total_value",
    "avg_value",
    "max_value",
    "distinct_counterparties",
    "active_days",
]

ADDITIVE = (
    Measure("tx_count", "count", "tx_id"),
    Measure("total_value", "sum", "value"),
    Measure("avg_value", "mean", "value"),
    Measure("max_value", "max", "value"),
    Measure("first_seen_ts", "min", "event_ts"),
)
LABEL_COUNTS = (
    Measure("n_illicit", "count", "fraud_label", equals="ILLICIT"),
    Measure("n_licit", "count", "fraud_label", equals="LICIT"),
)
AMOUNTS = ("total_value", "avg_value", "max_value")


def wallet_labels_expr(n_illicit, n_licit):
    return F.when(n_illicit > 0, F.lit(1)).when(n_licit > 0, F.lit(0)).otherwise(F.lit(None).cast("int"))


def with_labels(tx: DataFrame, labels: DataFrame) -> DataFrame:
    # The feed holds a row per transaction, packed far below its size in memory: never broadcast through the driver.
    return tx.join(labels.select("tx_id", "fraud_label").hint("merge"), "tx_id", "left")


def day_states(tx: DataFrame, labels: DataFrame | None = None, exact_distinct: bool = False, keep=()) -> DataFrame:
    """Mergeable states per wallet and day (and counterparty, for exact counts) of some transactions.

    Labels come from a separate feed joined on tx_id (left join), or - when
    ``tx`` already carries ``fraud_label`` - from that column, with no join.
    Without ``exact_distinct`` counterparties are HLL sketches, one per wallet and day.
    ``keep``: columns of ``tx`` to group by as well (the partition of a stored state).
    """
    rows = tx if labels is None else with_labels(tx, labels)
    taken = ADDITIVE + (LABEL_COUNTS if "fraud_label" in rows.columns else ())
    rows = rows.withColumn("_day", F.to_date("event_ts"))
    if exact_distinct:
        return rows.groupBy("wallet_id", "_day", *keep, "counterparty_id").agg(*ME.parts(taken))
    return rows.groupBy("wallet_id", "_day", *keep).agg(*ME.parts(taken), F.hll_sketch_agg("counterparty_id").alias("_peers"))


def fold_states(states: DataFrame) -> DataFrame:
    """Features per wallet from day states: wallet_id, FEATURE_COLUMNS..., first_seen_ts[, label].

    States of several runs may hold one wallet and day more than once (rows of a day in several partitions).
    """
    labelled = "n_illicit" in states.columns
    taken = ADDITIVE + (LABEL_COUNTS if labelled else ())
    # A wallet's days are bounded by the calendar; its counterparties are not, so only they are counted by a shuffle.
    peers = (F.count_distinct("counterparty_id") if "counterparty_id" in states.columns
             else F.hll_sketch_estimate(F.hll_union_agg("_peers")))
    per_wallet = states.groupBy("wallet_id").agg(*ME.wholes(taken), peers.alias("distinct_counterparties"),
                                                 F.size(F.collect_set("_day")).cast("long").alias("active_days"))
    out = ME.finished(per_wallet, taken) | {c: F.col(c) for c in ("distinct_counterparties", "active_days")}
    out |= {c: out[c].cast("double") for c in AMOUNTS}
    names = [*FEATURE_COLUMNS, "first_seen_ts"]
    if labelled:
        out["label"] = wallet_labels_expr(out["n_illicit"], out["n_licit"])
        names.append("label")
    return per_wallet.select("wallet_id", *[out[c].alias(c) for c in names])


def wallet_features(tx: DataFrame, labels: DataFrame | None = None, exact_distinct: bool = False) -> DataFrame:
    """The features of a set of transactions: ``day_states``, folded."""
    return fold_states(day_states(tx, labels, exact_distinct))


def wallet_labels(tx: DataFrame, labels: DataFrame) -> DataFrame:
    """(wallet_id, n_illicit, n_licit, label) from transaction labels."""
    counted = with_labels(tx.select("tx_id", "wallet_id"), labels).groupBy("wallet_id").agg(*ME.columns(LABEL_COUNTS))
    return counted.withColumn("label", wallet_labels_expr(F.col("n_illicit"), F.col("n_licit")))
