"""Map the driver's TPC-H-ish tables onto the wallet-risk shapes.

  events   -> raw transaction extract (all text) and typed transactions
  events   -> transaction labels (error = ILLICIT, purchase = LICIT)
  orders   -> wallet tier snapshots (SCD2 updates)
  lineitem -> fact rows for the point-in-time join
  documents + labels -> a scored, labelled set for ranking metrics

Every mapping is a projection (plus one join for line items), so Catalyst
prunes the scans down to the columns each query uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.hashing import md5_unit
from riskflow.operators.contract import TX_CONTRACT, Contract, with_rules
from riskflow.sources.files import read_table

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Fixed values of the mapping: accepted event assets, counterparty ring size,
# tier per order priority.
EVENT_ASSETS = ("CLICK", "VIEW", "PURCHASE")
COUNTERPARTY_RING = 150
PRIORITY_TIER = {"1": "HIGH", "2": "HIGH", "3": "MEDIUM", "4": "LOW", "5": "LOW"}

EVENTS_CONTRACT = with_rules(TX_CONTRACT, accepted={"asset": EVENT_ASSETS})

CUSTOMER_CONTRACT = Contract(
    types={
        "c_custkey": "bigint",
        "c_name": "string",
        "c_nationkey": "int",
        "c_acctbal": "double",
        "c_mktsegment": "string",
    },
    key=("c_custkey",),
    required=("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
    non_negative=("c_acctbal",),
    accepted={"c_mktsegment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")},
    trim=("c_name",),
    upper=("c_mktsegment",),
)

LINEITEM_CONTRACT = Contract(
    types={
        "l_orderkey": "bigint",
        "l_linenumber": "int",
        "l_quantity": "double",
        "l_shipdate": "timestamp_ntz",
    },
    key=("l_orderkey", "l_linenumber"),
    required=("l_orderkey", "l_linenumber", "l_shipdate"),
    non_negative=("l_quantity",),
    event_time="l_shipdate",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_transactions(events: DataFrame) -> DataFrame:
    """Bronze-shaped extract: every field as text, ids/assets padded and lower case."""
    return events.select(
        F.concat(F.lit(" tx-"), F.col("event_id").cast("string"), F.lit(" ")).alias("tx_id"),
        F.concat(F.lit("w-"), F.col("user_id").cast("string")).alias("wallet_id"),
        _counterparty().alias("counterparty_id"),
        F.col("ts").cast("string").alias("event_ts"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("value"),
        F.concat(F.lit(" "), F.lower("event_type"), F.lit(" ")).alias("asset"),
    )


def _counterparty():
    return F.concat(
        F.lit("w-"), F.pmod(F.col("event_id") * 7 + 3, F.lit(COUNTERPARTY_RING)).cast("string")
    )


def _typed_transactions(events: DataFrame, with_label: bool) -> DataFrame:
    cols = [
        F.concat(F.lit("tx-"), F.col("event_id").cast("string")).alias("tx_id"),
        F.concat(F.lit("w-"), F.col("user_id").cast("string")).alias("wallet_id"),
        _counterparty().alias("counterparty_id"),
        F.col("ts").alias("event_ts"),
        F.col("value").cast("decimal(38,8)").alias("value"),
        F.upper("event_type").alias("asset"),
    ]
    if with_label:
        cols.append(_event_label().alias("fraud_label"))
    return events.select(*cols)


def transactions(events: DataFrame) -> DataFrame:
    """Typed transactions in contract shape (no text round trip)."""
    return _typed_transactions(events, with_label=False)


def _event_label():
    return (
        F.when(F.col("event_type") == "error", "ILLICIT")
        .when(F.col("event_type") == "purchase", "LICIT")
        .otherwise("UNKNOWN")
    )


def transaction_labels(events: DataFrame) -> DataFrame:
    """A separate label feed keyed by tx_id (joined to transactions on tx_id)."""
    return events.select(
        F.concat(F.lit("tx-"), F.col("event_id").cast("string")).alias("tx_id"),
        _event_label().alias("fraud_label"),
    )


def labelled_transactions(events: DataFrame) -> DataFrame:
    """``transactions`` with the label carried on each row (no join needed)."""
    return _typed_transactions(events, with_label=True)


def tier_updates(orders: DataFrame) -> DataFrame:
    """Wallet tier snapshots: (wallet_id, risk_tier, snapshot_ts, tie)."""
    prio = F.substring("o_orderpriority", 1, 1)
    tier = None
    for p, t in PRIORITY_TIER.items():
        tier = F.when(prio == p, F.lit(t)) if tier is None else tier.when(prio == p, F.lit(t))
    return orders.select(
        F.concat(F.lit("w-"), F.col("o_custkey").cast("string")).alias("wallet_id"),
        tier.alias("risk_tier"),
        F.col("o_orderdate").alias("snapshot_ts"),
        F.col("o_orderkey").alias("tie"),
    )


def _with_orders(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with the columns of their order; the orders are hashed, so the line items are not sorted."""
    li = lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice")
    return li.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def fact_rows(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items with wallet and event time, their other columns as they are stored (narrow rows for joins)."""
    return _with_orders(lineitem, orders.select("o_orderkey", "o_custkey")).select(
        F.concat(F.lit("w-"), F.col("o_custkey").cast("string")).alias("wallet_id"), F.col("l_shipdate").alias("event_ts"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


def fact_columns(rows: DataFrame, *more: str) -> DataFrame:
    """``fact_rows`` in transaction shape, with the columns ``more`` behind."""
    return rows.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tx_id"),
        "wallet_id",
        F.concat(F.lit("s-"), F.col("l_suppkey").cast("string")).alias("counterparty_id"),
        "event_ts",
        F.col("l_extendedprice").cast("decimal(38,8)").alias("value"),
        *more,
    )


def fact_transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items as transactions of the ordering customer's wallet."""
    return fact_columns(fact_rows(lineitem, orders))


def labelled_fact_transactions(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``fact_transactions`` with ``fraud_label`` from the ordering customer carried inline
    (HOUSEHOLD segment -> UNKNOWN, negative balance -> ILLICIT, else LICIT):
    one join chain instead of joining the facts to labels derived from the same rows."""
    # The customer meets the orders, so the line items are dealt once.
    cu = customer.select("c_custkey", "c_acctbal", "c_mktsegment").hint("shuffle_hash")
    od = orders.select("o_orderkey", "o_custkey").join(cu, F.col("o_custkey") == F.col("c_custkey"), "left")
    j = _with_orders(lineitem, od)
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tx_id"),
        F.concat(F.lit("w-"), F.col("o_custkey").cast("string")).alias("wallet_id"),
        F.concat(F.lit("s-"), F.col("l_suppkey").cast("string")).alias("counterparty_id"),
        F.col("l_shipdate").alias("event_ts"),
        F.col("l_extendedprice").cast("decimal(38,8)").alias("value"),
        F.when(F.col("c_custkey").isNull(), F.lit(None).cast("string"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "UNKNOWN")
        .when(F.col("c_acctbal") < 0, "ILLICIT")
        .otherwise("LICIT")
        .alias("fraud_label"),
    )


def scored_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled documents with a deterministic score in [0, 1) from their length:
    floor(1000 * n / (n + 2000)) / 1000, in integer arithmetic (exact everywhere)."""
    docs = documents.select("doc_id", "n_chars")
    return labels.select("doc_id", "quality").join(docs, "doc_id", "inner").select(
        F.col("doc_id"),
        F.col("quality").alias("label"),
        (F.expr("(n_chars * 1000) div (n_chars + 2000)").cast("double") / F.lit(1000.0)).alias("score"),
    )


def wallet_scores(wallets: DataFrame) -> DataFrame:
    """Hash-derived stand-in score per wallet (three decimals), for evidence."""
    return wallets.select(
        "wallet_id",
        md5_unit(F.col("wallet_id"), 1000).alias("fraud_score"),
        F.lit("hash-v1").alias("model_version"),
    )


ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Fixed value: a payload of an 'error' event arrives cut after this many characters.
TRUNCATED_PAYLOAD_CHARS = 30


def event_payloads(events: DataFrame, cut_errors: bool = False) -> DataFrame:
    """Events as JSON text in a ``value`` column (what a broker would carry).

    ``cut_errors``: payloads of 'error' events arrive truncated (unparseable), so the
    parser's corrupt branch sees real rows. Also keeps ``ts`` for ordering files.
    """
    ts = F.col("ts")
    body = F.concat(
        F.lit('{"tx_id":"tx-'), F.col("event_id").cast("string"),
        F.lit('","wallet_id":"w-'), F.col("user_id").cast("string"),
        F.lit('","counterparty_id":"'), _counterparty(),
        F.lit('","value":'), F.col("value").cast("decimal(12,2)").cast("string"),
        F.lit(',"asset":"'), F.upper("event_type"),
        F.lit('","event_ts":"'), F.date_format(ts, ISO_MICROS),
        F.lit('","produced_ts":"'), F.date_format(ts + F.expr("INTERVAL 2 SECONDS"), ISO_MICROS),
        F.lit('"}'),
    )
    payload = body
    if cut_errors:
        payload = F.when(F.col("event_type") == "error", F.substring(body, 1, TRUNCATED_PAYLOAD_CHARS)).otherwise(body)
    return events.select(payload.alias("value"), ts, F.col("event_type"))


def graph_feature_rows(events: DataFrame) -> DataFrame:
    """Events shaped as a labelled-graph features export: tx_id, time_step, f0, extra anonymous columns."""
    return events.select(
        F.col("event_id").alias("tx_id"),
        (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + 1).alias("time_step"),
        (F.col("value") - F.lit(100.0)).alias("f0"),
        F.col("user_id").alias("f1"),
        F.length("props").alias("f2"),
    )


def graph_class_rows(events: DataFrame) -> DataFrame:
    """Events shaped as a classes export: txId, class ('1' illicit, '2' licit, 'unknown')."""
    return events.select(
        F.col("event_id").cast("string").alias("txId"),
        F.when(F.col("event_type") == "error", "1").when(F.col("event_type") == "purchase", "2")
        .otherwise("unknown").alias("class"),
    )
