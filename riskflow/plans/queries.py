"""Registered queries over the driver tables, each with its DuckDB twin.

Every query reads whole tables (or data Spark derives from them); none
filters by id ranges or caps rows. Oracle SQL repeats the same mappings as
CTEs so the comparison is end to end.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from riskflow.operators import checks as K
from riskflow.operators import contract as C
from riskflow.operators import evidence as EV
from riskflow.operators import features as FE
from riskflow.operators import model as M
from riskflow.operators import scd2 as S
from riskflow.operators import serving as SV
from riskflow.operators.dedupe import dedupe_transactions, latest_per_key
from riskflow.operators.velocity import velocity_features
from riskflow.plans import domain as D
from riskflow.plans.registry import register
from riskflow.session import materialize, scratch_path
from riskflow.sinks.tables import materialize_view

# Injected "now" values: audits and freshness rules never read the wall clock.
EVENTS_AUDIT_NOW = dt.datetime(2024, 1, 20, 0, 0, 0)
LINEITEM_AUDIT_NOW = dt.datetime(1999, 1, 1, 0, 0, 0)

# ---------------------------------------------------------------------------
# Oracle CTEs: the same mappings as riskflow.plans.domain, in DuckDB SQL.
# ---------------------------------------------------------------------------

SQL_TX = """tx AS (
  SELECT 'tx-' || event_id AS tx_id, 'w-' || user_id AS wallet_id,
         'w-' || ((event_id * 7 + 3) % 150) AS counterparty_id,
         ts AS event_ts, CAST(value AS DECIMAL(38,8)) AS value, upper(event_type) AS asset
  FROM events)"""

SQL_RAW = """raw AS (
  SELECT ' tx-' || event_id || ' ' AS tx_id, 'w-' || user_id AS wallet_id,
         'w-' || ((event_id * 7 + 3) % 150) AS counterparty_id,
         CAST(ts AS VARCHAR) AS event_ts,
         CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS value,
         ' ' || lower(event_type) || ' ' AS asset
  FROM events)"""

SQL_NORM = """norm AS (
  SELECT trim(tx_id) AS tx_id, trim(wallet_id) AS wallet_id, counterparty_id,
         TRY_CAST(trim(event_ts) AS TIMESTAMP) AS event_ts,
         TRY_CAST(trim(value) AS DECIMAL(38,8)) AS value,
         upper(trim(asset)) AS asset
  FROM raw)"""

SQL_TX_BREACH = """concat_ws(',',
    CASE WHEN tx_id IS NULL THEN 'null_tx_id' END,
    CASE WHEN wallet_id IS NULL THEN 'null_wallet_id' END,
    CASE WHEN event_ts IS NULL THEN 'null_event_ts' END,
    CASE WHEN value IS NULL THEN 'null_value' END,
    CASE WHEN asset IS NULL THEN 'null_asset' END,
    CASE WHEN value < 0 THEN 'negative_value' END,
    CASE WHEN asset IS NOT NULL AND asset NOT IN ('CLICK', 'VIEW', 'PURCHASE') THEN 'unaccepted_asset' END)"""

SQL_LABELS = """lbl AS (
  SELECT 'tx-' || event_id AS tx_id,
         CASE WHEN event_type = 'error' THEN 'ILLICIT'
              WHEN event_type = 'purchase' THEN 'LICIT' ELSE 'UNKNOWN' END AS fraud_label
  FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _events_tx(spark, sf):
    return D.transactions(D.table(spark, sf, "events"))


def _normalized_events(spark, sf):
    return C.normalize(D.raw_transactions(D.table(spark, sf, "events")), D.EVENTS_CONTRACT)


# ---------------------------------------------------------------------------
# Contract: normalize, quarantine, silver chain, audit
# ---------------------------------------------------------------------------


@register(
    "normalize_contract",
    "B1 H1 H2 H3 H4",
    _with(SQL_RAW, SQL_NORM) + "SELECT * FROM norm",
)
def normalize_contract(spark, sf):
    return _normalized_events(spark, sf)


@register(
    "quarantine_split_clean",
    "B2 B3 B4 B5",
    _with(SQL_RAW, SQL_NORM) + f"SELECT * FROM norm WHERE {SQL_TX_BREACH} = ''",
)
def quarantine_split_clean(spark, sf):
    clean, _ = C.split_quarantine(_normalized_events(spark, sf), D.EVENTS_CONTRACT)
    return clean


@register(
    "quarantine_split_bad",
    "B2 B3 B4 B5",
    _with(SQL_RAW, SQL_NORM)
    + f"SELECT *, {SQL_TX_BREACH} AS breach_reasons FROM norm WHERE {SQL_TX_BREACH} <> ''",
)
def quarantine_split_bad(spark, sf):
    _, bad = C.split_quarantine(_normalized_events(spark, sf), D.EVENTS_CONTRACT)
    return bad


@register(
    "quarantine_customer",
    "B2 B4 B5 (contract on customer)",
    """
    WITH n AS (
      SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, upper(trim(c_mktsegment)) AS c_mktsegment
      FROM customer)
    SELECT *, concat_ws(',',
        CASE WHEN c_custkey IS NULL THEN 'null_c_custkey' END,
        CASE WHEN c_name IS NULL THEN 'null_c_name' END,
        CASE WHEN c_acctbal IS NULL THEN 'null_c_acctbal' END,
        CASE WHEN c_mktsegment IS NULL THEN 'null_c_mktsegment' END,
        CASE WHEN c_acctbal < 0 THEN 'negative_c_acctbal' END,
        CASE WHEN c_mktsegment IS NOT NULL AND c_mktsegment NOT IN
          ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY') THEN 'unaccepted_c_mktsegment' END
      ) AS breach_reasons
    FROM n
    WHERE breach_reasons <> ''
    """,
)
def quarantine_customer(spark, sf):
    cust = C.normalize(D.table(spark, sf, "customer"), D.CUSTOMER_CONTRACT)
    _, bad = C.split_quarantine(cust, D.CUSTOMER_CONTRACT)
    return bad


@register(
    "dedupe_latest",
    "E1",
    """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn
      FROM lineitem) WHERE rn = 1
    """,
)
def dedupe_latest(spark, sf):
    li = D.table(spark, sf, "lineitem")
    order = [F.col("l_shipdate").desc(), "l_partkey", "l_suppkey", "l_extendedprice"]
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], order)


@register(
    "silver_chain",
    "B6 B1 B2 E1",
    _with(SQL_RAW, SQL_NORM)
    + f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY event_ts DESC, wallet_id) AS rn
      FROM norm WHERE {SQL_TX_BREACH} = '') WHERE rn = 1
    """,
)
def silver_chain(spark, sf):
    clean, _ = C.split_quarantine(_normalized_events(spark, sf), D.EVENTS_CONTRACT)
    return dedupe_transactions(clean)


def _audit_sql(source_cte: str, key_expr: str, key_ok: str, key_name: str, neg: str, neg_name: str,
               ts: str, now: str) -> str:
    return f"""
    {source_cte}
    , a AS (
      SELECT count(*) AS row_count,
             count(*) FILTER (WHERE {key_ok}) AS n_key,
             count(DISTINCT CASE WHEN {key_ok} THEN {key_expr} END) AS n_key_distinct,
             count(*) FILTER (WHERE {neg} < 0) AS n_negative,
             count(*) FILTER (WHERE {ts} > TIMESTAMP '{now}') AS n_future,
             count(*) FILTER (WHERE {ts} IS NULL) AS n_null_ts
      FROM src)
    SELECT row_count, n_key, n_key_distinct, n_negative, n_future, n_null_ts,
           concat_ws('; ',
             CASE WHEN row_count < 1 OR row_count > 10000000
                  THEN printf('row_count %d outside [1, 10000000]', row_count) END,
             CASE WHEN n_key <> n_key_distinct
                  THEN printf('{key_name} not unique: %d duplicate rows', n_key - n_key_distinct) END,
             CASE WHEN n_negative > 0 THEN printf('%d rows with negative {neg_name}', n_negative) END,
             CASE WHEN n_future > 0 THEN printf('%d rows with {ts} in the future', n_future) END,
             CASE WHEN n_null_ts > 0 THEN printf('%d rows with null {ts}', n_null_ts) END
           ) AS breaches,
           breaches = '' AS passed
    FROM a
    """


@register(
    "audit_events",
    "D1a D6a D7a D10a G3 J1 J2 J3 J4 J5 J6 J7",
    _audit_sql(
        _with(SQL_RAW, SQL_NORM) + ", src AS (SELECT * FROM norm)",
        "tx_id", "tx_id IS NOT NULL", "tx_id", "value", "value", "event_ts", "2024-01-20 00:00:00",
    ),
)
def audit_events(spark, sf):
    return C.audit_frame(_normalized_events(spark, sf), D.EVENTS_CONTRACT, now=EVENTS_AUDIT_NOW)


@register(
    "audit_lineitem",
    "D1a J2 J3 J4 J5 J6 (composite key)",
    _audit_sql(
        "WITH src AS (SELECT * FROM lineitem)",
        "(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR))",
        "l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL",
        "l_orderkey+l_linenumber", "l_quantity", "l_quantity", "l_shipdate", "1999-01-01 00:00:00",
    ),
)
def audit_lineitem(spark, sf):
    li = D.table(spark, sf, "lineitem")
    return C.audit_frame(li, D.LINEITEM_CONTRACT, now=LINEITEM_AUDIT_NOW)


# ---------------------------------------------------------------------------
# Velocity aggregates (batch form of the stream's operator)
# ---------------------------------------------------------------------------


def _velocity_sql(interval: str) -> str:
    return _with(SQL_TX) + f"""
    SELECT time_bucket(INTERVAL '{interval}', event_ts) AS window_start,
           time_bucket(INTERVAL '{interval}', event_ts) + INTERVAL '{interval}' AS window_end,
           wallet_id, count(tx_id) AS tx_count, sum(value) AS total_value,
           count(DISTINCT counterparty_id) AS distinct_counterparties,
           max(value) AS max_single_value
    FROM tx GROUP BY 1, 2, 3
    """


@register("velocity_10min", "D5a I2 D6a D7a D9a", _velocity_sql("10 minutes"))
def velocity_10min(spark, sf):
    return velocity_features(_events_tx(spark, sf), "10 minutes", exact_distinct=True)


@register("velocity_1day", "D5a I2 (1-day window)", _velocity_sql("1 day"))
def velocity_1day(spark, sf):
    return velocity_features(_events_tx(spark, sf), "1 day", exact_distinct=True)


# An estimate counts as close within three standard errors of five per cent, and one.
ESTIMATE_CLOSE = "abs(estimate - exact_count) <= 1 + 0.15 * exact_count"


def held_to_exact(estimated, exact, keys, flagged=False):
    """``estimated`` with its distinct counts held against the exact ones: one that is not close gives way to the exact count.

    ``flagged``: ``distinct_counterparties_close`` tells whether the estimate was close (not, where there is no exact count).
    """
    known = exact.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("distinct_counterparties").alias("exact_count"))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    count = F.expr(f"CASE WHEN exact_count IS NULL OR {ESTIMATE_CLOSE} THEN estimate ELSE exact_count END")
    joined = estimated.withColumnRenamed("distinct_counterparties", "estimate").join(known, same, "left")
    flag = [F.coalesce(F.expr(ESTIMATE_CLOSE), F.lit(False)).alias("distinct_counterparties_close")] if flagged else []
    return joined.withColumn("distinct_counterparties", count).select(*estimated.columns, *flag)


# HLL++ at five per cent keeps 512 registers, chosen by the first nine bits of xxhash64 (seed 42) of the value. There are at most
# 150 counterparties, for which the estimate is a linear count of the registers met: 512 * ln(512 / those not met).
_P1, _P2, _P3, _P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 2870177450012600261
_TWO64 = 1 << 64


def _mul(a, b: int) -> str:
    return f"({a} * {b}::UHUGEINT % {_TWO64}::UHUGEINT)"


def _rotl(h: str, bits: int) -> str:
    return f"({_mul(h, 1 << bits)} + {h} // {1 << (64 - bits)}::UHUGEINT)"


def _xor(a: str, b: str) -> str:
    return f"xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT))::UHUGEINT"


def _byte(at: str) -> str:
    return f"ascii(substr(counterparty_id, {at}, 1))::UHUGEINT"


def _registers_sql() -> str:
    """CTE ``registers``: the register of every counterparty id (three to five bytes)."""
    word = " + ".join(f"{_byte(str(i + 1))} * {1 << 8 * i}" for i in range(4))
    steps = [f"CASE WHEN n >= 4 THEN {_xor('h', _mul(f'({word})', _P1))} ELSE h END",
             f"CASE WHEN n >= 4 THEN ({_mul(_rotl('h', 23), _P2)} + {_P3}::UHUGEINT) % {_TWO64}::UHUGEINT ELSE h END"]
    for j in range(3):  # what is left of the bytes, one by one
        at, left = f"n // 4 * 4 + {j + 1}", f"n % 4 > {j}"
        steps += [f"CASE WHEN {left} THEN {_xor('h', _mul(_byte(at), _P5))} ELSE h END",
                  f"CASE WHEN {left} THEN {_mul(_rotl('h', 11), _P1)} ELSE h END"]
    for shift, prime in ((33, _P2), (29, _P3), (32, 1)):
        steps += [_xor("h", f"h // {1 << shift}::UHUGEINT"), _mul("h", prime)]
    out = ["x0 AS (SELECT DISTINCT counterparty_id, length(counterparty_id) AS n, "
           f"({42 + _P5} + length(counterparty_id))::UHUGEINT AS h FROM tx WHERE counterparty_id IS NOT NULL)"]
    out += [f"x{i} AS (SELECT counterparty_id, n, {step} AS h FROM x{i - 1})" for i, step in enumerate(steps, 1)]
    return ",\n".join([*out, f"registers AS (SELECT counterparty_id, h // {1 << 55}::UHUGEINT AS register FROM x{len(steps)})"])


def _estimated_velocity_sql(interval: str, flagged: bool = False) -> str:
    flag = f", {ESTIMATE_CLOSE} AS distinct_counterparties_close" if flagged else ""
    return _with(SQL_TX, _registers_sql()) + f"""
    SELECT * EXCLUDE (exact_count, estimate),
           CAST(CASE WHEN {ESTIMATE_CLOSE} THEN estimate ELSE exact_count END AS BIGINT) AS distinct_counterparties{flag}
    FROM (
      SELECT time_bucket(INTERVAL '{interval}', event_ts) AS window_start,
             time_bucket(INTERVAL '{interval}', event_ts) + INTERVAL '{interval}' AS window_end,
             wallet_id, count(tx_id) AS tx_count, sum(value) AS total_value, max(value) AS max_single_value,
             count(DISTINCT counterparty_id) AS exact_count,
             round(512 * ln(512 / (512 - count(DISTINCT register)))) AS estimate
      FROM tx LEFT JOIN registers USING (counterparty_id) GROUP BY 1, 2, 3)
    """


@register("velocity_10min_hll", "D5a D8a (HLL++ distinct counts, held against the exact ones)", _estimated_velocity_sql("10 minutes"))
def velocity_10min_hll(spark, sf):
    tx = _events_tx(spark, sf)
    return held_to_exact(velocity_features(tx, "10 minutes", exact_distinct=False),
                         velocity_features(tx, "10 minutes", exact_distinct=True), ["window_start", "wallet_id"])


# ---------------------------------------------------------------------------
# SCD2 dimension, point-in-time fact, table tests
# ---------------------------------------------------------------------------


SPLIT_TS = dt.datetime(1998, 1, 1)

SQL_TIER = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'HIGH' WHEN '2' THEN 'HIGH'
    WHEN '3' THEN 'MEDIUM' WHEN '4' THEN 'LOW' WHEN '5' THEN 'LOW' END"""


def _sql_dim(name: str, batch_expr: str, where: str = "TRUE") -> str:
    """Closed form of applying batches in order: latest per (wallet, batch),
    keep batches whose tier differs from the previous one, valid_to = next valid_from."""
    return f"""
  {name}_upd AS (
    SELECT 'w-' || o_custkey AS wallet_id, {SQL_TIER} AS risk_tier, o_orderdate AS snapshot_ts,
           o_orderkey AS tie, {batch_expr} AS batch
    FROM orders WHERE {where}),
  {name}_latest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY wallet_id, batch
                     ORDER BY snapshot_ts DESC, tie DESC) AS rn FROM {name}_upd) WHERE rn = 1),
  {name}_kept AS (
    SELECT * FROM (SELECT *, lag(risk_tier) OVER (PARTITION BY wallet_id ORDER BY batch) AS prev,
                          row_number() OVER (PARTITION BY wallet_id ORDER BY batch) AS k
                   FROM {name}_latest)
    WHERE k = 1 OR prev IS DISTINCT FROM risk_tier),
  {name} AS (
    SELECT wallet_id, risk_tier, valid_from, valid_to, valid_to IS NULL AS is_current FROM (
      SELECT wallet_id, risk_tier, snapshot_ts AS valid_from,
             lead(snapshot_ts) OVER (PARTITION BY wallet_id ORDER BY batch) AS valid_to
      FROM {name}_kept))"""


SQL_TWO_BATCH = "CASE WHEN o_orderdate < TIMESTAMP '1998-01-01 00:00:00' THEN 1 ELSE 2 END"
SQL_YEAR_BATCH = "year(o_orderdate)"

SQL_FACTS = """facts AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_id,
           'w-' || o_custkey AS wallet_id, 's-' || l_suppkey AS counterparty_id, l_shipdate AS event_ts,
           CAST(l_extendedprice AS DECIMAL(38,8)) AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SQL_PIT = """pit AS (
    SELECT f.tx_id, f.wallet_id, f.counterparty_id, f.event_ts, f.value, d.risk_tier AS wallet_risk_tier_at_event
    FROM facts f LEFT JOIN dim d
      ON d.wallet_id = f.wallet_id AND f.event_ts >= d.valid_from
     AND (d.valid_to IS NULL OR f.event_ts < d.valid_to))"""


def _updates(spark, sf, batch: str):
    upd = D.tier_updates(D.table(spark, sf, "orders"))
    if batch == "two":
        b = F.when(F.col("snapshot_ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"), 1).otherwise(2)
    else:
        b = F.year("snapshot_ts")
    return upd.withColumn("batch", b)


def _dim_yearly(spark, sf):
    return S.scd2_rebuild(_updates(spark, sf, "yearly"), "batch", tie="tie")


def _two_batch_states(spark, sf):
    upd = _updates(spark, sf, "two")
    dim0 = S.empty_dimension(spark)
    dim1 = materialize(S.scd2_apply(dim0, upd.where("batch = 1"), tie="tie"), "scd2-batch1")
    dim2 = S.scd2_apply(dim1, upd.where("batch = 2"), tie="tie")
    return dim1, dim2


@register(
    "scd2_two_batches",
    "C1 C5 C7 G1 E2 A13 A14 A15",
    "WITH" + _sql_dim("dim", SQL_TWO_BATCH) + "\nSELECT * FROM dim",
)
def scd2_two_batches(spark, sf):
    return _two_batch_states(spark, sf)[1]


@register(
    "scd2_yearly_batches",
    "C1 C5 C7 G1 E2 A13 A14 A15 (7 batches applied in order)",
    "WITH" + _sql_dim("dim", SQL_YEAR_BATCH) + "\nSELECT * FROM dim",
)
def scd2_yearly_batches(spark, sf):
    return S.scd2_apply_batches(S.empty_dimension(spark), _updates(spark, sf, "yearly"), "batch", tie="tie")


@register(
    "scd2_rebuild_yearly",
    "E2 E4 (whole history in one job)",
    "WITH" + _sql_dim("dim", SQL_YEAR_BATCH) + "\nSELECT * FROM dim",
)
def scd2_rebuild_yearly(spark, sf):
    return _dim_yearly(spark, sf)


@register(
    "scd2_checks_doubled",
    "J10 J11 E4 D12a G2",
    "WITH" + _sql_dim("d1", SQL_TWO_BATCH, "o_orderdate < TIMESTAMP '1998-01-01 00:00:00'") + ","
    + _sql_dim("d2", SQL_TWO_BATCH)
    + """,
  dims AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2),
  ordered AS (
    SELECT wallet_id, valid_from, valid_to,
           lead(valid_from) OVER (PARTITION BY wallet_id
             ORDER BY valid_from ASC NULLS LAST, valid_to ASC NULLS LAST) AS next_from
    FROM dims)
SELECT wallet_id, 'overlapping_range' AS breach FROM ordered
WHERE valid_to IS NOT NULL AND next_from IS NOT NULL AND valid_to > next_from
UNION ALL
SELECT wallet_id, 'multiple_current_rows' AS breach FROM dims WHERE is_current
GROUP BY wallet_id HAVING count(*) > 1""",
)
def scd2_checks_doubled(spark, sf):
    # A non-idempotent append of the state after each batch: the checks must flag it.
    dim1, dim2 = _two_batch_states(spark, sf)
    return K.scd2_breaches(dim1.unionByName(dim2))


def _fact_pit(spark, sf, salted: bool = False):
    facts = D.fact_rows(D.table(spark, sf, "lineitem"), D.table(spark, sf, "orders"))
    how = {"skew_share": _partition_share(spark)} if salted else {}
    tier = "wallet_risk_tier_at_event"
    joined = S.point_in_time_join(facts, _dim_yearly(spark, sf), rename={"risk_tier": tier}, **how)
    return D.fact_columns(joined, tier)  # texts and decimals are made behind the exchanges


def _partition_share(spark) -> float:
    """Hot = more rows than an average shuffle partition holds."""
    return 1 / int(spark.conf.get("spark.sql.shuffle.partitions"))


_PIT_SQL = "WITH" + _sql_dim("dim", SQL_YEAR_BATCH) + ",\n  " + SQL_FACTS + ",\n  " + SQL_PIT + "\n"


@register("fact_point_in_time", "C2 B9 H6 H17", _PIT_SQL + "SELECT * FROM pit")
def fact_point_in_time(spark, sf):
    return _fact_pit(spark, sf)


@register("fact_point_in_time_salted", "C2 (hot wallets salted)", _PIT_SQL + "SELECT * FROM pit")
def fact_point_in_time_salted(spark, sf):
    return _fact_pit(spark, sf, salted=True)


# Pooled wallets, one per order status: each holds about a third of all facts.
@register(
    "fact_point_in_time_pooled",
    "C2 (hot wallets salted)",
    _PIT_SQL.replace("o_custkey", "o_orderstatus") + "SELECT * FROM pit",
)
def fact_point_in_time_pooled(spark, sf):
    orders = D.table(spark, sf, "orders").withColumn("o_custkey", F.col("o_orderstatus"))
    updates = D.tier_updates(orders).withColumn("batch", F.year("snapshot_ts"))
    return S.point_in_time_join(D.fact_transactions(D.table(spark, sf, "lineitem"), orders),
                                S.scd2_rebuild(updates, "batch", tie="tie"),
                                rename={"risk_tier": "wallet_risk_tier_at_event"}, skew_share=_partition_share(spark))


@register(
    "dq_not_null_fact",
    "J8",
    _PIT_SQL + """SELECT *, concat_ws(',',
        CASE WHEN tx_id IS NULL THEN 'tx_id' END,
        CASE WHEN wallet_id IS NULL THEN 'wallet_id' END,
        CASE WHEN wallet_risk_tier_at_event IS NULL THEN 'wallet_risk_tier_at_event' END) AS null_columns
    FROM pit WHERE tx_id IS NULL OR wallet_id IS NULL OR wallet_risk_tier_at_event IS NULL""",
)
def dq_not_null_fact(spark, sf):
    return K.not_null_violations(_fact_pit(spark, sf), ["tx_id", "wallet_id", "wallet_risk_tier_at_event"])


@register(
    "dq_unique_lineitem",
    "J9 D12a",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def dq_unique_lineitem(spark, sf):
    return K.unique_violations(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "dq_accepted_asset",
    "J12 (accepted values)",
    _with(SQL_TX) + "SELECT * FROM tx WHERE asset IS NOT NULL AND asset NOT IN ('CLICK', 'VIEW', 'PURCHASE')",
)
def dq_accepted_asset(spark, sf):
    return K.accepted_values_violations(_events_tx(spark, sf), "asset", D.EVENT_ASSETS)


@register(
    "dq_relationship_wallet",
    "J12 (relationship) C5",
    "WITH" + _sql_dim("dim", SQL_YEAR_BATCH) + ",\n  " + SQL_TX + """
    SELECT * FROM tx WHERE wallet_id NOT IN (SELECT wallet_id FROM dim WHERE is_current)""",
)
def dq_relationship_wallet(spark, sf):
    cur = _dim_yearly(spark, sf).where("is_current")
    return K.relationship_violations(_events_tx(spark, sf), cur, "wallet_id")


# ---------------------------------------------------------------------------
# Feature mart, model layer, serving views
# ---------------------------------------------------------------------------


SCORED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)
ALERT_MIN_TX = 2


# The mean as the mart has it: an exact quotient of twelve places (half up), read as a double.
_UNSCALED = "CAST(replace(CAST(sum(value) AS VARCHAR), '.', '') AS HUGEINT)"
_TWELVE = f"((abs({_UNSCALED}) * 20000 + count(value)) // (2 * count(value)))"
SQL_AVG = (f"CAST(CASE WHEN sum(value) < 0 THEN '-' ELSE '' END || CAST({_TWELVE} // 1000000000000 AS VARCHAR) || '.' "
           f"|| lpad(CAST({_TWELVE} % 1000000000000 AS VARCHAR), 12, '0') AS DOUBLE)")


def _feature_sql(tx_cte: str, lbl_cte: str | None) -> str:
    """Feature mart twin; with ``lbl_cte`` None the tx CTE carries fraud_label itself."""
    lbl = f"\n  {lbl_cte}," if lbl_cte else ""
    src = "tx LEFT JOIN lbl USING (tx_id)" if lbl_cte else "tx"
    return f"""{tx_cte},{lbl}
  feats AS (
    SELECT wallet_id, count(tx_id) AS tx_count, CAST(sum(value) AS DOUBLE) AS total_value,
           {SQL_AVG} AS avg_value, CAST(max(value) AS DOUBLE) AS max_value,
           count(DISTINCT counterparty_id) AS distinct_counterparties,
           count(DISTINCT CAST(event_ts AS DATE)) AS active_days, min(event_ts) AS first_seen_ts,
           CASE WHEN count_if(fraud_label = 'ILLICIT') > 0 THEN 1
                WHEN count_if(fraud_label = 'LICIT') > 0 THEN 0 END AS label
    FROM {src} GROUP BY wallet_id)"""


SQL_FACT_TX = """tx AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_id,
           'w-' || o_custkey AS wallet_id, 's-' || l_suppkey AS counterparty_id, l_shipdate AS event_ts,
           CAST(l_extendedprice AS DECIMAL(38,8)) AS value
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

SQL_FACT_TX_LABELLED = """tx AS (
    SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS tx_id,
           'w-' || o_custkey AS wallet_id, 's-' || l_suppkey AS counterparty_id, l_shipdate AS event_ts,
           CAST(l_extendedprice AS DECIMAL(38,8)) AS value,
           CASE WHEN c_custkey IS NULL THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN 'UNKNOWN'
                WHEN c_acctbal < 0 THEN 'ILLICIT' ELSE 'LICIT' END AS fraud_label
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""

def _event_features(spark, sf, exact=True):
    ev = D.table(spark, sf, "events")
    return FE.wallet_features(D.transactions(ev), D.transaction_labels(ev), exact_distinct=exact)


def _model_features(spark, sf, exact=True):
    li, od = D.table(spark, sf, "lineitem"), D.table(spark, sf, "orders")
    cu = D.table(spark, sf, "customer")
    return FE.wallet_features(D.labelled_fact_transactions(li, od, cu), exact_distinct=exact)


@register("wallet_features", "D2a D3a D4a D11a C3 C4 K7 H5 H13",
          "WITH " + _feature_sql(SQL_TX, SQL_LABELS) + "\nSELECT * FROM feats")
def wallet_features_q(spark, sf):
    return _event_features(spark, sf)


@register("wallet_features_lineitem", "D2a D3a D4a K7 (model dataset)",
          "WITH " + _feature_sql(SQL_FACT_TX_LABELLED, None) + "\nSELECT * FROM feats")
def wallet_features_lineitem(spark, sf):
    return _model_features(spark, sf)


# At most 150 counterparties: so few a sketch holds one by one, and its estimate is their count.
@register("wallet_features_hll", "D2a D8a (HLL sketches, held against the exact count)",
          "WITH " + _feature_sql(SQL_TX, SQL_LABELS) + "\nSELECT *, TRUE AS distinct_counterparties_close FROM feats")
def wallet_features_hll(spark, sf):
    return held_to_exact(_event_features(spark, sf, exact=False), _event_features(spark, sf), ["wallet_id"], flagged=True)


@register(
    "wallet_labels",
    "D3a D4a D10a C3",
    _with(SQL_TX, SQL_LABELS) + """
    SELECT wallet_id, count_if(fraud_label = 'ILLICIT') AS n_illicit, count_if(fraud_label = 'LICIT') AS n_licit,
           CASE WHEN count_if(fraud_label = 'ILLICIT') > 0 THEN 1
                WHEN count_if(fraud_label = 'LICIT') > 0 THEN 0 END AS label
    FROM tx LEFT JOIN lbl USING (tx_id) GROUP BY wallet_id""",
)
def wallet_labels_q(spark, sf):
    ev = D.table(spark, sf, "events")
    return FE.wallet_labels(D.transactions(ev), D.transaction_labels(ev))


@register(
    "time_split",
    "K1 F1 B16",
    "WITH " + _feature_sql(SQL_FACT_TX_LABELLED, None) + """,
  r AS (SELECT wallet_id, first_seen_ts, label,
               row_number() OVER (ORDER BY first_seen_ts, wallet_id) - 1 AS split_position,
               count(*) OVER () AS n
        FROM feats WHERE label IS NOT NULL)
SELECT wallet_id, first_seen_ts, label, split_position,
       CASE WHEN split_position < CAST(floor(n * (1.0::DOUBLE - 0.3::DOUBLE)) AS BIGINT)
            THEN 'train' ELSE 'test' END AS split
FROM r""",
)
def time_split_q(spark, sf):
    feats = _model_features(spark, sf).select("wallet_id", "first_seen_ts", "label").na.drop(subset=["label"])
    return M.split_frame(feats).select("wallet_id", "first_seen_ts", "label", "split_position", "split")


SQL_SCORED_DOCS = """sd AS (
    SELECT l.doc_id, l.quality AS label,
           CAST((d.n_chars * 1000) // (d.n_chars + 2000) AS DOUBLE) / 1000.0::DOUBLE AS score
    FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


@register(
    "average_precision",
    "K3",
    _with(SQL_SCORED_DOCS) + """,
  g AS (SELECT score, CAST(sum(label) AS BIGINT) AS tp, count(*) AS n FROM sd GROUP BY score),
  c AS (SELECT tp, n,
               sum(tp) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_tp,
               sum(n) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_n
        FROM g)
SELECT CAST(sum(n) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS n_pos,
       round(sum(tp * (CAST(cum_tp AS DOUBLE) / cum_n)) / sum(tp), 10) AS average_precision
FROM c""",
)
def average_precision_q(spark, sf):
    sd = D.scored_documents(D.table(spark, sf, "documents"), D.table(spark, sf, "labels"))
    return M.average_precision(sd).withColumn("average_precision", F.round("average_precision", 10))


@register(
    "precision_at_k",
    "K4 F2",
    _with(SQL_SCORED_DOCS) + """
SELECT count(*) AS k, round(avg(CAST(label AS DOUBLE)), 10) AS precision_at_k
FROM (SELECT * FROM sd ORDER BY score DESC, doc_id ASC LIMIT 50)""",
)
def precision_at_k_q(spark, sf):
    sd = D.scored_documents(D.table(spark, sf, "documents"), D.table(spark, sf, "labels"))
    return M.precision_at_k(sd, 50, key="doc_id").withColumn("precision_at_k", F.round("precision_at_k", 10))


SQL_WALLET_SCORES = """sc AS (
    SELECT wallet_id,
           CAST(CAST(concat('0x', substr(md5(wallet_id), 1, 15)) AS BIGINT) % 1000 AS DOUBLE) / 1000.0::DOUBLE
             AS fraud_score,
           'hash-v1' AS model_version
    FROM (SELECT DISTINCT 'w-' || user_id AS wallet_id FROM events))"""


def _hash_scores(spark, sf):
    wallets = D.transactions(D.table(spark, sf, "events")).select("wallet_id").distinct()
    return D.wallet_scores(wallets)


@register(
    "top_risk",
    "F3 L7 F2 H7",
    _with(SQL_WALLET_SCORES) + "SELECT * FROM sc ORDER BY fraud_score DESC, wallet_id LIMIT 15",
)
def top_risk_q(spark, sf):
    return SV.top_risk(_hash_scores(spark, sf))


@register(
    "risk_tier",
    "B17",
    _with(SQL_WALLET_SCORES)
    + "SELECT *, CASE WHEN fraud_score > 0.7 THEN 'HIGH' ELSE 'LOW' END AS risk_tier FROM sc",
)
def risk_tier_q(spark, sf):
    return SV.with_risk_tier(_hash_scores(spark, sf))


MODEL_VERSION = "gbt-v1"
# Models trained by this application: (application, tables) -> (features, model folder, evaluation). Training is two hundred
# passes over the training rows, so the queries that use a model load the one that was saved.
_MODELS: dict = {}


def _trained(spark, sf):
    key = (spark.sparkContext.applicationId, sf)
    if key not in _MODELS:
        feats = materialize(_model_features(spark, sf, exact=False), "model-features")
        model, report = M.train_and_evaluate(feats, k=M.PRECISION_K)
        root = scratch_path(spark, "models")
        M.save_model(model, root, MODEL_VERSION)
        _MODELS[key] = feats, root, report
    feats, root, report = _MODELS[key]
    return feats, M.load_model(root, MODEL_VERSION), report


# Scores and metrics are model output, which SQL can't reproduce: no twins. tests/ recompute scores from the trees.
@register("gbt_score", "K2 K6 A16 H20")
def gbt_score_q(spark, sf):
    feats, model, _ = _trained(spark, sf)
    return M.score(model, feats, MODEL_VERSION, SCORED_AT)


@register("model_eval", "K5 L8 D13a")
def model_eval_q(spark, sf):
    feats, model, report = _trained(spark, sf)
    return SV.kpis(M.score(model, feats, MODEL_VERSION, SCORED_AT), report)


@register("model_score_evidence", "K6 A16 L1 L3 H18 H20 (mart -> model -> keyed score table -> evidence)")
def model_score_evidence_q(spark, sf):
    """Every fact of the model's wallets: the score fact comes from the score table, which the loaded model filled."""
    feats, model, _ = _trained(spark, sf)
    root = scratch_path(spark, "model-scores")
    SV.publish_scores(spark, M.score(model, feats, MODEL_VERSION), root)  # scored_at: the time of the run
    # Sizes, range bounds and positions each read the dimension, and the sizes and texts the scores: both are computed once.
    dims, scores = materialize(_dim_yearly(spark, sf), "ev-dim"), materialize(SV.score_table(spark, root).read(), "ev-scores")
    return EV.evidence_facts(feats, dims, scores)


def _analyst_views(spark, sf, prefix):
    SV.register_masked_views(spark, _fact_pit(spark, sf), _dim_yearly(spark, sf), prefix)


@register("masked_fact", "B12 L9 A20 (analyst view)", _PIT_SQL + "SELECT * EXCLUDE (wallet_id, counterparty_id) FROM pit")
def masked_fact_q(spark, sf):
    _analyst_views(spark, sf, "analyst_q_")
    return spark.table("analyst_q_fact_transaction")


@register("masked_dim", "B13 L9 A20 (analyst table: the model written to the catalog)",
          "WITH" + _sql_dim("dim", SQL_YEAR_BATCH) + "\nSELECT * EXCLUDE (wallet_id) FROM dim")
def masked_dim_q(spark, sf):
    name = f"analyst_dim_wallet_{uuid.uuid4().hex[:8]}"
    return materialize_view(SV.masked_view(_dim_yearly(spark, sf), SV.DIM_MASK), name, as_table=True)


# ---------------------------------------------------------------------------
# Evidence and reports for every wallet seen anywhere
# ---------------------------------------------------------------------------


def _evidence_inputs(spark, sf, shared: bool = False):
    """Wallet set, mart, dimension, scores and alert windows for the evidence queries.

    ``shared``: the inputs feed both the summary and the facts (the report), so
    the mart, the dimension and the alert windows are written once instead of
    being computed twice from the base tables.
    """
    ev = D.table(spark, sf, "events")
    tx = D.transactions(ev)
    keep = (lambda df, name: materialize(df, name)) if shared else (lambda df, name: df)
    feats = keep(FE.wallet_features(D.labelled_transactions(ev), exact_distinct=True), "ev-features")
    dims = keep(_dim_yearly(spark, sf), "ev-dim")
    scores = D.wallet_scores(tx.select("wallet_id").distinct())
    alerts = keep(
        velocity_features(tx, "10 minutes", exact_distinct=True).where(F.col("tx_count") >= ALERT_MIN_TX),
        "ev-alerts")
    wallets = (
        tx.select("wallet_id")
        .unionByName(D.table(spark, sf, "customer").select(F.concat(F.lit("w-"), F.col("c_custkey").cast("string"))
                                                         .alias("wallet_id")))
        .unionByName(D.table(spark, sf, "supplier").select(F.concat(F.lit("s-"), F.col("s_suppkey").cast("string"))
                                                         .alias("wallet_id")))
        .distinct()
    )
    return wallets, feats, dims, scores, alerts


def _fmt(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


SQL_EVIDENCE = (
    "WITH " + _feature_sql(SQL_TX, SQL_LABELS) + ",\n" + _sql_dim("dim", SQL_YEAR_BATCH) + ",\n  "
    + SQL_WALLET_SCORES + f""",
  alerts AS (
    SELECT time_bucket(INTERVAL '10 minutes', event_ts) AS window_start, wallet_id,
           count(tx_id) AS tx_count, sum(value) AS total_value
    FROM tx GROUP BY 1, 2 HAVING count(tx_id) >= {ALERT_MIN_TX}),
  facts AS (
    SELECT wallet_id, 1 AS section, CAST(NULL AS TIMESTAMP) AS sort_ts, 0 AS sort_i,
           'feature tx_count = ' || CAST(tx_count AS VARCHAR) AS fact FROM feats
    UNION ALL SELECT wallet_id, 1, NULL, 1, 'feature total_value = ' || {_fmt('total_value')} FROM feats
    UNION ALL SELECT wallet_id, 1, NULL, 2, 'feature avg_value = ' || {_fmt('avg_value')} FROM feats
    UNION ALL SELECT wallet_id, 1, NULL, 3, 'feature max_value = ' || {_fmt('max_value')} FROM feats
    UNION ALL SELECT wallet_id, 1, NULL, 4,
           'feature distinct_counterparties = ' || CAST(distinct_counterparties AS VARCHAR) FROM feats
    UNION ALL SELECT wallet_id, 1, NULL, 5, 'feature active_days = ' || CAST(active_days AS VARCHAR) FROM feats
    UNION ALL SELECT wallet_id, 2, valid_from, 0,
           'risk_tier ' || risk_tier || ' from ' || strftime(valid_from, '%Y-%m-%d %H:%M:%S') || ' to '
           || coalesce(strftime(valid_to, '%Y-%m-%d %H:%M:%S'), 'now') FROM dim
    UNION ALL SELECT wallet_id, 3, NULL, 0,
           'fraud_score = ' || printf('%.3f', fraud_score) || ' (model ' || model_version || ')' FROM sc
    UNION ALL SELECT wallet_id, 4, window_start, 0,
           'alert: window ' || strftime(window_start, '%Y-%m-%d %H:%M:%S') || ' tx_count=' || CAST(tx_count AS VARCHAR)
           || ' total_value=' || CAST(CAST(total_value AS DOUBLE) AS VARCHAR) FROM alerts),
  numbered AS (
    SELECT wallet_id, row_number() OVER (PARTITION BY wallet_id
             ORDER BY section, sort_ts NULLS FIRST, sort_i, fact) AS fact_no, fact
    FROM facts),
  w AS (SELECT 'w-' || user_id AS wallet_id FROM events
        UNION SELECT 'w-' || c_custkey FROM customer UNION SELECT 's-' || s_suppkey FROM supplier),
  summary AS (
    SELECT w.wallet_id,
           (f.wallet_id IS NOT NULL OR coalesce(h.n, 0) > 0) AS found,
           CAST(CASE WHEN f.wallet_id IS NOT NULL THEN 6 ELSE 0 END AS BIGINT) AS n_features,
           CAST(coalesce(h.n, 0) AS BIGINT) AS n_history,
           s.wallet_id IS NOT NULL AS has_score,
           CAST(coalesce(a.n, 0) AS BIGINT) AS n_alerts
    FROM w
    LEFT JOIN feats f ON f.wallet_id = w.wallet_id
    LEFT JOIN (SELECT wallet_id, count(*) AS n FROM dim GROUP BY 1) h ON h.wallet_id = w.wallet_id
    LEFT JOIN sc s ON s.wallet_id = w.wallet_id
    LEFT JOIN (SELECT wallet_id, count(*) AS n FROM alerts GROUP BY 1) a ON a.wallet_id = w.wallet_id),
  found AS (SELECT wallet_id, n_features + n_history + CAST(has_score AS BIGINT) + n_alerts AS n_facts
            FROM summary WHERE found)
"""
)


@register("evidence_summary", "L1 L2 C8", SQL_EVIDENCE + "SELECT * FROM summary")
def evidence_summary_q(spark, sf):
    wallets, feats, dims, scores, alerts = _evidence_inputs(spark, sf)
    return EV.wallet_evidence(wallets, feats, dims, scores, alerts)


@register("evidence_facts", "L1 L3 F4 B14 B15 H18 C8", SQL_EVIDENCE + "SELECT * FROM numbered")
def evidence_facts_q(spark, sf):
    _, feats, dims, scores, alerts = _evidence_inputs(spark, sf)
    return EV.evidence_facts(feats, dims, scores, alerts)


@register(
    "wallet_report",
    "L4 L5 L6 H19",
    SQL_EVIDENCE + f"""
SELECT wallet_id, CAST(0 AS BIGINT) AS line_no, 'Analysis for wallet ' || wallet_id || ':' AS line FROM found
UNION ALL
SELECT n.wallet_id, CAST(n.fact_no AS BIGINT), '  [' || CAST(n.fact_no AS VARCHAR) || '] ' || n.fact
FROM numbered n WHERE n.wallet_id IN (SELECT wallet_id FROM found)
UNION ALL
SELECT wallet_id, n_facts + 1, 'Question: {EV.DEFAULT_QUESTION}' FROM found
UNION ALL
SELECT wallet_id, n_facts + 2, '{EV.REPORT_CLOSING}' FROM found
UNION ALL
SELECT wallet_id, CAST(0 AS BIGINT), '{EV.REFUSAL.replace("'", "''")}' FROM summary WHERE NOT found""",
)
def wallet_report_q(spark, sf):
    wallets, feats, dims, scores, alerts = _evidence_inputs(spark, sf, shared=True)
    return EV.explain_wallets(wallets, feats, dims, scores, alerts)
