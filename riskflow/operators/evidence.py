"""Evidence and deterministic reports for any set of wallets.

Facts are rows, not per-wallet lists: (wallet_id, fact_no, fact). Sources:
  1 features  'feature <name> = <value>'   (mart column order; masked/hidden columns never read)
  2 history   'risk_tier <t> from <valid_from> to <valid_to | now>'   (by valid_from)
  3 score     'fraud_score = <0.000> (model <version>)'   (latest score per wallet)
  4 alerts    'alert: window <start> tx_count=<n> total_value=<v>'   (by window start)
A fact's number is the size of the sections before its own plus its position
there. Sizes are counts per wallet; positions come from narrow rows (wallet,
time and the few typed columns of the section) by ``ranking.group_positions``, so
a wallet with a huge history or alert list is numbered by several tasks. Text is
built last: no sort or range exchange carries it.

A wallet is *found* when the feature mart or the dimension has it (a score or
alerts alone do not count). Unknown wallets get the fixed refusal line.
Reports are rows too: (wallet_id, line_no, line).
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.text import double_text, fixed3, ts_text, value_text
from riskflow.operators.dedupe import latest_per_key
from riskflow.operators.ranking import group_positions
from riskflow.session import materialize

# Masked and hidden fields, refusal and report texts.
MASKED_FIELDS = ("counterparty_id",)
HIDDEN_FIELDS = ("wallet_id", "label", "first_seen_ts")
REFUSAL = "No evidence found for this wallet in the lakehouse. I can't speculate about it."
DEFAULT_QUESTION = "Why was this wallet flagged?"
REPORT_HEADER = "Analysis for wallet "
REPORT_CLOSING = "Assessment: based solely on the facts above."

SECTIONS = ("features", "history", "score", "alerts")


def _value(col: str, dtype: str):
    c = F.col(col)
    if dtype in ("double", "float") or dtype.startswith("decimal"):
        return double_text(c)
    if dtype.startswith("timestamp"):
        return ts_text(c)
    return value_text(c)


def feature_names(features: DataFrame, key: str = "wallet_id") -> list:
    """The mart columns that evidence shows, in their order."""
    return [c for c in features.columns if c not in set(MASKED_FIELDS) | set(HIDDEN_FIELDS) | {key}]


def feature_facts(features: DataFrame, key: str = "wallet_id") -> DataFrame:
    """(wallet_id, place, fact); ``place`` is the 1-based position within the section, as in the other sections."""
    dtypes = dict(features.dtypes)
    entries = [
        F.struct(F.lit(i).cast("long").alias("place"),
                 F.concat(F.lit(f"feature {c} = "), F.coalesce(_value(c, dtypes[c]), F.lit("None"))).alias("fact"))
        for i, c in enumerate(feature_names(features, key), 1)
    ]
    return features.select(F.col(key).alias("wallet_id"), F.explode(F.array(*entries)).alias("_e")).select("wallet_id", "_e.*")


def history_facts(dims: DataFrame, key: str = "wallet_id", attr: str = "risk_tier") -> DataFrame:
    rows = dims.select(F.col(key).alias("wallet_id"), F.coalesce(F.col(attr), F.lit("None")).alias("tier"),
                       F.col("valid_from").cast("timestamp_ntz").alias("since"), F.col("valid_to").alias("until"))
    # In the order of the texts: by start, then by what the fact says ("now" comes after any time).
    order = [F.col("since").asc_nulls_first(), "tier", F.col("until").asc_nulls_last()]
    return group_positions(rows, ["wallet_id"], order, "place").select(
        "wallet_id", "place",
        F.concat(
            F.lit(f"{attr} "), "tier",
            F.lit(" from "), ts_text(F.col("since")),
            F.lit(" to "), F.coalesce(ts_text(F.col("until")), F.lit("now")),
        ).alias("fact"),
    )


def score_facts(scores: DataFrame, key: str = "wallet_id") -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in ("scored_at", "model_version") if c in scores.columns]
    latest = latest_per_key(scores, [key], order) if order else scores
    return latest.select(
        F.col(key).alias("wallet_id"),
        F.lit(1).cast("long").alias("place"),
        F.concat(F.lit("fraud_score = "), fixed3(F.col("fraud_score")),
                 F.lit(" (model "), F.col("model_version"), F.lit(")")).alias("fact"),
    )


def alert_facts(alerts: DataFrame, key: str = "wallet_id") -> DataFrame:
    rows = alerts.select(F.col(key).alias("wallet_id"), F.col("window_start").cast("timestamp_ntz").alias("since"), "tx_count",
                         F.col("total_value").cast("double").alias("total"))
    return group_positions(rows, ["wallet_id"], [F.col("since").asc_nulls_first(), "tx_count", "total"], "place").select(
        "wallet_id", "place",
        F.concat(
            F.lit("alert: window "), ts_text(F.col("since")),
            F.lit(" tx_count="), value_text(F.col("tx_count")),
            F.lit(" total_value="), double_text(F.col("total")),
        ).alias("fact"),
    )


def section_sizes(features: DataFrame, dims: DataFrame, scores: DataFrame | None = None,
                  alerts: DataFrame | None = None, key: str = "wallet_id") -> DataFrame:
    """One row per wallet that any source knows: how many facts each section gives it."""
    n_features = len(feature_names(features, key))
    held = {"features": (features, F.lit(n_features)), "history": (dims, F.count(F.lit(1))),
            "score": (scores, F.lit(1)), "alerts": (alerts, F.count(F.lit(1)))}
    out = None
    for section in SECTIONS:
        rows, size = held[section]
        if rows is None:
            continue
        own = rows.groupBy(F.col(key).alias("wallet_id")).agg(size.cast("long").alias(section))
        out = own if out is None else out.join(own, "wallet_id", "full_outer")
    names = [c for c in SECTIONS if c in out.columns]
    return out.select("wallet_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names],
                      *[F.lit(0).cast("long").alias(c) for c in SECTIONS if c not in names])


def evidence_facts(features: DataFrame, dims: DataFrame, scores: DataFrame | None = None,
                   alerts: DataFrame | None = None, key: str = "wallet_id") -> DataFrame:
    """(wallet_id, fact_no, fact) for every wallet any source knows, in the fixed order."""
    sizes = materialize(section_sizes(features, dims, scores, alerts, key), "evidence-sizes")
    parts = {"features": feature_facts(features, key), "history": history_facts(dims, key)}
    if scores is not None:
        parts["score"] = score_facts(scores, key)
    if alerts is not None:
        parts["alerts"] = alert_facts(alerts, key)
    out = None
    for section, facts in parts.items():
        before = [F.col(c) for c in SECTIONS[:SECTIONS.index(section)]]
        if before:
            offset = sizes.where(F.col(section) > 0).select("wallet_id", reduce(add, before).alias("_before"))
            facts = facts.join(offset, "wallet_id").withColumn("place", F.col("place") + F.col("_before"))
        facts = facts.select("wallet_id", F.col("place").alias("fact_no"), "fact")
        out = facts if out is None else out.unionByName(facts)
    return out


def wallet_evidence(wallets: DataFrame, features: DataFrame, dims: DataFrame, scores: DataFrame | None = None,
                    alerts: DataFrame | None = None, key: str = "wallet_id") -> DataFrame:
    """Per requested wallet: found flag and how many facts each source gives (one row per wallet on each side)."""
    w = wallets.select(F.col(key).alias("wallet_id")).distinct()
    known = w.join(section_sizes(features, dims, scores, alerts, key), "wallet_id", "left")
    size = {c: F.coalesce(c, F.lit(0)).cast("long") for c in SECTIONS}
    return known.select(
        "wallet_id",
        ((size["features"] > 0) | (size["history"] > 0)).alias("found"),
        size["features"].alias("n_features"),
        size["history"].alias("n_history"),
        (size["score"] > 0).alias("has_score"),
        size["alerts"].alias("n_alerts"),
    )


def report_lines(summary: DataFrame, facts: DataFrame, question: str = DEFAULT_QUESTION) -> DataFrame:
    """(wallet_id, line_no, line): header, numbered facts, question, closing; refusal if not found.

    ``summary`` is ``wallet_evidence`` output; ``facts`` is ``evidence_facts``.
    The summary (one row per wallet) feeds five branches, so it is written once.
    """
    summary = materialize(summary, "evidence-summary")
    found = summary.where("found").select(
        "wallet_id",
        (F.col("n_features") + F.col("n_history") + F.col("has_score").cast("long") + F.col("n_alerts"))
        .alias("n_facts"),
    )
    header = found.select("wallet_id", F.lit(0).cast("long").alias("line_no"),
                          F.concat(F.lit(REPORT_HEADER), F.col("wallet_id"), F.lit(":")).alias("line"))
    body = facts.join(found.select("wallet_id"), "wallet_id", "left_semi").select(
        "wallet_id", F.col("fact_no").cast("long").alias("line_no"),
        F.concat(F.lit("  ["), F.col("fact_no").cast("string"), F.lit("] "), F.col("fact")).alias("line"),
    )
    q = found.select("wallet_id", (F.col("n_facts") + 1).alias("line_no"),
                     F.lit(f"Question: {question}").alias("line"))
    closing = found.select("wallet_id", (F.col("n_facts") + 2).alias("line_no"), F.lit(REPORT_CLOSING).alias("line"))
    refusal = summary.where(~F.col("found")).select("wallet_id", F.lit(0).cast("long").alias("line_no"),
                                                    F.lit(REFUSAL).alias("line"))
    return header.unionByName(body).unionByName(q).unionByName(closing).unionByName(refusal)


def report_text(lines: DataFrame, wallet_ids) -> dict:
    """Assemble report text for a few named wallets on the driver (explain API)."""
    rows = (
        lines.where(F.col("wallet_id").isin(list(wallet_ids)))
        .orderBy("wallet_id", "line_no")
        .collect()
    )
    out: dict = {}
    for r in rows:
        out.setdefault(r["wallet_id"], []).append(r["line"])
    return {w: "\n".join(v) for w, v in out.items()}


def explain_wallets(wallets: DataFrame, features: DataFrame, dims: DataFrame, scores: DataFrame | None = None,
                    alerts: DataFrame | None = None, question: str = DEFAULT_QUESTION) -> DataFrame:
    """Retrieve -> guard -> narrate for a set of wallets: report rows (wallet_id, line_no, line)."""
    summary = wallet_evidence(wallets, features, dims, scores, alerts)
    facts = evidence_facts(features, dims, scores, alerts)
    return report_lines(summary, facts, question)


def explain(wallet_ids, features: DataFrame, dims: DataFrame, scores: DataFrame | None = None,
            alerts: DataFrame | None = None, question: str = DEFAULT_QUESTION) -> dict:
    """Report text for a few named wallets (the caller's list bounds what reaches the driver).

    Every source is first cut to those wallets with a broadcast semi-join, so a
    lookup does not compute facts for the whole mart.
    """
    spark = features.sparkSession
    ids = list(dict.fromkeys(wallet_ids))
    wallets = spark.createDataFrame([(w,) for w in ids], "wallet_id string")

    def only(df):
        return None if df is None else df.join(F.broadcast(wallets), "wallet_id", "left_semi")

    lines = explain_wallets(wallets, only(features), only(dims), only(scores), only(alerts), question)
    return report_text(lines, ids)
