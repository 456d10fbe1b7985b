"""Model layer on Spark: time split, gradient-boosted trees, ranking metrics, scoring.

* ``time_split``: sort by (first_seen_ts, key); the first floor(n * (1 - f))
  rows train, the rest test, so max(train ts) <= min(test ts). Positions come
  from ``ranking.global_positions`` (no single-task sort).
* ``average_precision``: step-wise AP, as the usual precision-recall
  definition: group rows by score, walk distinct scores high to low,
  AP = sum over scores of (new positives / all positives) * precision there.
  Prefix sums are distributed (``ranking.running_sums``).
* ``precision_at_k``: mean label of the k best-scored rows (ties: key asc),
  k clipped to the row count; ``orderBy().limit(k)`` runs as a bounded top-k.
* ``fit_gbt`` / ``score``: MLlib ``GBTClassifier`` on the six features;
  the score is P(class 1).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.errors import ModelError
from riskflow.operators.features import FEATURE_COLUMNS
from riskflow.operators.ranking import global_positions, running_sums
from riskflow.session import materialize

# Defaults of the evaluation.
TEST_FRACTION = 0.3
PRECISION_K = 50
GBT_SEED = 42
GBT_ITERATIONS = 200


@dataclass
class EvalReport:
    pr_auc: float | None
    precision_at_k: float | None
    k: int
    n_train: int
    n_test: int
    split_ts: str


def time_split(df: DataFrame, ts_col: str = "first_seen_ts", key: str = "wallet_id",
               test_fraction: float = TEST_FRACTION, partitions: int | None = None):
    """Return (train, test, info). Raises ModelError when one side would be empty."""
    ranked, n = global_positions(df, [F.col(ts_col), F.col(key)], "split_position", partitions, with_total=True)
    cut = int(n * (1 - test_fraction))
    if cut == 0 or cut == n:
        raise ModelError(f"time_split degenerate: n={n}, test_fraction={test_fraction}")
    train = ranked.where(F.col("split_position") < cut)
    test = ranked.where(F.col("split_position") >= cut)
    return train, test, {"n": n, "cut": cut}


def split_frame(df: DataFrame, ts_col: str = "first_seen_ts", key: str = "wallet_id",
                test_fraction: float = TEST_FRACTION) -> DataFrame:
    """All rows with ``split_position`` and ``split`` ('train'/'test')."""
    train, test, info = time_split(df, ts_col, key, test_fraction)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


def average_precision(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: n, n_pos, average_precision (NULL when there is no positive)."""
    per_score = scored.groupBy(score).agg(
        F.sum(F.col(label).cast("long")).alias("tp"), F.count(F.lit(1)).alias("n")
    )
    cum = running_sums(per_score, [F.col(score).desc()], ["tp", "n"])
    return cum.agg(
        F.sum("n").alias("n"),
        F.sum("tp").alias("n_pos"),
        (F.sum(F.col("tp") * (F.col("cum_tp") / F.col("cum_n"))) / F.sum("tp")).alias("average_precision"),
    )


def precision_at_k(scored: DataFrame, k: int = PRECISION_K, label: str = "label", score: str = "score",
                   key: str = "wallet_id") -> DataFrame:
    """One row: k (clipped to the row count) and precision_at_k."""
    top = scored.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)
    return top.agg(F.count(F.lit(1)).alias("k"), F.avg(F.col(label).cast("double")).alias("precision_at_k"))


def top_k(df: DataFrame, k: int, score: str, key: str) -> DataFrame:
    """The k highest scores (ties: key ascending)."""
    return df.orderBy(F.col(score).desc(), F.col(key).asc()).limit(k)


def require_two_classes(df: DataFrame, label: str = "label") -> None:
    if df.select(label).where(F.col(label).isNotNull()).distinct().limit(2).count() < 2:
        raise ModelError("need both classes present to train")


def fit_gbt(train: DataFrame, features=FEATURE_COLUMNS, label: str = "label", max_iter: int = GBT_ITERATIONS,
            seed: int = GBT_SEED, max_depth: int = 5):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    gbt = (
        GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=max_iter, seed=seed,
                      maxDepth=max_depth, predictionCol="_pred")
        .setProbabilityCol("_prob")
        .setRawPredictionCol("_raw")
    )
    data = train.withColumn("_label", F.col(label).cast("double"))
    return Pipeline(stages=[assembler, gbt]).fit(data)


def _model_path(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/model_version={version}"


def save_model(model, root: str, version: str) -> None:
    """Store a fitted model under its version; a version is written once."""
    model.save(_model_path(root, version))


def load_model(root: str, version: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(_model_path(root, version))


def score(model, df: DataFrame, model_version: str, scored_at: _dt.datetime | None = None,
          key: str = "wallet_id", keep=()) -> DataFrame:
    """(key, fraud_score, model_version, scored_at[, keep...])."""
    from pyspark.ml.functions import vector_to_array

    if scored_at is None:
        stamp = F.current_timestamp().cast("timestamp_ntz")
    else:
        stamp = F.lit(scored_at).cast("timestamp_ntz")
    out = model.transform(df)
    return out.select(
        key,
        vector_to_array(F.col("_prob"))[1].alias("fraud_score"),
        F.lit(model_version).alias("model_version"),
        stamp.alias("scored_at"),
        *keep,
    )


def train_and_evaluate(features: DataFrame, k: int = PRECISION_K, test_fraction: float = TEST_FRACTION,
                       max_iter: int = GBT_ITERATIONS, seed: int = GBT_SEED, key: str = "wallet_id"):
    """Drop unknown labels -> two-class check -> time split -> GBT -> (model, EvalReport)."""
    labelled = features.na.drop(subset=["label"])
    require_two_classes(labelled)
    train, test, info = time_split(labelled, key=key, test_fraction=test_fraction)
    # Boosting passes over the training rows many times: read them from a written table.
    train = materialize(train, "train-split")
    model = fit_gbt(train, max_iter=max_iter, seed=seed)
    scored = score(model, test, "eval", _dt.datetime(1970, 1, 1), key=key, keep=("label",))
    scored = materialize(scored, "eval-scores")
    ap = average_precision(scored, score="fraud_score").first()
    pk = precision_at_k(scored, k, score="fraud_score", key=key).first()
    split_ts = train.agg(F.max("first_seen_ts")).first()[0]
    report = EvalReport(
        pr_auc=None if ap["average_precision"] is None else float(ap["average_precision"]),
        precision_at_k=None if pk["precision_at_k"] is None else float(pk["precision_at_k"]),
        k=int(pk["k"]),
        n_train=info["cut"],
        n_test=info["n"] - info["cut"],
        split_ts=str(split_ts),
    )
    return model, report
