"""Quality classifier: Bradley-Terry pairwise ranking.

Every document has a raw score w . x over features of its whole text. The
weights are learned from preference pairs (a document labelled 1 is preferred
to one labelled 0) by logistic loss on the feature differences. The raw score
at the quantile that the share of label 0 marks among the training scores
becomes 0.5; the logistic function maps raw scores to 0..1.

The model is fitted on a bounded sample: at most ``max_labelled`` labelled
documents in a fixed hash order of their ids, each met in at most
``pairs_per_document`` pairs.

Defined cases: a null text counts as empty and is scored like any other; a
document labelled more than once counts by its mean label (0.5 is no label);
without both labels every score is 0.5; repeated rows are scored alike; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import DIGIT, LOWER, OTHER, SPACE, UPPER, char_class_table, code_points, hash_order, ready_for_python

MAX_LABELLED = 20_000
PAIRS_PER_DOCUMENT = 20
RIDGE = 1e-3


def raw_features(text: str) -> list[float]:
    """Shape of a text: character classes, word and line repetition, compressibility."""
    u = code_points(text)
    kinds = np.bincount(char_class_table()[u], minlength=5) if len(u) else np.zeros(5)
    n = max(1, len(u))
    letters = max(1, kinds[LOWER] + kinds[UPPER])
    words = text.split()
    w = max(1, len(words))
    seen = Counter(words)
    lines = [v for v in text.split("\n") if v]
    data = text.encode("utf-8", "surrogatepass")
    grams = {(words[i], words[i + 1], words[i + 2]) for i in range(len(words) - 2)}
    return [
        np.log1p(len(words)),
        len(u) / w / 10,
        letters / n,
        kinds[DIGIT] / n,
        kinds[UPPER] / letters,
        kinds[OTHER] / n,
        kinds[SPACE] / n,
        len(seen) / w,
        np.log1p(len(seen)) / np.log1p(w),
        max(seen.values(), default=0) / w,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / w,
        len(set(lines)) / max(1, len(lines)),
        len(grams) / max(1, len(words) - 2),
        sum(not v[-1].isalnum() for v in words) / w,
        np.log1p(len(u) / max(1, len(lines))) / 5,
        len(zlib.compress(data, 1)) / max(1, len(data)) if data else 0.0,
    ]


def features(text: str) -> np.ndarray:
    x = np.array(raw_features(text), np.float64)
    return np.concatenate([x, x * x, np.sqrt(np.abs(x))])


def fit(x: np.ndarray, label: np.ndarray, pairs_per_document: int = PAIRS_PER_DOCUMENT) -> dict | None:
    """Bradley-Terry weights by Newton steps on the pair differences; None without both labels."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return None
    center, scale = x.mean(0), x.std(0) + 1e-9
    z = (x - center) / scale
    draw = np.random.default_rng(11)
    n = min(len(good), len(bad)) * pairs_per_document
    diff = z[draw.permutation(np.resize(good, n))] - z[draw.permutation(np.resize(bad, n))]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1.0 / (1.0 + np.exp(-np.clip(diff @ w, -35, 35)))
        grad = diff.T @ (1.0 - p) / n - RIDGE * w
        hess = (diff * (p * (1.0 - p))[:, None]).T @ diff / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    raw = z @ w
    # Each document counts with the share of its label, so the quantile marks the labels' own split.
    return {"center": center, "scale": scale, "w": w, "cut": float(np.quantile(raw, len(bad) / len(label)))}


def score(model: dict | None, texts: list[str | None]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    x = np.stack([features(t or "") for t in texts])
    raw = ((x - model["center"]) / model["scale"]) @ model["w"] - model["cut"]
    return 1.0 / (1.0 + np.exp(-np.clip(raw, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict | None:
    """Fit on labelled documents; ``labels`` (doc_id, quality) holds the rows that may be learned from."""
    spark = docs.sparkSession
    ready_for_python(spark)
    known = (labels.where("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("mean"))
             .where("mean <> 0.5").orderBy(hash_order(F.col("doc_id")), "doc_id").limit(max_labelled))
    known = [(r["doc_id"], int(r["mean"] > 0.5)) for r in known.collect()]
    chosen = spark.createDataFrame(known, "chosen long, label int")
    sample = (docs.selectExpr("cast(doc_id as long) doc_id", "text")
              .join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("doc_id", "label", "text"))

    def run(batches):
        for batch in batches:
            vectors = [features(t or "").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())],
                                             names=["doc_id", "label", "x"])

    got = sorted((r["doc_id"], r["label"], bytes(r["x"]))
                 for r in sample.mapInArrow(run, "doc_id long, label int, x binary").collect())
    if not got:
        return None
    return fit(np.stack([np.frombuffer(v, np.float64) for _, _, v in got]), np.array([y for _, y, _ in got]))


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """doc_id and score of every whole text."""
    ready_for_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score(shared.value, batch.column(1).to_pylist()), pa.float64())],
                names=["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, score double")
