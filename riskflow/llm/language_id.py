"""Language identification by hierarchical discrimination.

A linear SVM per family pair decides the language family first; one-versus-one
linear SVMs then separate the languages of that family. Features are hashed
counts of character 1- to 3-grams of the whole text (square roots, unit
length), so the case of letters, digits and punctuation do not matter.

The models are fitted on a bounded sample of labelled rows: at most about
``per_language`` documents a language in a fixed hash order of their ids.

Defined cases: a null text and a text without letters are ``und`` with score
0; without any labelled row every text is ``und``; with one learned language
every text with letters is that language, score 1; a language outside the
family table is a family of its own; repeated rows are predicted alike; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import LOWER, UPPER, char_class_table, code_points, hash_order, ready_for_python

# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "pl", "cs", "sk", "uk", "bg", "sr", "hr", "sl", "be"],
    "uralic": ["fi", "hu", "et"],
}
UNDETERMINED = "und"
DIM = 2048
PER_LANGUAGE = 1000
MARGIN_SCALE = 4.0


def family_of(lang: str) -> str:
    return next((name for name, members in FAMILIES.items() if lang in members), f"own:{lang}")


def features(text: str) -> np.ndarray | None:
    """Unit vector of hashed character n-grams, or None for a text without letters."""
    u = code_points(text.lower())
    letters = char_class_table()[u] >= LOWER if len(u) else np.zeros(0, bool)
    if not letters.any():
        return None
    u = np.where(letters, u, 32).astype(np.uint32)
    keep = np.ones(len(u), bool)
    keep[1:] = (u[1:] != 32) | (u[:-1] != 32)
    u = np.concatenate([[32], u[keep], [32]]).astype(np.uint32)
    counts = np.zeros(DIM)
    for n in (1, 2, 3):
        m = len(u) - n + 1
        h = np.full(max(m, 0), n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
        for k in range(n):
            h = (h ^ u[k:k + m]) * np.uint32(0x01000193) + np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(15)
        counts += np.bincount((h * np.uint32(0x2C1B3C6D)) >> np.uint32(21), minlength=DIM)
    root = np.sqrt(counts)
    return (root / np.linalg.norm(root)).astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Squared-hinge linear SVM (last weight: bias) by accelerated gradient; both classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w = z = np.zeros(x.shape[1], np.float64)
    rate = 1.0 / (2 * 2.0 + penalty)  # rows have squared norm 2, weights sum to 1
    for t in range(steps):
        slack = np.maximum(0.0, 1.0 - y * (x @ z.astype(x.dtype)))
        grad = penalty * z - 2.0 * (x.T @ (weight * y * slack).astype(x.dtype))
        nxt = z - rate * grad
        z = nxt + (t / (t + 3.0)) * (nxt - w)
        w = nxt
    return w


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """Family SVMs and, per family, one SVM for each pair of its languages."""
    names = np.array(langs)
    fams = np.array([family_of(v) for v in langs])

    def pairs(kinds, values):
        model = {}
        for a, b in combinations(sorted(set(kinds)), 2):
            rows = (values == a) | (values == b)
            model[(a, b)] = linear_svm(x[rows], np.where(values[rows] == a, 1.0, -1.0))
        return model

    families = sorted(set(fams.tolist()))
    members = {f: sorted(set(names[fams == f].tolist())) for f in families}
    return {"families": families, "members": members, "between": pairs(families, fams),
            "within": {f: pairs(members[f], names) for f in families}}


def _vote(x: np.ndarray, kinds: list[str], svms: dict) -> tuple[np.ndarray, np.ndarray]:
    """Winner of the one-versus-one votes (ties by summed confidence) and its worst pairwise confidence."""
    votes = np.zeros((len(x), len(kinds)))
    worst = np.ones((len(x), len(kinds)))
    for (a, b), w in svms.items():
        p = 1.0 / (1.0 + np.exp(-MARGIN_SCALE * (x @ w[:-1] + w[-1])))
        i, j = kinds.index(a), kinds.index(b)
        votes[:, i] += (p >= 0.5) + 1e-3 * p
        votes[:, j] += (p < 0.5) + 1e-3 * (1 - p)
        worst[:, i] = np.minimum(worst[:, i], p)
        worst[:, j] = np.minimum(worst[:, j], 1 - p)
    best = votes.argmax(1)
    return best, worst[np.arange(len(x)), best]


def predict(model: dict, texts: list[str | None]) -> tuple[list[str], list[float]]:
    rows = [features(t) if t else None for t in texts]
    at = [i for i, r in enumerate(rows) if r is not None]
    langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    if not at or not model["families"]:
        return langs, scores
    x = np.stack([rows[i] for i in at])
    fam, sure = _vote(x, model["families"], model["between"])
    for k, family in enumerate(model["families"]):
        own = np.flatnonzero(fam == k)
        if len(own):
            best, score = _vote(x[own], model["members"][family], model["within"][family])
            for i, b, s in zip(own, best, score * sure[own], strict=True):
                langs[at[i]], scores[at[i]] = model["members"][family][b], float(s)
    return langs, scores


def train(docs: DataFrame, eligible, per_language: int = PER_LANGUAGE, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> dict:
    """Fit on a bounded sample of the ``eligible`` (a Column) rows with a language and letters in the text."""
    spark = docs.sparkSession
    ready_for_python(spark)
    rows = docs.where(eligible & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                      & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit(np.zeros((0, DIM), np.float32), [])
    # A hash value below the share of its language: the expected number is per_language.
    share = F.create_map(*[v for k, n in counts.items()
                           for v in (F.lit(k), F.lit(min(1.0, per_language / n)))])
    place = F.pmod(hash_order(F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    ids = (rows.where(place < share[F.col("lang")]).select("doc_id").distinct()
           .orderBy(hash_order(F.col("doc_id"))).limit(2 * per_language * len(counts)))
    ids = [r["doc_id"] for r in ids.collect()]
    chosen = spark.createDataFrame([(i,) for i in ids], "chosen long")
    sample = (docs.where(eligible & F.col(lang_col).isNotNull())
              .select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).alias("lang"),
                      F.col(text_col).alias("text"))
              .join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen"), "left_semi"))

    def run(batches):
        for batch in batches:
            ids, langs, texts = (c.to_pylist() for c in batch.columns)
            vectors = [features(t) if t else None for t in texts]
            at = [i for i, v in enumerate(vectors) if v is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in at], pa.int64()), pa.array([langs[i] for i in at], pa.string()),
                 pa.array([vectors[i].tobytes() for i in at], pa.binary())], names=["doc_id", "lang", "vector"])

    got = sorted((r["doc_id"], r["lang"], bytes(r["vector"]))
                 for r in sample.mapInArrow(run, "doc_id long, lang string, vector binary").collect())
    x = np.stack([np.frombuffer(v, np.float32) for _, _, v in got]) if got else np.zeros((0, DIM), np.float32)
    return fit(x, [lang for _, lang, _ in got])


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every whole text."""
    ready_for_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            langs, scores = predict(shared.value, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return (docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def keep_identified(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is determined, with all their columns."""
    ready_for_python(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            langs, _ = predict(shared.value, batch.column(at).to_pylist())
            yield batch.filter(pa.array([v != UNDETERMINED for v in langs], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
