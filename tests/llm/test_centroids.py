"""Dimension-sharded rounds against plain ones."""

import hashlib
import math
import random

import pytest

from riskflow.llm import centroids

VECTORS = "vec_id long, embedding array<double>"


def _brute(rows, clusters, rounds, dims, scale):
    kept = [(i, [math.floor(max(-centroids.COMPONENT_BOUND, min(centroids.COMPONENT_BOUND, scale * x))) for x in v])
            for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centers = [v for _, v in hashed[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centers = [[sum(col) // len(groups[k]) for col in zip(*groups[k], strict=True)] if k in groups else c
                   for k, c in enumerate(centers)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in kept), key=str), centers


def _check(spark, rows, clusters=4, rounds=3, dims=6, scale=64, blocks=3):
    frame = spark.createDataFrame(rows, VECTORS).repartition(3)
    found, centers = centroids.cluster(frame, clusters, rounds, dims, scale, blocks=blocks)
    want, want_centers = _brute(rows, clusters, rounds, dims, scale)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert centers.tolist() == want_centers
    return found, centers


@pytest.mark.parametrize("blocks", [1, 4, 6])
def test_equals_plain_rounds(spark, blocks):
    rng = random.Random(blocks)
    rows = [(i, [rng.gauss(i % 5, 0.7) for _ in range(6)]) for i in range(300)]
    found, centers = _check(spark, rows, blocks=blocks)
    report = centroids.report(found, centers).collect()
    assert {r["inertia"] for r in report} == {sum(r["distance"] for r in report)}
    for k in range(len(centers)):
        own = [r for r in report if r["cluster"] == k]
        assert {r["cluster_inertia"] for r in own} <= {sum(r["distance"] for r in own)}
        assert {r["centroid_sha256"] for r in own} <= {hashlib.sha256(",".join(map(str, centers[k].tolist())).encode()).hexdigest()}


def test_odd_vectors(spark):
    whole = [float(i) for i in range(6)]
    rows = [(1, whole), (1, whole), (2, None), (3, []), (4, whole[:5]), (5, [*whole, 1.0]), (6, [None, *whole[1:]]),
            (7, [float("nan"), *whole[1:]]), (8, [float("inf"), *whole[1:]]), (None, [-0.01] * 6), (None, [0.5] * 6),
            (9, [1e308, -1e308, 1e6, -1e6, 1e-300, 0.0]), (10, [2.5] * 6)]
    _check(spark, rows, clusters=4)
    _check(spark, rows, clusters=40)  # fewer vectors than clusters


def test_ties_go_to_the_smaller_number_and_empty_centroids_stay(spark):
    rows = [(i, [float(i % 2)] * 6) for i in range(40)]  # many equal starting centroids
    found, _ = _check(spark, rows, clusters=8)
    assert found.select("cluster").distinct().count() == 2


def test_no_vector_and_other_columns(spark):
    found, centers = centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], VECTORS))
    assert found.count() == 0 and centroids.report(found, centers).count() == 0
    rows = [(i, [float(i)] * 6) for i in range(9)]
    clashing = spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], VECTORS + ", cluster int, distance int, chunk string")
    found, _ = centroids.cluster(clashing, 2, 3, 6)
    assert sorted(tuple(r) for r in found.collect()) == _brute(rows, 2, 3, 6, 64)[0]
