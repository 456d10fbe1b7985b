"""Centroid clustering: Lloyd's rounds over vectors that are sharded by dimension.

Vectors of integer components are cut into column blocks; a record holds one
block of columns of a chunk of vectors. Records are dealt once to tasks by
(block, chunk) and stay there. In a round
- column-block tasks compute the exact partial squared distances of their
  columns to the centroids' slices of these columns;
- reduceByKey adds the blocks of a chunk, and the argmin is taken where the
  sums end (ties: the smaller number);
- the assignments (a byte a vector) go back to the tasks of each block, which
  sum their columns per cluster; each block's slice is renewed by itself.
Only centroids (clusters * dimensions integers) pass the driver.

Components are floor(scale * x), x as double, and are held within
+-COMPONENT_BOUND, so that every distance fits a long.

Defined cases: vectors that are null, have another number of components, or a
null or non-finite one, are left out; rows that repeat an id are vectors of
their own; rows without id count as id text ''; starting centroids with equal
hash are ordered by their components; with fewer vectors than clusters there
are as many centroids as vectors; an empty centroid keeps its place; inertias
beyond a long are null; no vector at all gives an empty result; other columns
of the input are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import ready_for_python
from riskflow.session import materialize

COMPONENT_BOUND = 1 << 26
BLOCKS = 4  # column blocks

_PACKED = "chunk long, block int, n int, kind string, data binary, ids binary, missing binary"
SCHEMA = "vec_id long, cluster int, distance long"


def quantized(vectors: DataFrame, dimensions: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and components (array of long) of the vectors that count."""
    rows = vectors.select(vectors[f"`{id_col}`"].cast("long").alias("vec_id"),
                          vectors[f"`{vector_col}`"].cast("array<double>").alias("x"))
    infinite = F.lit(float("inf"))
    rows = rows.where((F.size("x") == dimensions) & F.forall(
        "x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite)))
    bound = F.lit(float(COMPONENT_BOUND))
    return rows.select("vec_id", F.transform(
        "x", lambda v: F.floor(F.greatest(F.least(v * scale, bound), -bound))).alias("components"))


def starting_centroids(rows: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """Components of the vectors with the smallest sha256 of ``<seed>:<vec_id>``, in that order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(name, 256).alias("hash"), "components").orderBy("hash", "components").limit(clusters).collect()
    return np.array([r["components"] for r in first], np.int64)


def column_blocks(rows: DataFrame, dimensions: int, blocks: int) -> DataFrame:
    """One record per chunk (an Arrow batch) and column block, packed in the smallest integers that hold it."""
    ready_for_python(rows.sparkSession)
    cuts = np.linspace(0, dimensions, blocks + 1).astype(int)
    names = [c.split()[0] for c in _PACKED.split(", ")]

    def pack(batches):
        first = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(batches):
            n = len(batch)
            if not n:
                continue
            ids = batch.column(0)
            whole = np.asarray(batch.column(1).flatten()).reshape(n, dimensions)
            out = []
            for b in range(blocks):
                part = whole[:, cuts[b]:cuts[b + 1]]
                low, high = int(part.min()), int(part.max())
                kind = next(t for t in map(np.dtype, ("<i1", "<i2", "<i4")) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
                carried = b == 0  # one block of a chunk carries the ids
                out.append((first + k, b, n, kind.str, part.astype(kind).tobytes(),
                            np.asarray(ids.fill_null(0)).astype("<i8").tobytes() if carried else b"",
                            np.packbits(np.asarray(ids.is_null())).tobytes() if carried else b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.binary(),
                                                                        pa.binary(), pa.binary()), strict=True)], names=names)

    return rows.mapInArrow(pack, _PACKED)


def _matrix(record) -> np.ndarray:
    return np.frombuffer(record[1], record[0]).reshape(record[2], -1).astype(np.int64)


def _distances(part: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Exact squared distances (vectors x centroids), in 32 bits where they fit."""
    out = np.stack([((part - c) ** 2).sum(1) for c in slices], 1)
    return out.astype(np.uint32) if out.max(initial=0) < 1 << 28 else out


def _add(a: tuple, b: tuple) -> tuple:
    x, y = a[0], b[0]
    if x.dtype != y.dtype:
        x, y = x.astype(np.int64), y.astype(np.int64)
    total = x + y
    if total.dtype == np.uint32 and total.max(initial=0) >= 1 << 31:
        total = x.astype(np.int64) + y.astype(np.int64)
    return total, a[1] or b[1]


class ShardedVectors:
    """Column-block records, dealt to tasks by (block, chunk) once; later rounds reuse that shuffle."""

    def __init__(self, rows: DataFrame, dimensions: int, blocks: int):
        self.blocks = blocks
        self.cuts = np.linspace(0, dimensions, blocks + 1).astype(int)
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.parts, self.per_block = parts, max(1, -(-parts // blocks))
        per_block = self.per_block

        def place(key):
            block, chunk = key
            # Chunk numbers hold the task above 32 bits and the batch below: mix both.
            return block * per_block + (chunk * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % per_block

        self._place = place
        packed = column_blocks(rows, dimensions, blocks).rdd
        self.records: RDD = packed.map(lambda r: ((r["block"], r["chunk"]), (r["kind"], bytes(r["data"]), r["n"], bytes(r["ids"]), bytes(r["missing"])))
                                       ).partitionBy(blocks * per_block, place)

    def _slices(self, centroids: np.ndarray) -> list[np.ndarray]:
        return [centroids[:, a:b] for a, b in zip(self.cuts[:-1], self.cuts[1:], strict=True)]

    def nearest(self, centroids: np.ndarray, with_ids: bool = False) -> RDD:
        """(chunk, (cluster of each vector, distance of each vector, ids or None))."""
        slices = self._slices(centroids)

        def partial(item):
            (block, chunk), record = item
            ids = (record[3], record[4]) if with_ids and block == 0 else None
            return chunk, (_distances(_matrix(record), slices[block]), ids)

        def take(value):
            total, ids = value
            cluster = total.argmin(1)
            return cluster.astype(np.uint16), total[np.arange(len(total)), cluster].astype(np.int64), ids

        return self.records.map(partial).reduceByKey(_add, self.parts).mapValues(take)

    def updated(self, centroids: np.ndarray) -> np.ndarray:
        """Centroids after one round: each block's slice is renewed from its own columns."""
        slices, blocks, clusters = self._slices(centroids), self.blocks, len(centroids)
        back = (self.nearest(centroids)
                .flatMap(lambda item: [((b, item[0]), item[1][0]) for b in range(blocks)])
                .partitionBy(self.records.getNumPartitions(), self._place))
        both = back.union(self.records)  # equal partitioners: the same tasks, assignments first, nothing is shuffled
        if both.getNumPartitions() != self.records.getNumPartitions():
            raise RuntimeError("assignments and column blocks are not dealt alike")

        def sums(items):
            assigned, totals = {}, {}
            for key, value in items:
                if isinstance(value, np.ndarray):
                    assigned[key] = value
                    continue
                block, part, cluster = key[0], _matrix(value), assigned.pop(key)
                if block not in totals:
                    totals[block] = np.zeros((clusters, part.shape[1] + 1), np.int64)
                of = cluster[None, :] == np.arange(clusters)[:, None]
                totals[block][:, :-1] += of.astype(np.int64) @ part
                totals[block][:, -1] += of.sum(1)
            yield from totals.items()

        def renewed(item):
            block, total = item
            count = total[:, -1:]
            return block, np.where(count > 0, total[:, :-1] // np.maximum(count, 1), slices[block])

        found = dict(both.mapPartitions(sums).reduceByKey(np.add, blocks).map(renewed).collect())
        return np.concatenate([found[b] for b in range(blocks)], 1)


def cluster(vectors: DataFrame, clusters: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64,
            seed: str = "1", blocks: int = BLOCKS, id_col: str = "vec_id", vector_col: str = "embedding"
            ) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that counts, and the final centroids."""
    if not 1 <= clusters <= 1 << 16 or not 1 <= blocks <= dimensions:
        raise ValueError("clusters or blocks out of range")
    spark = vectors.sparkSession
    rows = quantized(vectors, dimensions, scale, id_col, vector_col)
    centroids = starting_centroids(rows, clusters, seed)
    if not len(centroids):
        return spark.createDataFrame([], SCHEMA), centroids
    sharded = ShardedVectors(rows, dimensions, blocks)
    for _ in range(rounds):
        centroids = sharded.updated(centroids)
    final = sharded.nearest(centroids, with_ids=True).map(
        lambda item: (bytearray(item[1][2][0]), bytearray(item[1][2][1]), bytearray(item[1][0].tobytes()), bytearray(item[1][1].tobytes())))
    packed = spark.createDataFrame(final, "ids binary, missing binary, cluster binary, distance binary", verifySchema=False)

    def unpack(batches):
        for batch in batches:
            for ids, missing, number, distance in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(ids, "<i8")
                null = np.unpackbits(np.frombuffer(missing, np.uint8), count=len(ids)).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, mask=null), pa.array(np.frombuffer(number, np.uint16).astype(np.int32)),
                     pa.array(np.frombuffer(distance, np.int64))], names=["vec_id", "cluster", "distance"])

    return materialize(packed.mapInArrow(unpack, SCHEMA), "clusters"), centroids


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with the inertias of its cluster and of all, and the digest of its centroid."""
    spark = assigned.sparkSession
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids.tolist())]
    parts = {r["cluster"]: int(r["part"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("part")).collect()}  # one row a cluster

    def as_long(value: int) -> int | None:
        return value if value < 1 << 63 else None

    whole = as_long(sum(parts.values()))
    sums = spark.createDataFrame([(k, as_long(parts.get(k, 0)), whole, digest) for k, digest in digests],
                                 "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
