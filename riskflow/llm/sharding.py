"""Sharding: longest-processing-time scheduling of groups that must stay together.

Documents of equal text form a group and go to one shard. Groups are placed in
descending order of size, each on the shard with the least load so far, which
a heap keeps at hand.

The heap sees a bounded list whatever the size of the table:
- a group of at least 1 / (shards * HEAVY) of all bytes is an entry of its own
  (at most shards * HEAVY such groups exist);
- lighter groups are dealt by their hash into bundles, and a bundle is one
  entry. Half of the light groups lie in bundles of the first level, a quarter
  in those of the second, and so on: entries run from coarse to as fine as
  single groups, so the last ones level the loads.
Where every group is an entry of its own (small tables) this is plain
longest-processing-time scheduling over the groups.

Texts are read by narrow scans and never shuffled; what is shuffled is one
pre-aggregated row per group. A hot group costs one row per input partition,
and rows find their shard by a broadcast of the bounded entries. Slots are
numbered within each task and shifted by the counts of the tasks before it.

Defined cases: a null text has no bytes and counts with the empty texts as one
group (checksum 0); equal rows are rows of their own, with slots of their own;
rows without id are placed like others; of groups of equal size the one with
the smaller key goes first, of shards of equal load the smaller number; an
empty table gives an empty result; other columns of the input are not read,
whatever their names (``write_shards`` keeps them).
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from riskflow.llm.common import ready_for_python
from riskflow.session import materialize

HEAVY = 1000  # a group is an entry of its own from 1 / HEAVY of a shard's even share
PER_LEVEL = 64  # bundles a level, per shard
LEVELS = 20
ROW_BYTES = 8  # counted for each row besides its text


def schedule(entries: list[tuple], shards: int) -> dict:
    """Longest-processing-time: {key: shard} of (key, size) entries, largest first, each to the least load."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for key, size in sorted(entries, key=lambda e: (-e[1], e[0])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[key] = shard
    return placed


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`"), F.lit(""))


def _size(text: Column) -> Column:
    return F.octet_length(text).cast("long") + F.lit(ROW_BYTES)


def _group_key(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _bundle(key: Column, shards: int) -> Column:
    """Bundle number of a light group: the level from 30 bits of its hash, the place in it from the others."""
    bits = F.shiftrightunsigned(F.xxhash64(key), 1)
    level = F.least(F.lit(30) - F.length(F.bin(bits.bitwiseAND(F.lit((1 << 30) - 1)))), F.lit(LEVELS - 1))
    per_level = PER_LEVEL * shards
    return (level * F.lit(per_level) + F.shiftright(bits, 30) % F.lit(per_level)).cast("int")


def place_groups(docs: DataFrame, shards: int, text_col: str = "text", heavy: int = HEAVY) -> tuple[DataFrame, DataFrame]:
    """Where each group goes: (group_key, shard) of the heavy groups and (bundle, shard) of the others.

    At most ``shards * heavy`` and ``shards * PER_LEVEL * LEVELS`` rows; these pass the driver.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = docs.sparkSession
    text = _text(text_col)
    groups = materialize(docs.select(_group_key(text).alias("group_key"), _size(text).alias("size"))
                         .groupBy("group_key").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    is_heavy = F.col("bytes") * F.lit(shards * heavy) >= F.lit(total).cast("decimal(38,0)")
    large = [(bytes(r[0]), r[1]) for r in groups.where(is_heavy).collect()]
    light = (groups.where(~is_heavy).groupBy(_bundle(F.col("group_key"), shards).alias("bundle"))
             .agg(F.sum("bytes").alias("bytes")).collect())
    # Keys of one kind for the order of ties: heavy groups first, then bundles by number.
    placed = schedule([((0, key), size) for key, size in large]
                      + [((1, r["bundle"].to_bytes(4)), r["bytes"]) for r in light], shards)
    keys = T.StructType([T.StructField("group_key", T.BinaryType()), T.StructField("heavy_shard", T.IntegerType())])
    return (spark.createDataFrame([(bytearray(k), s) for (kind, k), s in placed.items() if kind == 0], keys),
            spark.createDataFrame([(int.from_bytes(k), s) for (kind, k), s in placed.items() if kind == 1],
                                  "bundle int, light_shard int"))


def with_shard(docs: DataFrame, shards: int, text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(row, size, text_crc32, shard): ``row`` is a struct of all columns of ``docs``. No row is shuffled."""
    heavies, bundles = place_groups(docs, shards, text_col, heavy)
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.select("row", _size(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                       _group_key(text).alias("group_key"))
    rows = rows.withColumn("bundle", _bundle(F.col("group_key"), shards))
    # Both tables are bounded by the parameters (see place_groups).
    return (rows.join(F.broadcast(heavies), "group_key", "left").join(F.broadcast(bundles), "bundle", "left")
            .select("row", "size", "text_crc32", F.coalesce("heavy_shard", "light_shard").alias("shard")))


def numbered(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (with a column shard) with ``slot``: 0, 1, ... within each shard, without gaps.

    Each task counts its rows per shard; the rows are written once with that
    count, and the sum over earlier tasks is added. No rows are shuffled.
    """
    ready_for_python(rows.sparkSession)
    names = rows.columns
    place = names.index("shard")

    def count(batches):
        task = TaskContext.get().partitionId()
        seen = [0] * shards
        for batch in batches:
            local = []
            for shard in batch.column(place).to_pylist():
                local.append(seen[shard])
                seen[shard] += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(local), pa.int32()), pa.array(local, pa.int64())],
                names=[*names, "task", "local"])

    schema = T.StructType([*rows.schema.fields, T.StructField("task", T.IntegerType()), T.StructField("local", T.LongType())])
    counted = materialize(rows.mapInArrow(count, schema), "shard-rows")
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counted.groupBy("shard", "task").agg(F.count("*").alias("n"))
               .select("shard", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    return (counted.join(offsets, ["shard", "task"])
            .select(*names, (F.col("local") + F.col("offset")).alias("slot")))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    docs = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    rows = with_shard(docs, shards, heavy=heavy).select(F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", "shard")
    return numbered(rows, shards)


def write_shards(docs: DataFrame, shards: int, path: str, text_col: str = "text") -> DataFrame:
    """Write the rows with all their columns to ``path``, one folder per shard; the table as read back.

    Rows go to their folder from where they are read: as many files a shard as the table has splits.
    """
    rows = with_shard(docs, shards, text_col)
    keep = [c for c in docs.columns if c.lower() != "shard"]
    rows.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "shard").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
