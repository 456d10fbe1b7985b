"""Document fingerprints: quartile bucket digest.

A 5-byte window slides over the UTF-8 bytes; its hashed byte triplets are
counted in 128 buckets. Each bucket becomes two bits (which quartile of the
bucket counts it lies above), and the length is kept on a logarithmic scale.
Two digests are compared by a bounded difference score; likeness is
1 - difference / bound.

Defined cases: a null text counts as empty; texts of under five bytes have all
buckets 0 and differ by length only; equal texts have equal digests (likeness
1); the successor of a document is the next row in the order (doc_id, text),
rows without id first, and the first row follows the last; repeated rows
succeed each other; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import ready_for_python

BUCKETS = 128
WINDOW = 5
# Fixed choices of the digest: the triplets of a window (its first byte and two
# others), each with a salt of its own.
_TRIPLETS = [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]
_LENGTH_STEP = math.log(1.25)
# Difference of two bucket codes; opposite quartiles weigh double.
_CODE_DIFF = np.array([0, 1, 2, 6], np.int64)
LENGTH_BOUND = 48
DIFF_BOUND = 300  # scores at or beyond it mean "nothing in common"

SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _counts(data: bytes) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    step = 1 << 20  # bounded memory for very long texts
    for start in range(0, max(0, len(data) - WINDOW + 1), step):
        b = np.frombuffer(data, np.uint8, min(step + WINDOW - 1, len(data) - start), start).astype(np.uint32)
        n = len(b) - WINDOW + 1
        first = b[:n] * np.uint32(0x9E3779B1)
        for salt, (i, j) in enumerate(_TRIPLETS):
            h = first ^ (b[i:i + n] * np.uint32(0x85EBCA6B)) ^ (b[j:j + n] * np.uint32(0xC2B2AE35))
            h = (h + np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)) * np.uint32(0x2C1B3C6D)
            total += np.bincount(h >> np.uint32(25), minlength=BUCKETS)
    return total


def digest(data: bytes) -> bytes:
    """One length byte, then two bits per bucket (33 bytes)."""
    counts = _counts(data)
    ordered = np.sort(counts)
    quartiles = ordered[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, None] > quartiles[None, :]).sum(1).astype(np.uint8)
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = min(255, int(math.log(len(data) + 1) / _LENGTH_STEP))
    return bytes([length]) + packed.tobytes()


def difference(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(d, np.uint8)[1:] for d in (a, b))
    total = min(LENGTH_BOUND, 2 * abs(a[0] - b[0]))
    for shift in (0, 2, 4, 6):
        total += int(_CODE_DIFF[np.abs((x >> shift & 3).astype(np.int64) - (y >> shift & 3))].sum())
    return min(total, DIFF_BOUND)


def likeness(a: bytes, b: bytes) -> float:
    return 1.0 - difference(a, b) / DIFF_BOUND


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _dealt_in_order(docs: DataFrame, buckets: int) -> DataFrame:
    """doc_id, text, bucket, sentinel: id ranges dealt over the partitions, each sorted.

    Every range is followed by a copy (sentinel) of the first rows of the next
    range that is not empty, so each row meets its successor in its own range.
    Only the range bounds and the first id of each range pass the driver: at
    most ``buckets`` numbers.
    """
    cuts = [k / buckets for k in range(1, buckets)]
    bounds = docs.select(F.percentile_approx("doc_id", cuts, 20000).alias("b")).first()["b"] or []
    splits = [-math.inf, *sorted({float(b) for b in bounds}), math.inf]
    docs = docs.withColumn("place", F.col("doc_id").cast("double"))
    if len(splits) > 2:
        docs = Bucketizer(splits=splits, inputCol="place", outputCol="range", handleInvalid="keep").transform(docs)
    else:
        docs = docs.withColumn("range", F.lit(0))
    docs = docs.select("doc_id", "text", F.when(F.col("doc_id").isNull(), 0)
                       .otherwise(F.col("range").cast("int")).alias("bucket"))
    firsts = (docs.groupBy("bucket")
              .agg(F.min("doc_id").alias("first_id"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect())
    firsts = sorted((r["bucket"], None if r["nulls"] else r["first_id"]) for r in firsts)
    previous = {firsts[i][1]: firsts[i - 1][0] for i in range(len(firsts))}  # the first range follows the last
    heads = docs.sparkSession.createDataFrame(list(previous.items()) or [(None, 0)], "head long, before int")
    ranged = docs.withColumn("sentinel", F.lit(False))
    copies = (docs.join(F.broadcast(heads), docs["doc_id"].eqNullSafe(heads["head"]))
              .select("doc_id", "text", F.col("before").alias("bucket"), F.lit(True).alias("sentinel")))
    return ranged.unionByName(copies)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 ranges_per_task: int = 4) -> DataFrame:
    """Digest of each text and of its edited text, with both likenesses (see SCHEMA).

    One shuffle of the texts: id ranges are dealt to tasks and read in order,
    one row held at a time besides the current batch.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    docs = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"coalesce(`{text_col}`, '') text")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (_dealt_in_order(docs, tasks * ranges_per_task).repartition(tasks, "bucket")
             .sortWithinPartitions("bucket", "sentinel", F.col("doc_id").asc_nulls_first(), "text"))

    def run(batches):
        held = None  # (bucket, doc_id, text, digest) of the row that waits for its successor
        for batch in batches:
            out = []
            for doc_id, text, bucket, sentinel in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                same = held is not None and held[0] == bucket
                own = None if sentinel and not same else digest(text.encode())
                if same:
                    edited = edited_text(held[2], text).encode()
                    other = digest(edited)
                    out.append((held[1], len(held[2]), hashlib.sha256(edited).hexdigest(), held[3].hex(),
                                other.hex(), likeness(held[3], other), likeness(held[3], own)))
                held = None if sentinel else (bucket, doc_id, text, own)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, f.type) for v, f in zip(zip(*out, strict=True), _ARROW, strict=True)], schema=_ARROW)

    return dealt.select("doc_id", "text", "bucket", "sentinel").mapInArrow(run, SCHEMA)
