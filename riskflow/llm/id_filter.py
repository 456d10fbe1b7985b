"""Bloom filter of ids, so that whole texts need not be shuffled to learn which of them a later step asks for.

One 64-bit word a hash, ``_BITS`` bits set in it. Tasks set the bits, words are
combined by a grouped ``bit_or`` before they reach the driver, and the filter
is broadcast. It takes at most ``filter_bytes`` at every size of the table:
beyond that it answers more ids that it does not hold, never fewer that it does.

Defined cases: a null id is held by no filter; an empty table gives a filter
that answers none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import ready_for_python

FILTER_BYTES = 16 << 20
BITS_PER_ID = 16
_BITS = 4


def _hash(ids: np.ndarray) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(ids: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(word of each id, bits of that word)."""
    h = _hash(ids)
    bits = np.zeros(len(h), np.uint64)
    for k in range(_BITS):
        bits |= np.uint64(1) << (h >> np.uint64(6 * k) & np.uint64(63))
    return ((h >> np.uint64(32)) * np.uint64(words) >> np.uint64(32)).astype(np.int64), bits


class IdFilter:
    """Words of the filter; ``holds`` may answer for ids that were not put in, never against one that was."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, column: pa.Array) -> np.ndarray:
        """Whether each id of an Arrow column may be in the filter; false for null."""
        known = column.is_valid().to_numpy(zero_copy_only=False)
        word, bits = _places(column.fill_null(0).to_numpy(zero_copy_only=False), len(self.words))
        return known & (self.words[word] & bits == bits)


def build(ids: DataFrame, filter_bytes: int = FILTER_BYTES) -> IdFilter:
    """Filter of a written one-column table of distinct long ids (which is counted first)."""
    ready_for_python(ids.sparkSession)
    words = max(1, min(filter_bytes * 8, BITS_PER_ID * ids.count()) // 64)

    def fill(batches):
        for batch in batches:
            column = batch.column(0).drop_null()
            word, bits = _places(column.to_numpy(zero_copy_only=False), words)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bits.view(np.int64))], names=["word", "bits"])

    out = np.zeros(words, np.uint64)
    got = ids.mapInArrow(fill, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return IdFilter(out)


def matching(rows: DataFrame, id_col: str, ids: IdFilter, wanted: bool = True) -> DataFrame:
    """The rows whose id (a long column) the filter answers, or with ``wanted`` false those it does not; all columns."""
    spark = rows.sparkSession
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast(ids)
    at = rows.columns.index(id_col)

    def run(batches):
        for batch in batches:
            found = shared.value.holds(batch.column(at).cast(pa.int64()))
            yield batch.filter(pa.array(found == wanted, pa.bool_()))

    return rows.mapInArrow(run, rows.schema)
