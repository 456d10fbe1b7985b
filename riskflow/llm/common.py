"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows per Arrow batch handed to Python: documents can be long, so batches are short.
ARROW_ROWS = 1000
ARROW_BYTES = "32m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ready_for_python(spark: SparkSession) -> None:
    """Settings and code for Python tasks.

    A batch holds at most ARROW_ROWS documents and about ARROW_BYTES, which bounds a task's memory.
    The package goes to the executors with the application (once), so tasks
    find it wherever the driver was started.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="riskflow-code-"), "riskflow.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def id_remainder(id_col: Column, n: int) -> Column:
    """crc32(id as text) mod n; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % F.lit(n)


def hash_order(id_col: Column) -> Column:
    """A fixed pseudo-random order of ids, the same at every layout of the table."""
    return F.xxhash64(id_col)


# Code point classes of ``char_classes``.
OTHER, SPACE, DIGIT, LOWER, UPPER = range(5)


@cache
def char_class_table() -> np.ndarray:
    """Class of every code point; letters without case count as LOWER."""
    kinds = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            kinds[i] = UPPER if c.isupper() else LOWER
        elif c.isspace():
            kinds[i] = SPACE
        elif c.isdigit():
            kinds[i] = DIGIT
    return kinds


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
