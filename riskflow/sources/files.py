"""File sources: extract validation, partitioned scans, CSV readers.

Listing goes through Hadoop's FileSystem API on the driver (metadata only),
so the same code works for local paths, HDFS and object stores.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.errors import IngestionError


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


# Fixed value: the folder name of Spark's partition writer for a NULL value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table, if it exists."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def remove_file(spark: SparkSession, url: str) -> None:
    """Delete a data file by its URL, as ``input_file_name`` gives it (special characters escaped)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(url))
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False)


def list_dirs(spark: SparkSession, path: str) -> list:
    """Names of sub-directories of ``path`` ([] if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list:
    """Names of the files in a folder ([] if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, complete or absent: written beside its place and renamed."""
    fs, p = _fs(spark, path)
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_tmp-{uuid.uuid4().hex}")
    out = fs.create(part)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, p):
        fs.delete(part, False)
        raise IngestionError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _fs(spark, path)
    n = int(fs.getFileStatus(p).getLen())
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, n)).decode()
    finally:
        stream.close()


def validate_source(spark: SparkSession, path: str) -> list:
    """Data files of an extract (a file or a folder); zero-byte and hidden files skipped.

    Raises IngestionError when the path is missing or holds no non-empty file.
    """
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        raise IngestionError(f"raw extract missing: {path}")
    statuses = [fs.getFileStatus(p)] if fs.isFile(p) else list(fs.listStatus(p))
    files = []
    for s in statuses:
        name = s.getPath().getName()
        if s.isFile() and s.getLen() > 0 and not name.startswith(("_", ".")):
            files.append(s.getPath().toString())
    if not files:
        raise IngestionError(f"no non-empty files found at: {path}")
    return sorted(files)


def read_extract(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, options: dict | None = None
                 ) -> DataFrame:
    """Read a validated extract (only its non-empty files)."""
    files = validate_source(spark, path)
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(files)


def read_table(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """A Parquet table as it is split; ``partitions`` deals its rows over that many tasks first."""
    df = spark.read.parquet(path)
    return df.repartition(partitions) if partitions else df


def partition_value(d) -> str:
    if isinstance(d, (_dt.date, _dt.datetime)):
        return d.strftime("%Y-%m-%d")
    return str(d)


def partition_path(root: str, logical_date, partition_col: str = "ingest_date") -> str:
    """Folder of one date partition: ``<root>/<col>=YYYY-MM-DD``."""
    return f"{root.rstrip('/')}/{partition_col}={partition_value(logical_date)}"


def read_partition(spark: SparkSession, root: str, logical_date=None, partition_col: str = "ingest_date",
                   schema=None) -> DataFrame:
    """Scan a partitioned dataset; with ``logical_date`` only that partition is listed/read.

    The partition column is kept (reading the leaf folder directly would drop it).
    ``schema`` (including the partition column) skips inference, so a table
    whose writes so far were all empty still reads as zero rows.
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(root)
    if logical_date is not None:
        df = df.where(F.col(partition_col) == F.lit(partition_value(logical_date)).cast("date"))
    return df


def read_headerless_csv(spark: SparkSession, path: str, names, schema: str | None = None) -> DataFrame:
    """CSV without header; the first ``len(names)`` columns renamed by position, the rest dropped.

    With ``schema`` (DDL for the named columns) there is no inference pass.
    """
    validate_source(spark, path)
    names = list(names)
    if schema:
        return spark.read.schema(schema).option("header", False).csv(path).select(*names)
    df = spark.read.option("header", False).option("inferSchema", True).csv(path)
    return df.select(*[F.col(c).alias(n) for c, n in zip(df.columns, names)])


def read_header_csv(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """CSV with header, every column as string; optionally only the first ``first`` columns."""
    validate_source(spark, path)
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return df.select(*df.columns[:first]) if first else df
