"""Keyed tables that take upserts as appends and resolve them on read.

Layout under ``root``:
  rows/<partition columns>/_bucket=<b>/...  every row written, with the number of its write in ``_write``
  log/begin=<n>, log/commit=<n>             empty files: write n was started, write n counts

``upsert`` appends the batch, dealt by (partition, bucket of the key), and then
commits it: no file of the table is read or rewritten, so a late row costs one
small file whatever the size of its partition. ``read`` keeps, per key, the row
of the latest committed write. A key may change its partition: the row in the
old one loses against the later write.

Crashes: rows of a write that never committed are not seen, and its number is
never used again; the replay is a write of its own. A batch applied twice gives
the same table.

``compact`` rewrites the partitions asked for: it appends the winning rows under
the write numbers they have, and then removes the files that were there before.
At every moment each winning row exists at least once, and copies of one row do
no harm, so a compaction may stop anywhere and be run again. Readers of the
removed files must start anew.

A single writer per table is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.errors import ConfigError
from riskflow.sources import files as FS

WRITE, BUCKET = "_write", "_bucket"


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, keys, partition_cols, buckets: int = 8):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.keys = [keys] if isinstance(keys, str) else list(keys)
        self.partition_cols = [partition_cols] if isinstance(partition_cols, str) else list(partition_cols)
        self._rows, self._log = f"{self.root}/rows", f"{self.root}/log"

    # -- the log -----------------------------------------------------------

    def _numbers(self, kind: str) -> set:
        return {int(n.split("=", 1)[1]) for n in FS.list_files(self.spark, self._log) if n.startswith(f"{kind}=")}

    def exists(self) -> bool:
        return FS.path_exists(self.spark, f"{self._log}/schema")

    def begin(self) -> int:
        """The number of a new write."""
        number = max(self._numbers("begin") | self._numbers("commit"), default=0) + 1
        FS.write_text(self.spark, f"{self._log}/begin={number}", "")
        return number

    def commit(self, number: int) -> None:
        FS.write_text(self.spark, f"{self._log}/commit={number}", "")

    def _visible(self):
        """Condition on the write number: up to the last commit, less the writes that were given up."""
        done = self._numbers("commit")
        lost = self._numbers("begin") - done
        last = max(done, default=0)
        seen = F.col(WRITE) <= F.lit(last)
        holes = sorted(n for n in lost if n < last)
        return seen & ~F.col(WRITE).isin(holes) if holes else seen

    # -- writing -----------------------------------------------------------

    def append(self, rows: DataFrame, number: int) -> int:
        """Write the rows of write ``number``; they count once it is committed. Rows written."""
        missing = [c for c in [*self.keys, *self.partition_cols] if c not in rows.columns]
        if missing:
            raise ConfigError(f"rows of a keyed table lack {missing}")
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema.fields])
        if not self.exists():
            FS.write_text(self.spark, f"{self._log}/schema", schema.json())
        observed = Observation()
        dealt = (rows.withColumn(WRITE, F.lit(number).cast("long"))
                 .withColumn(BUCKET, F.pmod(F.hash(*self.keys), F.lit(self.buckets)))
                 .hint("rebalance", *self.partition_cols, BUCKET))
        # Above the rebalance, so that an empty batch reports 0.
        (dealt.observe(observed, F.count(F.lit(1)).alias("rows")).write.mode("append")
         .partitionBy(*self.partition_cols, BUCKET).parquet(self._rows))
        return int(observed.get["rows"])

    def upsert(self, rows: DataFrame) -> int:
        """Insert or replace whole rows by key; of rows with one key in the batch one counts. Rows written."""
        number = self.begin()
        n = self.append(rows, number)
        self.commit(number)
        return n

    # -- reading -----------------------------------------------------------

    def _schema(self) -> T.StructType:
        import json

        return T.StructType.fromJson(json.loads(FS.read_text(self.spark, f"{self._log}/schema")))

    def _written(self) -> DataFrame:
        own = self._schema()
        fields = [*own.fields, T.StructField(WRITE, T.LongType()), T.StructField(BUCKET, T.IntegerType())]
        return self.spark.read.schema(T.StructType(fields)).parquet(self._rows)

    def _winners(self, rows: DataFrame) -> DataFrame:
        order = [F.col(WRITE).desc(), F.xxhash64(*self._schema().names)]
        w = Window.partitionBy(*self.keys).orderBy(*order)
        return rows.where(self._visible()).withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")

    def read(self) -> DataFrame:
        """The latest committed row of every key. Filters on key columns reach the scan."""
        return self._winners(self._written()).select(*self._schema().names)

    # -- compaction --------------------------------------------------------

    def compact(self, where=None) -> int:
        """Keep only winning rows in the partitions that meet ``where`` (a condition on the partition columns).

        The number of files removed. A winner is found among all partitions,
        unless the partition columns belong to the key.
        """
        wanted = F.lit(True) if where is None else where
        old = self._written().where(wanted).select(F.input_file_name().alias("file")).distinct()
        # One path per file of these partitions: bounded by the files that are rewritten.
        files = [r["file"] for r in old.collect()]
        if not files:
            return 0
        whole = self._written()
        if set(self.partition_cols) <= set(self.keys):
            whole = whole.where(wanted)
        winners = self._winners(whole).where(wanted)
        (winners.hint("rebalance", *self.partition_cols, BUCKET).write.mode("append")
         .partitionBy(*self.partition_cols, BUCKET).parquet(self._rows))
        for f in files:
            FS.remove_file(self.spark, f)
        if where is None:  # no row of a write that was given up is left: the log shrinks to its last commit
            last = max(self._numbers("commit"), default=0)
            for kind in ("begin", "commit"):
                for n in self._numbers(kind):
                    if n < last:
                        FS.remove(self.spark, f"{self._log}/{kind}={n}")
        return len(files)
