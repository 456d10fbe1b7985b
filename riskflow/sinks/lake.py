"""Published tables of a lake: staged per run, switched all at once, read through the session catalog.

A run writes its tables to folders of its own:
  _runs/<run>/<table>/<partition column>=<value>/...
Nothing of that is visible. ``publish`` then writes one small file
  _published/<number>
with the place of every partition of every table: the places of the last
publication, replaced by this run's for the values it covers. The file is
complete or absent, so a run shows whole or not at all, in all tables at once,
and a run that fails anywhere leaves what was published before.

``read`` brings the session catalog up to date - new partitions by one
``ADD PARTITION``, replaced ones by ``SET LOCATION``, emptied ones dropped - and
returns the catalog table, so partition filters prune as usual. A new session
builds its tables from the last publication.

Replaced folders stay for readers that still use them until ``vacuum``.
A single writer per lake is assumed.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.errors import ConfigError
from riskflow.sinks.tables import partition_clause, register_partitions
from riskflow.sources import files as FS

# What the catalog of this application holds: (application, lake) -> (number, {table: {value: place}}).
_CATALOG: dict = {}


def _value(text: str):
    return None if text == FS.NULL_PARTITION else text


class PublishedLake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._records = f"{self.root}/_published"

    # -- staging -----------------------------------------------------------

    def new_run(self) -> str:
        return uuid.uuid4().hex[:12]

    def place(self, run: str, table: str) -> str:
        return f"{self.root}/_runs/{run}/{table}"

    def stage(self, run: str, table: str, rows: DataFrame, partition_col: str) -> int:
        """Write a table of the run, a few right-sized files per partition; rows written."""
        observed = Observation()
        (rows.hint("rebalance", partition_col).observe(observed, F.count(F.lit(1)).alias("rows"))
         .write.mode("overwrite").partitionBy(partition_col).parquet(self.place(run, table)))
        return int(observed.get["rows"])

    def staged(self, run: str, table: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.place(run, table))

    # -- publishing --------------------------------------------------------

    def _last(self) -> tuple[int, dict]:
        numbers = [int(n) for n in FS.list_files(self.spark, self._records) if n.isdigit()]
        if not numbers:
            return 0, {}
        return max(numbers), json.loads(FS.read_text(self.spark, f"{self._records}/{max(numbers)}"))

    def publish(self, run: str, tables: dict) -> int:
        """Make the staged tables of a run visible: {table: (schema, partition column, values)}.

        Each of ``values`` (None: rows without one) that the run covers is replaced, or emptied where nothing was staged.
        """
        number, state = self._last()
        for table, (schema, partition_col, values) in tables.items():
            held = state.get(table, {"places": {}})
            if held["places"] and held["partition_col"] != partition_col:
                raise ConfigError(f"{table} is partitioned by {held['partition_col']}, not {partition_col}")
            staged = set(FS.list_dirs(self.spark, self.place(run, table)))
            places = held["places"]
            for v in values:
                text = FS.NULL_PARTITION if v is None else FS.partition_value(v)
                places.pop(text, None)
                if f"{partition_col}={text}" in staged:
                    places[text] = f"{self.place(run, table)}/{partition_col}={text}"
            data = T.StructType([f for f in schema.fields if f.name != partition_col])
            state[table] = {"schema": data.jsonValue(), "partition_col": partition_col,
                            "partition_type": schema[partition_col].dataType.simpleString(), "places": places}
        FS.write_text(self.spark, f"{self._records}/{number + 1}", json.dumps(state))
        return number + 1

    # -- reading -----------------------------------------------------------

    def catalog_name(self, table: str) -> str:
        return f"lake_{hashlib.md5(self.root.encode()).hexdigest()[:12]}_{table}"

    def _sync(self) -> dict:
        number, state = self._last()
        key = (self.spark.sparkContext.applicationId, self.root)
        known, tables = _CATALOG.get(key, (0, {}))
        if known == number:
            return state
        for table, entry in state.items():
            name, col, places = self.catalog_name(table), entry["partition_col"], entry["places"]
            if table not in tables:
                schema = T.StructType.fromJson(entry["schema"])
                ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table: its files stay
                self.spark.sql(f"CREATE TABLE {name} ({ddl}, `{col}` {entry['partition_type']}) USING parquet "
                               f"PARTITIONED BY (`{col}`) LOCATION '{self.root}/_runs'")
            held = tables.get(table, {})
            gone = [v for v in held if v not in places]
            if gone:
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(partition_clause(_value(v), col) for v in gone))
            for v, place in places.items():
                if v in held and held[v] != place:
                    self.spark.sql(f"ALTER TABLE {name} {partition_clause(_value(v), col)} SET LOCATION '{place}'")
            register_partitions(self.spark, name, {_value(v): p for v, p in places.items() if v not in held}, col)
            self.spark.catalog.refreshTable(name)
        _CATALOG[key] = (number, {t: dict(e["places"]) for t, e in state.items()})
        return state

    def has(self, table: str) -> bool:
        return table in self._last()[1]

    def read(self, table: str) -> DataFrame:
        """A published table as it is now."""
        if table not in self._sync():
            raise ConfigError(f"{table} was never published in {self.root}")
        return self.spark.table(self.catalog_name(table))

    def vacuum(self) -> int:
        """Remove staged folders that the last publication does not use; how many partitions and runs went."""
        _, state = self._last()
        used = {place for entry in state.values() for place in entry["places"].values()}
        removed = 0
        for run in FS.list_dirs(self.spark, f"{self.root}/_runs"):
            base = f"{self.root}/_runs/{run}"
            if not any(place.startswith(f"{base}/") for place in used):
                FS.remove(self.spark, base)
                removed += 1
                continue
            for table in FS.list_dirs(self.spark, base):
                for part in FS.list_dirs(self.spark, f"{base}/{table}"):
                    if f"{base}/{table}/{part}" not in used:
                        FS.remove(self.spark, f"{base}/{table}/{part}")
                        removed += 1
        return removed
