from riskflow.sinks.keyed import KeyedTable
from riskflow.sinks.lake import PublishedLake
from riskflow.sinks.tables import (
    Scd2Table,
    create_partitioned_table,
    land_partition,
    materialize_view,
    overwrite_partitions,
    register_partition,
    register_partitions,
    upsert_frame,
)

__all__ = [
    "KeyedTable",
    "PublishedLake",
    "Scd2Table",
    "create_partitioned_table",
    "land_partition",
    "materialize_view",
    "overwrite_partitions",
    "register_partition",
    "register_partitions",
    "upsert_frame",
]
