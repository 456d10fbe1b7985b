"""Event payloads (JSON text in a ``value`` column, as a Kafka record carries it).

A payload is read by a ``Contract``: the JSON schema, the columns that hold
times and the rule for unreadable payloads (a key column without a value) all
come from it. ``parse_events`` works on a batch or a streaming frame and adds a
``_corrupt`` flag and the raw text for a dead-letter sink. Bad numbers or times
in an otherwise good payload become NULL for that field only.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.contract import Contract

# Payload fields and types (value parsed as decimal, see README D9).
PAYLOAD_CONTRACT = Contract(
    types={
        "tx_id": "string",
        "wallet_id": "string",
        "counterparty_id": "string",
        "value": "decimal(38,8)",
        "asset": "string",
        "event_ts": "timestamp_ntz",
        "produced_ts": "timestamp_ntz",
    },
    key=("tx_id",),
    event_time="event_ts",
)


def parse_events(raw: DataFrame, ts_type: str | None = None, value_col: str = "value",
                 contract: Contract = PAYLOAD_CONTRACT) -> DataFrame:
    """Payload -> the contract's columns + ``_corrupt`` + ``_raw``.

    ``ts_type`` replaces the contract's time type ('timestamp' for watermarks).
    """
    times = {c: ts_type or t for c, t in contract.types.items() if t.startswith("timestamp")}
    wire = ", ".join(f"`{c}` {'string' if c in times else t}" for c, t in contract.types.items())
    read = raw.select(F.col(value_col).cast("string").alias("_raw")).withColumn("_payload", F.from_json("_raw", wire))
    fields = {c: F.col("_payload").getField(c) for c in contract.types}
    no_key = reduce(or_, [fields[k].isNull() for k in contract.key])
    typed = {c: f.try_cast(times[c]) if c in times else f for c, f in fields.items()}
    return read.select(*[f.alias(c) for c, f in typed.items()], no_key.alias("_corrupt"), "_raw")


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("_corrupt"))


def dead_letters(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("_corrupt")).select("_raw")


def event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 fmt: str = "text") -> DataFrame:
    """Streaming source of payload lines with a ``value`` column.

    Files stand in for a broker here (no Kafka client on this machine); a
    Kafka source (``format('kafka')``, ``startingOffsets=earliest``) yields
    the same ``value`` column and feeds the same code.
    """
    reader = spark.readStream.format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Kafka source from the earliest offsets (needs the Kafka connector on the classpath)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .load()
    )
