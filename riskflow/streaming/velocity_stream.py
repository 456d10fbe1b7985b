"""Velocity stream: payloads -> parse -> watermark -> 10-minute windows -> keyed upsert.

Effectively-once results: the source is replayable, offsets and state live in
the checkpoint, and each micro-batch is a keyed upsert on (wallet_id,
window_start) into a ``KeyedTable``: it is appended and then committed, so a
late event costs a small file and a batch replayed after a crash gives the same
table. In update mode every emitted row is the full current aggregate of its
window, so *replace* is right and *add* would double count.

State is kept by RocksDB with changelog checkpoints: it lives outside the heap,
and a micro-batch uploads its changes instead of the whole state. A query that
is stopped, or lost, starts again from the same checkpoint where it was.

Corrupt payloads go to a dead-letter sink (second query, append mode).
Duplicate deliveries are counted as sent (as the original job does) unless
``dedupe_key`` is given; then ``dropDuplicatesWithinWatermark`` drops repeats
of that key inside the watermark before the aggregate (one watermark only).
"""

from __future__ import annotations

import datetime as _dt
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.operators.dedupe import collapse_upsert_keys
from riskflow.operators.opsmetrics import metric_rows, metrics_table
from riskflow.operators.velocity import VELOCITY_COLUMNS, WATERMARK, WINDOW, velocity_features
from riskflow.sinks.keyed import KeyedTable
from riskflow.sources.events import dead_letters, good_events, parse_events

UPSERT_KEYS = ("wallet_id", "window_start")
PARTITION_COL = "window_date"
# Session settings of a query while it starts; a checkpoint keeps the ones it was begun with.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def stream_features(raw: DataFrame, watermark: str = WATERMARK, window: str = WINDOW,
                    dedupe_key: str | None = None) -> DataFrame:
    """The streaming plan up to the aggregate (also runs on a batch frame)."""
    events = good_events(parse_events(raw, ts_type="timestamp"))
    if dedupe_key:
        events = events.withWatermark("event_ts", watermark).dropDuplicatesWithinWatermark([dedupe_key])
        return velocity_features(events, window, watermark=None)
    return velocity_features(events, window, watermark=watermark)


def velocity_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, [*UPSERT_KEYS, PARTITION_COL], PARTITION_COL)


def make_upsert(target_root: str, metrics_root: str | None = None):
    """foreachBatch callback: collapse duplicate keys, append and commit them, record how many rows it were."""

    def _upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cleaned = collapse_upsert_keys(batch, UPSERT_KEYS).withColumn(PARTITION_COL, F.to_date(F.col("window_start")))
        rows = velocity_table(spark, target_root).upsert(cleaned)
        if metrics_root:
            now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
            counted = spark.createDataFrame([(now.date(), rows)], "metric_date date, stream_batch_rows long")
            metrics_table(spark, metrics_root).upsert(
                metric_rows(counted, ["stream_batch_rows"], now, source=f"velocity-{batch_id}"))

    return _upsert


@dataclass
class StreamHandles:
    features: object
    dead_letter: object | None

    def await_all(self) -> None:
        self.features.awaitTermination()
        if self.dead_letter is not None:
            self.dead_letter.awaitTermination()

    def stop(self) -> None:
        for q in (self.features, self.dead_letter):
            if q is not None and q.isActive:
                q.stop()


@contextmanager
def _settings(spark: SparkSession, values: dict):
    """Settings that hold while a query starts (it runs on a copy of the session)."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_stream(raw: DataFrame, target_root: str, checkpoint_root: str, dead_letter_root: str | None = None,
               available_now: bool = True, dedupe_key: str | None = None, metrics_root: str | None = None
               ) -> StreamHandles:
    """Start the velocity query (and the dead-letter query when a path is given)."""
    feats = stream_features(raw, dedupe_key=dedupe_key)
    writer = (
        feats.writeStream.foreachBatch(make_upsert(target_root, metrics_root))
        .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/velocity")
        .outputMode("update")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    with _settings(raw.sparkSession, STATE_SETTINGS):
        q = writer.start()
    dl = None
    if dead_letter_root:
        dlw = (
            dead_letters(parse_events(raw, ts_type="timestamp"))
            .writeStream.format("parquet")
            .option("path", dead_letter_root)
            .option("checkpointLocation", f"{checkpoint_root.rstrip('/')}/dead_letter")
            .outputMode("append")
        )
        dlw = dlw.trigger(availableNow=True) if available_now else dlw.trigger(processingTime="10 seconds")
        dl = dlw.start()
    return StreamHandles(q, dl)


def read_velocity_table(spark: SparkSession, root: str) -> DataFrame:
    return velocity_table(spark, root).read().select(*VELOCITY_COLUMNS)
