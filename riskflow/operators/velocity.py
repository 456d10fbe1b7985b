"""Measures per owner over tumbling event-time windows.

``windowed_measures`` takes any declared measures; ``velocity_features`` is the
wallet's set. The same function serves batch and stream. In a stream, pass
``watermark`` so state of closed windows is dropped; exact distinct counts are
not allowed there, so they are HLL++ unless ``exact_distinct`` is asked for in batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.measures import Measure, columns

# The stream's watermark delay, window length and measure names.
WATERMARK = "15 minutes"
WINDOW = "10 minutes"
VELOCITY = (
    Measure("tx_count", "count", "tx_id"),
    Measure("total_value", "sum", "value"),
    Measure("distinct_counterparties", "distinct", "counterparty_id"),
    Measure("max_single_value", "max", "value"),
)
BOUNDS = {"window_start": "start", "window_end": "end"}
VELOCITY_COLUMNS = [*BOUNDS, "wallet_id", *(m.name for m in VELOCITY)]


def windowed_measures(rows: DataFrame, measures: Sequence[Measure], owner: Sequence[str], event_time: str, window: str,
                      watermark: str | None = None, exact: bool = False) -> DataFrame:
    """window_start, window_end, the owner columns and one column per measure."""
    timed = rows.withWatermark(event_time, watermark) if watermark else rows
    slots = timed.groupBy(F.window(event_time, window).alias("_slot"), *owner).agg(*columns(measures, exact))
    bounds = {name: F.col(f"_slot.{end}") for name, end in BOUNDS.items()}
    return slots.withColumns(bounds).select(*bounds, *owner, *[m.name for m in measures])


def velocity_features(events: DataFrame, window: str = WINDOW, watermark: str | None = None,
                      exact_distinct: bool = False) -> DataFrame:
    return windowed_measures(events, VELOCITY, ["wallet_id"], "event_ts", window, watermark, exact_distinct)
