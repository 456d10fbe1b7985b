"""Score-derived column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the risk-tier cut used by the ops view.
HIGH_RISK_THRESHOLD = 0.7


def risk_tier(score: Column, threshold: float = HIGH_RISK_THRESHOLD) -> Column:
    """'HIGH' when score > threshold, else 'LOW' (NULL score stays NULL)."""
    return F.when(score > F.lit(threshold), F.lit("HIGH")).when(score.isNotNull(), F.lit("LOW"))
