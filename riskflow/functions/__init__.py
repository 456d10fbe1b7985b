from riskflow.functions.hashing import md5_bucket, md5_unit
from riskflow.functions.scoring import HIGH_RISK_THRESHOLD, risk_tier
from riskflow.functions.text import fixed3, ts_text, value_text

__all__ = [
    "md5_bucket",
    "md5_unit",
    "risk_tier",
    "HIGH_RISK_THRESHOLD",
    "ts_text",
    "value_text",
    "fixed3",
]
