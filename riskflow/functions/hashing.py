"""Stable hash buckets computed inside the JVM (no Python UDF).

``md5_bucket(x, m)``: md5 of the text form, first 15 hex digits read as a
base-16 number, then a non-negative modulo ``m``. 15 hex digits are 60 bits,
so the number always fits a signed long. The same value in SQL engines:
``cast(concat('0x', substr(md5(x), 1, 15)) as bigint) % m``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_bucket(col: Column, modulus: int) -> Column:
    hex15 = F.substring(F.md5(col.cast("string")), 1, 15)
    return F.pmod(F.conv(hex15, 16, 10).cast("long"), F.lit(modulus))


def md5_unit(col: Column, resolution: int = 1000) -> Column:
    """A deterministic value in [0, 1) with ``resolution`` steps, from md5."""
    return md5_bucket(col, resolution).cast("double") / F.lit(float(resolution))
