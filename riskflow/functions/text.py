"""Text rendering of values for facts and reports, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"


def ts_text(col: Column) -> Column:
    """Timestamp as 'YYYY-MM-DD HH:MM:SS' (explicit, session-zone free for NTZ)."""
    return F.date_format(col, TS_TEXT_FORMAT)


def value_text(col: Column) -> Column:
    """A number as plain text."""
    return col.cast("string")


# A double is printed without an exponent from the first up to the second.
PLAIN_FROM, PLAIN_UPTO = 1e-4, 1e16


def double_text(col: Column) -> Column:
    """A double in full, with its shortest digits: '9000.0', '47.2133333', '12345678.9', '1.0E17'."""
    x = col.cast("double")
    short = x.cast("string")
    plain = F.rtrim(short.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(plain, F.lit(".")), F.concat(plain, F.lit("0"))).otherwise(plain)
    within = (F.abs(x) >= PLAIN_FROM) & (F.abs(x) < PLAIN_UPTO)
    return F.when(F.contains(short, F.lit("E")) & within, plain).otherwise(short)


def fixed3(col: Column) -> Column:
    """A double with three decimals, as the score fact prints it."""
    return F.format_string("%.3f", col.cast("double"))
