"""Hot-key handling for equi-joins.

A key that holds a large share of one side sends all its rows to one
reducer. ``hot_keys`` finds keys above a row threshold with one partial
aggregate; the result has at most ``rows / threshold`` entries and is written
once, so Spark joins it by its known size. ``salted_join`` spreads each hot
key's rows on the big side over sub-keys (a deterministic hash of the row, so
a retried task routes rows the same way) and copies the small side's matching
rows to every sub-key. Cold keys keep sub-key 0. Rows without a key match
nothing and are spread by their hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.errors import ConfigError
from riskflow.session import materialize

SALT = "_rf_salt"
N_SALT = "_rf_nsalt"

# Sub-keys for rows without a key, which need no partner.
NO_KEY_SALTS = 1 << 16


def hot_keys(df: DataFrame, keys, min_rows: int | None = None, share: float | None = None) -> DataFrame:
    """Keys with at least ``min_rows`` rows, with the salt fan-out ceil(rows / min_rows) per key.

    ``share`` gives the threshold as a part of all rows instead; the total
    comes from the same counts, so ``df`` is read once.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*keys).count()
    if min_rows is None:
        counts = materialize(counts, "key-counts")
        total = counts.agg(F.sum("count")).first()[0] or 0
        min_rows = max(1, int(total * share))
    return (
        counts
        .where(F.col("count") >= F.lit(min_rows))
        .select(*keys, F.ceil(F.col("count") / F.lit(min_rows)).cast("int").alias(N_SALT))
    )


def salted_join(big: DataFrame, small: DataFrame, keys, how: str, extra_cond=None,
                hot: DataFrame | None = None, min_rows: int | None = None,
                share: float | None = None) -> DataFrame:
    """Join ``big`` to ``small`` on ``keys`` (+ ``extra_cond(big_alias, small_alias)``).

    ``how`` is 'inner' or 'left' (big side preserved). Hot keys come from
    ``hot`` or are computed from ``big`` with ``min_rows`` or ``share``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("inner", "left"):
        raise ConfigError(f"salted_join supports inner/left, not {how}")
    if hot is None:
        if not min_rows and not share:
            raise ConfigError("salted_join needs hot keys, min_rows or share")
        hot = hot_keys(big, keys, min_rows, share)
    hot = materialize(hot, "hot-keys")
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    b = big.join(hot, keys, "left").withColumn(
        SALT, F.when(no_key, F.pmod(row_hash, F.lit(NO_KEY_SALTS))).otherwise(
            F.coalesce(F.pmod(row_hash, F.col(N_SALT)), F.lit(0))).cast("int")
    ).drop(N_SALT)
    s = small.join(hot, keys, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(N_SALT), F.lit(1)) - 1))).drop(N_SALT)
    bb, ss = b.alias("_b"), s.alias("_s")
    cond = None
    for k in keys + [SALT]:
        c = F.col(f"_b.{k}") == F.col(f"_s.{k}")
        cond = c if cond is None else cond & c
    if extra_cond is not None:
        cond = cond & extra_cond("_b", "_s")
    out = bb.join(ss, cond, how)
    small_cols = [c for c in small.columns if c not in keys]
    return out.select(*[F.col(f"_b.{c}") for c in big.columns], *[F.col(f"_s.{c}") for c in small_cols])
