"""Table tests in the dbt style: each returns the offending rows (none = pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.operators.scd2 import IS_CURRENT, VALID_FROM, VALID_TO


def scd2_breaches(dims: DataFrame, key: str = "wallet_id") -> DataFrame:
    """(key, breach) for overlapping ranges and for keys with several current rows.

    Overlap: a closed row whose valid_to is after the next row's valid_from
    (next by valid_from within the key). Duplicates of a breach are kept, as
    the two checks are UNION ALL-ed.
    """
    # valid_to breaks valid_from ties (open row last) so the check is deterministic.
    w = Window.partitionBy(key).orderBy(F.col(VALID_FROM).asc_nulls_last(), F.col(VALID_TO).asc_nulls_last())
    ordered = dims.select(key, VALID_FROM, VALID_TO, F.lead(VALID_FROM).over(w).alias("next_from"))
    overlaps = ordered.where(
        F.col(VALID_TO).isNotNull() & F.col("next_from").isNotNull() & (F.col(VALID_TO) > F.col("next_from"))
    ).select(key, F.lit("overlapping_range").alias("breach"))
    multi = (
        dims.where(F.col(IS_CURRENT))
        .groupBy(key)
        .count()
        .where(F.col("count") > 1)
        .select(key, F.lit("multiple_current_rows").alias("breach"))
    )
    return overlaps.unionByName(multi)


def not_null_violations(df: DataFrame, cols) -> DataFrame:
    """Rows with a NULL in any of ``cols``, plus which columns are NULL."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    which = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(cond).withColumn("null_columns", which)


def unique_violations(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count (partial aggregate)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def accepted_values_violations(df: DataFrame, col: str, allowed) -> DataFrame:
    """Rows whose ``col`` is set and not in ``allowed``."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(allowed)))


def relationship_violations(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None
                            ) -> DataFrame:
    """Child rows whose key has no parent row (left anti join)."""
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")
