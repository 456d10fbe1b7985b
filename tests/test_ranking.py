from pyspark.sql import Window
from pyspark.sql import functions as F

from riskflow.operators.ranking import global_positions, group_positions, running_sums


def skewed(spark, n=5000):
    # one key holds ~60 % of the rows
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 5 < 3, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 17).cast("string")))
        .alias("g"),
        (F.col("id") * 7919 % 1000).alias("v"),
    )


def test_global_positions_equal_row_number(spark):
    df = skewed(spark)
    got = {r.id: r.position for r in global_positions(df, ["v", "id"], partitions=7).collect()}
    want = {r.id: r.rn - 1 for r in df.select("id", F.row_number().over(Window.orderBy("v", "id")).alias("rn")).collect()}
    assert got == want


def test_group_positions_spread_hot_group(spark):
    df = skewed(spark)
    got = {r.id: r.position for r in group_positions(df, ["g"], ["v", "id"], partitions=9).collect()}
    w = Window.partitionBy("g").orderBy("v", "id")
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
    assert got == want


def test_running_sums(spark):
    df = spark.range(1, 101).select(F.col("id"), F.lit(1).alias("one"), F.col("id").alias("x"))
    out = {r.id: (r.cum_one, r.cum_x) for r in running_sums(df, ["id"], ["one", "x"], partitions=6).collect()}
    assert all(out[i] == (i, i * (i + 1) // 2) for i in range(1, 101))
