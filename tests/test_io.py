import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from riskflow.errors import IngestionError
from riskflow.session import local_path
from riskflow.sinks import tables as T
from riskflow.sources import files as FS
from riskflow.sources import graph as G


def extract(spark, n, tag):
    return spark.range(n).select(F.concat(F.lit(tag), F.col("id").cast("string")).alias("tx_id"))


def test_land_rerun_same_rows_and_other_date_kept(spark, work):
    root = f"{work}/bronze"
    d1, d2 = dt.date(2026, 7, 1), dt.date(2026, 7, 2)
    T.land_partition(extract(spark, 5, "a"), root, d1)
    T.land_partition(extract(spark, 5, "a"), root, d1)
    T.land_partition(extract(spark, 3, "b"), root, d2)
    assert FS.read_partition(spark, root, d1).count() == 5
    assert FS.read_partition(spark, root).count() == 8
    assert set(FS.read_partition(spark, root, d2).columns) == {"tx_id", "ingest_date"}


def test_missing_or_empty_source(spark, work):
    with pytest.raises(IngestionError):
        FS.validate_source(spark, f"{work}/nope")
    os.makedirs(local_path(f"{work}/empty"))
    open(local_path(f"{work}/empty/zero.parquet"), "w").close()
    with pytest.raises(IngestionError):
        FS.validate_source(spark, f"{work}/empty")


def test_zero_byte_files_skipped(spark, work):
    extract(spark, 4, "x").write.parquet(f"{work}/src")
    open(local_path(f"{work}/src/zero.parquet"), "w").close()
    assert FS.read_extract(spark, f"{work}/src").count() == 4


def test_labelled_graph_loader(spark, work):
    p = local_path(work)
    os.makedirs(p, exist_ok=True)
    with open(f"{p}/features.csv", "w") as fh:
        fh.write("101,1,0.5,7\n102,1,-2.0,8\n103,2,1.25,9\n")
    with open(f"{p}/classes.csv", "w") as fh:
        fh.write("txId,class\n101,1\n102,2\n103,unknown\n")
    tx, labels = G.load_labelled_graph(spark, f"{work}/features.csv", f"{work}/classes.csv")
    rows = {r.tx_id: r for r in tx.collect()}
    assert len(rows) == 3 and rows["101"].asset == "BTC" and rows["101"].value == "501.0"
    assert rows["103"].event_ts > rows["101"].event_ts
    assert {r.tx_id: r.fraud_label for r in labels.collect()} == {"101": "ILLICIT", "102": "LICIT", "103": "UNKNOWN"}
    again, _ = G.load_labelled_graph(spark, f"{work}/features.csv", f"{work}/classes.csv", infer=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, tx.collect()))
    with pytest.raises(IngestionError):
        G.load_labelled_graph(spark, f"{work}/missing.csv", f"{work}/classes.csv")


def test_register_partition_twice(spark, work):
    root = f"{work}/t"
    T.land_partition(extract(spark, 2, "a"), root, dt.date(2026, 7, 1))
    T.create_partitioned_table(spark, "bronze_tx_test", root, "tx_id string")
    for _ in range(2):
        T.register_partition(spark, "bronze_tx_test", dt.date(2026, 7, 1), f"{root}/ingest_date=2026-07-01")
    assert spark.table("bronze_tx_test").count() == 2
    spark.sql("DROP TABLE bronze_tx_test")


def test_upsert_frame(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    u = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    assert sorted(map(tuple, T.upsert_frame(t, u, "k").collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_tables_are_read_as_they_are_split(spark, work):
    spark.range(50_000).selectExpr("id", "cast(id * 7 as string) s").coalesce(1).write.parquet(f"{work}/one")
    assert FS.read_table(spark, f"{work}/one").rdd.getNumPartitions() == 1
    dealt = FS.read_table(spark, f"{work}/one", partitions=5)
    assert dealt.rdd.getNumPartitions() == 5 and dealt.count() == 50_000


def test_partitions_are_registered_by_one_statement(spark, work, monkeypatch):
    root = f"{work}/t"
    T.land_partition(extract(spark, 2, "a"), root, dt.date(2026, 7, 1))
    T.land_partition(extract(spark, 3, "b"), root, dt.date(2026, 7, 2))
    T.create_partitioned_table(spark, "bronze_tx_many", root, "tx_id string")
    sent = []
    monkeypatch.setattr(type(spark), "sql", lambda self, text, run=type(spark).sql: (sent.append(text), run(self, text))[1])
    T.register_partitions(spark, "bronze_tx_many", {f"2026-07-0{k}": f"{root}/ingest_date=2026-07-0{k}" for k in (1, 2)})
    assert len(sent) == 1
    assert spark.table("bronze_tx_many").count() == 5
    spark.sql("DROP TABLE bronze_tx_many")


def test_scratch_folder_must_be_shared_off_local():
    from types import SimpleNamespace

    from riskflow.errors import ConfigError
    from riskflow.session import ensure_checkpoint_dir

    faked = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None),
                            conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ConfigError):
        ensure_checkpoint_dir(faked)


def test_missing_metrics_are_breaches_from_the_given_day(spark):
    import datetime as dt

    from riskflow.operators.opsmetrics import zero_row_days

    none = spark.createDataFrame([], "metric_name string, metric_value double, metric_date date, written_at timestamp_ntz")
    got = zero_row_days(none, dt.date(2024, 1, 3), since=dt.date(2024, 1, 1)).collect()
    assert len(got) == 3 and all(r.breach for r in got)
