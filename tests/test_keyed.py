import os

from riskflow.session import local_path
from riskflow.sinks.keyed import KeyedTable

S = "k string, v int, p string"


def rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def data_files(table):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(local_path(f"{table.root}/rows")) for f in files if f.endswith(".parquet"))


def three(spark, work):
    t = KeyedTable(spark, work, "k", "p")
    t.upsert(spark.createDataFrame([("k1", 1, "p1"), ("k2", 1, "p2"), ("k3", 1, "p2")], S))
    return t


def test_replay_gives_the_same_table(spark, work):
    t = three(spark, work)
    for _ in range(2):
        assert t.upsert(spark.createDataFrame([("k2", 2, "p2"), ("k4", 2, "p2")], S)) == 2
        assert rows(t) == [("k1", 1, "p1"), ("k2", 2, "p2"), ("k3", 1, "p2"), ("k4", 2, "p2")]


def test_a_key_moves_to_its_new_partition(spark, work):
    t = three(spark, work)
    t.upsert(spark.createDataFrame([("k1", 2, "p2"), ("k3", 2, "p3")], S))
    want = [("k1", 2, "p2"), ("k2", 1, "p2"), ("k3", 2, "p3")]
    assert rows(t) == want
    t.compact("p = 'p1'")  # the left partition holds no winner any more
    assert rows(t) == want and not any("p=p1" in f for f in data_files(t))


def test_a_one_row_batch_writes_one_small_file(spark, work):
    t = KeyedTable(spark, work, ["k"], ["p"])
    t.upsert(spark.range(20_000).selectExpr("cast(id as string) k", "cast(id as int) v", "'p1' p"))
    before = {f: os.path.getmtime(f) for f in data_files(t)}
    t.upsert(spark.createDataFrame([("7", -1, "p1")], S))
    new = [f for f in data_files(t) if f not in before]
    assert len(new) == 1 and os.path.getsize(new[0]) < 5000
    assert {f: os.path.getmtime(f) for f in before} == before  # nothing was rewritten
    assert t.read().where("k = '7'").first().v == -1 and t.read().count() == 20_000


def test_a_crash_between_write_and_commit_loses_nothing(spark, work):
    t = three(spark, work)
    old = rows(t)
    t.append(spark.createDataFrame([("k2", 9, "p2"), ("k9", 9, "p9")], S), t.begin())  # and no commit
    assert rows(t) == old
    t.upsert(spark.createDataFrame([("k2", 2, "p2")], S))  # the replay, with other rows
    want = [("k1", 1, "p1"), ("k2", 2, "p2"), ("k3", 1, "p2")]
    assert rows(t) == want
    t.compact()
    assert rows(t) == want and not any("p=p9" in f for f in data_files(t))
    t.upsert(spark.createDataFrame([("k5", 1, "p1")], S))  # the shortened log goes on
    assert rows(t) == sorted([*want, ("k5", 1, "p1")])


def test_a_compaction_that_stops_midway_does_no_harm(spark, work, monkeypatch):
    from riskflow.sources import files as FS

    t = three(spark, work)
    t.upsert(spark.createDataFrame([("k2", 2, "p2"), ("k1", 2, "p3")], S))
    old = rows(t)

    def fail(*_):
        raise RuntimeError

    with monkeypatch.context() as m:
        m.setattr(FS, "remove_file", fail)
        try:
            t.compact()
        except RuntimeError:
            pass
    assert rows(t) == old
    t.compact()
    assert rows(t) == old and len(data_files(t)) <= 3


def test_odd_values_and_repeated_keys(spark, work):
    t = KeyedTable(spark, work, ["k"], ["p"])
    odd = [("a b", 1, "x/y: 100%"), (None, 2, "p"), ("ü", 3, None)]
    t.upsert(spark.createDataFrame(odd, S))
    t.upsert(spark.createDataFrame([("r", 1, "p"), ("r", 2, "p")], S))  # one of them counts, always the same
    got = [tuple(r) for r in t.read().collect()]
    assert sorted(map(str, odd)) == sorted(str(r) for r in got if r[0] != "r") and len(got) == 4
    assert t.upsert(spark.createDataFrame([], S)) == 0
    t.compact()
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in t.read().collect())


def test_filters_on_the_partition_reach_the_scan(spark, work):
    t = KeyedTable(spark, work, ["k", "p"], ["p"])
    t.upsert(spark.createDataFrame([("k1", 1, "p1"), ("k2", 1, "p2")], S))
    plan = t.read().where("p = 'p1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
