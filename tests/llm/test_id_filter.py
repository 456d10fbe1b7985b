"""Filters of ids: nothing held is missed, others seldom answered, and near-dedup is exact with a filter that answers all."""

from functools import partial

import numpy as np
import pyarrow as pa
import pytest

from riskflow.llm import id_filter, near_dedup
from tests.llm.test_queries import ODD, _docs


def _ids(spark, ids, parts=3):
    return spark.createDataFrame([(int(i),) for i in ids], "id long").repartition(parts)


def test_filter_holds_its_ids_and_few_others(spark):
    own = np.concatenate([np.arange(-50, 5000, 3), [2**63 - 1, -2**63]])
    built = id_filter.build(_ids(spark, own))
    assert built.holds(pa.array(own, pa.int64())).all()
    others = np.setdiff1d(np.arange(10_000, 110_000), own)
    assert built.holds(pa.array(others, pa.int64())).mean() < 0.05
    assert len(built.words) * 64 <= id_filter.BITS_PER_ID * len(own)


def test_filter_of_odd_ids(spark):
    built = id_filter.build(_ids(spark, [7]))
    assert built.holds(pa.array([7, None], pa.int64())).tolist() == [True, False]
    empty = id_filter.build(_ids(spark, []))
    assert not empty.holds(pa.array([0, 7, None], pa.int64())).any()
    assert empty.holds(pa.array([], pa.int64())).tolist() == []


def test_a_small_filter_stays_in_its_bytes_and_misses_nothing(spark):
    own = np.arange(20_000)
    built = id_filter.build(_ids(spark, own), filter_bytes=1024)
    assert built.words.nbytes == 1024 and built.holds(pa.array(own, pa.int64())).all()


def test_matching_splits_the_rows(spark):
    rows = spark.range(1000).selectExpr("cast(id as int) id", "concat('t', id) text")
    built = id_filter.build(_ids(spark, range(0, 1000, 2)))
    inside, outside = (id_filter.matching(rows, "id", built, wanted=w).collect() for w in (True, False))
    assert {r["id"] for r in inside} >= set(range(0, 1000, 2))
    assert sorted(r["text"] for r in inside + outside) == sorted(f"t{i}" for i in range(1000))


@pytest.mark.parametrize("filter_bytes", [8, id_filter.FILTER_BYTES])
def test_near_dedup_does_not_depend_on_the_filter(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(near_dedup.id_filter, "build", partial(id_filter.build, filter_bytes=filter_bytes))
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(i, base + f" tail{i}") for i in range(5, 9)] + [(20, "a clean text of its own words"), (21, "x y z"), (21, "x y z")]
    got = near_dedup.keep_one(_docs(spark, rows).repartition(3)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(5, base + " tail5"), (20, "a clean text of its own words"), (21, "x y z")]
    groups = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(_docs(spark, rows)).collect()}
    assert groups == {5: 5, 6: 5, 7: 5, 8: 5, 20: 20, 21: 21}
    odd = near_dedup.keep_one(_docs(spark, ODD))
    assert sorted(str(r["doc_id"]) for r in odd.collect()) == ["1", "2", "3", "4", "5", "6", "7", "None"]
