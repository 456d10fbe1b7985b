"""Sharding: plain scheduling, balance with bundles, odd inputs."""

import heapq
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import sharding
from riskflow.session import scratch_path

DOCS = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "no id"), (None, "no id"), (4, "x" * 70000), (5, "é漢字"), (6, "b"), (2, "")]


def _loads(rows, shards):
    loads = [0] * shards
    for r in rows:
        loads[r["shard"]] += r["size"]
    return loads


def _check(rows, docs, shards):
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs), key=str)
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 7))
def test_schedule_is_longest_first_to_the_least_load(sizes, shards):
    placed = sharding.schedule([(k, s) for k, s in enumerate(sizes)], shards)
    loads = [0] * shards
    for k, s in sorted(enumerate(sizes), key=lambda e: (-e[1], e[0])):
        least = min(range(shards), key=lambda i: (loads[i], i))
        assert placed[k] == least
        loads[least] += s


def test_groups_stay_together_and_loads_are_those_of_plain_scheduling(spark):
    docs = [(i, "abcdefgh" * (i * 37 % 50) + str(i % 400)) for i in range(1000)] + [(5000 + i, "copied text") for i in range(300)]
    rows = sharding.assign(spark.createDataFrame(docs, DOCS).repartition(5), 7).collect()
    _check(rows, docs, 7)
    sizes, shard_of = {}, {}
    texts = dict(docs)
    for r in rows:
        text = texts[r["doc_id"]]
        sizes[text] = sizes.get(text, 0) + r["size"]
        assert shard_of.setdefault(text, r["shard"]) == r["shard"]
    heap = [0] * 7
    for s in sorted(sizes.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + s)
    assert sorted(_loads(rows, 7)) == sorted(heap)  # every group is an entry of its own here


def test_bundles_level_the_loads(spark):
    docs = [(i, f"text {i} " + "y" * (i * 7919 % 200)) for i in range(6000)]
    rows = sharding.assign(spark.createDataFrame(docs, DOCS), 4, heavy=1).collect()
    _check(rows, docs, 4)
    loads = _loads(rows, 4)
    assert max(loads) - min(loads) <= 220  # no more than the largest document


def test_a_group_larger_than_a_shard_leaves_the_rest_even(spark):
    docs = [(i, "z" * 50) for i in range(500)] + [(1000 + i, f"{i:05d}" * 4) for i in range(400)]
    loads = sorted(_loads(sharding.assign(spark.createDataFrame(docs, DOCS), 5, heavy=10).collect(), 5))
    assert loads[-1] == 500 * 58 and loads[3] - loads[0] <= 28


def test_odd_rows_empty_tables_and_other_columns(spark):
    rows = sharding.assign(spark.createDataFrame(ODD, DOCS), 3).collect()
    _check(rows, ODD, 3)
    assert len({r["shard"] for r in rows if r["text_crc32"] == 0}) == 1  # null and empty texts are one group
    clashing = spark.createDataFrame([(i, t, 9, 9, "s", 9, 9, 9) for i, t in ODD],
                                     DOCS + ", shard int, size int, slot string, task int, local int, bundle int")
    assert sorted(map(str, sharding.assign(clashing, 3).drop("slot").collect())) == sorted(
        str(r) for r in sharding.assign(spark.createDataFrame(ODD, DOCS), 3).drop("slot").collect())
    assert sharding.assign(spark.createDataFrame([], DOCS), 3).count() == 0


def test_written_shards_hold_every_row(spark):
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(ODD)], DOCS + ", place int")
    back = sharding.write_shards(docs, 3, scratch_path(spark, "shards"))
    assert sorted(map(str, back.select("doc_id", "text", "place").collect())) == sorted(map(str, docs.collect()))
    placed = {r["place"]: r["shard"] for r in back.collect()}
    assert placed[2] == placed[3] and placed[0] == placed[1] == placed[9]
