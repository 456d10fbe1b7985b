"""MinHash near-dedup with tensored banding.

A document's set is its distinct word shingles (words: runs of non-space bytes,
A-Z lower-cased; a text with fewer words is one shingle, a text without words
has the empty set). Two documents are linked if 100 * |intersection| >=
percent * |union|; a component's documents are one near-duplicate group.

Table keys are tensored: two collections of ``SUB`` small keys (``WIDTH`` minhashes
each) are computed, and the keys of the SUB * SUB tables are all pairs of one
key of either collection. That takes 2 * SUB * WIDTH minhashes instead of
2 * SUB * SUB * WIDTH. A pair of similarity s meets in some table with
probability (1 - (1 - s^WIDTH)^SUB)^2: 0.9999 at s = 0.8.

From tables to components, without listing all pairs of a table entry:
1. Equal sets collapse to one node (the smallest doc_id).
2. Small keys held by one node only can't be part of a shared table key and
   are dropped before the pairs are formed (nothing else is lost by it).
3. Star rounds: the nodes of an entry are compared with one of them. Links
   join components; nodes already in one component need no comparison.
4. Nodes of entries that still hold several components are met by an exact
   prefix filter on their shingles, rarest first, across components, with an
   exact bound on bit maps of the sets as part of the join. So every
   two nodes of an entry end in one component or are proven not to be linked.
Every candidate is confirmed on the full sets. Those are made where the texts
lie, for the ids that a filter of bounded size answers (``id_filter``); an id
too many costs its set, nothing else. Likewise ``keep_one`` shuffles only the
texts whose id may be among those that go.

Defined cases: rows that share a doc_id count as one document (linked if any of
them is); null texts and texts without words have n_shingles 0 and are linked
with nothing; a null doc_id is linked with nothing (component_id null, kept);
an empty table gives an empty result; other columns of the input are not read.
``keep_one`` tells the different texts of one id apart, each as a document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskflow.llm import id_filter
from riskflow.llm.common import ready_for_python
from riskflow.llm.id_filter import IdFilter
from riskflow.operators.ranking import global_positions
from riskflow.session import materialize

SUB = 10
WIDTH = 2
STAR_ROUNDS = 1
LARGE_ENTRY = 8  # entries beyond it are compared by stars first
_WORD_CACHE = 200_000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered for the frequent ones."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(text: str | None, words: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a text."""
    split = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, split), np.uint64, len(split))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for k in range(min(words, len(h))):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n])
    return np.unique(out)


def _seeds(count: int) -> np.ndarray:
    return _mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def small_keys(shingles: np.ndarray, sub: int, width: int) -> np.ndarray:
    """2 * sub small keys: the first half is one collection, the second half the other."""
    seeds = _seeds(2 * sub * width)
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):  # bounded memory for very long texts
        least = np.minimum(least, _mix(shingles[None, at:at + 4096] ^ seeds[:, None]).min(1))
    keys = np.arange(2 * sub, dtype=np.uint64)
    for k in range(width):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + least[k::width])
    return keys.view(np.int64)


def signatures(docs: DataFrame, words: int, sub: int, width: int) -> DataFrame:
    ready_for_python(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()),
                        ("keys", pa.list_(pa.int64()))])

    def run(batches):
        cache = WordHashes()
        for batch in batches:
            sizes, sets, keys = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, words, cache)
                sizes.append(len(s))
                sets.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                keys.append(small_keys(s, sub, width) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, keys array<long>")


def _sets(docs: DataFrame, words: int, wanted: IdFilter) -> DataFrame:
    """Full sets of the documents that the filter answers; the texts are read where they lie, not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        cache = WordHashes()
        for batch in batches:
            batch = batch.filter(pa.array(shared.value.holds(batch.column(0)), pa.bool_()))
            sets = [shingle_set(t, words, cache).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "members"])

    return docs.mapInArrow(run, "node long, members binary")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) whose full sets meet the threshold."""
    a = sets.select(F.col("node").alias("x"), F.col("members").alias("x_set"))
    b = sets.select(F.col("node").alias("y"), F.col("members").alias("y_set"))
    both = pairs.join(a, "x").join(b, "y").select("x", "y", "x_set", "y_set")

    def run(batches):
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                inter = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * inter >= percent * (len(p) + len(q) - inter))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)],
                                             names=["x", "y"])

    return both.mapInArrow(run, "x long, y long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for the end points of ``edges`` (x, y).

    Labels move along the edges and along the labels themselves (pointer
    jumping); every step is one written table, so a lost executor costs one step.
    """
    both = edges.select("x", "y").where("x <> y")
    both = materialize(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("y"))
                         .select("node", F.least("node", "y").alias("component")), "labels")
    while True:
        near = (both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("component").alias("near")))
        moved = labels.join(near, labels["node"] == near["x"]).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("jumped"))
        step = materialize(moved.join(jump, F.col("next") == F.col("via")).select(
            "node", "old", F.least("next", "jumped").alias("component")), "labels")
        labels = step.select("node", "component")
        if not step.where("old <> component").limit(1).count():
            return labels


def _merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Component labels after more edges: the old components are the nodes of the next search."""
    if labels is None:
        return components(edges)
    a = labels.select(F.col("node").alias("x"), F.col("component").alias("cx"))
    b = labels.select(F.col("node").alias("y"), F.col("component").alias("cy"))
    between = materialize(edges.join(a, "x", "left").join(b, "y", "left").select(
        F.coalesce("cx", "x").alias("x"), F.coalesce("cy", "y").alias("y")).where("x <> y").distinct(), "links")
    found = components(between).select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = labels.join(found, labels["component"] == found["old"], "left").select(
        "node", F.coalesce("new", "component").alias("component"))
    # Nodes that had no link before are their own old component.
    fresh = found.join(labels, found["old"] == labels["node"], "left_anti").select(
        F.col("old").alias("node"), F.col("new").alias("component"))
    return materialize(moved.unionByName(fresh), "labels")


def _table_entries(nodes: DataFrame, sub: int) -> DataFrame:
    """node, n, key for every tensored table key made of small keys that several nodes hold."""
    small = nodes.select("node", "n", F.posexplode("keys").alias("place", "small"))
    shared = materialize(small.groupBy("small").agg(F.count("*").alias("c")).where("c > 1").select("small"), "small-keys")
    held = (small.join(shared, "small", "left_semi").groupBy("node", "n")
            .agg(F.collect_list(F.when(F.col("place") < sub, F.col("small"))).alias("first"),
                 F.collect_list(F.when(F.col("place") >= sub, F.col("small"))).alias("second")))
    return (held.select("node", "n", F.explode("first").alias("a"), "second")
            .select("node", "n", "a", F.explode("second").alias("b"))
            .select("node", "n", F.xxhash64("a", "b").alias("key")))


def _fits(percent: int):
    """Length filter: sets of these sizes can meet the threshold."""
    return 100 * F.least("xn", "yn") >= percent * F.greatest("xn", "yn")


def _pair(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.where(_fits(percent)).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def _rest_pairs(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of different components that can meet the threshold, by an exact prefix filter.

    A set of n shingles that meets the threshold with another shares at least
    ceil(percent / 100 * n) of them. In any order of the shingles the first
    n - that + 1 of both sets then share one. The order here: shingles of one
    component only (they match nothing outside), then the others, rarest first.
    Most nodes have enough shingles of the first kind to be done with.
    """
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one document's rows at a time
                members = np.frombuffer(batch.column(3)[i].as_py(), np.int64)
                repeated = [pa.array(np.full(len(members), batch.column(k)[i].as_py())) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*repeated, pa.array(members)], names=["x", "xn", "cx", "shingle"])

    rest = materialize(rest, "rest")
    held = rest.join(sets, "node").select("node", "n", "component", "members").mapInArrow(
        run, "x long, xn long, cx long, shingle long")
    shared = materialize(held.groupBy("shingle").agg(F.count("*").alias("c"), F.min("cx").alias("low"), F.max("cx").alias("high"))
                         .where("low <> high").select("shingle", "c"), "shared-shingles")
    held = materialize(held.join(shared, "shingle"), "shared-places")
    least = F.ceil(F.lit(percent) * F.col("xn") / 100)
    able = (held.groupBy("x", "xn").agg(F.count("*").alias("inside")).where(F.col("inside") >= least)
            .select("x", (F.col("xn") - F.col("inside")).alias("alone"), (F.col("xn") - least + 1).alias("slots")))
    able = materialize(_bitmaps(able.join(sets, able["x"] == sets["node"])), "able")
    order = Window.partitionBy("x").orderBy("c", "shingle")
    prefix = materialize(held.join(able, "x").withColumn("place", F.col("alone") + F.row_number().over(order))
                         .where("place <= slots").drop("c", "alone", "slots"), "prefixes")
    other = prefix.select("shingle", *[F.col(c).alias(f"other_{c}") for c in prefix.columns if c != "shingle"])
    # The least overlap of a pair of these sizes, and so the most shingles that may differ.
    both = f"(({percent} * (xn + other_xn) + {99 + percent}) div {100 + percent})"
    differ = " + ".join(f"bit_count({w} ^ other_{w})" for w in _BITMAP)
    close = F.expr(f"x < other_x and cx <> other_cx and place <= xn - {both} + 1 and other_place <= other_xn - {both} + 1 "
                   f"and {differ} <= xn + other_xn - 2 * {both}")
    return prefix.join(other, "shingle").where(close).select("x", F.col("other_x").alias("y")).distinct()


_BITMAP = [f"w{i}" for i in range(16)]


def _bitmaps(rows: DataFrame) -> DataFrame:
    """x, alone and slots with a 1024-bit map of the set: bits that differ are never more than the shingles that do."""
    def run(batches):
        for batch in batches:
            words = np.zeros((batch.num_rows, 16), np.uint64)
            for i, m in enumerate(batch.column(3).to_pylist()):
                bits = np.zeros(1024, np.uint8)
                bits[np.frombuffer(m, np.uint64) >> np.uint64(54)] = 1
                words[i] = np.packbits(bits).view(np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(words[:, i].view(np.int64)) for i in range(16)]],
                names=["x", "alone", "slots", *_BITMAP])

    return rows.select("x", "alone", "slots", "members").mapInArrow(
        run, "x long, alone long, slots long, " + ", ".join(f"{w} long" for w in _BITMAP))


def links(docs: DataFrame, nodes: DataFrame, words: int, percent: int, sub: int, rounds: int = STAR_ROUNDS,
          large: int = LARGE_ENTRY) -> DataFrame | None:
    """node, component for all nodes linked with another; ``nodes`` has node, n, keys."""
    entries = materialize(_table_entries(nodes, sub), "entries")
    sizes = materialize(entries.groupBy("key").agg(F.count("*").alias("size"),
                                                   F.min(F.struct("node", "n")).alias("lead")).where("size > 1"), "entry-sizes")
    members = materialize(entries.join(sizes.select("key", "size", F.col("lead.node").alias("y"), F.col("lead.n").alias("yn")),
                                       "key"), "members")
    involved = materialize(members.select("node").distinct(), "involved")
    sets = materialize(_sets(docs, words, id_filter.build(involved)), "sets")

    star = _pair(members.where("node <> y").select(F.col("node").alias("x"), F.col("n").alias("xn"), "y", "yn"), percent)
    done = materialize(star, "star")
    edges = materialize(_confirmed(done, sets, percent), "confirmed")
    if not edges.limit(1).count():
        labels = None
    else:
        labels = _merged(None, edges)

    def labelled(rows):
        if labels is None:
            return rows.withColumn("component", F.col("node"))
        at = labels.select(F.col("node").alias("at"), F.col("component").alias("found"))
        return rows.join(at, F.col("node") == F.col("at"), "left").select(
            *rows.columns, F.coalesce("found", "node").alias("component"))

    open_members = members.where("size > 2").select("key", "size", "node", "n")
    for turn in range(rounds + 1):
        # Entries whose nodes are in several components; only their other nodes are compared.
        now = materialize(labelled(open_members), "open")
        split = now.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                       F.min(F.struct(F.xxhash64("node", "key", F.lit(turn)), "node", "n", "component"))
                                       .alias("lead")).where("low <> high")
        split = materialize(split.select("key", F.col("lead.node").alias("y"), F.col("lead.n").alias("yn"),
                                         F.col("lead.component").alias("cy")), "split")
        if not split.limit(1).count():
            break
        open_members = now.join(split.select("key"), "key", "left_semi").drop("component")
        if turn < rounds:
            rows = now.join(split, "key").select("size", F.col("node").alias("x"), F.col("n").alias("xn"),
                                                 F.col("component").alias("cx"), "y", "yn", "cy")
            pairs = _pair(rows.where((F.col("size") > large) & (F.col("cx") != F.col("cy"))), percent)
        else:
            rest = now.join(split.select("key"), "key", "left_semi").select("node", "n", "component").distinct()
            pairs = _rest_pairs(rest, sets, percent)
        pairs = materialize(pairs.join(done, ["x", "y"], "left_anti"), "pairs")
        if pairs.limit(1).count():
            more = materialize(_confirmed(pairs, sets, percent), "confirmed")
            done = done.unionByName(pairs)
            if more.limit(1).count():
                labels = _merged(labels, more)
    return labels


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, sub: int = SUB, width: int = WIDTH,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    docs = docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text")
    signed = materialize(signatures(docs, words, sub, width), "signatures")
    usable = signed.where("doc_id is not null and set_id is not null")
    sets = materialize(usable.groupBy("set_id").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"),
                                                    F.first("keys").alias("keys")), "sets")
    labels = links(docs, sets.select("node", "n", "keys"), words, percent, sub)
    of_set = sets.select(F.col("set_id").alias("known"), "node")
    rows = signed.join(of_set, F.col("doc_id").isNotNull() & (F.col("set_id") == F.col("known")), "left")
    rows = rows.select("doc_id", "n_shingles", F.coalesce("node", "doc_id").alias("node"))
    if labels is not None:
        at = labels.select(F.col("node").alias("at"), F.col("component").alias("found"))
        rows = rows.join(at, F.col("node") == F.col("at"), "left").select(
            "doc_id", "n_shingles", F.coalesce("found", "node").alias("node"))
    return rows.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("component_id"),
                       (F.col("doc_id").isNull() | (F.col("doc_id") == F.col("node"))).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without those whose group has a smaller doc_id; of repeated rows one stays."""
    named = docs.where(docs["doc_id"].isNotNull())
    texts = named.select(F.col("doc_id").cast("long").alias("of_id"), F.xxhash64("text").alias("text_hash"))
    several = materialize(texts.groupBy("of_id").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
                          .where("low <> high").select("of_id"), "ids-of-several-texts")
    if several.limit(1).count():
        out = _keep_one_text(named, texts, **options)
    else:
        out = _keep_one_id(named, near_duplicates(docs, **options).where("doc_id is not null"))
    return out.unionByName(docs.where(docs["doc_id"].isNull()))


def _keep_one_id(named: DataFrame, marked: DataFrame) -> DataFrame:
    """``keep_one`` where an id has one text.

    Only rows whose id may have to go or is repeated are shuffled to the exact list of those ids; a filter of that list
    lets the others through where they lie.
    """
    special = materialize(marked.groupBy("doc_id").agg(F.bool_or("kept").alias("stays"), F.count("*").alias("rows_of_id"))
                          .where("not stays or rows_of_id > 1").select(F.col("doc_id").alias("special_id"), "stays"), "special")
    known = id_filter.build(special.select("special_id"))
    maybe = id_filter.matching(named, "doc_id", known)
    same = maybe["doc_id"].cast("long") == special["special_id"]
    again = maybe.join(special.where("stays"), same, "left_semi").dropDuplicates(["doc_id"])
    return (id_filter.matching(named, "doc_id", known, wanted=False)
            .unionByName(maybe.join(special, same, "left_anti")).unionByName(again))


def _keep_one_text(named: DataFrame, texts: DataFrame, **options) -> DataFrame:
    """``keep_one`` where ids repeat with different texts: each text of an id stands under a number of its own.

    The numbers follow doc_id, then the text's hash, so the smallest doc_id of a group stays.
    """
    numbered = materialize(global_positions(texts.distinct(), ["of_id", "text_hash"], "number"), "numbered-texts")
    same = (named["doc_id"].cast("long") == numbered["of_id"]) & (F.xxhash64(named["text"]) == numbered["text_hash"])
    each = named.join(numbered, same).select(F.col("number").alias("doc_id"), named["text"])
    marked = near_duplicates(each, **options).where("kept").select("doc_id").distinct()
    kept = materialize(numbered.join(marked, numbered["number"] == marked["doc_id"], "left_semi"), "kept")
    same = (named["doc_id"].cast("long") == kept["of_id"]) & (F.xxhash64(named["text"]) == kept["text_hash"])
    return named.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
