r"""Spelling variant grouping: neighbourhoods guided by Bloom filters.

Words are maximal runs of letters with A-Z lower-cased, some with a planted
misspelling (``misspelt``). The vocabulary holds those that are long and
frequent enough. Two words are near if they differ by exactly one inserted,
deleted or replaced code point.

For each word its edits are generated as hashes only (deletions, and
replacements by a greater letter: each near pair is met from one side) and
probed against blocked Bloom filters, one shard per word length. Only edits
that some filter answers are spelled out and shuffled to an exact join with
the vocabulary, which removes the false positives; each pair met then counts
for both words.

The filters are broadcast. They take at most ``filter_bytes`` at once: a
larger vocabulary is filtered in several passes, each over the words of one
hash range, so the bound holds at every size and nothing is lost.

Hash of a word: the sum of table[letter] * R^place in 64 bits, so that the hash
of an edit follows from prefix sums without spelling it.

Defined cases: a null text has no words; rows without id count as id text '';
repeated rows count each; very long texts are read in pieces cut between runs;
a run of any length is one word (its edits are probed in slices of bounded
size); of near words of equal count the first in code-point order is the form;
an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import ready_for_python
from riskflow.session import materialize

LEAST_LENGTH, LEAST_COUNT = 5, 3
EDIT_SHARE = 97  # one run and document in so many is misspelt
FILTER_BYTES = 32 << 20
PROBES = 1 << 21  # edits probed at once
_PIECE = 1 << 20
_HELD = 200_000  # distinct words a task counts before it passes them on

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_BREAK = re.compile("[^A-Za-zÀ-ÿ]")
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Letters of a word, ascending.
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.int64)

_U = np.uint64
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_R_INVERSE = _U(pow(_R, -1, 1 << 64))
_BLOCK_WORDS, _BITS = 8, 6  # a block is 512 bits; bits set per word


def runs(text: str):
    """The maximal runs of letters, as found, in pieces of bounded size."""
    start = 0
    while len(text) - start > _PIECE:
        cut = _BREAK.search(text, start + _PIECE)
        if cut is None:
            break
        yield from _RUN.findall(text, start, cut.start())
        start = cut.start()
    yield from _RUN.findall(text, start)


def misspelt(doc_id: str, run: str) -> str:
    """The run, less one code point if its checksum with the id says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % EDIT_SHARE:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the vocabulary; tasks count before they shuffle."""
    ready_for_python(docs.sparkSession)

    def count(batches):
        found = Counter()

        def flush():
            words = list(found)
            out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([found[w] for w in words], pa.int64())],
                                             names=["word", "n"])
            found.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = Counter()
                for run, n in Counter(runs(text or "")).items():
                    own[run.lower() if run.isascii() else run.translate(_LOWER)] += n
                for run, n in own.items():
                    word = misspelt(doc_id or "", run)
                    if len(word) >= least_length:
                        found[word] += n
                if len(found) >= _HELD:
                    yield flush()
        if found:
            yield flush()

    rows = docs.select(docs[f"`{id_col}`"].cast("long").cast("string").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_TABLE = _mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


def _powers(n: int) -> np.ndarray:
    """R^0 .. R^(n-1) modulo 2^64."""
    out = np.full(n, _U(_R))
    out[:1] = 1
    return np.multiply.accumulate(out)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


class LengthFilters:
    """Blocked Bloom filters of one pass, one shard per word length, in one array of 512-bit blocks."""

    def __init__(self, counts: dict[int, int], passes: int, number: int):
        self.passes, self.number = passes, number
        self.shards, at = {}, 0
        for length in sorted(counts):
            # 16 bits a word; 32 for long ones, whose edits are many and dear to spell out.
            blocks = -(-(-(-counts[length] // passes)) * (16 if length <= 64 else 32) // 512)
            self.shards[length] = (at, blocks)
            at += blocks
        self.blocks = np.zeros((at, _BLOCK_WORDS), np.uint64)

    def places(self, hashes: np.ndarray, length: int):
        """(block of each hash, the mixed hash that gives its bits, whether this pass holds it)."""
        at, blocks = self.shards[length]
        mixed = _mix(hashes + _U(length))
        block = (mixed >> _U(32)) * _U(blocks) >> _U(32)
        return block.astype(np.int64) + at, _mix(mixed), (mixed & _U(0xFFFFFFFF)) % _U(self.passes) == self.number

    @staticmethod
    def bit(bits: np.ndarray, k: int):
        """(word of the block, mask) of the k-th bit."""
        nine = bits >> _U(9 * k) & _U(511)
        return (nine >> _U(6)).astype(np.int64), _U(1) << (nine & _U(63))

    def hits(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Indexes of the hashes that the shard of this length answers."""
        block, bits, mine = self.places(hashes, length)
        left = np.flatnonzero(mine)
        for k in range(_BITS):
            word, mask = self.bit(bits[left], k)
            left = left[self.blocks[block[left], word] & mask != 0]
        return left


def _by_length(words: list[str]):
    """(length, indexes of the words) for each length."""
    lengths = np.array([len(w) for w in words], np.int64)
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if len(part):
            yield int(lengths[part[0]]), part


def build_filters(vocabulary: DataFrame, counts: dict[int, int], passes: int, number: int) -> LengthFilters:
    """Fill the filters of a pass: tasks set bits of blocks, blocks are combined before they reach the driver."""
    empty = LengthFilters(counts, passes, number)
    names = ["block", *[f"w{i}" for i in range(_BLOCK_WORDS)]]

    def fill(batches):
        for batch in batches:
            words = batch.column(0).to_pylist()
            held = {}
            for length, part in _by_length(words):
                codes = _codes([words[i] for i in part], length)
                hashes = (_TABLE[codes] * _powers(length)).sum(1, dtype=np.uint64)
                block, bits, mine = empty.places(hashes, length)
                block, bits = block[mine], bits[mine]
                own, where = np.unique(block, return_inverse=True)
                rows = np.zeros((len(own), _BLOCK_WORDS), np.uint64)
                for k in range(_BITS):
                    word, mask = empty.bit(bits, k)
                    np.bitwise_or.at(rows, (where, word), mask)
                held[length] = own, rows
            if held:
                own = np.concatenate([o for o, _ in held.values()])
                rows = np.concatenate([r for _, r in held.values()]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), *[pa.array(rows[:, i]) for i in range(_BLOCK_WORDS)]], names=names)

    schema = ", ".join(f"{n} long" for n in names)
    blocks = (vocabulary.select("word").mapInArrow(fill, schema).groupBy("block")
              .agg(*[F.bit_or(n).alias(n) for n in names[1:]]).toArrow())  # at most filter_bytes
    at = blocks.column("block").to_numpy()
    for i, n in enumerate(names[1:]):
        empty.blocks[at, i] = blocks.column(n).to_numpy().view(np.uint64)
    return empty


def edits(words: list[str], length: int, filters: LengthFilters):
    """(index of the word, edited word, whether it is one letter shorter) of the edits that a filter answers."""
    codes = _codes(words, length)
    terms = _TABLE[codes] * _powers(length)
    ends = np.cumsum(terms, 1, dtype=np.uint64)
    whole = ends[:, -1:]
    if length - 1 in filters.shards:
        shorter = ends - terms + (whole - ends) * _R_INVERSE
        # Deleting either of two equal neighbours gives one word: the first counts.
        first = np.ones_like(codes, bool)
        first[:, 1:] = codes[:, 1:] != codes[:, :-1]
        at = np.flatnonzero(first.ravel())
        for k in at[filters.hits(shorter.ravel()[at], length - 1)].tolist():
            w, i = divmod(k, length)
            yield w, words[w][:i] + words[w][i + 1:], True
    powers = _powers(length)
    step = max(1, PROBES // (len(words) * len(LETTERS)))
    for low in range(0, length, step):
        part = codes[:, low:low + step]
        hashes = (whole - terms[:, low:low + step])[:, :, None] + _TABLE[LETTERS] * powers[low:low + step][None, :, None]
        at = np.flatnonzero((LETTERS > part[:, :, None]).ravel())
        for k in at[filters.hits(hashes.ravel()[at], length)].tolist():
            place, c = divmod(k, len(LETTERS))
            w, i = divmod(place, part.shape[1])
            yield w, words[w][:low + i] + chr(LETTERS[c]) + words[w][low + i + 1:], False


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n) of every near pair of the vocabulary, both ways, each once."""
    spark = vocabulary.sparkSession
    ready_for_python(spark)
    # A row per word length; only their counts pass the driver.
    counts = {r["length"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("length"))
              .agg(F.count("*").alias("n")).collect()}
    passes = max(1, -(-sum(n * (2 if length <= 64 else 4) for length, n in counts.items()) // filter_bytes))
    found = None
    for number in range(passes):
        shipped = spark.sparkContext.broadcast(build_filters(vocabulary, counts, passes, number))

        def probe(batches, shipped=shipped):
            filters = shipped.value
            for batch in batches:
                words, n = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for length, part in _by_length(words):
                    own = [words[i] for i in part]
                    size = max(1, PROBES // (length * len(LETTERS)))
                    for low in range(0, len(own), size):
                        out = [(own[low + w], n[part[low + w]], word) for w, word, _ in edits(own[low:low + size], length, filters)]
                        if out:
                            word, count, edit = zip(*out, strict=True)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(word), pa.array(count, pa.int64()), pa.array(edit)], names=["word", "n", "near"])

        probed = vocabulary.mapInArrow(probe, "word string, n long, near string")
        found = probed if found is None else found.unionByName(probed)
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return (found.join(exact, "near").select(F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))))
        .alias("p")).select("p.*"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Column root: from each word over its form to the last. Counts double from form to form, so steps are few.

    Each step doubles the way: a word's root becomes the root of its root.
    """
    rooted = materialize(forms.withColumn("root", F.coalesce("form", "word")), "spelling-forms")
    while True:
        onward = rooted.where(F.col("form").isNotNull()).select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = (rooted.where(F.col("form").isNotNull()).select("word", "root").join(onward, "root")
                 .select("word", F.col("next").alias("moved")))
        moved = materialize(moved, "spelling-steps")
        if moved.isEmpty():
            return rooted
        rooted = materialize(rooted.join(moved, "word", "left").withColumn("root", F.coalesce("moved", "root")).drop("moved"),
                             "spelling-roots")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
             least_count: int = LEAST_COUNT, ratio: int = 2, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary.

    The form is the near word of the largest count, if that is at least ``ratio`` times the word's own.
    """
    if ratio < 2:
        raise ValueError("counts must grow from form to form")
    vocabulary = materialize(word_counts(docs, id_col, text_col, least_length, least_count), "spelling-words")
    near = (near_pairs(vocabulary, filter_bytes).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")))
    has_form = -F.col("best.less") >= ratio * F.col("n")
    forms = vocabulary.join(near, "word", "left").select(
        "word", F.when(has_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(has_form, -F.col("best.less")).alias("form_n"))
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
