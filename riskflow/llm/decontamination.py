"""Benchmark decontamination: q-gram lemma filtering with banded verification.

Texts are normalized (lower case, runs of white space to one blank). Benchmark
items are cut into overlapping segments; a segment of m characters is found in
a document if some passage is within k = floor(m * budget) edits of it. By the
q-gram lemma such a passage shares at least m - q + 1 - k * q q-grams with the
segment, and their offsets lie within a band of k + 1 diagonals on either side.
The filter counts shared q-grams in overlapping diagonal bands, keeps the
bands that reach the bound, drops those whose region is out of reach by a
bit-parallel edit distance, and verifies the rest by banded alignment.

Segments begin every third of their length, so a verbatim excerpt of
``SEGMENT`` * 4 / 3 - 1 = 79 characters of an item holds a whole one and is found
wherever it starts; shorter excerpts are found if they hold one within its edits.

The benchmark is taken in blocks of at most ``block_segments`` segments, each
broadcast (that many segments of at most ``SEGMENT`` characters) for one pass
over the documents, so its size has no other bound.

Defined cases: null and empty texts match nothing; very long texts are searched
whole, one document at a time, in time that grows with the text and with the
passages that nearly match; an item shorter than q
characters once normalized matches only documents that equal it; an empty benchmark or table gives an empty
result; repeated items and repeated rows each give their own result rows;
other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import code_points, ready_for_python

Q = 7
BUDGET = 0.1
SEGMENT = 60
BLOCK_SEGMENTS = 5_000
_LEAD_BITS = 20
_MOST_CHARS = 1 << 8  # places in a segment are packed in eight bits

SCHEMA = "doc_id long, item_id long, segment int, start long, length int, edits int"


def normalize(text: str | None) -> str:
    return " ".join((text or "").split()).lower()


def segments(text: str, size: int = SEGMENT) -> list[str]:
    """Pieces of ``size`` characters, one every third of that; the last one ends with the text.

    Any passage of size + size // 3 - 1 characters holds a whole piece.
    """
    if len(text) <= size:
        return [text] if text else []
    starts = list(range(0, len(text) - size, size // 3)) + [len(text) - size]
    return [text[s:s + size] for s in starts]


def gram_hashes(u: np.ndarray, q: int) -> np.ndarray:
    n = len(u) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(q):
        h = h * np.uint64(0x9E3779B97F4A7C15) + u[k:k + n]
    h ^= h >> np.uint64(29)
    return h * np.uint64(0xBF58476D1CE4E5B9)


class Index:
    """The q-grams of a block of segments, sorted by hash, behind a bit table."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, budget: float = BUDGET, size: int = SEGMENT):
        if not 3 <= size < _MOST_CHARS:
            raise ValueError(f"a segment has 3 to {_MOST_CHARS - 1} characters")
        self.q = q
        self.parts = [(item, n, p) for item, text in items for n, p in enumerate(segments(text, size))]
        self.codes = [code_points(p).astype(np.int64) for _, _, p in self.parts]
        self.edits = np.array([int(len(c) * budget) for c in self.codes], np.int64)
        hashes = [gram_hashes(c.astype(np.uint64), q) for c in self.codes]
        # At least one shared q-gram is asked for: a smaller budget where the lemma's bound would vanish.
        for i, h in enumerate(hashes):
            self.edits[i] = max(0, min(self.edits[i], (len(h) - 1) // q))
        self.least = np.array([len(h) - e * q for h, e in zip(hashes, self.edits, strict=True)], np.int64)
        self.short = {}
        for i, h in enumerate(hashes):
            if not len(h):
                self.short.setdefault(self.parts[i][2], []).append(i)
        flat = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        self.hash, self.owner, self.place = flat[order], owner[order].astype(np.int64), place[order]
        # Where the hashes with each leading bit pattern begin.
        lead = (self.hash >> np.uint64(64 - _LEAD_BITS)).astype(np.int64)
        self.begin = np.searchsorted(lead, np.arange((1 << _LEAD_BITS) + 1)).astype(np.int32)
        self.masks = [self._char_masks(c) for c in self.codes]

    @staticmethod
    def _char_masks(codes: np.ndarray) -> dict[int, int]:
        masks: dict[int, int] = {}
        for i, c in enumerate(codes.tolist()):
            masks[c] = masks.get(c, 0) | 1 << i
        return masks

    def hits(self, u: np.ndarray):
        """(position in the text, segment, position in the segment) of every shared q-gram."""
        h = gram_hashes(u.astype(np.uint64), self.q)
        lead = (h >> np.uint64(64 - _LEAD_BITS)).astype(np.int64)
        lo, n = self.begin[lead], self.begin[lead + 1] - self.begin[lead]
        at = np.flatnonzero(n)
        lo, n = lo[at].astype(np.int64), n[at].astype(np.int64)
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        at = np.repeat(at, n)
        same = self.hash[entry] == h[at]
        return at[same], self.owner[entry[same]], self.place[entry[same]]

    def candidates(self, u: np.ndarray):
        """Bands that reach the lemma's bound: (segment, first diagonal, last diagonal).

        A segment's q-gram counts once in each half of a band, however often the text repeats it there.
        """
        at, owner, place = self.hits(u)
        enough = np.bincount(owner, minlength=len(self.parts))[owner] >= self.least[owner]
        at, owner, place = at[enough], owner[enough], place[enough]
        if not len(at):
            return []
        width = self.edits[owner] + 1  # two neighbouring halves make a band of 2k + 2 diagonals
        offset = _MOST_CHARS
        half = (at - place + offset) // width
        key = np.sort((owner << 32 | half) << 8 | place)
        key = key[np.concatenate([[True], key[1:] != key[:-1]])] >> 8
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        keys, count = key[first], np.diff(np.append(first, len(key)))
        nxt = np.minimum(np.searchsorted(keys, keys + 1), len(keys) - 1)
        both = count + np.where(keys[nxt] == keys + 1, count[nxt], 0)
        found = []
        for i in np.flatnonzero(both >= self.least[keys >> 32]):
            s, k = int(keys[i] >> 32), int(self.edits[keys[i] >> 32])
            first = int(keys[i] & 0xFFFFFFFF) * (k + 1) - offset
            found.append((s, first, first + 2 * (k + 1) - 1))
        return found

    def reachable(self, text: str, segment: int, first: int, last: int) -> bool:
        """Whether some passage of the band's region is within the budget, by bit-parallel edit distance."""
        k, m = int(self.edits[segment]), len(self.codes[segment])
        masks, top, full = self.masks[segment], 1 << m - 1, (1 << m) - 1
        plus, minus, cost = full, 0, m
        for c in map(ord, text[max(0, first - k):max(0, last + m + 2 * k)]):
            eq = masks.get(c, 0)
            x = (((eq & plus) + plus) ^ plus) | eq | minus
            up, down = minus | ~(x | plus) & full, plus & x
            cost += bool(up & top) - bool(down & top)
            if cost <= k:
                return True
            up, down = up << 1 & full, down << 1 & full
            plus, minus = down | ~(x | up) & full, up & x
        return False

    def align(self, u: np.ndarray, segment: int, first: int, last: int) -> tuple[int, int, int] | None:
        """Banded alignment of a segment with the passages on diagonals first..last, k more on each side.

        Returns (edits, start, length) of the best passage within the budget.
        Cell c of row i stands for text position i + lo + c.
        """
        p, k = self.codes[segment], int(self.edits[segment])
        lo, hi = first - k, last + k
        width = hi - lo + 1
        far = len(p) + 1
        cells = np.arange(width)
        start = lo + cells
        cost = np.where((start >= 0) & (start <= len(u)), 0, far)
        for i in range(1, len(p) + 1):
            pos = i + lo + cells  # text characters consumed after this row
            inside = (pos >= 1) & (pos <= len(u))
            match = np.zeros(width, bool)
            match[inside] = u[pos[inside] - 1] == p[i - 1]
            step = np.where(inside, cost + ~match, far)
            skip = np.full(width, far)
            skip[:-1] = cost[1:] + 1
            take_skip = skip < step
            best = np.where(take_skip, skip, step)
            origin = start.copy()
            origin[:-1] = np.where(take_skip[:-1], start[1:], start[:-1])
            # Text characters left out of the segment: a running minimum along the row.
            lifted = best - cells
            run = np.minimum.accumulate(lifted)
            source = np.maximum.accumulate(np.where(lifted == run, cells, 0))
            cost = np.minimum(run + cells, far)
            start = origin[source]
            cost = np.where((pos >= 0) & (pos <= len(u)), cost, far)
        c = int(cost.argmin())
        if cost[c] > k:
            return None
        end = len(p) + lo + c
        return int(cost[c]), int(start[c]), int(end - start[c])

    def matches(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item, segment number, start, length, edits) of each segment found, best passage each."""
        norm = normalize(text)
        if not norm:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        for s in self.short.get(norm, []):
            best[s] = (0, 0, len(norm))
        u = code_points(norm).astype(np.int64)
        for s, first, last in self.candidates(u):
            if s in best and best[s][0] == 0:
                continue
            part = self.parts[s][2]
            exact = norm.find(part, max(0, first), max(0, last + len(part)))  # an alignment without edits
            if exact >= 0:
                got = (0, exact, len(part))
            else:
                got = self.align(u, s, first, last) if self.reachable(norm, s, first, last) else None
            if got and (s not in best or got < best[s]):
                best[s] = got
        return [(self.parts[s][0], self.parts[s][1], start, length, edits)
                for s, (edits, start, length) in sorted(best.items())]


def _blocks(benchmark: DataFrame, block_segments: int, size: int):
    """The benchmark in blocks of bounded size, in the order (item_id, text)."""
    block, n = [], 0
    rows = benchmark.selectExpr("cast(item_id as long) item_id", "text").where("text is not null")
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        text = normalize(row["text"])
        block.append((row["item_id"], text))
        n += len(text) // (size // 3) + 1
        if n >= block_segments:
            yield block
            block, n = [], 0
    if block:
        yield block


def leaks(docs: DataFrame, benchmark: DataFrame, q: int = Q, budget: float = BUDGET, size: int = SEGMENT,
          block_segments: int = BLOCK_SEGMENTS) -> DataFrame:
    """One row per document and benchmark segment found in it (see SCHEMA)."""
    spark = docs.sparkSession
    ready_for_python(spark)
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    out = None
    for block in _blocks(benchmark, block_segments, size):
        shared = spark.sparkContext.broadcast(Index(block, q, budget, size))
        found = rows.mapInArrow(_finder(shared), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def _finder(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("segment", pa.int32()),
                        ("start", pa.int64()), ("length", pa.int32()), ("edits", pa.int32())])

    def run(batches):
        for batch in batches:
            out = [(doc_id, *m) for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                   for m in shared.value.matches(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark segment is found, with all their columns."""
    spark = docs.sparkSession
    ready_for_python(spark)
    at = docs.columns.index(text_col)
    opts = {"q": Q, "budget": BUDGET, "size": SEGMENT, "block_segments": BLOCK_SEGMENTS} | options
    for block in _blocks(benchmark, opts["block_segments"], opts["size"]):
        shared = spark.sparkContext.broadcast(Index(block, opts["q"], opts["budget"], opts["size"]))

        def run(batches, shared=shared):
            for batch in batches:
                clean = [not shared.value.matches(t) for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def summarize(found: DataFrame) -> DataFrame:
    """Segments per document and item: doc_id, item_id, n_segments, first_start and the fewest edits."""
    return found.groupBy("doc_id", "item_id").agg(
        F.countDistinct("segment").alias("n_segments"), F.min("start").alias("first_start"),
        F.min("edits").alias("least_edits"))
