"""Edit-aware token counts: segment trees over pre-tokens.

A text is split into pre-tokens; their character and token counts lie in the
leaves (runs of pre-tokens) of a segment tree whose inner nodes hold sums. An
edit re-splits and re-encodes only from the pre-token that holds the last
characters before it to the first boundary behind it at which the old split
continues, and renews the sums above the touched leaves.

Defined cases: a null text counts as empty; null edits, and null elements among
them, are no edits; a null start or length is 0, and an edit with a null
replacement deletes; spans are clipped to the text; edits of a document apply
one after the other, each in the coordinates of the text so far; a run of one
kind of character is one pre-token whatever its length; repeated rows give
repeated results; an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskflow.llm.byte_bpe import encode_match, encoding
from riskflow.llm.common import ready_for_python

LEAF = 128
# The pattern looks at most two characters behind the end of a match ('ll, white space).
CONTEXT = 3
_CACHE = 200_000

SCHEMA = "doc_id long, n_tokens long, n_edits int, edited_tokens long, edited_chars long, reencoded_chars long"


class TokenCounts(dict):
    """Tokens per pre-token, remembered for the frequent ones."""

    def __init__(self, enc):
        super().__init__()
        self._enc = enc

    def __missing__(self, piece: str) -> int:
        n = len(encode_match(self._enc, piece))
        if len(piece) <= 64:
            if len(self) >= _CACHE:
                self.clear()
            self[piece] = n
        return n


class TokenTree:
    """Token count of one text that is kept up to date under edits.

    A leaf holds its stretch of text, and the characters and tokens of each of
    its pre-tokens. An edit reads the leaves it touches; a leaf that grows
    beyond twice LEAF pre-tokens is cut into several.
    """

    def __init__(self, text: str, split: regex.Pattern, counts: TokenCounts):
        self._split, self._counts = split, counts
        pieces = split.findall(text)
        self._leaves = self._cut(pieces, [len(p) for p in pieces], [counts[p] for p in pieces]) or [("", [], [])]
        self._build()
        self.reencoded = 0

    @staticmethod
    def _cut(pieces: list[str], sizes: list[int], tokens: list[int]) -> list[tuple]:
        return [("".join(pieces[i:i + LEAF]), sizes[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(pieces), LEAF)]

    def _build(self) -> None:
        """The inner nodes over the leaves as they are."""
        self._width = 1 << (len(self._leaves) - 1).bit_length()
        self._chars, self._tokens = [0] * (2 * self._width), [0] * (2 * self._width)
        for i, (text, _, tokens) in enumerate(self._leaves):
            self._chars[self._width + i], self._tokens[self._width + i] = len(text), sum(tokens)
        for node in range(self._width - 1, 0, -1):
            self._sum(node)

    @property
    def total(self) -> int:
        return self._tokens[1]

    @property
    def chars(self) -> int:
        return self._chars[1]

    @property
    def text(self) -> str:
        return "".join(leaf[0] for leaf in self._leaves)

    def _sum(self, node: int) -> None:
        self._chars[node] = self._chars[2 * node] + self._chars[2 * node + 1]
        self._tokens[node] = self._tokens[2 * node] + self._tokens[2 * node + 1]

    def _replace(self, first: int, last: int, pieces: list[str], sizes: list[int], tokens: list[int]) -> None:
        """These pre-tokens in place of the leaves first to last."""
        if first == last and len(pieces) <= 2 * LEAF:
            self._leaves[first] = ("".join(pieces), sizes, tokens)
            node = self._width + first
            self._chars[node], self._tokens[node] = len(self._leaves[first][0]), sum(tokens)
            while node > 1:
                node //= 2
                self._sum(node)
        else:
            self._leaves[first:last + 1] = self._cut(pieces, sizes, tokens)
            self._leaves = self._leaves or [("", [], [])]
            self._build()

    def _locate(self, position: int) -> tuple[int, int]:
        """(leaf, its start) that holds a position, the last leaf for the end."""
        node, start = 1, 0
        while node < self._width:
            node *= 2
            if position - start >= self._chars[node] and self._chars[node + 1]:
                start += self._chars[node]
                node += 1
        return min(node - self._width, len(self._leaves) - 1), start

    def edit(self, start: int, length: int, replacement: str) -> None:
        start = max(0, min(start, self.chars))
        end = min(self.chars, start + max(0, length))
        shift = len(replacement) - (end - start)
        first, base = self._locate(max(0, start - CONTEXT))
        last, _ = self._locate(end)
        # From the leaf's pre-token that holds the characters before the edit; all places below count from the leaf's start.
        kept, at = 0, 0
        for size in self._leaves[first][1][:-1]:
            if base + at + size > max(0, start - CONTEXT):
                break
            kept, at = kept + 1, at + size
        new, done = [], at  # pre-tokens found anew, and where they end
        while True:
            old = "".join(leaf[0] for leaf in self._leaves[first:last + 1])
            window = old[:start - base] + replacement + old[end - base:]
            whole = last == len(self._leaves) - 1
            ends = set(accumulate(chain.from_iterable(leaf[1] for leaf in self._leaves[first:last + 1])))
            behind = start - base + len(replacement)
            met = False
            for match in self._split.finditer(window, done):
                if done >= behind and done - shift >= end - base and done - shift in ends:
                    met = True
                    break
                if not whole and match.end() > len(window) - CONTEXT:
                    break  # the match might go on behind the window
                new.append(match.group())
                done = match.end()
            if met or whole:
                break
            if done >= behind and done - shift >= end - base and done - shift in ends:
                met = True
                break
            last = min(len(self._leaves) - 1, last + (last - first + 1))
        self.reencoded += done - at
        head, sizes, tokens = self._leaves[first]
        pieces = _pieces(head, sizes)[:kept] + new
        sizes, tokens = sizes[:kept] + [len(p) for p in new], tokens[:kept] + [self._counts[p] for p in new]
        reached = 0
        if met:  # the old split goes on from here
            for leaf in range(first, last + 1):
                text, leaf_sizes, leaf_tokens = self._leaves[leaf]
                if reached + len(text) > done - shift:
                    k = next(i for i, e in enumerate(accumulate(leaf_sizes, initial=reached)) if e == done - shift)
                    pieces += _pieces(text, leaf_sizes)[k:]
                    sizes, tokens = sizes + leaf_sizes[k:], tokens + leaf_tokens[k:]
                    last = leaf
                    break
                reached += len(text)
        self._replace(first, last, pieces, sizes, tokens)


def _pieces(text: str, sizes: list[int]) -> list[str]:
    return [text[e - n:e] for n, e in zip(sizes, accumulate(sizes), strict=True)]


def count_edited(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """Token counts before and after the edits of each row of (doc_id, text, edits); see SCHEMA.

    ``edits`` is an array of structs (start, length, replacement) in code points.
    """
    ready_for_python(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_edits", pa.int32()),
                        ("edited_tokens", pa.int64()), ("edited_chars", pa.int64()), ("reencoded_chars", pa.int64())])

    def run(batches):
        split, counts = regex.compile(pattern), TokenCounts(encoding(rank_file, pattern))
        for batch in batches:
            out = []
            for doc_id, text, edits in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tree = TokenTree(text or "", split, counts)
                before = tree.total
                edits = [e for e in edits or [] if e is not None]
                for e in edits:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
                out.append((doc_id, before, len(edits), tree.total, tree.chars, tree.reencoded))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)],
                                             schema=schema)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text", "edits").mapInArrow(run, SCHEMA)
