"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskflow.llm import spelling

DOCS = "doc_id long, text string"


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}
    near = {w: sorted((-n[v], v) for v in n if _near(w, v)) for w in n}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 2 * n[w] else None for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def _documents(seed, n=60):
    rng = random.Random(seed)
    letters = "abcéöÿ×Éß"
    vocabulary = ["".join(rng.choices(letters, k=rng.randint(4, 8))) for _ in range(25)] + ["aaaaa", "aaaaaa", "aaaaaaa", "aaaab"]

    def word():
        w = rng.choice(vocabulary[:1 + int(len(vocabulary) * rng.random() ** 2)])
        if rng.random() < 0.3:
            k = rng.randrange(len(w))
            w = w[:k] + rng.choice(["", rng.choice(letters), w[k] + rng.choice(letters)]) + w[k + 1:]
        return w.upper() if rng.random() < 0.1 else w

    return [(i, rng.choice([" ", "\n", "7", "-"]).join(word() for _ in range(rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 64])
def test_equals_brute_force(spark, filter_bytes):
    docs = _documents(1) + [(None, "without without without ithout"), (7, None), (8, ""), (9, "same words same words"), (9, "same words same words")]
    got = spelling.variants(spark.createDataFrame(docs, DOCS).repartition(3), filter_bytes=filter_bytes)
    assert sorted(((tuple(r)) for r in got.collect()), key=lambda r: r[0]) == _brute(docs)


def test_chains_are_followed_to_the_last_form(spark):
    docs = [(k, " ".join(["abcdea"] * 3 + ["abcde"] * 6 + ["abcdx"] * 12 + ["abcyx"] * 24 + ["abzyx"] * 48 + ["awzyx"] * 96)) for k in range(1)]
    got = spelling.variants(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == _brute(docs)
    assert {r["root"] for r in got} == {"awzyx"}


def test_hashes_of_edits_are_those_of_the_edited_words():
    rng = random.Random(2)
    words = ["".join(chr(rng.choice(spelling.LETTERS)) for _ in range(7)) for _ in range(20)]

    def known(w):
        return int((spelling._TABLE[spelling._codes([w], len(w))] * spelling._powers(len(w))).sum(1, dtype=np.uint64)[0])

    class Every(spelling.LengthFilters):
        def hits(self, hashes, length):
            self.seen.setdefault(length, []).extend(hashes.tolist())
            return np.arange(len(hashes))

    filters = Every({6: 1, 7: 1}, 1, 0)
    filters.seen = {}
    found = list(spelling.edits(words, 7, filters))
    assert [known(w) for _, w, shorter in found if shorter] == filters.seen[6]
    assert [known(w) for _, w, shorter in found if not shorter] == filters.seen[7]
    assert all(_near(words[i], w) for i, w, _ in found)


def test_very_long_texts_and_runs(spark):
    long_run = "ab" * 40_000
    docs = [(1, "spelling spelings " * 100_000), (2, " ".join([long_run] * 40 + [long_run[:-1]] * 3)), (3, "x" * (1 << 21))]
    got = {r["word"]: r for r in spelling.variants(spark.createDataFrame(docs, DOCS)).collect()}
    assert got["spelling"]["n"] + got["spelings"]["n"] == 200_000
    assert got[long_run[:-1]]["form"] == long_run and got[long_run[:-1]]["n_near"] == 1


def test_empty_tables_and_other_columns(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0
    docs = _documents(3, 10)
    clashing = spark.createDataFrame([(i, t, "w", 1, "r") for i, t in docs], DOCS + ", word string, n int, root string")
    assert sorted((tuple(r) for r in spelling.variants(clashing).collect()), key=lambda r: r[0]) == _brute(docs)
