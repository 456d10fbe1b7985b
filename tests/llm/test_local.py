"""Per-text code of the operators against brute force (no Spark)."""

import io
import random
import zipfile

import numpy as np
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import bucket_digest, byte_bpe, decontamination, edit_counts, language_id, near_dedup, quality_ranking, warc_zip

RANKS, PATTERN = byte_bpe.default_tokenizer()
ENC = byte_bpe.encoding(RANKS, PATTERN)
TEXTS = st.text(alphabet=st.sampled_from("ab é'sl 1\n\t漢!x"), max_size=60)


@given(TEXTS, st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_pieces_encode_as_the_whole(text, size):
    assert byte_bpe.encode(ENC, text, size).tolist() == ENC.encode_ordinary(text)
    assert byte_bpe.decode(ENC, byte_bpe.encode(ENC, text, size)) == text.encode()


@given(TEXTS, st.lists(st.tuples(st.integers(0, 70), st.integers(0, 12), TEXTS), max_size=5))
@settings(max_examples=200, deadline=None)
def test_edited_counts_equal_full_counts(text, edits):
    split, counts = regex.compile(PATTERN), edit_counts.TokenCounts(ENC)
    tree = edit_counts.TokenTree(text, split, counts)
    assert tree.total == len(ENC.encode_ordinary(text))
    for start, length, new in edits:
        start = min(start, len(text))
        text = text[:start] + new + text[start + length:]
        tree.edit(start, length, new)
        assert tree.text == text
        assert tree.total == len(ENC.encode_ordinary(text))


def test_edits_of_a_long_text_touch_little():
    text = " ".join(f"word{i % 97} and{i % 13}" for i in range(20000))
    tree = edit_counts.TokenTree(text, regex.compile(PATTERN), edit_counts.TokenCounts(ENC))
    rng = random.Random(3)
    for _ in range(20):
        at = rng.randrange(len(text))
        text = text[:at] + " new words" + text[at + 7:]
        tree.edit(at, 7, " new words")
    assert tree.total == len(ENC.encode_ordinary(text)) and tree.reencoded < 20 * 60


def test_a_large_insertion_leaves_small_leaves():
    split, counts = regex.compile(PATTERN), edit_counts.TokenCounts(ENC)
    tree = edit_counts.TokenTree("start end", split, counts)
    tree.edit(5, 0, " ab1 cd2" * 50_000)
    assert max(len(leaf[1]) for leaf in tree._leaves) <= 2 * edit_counts.LEAF
    before = tree.reencoded
    tree.edit(200_000, 3, "xyz")
    assert tree.reencoded - before < 100
    text = tree.text
    for at in (0, 123_456, 399_000):
        tree.edit(at, 100_000, "")
        text = text[:at] + text[at + 100_000:]
    assert tree.text == text and tree.total == len(ENC.encode_ordinary(text)) and tree.chars == len(text)


@given(st.integers(0, 10**6), st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 900), TEXTS), max_size=6))
@settings(max_examples=60, deadline=None)
def test_edits_over_many_leaves_equal_full_counts(seed, edits):
    rng = random.Random(seed)
    text = "".join(rng.choice(["ab ", "  ", "\n", "x1", "'ll", "é!", " " * 40, "q" * 40]) for _ in range(600))
    tree = edit_counts.TokenTree(text, regex.compile(PATTERN), edit_counts.TokenCounts(ENC))
    for start, length, new in edits:
        start = min(start, len(text))
        text = text[:start] + new + text[start + length:]
        tree.edit(start, length, new)
        assert tree.text == text and tree.total == len(ENC.encode_ordinary(text))


@pytest.mark.parametrize("unit", [" ", "\n", "a", "7", "漢", "!", "\t "])
def test_runs_of_two_million_characters(unit):
    run = unit * (2_000_000 // len(unit))
    for text in (run, f"word {run}word", f"{run} x"):
        ids = byte_bpe.encode(ENC, text)
        assert byte_bpe.decode(ENC, ids) == text.encode()
        tree = edit_counts.TokenTree(text, regex.compile(PATTERN), edit_counts.TokenCounts(ENC))
        assert tree.total == len(ids)
    # The same ids as the library gives where its splitter still works.
    short = f"word {unit * 20_000}word"
    assert byte_bpe.encode(ENC, short, 100).tolist() == ENC.encode_ordinary(short)


def test_long_pieces_are_split_as_the_library_does(monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_PIECE", 10)
    rng = random.Random(8)
    for _ in range(300):
        text = "".join(rng.choice("ab é'sl 1\n\t漢!x") for _ in range(rng.randrange(200)))
        assert byte_bpe.encode(ENC, text, 50).tolist() == ENC.encode_ordinary(text)


def _zip(zip64):
    sink = io.BytesIO()
    close, sink.close = sink.close, lambda: None
    writer = warc_zip.PackageWriter(sink)
    records = [warc_zip.record_bytes(i, f"http://a/{i}?x=é\n", b"p" * i, "d", None, "response") for i in range(5)]
    for i, r in enumerate(records):
        writer.add(i, r)
    assert writer.close() == 5
    return sink.getvalue()


@pytest.mark.parametrize("zip64", [False, True])
def test_zip_directory_and_members(zip64, monkeypatch):
    if zip64:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 0)
    data = _zip(zip64)
    assert (b"PK\x06\x06" in data) is zip64
    members = warc_zip.directory(io.BytesIO(data), len(data))
    with zipfile.ZipFile(io.BytesIO(data)) as known:
        assert set(members) == set(known.namelist())
        for name in members:
            at, size = warc_zip.stored_member(io.BytesIO(data), members, name)
            assert data[at:at + size] == known.read(name)


def test_broken_and_compressed_packages_are_refused():
    sink = io.BytesIO()
    with zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/data.warc.gz", "x" * 100)
    members = warc_zip.directory(sink, len(sink.getvalue()))
    with pytest.raises(warc_zip.ZipFormatError):
        warc_zip.stored_member(sink, members, "archive/data.warc.gz")
    with pytest.raises(warc_zip.ZipFormatError):
        warc_zip.directory(io.BytesIO(b"no zip at all" * 5), 65)


def test_digest_of_equal_and_unlike_texts():
    a, b = b"the quick brown fox " * 30, b"0123456789" * 70
    assert bucket_digest.digest(a) == bucket_digest.digest(bytes(a))
    assert bucket_digest.likeness(bucket_digest.digest(a), bucket_digest.digest(a)) == 1.0
    assert 0 <= bucket_digest.likeness(bucket_digest.digest(a), bucket_digest.digest(b)) < 0.7
    assert bucket_digest.digest(b"") != bucket_digest.digest(b"xy")


def _digest_brute(data: bytes) -> bytes:
    """Windows, triplets, buckets and quartiles written out, one at a time."""
    counts = [0] * 128
    m = 0xFFFFFFFF
    for at in range(len(data) - 4):
        w = data[at:at + 5]
        for salt, (i, j) in enumerate([(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)]):
            h = (w[0] * 0x9E3779B1 & m) ^ (w[i] * 0x85EBCA6B & m) ^ (w[j] * 0xC2B2AE35 & m)
            h = (h + salt * 0x27D4EB2F) * 0x2C1B3C6D & m
            counts[h >> 25] += 1
    ordered = sorted(counts)
    cuts = ordered[31], ordered[63], ordered[95]
    codes = [sum(c > q for q in cuts) for c in counts]
    length, step = 0, 1.25
    while length < 255 and (len(data) + 1) >= step ** (length + 1) * (1 - 1e-12):
        length += 1
    return bytes([length]) + bytes(sum(codes[4 * k + i] << 2 * i for i in range(4)) for k in range(32))


def _difference_brute(a: bytes, b: bytes) -> int:
    total = min(48, 2 * abs(a[0] - b[0]))
    for x, y in zip(a[1:], b[1:], strict=True):
        total += sum((0, 1, 2, 6)[abs((x >> s & 3) - (y >> s & 3))] for s in (0, 2, 4, 6))
    return min(total, 300)


@pytest.mark.parametrize("size", [0, 1, 4, 5, 6, 40, 700, 5000])
def test_digests_and_scores_equal_brute_force(size):
    rng = random.Random(size)
    a, b = (bytes(rng.choice(b"abcdefgh \n\xc3\xa9") for _ in range(size + k)) for k in (0, 3))
    for x in (a, b):
        assert bucket_digest.digest(x) == _digest_brute(x)
    p, q = bucket_digest.digest(a), bucket_digest.digest(b)
    assert bucket_digest.difference(p, q) == _difference_brute(p, q)
    assert bucket_digest.likeness(p, q) == 1 - _difference_brute(p, q) / 300


def test_very_long_texts_have_the_digest_of_all_their_windows():
    data = np.random.default_rng(1).integers(0, 256, (1 << 20) + 5000).astype(np.uint8).tobytes()
    parts = sum((bucket_digest._counts(data[at:at + 70_004]) for at in range(0, len(data) - 4, 70_000)), np.zeros(128, np.int64))
    assert (bucket_digest._counts(data) == parts).all()


def test_segments_must_fit_their_packing():
    with pytest.raises(ValueError):
        decontamination.Index([(1, "x" * 600)], size=256)


def _edits(p, u):
    """Least edits of p against any passage of u."""
    row = [0] * (len(u) + 1)
    for i in range(1, len(p) + 1):
        new = [i] + [0] * len(u)
        for j in range(1, len(u) + 1):
            new[j] = min(row[j - 1] + (p[i - 1] != u[j - 1]), row[j] + 1, new[j - 1] + 1)
        row = new
    return min(row)


def test_decontamination_equals_brute_force():
    rng = random.Random(5)

    def prose(n):
        return " ".join(rng.choice(["the", "ing", "and", "tion", "re", "hath", "on"]) for _ in range(n))

    items = [(i, prose(rng.randrange(18, 60))) for i in range(6)]
    index = decontamination.Index(items)
    for trial in range(60):
        item, text = items[trial % 6]
        passage = list(text)
        for _ in range(rng.randrange(0, len(text) // 7)):
            at = rng.randrange(len(passage))
            passage[at:at + rng.randrange(2)] = rng.choice(["x", "", " q"])
        doc = prose(15) + " " + "".join(passage) + " " + prose(15)
        norm = decontamination.normalize(doc)
        found = {(m[0], m[1]): m for m in index.matches(doc)}
        for s, (owner, number, part) in enumerate(index.parts):
            least = _edits(part, norm)
            assert ((owner, number) in found) == (least <= index.edits[s]), (trial, owner, number, least)
            if (owner, number) in found:
                _, _, start, length, edits = found[(owner, number)]
                assert edits == least and _edits(part, norm[start:start + length]) == edits


def test_excerpts_are_found_wherever_they_start():
    rng = random.Random(8)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))

    item = prose(60)
    index = decontamination.Index([(1, item)])
    size = decontamination.SEGMENT + decontamination.SEGMENT // 3 - 1
    assert size == 79
    missed = [at for at in range(len(item) - size + 1)
              if not index.matches(prose(20) + " " + item[at:at + size] + " " + prose(20))]
    assert missed == [] and index.matches(prose(200)) == []


def test_decontamination_of_odd_texts():
    index = decontamination.Index([(1, "abc"), (2, ""), (3, "Some benchmark question with a long enough text in it")])
    assert index.matches(None) == [] and index.matches("") == []
    assert [m[0] for m in index.matches(" ABC ")] == [1]
    assert index.matches("xabcx") == []
    assert [m[0] for m in index.matches("x " * 50 + "some BENCHMARK question\nwith a long enough text in it")] == [3]


@given(TEXTS, st.integers(1, 6))
@settings(max_examples=150, deadline=None)
def test_shingle_sets(text, words):
    split = [w for w in regex.split(r"[\x20\x09-\x0D]+", text) if w]
    grams = {tuple(split[i:i + words]) for i in range(max(1, len(split) - words + 1))} if split else set()
    got = near_dedup.shingle_set(text.upper() if text.isascii() else text, words, near_dedup.WordHashes())
    assert len(got) == len(grams)


def test_language_features_and_models():
    assert language_id.features("123 !? \n") is None
    assert language_id.predict(language_id.fit(np.zeros((0, language_id.DIM), np.float32), []), ["abc", None]) == (
        ["und", "und"], [0.0, 0.0])
    only = language_id.fit(np.stack([language_id.features("hello")] * 2), ["en", "en"])
    assert language_id.predict(only, ["text", "12"]) == (["en", "und"], [1.0, 0.0])
    assert language_id.family_of("xx") == "own:xx"


def test_quality_without_both_labels():
    assert quality_ranking.fit(np.ones((3, 2)), np.array([1, 1, 1])) is None
    assert quality_ranking.score(None, ["a", None]).tolist() == [0.5, 0.5]
    assert np.isfinite(quality_ranking.features("")).all()
