"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Long texts are cut at boundaries that no match of the split pattern can cross,
so pieces encode to the same ids as the whole text. A piece that stays long
(white space, letters or digits without end) is split by the ``regex`` module
and its matches are encoded one by one, since the library's own splitter fails
on matches of some hundred thousand characters. Decoding joins the raw bytes of
the ids.

Defined cases: a null text encodes as the empty text (no ids); repeated rows
give repeated results; very long texts, and runs of one kind of character in
them, encode as any other; an empty table gives an empty result; other columns
of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from riskflow.llm.common import ready_for_python

PIECE_CHARS = 1 << 16
LONG_PIECE = 1 << 17  # beyond it the library's splitter is not used

# A blank between two other characters that are no white space: no match of the
# pattern spans "non-space, blank", and what ends there needs no look at the rest.
_SAFE = regex.compile(r"(?<=\S) (?=\S)")
_split = cache(regex.compile)

SCHEMA = "doc_id long, n_tokens long, ids binary, decoded_sha256 string"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                    ("decoded_sha256", pa.string())])


@cache
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS):
    """Cut a text at safe boundaries, each piece at least ``size`` long where one exists."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:] if start else text


def encode(enc: tiktoken.Encoding, text: str, size: int = PIECE_CHARS) -> np.ndarray:
    parts = []
    for p in pieces(text, size):
        if len(p) <= LONG_PIECE:
            parts.append(np.array(enc.encode_ordinary(p), "<u4"))
        else:
            ids = chain.from_iterable(encode_match(enc, m.group()) for m in _split(enc._pat_str).finditer(p))
            parts.append(np.fromiter(ids, "<u4"))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def encode_match(enc: tiktoken.Encoding, match: str) -> list[int]:
    """The ids of one match of the split pattern."""
    return enc._encode_single_piece(match)


def decode(enc: tiktoken.Encoding, ids: np.ndarray) -> bytes:
    return enc.decode_bytes(ids.tolist())


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def tokenize(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the digest of the decoded bytes.

    ``rank_file`` must be readable at the same path on every executor (it is
    installed with the tokenizers package).
    """
    ready_for_python(docs.sparkSession)

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            counts, blobs, digests = [], [], []
            for text in batch.column(1).to_pylist():
                ids = encode(enc, text or "")
                counts.append(len(ids))
                blobs.append(ids.tobytes())
                digests.append(hashlib.sha256(decode(enc, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary()), pa.array(digests)],
                schema=_ARROW)

    return docs.selectExpr(f"cast(`{id_col}` as long) doc_id", f"`{text_col}` text").mapInArrow(run, SCHEMA)


def token_ids(docs: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """The rows of ``docs`` with their text replaced by token_ids (array of int) and n_tokens.

    Columns of these two names already present are replaced; the text column
    goes, as the ids decode to it byte by byte.
    """
    ready_for_python(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in ("text", "n_tokens", "token_ids")]

    def run(batches):
        enc = encoding(rank_file, pattern)
        for batch in batches:
            ids = [encode(enc, t or "") for t in batch.column(len(keep)).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
            flat = np.concatenate([*ids, np.array([], "<u4")]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))]
                + [pa.array(np.diff(offsets).astype(np.int64)),
                   pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=[*keep, "n_tokens", "token_ids"])

    kept = docs.select(*[docs[c] for c in keep])
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields]
                       + ["n_tokens long", "token_ids array<int>"])
    return docs.select(*[docs[c] for c in keep], docs["text"]).mapInArrow(run, schema)
