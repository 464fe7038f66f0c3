"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut before encoding where the split pattern begins a new match for certain, so no
call sees more than about ``LONG`` characters; ids decode to raw bytes, which need not end at a
character's border.
"""

from __future__ import annotations

import base64
import hashlib
import re

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantsilo.llm.common import plain_text, small_batches

#: Texts longer than this are encoded in pieces of about this many characters.
LONG = 1 << 16
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Between a character that is no white space and a space: whatever matches before such a place
#: ends there (no alternative of the pattern has white space after other characters), and the
#: next match begins with that space.  What follows it cannot change the matches before it.
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
_LOADED: dict[str, tiktoken.Encoding] = {}


def encoding(path: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    """The encoder of a rank file, loaded once in each Python worker."""
    if (path, pattern) not in _LOADED:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks,
                                                   special_tokens={})
    return _LOADED[path, pattern]


def pieces(text: str, size: int = LONG):
    """``text`` cut at safe places, each piece at least ``size`` long but the last.

    A text without safe places (one endless word or run of spaces) stays whole.
    """
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:]


def encode(enc: tiktoken.Encoding, text: str, size: int = LONG) -> list[int]:
    if len(text) <= size:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for p in pieces(text, size):
        ids += enc.encode_ordinary(p)
    return ids


def decode(enc: tiktoken.Encoding, ids: list[int]) -> bytes:
    """The raw bytes of any slice of ids; they need not be valid UTF-8."""
    return enc.decode_bytes(ids)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS) -> DataFrame:
    """``id_col`` and ids (array<int>) of every whole text; null and empty texts have no ids.

    One narrow pass over (id, text): nothing is shuffled, equal rows give equal results, other
    columns are ignored, an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoding(path)
        for b in batches:
            ids = [encode(enc, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    return (docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, ids array<int>").withColumnRenamed("id", id_col))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = RANKS) -> DataFrame:
    """Digests of every text's ids and of the bytes that they decode to, without moving the ids.

    Returns ``id_col``, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256.
    Cases are those of ``encode_texts``; an empty text has 0 tokens and the digests of no bytes.
    """
    small_batches(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoding(path)
        decimal = [b"%d" % i for i in range(enc.n_vocab)]
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in b.column(1).to_pylist():
                ids = encode(enc, t)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(b" ".join(map(decimal.__getitem__, ids))).hexdigest())
                text_sha.append(hashlib.sha256(decode(enc, ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col(id_col).alias("id"), plain_text(text_col).alias("t"))
            .mapInArrow(run, f"id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string")
            .withColumnRenamed("id", id_col))
