"""Byte-level BPE encoding and decoding with tiktoken and a local rank file.

The encoder is loaded once per Python worker. Long texts are cut at safe boundaries first, so that no call sees
more than ``PIECE_CHARS`` characters unless a text has no boundary: before white space that follows another
character, and between letters and digits. No match of the split pattern crosses such a place and no look-ahead
sees past it, so the ids of the parts are the ids of the whole.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty

PIECE_CHARS = 65_536
#: White space of Unicode, as the split pattern's \s has it.
SPACE = "\t-\r \x85\xa0  -     　"
_SAFE = regex.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])|(?<=\p{{L}})(?=\p{{N}})|(?<=\p{{N}})(?=\p{{L}})")
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def safe_pieces(text: str, size: int = PIECE_CHARS) -> list[str]:
    """``text`` cut into parts of about ``size`` characters at safe boundaries; one part if it is short."""
    if len(text) <= size:
        return [text]
    parts, start = [], 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if not cut:
            break
        parts.append(text[start : cut.start()])
        start = cut.start()
    return [*parts, text[start:]]


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(enc, text: str) -> list[int]:
    """The ids of a whole text, without special tokens."""
    pieces = safe_pieces(text)
    if len(pieces) == 1:
        return enc.encode_ordinary(text)
    return [i for piece in pieces for i in enc.encode_ordinary(piece)]


def encode_documents(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ids (array of int) of every row; null texts count as empty and have no ids."""

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            ids = [encode(enc, t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text_or_empty(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode_documents(df: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the raw bytes that the ids stand for; null counts as no ids."""

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], [key, "raw"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, ids).mapInArrow(run, f"`{key}` {kind}, raw binary")


def digests(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode and digest every row in one pass, so that ids never travel: SCHEMA.

    Null and empty texts have no ids and the digests of no bytes. Rows that repeat are repeated; other columns are
    not read. Memory is bounded by one Arrow batch and one text's ids.
    """

    def run(batches):
        enc = encoding(path, pattern)
        for batch in batches:
            counts, ids_hex, raw_hex = [], [], []
            for value in batch.column(1):
                ids = encode(enc, value.as_py())
                counts.append(len(ids))
                ids_hex.append(hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest())
                raw_hex.append(hashlib.sha256(enc.decode_bytes(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(raw_hex, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(run, SCHEMA)
