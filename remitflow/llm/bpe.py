"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A text is split by the tokenizer's pattern.  The distinct pieces of a slice of the corpus that a
worker has not met before are encoded together (``merge_replay``): an inverted index from token pair
to positions applies every merge in rank order.  Their ids are decoded again by the vocabulary.  A
text is then put together from its pieces, once as ids and once as decoded bytes, and hashed.

Null texts are empty: no ids, both hashes those of the empty string.  Every row gives one row.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, text_slices
from remitflow.llm.merge_replay import Merges, replay

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Pieces a worker remembers before it starts anew.
KNOWN_PIECES = 500_000
_SLICE_BYTES = 8 << 20


class ByteBpe:
    """Ids and decoded bytes of texts.  Per piece it keeps two byte strings, the ids in decimal, a
    space after each, and what they decode to; no containers, which would keep the collector busy."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.token = [b""] * (max(self.ranks.values()) + 1)
        for word, i in self.ranks.items():
            self.token[i] = word
        self._decimal = [b"%d " % i for i in range(len(self.token))]
        self._token_size, self._decimal_size = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (self.token, self._decimal))
        self._bytes = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self._merges = Merges.from_ranks(self.ranks)
        self._findall = regex.compile(pattern).findall
        self._ids: dict[str, bytes] = {}
        self._decoded: dict[str, bytes] = {}

    def _learn(self, pieces: list[str]) -> None:
        raw = [p.encode() for p in pieces]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ids, starts = replay(self._bytes[np.frombuffer(b"".join(raw), dtype=np.uint8)], np.concatenate(([0], np.cumsum(sizes))), self._merges)
        whole = np.fromiter(map(self.ranks.get, raw, repeat(-1)), dtype=np.int64, count=len(raw))
        for k in np.flatnonzero((whole >= 0) & (np.diff(starts) > 1)).tolist():  # a piece that is a token needs no merges
            ids[starts[k]] = whole[k]
            ids[starts[k] + 1:starts[k + 1]] = -1
        kept = np.concatenate(([0], np.cumsum(ids >= 0)))
        ids, starts = ids[ids >= 0], kept[starts]
        listed = ids.tolist()
        for known, table, size in ((self._ids, self._decimal, self._decimal_size), (self._decoded, self.token, self._token_size)):
            joined = b"".join(map(table.__getitem__, listed))
            cuts = np.concatenate(([0], np.cumsum(size[ids])))[starts].tolist()
            known.update(zip(pieces, map(joined.__getitem__, map(slice, cuts, cuts[1:]))))

    def encode_bytes(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """Per text: its ids in decimal, a space after each, and the bytes they decode to."""
        if len(self._ids) > KNOWN_PIECES:
            self._ids.clear()
            self._decoded.clear()
        split = [self._findall(t) for t in texts]
        found: set[str] = set()
        for pieces in split:
            found.update(pieces)
        if new := [p for p in found if p not in self._ids]:
            self._learn(new)
        ids, decoded = self._ids.__getitem__, self._decoded.__getitem__
        for pieces in split:
            yield b"".join(map(ids, pieces)), b"".join(map(decoded, pieces))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [list(map(int, ids.split())) for ids, _ in self.encode_bytes(texts)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)


def encoded_digests(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for part in text_slices(batches, "text", _SLICE_BYTES):
            counts, ids, decoded = [], [], []
            for a, b in bpe.encode_bytes(column_or_empty(part.column("text"))):
                counts.append(a.count(b" "))
                ids.append(hashlib.sha256(a[:-1]).hexdigest())
                decoded.append(hashlib.sha256(b).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                                             schema=schema)

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the ids themselves, for callers that want the tokens."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for part in text_slices(batches, "text", _SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(bpe.encode(column_or_empty(part.column("text"))), pa.list_(pa.int32()))], ["doc_id", "ids"])

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the bytes that ``ids`` stand for."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for part in batches:
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([bpe.decode(x or []) for x in part.column("ids").to_pylist()], pa.binary())], ["doc_id", "bytes"])

    return tokens.select("doc_id", "ids").mapInArrow(decode, "doc_id long, bytes binary")


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_digests(documents(spark, sf_dir))
