"""Cross-tokenizer alignment: which tokens of a byte-level vocabulary (A) and of a piece vocabulary (B) cover the
same bytes of a text.

Tokens x bytes matrices in compressed rows give the overlap links as the row products A . B'; bytes at which
tokens of both sides end cut the tokens into groups, and tokens x groups matrices give the links of tokens that
share a group (``incidence``).

A text, with a space before it, falls into units: each begins at a space that follows a visible character.  No
token of either side crosses such a place, so the products are made once for each distinct unit that a worker
meets and a text is put together from its units.

How many documents hold a pair of ids linked is counted over the whole corpus.  A slice of documents is written
as a sparse matrix of pairs x documents in blocks by A id.  The blocks' pair counts are added up by Spark; each
block then meets the counts of its own A ids, which hold the best partner of an id as well, and gives one number
for each document and measure; a slice's documents add up what their blocks give.  No count table is broadcast.

Rows: null and empty texts, and texts whose tokens of a side do not spell the text, have no tokens (zeros, empty
``groups_sha256``) and count for no pair.  Every row is a document of its own, equal ids and texts included.
Ties for the best partner all count.  Empty tables give no rows.  Very long texts are processed whole, a slice
each; one without any space is a single unit.  Columns beside ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, documents, stored, text_slices
from remitflow.llm.incidence import product, product_in_blocks, product_size, spread, token_bytes, token_groups, transposed

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
#: Blocks of A ids, and slices of documents that meet a block's counts in one task.
BLOCKS = 32
SLICES_TOGETHER = 128
_SLICE_BYTES = 8 << 20
#: A worker forgets its units beyond so many, or so many bytes of them.
KNOWN_UNITS = 300_000
KNOWN_BYTES = 24 << 20
#: Texts of these letters go through the quicker of two libraries.
_PLAIN_BELOW = "ɐ"
_AT_ONCE = 1 << 17  # bytes of units that go to the libraries in one text
_AFTER_SPACE = re.compile(r"\s ")
_UNIT = re.compile(r"(?<=\S)(?= )")


def _byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write for bytes: visible Latin-1 characters stand for
    themselves, the others for the letters from 256 on, in order."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def units(text: str) -> list[str]:
    """The units of a text that is not empty, without the space that each begins with."""
    if text[0] != " " and not _AFTER_SPACE.search(text):
        return text.split(" ")
    return [u[1:] for u in _UNIT.split(" " + text)]


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What two ascending arrays that end alike have in common."""
    return a[b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a]


class Aligner:
    """Units met so far: number of A tokens, B tokens, groups and shared-group links; linked id pairs; groups as text."""

    def __init__(self, byte_vocabulary: str, piece_vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(byte_vocabulary)
        self._a.encode_special_tokens = True  # their strings in a text are ordinary text
        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary)
        letters = _byte_letters()
        names = self._a.get_vocab()
        self._a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self._a_bytes[i] = bytes([letters[c] for c in name]) if all(c in letters for c in name) else name.encode()
        # A quicker library for the same vocabulary, whose ids are its merge ranks; for letters that both know alike.
        special = {t.content for t in self._a.get_added_tokens_decoder().values()}
        self._quick = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            self._a_bytes[i]: i for name, i in names.items() if name not in special})
        self.stride = self._b.get_piece_size()
        self._b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in ((i, self._b.id_to_piece(i)) for i in range(self.stride))]
        self._sizes = [np.array([len(x) for x in side], dtype=np.int64) for side in (self._a_bytes, self._b_bytes)]
        self._digits = [np.array([len(str(i)) for i in range(len(side))], dtype=np.int64) for side in (self._a_bytes, self._b_bytes)]
        self._written = [[b"%d%c" % (i, end) for i in range(max(len(self._a_bytes), self.stride))] for end in b",|;"]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.bad = np.zeros(0, dtype=bool)
        self.numbers = np.zeros((0, 4), dtype=np.int64)
        self.link_ptr = np.zeros(1, dtype=np.int64)
        self.links = np.zeros(0, dtype=np.int64)
        self.groups: list[bytes] = []
        self._held = 0

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides for a text (with the space before it); None where they do not spell it."""
        whole = " " + text
        if max(whole) < _PLAIN_BELOW:
            a = self._quick.encode_to_numpy(whole, disallowed_special=()).astype(np.int64)
        else:
            a = np.array(self._a.encode(whole, add_special_tokens=False).ids, dtype=np.int64)
        b = self._b.encode(text, num_threads=1) if text else [self._b.piece_to_id("▁")]  # a last space; the library adds none to ""
        raw = whole.encode()
        if self._sizes[0][a].sum() != len(raw) or b"".join(map(self._b_bytes.__getitem__, b)) != raw:  # A merges bytes: none is lost
            return None
        return a, np.array(b, dtype=np.int64)

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self._sizes[0][a]), np.cumsum(self._sizes[1][b])

    def number(self, found: list[list[str]]) -> list[list[int]]:
        """The units' numbers, learning those not met before."""
        if len(self.known) > KNOWN_UNITS or self._held > KNOWN_BYTES:
            self.forget()
        known = self.known
        new = [u for u in dict.fromkeys(chain.from_iterable(found)) if u not in known]
        self._learn(new)
        return [list(map(known.__getitem__, u)) for u in found]

    def _learn(self, new: list[str]) -> None:
        batch: list[str] = []
        learned, held = [], 0
        for u in new:
            if u and not u[-1].isspace():
                batch.append(u)
                held += len(u)
                if held > _AT_ONCE:
                    learned.append(self._aligned(batch))
                    batch, held = [], 0
            else:
                learned.append(self._aligned([u]))  # white space at its end would meet the next unit's space
        if batch:
            learned.append(self._aligned(batch))
        if learned:
            self.bad, self.numbers = (np.concatenate([own, *x]) for own, x in zip((self.bad, self.numbers), zip(*[p[:2] for p in learned])))
            self.link_ptr = np.concatenate((self.link_ptr, self.link_ptr[-1] + np.cumsum(np.concatenate([p[2] for p in learned]))))
            self.links = np.concatenate([self.links, *[p[3] for p in learned]])

    def _aligned(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """bad, numbers, links per unit, links of units that follow each other in one text."""
        for u in batch:
            self.known[u] = len(self.known)
            self._held += len(u)
        found = self.tokens(" ".join(batch))
        limits = np.cumsum([1 + len(u.encode()) for u in batch])
        if found is not None:
            a_ends, b_ends = self.ends(*found)
            cuts = common(a_ends, b_ends)
            if len(common(limits, cuts)) < len(limits):
                found = None
        if found is None:
            if len(batch) > 1:  # find out which unit it is
                for u in batch:
                    del self.known[u]
                parts = [self._aligned(half) for half in (batch[:len(batch) // 2], batch[len(batch) // 2:])]
                return tuple(np.concatenate(x) for x in zip(*parts))
            self.groups.append(b"")
            return np.array([True]), np.zeros((1, 4), dtype=np.int64), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)
        a, b = found
        overlap, _ = product(token_bytes(a_ends), transposed(token_bytes(b_ends)))
        a_groups, b_groups = token_groups(a_ends, cuts), token_groups(b_ends, cuts)
        in_a, in_b = (np.bincount(g.indices, minlength=len(cuts)) for g in (a_groups, b_groups))
        shared = product_size(a_groups, transposed(b_groups))  # shared-group links of each A token, counted only
        links = np.repeat(a, np.diff(overlap.indptr)) * self.stride + b[overlap.indices]

        def per_unit(ends: np.ndarray, values: np.ndarray) -> np.ndarray:
            total = np.concatenate(([0], np.cumsum(values)))[np.searchsorted(ends, limits, side="right")]
            return np.diff(np.concatenate(([0], total)))

        n_links = per_unit(a_ends, np.diff(overlap.indptr))
        numbers = np.stack([per_unit(a_ends, np.ones_like(a)), per_unit(b_ends, np.ones_like(b)), per_unit(cuts, np.ones_like(cuts)),
                            per_unit(a_ends, shared)], axis=1)
        self.groups.extend(self._group_texts(a, b, a_groups.indices, b_groups.indices, per_unit(cuts, in_a + in_b)))
        return np.zeros(len(batch), dtype=bool), numbers, n_links, links

    def _group_texts(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, per_unit: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each unit."""
        ids, group = np.concatenate((a, b)), np.concatenate((a_group, b_group))
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        ids, place = ids[order], (2 * group + side)[order]
        last = np.concatenate((place[1:] != place[:-1], [True]))
        end = np.where(last, 1 + place % 2, 0)
        written = self._written
        text = b"".join([written[e][i] for e, i in zip(end.tolist(), ids.tolist())])
        sizes = np.concatenate(([0], np.cumsum(1 + np.where(place % 2 == 0, self._digits[0][np.minimum(ids, len(self._digits[0]) - 1)],
                                                            self._digits[1][np.minimum(ids, self.stride - 1)]))))
        bounds = sizes[np.concatenate(([0], np.cumsum(per_unit)))].tolist()
        return [text[i:j - 1] for i, j in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def aligner(byte_vocabulary: str, piece_vocabulary: str) -> Aligner:
    return Aligner(byte_vocabulary, piece_vocabulary)


_NUMBERS = ("n_a", "n_b", "n_groups", "n_group_links", "n_links")
_SLICES = ("slice long, block int, codes binary, n_docs binary, docs binary, times binary, "
           "doc_ids array<long>, " + ", ".join(f"{n} array<long>" for n in _NUMBERS) + ", groups_sha256 array<string>")
_SLICE = pa.schema([("slice", pa.int64()), ("block", pa.int32()), ("codes", pa.binary()), ("n_docs", pa.binary()), ("docs", pa.binary()),
                    ("times", pa.binary()), ("doc_ids", pa.list_(pa.int64())), *[(n, pa.list_(pa.int64())) for n in _NUMBERS],
                    ("groups_sha256", pa.list_(pa.string()))])


def _sums(values: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros((1, *values.shape[1:]), dtype=np.int64), np.cumsum(values, axis=0)))
    return total[begins + sizes] - total[begins]


def _slice_rows(own: Aligner, number: int, doc_ids: list, texts: list[str | None], blocks: int) -> pa.RecordBatch:
    """The slice's documents (block -1) and its pairs x documents matrix by blocks."""
    numbered = own.number([units(t) if t else [] for t in texts])
    sizes = np.array([len(x) for x in numbered], dtype=np.int64)
    flat = np.fromiter(chain.from_iterable(numbered), dtype=np.int64, count=int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    fine = (sizes > 0) & (_sums(own.bad[flat].astype(np.int64), begins, sizes) == 0)
    links_of = np.diff(own.link_ptr)
    totals = _sums(np.concatenate((own.numbers[flat], links_of[flat][:, None]), axis=1), begins, sizes) * fine[:, None]
    hashes = [hashlib.sha256(b";".join(map(own.groups.__getitem__, x))).hexdigest() if f else "" for x, f in zip(numbered, fine.tolist())]
    head = (number, -1, None, None, None, None, doc_ids, *totals.T.tolist(), hashes)
    # Distinct (document, unit), then their links, summed by (block, pair, document).
    n = len(texts)
    doc = np.repeat(np.arange(n), sizes)
    kept = np.repeat(fine, sizes)
    key, times = np.unique(doc[kept] * max(len(own.groups), 1) + flat[kept], return_counts=True)
    unit, doc = key % max(len(own.groups), 1), key // max(len(own.groups), 1)
    at, fan = spread(own.link_ptr, unit)
    code = own.links[at]
    key = ((code // own.stride % blocks) << 32 | code) * n + np.repeat(doc, fan)
    order = np.argsort(key, kind="stable")
    key, times = key[order], np.repeat(times, fan)[order]
    rows = [head]
    if len(key):
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        times, key = np.add.reduceat(times, first), key[first]
        doc, pair = key % n, key // n
        starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        pair, held = pair[starts], np.diff(np.concatenate((starts, [len(key)])))
        block = pair >> 32
        lows = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        for i, j in zip(lows.tolist(), [*lows[1:].tolist(), len(pair)]):
            x, y = int(starts[i]), int(starts[j]) if j < len(starts) else len(key)
            rows.append((number, int(block[i]), (pair[i:j] & 0xFFFFFFFF).astype("<u4").tobytes(), held[i:j].astype("<u4").tobytes(),
                         doc[x:y].astype("<u4" if n > 1 << 16 else "<u2").tobytes(), times[x:y].astype("<u4").tobytes(), *[None] * 7))
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _SLICE)], schema=_SLICE)


def pair_slices(docs: DataFrame, byte_vocabulary: str, piece_vocabulary: str, blocks: int) -> DataFrame:
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_vocabulary, piece_vocabulary)
        number = TaskContext.get().partitionId() << 32
        for part in text_slices(batches, "text", _SLICE_BYTES):
            yield _slice_rows(own, number, part.column("doc_id").to_pylist(), part.column("text").to_pylist(), blocks)
            number += 1

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(align, _SLICES)


def pair_counts(slices: DataFrame) -> DataFrame:
    """block, code (A id x stride + B id), n: documents that hold the pair linked."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(parts: list[tuple]) -> tuple:
            block, code, n = (np.concatenate(x) for x in zip(*parts))
            code, at = np.unique(code, return_inverse=True)
            owner = np.zeros(len(code), dtype=np.int32)
            owner[at] = block
            return owner, code, np.bincount(at, weights=n, minlength=len(code)).astype(np.int64)

        parts: list[tuple] = []
        held = 0
        for batch in batches:
            for block, codes, n in zip(*(batch.column(c).to_pylist() for c in ("block", "codes", "n_docs"))):
                code = np.frombuffer(codes, dtype="<u4").astype(np.int64)
                parts.append((np.full(len(code), block, dtype=np.int32), code, np.frombuffer(n, dtype="<u4").astype(np.int64)))
                held += len(code)
                if held > 4_000_000:
                    parts = [packed(parts)]
                    if len(parts[0][0]) > 2_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts[0]], ["block", "code", "n"])
                        parts = []
                    held = sum(len(p[0]) for p in parts)
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in packed(parts)], ["block", "code", "n"])

    return slices.where("block >= 0").select("block", "codes", "n_docs").mapInArrow(add, "block int, code long, n long").groupBy(
        "block", "code").agg(F.sum("n").alias("n"))


def _block_scores(stride: int):
    def score(pairs: pa.Table, counts: pa.Table) -> pa.Table:
        """slice, best and total of each of its documents, from the links of one block of A ids."""
        code, n = (counts.column(c).to_numpy() for c in ("code", "n"))
        order = np.argsort(code)
        code, n = code[order], n[order]
        a = code // stride
        first = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else np.zeros(0, dtype=np.int64)
        most = np.repeat(np.maximum.reduceat(n, first), np.diff(np.concatenate((first, [len(a)])))) if len(a) else n
        rows = []
        for number, size, codes, held, doc, times in zip(*(pairs.column(c).to_pylist() for c in ("slice", "size", "codes", "n_docs", "docs", "times"))):
            at = np.searchsorted(code, np.frombuffer(codes, dtype="<u4"))
            held, times = np.frombuffer(held, dtype="<u4"), np.frombuffer(times, dtype="<u4").astype(np.int64)
            doc = np.frombuffer(doc, dtype="<u4" if size > 1 << 16 else "<u2")
            at = np.repeat(at, held)
            total = np.zeros(size, dtype=np.int64)
            best = np.zeros(size, dtype=np.int64)
            np.add.at(total, doc, times * n[at])
            np.add.at(best, doc, times * (n[at] == most[at]))
            rows.append((number, best.astype("<u4").tobytes(), total.astype("<i8").tobytes()))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), (pa.int64(), pa.binary(), pa.binary()))], names=["slice", "best", "total"])

    return score


def _documents(heads: pa.Table, scores: pa.Table) -> pa.Table:
    """The rows of one slice's documents, with the sums over its blocks."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]
    out = []
    for row in heads.to_pylist():
        best, total = np.zeros(len(row["doc_ids"]), dtype=np.int64), np.zeros(len(row["doc_ids"]), dtype=np.int64)
        for b, t in zip(scores.column("best").to_pylist(), scores.column("total").to_pylist()):
            best += np.frombuffer(b, dtype="<u4")
            total += np.frombuffer(t, dtype="<i8")
        out.append(pa.table([pa.array(row["doc_ids"], pa.int64()), *[pa.array(row[n], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")],
                             pa.array(best), pa.array(total), pa.array(row["groups_sha256"], pa.string()), pa.array(row["n_group_links"], pa.int64())], names=names))
    return pa.concat_tables(out) if out else pa.table([pa.array([], pa.string() if n == "groups_sha256" else pa.int64()) for n in names], names=names)


def alignment_digests(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY, blocks: int = BLOCKS,
                      together: int = SLICES_TOGETHER) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links of every row."""
    slices = stored(pair_slices(docs, byte_vocabulary, piece_vocabulary, blocks), "pair-slices")
    counts = stored(pair_counts(slices), "pair-counts")
    heads = slices.where("block < 0").select("slice", "doc_ids", *_NUMBERS, "groups_sha256")
    salts = max(1, -(-heads.count() // together))
    sizes = heads.select("slice", F.size("doc_ids").alias("size"))
    pairs = slices.where("block >= 0").select("slice", "block", "codes", "n_docs", "docs", "times").join(sizes, "slice")
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64("slice"), F.lit(salts)))
    counts = counts.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    stride = _pieces(piece_vocabulary)
    scores = pairs.groupBy("block", "salt").cogroup(counts.groupBy("block", "salt")).applyInArrow(
        _block_scores(stride), "slice long, best binary, total binary")
    return heads.groupBy("slice").cogroup(scores.groupBy("slice")).applyInArrow(
        _documents, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, n_group_links long")


def _pieces(piece_vocabulary: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_vocabulary).get_piece_size()


def text_links(own: Aligner, text: str | None) -> Iterator[tuple[str, np.ndarray, np.ndarray, np.ndarray]]:
    """(kind, A positions, B positions, bytes in common or 0) of one text: ``overlap`` first, then ``group``."""
    if not text or (found := own.tokens(text)) is None:
        return
    a_ends, b_ends = own.ends(*found)
    cuts = common(a_ends, b_ends)
    for kind, left, right in (("overlap", token_bytes(a_ends), transposed(token_bytes(b_ends))),
                              ("group", token_groups(a_ends, cuts), transposed(token_groups(b_ends, cuts)))):
        for begin, part, values in product_in_blocks(left, right):
            yield kind, begin + np.repeat(np.arange(part.rows), np.diff(part.indptr)), part.indices, values if kind == "overlap" else values * 0


def aligned_links(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_vocabulary: str = PIECE_VOCABULARY) -> DataFrame:
    """One row per link: doc_id, kind (``overlap`` or ``group``), a_pos, b_pos, a_id, b_id, n_bytes in common (0 for ``group``)."""
    names = ["doc_id", "kind", "a_pos", "b_pos", "a_id", "b_id", "n_bytes"]

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_vocabulary, piece_vocabulary)
        for part in batches:
            for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                a, b = (own.tokens(text) if text else None) or (None, None)
                for kind, i, j, n in text_links(own, text):
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(i), pa.int64()), pa.array([kind] * len(i)), *[
                        pa.array(x.astype(np.int64)) for x in (i, j, a[i], b[j], n)]], names)

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        link, "doc_id long, kind string, a_pos long, b_pos long, a_id long, b_id long, n_bytes long")


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_digests(documents(spark, sf_dir))
