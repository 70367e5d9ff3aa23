import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from remitflow.llm import alignment
from remitflow.llm.alignment import Aligner, aligned_links, alignment_digests, units
from remitflow.llm.incidence import Csr, product, product_in_blocks, product_size, token_bytes, transposed
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [None, "", "a", "a", " ", "  ", "x  y", " lead", "trail ", "a \nb\n c\n", "it's 12½ ΑΣ é ́ \x01 \x1c x\x1c y", "<|endoftext|> </s> <unk> <0x41> <s>",
       "▁ under", "good ▁x bad", "人人生而自由 𝒳 😀😀", "tab\there", "  nb sp 　 wide", "ab" * 300, "\t \t", "don't we'll I'M",
       "﻿bom ​zero \u0085 nel", "ﬁne ½ Å Å"]


@pytest.fixture(scope="module")
def own():
    return Aligner(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)


class Brute:
    """Whole texts through the libraries, byte by byte."""

    def __init__(self):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in visible}
        for b in range(256):
            if b not in visible:
                letters[chr(256 + len(letters) - len(visible))] = b
        self.letters = letters

    def tokens(self, text):
        if not text:
            return [], []
        a = [(t, bytes(self.letters[c] for c in self.a.id_to_token(t))) for t in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for t in self.b.encode(text):
            p = self.b.id_to_piece(t)
            b.append((t, bytes([int(p[3:5], 16)]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b) else ([], [])

    def rows(self, docs):
        read, held = [], Counter()
        for doc, text in docs:
            a, b = self.tokens(text)
            owners = [[k for k, (_, x) in enumerate(side) for _ in x] for side in (a, b)]
            links = [(a[i][0], b[j][0]) for i, j in sorted(set(zip(*owners)))]
            spans = []
            for side in (a, b):
                at = np.cumsum([0, *[len(x) for _, x in side]]).tolist()
                spans.append(list(zip(at, at[1:])))
            ends = sorted({y for _, y in spans[0]} & {y for _, y in spans[1]})
            group = {}
            for k, end in enumerate(ends):
                group.update(dict.fromkeys(range(ends[k - 1] if k else 0, end), k))
            groups = [[[], []] for _ in ends]
            for which, (side, s) in enumerate(zip((a, b), spans)):
                for (t, _), (x, _) in zip(side, s):
                    groups[group[x]][which].append(t)
            held.update(set(links))
            read.append((doc, len(a), len(b), groups, links))
        best = {}
        for (i, _), n in held.items():
            best[i] = max(best.get(i, 0), n)
        return [(doc, n, m, len(groups), len(links), sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links),
                 hashlib.sha256(";".join("|".join(",".join(map(str, side)) for side in g) for g in groups).encode()).hexdigest() if groups else "",
                 sum(len(p) * len(q) for p, q in groups)) for doc, n, m, groups, links in read]


def key(r):
    return (r[0] is None, r[0] or 0, *map(str, r[1:]))


def run(spark, rows, **more):
    df = spark.createDataFrame([(d, t, "c", 5) for d, t in rows], "doc_id long, text string, codes string, slice int").repartition(3)
    return sorted((tuple(r) for r in alignment_digests(df, **more).collect()), key=key)


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op11_cross_tokenizer_alignment"](spark, SF).collect()), key=key)
    docs = sorted(docs, key=lambda r: len(r[1] or ""))
    want = sorted(Brute().rows(docs), key=key)
    assert got == want and any(r[1] for r in got)


def test_odd_rows_in_many_blocks(spark, monkeypatch):
    rows = [(i if i else None, t) for i, t in enumerate(ODD)] + [(1, "a"), (2, "river stone river"), (2, "river stone river")]
    want = sorted(Brute().rows(rows), key=key)
    assert run(spark, rows) == want
    assert run(spark, rows, blocks=3, together=1) == want
    assert any(r[1] == 0 and t for r, t in zip(Brute().rows(rows), [t for _, t in rows]))  # a text that no side spells


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert alignment_digests(df.where("false")).collect() == []
    assert alignment_digests(df.where("false").unionByName(spark.createDataFrame([(1, None)], df.schema))).collect()[0].n_a == 0


def test_units_are_places_no_token_crosses(own):
    for t in [t for t in ODD if t] + ["one  two   three ", "x\n y", " \n z"]:
        parts = units(t)
        assert "".join(" " + u for u in parts) == " " + t
        found = own.tokens(t)
        if found is None:
            continue
        limits = np.cumsum([1 + len(u.encode()) for u in parts])
        a_ends, b_ends = own.ends(*found)
        assert np.isin(limits, a_ends).all() and np.isin(limits, b_ends).all()


def test_forgetting_changes_nothing(spark, monkeypatch):
    rows = [(i, f"word{i % 7} and stone {i}") for i in range(60)]
    want = sorted(Brute().rows(rows), key=key)
    monkeypatch.setattr(alignment, "_SLICE_BYTES", 40)
    monkeypatch.setattr(alignment, "KNOWN_UNITS", 3)
    own = Aligner(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    one = own.number([units(rows[0][1])])
    own.number([["other", "units", "come"]])
    assert len(own.number([units(rows[0][1])])[0]) == len(one[0]) and len(own.known) <= 7
    assert run(spark, rows) == want


def test_links_themselves(spark):
    df = spark.createDataFrame([(1, "unbelievable stones"), (2, None), (3, "▁")], "doc_id long, text string")
    rows = aligned_links(df).collect()
    assert {r.doc_id for r in rows} == {1}
    a, b = Brute().tokens("unbelievable stones")
    overlap = [r for r in rows if r.kind == "overlap"]
    assert sum(r.n_bytes for r in overlap) == len(" unbelievable stones")
    assert all((a[r.a_pos][0], b[r.b_pos][0]) == (r.a_id, r.b_id) for r in rows)
    assert {(r.a_pos, r.b_pos) for r in overlap} <= {(r.a_pos, r.b_pos) for r in rows if r.kind == "group"}


def test_products_equal_dense_ones():
    rng = np.random.default_rng(5)
    for _ in range(20):
        x, y = rng.random((rng.integers(1, 9), 7)) < 0.4, rng.random((7, rng.integers(1, 9))) < 0.4

        def csr(m):
            return Csr(np.concatenate(([0], np.cumsum(m.sum(axis=1)))), np.nonzero(m)[1], m.shape[1])

        def dense(m, values):
            out = np.zeros((m.rows, m.columns), dtype=int)
            out[np.repeat(np.arange(m.rows), np.diff(m.indptr)), m.indices] = values
            return out

        want = x.astype(int) @ y.astype(int)
        assert (dense(*product(csr(x), csr(y))) == want).all()
        t = transposed(csr(x))
        assert (dense(t, 1) == x.T).all() and product_size(csr(x), csr(y)).sum() == want.sum()
        for most in (1, 4):
            assert (np.concatenate([dense(m, v) for _, m, v in product_in_blocks(csr(x), csr(y), most)]) == want).all()
    assert token_bytes(np.array([2, 3])).indices.tolist() == [0, 1, 2]
