import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from remitflow.llm.bpe import VOCABULARY, byte_bpe, decoded, encoded, encoded_digests
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def sha(x):
    return hashlib.sha256(x).hexdigest()


ODD = ["", " ", "  a", "a  ", "\n\n  b\t c", "x\x1cy \x1d", "it's 'S don't", "aaaaaaaaaaaaaaaaaaaaaaa", "xyxyxyxyxy", "½ 12 ³ é é",
       "日本語 テスト 🙂🙂", "<|endoftext|>", "a b　c d", "==== ----- !!!!!!!!!!", "\r\n\r\n x", "ababababab " * 300, "z" * 5000]


def test_ids_as_the_library(library):
    bpe = byte_bpe(VOCABULARY)
    texts = ODD + ["".join(chr(33 + (i * k) % 90) + (" " if i % 7 == 0 else "") for i in range(400)) for k in range(1, 30)]
    got = bpe.encode(texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    assert [bpe.decode(x) for x in got] == [t.encode() for t in texts]


def test_query_on_whole_texts(spark, library):
    got = {r.doc_id: r for r in QUERIES["op6_byte_level_bpe"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d, text in docs:
        ids = library.encode_ordinary(text or "")
        assert (got[d].n_tokens, got[d].ids_sha256, got[d].decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids)).encode()), sha((text or "").encode()))


def test_odd_rows_and_round_trip(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, None, "n"), (None, "a b", "n"), *[(10 + i, t, "n") for i, t in enumerate(ODD)]],
                               "doc_id long, text string, ids string")
    rows = encoded_digests(df).collect()
    assert len(rows) == len(ODD) + 3
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows[:2]] == [(0, sha(b""), sha(b""))] * 2
    back = {r.doc_id: bytes(r.bytes) for r in decoded(encoded(df)).collect()}
    assert all(back[10 + i] == t.encode() for i, t in enumerate(ODD))
    assert encoded_digests(df.where("false")).count() == 0
