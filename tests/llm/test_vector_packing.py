import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from remitflow.llm import vector_packing
from remitflow.llm.queries import QUERIES
from remitflow.llm.vector_packing import Limits, Packer
from remitflow.llm.vector_packing import vector_packing as pack

SF = "/root/testdata/sf0.001"


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    return t


def ids_of(t, text):
    return t.encode(text or "", add_special_tokens=False).ids


def check(rows, wanted, limits, loss_from=None):
    """``wanted``: list of (doc_id, ids); rows of equal doc_id and ids may be mixed among each other."""
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, ids in wanted:
        at = 0
        for r in sorted(pieces[doc], key=lambda r: r.start):
            own = np.array(ids[r.start:r.start + r.length], dtype="<u4")
            assert (r.start, r.length, r.doc_tokens) == (at, len(own), len(ids)) and r.ids_crc32 == zlib.crc32(own.tobytes())
            if loss_from:
                assert r.loss_tokens == max(0, r.start + r.length - max(r.start, loss_from[doc]))
            at += r.length
        assert at == len(ids)
    assert len(pieces) == len(wanted)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == limits.tokens or at & (at - 1) == 0, "padding"
        assert at <= limits.tokens and len(parts) <= limits.segments and sum(r.loss_tokens for r in parts) <= limits.loss
    return len(sequences)


def test_query_matches_the_library_without_padding(spark):
    t = library()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    wanted = [(d, [*ids_of(t, text), 1]) for d, text in docs]
    got = QUERIES["op12_instruction_packing"](spark, SF).collect()
    n = check(got, wanted, Limits())
    assert n <= -(-sum(len(i) for _, i in wanted) // 2048) + 11
    assert sum(r.length < r.doc_tokens for r in got) < 3 * n  # few documents are cut


@pytest.mark.parametrize("limits", [Limits(64, 4, 40), Limits(64, 64, 9), Limits(100, 3, 100)])
def test_limits_with_prompts(spark, limits, monkeypatch):
    monkeypatch.setattr(vector_packing, "GROUP_SEQUENCES", 2)  # several turns
    t, rng = library(), random.Random(limits.loss)
    rows = [(i, " ".join(rng.choices("river stone maker 12 of the", k=rng.randint(0, 90))), rng.choice([None, "", "say it " * rng.randint(1, 40)])) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ask string").repartition(7)
    got = pack(df, limits=limits, prompt="ask").collect()
    heads = {i: len(ids_of(t, p)) for i, _, p in rows}
    wanted = [(i, [*ids_of(t, p), *ids_of(t, x), 1]) for i, x, p in rows]
    n = check(got, wanted, limits, heads)
    least = max(sum(len(i) for _, i in wanted) / limits.tokens, sum(len(i) - heads[d] for d, i in wanted) / limits.loss, 300 / limits.segments)
    assert n <= 1.8 * least + 12


def test_only_tiny_examples(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "IF(id % 2 = 0, 'a', NULL) AS text")
    limits = Limits(2048, 256, 2048)
    got = pack(df, limits=limits).collect()
    t = library()
    assert check(got, [(i, [*ids_of(t, "a" if i % 2 == 0 else ""), 1]) for i in range(5000)], limits) <= 45


def test_odd_rows(spark):
    texts = [None, "", "a", "a", "<|endoftext|>", "x\x1cy 'S it's 12½ ΑΣ é ́ \x01", "word " * 9000]
    df = spark.createDataFrame([(i if i else None, t, 9, 1, "q") for i, t in enumerate(texts)], "doc_id long, text string, length int, sequence_id int, ids string")
    t = library()
    check(pack(df).collect(), [(i if i else None, [*ids_of(t, x), 1]) for i, x in enumerate(texts)], Limits())
    assert pack(df.where("false")).collect() == []


def test_repeated_rows(spark):
    df = spark.createDataFrame([(7, "the same text again")] * 900, "doc_id long, text string")
    rows = pack(df).collect()
    n = len(ids_of(library(), "the same text again")) + 1
    assert sum(r.length for r in rows) == 900 * n
    held = defaultdict(int)
    for r in rows:
        held[r.sequence_id] += r.length
    assert all(x == 2048 or x & (x - 1) == 0 for x in held.values())


def test_heuristic_takes_the_greatest_product():
    p = Packer(Limits(10, 5, 4))
    for i, (n, loss_from) in enumerate([(6, 6), (6, 0), (4, 0), (3, 3)]):  # (6, 0), (6, 6), (4, 4), (3, 0) demands
        p.loss_from[i] = loss_from
        p.add(i, 0, n)
    first = next(p.sequences(True))
    # (6, 0) and (4, 4) fill both limits; (6, 6) never fits whole.
    assert sorted(first) == [(0, 0, 6), (2, 0, 4)]


def test_impossible_limits():
    p = Packer(Limits(8, 2, 0))
    p.loss_from[0] = 0
    p.add(0, 0, 3)
    with pytest.raises(ValueError):
        list(p.sequences(True))
