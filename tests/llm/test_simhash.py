import random
import re

import numpy as np
import pytest
import xxhash

from remitflow.llm.queries import QUERIES
from remitflow.llm.simhash import fingerprint, near_duplicates, shingle_hashes

SF = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, radius=4):
    """rows: (doc_id, fp)."""
    root = {d: d for d, _ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for d, f in rows:
        for e, g in rows:
            if (f ^ g).bit_count() <= radius:
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d, _ in rows}


@pytest.mark.parametrize("text", ["", " ", "a", "A b", "a b c d", "É A\x1cb\xa0c D", "One two THREE four five six " * 200, "x\ty\x0bz\n" * 7])
def test_fingerprint(text):
    assert fingerprint(shingle_hashes(text)) == plain(text)


def test_spark_hash_is_the_same(spark):
    got = spark.sql("SELECT xxhash64('é word two') AS h").first().h
    assert np.uint64(got & (2**64 - 1)) == xxhash.xxh64_intdigest("é word two", 42)


def test_query_against_all_pairs(spark):
    got = QUERIES["op2_simhash_near_dedup"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    fps = [(d, plain(t)) for d, t in docs]
    assert {r.doc_id: r.fingerprint for r in got} == {d: f"{f:016x}" for d, f in fps}
    assert {r.doc_id: r.component_id for r in got} == plain_components(fps)
    assert len(got) == len(docs) and len({r.component_id for r in got}) < len(docs)


def test_chunked_tiles_lose_no_link(spark):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        words = [f"w{rng.randrange(1000)}" for _ in range(60)]
        for k in range(25):
            w = list(words)
            w[rng.randrange(60)] = f"v{k}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components([(d, plain(t)) for d, t in rows])
    for size in (3, 50, 32768):
        assert {r.doc_id: r.component_id for r in near_duplicates(df, tile_rows=size).collect()} == want


def test_odd_rows(spark):
    df = spark.createDataFrame([(7, None, 1, 2), (5, "", 1, 2), (None, "a b", 1, 2), (9, "a b", 1, 2), (9, "a b", 1, 2),
                                (8, "word " * 30000, 1, 2), (6, " \n", 1, 2)], "doc_id long, text string, fp int, tile int")
    got = sorted(((r.doc_id or 0, r.component_id) for r in near_duplicates(df).collect()))
    assert got == [(0, None), (5, 5), (6, 5), (7, 5), (8, 8), (9, 9), (9, 9)]
    assert near_duplicates(df.where("false")).count() == 0
