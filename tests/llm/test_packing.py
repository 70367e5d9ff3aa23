import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from remitflow.llm.packing import best_fit_packing, pack, packing_plan
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_rank_once_and_tightly(seed):
    rng = random.Random(seed)
    capacity = 60
    histogram = {n: rng.randint(1, 40) for n in rng.sample(range(1, capacity + 1), rng.randint(1, 50))}
    rows = []
    for s in packing_plan(histogram, capacity):
        for r in range(s.rank_from, s.rank_to):
            rows.append({"sequence_id": s.first + (r - s.rank_from) // s.per, "length": s.length, "rank": r,
                         "offset": s.offset + (r - s.rank_from) % s.per * s.length})
    assert sorted((r["length"], r["rank"]) for r in rows) == sorted((n, r) for n, c in histogram.items() for r in range(c))
    bins = check(rows, capacity)
    # Plain best-fit decreasing, piece by piece, is the yardstick.
    rooms = []
    for n in sorted((n for n, c in histogram.items() for _ in range(c)), reverse=True):
        fits = [i for i, g in enumerate(rooms) if g >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(capacity - n)
    least = -(-sum(n * c for n, c in histogram.items()) // capacity)
    assert bins <= max(len(rooms), least + 1) + 1


def test_query_matches_the_library_on_whole_texts(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    got = QUERIES["op8_best_fit_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d, text in docs:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k in range(0, len(ids), 2048):
            part = ids[k:k + 2048]
            want[d, k // 2048] = (k, len(part), zlib.crc32(part.tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    assert len(got) == len(want)
    total = sum(r.length for r in got)
    assert check([r.asDict() for r in got], 2048) <= -(-total // 2048) * 1.02 + 1


def test_odd_rows(spark):
    texts = [None, "", "a", "a", "<|endoftext|>", "x\x1cy 'S it's 12½ ΑΣ é ́ \x01", "word " * 5000]
    df = spark.createDataFrame([(i if i else None, t, 9, 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, length int, sequence_id int")
    got = best_fit_packing(df).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got if r.doc_id in (None, 1, 2, 3)) == [(0, 1), (1, 1), (2, 2), (3, 2)]
    assert [r.length for r in sorted(got, key=lambda r: r.piece) if r.doc_id == 6] == [2048, 2048, 905]
    check([r.asDict() for r in got], 2048)
    assert best_fit_packing(df.where("false")).count() == 0


def test_repeated_pieces(spark):
    df = spark.range(500).selectExpr("7L AS doc_id", "0 AS piece", "0L AS start", "cast(1 + id % 3 AS long) * 300 AS length")
    rows = pack(df).collect()
    assert len(rows) == 500
    check([r.asDict() for r in rows], 2048)
