import hashlib
import random

import duckdb
import numpy as np

from remitflow.llm import line_dedup
from remitflow.llm.line_dedup import OP4_SQL, dedup_lines, shapes, winnowed
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def plain(docs, run=3, words=20):
    """docs: (doc_id, text); the texts left."""
    split = {d: t.split("\n") for d, t in docs}
    seen, gone = set(), {d: set() for d in split}
    for d in sorted(split):
        for i in range(len(split[d])):
            for size in range(1, run + 1):
                w = tuple(split[d][i:i + size])
                if len(w) < size or (size < run and sum(len(x.encode().split()) for x in w) < words):
                    continue
                if w in seen:
                    gone[d].update(range(i, i + size))
                seen.add(w)
    return {d: "\n".join(x for i, x in enumerate(ls) if i not in gone[d]) for d, ls in split.items()}


def test_random_documents(spark, monkeypatch):
    rng = random.Random(7)
    pool = ["a", "b", "", "c d", "one two three four", "five six seven eight nine ten", "\u00a0x y\tz"]
    docs = [(i * 3, "\n".join(rng.choice([*pool, f"u{rng.randrange(40)}"]) for _ in range(rng.randint(1, 14)))) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for run, words in ((1, 5), (2, 9), (3, 6), (3, 10**6), (5, 8)):
        assert {r.doc_id: r.text for r in dedup_lines(df, run, words).collect()} == plain(docs, run, words)
    monkeypatch.setattr(line_dedup, "_HOT_ROWS", 3)  # nearly all shared lines are hot
    monkeypatch.setattr(line_dedup, "_HOT", 10**9)
    assert {r.doc_id: r.text for r in dedup_lines(df, 3, 6).collect()} == plain(docs, 3, 6)


def test_one_long_line_goes_a_short_one_stays(spark):
    passage = " ".join(f"w{i}" for i in range(52))
    docs = [(1, f"x\n{passage}\ny"), (2, f"p\n{passage}\nq"), (3, passage), (4, "too short to count\nother"), (5, "too short to count")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in dedup_lines(df).collect()} == {**dict(docs), 2: "p\nq", 3: ""}


def test_equal_windows_select_a_line_at_the_same_place():
    rng = random.Random(8)
    same = [f"l{rng.random()}" for _ in range(3)]
    for _ in range(50):
        held = []
        for _ in "ab":
            head = [f"x{rng.random()}" for _ in range(rng.randint(0, 5))]
            found = winnowed("\n".join([*head, *same, *(f"y{rng.random()}" for _ in range(rng.randint(0, 5)))]))
            # (hash, place in the window) of the line that this very window has selected
            held.append({(fp, before) for fp, at, _, bits, _ in found for k, (before, size) in enumerate(shapes(3))
                         if bits >> k & 1 and size == 3 and at - before == len(head)})
        assert len(held[0]) == 1 and held[0] == held[1]
    assert len(winnowed("a\nb\nc\nd\ne\nf\ng\nh")) < 6  # not every line


def test_query_against_sql(spark):
    got = sorted(tuple(r) for r in QUERIES["op4_line_dedup"](spark, SF).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(db.execute(OP4_SQL).fetchall())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert {r[0]: r[4] for r in got} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in plain([tuple(r) for r in docs]).items()}


def test_odd_rows(spark):
    run = "a\nb\nc"
    df = spark.createDataFrame([(1, None, 0, 0), (2, "", 0, 0), (None, run, 0, 0), (4, run, 0, 0), (4, run, 0, 0), (5, run + "\nd", 0, 0),
                                (6, "x\n" * 5000, 0, 0)], "doc_id long, text string, line int, at int")
    got = sorted(((r.doc_id or 0, r.text, r["line"]) for r in dedup_lines(df).collect()), key=str)
    # Of 5000 equal lines the first is left, and the empty line that ends them.
    assert got == sorted([(1, None, 0), (2, "", 0), (0, run, 0), (4, run, 0), (4, run, 0), (5, "d", 0), (6, "x\n", 0)], key=str)
    assert dedup_lines(df.where("false")).count() == 0
