import re
import zlib

import numpy as np
import public_tokenizers
import xxhash

import corpus_pipeline as P
from remitflow.llm.language_id import fit, training_sample

SF = "/root/testdata/sf0.001"


def plain_lines(docs):
    seen, out = set(), {}
    for d in sorted(docs):
        lines = docs[d].split("\n")
        gone = set()
        for i in range(len(lines)):
            for size in (1, 2, 3):
                w = tuple(lines[i:i + size])
                if len(w) == size and (size == 3 or sum(len(x.encode().split()) for x in w) >= 20):
                    if w in seen:
                        gone.update(range(i, i + size))
                    seen.add(w)
        if len(gone) < len(lines):
            out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def plain_near(docs):
    def fp(text):
        words = text.encode().lower().split()
        hs = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(len(words) - 3, 1))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))

    fps, least = {d: fp(t) for d, t in docs.items()}, {d: d for d in docs}
    for _ in range(len(docs)):
        new = {d: min(least[e] for e in docs if (fps[d] ^ fps[e]).bit_count() <= 4) for d in docs}
        if new == least:
            break
        least = new
    return {d: t for d, t in docs.items() if least[d] == d}


SECRET = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}""", re.I | re.A)


def test_run_against_plain_python(spark):
    from tokenizers import Tokenizer

    rows = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit(training_sample(rows.where(~P.held_out())))
    docs = {r.doc_id: r.text for r in rows.collect()}
    _, scores, _, familiar = model.predict(list(docs.values()))
    docs = {d: t for (d, t), f, s in zip(docs.items(), familiar, scores) if f and s >= P.LEAST_SCORE}
    docs = plain_near(plain_lines(docs))
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    got = P.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(docs)
    clean = {d for d, text in docs.items() if not SECRET.search(text)}
    assert len(clean) > 50
    want = {}
    for d in clean:
        ids = np.array([*t.encode(docs[d], add_special_tokens=False).ids, 0], dtype="<u4")
        want |= {(d, k // 2048): (k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got if r.doc_id in clean} == want
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))]).tolist()[:-1] and sum(n for _, n in parts) <= 2048


def test_stages_keep_columns_and_clean_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    docs = rows
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == rows.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in rows.schema]
        docs = spark.createDataFrame(out.collect(), rows.schema)
        assert docs.count() > 0.6 * rows.count()
        assert docs.where("n_chars <> length(text)").count() == 0


def test_odd_rows(spark):
    long = "the house and the dog\n" * 3 + "of the king " * 20000
    df = spark.createDataFrame([(1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, "12 !", "en", "s", 4, 1), (None, "the dog is here", "en", "s", 15, 1),
                                (4, "a dog of the house", None, "s", 18, 1), (4, "a dog of the house", None, "s", 18, 1), (6, long, "en", "s", 9, 1),
                                (7, "the key token=abcdefghijklmnop of the dog", "en", None, 41, 1), (9, "the king and the house", "en", "s", 22, 1)],
                               "doc_id long, text string, lang string, source string, n_chars long, version int")
    docs = df
    for name, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), df.schema)
    left = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == 5 and set(left) == {None, 4, 6, 7, 9} and left[6].text == long and left[4].lang is None
    assert left[7].text == "the key [secret] of the dog" and left[7].n_chars == 27 and left[7].source is None
    assert P.STAGES[-1][1](spark, docs, SF).where("doc_id = 4").count() == 1
    for name, stage in P.STAGES:
        assert stage(spark, df.where("false"), SF).count() == 0


FOREIGN = ["人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待", "Все люди рождаются свободными и равными в своем достоинстве и правах",
           "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα",
           "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
           "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
           "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
           "xqz wvkj zzxq pfgh qqwx jkvz bnmx tyqw zxcv lkjh qpzm wxnv fghj kqzx vbnq wpxz jqkx hzvq mxwz"]


def test_unlearned_languages_go(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet")
    more = [(10**6 + k, t, None, "s", len(t)) for k, t in enumerate([*FOREIGN, *(f"{t}\n" * 30 for t in FOREIGN)])]
    docs = rows.unionByName(spark.createDataFrame(more, rows.schema))
    left = {r.doc_id for r in P.language_id(spark, docs, SF).collect()}
    assert left == {r.doc_id for r in rows.where("text RLIKE '\\\\p{L}'").collect()}
