import math
import zlib

import numpy as np

from remitflow.llm.language_id import fit, identify, ngrams, training_sample
from remitflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"

SAMPLES = [("the cat and the dog", "en"), ("this is a house of the king", "en"), ("le chat et la maison", "fr"),
           ("la reine est dans le château", "fr"), ("der hund und das haus", "de"), ("die königin ist groß", "de")] * 2


def plain_grams(text):
    s = [c if c.isalpha() else " " for c in text.lower()]
    s = [" ", *s, " "]
    return {tuple(s[i:i + n]) for n in (1, 2, 3) for i in range(len(s) - n + 1)}


def test_kernels_by_sets():
    model = fit(SAMPLES, landmarks=6)
    texts = ["the house and the cat", "Die Maison", "ß", "zzz the", "a 1 b"]
    marks = sorted(range(len(SAMPLES)), key=lambda i: ([g for _, g in SAMPLES[:i]].count(SAMPLES[i][1]), i))[:6]
    want = [[len(a & b) / math.sqrt(len(a) * len(b)) for b in (plain_grams(SAMPLES[i][0]) for i in marks)]
            for a in (plain_grams(t) for t in texts)]
    np.testing.assert_allclose(model.kernels([ngrams(t) for t in texts]), want, rtol=1e-5)
    assert model.predict(["the dog of the king", "le roi et la reine", "das ist groß"])[0] == ["en", "fr", "de"]


def test_query_on_held_out_texts(spark):
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) >= 0.99
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or "")) for r in rows)


def test_odd_rows(spark):
    learn = spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(SAMPLES)] + [(90, "x", None), (91, None, "en"), (92, "", "xx")],
                                  "doc_id long, text string, lang string")
    df = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "12 + 3", 0.5), (None, "the dog and the cat", 0.5),
                                (4, "und das haus der " * 20000, 0.5), (4, "und das haus der " * 20000, 0.5)],
                               "doc_id long, text string, score double")
    rows = identify(df, learn).collect()
    assert [(r.doc_id, r.lang_pred) for r in rows] == [(1, "und"), (2, "und"), (3, "und"), (None, "en"), (4, "de"), (4, "de")]
    assert rows[4].score == rows[5].score and rows[0].score == 0
    assert {r.lang_pred for r in identify(df, learn.where("false")).collect()} == {"und"}
    assert identify(df.where("false"), learn).count() == 0


def test_sample_of_copied_and_of_long_texts(spark):
    rows = [(f"ala ma kota {k % 3}", "pl") for k in range(3000)] + [(f"der hund {k}", "de") for k in range(50)]
    rows += [(f"{k} " + "le chat et la maison " * 2000 + "zut", "fr") for k in range(5)] + [("12 + 3", "xx"), (None, "xx")]
    got = training_sample(spark.createDataFrame(rows, "text string, lang string"), per_language=10)
    assert {g: sum(x == g for _, x in got) for _, g in got} == {"pl": 3, "de": 10, "fr": 5}
    whole = set(np.unique(ngrams(rows[-3][0])).tolist())
    assert all(set(x.tolist()) == whole for x, g in got if g == "fr")  # to the last word


def test_any_text_with_a_letter_has_a_learned_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = ["The quick brown fox jumps over the lazy dog", "人人生而自由", "x", "Ω", "zut", "Все люди рождаются свободными", "12 a"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    known = {r[0] for r in docs.select("lang").distinct().collect()}
    rows = {r.doc_id: r for r in identify(df, docs).collect()}
    assert all(rows[i].lang_pred in known and 0 <= rows[i].score <= 1 for i in range(len(texts)))
    assert rows[1].coverage < 0.2 and rows[5].coverage < 0.2


def test_six_scripts_at_once():
    base = {"zh": "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待", "ja": "すべての人間は生まれながらにして自由でありかつ尊厳と権利とについて平等である",
            "ru": "все люди рождаются свободными и равными в своем достоинстве и правах", "el": "όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια",
            "ar": "يولد جميع الناس أحرارا متساوين في الكرامة والحقوق وقد وهبوا عقلا وضميرا", "en": "all human beings are born free and equal in dignity and rights"}
    # Two halves of a sentence, many letters a script: learned from the one, told by the other.
    samples = [(t[:2 * len(t) // 3], g) for g, t in base.items()] + [(t[len(t) // 3:2 * len(t) // 3], g) for g, t in base.items()]
    model = fit(samples)
    assert model.predict([t[len(t) // 2:] for t in base.values()])[0] == list(base)


def test_equal_values_go_to_the_first_name():
    model = fit([("abc", "yy"), ("abc", "xx")])
    assert model.predict(["abc"])[0] == ["xx"]


def test_ridge_by_its_definition():
    model = fit(SAMPLES, landmarks=6, ridge=1e-2)
    kernel = model.kernels([ngrams(t) for t, _ in SAMPLES]).astype(float)
    order = sorted(range(len(SAMPLES)), key=lambda i: ([g for _, g in SAMPLES[:i]].count(SAMPLES[i][1]), i))[:6]
    value, vector = np.linalg.eigh(kernel[order])
    mapped = kernel @ (vector / np.sqrt(np.maximum(value, 1e-6)) @ vector.T)
    target = np.array([[1.0 if g == x else -1.0 for x in model.languages] for _, g in SAMPLES])
    want = np.linalg.solve(mapped.T @ mapped + 1e-2 * len(SAMPLES) * np.eye(6), mapped.T @ target)
    np.testing.assert_allclose(kernel @ model.weights, mapped @ want, atol=1e-3)  # equal languages weigh alike
