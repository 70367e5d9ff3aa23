"""Language of a text by string kernels.

The kernel of two texts is the number of character n-grams (n = 1 to 3, the blended spectrum) that
both hold, divided by the root of the product of their own numbers: presence, not frequency.  Some
labelled texts serve as Nystroem landmarks; a text is described by its kernels with them, whitened by
the inverse root of the landmarks' own kernel matrix, and kernel ridge regression, one language
against the rest, gives a value per language.  Texts are scored in batches: one product of the
batch's presence matrix with the landmarks', one with the weights.

Characters: lower-case code points; what is not a letter counts as a space.  An n-gram's feature is a hash of
its code points, so any number of scripts stands side by side.  The whole text is read.

The classifier is fitted on a bounded sample: at most ``per_language`` distinct labelled texts of each
language, the first by a hash of text, whole; ``landmarks`` of them, spread over the languages, are the
landmarks.  Only the features that a text holds leave the executors.  However many copies a text has, a
language with a labelled text that has a letter is learned.

Every text with a letter gets the language of the greatest value, of equal ones the first by name.  A text of
none of the languages is unlike every landmark, so all its values are near 0 and say nothing; that is
told by its coverage, the share of its own n-grams that some landmark of the predicted language holds.  A
text is ``familiar`` unless it falls short of ``COVERED`` times the median coverage of the language's training
texts (each by the landmarks of other texts); short texts have an allowance of ``DEVIATIONS`` standard
deviations of a share of so many n-grams.  Coverage changes no prediction; ``of_known_language`` rejects by it.

Rows: null texts and texts without a letter are ``und`` with score and coverage 0, and so is every text if there
is nothing to learn from.  Null lang values are not learned.  Repeated rows get equal results; an
empty table gives no rows.  Columns beside the named ones are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, text_slices
from remitflow.session import bounded_broadcast

UNKNOWN = "und"
PER_LANGUAGE, LANDMARKS, RIDGE = 400, 128, 1e-2
#: Least coverage of a text, as a part of the median of its language; its allowance in standard deviations.
COVERED, DEVIATIONS = 0.65, 3.3
_BITS = 20  # of a feature
_SLICE_BYTES = 4 << 20
_ROWS = 256  # texts to a matrix product


_CODES = 1 << _BITS
_EDGE = np.zeros(1, dtype=np.uint32)
#: Odd multipliers: of the first, second and third character of an n-gram, and of the last mixing step.
_FIRST, _SECOND, _THIRD, _MIX = (np.uint32(x) for x in (2654435761, 2246822519, 3266489917, 668265263))
_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Letters as themselves, 0 for other code points."""
    if not _letters:
        _letters.append(np.fromiter((i if chr(i).isalpha() else 0 for i in range(0x110000)), dtype=np.uint32, count=0x110000))
    return _letters[0]


def _feature(h: np.ndarray, length: int) -> np.ndarray:
    h = (h + np.uint32(length)) * _MIX
    return ((h ^ (h >> np.uint32(15))) * _FIRST) >> np.uint32(32 - _BITS)


def ngrams(text: str) -> np.ndarray | None:
    """Features of the n-grams of ``text`` (with repeats); None if it has no letter."""
    s = _letter_table()[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    if not s.any():
        return None
    s = np.concatenate((_EDGE, s, _EDGE))
    one, two, three = s * _FIRST, s * _SECOND, s * _THIRD
    pair = one[:-1] + two[1:]
    return np.concatenate((_feature(one, 1), _feature(pair, 2), _feature(pair[:-1] + three[2:], 3)))


@dataclass
class LanguageModel:
    languages: list[str]
    features: np.ndarray  # that some landmark holds
    landmarks: np.ndarray  # features x landmarks: presence over the root of the landmark's own number
    weights: np.ndarray  # landmarks x languages
    known: np.ndarray  # features x languages: whether a landmark of the language holds it
    least: np.ndarray  # a language's least coverage

    def presence(self, grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Which features each text (its n-grams) holds, one row a text, and its number of distinct n-grams."""
        present = np.zeros(_CODES, dtype=bool)
        held = np.empty((len(grams), len(self.features)), dtype=np.float32)
        own = np.empty((len(grams), 1), dtype=np.float32)
        for i, codes in enumerate(grams):
            present[codes] = True
            held[i] = present[self.features]
            own[i] = np.count_nonzero(present)
            present[codes] = False
        return held, own

    def kernels(self, grams: list[np.ndarray]) -> np.ndarray:
        """Kernels of texts (their n-grams) with the landmarks, one row a text."""
        held, own = self.presence(grams)
        return held @ self.landmarks / np.sqrt(own)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float], list[bool]]:
        """Language, score, coverage and whether the text is familiar, of each text."""
        names, scores, covered, familiar = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts), [False] * len(texts)
        if not self.languages:
            return names, scores, covered, familiar
        for begin in range(0, len(texts), _ROWS):
            grams = [ngrams(t) for t in texts[begin:begin + _ROWS]]
            rows = [i for i, g in enumerate(grams) if g is not None]
            if not rows:
                continue
            held, own = self.presence([grams[i] for i in rows])
            values = (held @ self.landmarks / np.sqrt(own) @ self.weights).astype(np.float64)
            best = values.argmax(axis=1)
            share = ((held @ self.known)[np.arange(len(rows)), best] / own[:, 0]).astype(np.float64)
            least = self.least[best]
            least = least - DEVIATIONS * np.sqrt(least * (1 - least) / own[:, 0])
            for i, k, v, c, f in zip(rows, best, values.max(axis=1), share, share >= least):
                names[begin + i] = self.languages[k]
                scores[begin + i] = float(np.clip((v + 1) / 2, 0, 1))
                covered[begin + i], familiar[begin + i] = float(c), bool(f)
        return names, scores, covered, familiar


def fit(samples: list[tuple[str | np.ndarray, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> LanguageModel:
    """``samples``: (text, or the features it holds; language)."""
    read = [(ngrams(x) if isinstance(x, str) else x, g) for x, g in samples]
    samples = [(np.unique(x), g) for x, g in read if x is not None and len(x)]
    languages = sorted({g for _, g in samples})
    none = np.zeros((0, 0), dtype=np.float32)
    if not languages:
        return LanguageModel([], np.zeros(0, dtype=np.int64), none, none, none, none)
    turn: Counter[str] = Counter()
    order = []
    for i, (_, g) in enumerate(samples):  # the first of each language, the second of each, ...
        order.append((turn[g], i))
        turn[g] += 1
    chosen = [i for _, i in sorted(order)[:max(landmarks, len(languages))]]
    grams = [x for x, _ in samples]
    own = [grams[i] for i in chosen]
    features = np.unique(np.concatenate(own))
    matrix = np.zeros((len(features), len(chosen)), dtype=np.float32)
    for k, codes in enumerate(own):
        matrix[np.searchsorted(features, codes), k] = 1 / np.sqrt(len(codes))
    model = LanguageModel(languages, features, matrix, none, none, none)
    blocks = [model.kernels(grams[i:i + _ROWS]).astype(np.float64) for i in range(0, len(grams), _ROWS)]
    kernel = np.concatenate(blocks)
    values, vectors = np.linalg.eigh((kernel[chosen] + kernel[chosen].T) / 2)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T
    mapped = kernel @ root
    target = np.where(np.array([g for _, g in samples])[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # Each language weighs as much as any other.
    counts = Counter(g for _, g in samples)
    weight = np.array([len(samples) / (len(languages) * counts[g]) for _, g in samples])[:, None]
    gram = mapped.T @ (mapped * weight) + ridge * len(samples) * np.eye(len(chosen))
    model.known, model.least = _coverage(model, samples, grams, chosen)
    model.weights = (root @ np.linalg.solve(gram, mapped.T @ (target * weight))).astype(np.float32)
    return model


def _coverage(model: LanguageModel, samples: list[tuple[np.ndarray, str]], grams: list[np.ndarray], chosen: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``known`` and ``least`` of the model."""
    known = np.zeros((len(model.features), len(model.languages)), dtype=np.float32)
    least = np.zeros(len(model.languages))
    for k, language in enumerate(model.languages):
        marks = {grams[i].tobytes(): i for i in chosen if samples[i][1] == language}
        held = np.zeros(len(model.features), dtype=np.int32)  # by how many landmark texts
        for i in marks.values():
            held[np.searchsorted(model.features, grams[i])] += 1
        known[:, k] = held > 0
        shares = []
        for name, own in {x.tobytes(): x for x, g in samples if g == language}.items():
            at = np.minimum(np.searchsorted(model.features, own), len(model.features) - 1)
            others = (model.features[at] == own) & (held[at] > (name in marks))  # a landmark does not cover itself
            shares.append(others.mean())
        least[k] = COVERED * np.median(shares)
    return known, least


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[np.ndarray, str]]:
    """(features it holds, lang) of at most ``per_language`` distinct whole texts of each language, the first by a hash
    of the text.  At most ``per_language`` arrays of ``_CODES`` bits a language reach the driver."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("_hash", F.xxhash64("text"))
    texts = rows.select("lang", "_hash").distinct()  # however many copies a text has, it is learned once
    counts = texts.groupBy("lang").count()
    share = F.abs(F.col("_hash") % 1_000_000) / 1_000_000
    # Thinned to a few times the number before it is put in order.
    few = texts.join(bounded_broadcast(counts), "lang").where(share * F.col("count") <= 3 * per_language)
    first = Window.partitionBy("lang").orderBy(share, "_hash")
    chosen = few.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= per_language).select("lang", "_hash", "_n")
    own = rows.join(bounded_broadcast(chosen), ["lang", "_hash"]).groupBy("lang", "_n").agg(F.min("text").alias("text"))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            packed, bits = [], []
            for text in part.column("text").to_pylist():
                codes = np.unique(ngrams(text)) if any(map(str.isalpha, text)) else np.zeros(0)
                packed.append(4 * len(codes) > _CODES // 8)  # whichever is shorter
                if packed[-1]:
                    present = np.zeros(_CODES, dtype=bool)
                    present[codes] = True
                    bits.append(np.packbits(present).tobytes())
                else:
                    bits.append(codes.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("_n"), pa.array(packed), pa.array(bits, pa.binary())],
                                             ["lang", "n", "packed", "bits"])

    def features(r) -> np.ndarray:
        if r["packed"]:
            return np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8))).astype(np.uint32)
        return np.frombuffer(r["bits"], dtype="<u4")

    found = batched(own).select("lang", "_n", "text").mapInArrow(held, "lang string, n int, packed boolean, bits binary").collect()
    return [(features(r), r["lang"]) for r in sorted(found, key=lambda r: (r["lang"], r["n"]))]


def language_of(docs: DataFrame, model: LanguageModel, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` with lang_pred, score and coverage."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = batched(docs).select(*keep, F.col("text").cast("string").alias("text"))
    schema = kept.drop("text").schema if "text" not in keep else kept.schema
    schema = schema.add("lang_pred", "string").add("score", "double").add("coverage", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            names, scores, covered, _ = shared.value.predict(column_or_empty(part.column("text")))
            columns = [part.column(c) for c in keep] + [pa.array(names), pa.array(scores, pa.float64()), pa.array(covered, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", "coverage"])

    return kept.mapInArrow(predict, schema)


def of_known_language(docs: DataFrame, model: LanguageModel, least: float) -> DataFrame:
    """The rows of ``docs``, unchanged, that are familiar in their language and have a score of ``least`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            _, scores, _, familiar = shared.value.predict(column_or_empty(part.column("text")))
            yield part.filter(pa.array([f and s >= least for f, s in zip(familiar, scores)]))

    return batched(docs).mapInArrow(keep, docs.schema)


def held_out(column: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether a row is kept from learning; a row without an id is."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % parts == part, F.lit(True))


def identify(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score, coverage of ``docs``, learned from text and lang of ``learn_from``."""
    return language_of(docs.select(F.col("doc_id").cast("long"), "text"), fit(training_sample(learn_from)), "doc_id")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, docs.where(~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "coverage")
