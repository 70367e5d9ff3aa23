"""Quality score of a text: histogram gradient-boosted trees over document statistics.

Statistics (``statistics``) are counts and ratios over the whole text: characters by sort, words,
lines, repetition.  Each is cut into at most ``bins`` ranges by the quantiles of the training rows;
a tree grows level by level on histograms of gradients and hessians of the logistic loss.  A fitted
forest is a few flat arrays (``Forest``); a batch of rows walks all trees level by level as index
arithmetic.

The forest is fitted on at most ``TRAINING_ROWS`` labelled rows, the first by a hash of the id; a
label other than 0 and 1, or null, is not learned.  Rows without any label to learn from get 0.5.

Rows: null texts are empty; an empty text is scored like any other; repeated rows get equal scores;
a document with several labels is learned once for each; an empty table gives no rows.  Columns
beside the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitflow.llm.common import batched, column_or_empty, documents, stored, text_slices
from remitflow.llm.language_id import held_out

TRAINING_ROWS = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, LEAST_HESSIAN, L2 = 80, 4, 64, 0.15, 2.0, 1.0
_SLICE_BYTES = 8 << 20

NAMES = ("log_bytes", "log_words", "log_lines", "word_length", "longest_word", "distinct_words", "distinct_lines", "line_length",
         "top_word", "letters_upper", "letters_lower", "digits", "spaces", "beyond_ascii", "word_punct", "sentence_ends",
         *(f"share_{c}" for c in "!%&*$#|,.-_@<>/\\\"'()=+:;?"))
_SHARES = np.frombuffer("!%&*$#|,.-_@<>/\\\"'()=+:;?".encode(), dtype=np.uint8)


def statistics(text: str) -> list[float]:
    """The statistics of ``NAMES``."""
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    if not n:
        return [0.0] * len(NAMES)
    of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = raw.split()
    lines = raw.split(b"\n")
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    m = max(len(words), 1)
    in_words = sum(map(len, words))
    punct = sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128)
    return [np.log1p(n), np.log1p(len(words)), np.log1p(len(lines)), in_words / m, float(max(map(len, words), default=0)),
            len(counts) / m, len(set(lines)) / len(lines), n / len(lines), max(counts.values(), default=0) / m,
            of[65:91].sum() / n, of[97:123].sum() / n, of[48:58].sum() / n, (of[32] + of[9:14].sum()) / n, of[128:].sum() / n,
            punct / m, (of[33] + of[46] + of[63]) / m, *(of[_SHARES] / n)]


@dataclass
class Forest:
    """Complete trees of one depth in flat arrays: node k of a tree has the children 2k+1 and 2k+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # go right if the value is above
    leaf: np.ndarray  # trees x leaves
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        trees, inner = self.feature.shape
        total = np.full(len(rows), self.base)
        if trees:
            at = np.zeros((len(rows), trees), dtype=np.int64)
            tree = np.arange(trees)[None, :]
            each = np.arange(len(rows))[:, None]
            for _ in range((inner + 1).bit_length() - 1):
                at = 2 * at + 1 + (rows[each, self.feature[tree, at]] > self.threshold[tree, at])
            total = total + self.leaf[tree, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Forest:
    inner, leaves = 2**depth - 1, 2**depth
    if not len(labels) or labels.min() == labels.max():
        share = 0.5 if not len(labels) else float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), float(np.log(share / (1 - share))))
    features = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, f], np.arange(1, bins) / bins)) for f in range(features)]
    binned = np.stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    cell = binned + np.arange(features) * bins  # one histogram for all features
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)),
                    float(np.log(labels.mean() / (1 - labels.mean()))))
    margin = np.full(len(labels), forest.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - labels, p * (1 - p)
        node = np.zeros(len(labels), dtype=np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (features * bins) + cell).ravel()
            shape = (width, features, bins)
            g, h = (np.bincount(at, np.repeat(x, features), minlength=width * features * bins).reshape(shape).cumsum(axis=2)
                    for x in (gradient, hessian))
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + L2) + (g_all - g)**2 / (h_all - h + L2) - g_all**2 / (h_all + L2)
            gain[(h < LEAST_HESSIAN) | (h_all - h < LEAST_HESSIAN)] = -np.inf
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            for k in np.flatnonzero(good):
                f, b = divmod(int(best[k]), bins)
                forest.feature[t, first + k] = f
                forest.threshold[t, first + k] = cuts[f][b] if b < len(cuts[f]) else np.inf
            node = 2 * node + 1 + (rows[np.arange(len(rows)), forest.feature[t, node]] > forest.threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, hessian, leaves)
        forest.leaf[t] = -rate * g / (h + L2)
        margin += forest.leaf[t, leaf]
    return forest


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its statistics, one row per row."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, "text", _SLICE_BYTES):
            values = [statistics(t) for t in column_or_empty(part.column("text"))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(values, pa.list_(pa.float32()))], ["doc_id", "stats"])

    return batched(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(measure, "doc_id long, stats array<float>")


def learn(stats: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Forest:
    """A forest from (doc_id, quality) ``labels`` and the statistics of their documents."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("quality")).where("quality IN (0, 1)")
    # A hash of the id thins the labels to little more than ``rows`` before any are put in order.
    share = F.abs(F.xxhash64("doc_id") % 1_000_000_000) / 1_000_000_000
    few = known.where(share * known.count() <= 1.2 * rows).join(stats, "doc_id")
    got = few.orderBy(share, "doc_id", "quality", "stats").limit(rows).select("stats", "quality").collect()
    return fit(np.array([r["stats"] for r in got], dtype=np.float64).reshape(-1, len(NAMES)), np.array([r["quality"] for r in got], dtype=np.float64))


def score(stats: DataFrame, forest: Forest, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted."""
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            flat = part.column("stats").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            got = shared.value.score(flat.reshape(-1, len(NAMES)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(got), pa.array((got >= threshold).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return stats.select("doc_id", "stats").mapInArrow(walk, "doc_id long, score double, predicted int")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(document_statistics(documents(spark, sf_dir)), "statistics")
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    scored = score(stats, learn(stats, labels))
    return scored.select("doc_id", held_out(parts=5, part=0).alias("held_out"), "score", "predicted")
