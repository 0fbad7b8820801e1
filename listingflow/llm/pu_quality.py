"""A quality classifier from positive and unlabelled documents.

Only documents marked good (trusted positives) and web text without labels are learned from; which of the unlabelled
are bad is not known. With class prior p, the risk of a scorer on negatives is its risk as negative on the unlabelled
less p times its risk as negative on the positives. That difference is an estimate of something that cannot be below
zero, so where it falls below zero the step goes the other way (the non-negative risk estimator); without that the
scorer learns the positives by heart. The class prior is estimated from the same two samples: where a first scorer,
positives against unlabelled, keeps a share a of the positives it keeps at least p a of the unlabelled, so the least
ratio of the two shares over cross-fitted scores bounds p.

Scores come from the whole text alone, through the statistics in ``FEATURES``. Documents are measured and scored by
Python tasks, a few texts at a time. The fit sees a sample of at most ``max_rows`` positives and as many unlabelled
documents, drawn by a hash of the id; it is the only thing that reaches the driver, as ``max_rows`` x 2 rows of
numbers.

Folds: ids whose CRC-32 (of the id as text) leaves remainder 0 modulo 5 are held out; neither their labels nor their
texts are learned from. Defined cases: a document without words has the statistics of an empty text and gets a score
like any other. Rows with null ids are scored, held_out is null, and are not learned from. Of several labels for an
id the least counts; null labels are no labels. Without positives or unlabelled rows every score is the prior, 0.5.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingflow.llm.quality_rules import measure
from listingflow.llm.words import chunks, texts_of
from listingflow.session import materialize

MAX_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
FEATURES = (
    "words", "symbols", "repeats", "duplicate_lines", "upper", "digits", "bars", "marks", "stops", "commas",
    "distinct", "top_word", "stutter", "word_length", "line_words", "none",
)
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))


def _among(text: bytes, kind: bytes) -> int:
    return len(text) - len(text.translate(None, kind))


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """One row of ``FEATURES`` per text, all between 0 and about 1."""
    found = measure(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    for i, text in enumerate(texts):
        n = int(found["n_words"][i])
        if not n:
            out[i, -1] = 1.0
            continue
        words = text.split()
        counts = Counter(words)
        letters = _among(text, _UPPER) + _among(text, _LOWER) or 1
        size = found["word_chars"][i] or 1
        out[i] = (
            np.log1p(n) / 10, found["n_symbols"][i] / size, found["n_repeat_words"][i] / n,
            found["n_dup_lines"][i] / (found["n_lines"][i] or 1), _among(text, _UPPER) / letters,
            _among(text, b"0123456789") / size, _among(text, b"|") / n, _among(text, b"!?") / n,
            _among(text, b".") / n, _among(text, b",") / n, len(counts) / n, counts.most_common(1)[0][1] / n,
            sum(map(eq, words, words[1:])) / n, size / n / 10, np.log1p(n / (found["n_lines"][i] or 1)) / 10, 0.0,
        )
    return out


def spread(x: np.ndarray) -> np.ndarray:
    """The statistics, their roots (which tell small shares from none) and a constant."""
    x = np.clip(x, 0.0, 2.0)
    return np.hstack([x, np.sqrt(x), np.ones((len(x), 1))])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0)))


@dataclass(frozen=True)
class Scorer:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(((spread(x) - self.centre) / self.scale) @ self.weights)


def _descend(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _against_unlabelled(pos: np.ndarray, unl: np.ndarray, steps: int) -> np.ndarray:
    """Weights of a plain logistic scorer, positives against unlabelled, both sides weighing the same."""
    def gradient(w):
        return (-(1 - _sigmoid(pos @ w)) @ pos / len(pos) + _sigmoid(unl @ w) @ unl / len(unl)) + 1e-4 * w
    return _descend(gradient, pos.shape[1], steps, 0.05)


def estimate_prior(pos: np.ndarray, unl: np.ndarray, steps: int = 300) -> float:
    """Share of positives among the unlabelled, from scores of rows that the scorer has not seen."""
    p_scores, u_scores = np.zeros(len(pos)), np.zeros(len(unl))
    for half in (0, 1):
        w = _against_unlabelled(pos[half::2], unl[half::2], steps)
        p_scores[1 - half :: 2], u_scores[1 - half :: 2] = pos[1 - half :: 2] @ w, unl[1 - half :: 2] @ w
    p_sorted, u_sorted = np.sort(p_scores), np.sort(u_scores)
    cuts = np.quantile(p_scores, np.linspace(0.005, 0.5, 100))
    p_kept = 1 - np.searchsorted(p_sorted, cuts) / len(pos)
    u_kept = 1 - np.searchsorted(u_sorted, cuts) / len(unl)
    # A standard error less: a prior a little low blurs few scores, one too high calls bad documents good.
    error = np.sqrt(u_kept * (1 - u_kept) / len(unl) + p_kept * (1 - p_kept) / len(pos))
    return float(np.clip(((u_kept - error) / np.maximum(p_kept, 1e-9)).min(), 0.05, 0.95))


def fit(pos: np.ndarray, unl: np.ndarray, steps: int = 600, rate: float = 0.05) -> Scorer:
    """The scorer of least non-negative risk with logistic loss; ``pos`` and ``unl`` are rows of ``FEATURES``."""
    width = 2 * len(FEATURES) + 1
    if not len(pos) or not len(unl):
        return Scorer(np.zeros(width), np.ones(width), np.zeros(width), 0.5)
    pos, unl = spread(pos), spread(unl)
    centre, scale = unl.mean(axis=0), unl.std(axis=0) + 1e-3
    centre[-1], scale[-1] = 0.0, 1.0
    pos, unl = (pos - centre) / scale, (unl - centre) / scale
    prior = estimate_prior(pos, unl)

    def gradient(w):
        p, u = _sigmoid(pos @ w), _sigmoid(unl @ w)
        as_positive = -((1 - p) @ pos) / len(pos)
        as_negative = u @ unl / len(unl) - prior * (p @ pos) / len(pos)
        risk = np.logaddexp(0, unl @ w).mean() - prior * np.logaddexp(0, pos @ w).mean()
        step = prior * as_positive + as_negative if risk >= 0 else -as_negative
        return step + 1e-4 * w

    return Scorer(centre, scale, _descend(gradient, width, steps, rate), prior)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        rows = statistics(texts_of(batch))
        values = pa.ListArray.from_arrays(
            pa.array(np.arange(0, rows.size + 1, rows.shape[1]), pa.int32()), pa.array(rows.ravel())
        )
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], names=["doc_id", "x"])


def _scored(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays(
            # Rounded, as the last bits of a product depend on which rows are multiplied together.
            [batch.column("doc_id"), pa.array(np.round(scorer(x), 9))], names=["doc_id", "score"]
        )


def fold_of(doc_id: str) -> F.Column:
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of each row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _measured, f"doc_id {kind}, x array<double>"
    )


def _sample(rows: DataFrame, max_rows: int) -> np.ndarray:
    """At most ``max_rows`` rows of statistics, by a hash of the id."""
    there = rows.count()
    if there > max_rows:
        kept = int((1 << 20) * 0.95 * max_rows / there)  # so that the limit below is all but never reached
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < kept)
    found = [r["x"] for r in rows.select("x").limit(max_rows).collect()]
    return np.array(found, dtype=np.float64).reshape(-1, len(FEATURES))


def train(stats: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Scorer:
    """Fit on the positives of ``labels`` (doc_id, quality) and on documents whatever their labels, all folds but 0."""
    learned = stats.where(F.col("doc_id").isNotNull() & (fold_of("doc_id") != 0))
    marks = labels.where("quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    positives = learned.join(marks.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    # In a fixed order, so that sums of floating-point numbers agree between runs.
    pos, unl = (rows[np.lexsort(rows.T)] for rows in (_sample(positives, max_rows), _sample(learned, max_rows)))
    return fit(pos, unl)


def score(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    stats = materialize(measured(docs), "text-statistics")
    scorer = train(stats, labels, max_rows)
    scored = stats.mapInArrow(
        partial(_scored, scorer=scorer), f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double"
    )
    return scored.select(
        "doc_id", (fold_of("doc_id") == 0).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
