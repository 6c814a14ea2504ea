"""Quality by naive Bayes support vectors.

Indicators of hashed words and word pairs are scaled by the log ratio of their
class frequencies; a linear hinge-loss model is fitted on them by dual
coordinate descent, and its margin is calibrated to a probability on rows the
model was not fitted on.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.labelled import TERM_BITS, calibration_rows, distinct_terms, fit_in_one_task, held_out, labelled_sample, platt, scored, uni_and_bigrams, words_and_marks

# Labelled rows the model is fitted on, at most (about).
SAMPLE_ROWS = 16_384
# Texts a term must occur in, smoothing of the counts, hinge cost, passes.
TEXTS_LEAST, ALPHA, COST, PASSES = 3, 1.0, 1.0, 10


def _terms(texts: pa.Array):
    return uni_and_bigrams(*words_and_marks(texts))


def log_count_ratio(x: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    size = 1 << TERM_BITS
    count = np.zeros((2, size))
    for terms, label in zip(x, y):
        count[label, terms] += 1
    share = (count + ALPHA) / (count + ALPHA).sum(1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    ratio[count.sum(0) < TEXTS_LEAST] = 0
    return ratio


def dual_coordinate_descent(x: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear support vector machine."""
    w, b, sign = np.zeros(size), 0.0, np.where(y == 1, 1.0, -1.0)
    alpha, norm = np.zeros(len(y)), np.array([float(v @ v) + 1 for v in values])
    rng = np.random.default_rng(0)
    for _ in range(PASSES):
        for i in rng.permutation(len(y)):
            step = np.clip(alpha[i] - (sign[i] * (w[x[i]] @ values[i] + b) - 1) / norm[i], 0, COST) - alpha[i]
            if step:
                alpha[i] += step
                w[x[i]] += step * sign[i] * values[i]
                b += step * sign[i]
    return w, b


def _values(terms: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    return ratio[terms] / np.sqrt(max(1, len(terms)))


def train_nbsvm(x: list[np.ndarray], y: np.ndarray) -> bytes:
    """Pickled (terms, weights, bias, slope, offset). One class only, or no rows: its rate."""
    n, pos = len(y), int((y == 1).sum())
    if not 0 < pos < n:
        rate = (pos + 1) / (n + 2)
        return pickle.dumps((np.empty(0, np.int64), np.empty(0, np.float32), 0.0, 0.0, float(np.log(rate / (1 - rate)))))
    tested = calibration_rows(n)
    ratio = log_count_ratio([t for t, out in zip(x, tested) if not out], y[~tested])
    values = [_values(t, ratio) for t in x]
    fit = np.flatnonzero(~tested)
    w, b = dual_coordinate_descent([x[i] for i in fit], [values[i] for i in fit], y[fit], len(ratio))
    margin = np.array([w[t] @ v + b for t, v in zip(x, values)])
    slope, offset = platt(margin[tested], y[tested]) if tested.any() else (1.0, 0.0)
    weight = w * ratio
    terms = np.flatnonzero(weight)
    return pickle.dumps((terms, weight[terms].astype(np.float32), b, slope, offset))


def nbsvm_scorer(model: bytes):
    """Texts -> probabilities of label 1; an empty text gets the bias alone."""
    held: list = []

    def score(texts: pa.Array) -> np.ndarray:
        if not held:  # once per Python worker and task
            terms, weights, *rest = pickle.loads(model)
            dense = np.zeros(1 << TERM_BITS, np.float32)
            dense[terms] = weights
            held.extend([dense, *rest])
        dense, bias, slope, offset = held
        doc, term = distinct_terms(*_terms(texts))
        size = np.maximum(1, np.bincount(doc, minlength=len(texts)))
        margin = np.bincount(doc, dense[term], len(texts)) / np.sqrt(size) + bias
        return 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))

    return score


def quality_scores(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, threshold: float = 0.3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    The model sees the text only. Labels of the held-out fold are never read;
    null labels are left out, an id's several labels count as the largest.
    Null and empty texts score the model's bias; without labels, or with one
    class only, every text scores its rate. Repeated rows are scored alike; an
    empty table gives no rows; other columns are not looked at.
    """
    sample = labelled_sample(docs, labels, label, folds, fold, sample_rows, id_col, text_col)
    out = scored(docs, nbsvm_scorer(fit_in_one_task(sample, _terms, train_nbsvm)), id_col, text_col)
    return out.select(F.col("id").alias(id_col), held_out(F.col("id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
