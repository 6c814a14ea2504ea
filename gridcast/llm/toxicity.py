"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>) over the distinct terms of
a text: the inner products learn pairs (an insult with a group's name) that
additive weights miss.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.labelled import TERM_BITS, calibration_rows, distinct_terms, fit_in_one_task, held_out, labelled_sample, letter_words, platt, scored, unigrams

# Labelled rows the model is fitted on, at most (about).
SAMPLE_ROWS = 32_768
# Terms kept: those in TEXTS_LEAST rows whose chi-square with the label is significant
# at 0.001, and those in one of PAIRED rows that tell nothing alone but together with
# another such term, at 0.001 over all of their pairs.
CHI2_LEAST, TEXTS_LEAST, PAIRED, LEVEL = 10.83, 3, 20, 0.001
FACTORS, EPOCHS, BATCH, RATE, L2, SPREAD = 8, 40, 256, 0.1, 1e-4, 0.02
# Rows and columns of one block of the pair counts.
BLOCK = 1024


def _terms(texts: pa.Array):
    return unigrams(*letter_words(texts))


def _chi_square(seen: np.ndarray, hits: np.ndarray, n: int, pos: int) -> np.ndarray:
    """Of presence (in ``seen`` rows, ``hits`` of them with label 1) and label."""
    seen, hits = seen.astype(float), hits.astype(float)
    cells = ((hits, seen * pos / n), (seen - hits, seen * (n - pos) / n), (pos - hits, (n - seen) * pos / n), (n - pos - seen + hits, (n - seen) * (n - pos) / n))
    return sum(np.divide((o - e) ** 2, e, out=np.zeros(seen.shape), where=e > 0) for o, e in cells)


def _telling_pairs(rows: list[np.ndarray], y: np.ndarray, m: int) -> np.ndarray:
    """Which of ``m`` terms tell the label together with another of them: counts
    of the rows that hold both, a block of terms against all others at a time."""
    n, pos = len(y), int((y == 1).sum())
    least = 2 * np.log(max(m, 2) ** 2 / (2 * LEVEL))  # bounds the tail of one degree of freedom from above
    told = np.zeros(m, bool)
    for a in range(0, m, BLOCK):
        both = np.zeros((2, min(BLOCK, m - a), m), np.float32)
        for r in range(0, n, BLOCK):
            part = rows[r : r + BLOCK]
            held = np.zeros((len(part), m), np.float32)
            held[_flat(part)] = 1
            own = held[:, a : a + BLOCK]
            both[0] += own.T @ held
            both[1] += own.T @ (held * (y[r : r + BLOCK] == 1)[:, None])
        for i, (seen, hits) in enumerate(zip(*both)):
            strong = (_chi_square(seen, hits, n, pos) >= least) & (seen >= TEXTS_LEAST)
            strong[a + i] = False
            told |= strong
            told[a + i] |= strong.any()
    return told


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(row, term) of every term of the rows."""
    return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows) if rows else np.empty(0, np.int64)


def _margin(row: np.ndarray, term: np.ndarray, n: int, bias: float, w: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Score before the link, and the factor sums of every row; ``v`` has a line per factor."""
    sums = np.stack([np.bincount(row, line[term], n) for line in v])
    return bias + np.bincount(row, (w - 0.5 * (v**2).sum(0))[term], n) + 0.5 * (sums**2).sum(0), sums


def _descend(rows: list[np.ndarray], y: np.ndarray, m: int, bias: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Minibatch AdaGrad on the log loss; a step touches only the terms of its rows."""
    rng = np.random.default_rng(0)
    w, v = np.zeros(m), rng.normal(0, SPREAD, (FACTORS, m))
    gb, gw, gv = 1e-2, np.full(m, 1e-2), np.full((FACTORS, m), 1e-2)
    place = np.zeros(m, np.int64)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for a in range(0, len(y), BATCH):
            pick = order[a : a + BATCH]
            row, term = _flat([rows[p] for p in pick])
            seen = np.zeros(m, bool)
            seen[term] = True
            met = np.flatnonzero(seen)
            place[met] = np.arange(len(met))
            term, own_w, own_v = place[term], w[met], v[:, met]
            z, sums = _margin(row, term, len(pick), bias, own_w, own_v)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - (y[pick] == 1)) / len(pick)
            push = np.bincount(term, g[row], len(met))
            cross = np.stack([np.bincount(term, line[row], len(met)) for line in g * sums])
            db, dw, dv = g.sum(), push + L2 * own_w, cross - push * own_v + L2 * own_v
            gb += db**2
            gw[met] += dw**2
            gv[:, met] += dv**2
            bias -= RATE * db / np.sqrt(gb)
            w[met] -= RATE * dw / np.sqrt(gw[met])
            v[:, met] -= RATE * dv / np.sqrt(gv[:, met])
    return bias, w, v


def _fit(x: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """(terms, w0, w, v). One class only, or no telling term: w0 is its rate."""
    n, pos = len(y), int((y == 1).sum())
    bias, terms = float(np.log((pos + 1) / (n - pos + 1))), np.empty(0, np.int64)
    if 0 < pos < n:
        row, term = _flat(x)
        seen = np.bincount(term, minlength=1 << TERM_BITS)
        alone = (_chi_square(seen, np.bincount(term, (y == 1)[row], 1 << TERM_BITS), n, pos) >= CHI2_LEAST) & (seen >= TEXTS_LEAST)
        often = np.flatnonzero(~alone & (seen >= max(TEXTS_LEAST, n / PAIRED)))
        terms = np.union1d(np.flatnonzero(alone), often[_telling_pairs(_known(often, x), y, len(often))])
    if not len(terms):
        return terms, bias, np.empty(0), np.empty((FACTORS, 0))
    return terms, *_descend(_known(terms, x), y, len(terms), bias)


def _known(terms: np.ndarray, x: list[np.ndarray]) -> list[np.ndarray]:
    at = np.full(1 << TERM_BITS, -1)
    at[terms] = np.arange(len(terms))
    return [i[i >= 0] for i in (at[t] for t in x)]


def train_fm(x: list[np.ndarray], y: np.ndarray) -> bytes:
    """Pickled (terms, w0, w, v, slope, offset): calibrated on rows that a first
    fit left out, then fitted on all rows."""
    tested = calibration_rows(len(y))
    slope, offset = 1.0, 0.0
    if len(np.unique(y[tested])) == 2:
        terms, bias, w, v = _fit([t for t, out in zip(x, tested) if not out], y[~tested])
        if len(terms):
            row, term = _flat(_known(terms, [t for t, out in zip(x, tested) if out]))
            slope, offset = platt(_margin(row, term, int(tested.sum()), bias, w, v)[0], y[tested])
    return pickle.dumps((*_fit(x, y), slope, offset))


def fm_scorer(model: bytes):
    """Texts -> probabilities of label 1; a text without known terms gets the base rate."""

    def score(texts: pa.Array) -> np.ndarray:
        terms, bias, w, v, slope, offset = pickle.loads(model)
        doc, term = _terms(texts)
        place = np.minimum(np.searchsorted(terms, term), max(0, len(terms) - 1))
        known = terms[place] == term if len(terms) else np.zeros(len(term), bool)
        z = np.full(len(texts), bias)
        if known.any():
            doc, term = distinct_terms(doc[known], term[known])
            z, _ = _margin(doc, np.searchsorted(terms, term), len(texts), bias, w, v)
        return 1 / (1 + np.exp(-np.clip(slope * z + offset, -30, 30)))

    return score


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, fold: int = 1, threshold: float = 0.7, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Per row: id, ``held_out``, ``score`` (0 to 1) and ``predicted``, and the ``carry`` columns.

    The model sees the text only. Labels of the held-out fold are never read;
    null labels are left out, an id's several labels count as the largest.
    Null and empty texts score the base rate; without labels, or with one
    class only, every text does. Repeated rows are scored alike; an empty
    table gives no rows; other columns are not looked at.
    """
    sample = labelled_sample(docs, labels, label, folds, fold, sample_rows, id_col, text_col)
    out = scored(docs, fm_scorer(fit_in_one_task(sample, _terms, train_fm)), id_col, text_col, carry)
    return out.select(
        F.col("id").alias(id_col), held_out(F.col("id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *[F.col(f"c{i}_").alias(c) for i, c in enumerate(carry or [])]
    )
