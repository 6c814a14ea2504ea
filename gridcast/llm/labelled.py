"""Labelled training rows and hashed terms, shared by the two classifiers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import hash_strings, mix, split_words, text_slices, tidy

# Size of the hashed term space.
TERM_BITS = 20
# One sampled row in so many is kept from the fit, to calibrate its scores.
CALIBRATE = 5


def held_out(row_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id's text falls on ``fold``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """id, text and label (0 or 1) of at most about ``rows`` labelled rows outside
    the held-out fold, picked by a hash of the id. Labels are made one per id
    (the largest) and null ones left out. The sample's bound lets its labels be
    broadcast, so the texts of the corpus are not shuffled."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("id"), folds, fold))
        .groupBy("id").agg(F.max("label").alias("label"))
    )
    share = min(1.0, rows / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return texts.join(F.broadcast(picked), "id").select("id", "text", "label")


def letter_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters and digits: (all words, offsets per text)."""
    return split_words(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"[^\p{L}\p{N}]+", " "))


def words_and_marks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased runs of letters and digits, and runs of other marks, in order."""
    return split_words(pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts, "")), r"([^\p{L}\p{N}\s]+)", r" \1 "))


def unigrams(tokens: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hashed term) of every token."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return doc, (hash_strings(tokens) >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def uni_and_bigrams(tokens: pa.Array, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hashed term) of every token and every two neighbours."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    hashes = hash_strings(tokens)
    two = mix(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    inside = doc[:-1] == doc[1:]
    terms = np.concatenate([hashes, two[inside]]) >> np.uint64(64 - TERM_BITS)
    return np.concatenate([doc, doc[:-1][inside]]), terms.astype(np.int64)


def distinct_terms(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs, by text."""
    key = np.unique(doc * (1 << TERM_BITS) + term)
    return key >> TERM_BITS, key & ((1 << TERM_BITS) - 1)


def calibration_rows(n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[np.random.default_rng(1).permutation(n)[: n // CALIBRATE]] = True
    return out


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps on the log loss."""
    pos, neg = (y == 1).sum(), (y != 1).sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    t = np.array([1.0, np.log((pos + 1) / (neg + 1))])
    design = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ t, -30, 30)))
        hess = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step = np.linalg.solve(hess, design.T @ (p - target))
        t -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), float(t[1])


def fit_in_one_task(sample: DataFrame, terms: Callable, train: Callable[[list[np.ndarray], np.ndarray], bytes]) -> bytes:
    """Featurise the (bounded) sample in parallel, fit in one task, return the model.

    The rows are sorted by id before the fit, so a rerun gives the same model.
    """

    def featurise(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                doc, term = distinct_terms(*terms(batch.column("text")))
                cuts = np.searchsorted(doc, np.arange(1, batch.num_rows))
                rows = [t.astype(np.int32).tobytes() for t in np.split(term, cuts)]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())], ["id", "label", "terms"])

    def fit(batches):
        x, y = [], []
        for batch in batches:
            x += [np.frombuffer(t, np.int32) for t in batch.column("terms").to_pylist()]
            y.append(batch.column("label").to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([train(x, np.concatenate(y) if y else np.empty(0, np.int32))], pa.binary())], ["model"])

    rows = sample.mapInArrow(tidy(featurise), "id long, label int, terms binary")
    model = rows.repartition(1).sortWithinPartitions("id", "label").mapInArrow(tidy(fit), "model binary").first()
    return bytes(model["model"]) if model else train([], np.empty(0, np.int32))  # no rows, no task


def scored(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """id and score (and the ``carry`` columns) of every row, in one pass without a shuffle."""
    carry = carry or []
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"), *[F.col(c).alias(f"c{i}_") for i, c in enumerate(carry)])
    keep = ["id", *[f"c{i}_" for i in range(len(carry))]]

    def run(batches):
        for whole in batches:
            for batch in text_slices(whole, "text"):
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(score(batch.column("text")), pa.float64())], [*keep, "score"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.select(*keep).schema)
    return named.mapInArrow(tidy(run), f"{schema}, score double")
