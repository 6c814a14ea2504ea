import pickle
import random

import numpy as np
import pyarrow as pa
import pytest

from gridcast.llm.quality import dual_coordinate_descent, quality_scores
from gridcast.llm.toxicity import _terms, fm_scorer, toxicity_scores, train_fm
from tests.llm.data import documents, rows, words


def corpus(spark, bad):
    rng = random.Random(0)
    given, labels = [], []
    for i in range(900):
        text, label = words(rng.randrange(5, 60), i), rng.random() < 0.3
        if label:
            bad(rng, text)
        given.append((i, " ".join(text)))
        labels.append((i, 0 if label else 1, int(label)))
    labels += [(0, None, None), (None, 1, 1), (5, labels[5][1], labels[5][2])]
    return documents(spark, given), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def check(got, labels, name):
    truth = {r.doc_id: r[name] for r in labels.collect() if r[name] is not None}
    tested = [(r.predicted, truth[r.doc_id]) for r in got if r.held_out]
    assert len(tested) > 50
    assert np.mean([a == b for a, b in tested]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_on_held_out_rows(spark):
    docs, labels = corpus(spark, lambda rng, t: t.insert(rng.randrange(len(t)), rng.choice(["vile", "rotten", "scummy"])))
    check(toxicity_scores(docs, labels).collect(), labels, "toxic")


def test_pairs_that_single_weights_miss(spark):
    """Label 1 only where both words occur: neither word tells by itself."""
    rng = random.Random(1)
    given, labels = [], []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        given.append((i, " ".join(words(6, i) + ["alpha"] * a + ["omega"] * b)))
        labels.append((i, int(a and b)))
    got = toxicity_scores(documents(spark, given), spark.createDataFrame(labels, "doc_id long, toxic int"), threshold=0.5).collect()
    check(got, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic")


def test_pairs_of_words_that_tell_nothing_alone(spark):
    """Label 1 where exactly one of two words occurs: each is as frequent under both labels."""
    rng = random.Random(2)
    given, labels = [], []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        given.append((i, " ".join(words(6, i) + ["alpha"] * a + ["omega"] * b)))
        labels.append((i, int(a != b)))
    got = toxicity_scores(documents(spark, given), spark.createDataFrame(labels, "doc_id long, toxic int"), threshold=0.5).collect()
    check(got, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic")


def test_scores_equal_a_double_loop_over_pairs():
    rng = random.Random(3)
    texts = [" ".join(words(20, i) + ["vile"] * (i % 3 == 0)) for i in range(300)] + ["", "nothing known"]
    x = [np.unique(_terms(pa.array([t]))[1]) for t in texts]
    model = train_fm(x, np.array([int(i % 3 == 0 and rng.random() < 0.9) for i in range(302)]))
    terms, bias, w, v, slope, offset = pickle.loads(model)
    place = {t: i for i, t in enumerate(terms.tolist())}
    assert place
    for t, got in zip(x, fm_scorer(model)(pa.array(texts))):
        own = [place[k] for k in t.tolist() if k in place]
        z = bias + sum(w[i] for i in own)
        for k, i in enumerate(own):
            for j in own[k + 1 :]:
                z += sum(v[f, i] * v[f, j] for f in range(len(v)))
        assert got == pytest.approx(1 / (1 + np.exp(-(slope * z + offset))), abs=1e-9)


def test_quality_on_held_out_rows(spark):
    def junk(rng, text):
        text[:] = [w + rng.choice(["%%%", "###", "!!"]) for w in text]

    docs, labels = corpus(spark, junk)
    check(quality_scores(docs, labels).collect(), labels, "quality")


@pytest.mark.parametrize("score,label", [(toxicity_scores, "toxic"), (quality_scores, "quality")])
def test_awkward_rows_and_labels(spark, score, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    one = spark.createDataFrame([(i, 1) for i in range(300, 340)], f"doc_id long, {label} int")
    assert score(documents(spark, []), one).count() == 0
    assert {r.score for r in score(documents(spark), none).collect()} == {0.5}
    got = score(documents(spark), one).collect()
    assert len(got) == len(rows()) and all(r.score > 0.5 for r in got)
    assert [r.held_out for r in got if r.doc_id is None] == [False, False]


def test_coordinate_descent_separates():
    x = [np.array([i % 2]) for i in range(20)]
    w, b = dual_coordinate_descent(x, [np.ones(1)] * 20, np.arange(20) % 2, 2)
    assert w[0] + b < 0 < w[1] + b
