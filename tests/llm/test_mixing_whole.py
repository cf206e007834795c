"""The language model learns from every training document."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import mixing


@pytest.fixture
def rows():
    rnd = np.random.default_rng(5)
    return [(i, "".join(map(chr, rnd.integers(97, 123, 40)))) for i in range(300)]


def test_no_training_document_is_left_out(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = mixing.fit(df, F.lit(True)).model.whole()
    counts = mixing.counted(t.encode() for _, t in rows)
    assert ((model.odds != mixing.UNSEEN) == counts.any(axis=1)).all()
    want = np.rint(np.log((counts[:, 1] + mixing.PRIOR) / (counts[:, 0] + mixing.PRIOR)) * 256)
    assert (model.odds == np.where(counts.any(axis=1), want, mixing.UNSEEN)).all()


def test_every_training_document_moves_the_weights(spark, rows):
    # a hash of the key chose the texts that were fitted: with all keys equal, none or all
    df = spark.createDataFrame([(1, t * 2) for _, t in rows], "doc_id long, text string")
    got = mixing.fit(df, F.lit(True)).model.whole()
    first = mixing.fresh(got.odds)
    assert not np.array_equal(got.weights, first.weights) and not np.array_equal(got.refined, first.refined)


def test_an_occurrence_does_not_predict_itself(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = [t.encode() for _, t in rows]
    alone = [mixing.loosened(x) for x in mixing.gathered(mixing.different(df, 4))[1:]]
    counts = mixing.counted(iter(texts))
    for bit in (0, 1):
        left = counts.copy()
        left[:, bit] -= 1
        left = np.maximum(left, 0)
        want = np.rint(np.log((left[:, 1] + mixing.PRIOR) / (left[:, 0] + mixing.PRIOR)) * 256)
        assert (alone[bit] == np.where(left.any(axis=1), want, mixing.UNSEEN)).all()


def test_grams_are_counted_once_each(spark, rows, monkeypatch):
    rows = rows[:50] * 3 + [(0, ""), (0, "a" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = [mixing.unpacked(r["data"]) for r in mixing.different(df, 5).collect()]
    kinds, times = map(np.concatenate, zip(*found, strict=True))
    want = mixing.kinds_of(mixing.grams_of([t.encode() for _, t in rows])[0])
    order = np.argsort(kinds)
    assert (kinds[order] == want[0]).all() and (times[order] == want[1]).all()


def test_frequent_grams_change_no_score(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trained = mixing.fit(df, F.col("doc_id") % 2 == 0)
    texts, model = [t.encode() for _, t in rows], trained.model.whole()
    slow = [model.bits(mixing.grams_of([t])[0]).sum() for t in texts]
    for scorer in (mixing.Scorer(model), mixing.Scorer(model, trained.frequent)):
        assert np.allclose(scorer.bits(texts), slow, rtol=1e-6)
