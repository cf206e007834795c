"""What the language model sends through the driver is little, and exact."""

import pickle

import numpy as np
import pytest

from threadloom.llm import mixing


@pytest.fixture
def grams(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, "".join(map(chr, rnd.integers(97, 123, 40)))) for i in range(100)]
    return mixing.different(spark.createDataFrame(rows, "doc_id long, text string"), 4)


def test_three_tables_cost_one(grams):
    tables = mixing.gathered(grams)
    assert len(pickle.dumps(tables)) < 1.1 * len(pickle.dumps(tables[0]))


def test_frequent_grams_are_packed(grams):
    model = mixing.fresh(np.zeros(0, np.int16))
    model = mixing.Squeezed(mixing.gathered(grams)[0], model.weights, model.refined)
    found = mixing.frequent(grams, model)
    kinds = sum(len(mixing.unpacked(data)[0]) for data in found)
    assert kinds > 3000 and len(pickle.dumps(found)) < 12 * kinds
    kinds, bits = mixing.unpacked(found[0])
    assert np.array_equal(bits.astype("<u4").view("<f4"), model.whole().bits(kinds).astype("<f4"))


def test_counts_of_all_sizes():
    counts = np.zeros((1 << mixing.CHUNK_BITS, 2), np.int64)
    some = [0, 1, 2, 255, 256, 257, 65_535, 65_536, 2**31, 2**40]
    counts[: len(some) ** 2] = [(a, b) for a in some for b in some]
    for left in (None, 0, 1):
        table = mixing.loosened(([(3, mixing.squeezed(counts))], left)).reshape(-1, 1 << mixing.CHUNK_BITS)
        own = np.maximum(counts - [left == 0, left == 1], 0)
        want = np.rint(np.log((own[:, 1] + mixing.PRIOR) / (own[:, 0] + mixing.PRIOR)) * 256)
        assert (table[3] == np.where(own.any(axis=1), want, mixing.UNSEEN)).all()
        assert (np.delete(table, 3, axis=0) == mixing.UNSEEN).all()
