"""The random field against enumeration, and its accuracy on held-out documents."""

import itertools
import zlib

import numpy as np

from threadloom.llm import language
from threadloom.llm.queries import QUERIES

EN = "the cat and the dog with this house on that street\nshe thinks that they should have gone there"
DE = "der hund und die katze sind nicht in dem haus\nwir gehen heute durch die schöne strasse"


def slow_marginals(scores, transitions):
    n, k = scores.shape
    weights = {}
    for path in itertools.product(range(k), repeat=n):
        total = sum(scores[t, path[t]] for t in range(n))
        total += sum(transitions[a, b] for a, b in itertools.pairwise(path))
        weights[path] = np.exp(total)
    z = sum(weights.values())
    return np.array([[sum(w for p, w in weights.items() if p[t] == i) / z for i in range(k)] for t in range(n)])


def test_forward_backward_matches_enumeration():
    rnd = np.random.default_rng(0)
    transitions = rnd.normal(size=(3, 3))
    lengths = np.array([6, 1, 4])
    emissions = rnd.normal(size=(6, 3, 3)) * 3
    gamma, *_ = language.forward_backward(emissions, lengths, transitions)
    for i, n in enumerate(lengths):
        assert np.allclose(gamma[:n, i], slow_marginals(emissions[:n, i], transitions))


def test_labels_switch_inside_a_text():
    model = language.train([("en", EN)] * 1 + [("de", DE)])
    (gamma,) = language.Labeller(model).marginals(["the dog and that house der hund und die katze"])
    names = [model.languages[i] for i in gamma.argmax(axis=1)]
    assert names == ["en"] * 5 + ["de"] * 5
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_store_changes_no_result(monkeypatch):
    model = language.train([("en", EN), ("de", DE)])
    texts = [EN, DE, EN + " " + DE, "hund 12 !", "", None]
    want = language.Labeller(model).label(texts)
    monkeypatch.setattr(language, "KEPT_WORDS", 3)
    labeller = language.Labeller(model)
    got = [labeller.label([t]) for t in texts]
    assert [g[0][0] for g in got] == want[0]
    assert np.allclose([g[1][0] for g in got], want[1])


def test_odd_rows(spark):
    rows = [(1, EN, "en"), (2, DE, "de"), (3, None, "de"), (4, "12 ²³ !? __", None), (None, "the house", None),
            (5, "", "en"), (6, EN, "en"), (6, EN, "en"), (7, "der hund " * 30_000, None), (8, "x" * 100_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 score", "2 lang_pred", "3 mark")
    model = language.fit(df)
    got = {(r[0], i): r for i, r in enumerate(language.identify(df, model).collect())}
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got.values()}
    assert {by_id[i]["lang_pred"] for i in (3, 4, 5)} == {"und"} and by_id[4]["score"] == 0
    assert (by_id[1]["lang_pred"], by_id[2]["lang_pred"], by_id[7]["lang_pred"]) == ("en", "de", "de")
    assert by_id[None]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = language.fit(df.limit(0))
    assert nothing is None and {r["lang_pred"] for r in language.identify(df, nothing).collect()} == {"und"}
    assert language.identify(df.limit(0), model).count() == 0


def test_held_out_accuracy(spark):
    rows = QUERIES["op4_language"](spark, "/root/testdata/sf0.01").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
    held = [r for r in rows if r["held_out"] and docs[r["doc_id"]]["lang"]]
    right = sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held)
    print(right, len(held))
    assert right / len(held) > 0.95
