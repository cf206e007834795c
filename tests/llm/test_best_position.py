"""Search on impact lists against scoring every document."""

import math
import random
from collections import Counter

import numpy as np

from threadloom.llm import best_position as bp


def slow(rows, queries, k):
    docs = [(key, bp.terms_of(t or "")) for key, t in rows]
    docs = [(key, Counter(terms), len(terms)) for key, terms in docs if terms]
    total = sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for query, text in queries:
        scored = []
        for key, counts, n in docs:
            m = 100 - 75 + (75 * n * len(docs)) // total
            score = sum(
                times
                * math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t, times in Counter(bp.terms_of(text or "")).items()
                if counts[t]
            )
            if score > 0:
                scored.append((-score, key is not None, key or 0, key))
        out += [(query, r + 1, key, -s) for r, (s, _, _, key) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(4)
    vocabulary = [f"w{int(rnd.expovariate(0.02))}" for _ in range(2000)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 3, 50, 300])))) for i in range(900)]
    rows += [(None, "w1 w2 rare"), (1000, None), (1001, "RARE, rare. É_é"), (1002, "w5 " * 60_000), (-3, "w5 𝒳𝒴")]
    rows += [(1003 + i % 9, "tie one") for i in range(30)]
    queries = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 12, 60])))) for i in range(25)]
    queries += [(100, "tie"), (101, "É rare rare 𝒳𝒴"), (102, None), (103, ""), (104, "absent"), (None, "One"), (100, "w1 w2")]
    return rows, queries


def test_matches_scoring_every_document(spark, monkeypatch):
    rows, queries = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 score", "2 shard", "'x' term").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, query string").selectExpr("*", "1 doc_id", "2 uses")
    want = slow(rows, queries, 5)

    def got():
        return sorted(map(tuple, bp.top_k(docs, asked, 5).collect()), key=repr)

    assert got() == want
    # many shards, several blocks of queries
    monkeypatch.setattr(bp, "SHARD_DOCS", 100)
    monkeypatch.setattr(bp, "QUERY_BYTES", 1000)
    assert got() == want


def shard_of(texts):
    n = sum(1 for t in texts if t)
    _, terms, _, places, impacts = (c.to_pylist() for c in bp.shard_rows(0, list(range(len(texts))), texts, n, sum(map(len, texts))))
    return terms[1:], bp.Shard(len(texts), list(zip(places[1:], impacts[1:], strict=True)))


def test_lists_run_from_the_highest_impact():
    terms, shard = shard_of([[b"x"] * (1 + i % 5) + [b"y"] * (i % 3) for i in range(50)])
    assert terms == ["x", "y"]
    for start, length in zip(shard.starts, shard.lengths, strict=True):
        impacts = shard.impacts[start : start + length]
        assert (np.diff(impacts) <= 0).all() and len(impacts) == length > 0


def test_reading_stops_early():
    rnd = random.Random(1)
    texts = [[b"x"] * rnd.randint(1, 9) + [b"y"] * rnd.randint(1, 9) + [b"z"] * 40 for _ in range(6000)]
    _, shard = shard_of(texts)
    lists, weights = np.array([0, 1]), np.array([3, 2])
    places, scores = shard.best(lists, weights, 4)
    entries, there = shard.lookup(lists, np.arange(6000))
    every = (np.where(there, shard.impacts[entries], 0) * weights[:, None]).sum(axis=0)
    kth = np.sort(every)[-4]
    # all that reach the k-th score are met, ties included, and much is never read
    assert set(np.flatnonzero(every >= kth)) <= set(places) and (every[places] == scores).all()
    assert shard.reads < 6000 and not shard.seen.any()


def test_ties_at_the_kth_score_go_by_key(spark):
    rows = [(i, "same words here") for i in range(3000, 0, -1)] + [(5000 + i, "other") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = spark.createDataFrame([(1, "words")], "query_id long, query string")
    assert [r["doc_id"] for r in bp.top_k(docs, asked, 3).orderBy("rank").collect()] == [1, 2, 3]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert bp.top_k(docs.limit(0), asked).count() == 0
    assert bp.top_k(docs, asked.limit(0)).count() == 0
    assert bp.top_k(docs.where("doc_id is null"), asked).count() == 0
    assert [tuple(r) for r in bp.top_k(docs, asked).collect()] == slow([(1, "a"), (2, "b")], [(1, "a")], 10)
