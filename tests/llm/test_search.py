"""Search against scoring every document."""

import math
import random
from collections import Counter

import pytest

from threadloom.llm import search


def slow(rows, queries, k):
    docs = [(key, Counter(search.terms_of(t or "")), len(search.terms_of(t or ""))) for key, t in rows]
    average = sum(n for _, _, n in docs) / len(docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for query, text in queries:
        scored = []
        for key, counts, length in docs:
            score = sum(
                n * math.log1p((len(docs) - df[t] + 0.5) / (df[t] + 0.5)) * counts[t] * 2.2
                / (counts[t] + 1.2 * (0.25 + 0.75 * length / average))
                for t, n in sorted(Counter(search.terms_of(text or "")).items())
                if counts[t]
            )
            if score > 0:
                scored.append((-round(score, 9), key is not None, key or 0, key))
        out += [(query, r + 1, key, -s) for r, (s, _, _, key) in enumerate(sorted(scored)[:k])]
    return out


def check(got, want):
    got = sorted((r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want, key=lambda w: w[:2])]
    for g, w in zip(got, sorted(want, key=lambda w: w[:2]), strict=True):
        assert g[3] == pytest.approx(w[3], abs=1e-8)


def test_matches_scoring_every_document(spark, monkeypatch):
    rnd = random.Random(4)
    vocabulary = [f"w{int(rnd.expovariate(0.02))}" for _ in range(2000)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 3, 50, 300])))) for i in range(900)]
    rows += [(None, "w1 w2 rare"), (1000, None), (1001, "RARE, rare. É"), (1002, "w5 " * 60_000),
             (1003, "tie one"), (1004, "tie one"), (1005, "tie one"), (1005, "tie one")]
    queries = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 12, 60])))) for i in range(25)]
    queries += [(100, "tie"), (101, "É rare rare"), (102, None), (103, ""), (104, "absent")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 score", "2 shard", "3 keys").repartition(3)
    asked = spark.createDataFrame(queries, "query_id long, query string")
    want = slow(rows, queries, 3)
    check(search.top_k(docs, asked, 3).collect(), want)
    # many shards, several blocks of queries
    monkeypatch.setattr(search, "QUERIES_TOGETHER", 7)
    monkeypatch.setattr(search, "SHARD_DOCS", 100)
    check(search.top_k(docs, asked, 3).collect(), want)


def test_bounds_skip_blocks():
    texts = [[b"x"] * (1 + i // 640) + [b"y"] * 5 for i in range(6400)]
    number, tokens, keys, *rest = search.shard_of(0, list(range(6400)), texts)
    names = ["lengths", "terms", "term_starts", "blocks", "most", "shortest", "block_starts", "places", "times"]
    import pyarrow as pa

    row = {"keys": pa.array(keys)[0]} | {n: pa.array(c)[0] for n, c in zip(names, rest, strict=True)}
    shard = search.Shard(row, {"x": 1.0}, 6.0)
    seen = []
    share = shard.share
    shard.share = lambda times, lengths: seen.append(len(times)) or share(times, lengths)
    best = shard.best([("x", 1)], 2)
    assert sorted(k for _, k in best) == [5760, 5761] and sum(seen) < 1000


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, query string")
    assert search.top_k(docs.limit(0), asked).count() == 0
    assert search.top_k(docs, asked.limit(0)).count() == 0
    with pytest.raises(ValueError):
        search.top_k(docs, asked.union(asked))
