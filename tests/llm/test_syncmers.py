"""Closed syncmers against a slow version."""

import hashlib
import random

import numpy as np
import pytest

from threadloom.llm import syncmers

M = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 31) * 0xBF58476D1CE4E5B9 & M
    return x ^ x >> 29


def slow_anchors(text):
    def inner(i):
        value = 0
        for c in text[i : i + syncmers.S]:
            value = (value * syncmers.BASE + ord(c) + 1) & M
        return mix(value)

    found = []
    for i in range(len(text) - syncmers.K + 1):
        parts = [inner(i + j) for j in range(syncmers.K - syncmers.S + 1)]
        if min(parts) in (parts[0], parts[-1]):
            value = 0
            for at in range(0, syncmers.K, syncmers.S):
                value = (value * syncmers.BASE + parts[at]) & M
            found.append((i, mix(value)))
    return found


def prose(n, seed=1):
    rnd = random.Random(seed)
    return "".join(rnd.choices("abcdefghij é", k=n))


def test_anchors_match_the_slow_version():
    for text in (prose(400), "aaaa" * 30, "ab" * 40, prose(24), prose(25)):
        places, hashes = syncmers.anchors_of(text)
        want = slow_anchors(text)
        if want:
            assert list(zip(places.tolist(), hashes.tolist(), strict=True)) == want


def test_anchors_move_with_their_text():
    places, hashes = syncmers.anchors_of(prose(3000))
    moved = dict(zip(*map(np.ndarray.tolist, syncmers.anchors_of("xyz" * 7 + prose(3000))), strict=True))
    assert all(moved[p + 21] == h for p, h in zip(places.tolist(), hashes.tolist(), strict=True))
    assert 3000 / 12 < len(places) < 3000 / 6


def test_sketches():
    assert len(syncmers.sketch_of("")) == 0 and len(syncmers.sketch_of("a")) == 1
    assert syncmers.written(syncmers.sketch_of("a")) != syncmers.written(syncmers.sketch_of("b"))
    for text in (prose(50), prose(5000), "repeat this text " * 900, prose(300) * 40):
        _, hashes = syncmers.anchors_of(text)
        want = sorted({h >> 32 for h in hashes.tolist()})[: syncmers.SKETCH]
        assert syncmers.sketch_of(text).tolist() == want


def test_likeness_estimates_the_share_of_anchors():
    one, two = prose(20_000, 1), prose(20_000, 2)
    half = one[:10_000] + two[:10_000]
    a, b = ({*syncmers.anchors_of(t)[1].tolist()} for t in (one, half))
    estimate = syncmers.likeness(syncmers.sketch_of(one), syncmers.sketch_of(half))
    assert abs(estimate - len(a & b) / len(a | b)) < 0.2
    assert syncmers.likeness(syncmers.sketch_of(one), syncmers.sketch_of(two)) == 0
    empty = syncmers.sketch_of("")
    assert syncmers.likeness(empty, empty) == 1 and syncmers.likeness(empty, syncmers.sketch_of("a")) == 0


@pytest.mark.parametrize("n", [1, 2, 3, 200])
def test_every_document_meets_its_successor(spark, n):
    rnd = random.Random(n)
    rows = [(rnd.randrange(10**12), prose(rnd.choice([0, 1, 5, 90, 400]), i)) for i in range(n)]
    if n == 200:
        rows += [(None, "no key"), (5, "same"), (5, "same"), (5, "other"), (6, None), (7, "z" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 bucket", "2 extra", "3 key")
    got = syncmers.edits(df.repartition(3)).collect()
    ordered = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (doc, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = map(syncmers.sketch_of, (text, edited, after))
        want.append((doc, len(text), edited, syncmers.written(a), syncmers.written(b),
                     syncmers.likeness(a, b), syncmers.likeness(a, c)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table_and_anchor_rows(spark):
    df = spark.createDataFrame([(1, prose(200)), (2, None)], "doc_id long, text string")
    assert syncmers.edits(df.limit(0)).count() == 0
    rows = syncmers.anchors(df).collect()
    assert {r["doc_id"] for r in rows} == {1} and len(rows) > 10


def test_query(spark):
    from threadloom.llm.queries import QUERIES

    rows = QUERIES["op3_fingerprints"](spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    order = sorted(docs)
    assert len(rows) == len(docs)
    for row in rows:
        text = docs[row["doc_id"]]
        after = docs[order[(order.index(row["doc_id"]) + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    long = [r for r in rows if r["n_chars"] > 1500]
    assert sum(r["near_edited"] for r in long) / len(long) > 0.25
