"""Scores against slow versions, and the model against simpler ones."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.llm import mixing
from threadloom.llm.queries import QUERIES


def slow_base(rows, learns):
    """rows: (key, text); learns: whether each is a training row."""
    def tokens(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in "\t\n\v\f\r":
            low = low.replace(c, " ")
        return [w for w in low.split(" ") if w] + [None]

    counts = Counter()
    for (_, text), learn in zip(rows, learns, strict=True):
        if learn:
            counts.update(tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for (key, text), learn in zip(rows, learns, strict=True):
        found = tokens(text)
        base = math.fsum(math.log10((counts[t] + 1) / (n + v + 1)) for t in found)
        out.append((key, learn, len(found), sum(counts[t] > 0 for t in found), n, base))
    return out


def test_grams():
    grams, lengths = mixing.grams_of([b"abcdefg", b"", b"z"])
    assert lengths.tolist() == [8, 1, 2] and len(grams) == 11
    number = lambda last: int.from_bytes(last.rjust(8, b"\0"), "little")
    assert grams[0] == number(b"a") and grams[6] == number(b"bcdefg")
    assert grams[8] == 0 and grams[10] == number(b"z\0")
    assert mixing.word_so_far(grams[9:]).tolist() == [0, ord("z") << 8]


def test_store_changes_no_result(monkeypatch):
    texts = [b"the cat sat on the mat " * 20, b"the dog", b"", bytes(range(256)) * 9]
    odds = np.full((len(mixing.ORDERS), 1 << mixing.TABLE_BITS), mixing.UNSEEN, np.int16)
    counts = mixing.counted(iter(texts))
    seen = counts.any(axis=1)
    odds[seen] = (np.log((counts[:, 1] + 0.3) / (counts[:, 0] + 0.3)) * 256)[seen].astype(np.int16)
    model = mixing.tuned(odds, texts[:2])
    want = [model.bits(mixing.grams_of([t])[0]).sum() for t in texts]
    monkeypatch.setattr(mixing, "KNOWN_BITS", 4)
    scorer = mixing.Scorer(model)
    for _ in range(2):
        assert np.allclose(scorer.bits(texts), want)
    assert want[0] / len(texts[0]) < 0.5


def test_probabilities_of_all_next_bytes_sum_to_one():
    texts = [b"abracadabra " * 30]
    counts = mixing.counted(iter(texts))
    odds = np.where(counts.any(axis=1), np.log((counts[:, 1] + 0.3) / (counts[:, 0] + 0.3)) * 256, mixing.UNSEEN)
    model = mixing.tuned(odds.astype(np.int16), texts)
    context = int.from_bytes(b"bracada", "little")
    bits = model.bits(np.array([context | b << 56 for b in range(256)], np.uint64))
    assert abs(np.exp2(-bits).sum() - 1) < 1e-9


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_BYTES", 50_000)
    rows = [(i, f"The cat {i % 7} sat\ton the {i % 5} mat" * (i % 4)) for i in range(60)]
    rows += [(None, "no key"), (100, None), (101, ""), (102, "y" * 100_000), (103, "the " * 40_000),
             (104, "THE Éa\x0b b c"), (104, "THE Éa\x0b b c"), (105, "new words only")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 block", "2 learn", "3 score")
    allowed = F.col("doc_id") % 7 != 2
    trained = mixing.fit(df, allowed)
    assert trained.blocks > 3
    got = mixing.score(df, trained, allowed).collect()
    learns = [k is not None and k % 7 != 2 for k, _ in rows]
    key = lambda r: repr(r[:4])
    for have, want in zip(sorted(map(tuple, got), key=key), sorted(slow_base(rows, learns), key=key), strict=True):
        assert have[:5] == want[:5] and have[5] == pytest.approx(want[5], rel=1e-9)
        assert have[6] < 0 and math.isfinite(have[6])
    nothing = mixing.fit(df, F.lit(False))
    (row,) = mixing.score(df.where("doc_id = 101"), nothing, F.lit(False)).collect()
    assert (row["n_known"], row["train_tokens"], row["base_score"]) == (0, 0, 0)
    assert mixing.score(df.limit(0), trained, allowed).count() == 0


def test_query(spark):
    rows = QUERIES["op6_lm_scores"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    learns = [zlib.crc32(str(d).encode()) % 7 != 2 for d, _ in docs]
    want = {r[0]: r for r in slow_base(docs, learns)}
    assert len(rows) == len(docs)
    for r in rows:
        key, learn, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not learn, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    held = [r for r in rows if r["held_out"]]
    bits = sum(-r["score"] for r in held) / math.log10(2)
    size = sum(len(t.encode()) + 1 for (d, t), learn in zip(docs, learns, strict=True) if not learn)
    print("bits per byte", bits / size, "base", sum(-r["base_score"] for r in held) / math.log10(2) / size)
    assert bits / size < 2.5
