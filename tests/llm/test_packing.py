"""Packing: whole documents, no gaps, little padding."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from threadloom.llm import bpe, packing

PATH = bpe.default_path("word_bpe_49k.json")


def check_sequences(rows, texts, capacity=2048):
    """rows: (doc, start, length, ids, doc_tokens, sequence, offset); texts: {doc: text}."""
    library = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for doc, start, length, ids, tokens, sequence, offset in rows:
        pieces[doc].append((start, length, ids, tokens))
        sequences[sequence].append((offset, length))
    assert pieces.keys() == texts.keys()
    for doc, found in pieces.items():
        want = np.array([*library.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for start, length, ids, tokens in sorted(found):
            assert start == at and tokens == len(want)
            assert ids == want[at : at + length].tobytes()
            at += length
        assert at == len(want)
    padding = total = 0
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / total


def test_documents_come_back(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "a " * 60_000), (-4, "x" * 50_000), (-5, "b<|endoftext|>c\x1cd")],
        docs.schema,
    )
    both = docs.union(extra).selectExpr("*", "doc_id AS start", "'x' AS ids")
    rows = [tuple(r) for r in packing.pack(both, PATH).collect()]
    rows = [(d, s, n, bytes(i), t, q, o) for d, s, n, i, t, q, o in rows]
    assert check_sequences(rows, dict(both.select("doc_id", "text").collect())) < 0.02
    assert packing.pack(both.limit(0), PATH).count() == 0
    again = [tuple(r)[:3] for r in packing.pack(both, PATH).collect()]
    assert again == [r[:3] for r in rows]


@pytest.mark.parametrize("capacity", [1, 8, 64, 2048])
def test_classes_hold_their_fixed_count(capacity):
    rnd = np.random.default_rng(capacity)
    docs = [(i, b"abcd" * int(n)) for i, n in enumerate(rnd.geometric(1 / 700, 400))]
    got = defaultdict(int)
    for sequence, kind in packing.harmonic(iter(docs), capacity):
        lengths = [len(ids) // 4 for _, _, ids in sequence]
        assert sum(lengths) <= capacity
        if kind:
            assert len(lengths) == kind
            assert all(capacity // (kind + 1) < n <= capacity // kind for n in lengths)
        for doc, _, ids in sequence:
            got[doc] += len(ids)
    assert got == {i: len(ids) for i, ids in docs}


def test_query_has_the_checksums(spark):
    from threadloom.llm.queries import with_crc

    df = spark.createDataFrame([(1, "Hello there, world")], "doc_id long, text string")
    (row,) = packing.pack(df, PATH).limit(1).collect()
    (crc,) = [r["ids_crc32"] for r in with_crc(packing.pack(df, PATH)).limit(1).collect()]
    assert crc == zlib.crc32(bytes(row["ids"]))
