"""Byte-pair encoding against the tokenizers library."""

import random

import pytest
from tokenizers import Tokenizer

from threadloom.llm import bpe
from threadloom.llm.token_ids import Encoder

ODD = [
    "Σ", "İ", "\x1c", "\x1f", "\x85", " ", " ", "  ", "\n", "\t", "'s", "'LL", "é", "é",
    "<|endoftext|>", "<|startoftext|>", "<|", "12", "½", "ǅ", "中文", "🙂", "_", "-", "ß", " ", "a",
    "B", "́", "ﬁ", "\r\n", "​", "٣", "The quick", "internationalization",
]


def odd_texts(n=4000):
    rnd = random.Random(1)
    found = ["".join(rnd.choices(ODD, k=rnd.randint(0, 12))) for _ in range(n)]
    return [*found, "", "x" * 20_000, "ab " * 30_000, " " * 5000, "né'er" * 3000]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_matches_the_library(spark, name):
    path = bpe.default_path(name)
    library = Tokenizer.from_file(path)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r[0] for r in docs.select("text").collect()] + odd_texts()
    encode, decode, _ = bpe.coders(path)
    want = library.encode_batch(texts, add_special_tokens=False)
    for text, encoding in zip(texts, want, strict=True):
        got = encode(text)
        assert got == " ".join(map(str, encoding.ids))
        assert decode(got) == library.decode(encoding.ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_cut_texts_have_the_librarys_ids(name):
    path = bpe.default_path(name)
    library = Tokenizer.from_file(path)
    texts = odd_texts()
    got = Encoder(path).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == want


def test_operator_keeps_every_row(spark):
    rows = [(1, "Hello world"), (1, "Hello world"), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS ids")
    got = bpe.encode_decode(df, bpe.default_path("word_bpe_49k.json")).collect()
    assert [(r["doc_id"], r["n_tokens"], r["decoded"]) for r in got] == [
        (1, 2, "hello</w> world</w>"), (1, 2, "hello</w> world</w>"), (None, 0, ""), (2, 0, "")
    ]
    assert bpe.encode_decode(df.limit(0), bpe.default_path("word_bpe_49k.json")).count() == 0


def test_store_empties_itself():
    store = bpe.Store(str.upper, size=3)
    assert [store[c] for c in "abcdabcd"] == list("ABCDABCD")
    assert len(store) <= 3
