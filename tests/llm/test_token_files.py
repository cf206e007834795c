"""Token files: exact round trips, order, checksums."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from threadloom.llm import bpe, token_files
from threadloom.session import scratch_dir

PATH = bpe.default_path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 1000, 40_000])
@pytest.mark.parametrize("kind", ["random", "same", "skewed", "cyclic"])
def test_blocks_round_trip(n, kind):
    rnd = np.random.default_rng(n)
    ids = {
        "random": lambda: rnd.integers(0, 50_257, n),
        "same": lambda: np.full(n, 50_256),
        "skewed": lambda: np.minimum(rnd.geometric(0.01, n), 50_256),
        "cyclic": lambda: np.arange(n) % 7,
    }[kind]().astype("<u4")
    payload = token_files.encode_block(ids, 50_257)
    assert (token_files.decode_block(payload, n, 50_257) == ids).all()
    if n == 40_000 and kind != "random":
        assert 8 * len(payload) / n < {"same": 1, "skewed": 10, "cyclic": 2}[kind]


def test_documents_come_back_in_order(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame(
        [(-1, None), (-2, ""), (-3, "a " * 60_000), (-4, "x" * 50_000), (7, "again"), (7, "again"),
         (None, "no key"), (900, "b<|endoftext|>c\x1cd  \n")],
        docs.schema,
    )
    both = docs.union(extra).selectExpr("*", "1 AS part", "2 AS start", "'p' AS payload")
    folder = scratch_dir(spark, "tokens")
    token_files.write_tokens(both, PATH, folder)
    got = token_files.read_tokens(spark, folder).collect()
    library = Tokenizer.from_file(PATH)
    rows = sorted(both.select("doc_id", "text").collect(), key=lambda r: (r[0] is not None, r[0] or 0))
    want = [(d, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows]
    got = sorted(got, key=lambda r: r["start"])
    at = 0
    for row in got:
        assert row["start"] == at and row["n_tokens"] * 4 == len(row["ids"])
        at += row["n_tokens"]
    key = lambda pair: (pair[0] is not None, pair[0] or 0, pair[1])
    have = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got]
    assert [d for d, _ in have] == [d for d, _ in want]
    assert sorted(have, key=key) == sorted(want, key=key)


def test_empty_table(spark):
    folder = scratch_dir(spark, "tokens")
    df = spark.createDataFrame([], "doc_id long, text string")
    token_files.write_tokens(df, PATH, folder)
    assert token_files.read_tokens(spark, folder).count() == 0


def test_damage_is_noticed(spark):
    folder, worse = scratch_dir(spark, "tokens"), scratch_dir(spark, "tokens")
    df = spark.createDataFrame([(1, "some text here")], "doc_id long, text string")
    token_files.write_tokens(df, PATH, folder)
    blocks = spark.read.parquet(folder)
    flipped = blocks.selectExpr("*", "concat(payload, X'00') AS p").drop("payload")
    flipped.withColumnRenamed("p", "payload").write.parquet(worse)
    with pytest.raises(Exception, match="damaged block"):
        token_files.read_tokens(spark, worse).count()


def test_query(spark):
    from threadloom.llm.queries import QUERIES

    rows = QUERIES["op10_token_files"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    library, at = Tokenizer.from_file(PATH), 0
    got = {r["doc_id"]: r for r in rows}
    for doc in sorted(docs, key=lambda d: d["doc_id"]):
        ids = np.array([*library.encode(doc["text"], add_special_tokens=False).ids, 0], "<u4")
        want = (doc["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        assert tuple(got[doc["doc_id"]]) == want
        at += len(ids)
