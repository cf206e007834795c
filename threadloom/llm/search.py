"""Exact top-k search by BM25: inverted index in shards, blocks by falling bound, exact merge.

A shard indexes about 1 MB of whole texts: for every term its postings by document place, and for
every block of 32 places in which the term occurs, its greatest number of occurrences and the
least length of such a document. These bound the term's share of any score in the block.

A query adds up its terms' bounds for every block and scores blocks from the highest bound down.
It stops when no bound left can reach the k-th best score so far, so the result is exact. Document
frequencies and lengths are summed over all shards first, which makes scores comparable, and the
shards' best k are merged.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import cut, map_batches, part_number, text_of

K1, B = 1.2, 0.75
BLOCK_BITS = 5
# Text and documents of one shard; queries that go through the shards together.
SHARD_BYTES, SHARD_DOCS = 1 << 20, 1 << 14
QUERIES_TOGETHER = 4096

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

INDEX = (
    "shard long, tokens long, keys array<long>, lengths binary, terms array<string>, term_starts binary, "
    "blocks binary, most binary, shortest binary, block_starts binary, places binary, times binary"
)


def terms_of(text: str) -> list[bytes]:
    """ASCII letters, lower-cased, and digits and all other letters, in runs."""
    return TERM.findall(text.encode().lower())


def packed(values: np.ndarray) -> bytes:
    return values.astype("<i4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4")


def shard_of(number: int, keys: list, texts: list[list[bytes]]) -> tuple:
    """One shard's row: postings by term, then by place, and the blocks' bounds."""
    known: dict[bytes, int] = {}
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.fromiter(
        (known.setdefault(t, len(known)) for terms in texts for t in terms), np.int64, lengths.sum()
    )
    size = len(texts)
    pairs, times = np.unique(codes * size + np.repeat(np.arange(size), lengths), return_counts=True)
    code, place = np.divmod(pairs, size)
    cells = (code << 32) + (place >> BLOCK_BITS)
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(cells) else cells
    if len(starts):
        most = np.maximum.reduceat(times, starts)
        shortest = np.minimum.reduceat(lengths[place], starts)
    else:
        most = shortest = starts
    term_starts = np.searchsorted(code[starts], np.arange(len(known) + 1))
    return (
        [number], [int(lengths.sum())], [keys], [packed(lengths)], [[t.decode() for t in known]], [packed(term_starts)],
        [packed(place[starts] >> BLOCK_BITS)], [packed(most)], [packed(shortest)],
        [packed(np.append(starts, len(place)))], [packed(place)], [packed(times)],
    )


def build_index(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The index of all rows, one row per shard. A null text has no terms; repeated rows are
    indexed each; null keys are kept."""

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        names, bodies, size, number = [], [], 0, part_number() << 32
        for keys, texts in batches:
            for name, body in zip(keys, texts, strict=True):
                names.append(name)
                bodies.append(terms_of(body))
                size += len(body)
                if size >= SHARD_BYTES or len(names) >= SHARD_DOCS:
                    yield shard_of(number, names, bodies)
                    names, bodies, size, number = [], [], 0, number + 1
        if names:
            yield shard_of(number, names, bodies)

    docs = df.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return map_batches(docs, task, INDEX)


class Shard:
    """A shard's row, with the weights of a set of query terms."""

    def __init__(self, row: dict, weights: dict[str, float], average: float):
        self.keys, self.average = row["keys"].as_py(), average
        self.lengths = unpacked(row["lengths"].as_py()).astype(np.float64)
        names = ("blocks", "most", "shortest", "block_starts", "places", "times")
        self.blocks, self.most, self.shortest, self.starts, self.places, self.times = (
            unpacked(row[n].as_py()) for n in names
        )
        term_starts = unpacked(row["term_starts"].as_py())
        terms = row["terms"].values
        wanted = pc.is_in(terms, value_set=pa.array(sorted(weights), pa.string()))
        self.cells, self.bounds, self.weights = {}, {}, weights
        for i in np.flatnonzero(wanted.to_numpy(zero_copy_only=False)):
            a, b = int(term_starts[i]), int(term_starts[i + 1])
            term = terms[int(i)].as_py()
            self.cells[term] = a, b
            self.bounds[term] = weights[term] * self.share(self.most[a:b], self.shortest[a:b])

    def share(self, times: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A term's part of a score, but for its weight: grows with times, falls with length."""
        return times * (K1 + 1) / (times + K1 * (1 - B + B * lengths / self.average))

    def best(self, query: list[tuple[str, int]], k: int) -> list[tuple[float, int | None]]:
        """The ``k`` best documents as score and key, and no others."""
        here = [(t, n) for t, n in query if t in self.cells]
        if not here:
            return []
        limit = np.zeros((len(self.keys) >> BLOCK_BITS) + 1)
        for term, n in here:
            a, b = self.cells[term]
            limit[self.blocks[a:b]] += n * self.bounds[term]
        limit *= 1 + 1e-9  # sums in another order may differ in their last digits
        heap: list = []
        for block in np.argsort(-limit, kind="stable"):
            if limit[block] <= 0 or (len(heap) == k and limit[block] < heap[0][0]):
                break
            first = int(block) << BLOCK_BITS
            scores = np.zeros(min(1 << BLOCK_BITS, len(self.keys) - first))
            for term, n in here:
                a, b = self.cells[term]
                cell = a + int(np.searchsorted(self.blocks[a:b], block))
                if cell == b or self.blocks[cell] != block:
                    continue
                part = slice(self.starts[cell], self.starts[cell + 1])
                places = self.places[part]
                share = self.share(self.times[part], self.lengths[places])
                scores[places - first] += n * self.weights[term] * share
            for place in np.flatnonzero(scores > 0):
                key = self.keys[first + place]
                # equal scores: the smaller key is better, a null one best
                entry = (float(scores[place]), key is None, -(key or 0), int(place))
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        return [(score, None if none else -key) for score, none, key, _ in heap]


def _searched(index: DataFrame, queries: dict[int, list[tuple[str, int]]], k: int) -> DataFrame:
    """The shards' best for a block of queries, given as term counts."""
    wanted = sorted({t for terms in queries.values() for t, _ in terms})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value_set, found = pa.array(wanted, pa.string()), Counter()
        for batch in batches:
            for i in range(batch.num_rows):
                terms = batch.column("terms")[i].values
                term_starts = unpacked(batch.column("term_starts")[i].as_py())
                starts = unpacked(batch.column("block_starts")[i].as_py())
                for j in np.flatnonzero(pc.is_in(terms, value_set=value_set).to_numpy(zero_copy_only=False)):
                    n = starts[term_starts[j + 1]] - starts[term_starts[j]]
                    found[terms[int(j)].as_py()] += int(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["term", "n"]
        )

    size, length = index.agg(F.sum(F.size("keys").cast("long")), F.sum("tokens")).first()
    # no more rows than the block's queries have terms
    rows = index.select("terms", "term_starts", "block_starts").mapInArrow(frequencies, "term string, n long")
    counts = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    weights = {t: float(np.log1p((size - n + 0.5) / (n + 0.5))) for t, n in counts.items()}
    average = (length or 0) / size if size and length else 1.0

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                shard = Shard(row, weights, average)
                found = [
                    (q, key, score) for q, terms in queries.items() for score, key in shard.best(terms, k)
                ]
                if found:
                    columns = zip(*found, strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.float64())
                    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names=["query_id", "doc_id", "score"])

    return index.drop("shard", "tokens").mapInArrow(search, "query_id long, doc_id long, score double")


def top_k(
    df: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    text: str = "text",
    key: str = "doc_id",
    query_key: str = "query_id",
    query_text: str = "query",
) -> DataFrame:
    """The ``k`` best rows of ``df`` for every query: ``query_id``, ``rank``, ``doc_id``, ``score``.

    Rows that share no term with a query are never among them, so there may be fewer. Of equal
    scores the smaller key comes first, a null one before all. A term counts as often as the query
    has it. Null or empty queries find nothing; repeated query keys are an error. Queries are
    taken in blocks of about :data:`QUERIES_TOGETHER`; what reaches the driver is a block's terms.
    """
    index = cut(build_index(df, text, key), "index")
    asked = queries.select(
        F.col(query_key).cast("long").alias("id"), text_of(query_text).alias("query")
    )
    turns = max(1, -(-asked.count() // QUERIES_TOGETHER))
    turn = F.pmod(F.xxhash64("id"), F.lit(turns))
    found = []
    for number in range(turns):
        block = asked.where(turn == number).collect()
        terms = {r["id"]: sorted(Counter(t.decode() for t in terms_of(r["query"])).items()) for r in block}
        if len(terms) < len(block):
            raise ValueError("query keys repeat")
        found.append(cut(_searched(index, terms, k), "shard-results") if turns > 1 else _searched(index, terms, k))
    # Spark keeps k rows of a query in each task before they meet
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")
