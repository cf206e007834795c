"""Exact top-k search on impact lists by the Best Position Algorithm.

A shard holds about 4 MB of whole texts. It keeps, for every term, its documents from the highest
impact down; an impact is the term's part of a document's score before the term's weight, so it is
fixed when the index is written, from the corpus counts taken first.

A query reads its terms' lists side by side from the top. A document met in one list is looked up
in all the others at once, which gives its whole score and its position in each list. Positions so
known count as seen, whichever list the document was met in. The best position of a list is the
last one before which, and at which, all are seen, so what no list has shown yet stands behind the
best position of every list, and the weighted impacts there bound its score. Last-read positions,
which are never further, would bound it less tightly. A shard stops when that bound is strictly
below its k-th best score (an equal score could still win by its smaller id) or when nothing is
unseen. The shards' best are merged; all weights are the corpus's, so the result is exact.

All arithmetic is on integers but for the logarithm in a term's weight.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import cut, map_batches, part_number, text_of
from threadloom.schemas import ROW_ID
from threadloom.sources import with_row_id

# Text and documents of one shard, and query text that goes through the shards together.
SHARD_BYTES, SHARD_DOCS = 4 << 20, 1 << 14
QUERY_BYTES = 1 << 20

# Positions read from each list in the first step; every step reads twice as many.
FIRST_READ = 8

# A term is a longest run of ASCII letters, digits and code points from 128 on.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Room for an impact (below a million) and a place in the numbers that sort a shard's postings.
IMPACT_BITS, PLACE_BITS = 20, 14

# A row is one term's list: places and impacts as 32-bit integers. The row whose term is empty
# holds the shard's document keys by place, as 64-bit integers, and marks null keys by a byte 1.
INDEX = "shard long, term string, n int, places binary, impacts binary"
FOUND = "query long, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text, only A-Z lower-cased."""
    return TERM.findall(text.encode().lower())


def term_column(text: Column) -> Column:
    """:func:`terms_of` as a Spark column."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(TERM_PATTERN), F.lit(0))


def corpus_counts(df: DataFrame, text: str) -> tuple[int, int]:
    """Documents with a term, and terms in all with repeats."""
    size = F.regexp_count(text_of(text), F.lit(TERM_PATTERN)).cast("long")
    n, total = df.agg(F.count_if(size > 0), F.sum(size)).first()
    return n, total or 0


def binaries(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values; stretch ``i`` ends where ``i + 1`` begins."""
    offsets = (starts * values.itemsize).astype("<i4")
    data = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def shard_rows(number: int, keys: list, texts: list[list[bytes]], n_docs: int, n_terms: int) -> tuple:
    """One shard's rows, in the order of :data:`INDEX`."""
    known: dict[bytes, int] = {}
    size = len(texts)
    lengths = np.fromiter(map(len, texts), np.int64, size)
    codes = np.fromiter((known.setdefault(t, len(known)) for terms in texts for t in terms), np.int64, lengths.sum())
    pairs, times = np.unique(codes * size + np.repeat(np.arange(size), lengths), return_counts=True)
    code, place = np.divmod(pairs, size)
    # whole numbers of any size: n * N may need more than 64 bits
    norms = np.array([100 - 75 + 75 * int(n) * n_docs // max(n_terms, 1) for n in lengths], np.int64)
    impacts = 1_000_000_000 * times // (1000 * times + 8 * norms[place])
    turned = (1 << IMPACT_BITS) - 1 - impacts
    order = np.sort((((code << IMPACT_BITS) + turned) << PLACE_BITS) + place)
    place = (order & ((1 << PLACE_BITS) - 1)).astype("<i4")
    order >>= PLACE_BITS
    impacts = ((1 << IMPACT_BITS) - 1 - (order & ((1 << IMPACT_BITS) - 1))).astype("<i4")
    starts = np.searchsorted(order >> IMPACT_BITS, np.arange(len(known) + 1))
    counts = np.diff(starts).astype("<i4")
    named = np.array([key or 0 for key in keys], "<i8").tobytes()
    nulls = bytes(key is None for key in keys)
    return (
        pa.array(np.full(len(known) + 1, number)),
        pa.array(["", *(t.decode() for t in known)], pa.string()),
        pa.concat_arrays([pa.array([size], pa.int32()), pa.array(counts)]),
        pa.concat_arrays([pa.array([named], pa.binary()), binaries(place, starts)]),
        pa.concat_arrays([pa.array([nulls], pa.binary()), binaries(impacts, starts)]),
    )


def build_index(df: DataFrame, *, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, int]:
    """The index of all rows, a row for each term of each shard, and the number of documents with a
    term. Whole texts count; a null text has no terms; repeated rows are indexed each."""
    n_docs, n_terms = corpus_counts(df, text)

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        names, bodies, size, number = [], [], 0, part_number() << 32
        for keys, texts in batches:
            for name, body in zip(keys, texts, strict=True):
                terms = terms_of(body)
                if not terms:
                    continue
                names.append(name)
                bodies.append(terms)
                size += len(body)
                if size >= SHARD_BYTES or len(names) >= SHARD_DOCS:
                    yield shard_rows(number, names, bodies, n_docs, n_terms)
                    names, bodies, size, number = [], [], 0, number + 1
        if names:
            yield shard_rows(number, names, bodies, n_docs, n_terms)

    docs = df.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    return cut(map_batches(docs, task, INDEX), "impact-lists"), n_docs


class Shard:
    """The lists of a shard that some query wants, joined into one array from the top of each."""

    def __init__(self, size: int, lists: list[tuple[bytes, bytes]]):
        self.size = size
        self.lengths = np.array([len(places) // 4 for places, _ in lists], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.places = np.frombuffer(b"".join(p for p, _ in lists), "<i4").astype(np.int64)
        self.impacts = np.frombuffer(b"".join(i for _, i in lists), "<i4").astype(np.int64)
        # direct access: where the entry of a list and a place is
        cells = np.repeat(np.arange(len(lists)), self.lengths) * size + self.places
        self.where = np.argsort(cells)
        self.cells = cells[self.where]
        self.seen = np.zeros(len(cells), bool)
        self.reads = 0

    def lookup(self, lists: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entries of every list for every place, and whether there is one."""
        wanted = lists[:, None] * self.size + places
        at = np.minimum(np.searchsorted(self.cells, wanted), len(self.cells) - 1)
        return self.where[at], self.cells[at] == wanted

    def best(self, lists: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all documents that may be among the ``k`` best: every one whose
        score reaches the k-th best of the shard is there."""
        starts, lengths = self.starts[lists], self.lengths[lists]
        met = np.zeros(self.size, bool)
        best_positions = np.zeros(len(lists), np.int64)
        found_places, found_scores, marked = [], [], []
        depth, step = 0, FIRST_READ
        top = np.zeros(0, np.int64)
        while True:
            read = np.arange(depth, depth + step)
            entries = (starts[:, None] + read)[read < lengths[:, None]]
            self.reads += len(entries)
            places = np.unique(self.places[entries])
            places = places[~met[places]]
            if len(places):
                met[places] = True
                entries, there = self.lookup(lists, places)
                scores = (np.where(there, self.impacts[entries], 0) * weights[:, None]).sum(axis=0)
                marked.append(entries[there])
                self.seen[marked[-1]] = True
                found_places.append(places)
                found_scores.append(scores)
                top = np.sort(np.concatenate([top, scores]))[-k:]
            depth, step = depth + step, 2 * step
            bound = 0
            for i, (start, length) in enumerate(zip(starts, lengths, strict=True)):
                rest = self.seen[start + best_positions[i] : start + length]
                gap = int(rest.argmin()) if len(rest) else 0
                if len(rest) and rest[gap]:
                    gap = len(rest)
                best_positions[i] += gap
                if best_positions[i] < length:
                    # the first unseen entry: nothing unseen has more in this list
                    bound += int(weights[i]) * int(self.impacts[start + best_positions[i]])
            if bound == 0 or (len(top) == k and bound < top[0]):
                break
        for entries in marked:
            self.seen[entries] = False
        return np.concatenate(found_places), np.concatenate(found_scores)


def _search_shard(rows: pa.Table, k: int) -> pa.Table:
    """The ``k`` best of one shard for every query of a block."""
    keys, nulls, lists, queries = np.zeros(0, "<i8"), np.zeros(0, np.uint8), [], defaultdict(list)
    for term, places, impacts, weight, uses in zip(
        *(rows[c].to_pylist() for c in ("term", "places", "impacts", "weight", "uses")), strict=True
    ):
        if not term:
            keys, nulls = np.frombuffer(places, "<i8"), np.frombuffer(impacts, np.uint8)
            continue
        for use in uses:
            queries[use["query"]].append((len(lists), weight * use["times"]))
        lists.append((places, impacts))
    shard = Shard(len(keys), lists)
    out: list[list[np.ndarray]] = [[], [], []]
    for query, terms in queries.items():
        numbers, weights = np.array(terms, np.int64).T
        places, scores = shard.best(numbers, weights, k)
        # a null key comes before all others
        order = np.lexsort((keys[places], nulls[places] == 0, -scores))[:k]
        order = order[scores[order] > 0]
        out[0].append(np.full(len(order), query))
        out[1].append(places[order])
        out[2].append(scores[order])
    query, place, score = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in out)
    doc_id = pa.array(keys[place], pa.int64(), mask=nulls[place] == 1)
    return pa.table([pa.array(query, pa.int64()), doc_id, pa.array(score, pa.int64())], ["query", "doc_id", "score"])


def _search_block(index: DataFrame, n_docs: int, asked: DataFrame, small: bool, k: int) -> DataFrame:
    """The shards' best for a block of queries, given as ``query`` and ``text``."""
    mark = F.broadcast if small else (lambda df: df)
    terms = asked.select("query", F.explode(term_column(F.col("text"))).alias("term"))
    times = terms.groupBy("query", "term").agg(F.count("*").alias("times"))
    uses = times.groupBy("term").agg(F.collect_list(F.struct("query", "times")).alias("uses"))
    uses = cut(uses, "query-terms")
    holders = index.select("term", "n").join(mark(uses.select("term")), "term")
    frequencies = holders.groupBy("term").agg(F.sum("n").alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1)
    weighed = uses.join(frequencies, "term").select(
        "term", F.floor(1000 * F.log(ratio)).cast("long").alias("weight"), "uses"
    )
    # a term in nearly all documents weighs nothing, and its long lists stay where they are
    no_uses = F.lit(None).cast(weighed.schema["uses"].dataType)
    documents = asked.sparkSession.range(1).select(
        F.lit("").alias("term"), F.lit(0).cast("long").alias("weight"), no_uses.alias("uses")
    )
    wanted = cut(weighed.where("weight > 0").unionByName(documents), "weighed-terms")
    rows = index.select("shard", "term", "places", "impacts").join(mark(wanted), "term")
    return rows.groupBy("shard").applyInArrow(lambda table: _search_shard(table, k), FOUND)


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
    """The ``k`` best rows of ``df`` for every row of ``queries``: ``query_id``, ``rank``,
    ``doc_id``, ``score``.

    Every query row is a query of its own, also where keys repeat or are null. Rows that have none of
    its terms, or only such as weigh nothing, are never found, so there may be fewer than ``k``. Of
    equal scores the smaller key comes first, a null one before all; of equal rows each counts. Null
    or empty queries find nothing. Other columns of both tables are not looked at. Queries go
    through the shards in blocks of about :data:`QUERY_BYTES` of text; nothing of them or of the
    index reaches the driver but counts.
    """
    spark = df.sparkSession
    index, n_docs = build_index(df, text=text, key=key)
    named = queries.select(F.col(query_key).alias("query_id"), text_of(query_text).alias("text"))
    named = with_row_id(cut(named, "queries")).withColumnRenamed(ROW_ID, "query")
    n_bytes, longest = named.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    blocks = max(1, -(-(n_bytes or 0) // QUERY_BYTES))
    # terms take less room than their text, so this bounds what is broadcast
    small = (longest or 0) <= QUERY_BYTES
    found = []
    for block in range(blocks):
        asked = named.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        found.append(cut(_search_block(index, n_docs, asked, small, k), "shard-results"))
    merged = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], FOUND)
    # Spark keeps k rows of a query in each task before they meet
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(named.select("query", "query_id"), "query").select("query_id", "rank", "doc_id", "score")
