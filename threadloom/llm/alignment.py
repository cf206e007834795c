"""Alignment of two tokenizers' tokens over the bytes of the same texts, and corpus-wide link counts.

A is a byte-level vocabulary of the tokenizers library, B a sentencepiece vocabulary with byte
fallback. A reads the text with a space in front, B adds that space itself. Places where tokens of
both end cut a text into groups; the last A token and the last B token of a group end together and
are linked.

Most groups are one A token and one B token of the same bytes. For these an array made once gives
the B id of every A id, so a group is known by its A id alone: each task counts them in one vector as
long as the vocabulary and hands on the vector. Only links of irregular groups become pairs that
are shuffled and counted by Spark.

Texts are cut where both tokenizers have a token's end whatever stands around: before a space that
follows another character than white space, if no B piece goes across such a place. Equal units are
aligned once and kept in a bounded store.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.bpe import byte_letters
from threadloom.llm.common import cut, map_batches, part_number

# Units of one generation; two are kept. This bounds memory and changes no result.
GENERATION = 200_000

# The place between two units of a text.
UNIT_END = re.compile(r"(?<=\S)(?= )")
SPACE_MARK = "▁"
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# Links as numbers: the A id above, the B id below.
ID_BITS = 32

ALIGNED = (
    "row long, n_a long, n_b long, n_groups long, n_links long, groups string, "
    "same array<int>, same_times array<long>, pairs array<long>, pair_times array<long>"
)
LISTS = ("same", "same_times", "pairs", "pair_times")


class Aligner:
    """Two vocabularies and their identity map."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        # their strings in a text are ordinary text
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self._bytes_a(path_a)
        self.bytes_b = self._bytes_b()
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        crossing = re.compile(f"[^{SPACE_MARK}]{SPACE_MARK}")
        self.cuts = not any(crossing.search(piece) for piece in pieces)
        # a piece of its own comes before a byte piece of the same bytes
        by_bytes: dict[bytes, int] = {}
        for i in sorted(range(len(self.bytes_b)), key=lambda i: self.b.is_byte(i)):
            if not self.b.is_control(i) and not self.b.is_unknown(i):
                by_bytes.setdefault(self.bytes_b[i], i)
        self.same = [by_bytes.get(data, -1) for data in self.bytes_a]
        self.space = self.b.piece_to_id(SPACE_MARK)
        self.store: dict[str, tuple | None] = {}
        self.older: dict[str, tuple | None] = {}

    def _bytes_a(self, path: str) -> list[bytes]:
        """The bytes of every A id."""
        letters = {letter: byte for byte, letter in byte_letters().items()}
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        found = [b""] * (max(self.a.get_vocab_size(), *vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(letter in letters for letter in token):
                found[i] = bytes(letters[letter] for letter in token)
        return found

    def _bytes_b(self) -> list[bytes]:
        """The bytes of every B id."""
        found = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            found.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE_MARK, " ").encode())
        return found

    def units(self, text: str) -> list[str]:
        """The text with a space in front, cut into units that each begin with a space."""
        whole = " " + text
        return UNIT_END.split(whole) if self.cuts else [whole]

    def aligned(self, unit: str, a: list[int], b: list[int]) -> tuple | None:
        """Number of A and of B tokens, groups as text, A ids of identity groups and links of all
        others; None if either side's bytes differ from the unit's."""
        data = unit.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != data or b"".join(map(self.bytes_b.__getitem__, b)) != data:
            return None
        ends_a = list(accumulate(len(self.bytes_a[i]) for i in a))
        ends_b = list(accumulate(len(self.bytes_b[i]) for i in b))
        if ends_a == ends_b:
            shared = range(len(a))
            at_a = at_b = list(shared)
        else:
            places = {end: j for j, end in enumerate(ends_b)}
            both = [(i, places[end]) for i, end in enumerate(ends_a) if end in places]
            at_a, at_b = [i for i, _ in both], [j for _, j in both]
        groups, same, pairs = [], [], []
        from_a = from_b = 0
        for i, j in zip(at_a, at_b, strict=True):
            last_a, last_b = a[i], b[j]
            if i == from_a and j == from_b:
                groups.append(f"{last_a}|{last_b}")
            else:
                groups.append(f"{','.join(map(str, a[from_a:i + 1]))}|{','.join(map(str, b[from_b:j + 1]))}")
            if i == from_a and j == from_b and self.same[last_a] == last_b:
                same.append(last_a)
            else:
                pairs.append(last_a << ID_BITS | last_b)
            from_a, from_b = i + 1, j + 1
        return len(a), len(b), ";".join(groups), tuple(same), tuple(pairs)

    def known(self, units: set[str]) -> dict[str, tuple | None]:
        """The store, with these units in it."""
        if len(self.store) > GENERATION:
            self.store, self.older = {}, self.store
        store, older, missing = self.store, self.older, []
        for unit in units.difference(store):
            if unit in older:
                store[unit] = older[unit]
            else:
                missing.append(unit)
        if missing:
            a = self.a.encode_batch_fast(missing, add_special_tokens=False)
            b = self.b.encode([unit[1:] for unit in missing], num_threads=1)
            for unit, ids, pieces in zip(missing, a, b, strict=True):
                # B adds no space to an empty text
                store[unit] = self.aligned(unit, ids.ids, pieces if unit != " " else [self.space])
        return store


def _counted(numbers: list[int], dtype: type) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.array(numbers, dtype), return_counts=True)


def align(
    df: DataFrame, path_a: str, path_b: str, *, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Every row's ``key`` and alignment; see :data:`ALIGNED`. Other columns are not looked at.

    ``row`` numbers the rows. ``groups`` is the text ``a1,a2|b1;a3|b2,b3``: the decimal ids of A and of B in
    order, group by group. ``same`` and ``same_times`` count the A ids of identity groups, ``pairs`` and
    ``pair_times`` the links of irregular ones. A null or empty text, and one whose A or B bytes
    joined are not the text with a space in front, has zeros and empty values. Whole texts are
    aligned; repeated rows are aligned each; keys may be null.

    Besides, each task adds one row whose ``row`` is null: its vector of identity groups, as the
    ``pairs`` it met and ``pair_times``. The table is empty only if ``df`` has no partition.
    """
    docs = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        aligner = Aligner(path_a, path_b)
        vector = np.zeros(len(aligner.same), np.int64)
        number = part_number() << 32
        for keys, texts in batches:
            cuts = [aligner.units(body) if body else [] for body in texts]
            known = aligner.known(set(chain.from_iterable(cuts)))
            rows = []
            for units in cuts:
                found = [*map(known.__getitem__, units)]
                row = (0, 0, 0, 0, "", [], [], [], [])
                if found and None not in found:
                    n_a, n_b, groups, same, pairs = zip(*found, strict=True)
                    ids, times = _counted(same, np.int32)
                    links, link_times = _counted(pairs, np.int64)
                    vector[ids] += times
                    n = int(times.sum() + link_times.sum())
                    row = (sum(n_a), sum(n_b), n, n, ";".join(groups), ids, times, links, link_times)
                rows.append((number, *row))
                number += 1
            yield (keys, *map(list, zip(*rows, strict=True)))
        ids = np.flatnonzero(vector)
        links = ids << ID_BITS | np.array(aligner.same)[ids]
        yield ([None], [None], *[[0]] * 4, [""], [[]], [[]], [links], [vector[ids]])

    kind = docs.schema["key"].dataType.simpleString()
    return map_batches(docs, task, f"key {kind}, {ALIGNED}")


def _counted(numbers: tuple[tuple[int, ...], ...], dtype: type) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.array([*chain.from_iterable(numbers)], dtype), return_counts=True)


def _entries(aligned: DataFrame, *columns) -> DataFrame:
    """A row for each counted pair of each row: ``pair`` and ``times``."""
    entry = F.explode(F.arrays_zip("pairs", "pair_times")).alias("entry")
    exploded = aligned.select(*columns, entry)
    names = exploded.columns[:-1]
    return exploded.select(*names, F.col("entry.pairs").alias("pair"), F.col("entry.pair_times").alias("times"))


def link_counts(aligned: DataFrame) -> DataFrame:
    """How many links hold each id pair linked, over all rows: ``pair``, its ids ``a`` and ``b``,
    ``n``, ``same`` for identity pairs, and ``best`` where no other pair of its ``b`` has more.

    Vectors and irregular links are added up by pair, before the shuffle too.
    """
    entries = _entries(aligned, F.col("row").isNull().alias("same"))
    counted = entries.groupBy("pair").agg(F.sum("times").alias("n"), F.max("same").alias("same"))
    a = F.shiftright("pair", ID_BITS).cast("int").alias("a")
    b = F.col("pair").bitwiseAND((1 << ID_BITS) - 1).cast("int").alias("b")
    # a window holds the pairs of one B id, as many as A has ids at most
    most = F.max("n").over(Window.partitionBy("b"))
    return counted.select("pair", a, b, "n", "same").withColumn("best", F.col("n") == most)


def score(aligned: DataFrame) -> DataFrame:
    """What :func:`align` gives, without its lists and with ``n_best``, the number of links whose
    count is the highest of their B id in the corpus, ties included, and ``count_sum``, the counts
    of all links added up. Columns added to the alignment stay.

    The counts of identity pairs come back to the rows as an array as long as A's vocabulary, those
    of irregular links by a join on the pair.
    """
    aligned = cut(aligned, "aligned")
    counts = cut(link_counts(aligned), "link-counts")
    # one row for each A id at most
    own = counts.where("same").select("a", "n", "best").collect()
    weights = np.zeros((2, max((r["a"] for r in own), default=0) + 1), np.int64)
    for r in own:
        weights[:, r["a"]] = r["best"], r["n"]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, times = batch.column("same"), batch.column("same_times")
            lengths = ids.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            ids, times = ids.flatten().to_numpy(), times.flatten().to_numpy()
            running = np.cumsum(weights[:, ids] * times, axis=1)
            n_best, total = np.diff(np.pad(running, ((0, 0), (1, 0)))[:, ends])
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(n_best), pa.array(total)], [*kept, "n_best", "count_sum"]
            )

    kept = [c for c in aligned.columns if c not in LISTS]
    rows = aligned.where("row IS NOT NULL")
    slim = rows.select(*kept, "same", "same_times")
    schema = slim.select(*kept, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")).schema
    regular = slim.mapInArrow(sums, schema)
    pair_counts = counts.select("pair", "n", "best")
    irregular = (
        _entries(rows, "row")
        .join(pair_counts, "pair")
        .groupBy(F.col("row").alias("_row"))
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
            F.sum(F.col("times") * F.col("n")).alias("_sum"),
        )
    )
    added = lambda name, more: (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)
    joined = regular.join(irregular, regular["row"] == irregular["_row"], "left")
    return joined.select(*kept, added("n_best", "_best"), added("count_sum", "_sum")).drop("row")
