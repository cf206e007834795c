"""Harmonic packing of documents into sequences of fixed length.

Lengths fall into reciprocal classes: class ``j`` takes lengths above ``capacity / (j + 1)`` and
up to ``capacity / j``, and each of its sequences holds exactly ``j`` pieces. A document is first
cut into pieces of capacity, 1/2, 1/4, ... of it, which fill their classes' sequences exactly;
only a tail shorter than ``capacity / 16`` leaves a gap, below 1/17 of its sequence. Every worker
fills its own sequences, so nothing is shuffled.

What is left in a worker's unfinished sequences, fewer than ``j`` pieces for each class, is cut
into full sequences and then into lengths that are powers of two, which need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame

from threadloom.llm.common import map_batches, part_number, text_of
from threadloom.llm.token_ids import Encoder

CAPACITY = 2048
END_ID = 1
# Sequence numbers of one worker.
WORKER_ROOM = 1 << 40


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths to cut a document of ``n`` tokens into."""
    lengths = [capacity] * (n // capacity)
    rest, size = n % capacity, capacity // 2
    while size >= capacity // 16 and size > 0:
        if rest >= size:
            lengths.append(size)
            rest -= size
        size //= 2
    if rest:
        lengths.append(rest)
    return lengths


def harmonic(
    documents: Iterator[tuple], capacity: int = CAPACITY
) -> Iterator[tuple[list[tuple], int]]:
    """Sequences of pieces ``(document, start, ids)`` from ``(document, ids as bytes)``.

    Yields each sequence's pieces with the class number, 0 for what was left at the end.
    """
    open_pieces: dict[int, list] = defaultdict(list)
    for document, ids in documents:
        start = 0
        for length in piece_lengths(len(ids) // 4, capacity):
            kind = capacity // length
            held = open_pieces[kind]
            held.append((document, start, ids[4 * start : 4 * (start + length)]))
            start += length
            if len(held) == kind:
                yield held, kind
                del open_pieces[kind]
    left = [piece for kind in sorted(open_pieces) for piece in open_pieces[kind]]
    total = sum(len(ids) // 4 for _, _, ids in left)
    rooms = [capacity] * (total // capacity)
    rooms += [1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1]
    at = 0
    for room in rooms:
        sequence = []
        while room:
            document, start, ids = left[at]
            fits = min(room, len(ids) // 4)
            sequence.append((document, start, ids[: 4 * fits]))
            room -= fits
            if 4 * fits == len(ids):
                at += 1
            else:
                left[at] = (document, start + fits, ids[4 * fits :])
        yield sequence, 0


def pack(
    df: DataFrame,
    path: str,
    *,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``path`` is the tokenizer's file; each document ends with ``end_id``. One row per piece:
    ``doc_id``, ``start`` in its document, ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence, which has no gaps. A null or
    empty text is its end id alone. Repeated rows are packed each; null keys are kept; other
    columns are ignored.
    """
    kind = df.schema[key].dataType.simpleString()
    schema = (
        f"{key} {kind}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long"
    )
    end = end_id.to_bytes(4, "little")

    def task(batches):
        encoder = Encoder(path)

        def documents():
            for keys, texts in batches:
                for name, ids in zip(keys, encoder.encode(texts), strict=True):
                    yield (name, len(ids) // 4 + 1), ids + end

        rows, number = [], part_number() * WORKER_ROOM
        for sequence, _ in harmonic(documents(), capacity):
            offset = 0
            for (name, tokens), start, ids in sequence:
                length = len(ids) // 4
                rows.append((name, start, length, ids, tokens, number, offset))
                offset += length
            number += 1
            if len(rows) >= 1024:
                yield tuple(zip(*rows, strict=True))
                rows = []
        if rows:
            yield tuple(zip(*rows, strict=True))

    return map_batches(df.select(key, text_of(text).alias("text")), task, schema)
