"""Token ids in compressed files: an adaptive context-mixing range coder.

A block holds whole documents, is coded from a fresh model and carries checksums, so any block
can be read alone and damage is noticed. Its ids lie in up to 4096 lanes side by side, each with a
range coder of its own; the lanes advance together and share one model, so a step is a few array
operations.

For the next id the model names two candidates: the id that last followed the same two ids, and
the one that last followed the same id. Whether a candidate is right is a bit. Its probability
mixes what the order-2 slot, the order-1 slot and the order-0 average say, in the logistic domain,
with weights that are gated by whether the candidates agree and adapt as they go. Other ids are
coded by their order-0 frequencies so far. All arithmetic is on integers, so every machine decodes
what any machine wrote.

Files are Parquet, written by Spark's own committing writer to any store; a row is a block.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm.common import map_batches, part_number, text_of, width
from threadloom.llm.token_ids import kept_encoder

END_ID = 0
LANES, STEPS = 4096, 128
BLOCK_IDS = LANES * STEPS

# Model sizes and rates; part of the format.
HASH_BITS = 18
RATE = 4
WEIGHT_ONE = 1 << 16
WEIGHT_STEPS, FREQUENCY_STEPS = 4, 4
FREQUENCY_GAIN, FREQUENCY_LIMIT = 24, 1 << 24

# Odds of a 12-bit probability as logarithms in 1/256, and back.
STRETCH = np.array(
    [round(256 * math.log((2 * p + 1) / (8191 - 2 * p))) for p in range(4096)], np.int32
)
SQUASH = np.array(
    [min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)],
    np.int32,
)

TOP, BOTTOM, WORD = np.uint64(1 << 48), np.uint64(1 << 32), np.uint64(16)


class Mixer:
    """The probability that a candidate is right, learnt in contexts of order 2, 1 and 0."""

    def __init__(self, vocabulary: int):
        self.tables = [
            np.full(1 << HASH_BITS, 1 << 13, np.int32),
            np.full(vocabulary + 1, 1 << 13, np.int32),
            np.full(2, 1 << 13, np.int32),
        ]
        self.weights = np.full((3, 2), WEIGHT_ONE * 2 // 5, np.int64)
        self.steps = 0

    def predict(self, contexts: tuple[np.ndarray, ...]) -> np.ndarray:
        """12-bit probabilities; keeps what :meth:`learn` needs."""
        self.contexts = contexts
        # take() with a mode looks up much faster than brackets
        self.old = [t.take(c, mode="clip") for t, c in zip(self.tables, contexts, strict=True)]
        self.odds = [STRETCH.take(x >> 4, mode="clip") for x in self.old]
        gate = contexts[2]
        mixed = self.weights[0].take(gate, mode="clip") * self.odds[0]
        mixed += self.weights[1].take(gate, mode="clip") * self.odds[1]
        mixed += self.weights[2].take(gate, mode="clip") * self.odds[2]
        mixed >>= 16
        mixed += 2047
        self.p = SQUASH.take(mixed, mode="clip")
        return self.p

    def learn(self, bits: np.ndarray) -> None:
        target = bits * np.int32(65535)
        for table, context, old in zip(self.tables[:2], self.contexts[:2], self.old[:2], strict=True):
            table[context] = old + ((target - old) >> RATE)
        self.steps += 1
        if self.steps % WEIGHT_STEPS and len(bits) > 64:
            return
        error = bits * np.int64(4096) - self.p
        for gate in (0, 1):
            chosen = np.flatnonzero(self.contexts[2] == gate)
            if not len(chosen):
                continue
            missed = error[chosen]
            for i in range(3):
                slope = int((missed * self.odds[i][chosen]).sum()) // len(chosen)
                self.weights[i, gate] += slope // 64
            average = int(self.tables[2][gate])
            seen = 65535 * int(bits[chosen].sum()) // len(chosen)
            self.tables[2][gate] = average + (seen - average) // 8


class Model:
    """Candidates, mixers and frequencies of one block."""

    def __init__(self, vocabulary: int, lanes: int):
        self.vocabulary = vocabulary
        self.last = np.full(lanes, vocabulary, np.int64)
        self.before = np.full(lanes, vocabulary, np.int64)
        self.order2 = np.zeros(1 << HASH_BITS, np.int64)
        self.order1 = np.zeros(vocabulary + 1, np.int64)
        self.mixers = Mixer(vocabulary), Mixer(vocabulary)
        self.counts = np.ones(vocabulary, np.int64)
        self.waiting: list[np.ndarray] = []
        self.steps = 0
        self._sum()

    def _sum(self) -> None:
        self.ends = np.cumsum(self.counts)
        self.total = int(self.ends[-1])

    def candidates(self) -> tuple[np.ndarray, np.ndarray]:
        self.slot = (self.before * 40_503 + self.last * 2_654_435_761 >> 7) & (1 << HASH_BITS) - 1
        second, first = self.order2.take(self.slot, mode="clip"), self.order1.take(self.last, mode="clip")
        self.gate = (second == first).astype(np.int64)
        return second, first

    def contexts(self, lanes: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, ...]:
        return self.slot[lanes], self.last[lanes], self.gate[lanes]

    def update(self, ids: np.ndarray, coded: np.ndarray) -> None:
        """Take in a step's ids; ``coded`` are those coded by frequency."""
        self.order2[self.slot] = ids
        self.order1[self.last] = ids
        self.before, self.last = self.last, ids
        self.waiting.append(coded)
        self.steps += 1
        if self.steps % FREQUENCY_STEPS == 0:
            seen = np.bincount(np.concatenate(self.waiting), minlength=self.vocabulary)
            self.counts += FREQUENCY_GAIN * seen
            self.waiting = []
            if self.counts.sum() > FREQUENCY_LIMIT:
                self.counts = (self.counts >> 1) + 1
            self._sum()


class Coder:
    """One carry-less range coder for each lane, with 16-bit words."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.at = np.zeros(lanes, np.int64)

    def _narrow(self, lanes: np.ndarray | slice, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Narrow the lanes' ranges to a part of them and shift out settled words."""
        low = self.low[lanes] + unit * start
        span = unit * size
        while True:
            settled = (low ^ (low + span)) < TOP
            short = ~settled & (span < BOTTOM)
            moving = np.flatnonzero(settled | short)
            if not len(moving):
                break
            if short.any():
                span = np.where(short, (~low + np.uint64(1)) & (BOTTOM - np.uint64(1)), span)
            settled_low = low[moving]
            self._shift(moving if isinstance(lanes, slice) else lanes[moving], settled_low)
            low[moving] = settled_low << WORD
            span[moving] <<= WORD
        self.low[lanes], self.range[lanes] = low, span


class Writer(Coder):
    def __init__(self, lanes: int, steps: int):
        super().__init__(lanes)
        self.lengths = length_type(steps)
        self.words = np.zeros((lanes, 2 * steps + 8), np.uint16)

    def _shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        if self.at.max() + 2 > self.words.shape[1]:
            self.words = np.pad(self.words, ((0, 0), (0, self.words.shape[1])))
        self.words[lanes, self.at[lanes]] = (low >> np.uint64(48)).astype(np.uint16)
        self.at[lanes] += 1

    def bits(self, lanes: np.ndarray | slice, bits: np.ndarray, p: np.ndarray) -> None:
        """Code bits whose probabilities of 1 are ``p`` of 4096."""
        unit, ones = self.range[lanes] >> np.uint64(12), p.astype(np.uint64)
        start = np.where(bits, np.uint64(0), ones)
        self._narrow(lanes, unit, start, np.where(bits, ones, np.uint64(4096) - ones))

    def ids(self, lanes: np.ndarray, ids: np.ndarray, model: Model) -> None:
        unit = self.range[lanes] // np.uint64(model.total)
        size = model.counts[ids]
        start = (model.ends[ids] - size).astype(np.uint64)
        self._narrow(lanes, unit, start, size.astype(np.uint64))

    def finish(self) -> bytes:
        """Lengths of the lanes, then their words: two more settle each range."""
        lanes = np.arange(len(self.low))
        end = ((self.low + (BOTTOM - np.uint64(1))) >> np.uint64(32)) << np.uint64(32)
        for _ in range(2):
            self._shift(lanes, end)
            end <<= WORD
        used = np.arange(self.words.shape[1])[None, :] < self.at[:, None]
        return self.at.astype(self.lengths).tobytes() + self.words[used].astype("<u2").tobytes()


class Reader(Coder):
    def __init__(self, lanes: int, steps: int, payload: bytes):
        super().__init__(lanes)
        stored = np.frombuffer(payload, length_type(steps), lanes)
        lengths = stored.astype(np.int64)
        self.words = np.frombuffer(payload, "<u2", offset=stored.nbytes)
        # reading past a lane's end gives zeros
        self.words = np.append(self.words, np.uint16(0)).astype(np.uint64)
        self.ends = np.cumsum(lengths)
        self.at = self.ends - lengths
        self.code = np.zeros(lanes, np.uint64)
        every = np.arange(lanes)
        for _ in range(4):
            self._shift(every, None)

    def _shift(self, lanes: np.ndarray, low: np.ndarray | None) -> None:
        at = self.at[lanes]
        word = self.words[np.where(at < self.ends[lanes], at, -1)]
        self.code[lanes] = (self.code[lanes] << WORD) | word
        self.at[lanes] = at + 1

    def bits(self, lanes: np.ndarray | slice, p: np.ndarray) -> np.ndarray:
        unit, ones = self.range[lanes] >> np.uint64(12), p.astype(np.uint64)
        bits = (self.code[lanes] - self.low[lanes]) < unit * ones
        start = np.where(bits, np.uint64(0), ones)
        self._narrow(lanes, unit, start, np.where(bits, ones, np.uint64(4096) - ones))
        return bits

    def ids(self, lanes: np.ndarray, model: Model) -> np.ndarray:
        unit = self.range[lanes] // np.uint64(model.total)
        value = ((self.code[lanes] - self.low[lanes]) // unit).astype(np.int64)
        ids = np.searchsorted(model.ends, np.minimum(value, model.total - 1), side="right")
        size = model.counts.take(ids, mode="clip")
        start = (model.ends.take(ids, mode="clip") - size).astype(np.uint64)
        self._narrow(lanes, unit, start, size.astype(np.uint64))
        return ids


def length_type(steps: int) -> str:
    """How the lanes' numbers of words are stored."""
    return "<u2" if steps < 8192 else "<u4"


def shape_of(n: int) -> tuple[int, int]:
    """Lanes and steps of a block of ``n`` ids."""
    lanes = min(LANES, -(-n // STEPS))
    return lanes, -(-n // lanes)


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """The payload of a block's ids, all below ``vocabulary``."""
    lanes, steps = shape_of(len(ids))
    grid = np.zeros(lanes * steps, np.int64)
    grid[: len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model, writer, every = Model(vocabulary, lanes), Writer(lanes, steps), slice(None)
    for step in grid:
        second, first = model.candidates()
        right = step == second
        writer.bits(every, right, model.mixers[0].predict(model.contexts()))
        model.mixers[0].learn(right)
        other = np.flatnonzero(~right & (model.gate == 0))
        if len(other):
            also = step[other] == first[other]
            writer.bits(other, also, model.mixers[1].predict(model.contexts(other)))
            model.mixers[1].learn(also)
            right[other] = also
        rest = np.flatnonzero(~right)
        if len(rest):
            writer.ids(rest, step[rest], model)
        model.update(step, step[rest])
    return writer.finish()


def decode_block(payload: bytes, n: int, vocabulary: int) -> np.ndarray:
    """The ids :func:`encode_block` was given."""
    lanes, steps = shape_of(n)
    grid = np.empty((steps, lanes), np.int64)
    model, reader, every = Model(vocabulary, lanes), Reader(lanes, steps, payload), slice(None)
    for t in range(steps):
        second, first = model.candidates()
        right = reader.bits(every, model.mixers[0].predict(model.contexts()))
        model.mixers[0].learn(right)
        step = second.copy()
        other = np.flatnonzero(~right & (model.gate == 0))
        if len(other):
            also = reader.bits(other, model.mixers[1].predict(model.contexts(other)))
            model.mixers[1].learn(also)
            right[other] = also
            step[other] = first[other]
        rest = np.flatnonzero(~right)
        if len(rest):
            step[rest] = reader.ids(rest, model)
        grid[t] = step
        model.update(step, step[rest])
    return np.ascontiguousarray(grid.T).reshape(-1)[:n].astype("<u4")


BLOCKS = (
    "part int, start long, n_ids long, doc_ids array<long>, doc_tokens array<long>, "
    "vocabulary int, payload binary, payload_crc32 long, ids_crc32 long"
)


def write_tokens(
    df: DataFrame,
    path: str,
    folder: str,
    *,
    end_id: int = END_ID,
    text: str = "text",
    key: str = "doc_id",
) -> None:
    """Encode all texts and write their ids to ``folder`` in ascending order of ``key``.

    ``path`` is the tokenizer's file. Every document ends with ``end_id``; a null or empty text is
    that alone. Files and the blocks in them follow the order; null keys come first, repeated rows
    are written each. A document is never divided between blocks.
    """
    end = end_id.to_bytes(4, "little")

    def blocks(documents: Iterator[tuple[int, bytes]]) -> Iterator[tuple[list, list, bytes]]:
        keys, counts, held, n = [], [], [], 0
        for name, ids in documents:
            keys.append(name)
            counts.append(len(ids) // 4)
            held.append(ids)
            n += counts[-1]
            if n >= BLOCK_IDS:
                yield keys, counts, b"".join(held)
                keys, counts, held, n = [], [], [], 0
        if keys:
            yield keys, counts, b"".join(held)

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        encoder = kept_encoder(path)
        size = max(encoder.library.get_vocab_size(with_added_tokens=True), end_id + 1)

        def documents():
            for keys, texts in batches:
                for name, ids in zip(keys, encoder.encode(texts), strict=True):
                    yield name, ids + end

        start = 0
        for keys, counts, data in blocks(documents()):
            n = len(data) // 4
            payload = encode_block(np.frombuffer(data, "<u4"), size)
            yield (
                [part_number()], [start], [n], [keys], [counts], [size],
                [payload], [zlib.crc32(payload)], [zlib.crc32(data)],
            )
            start += n

    texts = df.select(F.col(key).cast("long").alias("key"), text_of(text).alias("text"))
    ordered = texts.repartitionByRange(width(df.sparkSession), "key").sortWithinPartitions("key", "text")
    map_batches(ordered, task, BLOCKS).write.parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a folder: ``doc_id``, ``start``, ``n_tokens`` and ``ids``.

    ``start`` counts the ids of all documents before this one; ``ids`` are little-endian unsigned
    32-bit. A damaged block fails the job.
    """
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    # one row for each partition that wrote: a few thousand at most, whatever the data's size
    sums = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = F.coalesce(F.expr("sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
    offsets = sums.select(F.col("part").alias("_part"), earlier.alias("_earlier"))
    placed = blocks.join(offsets, F.col("part") == F.col("_part")).select(
        (F.col("start") + F.col("_earlier")).alias("start"),
        "n_ids", "doc_ids", "doc_tokens", "vocabulary", "payload", "payload_crc32", "ids_crc32",
    )

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for columns in batches:
            for start, n, keys, counts, size, payload, payload_sum, ids_sum in zip(*columns, strict=True):
                if zlib.crc32(payload) != payload_sum:
                    raise ValueError("damaged block: its payload's checksum differs")
                data = decode_block(payload, n, size).tobytes()
                if zlib.crc32(data) != ids_sum:
                    raise ValueError("damaged block: its ids' checksum differs")
                starts = np.concatenate([[0], np.cumsum(counts)]).tolist()
                ids = [data[4 * a : 4 * b] for a, b in zip(starts, starts[1:], strict=False)]
                yield keys, [start + s for s in starts[:-1]], counts, ids

    return map_batches(placed, task, "doc_id long, start long, n_tokens long, ids binary")
