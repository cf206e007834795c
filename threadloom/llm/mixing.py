"""Language-model scores by logistic context mixing, beside a unigram score.

Bits of a text's bytes are predicted one after another. For each of several context lengths a
hashed table holds how often a 0 and a 1 followed; these counts are gathered from every training
document. Their log-odds are mixed with weights gated by how many of the contexts were ever seen
and by the bit's place, and an adaptive map over the mixed odds and the last byte refines the
result. Weights and map are fitted online over every training document as well, each occurrence
left out of the counts that predict it; parts of the corpus go side by side and are averaged after
each pass.

A prediction depends on the few bytes before it alone. So equal byte sequences are counted first,
and tables, weights and map come from these counts; and tasks that score texts keep the ones they
have met in a table of fixed size. Tables of odds have fixed sizes too; what is counted into them
grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import cut, map_batches, text_of, width, words

# Context lengths in bytes; 0 stands for the bytes since the last white space.
ORDERS = (0, 1, 2, 3, 4, 5, 7)
# Bytes that decide a prediction, with the predicted one.
SPAN = 8
TABLE_BITS = 21
CHUNK_BITS = 14
UNSEEN = -32768
PRIOR = 0.1
# Passes of the fit, bytes in a step of it, how far a step moves the map at most.
PASSES, BATCH, FULL_STEP = 2, 4096, 32
BUCKETS, LIMIT = 33, 8.0
# Bytes counted together, bytes sorted together, places in the table of known bytes, bytes of text
# in a block, bytes predicted together.
COUNTED_TOGETHER, SORTED_TOGETHER, KNOWN_BITS, BLOCK_BYTES = 1 << 21, 1 << 23, 22, 1 << 24
PREDICTED_TOGETHER = 8192

BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def grams_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the texts, and an end mark after each, the number its last eight bytes
    make, newest on top, so that those with equal ends sort together; and how many each text has."""
    pad = bytes(SPAN - 1)
    data = b"".join([pad + t + b"\0" for t in texts])
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    # a number at every byte
    grams = np.ndarray(max(0, len(data) - SPAN + 1), "<u8", data, strides=(1,))
    # the places that lie in the padding before a text
    ends = np.cumsum(lengths + SPAN - 1) - (SPAN - 1)
    keep = np.ones(len(grams), bool)
    for back in range(SPAN - 1):
        places = ends + back
        keep[places[places < len(grams)]] = False
    return grams[keep].astype(np.uint64, copy=False), lengths


def byte_of(grams: np.ndarray, back: int) -> np.ndarray:
    return grams >> np.uint64(56 - 8 * back) & np.uint64(255)


def word_so_far(grams: np.ndarray) -> np.ndarray:
    """The bytes before the last one, those before the nearest white space cleared."""
    context, inside = np.zeros_like(grams), np.ones(len(grams), bool)
    for back in range(1, SPAN):
        byte = byte_of(grams, back)
        inside &= (byte != 32) & (byte > 13)
        context |= np.where(inside, byte, np.uint64(0)) << np.uint64(8 * back)
    return context


def nodes_of(grams: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each bit of a predicted byte its place in the half's tree, and the bit."""
    byte = byte_of(grams, 0).astype(np.int64)
    for k in range(8):
        half = byte >> 4 if k < 4 else byte & 15
        yield 1 << k % 4 | half >> 4 - k % 4, (byte >> 7 - k & 1).astype(bool)


def groups_of(grams: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For each half of a predicted byte the first of its sixteen table slots under a context."""
    if order:
        context = grams << np.uint64(8) >> np.uint64(64 - 8 * order)
    else:
        context = word_so_far(grams)
    base = context * BASE + np.uint64(order)
    for known in (np.uint64(0), (grams >> np.uint64(60)) + np.uint64(1)):
        group = mix(base + known * np.uint64(0xD6E8FEB86659FD93)) * BASE >> np.uint64(68 - TABLE_BITS)
        yield group.astype(np.int64) << 4


def grouped(sorted_grams: np.ndarray, times: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """One gram for each context of this length with its byte, and how often they occur."""
    if not order:
        return sorted_grams, times
    ends = sorted_grams >> np.uint64(56 - 8 * order)
    starts = np.flatnonzero(np.concatenate([[True], ends[1:] != ends[:-1]]))
    return sorted_grams[starts], np.add.reduceat(times, starts)


def lowered(text: str) -> bytes:
    return text.encode().lower()


def kinds_of(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ones, ascending, and how often each occurs; sorts ``grams`` in place."""
    grams.sort()
    starts = np.flatnonzero(grams[1:] != grams[:-1]) + 1
    starts = np.concatenate([np.zeros(min(1, len(grams)), np.int64), starts])
    return grams[starts], np.diff(starts, append=len(grams))


def added(counts: np.ndarray, kinds: np.ndarray, times: np.ndarray) -> None:
    """Add to the counts by order, bit and slot; ``kinds`` ascend."""
    for i, order in enumerate(ORDERS):
        flat = counts[i].reshape(-1)
        first, often = grouped(kinds, times, order)
        for at in range(0, len(first), PREDICTED_TOGETHER):
            part, n = first[at : at + PREDICTED_TOGETHER], often[at : at + PREDICTED_TOGETHER].astype(counts.dtype)
            groups = list(groups_of(part, order))
            for k, (node, bit) in enumerate(nodes_of(part)):
                np.add.at(flat, (groups[k // 4] | node) + (bit.astype(np.int64) << TABLE_BITS), n)


def no_counts() -> np.ndarray:
    return np.zeros((len(ORDERS), 2, 1 << TABLE_BITS), np.int32)


def counted(texts: Iterator[bytes]) -> np.ndarray:
    """Counts by order, bit and slot over many texts."""
    counts, held, size = no_counts(), [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= COUNTED_TOGETHER:
            added(counts, *kinds_of(grams_of(held)[0]))
            held, size = [], 0
    if held:
        added(counts, *kinds_of(grams_of(held)[0]))
    return counts


@dataclass
class Model:
    """``odds``: log-odds by order and slot in 1/256; ``weights``: by gate (contexts seen, bit of
    the byte) and order, with a constant last; ``refined``: log-odds by last byte and bucket of the mixed odds."""

    odds: np.ndarray
    weights: np.ndarray
    refined: np.ndarray

    def inputs(self, grams: np.ndarray, alone: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each bit the mixer's inputs, by order, the gates and the bits. ``alone`` has the odds
        by bit, order and slot without one occurrence of the bit."""
        table = (self.odds if alone is None else alone).reshape(-1)
        halves = zip(*[groups_of(grams, order) for order in ORDERS], strict=True)
        firsts = (np.arange(len(ORDERS)) << TABLE_BITS)[:, None]
        for k, (node, bit) in enumerate(nodes_of(grams)):
            if k % 4 == 0:
                groups = np.stack(next(halves))
                groups |= firsts
            if alone is not None:
                node += bit * (len(ORDERS) << TABLE_BITS)
            odds = table.take(groups + node, mode="wrap")
            seen = odds != UNSEEN
            odds *= seen
            found = np.empty((len(ORDERS) + 1, len(grams)), np.float32)
            np.multiply(odds, np.float32(1 / 256), out=found[:-1])
            found[-1] = 0.3
            gate = seen.view(np.int8).sum(axis=0, dtype=np.int8).astype(np.int64)
            yield found, 8 * gate + k, bit

    def mixed(self, found: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = found[0] * self.weights[:, 0].take(gate, mode="clip")
        for i in range(1, len(found)):
            total += found[i] * self.weights[:, i].take(gate, mode="clip")
        return np.clip(total, -LIMIT, LIMIT)

    def refine(self, odds: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Refined log-odds, with the place in the map and the share of the next one they come from."""
        at = (odds + np.float32(LIMIT)) * np.float32((BUCKETS - 1) / (2 * LIMIT))
        bucket = np.minimum(at.astype(np.int64), BUCKETS - 2)
        share = at - bucket.astype(np.float32)
        place = last * BUCKETS + bucket
        refined = self.refined.reshape(-1)
        low, high = refined.take(place, mode="clip"), refined.take(place + 1, mode="clip")
        return low + (high - low) * share, place, share

    def bits(self, grams: np.ndarray) -> np.ndarray:
        """The information in each byte after the ones before it, in bits."""
        out = [self._bits(grams[at : at + PREDICTED_TOGETHER]) for at in range(0, len(grams), PREDICTED_TOGETHER)]
        return np.concatenate([np.zeros(0), *out])

    def _bits(self, grams: np.ndarray) -> np.ndarray:
        likely = np.ones(len(grams))
        last = byte_of(grams, 1).astype(np.int64)
        for found, gate, bit in self.inputs(grams):
            odds = self.mixed(found, gate)
            refined, _, _ = self.refine(odds, last)
            # in double precision, so that the chances of 0 and 1 sum to one
            p = chance(odds).astype(np.float64)
            p += chance(refined)
            p *= 0.5
            likely *= np.where(bit, p, 1 - p)
        return -np.log2(likely)


def chance(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-odds))


def fresh(odds: np.ndarray) -> Model:
    weights = np.full((8 * (len(ORDERS) + 1), len(ORDERS) + 1), 0.2, np.float32)
    grid = np.linspace(-LIMIT, LIMIT, BUCKETS, dtype=np.float32)
    return Model(odds, weights, np.tile(grid, (256, 1)))


def passed(
    model: Model, grams: np.ndarray, times: np.ndarray, turn: int, alone: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Fit weights, and from the second turn on the map, in small steps over the grams. Returns how
    many occurrences each gate and each place of the map had."""
    rate = 0.3 / (1 + turn) ** 2
    met, cells = np.zeros(len(model.weights)), np.zeros(model.refined.size)
    for at in range(0, len(grams), BATCH):
        part = grams[at : at + BATCH]
        found, gate, bit = (np.concatenate(x, axis=-1) for x in zip(*model.inputs(part, alone), strict=True))
        often = np.tile(times[at : at + BATCH].astype(np.float64), 8)
        mixed = model.mixed(found, gate)
        if turn:
            refined, place, share = model.refine(mixed, np.tile(byte_of(part, 1).astype(np.int64), 8))
            wrong = bit - chance(refined)
            weight, moved = 0, 0
            for there, own in ((place, often * (1 - share)), (place + 1, often * share)):
                weight = weight + np.bincount(there, own, model.refined.size)
                moved = moved + np.bincount(there, own * wrong, model.refined.size)
            moved *= 0.03 * np.minimum(weight, FULL_STEP) / np.maximum(weight, 1e-9)
            model.refined += moved.reshape(model.refined.shape).astype(np.float32)
            cells += weight
        missed = often * (bit - chance(mixed))
        weight = np.bincount(gate, often, len(met))
        for i, own in enumerate(found):
            slope = np.bincount(gate, missed * own, len(met)) / np.maximum(weight, 1e-9)
            model.weights[:, i] += (rate * slope).astype(np.float32)
        met += weight
    np.clip(model.refined, -LIMIT, LIMIT, out=model.refined)
    return met, cells


def tuned(odds: np.ndarray, texts: list[bytes]) -> Model:
    """A model fitted on texts in their order, with odds that leave nothing out."""
    model, (grams, _) = fresh(odds), grams_of(texts)
    for turn in range(PASSES):
        passed(model, grams, np.ones(len(grams)), turn)
    return model


class Scorer:
    """Applies a model; ``frequent`` are grams with places of their own in a table, and their information."""

    def __init__(self, model: Model, frequent: list[bytes] = ()):
        self.model = model
        self.known = np.full(1 << KNOWN_BITS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.value = np.zeros(1 << KNOWN_BITS, np.float32)
        for data in frequent:
            kinds, bits = unpacked(data)
            place = place_of(kinds)
            self.known[place], self.value[place] = kinds, bits.astype("<u4").view("<f4")

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Every text's information with its end, in bits."""
        grams, lengths = grams_of(texts)
        place = place_of(grams)
        found = self.value[place].astype(np.float64)
        missing = np.flatnonzero(self.known[place] != grams)
        if len(missing):
            sought = grams[missing]
            kinds, _ = kinds_of(sought.copy())
            values = self.model.bits(kinds).astype(np.float32)
            found[missing] = values[np.searchsorted(kinds, sought)]
        starts = np.cumsum(lengths) - lengths
        return np.add.reduceat(found, starts)


def place_of(grams: np.ndarray) -> np.ndarray:
    return (mix(grams * BASE) >> np.uint64(64 - KNOWN_BITS)).astype(np.int64)


def packed(kinds: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending grams and their counts, first bytes of all together."""
    both = np.stack([np.diff(kinds, prepend=np.uint64(0)), times.astype(np.uint64)]).astype("<u8")
    return zlib.compress(both.reshape(-1).view(np.uint8).reshape(2, -1, 8).transpose(0, 2, 1).tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(2, 8, -1)
    both = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u8")[..., 0].astype(np.uint64)
    return np.cumsum(both[0], dtype=np.uint64), both[1].astype(np.int64)


def squeezed(counts: np.ndarray) -> bytes:
    """Counts of a 0 and a 1 by slot, first bytes of all together; much smaller where few slots are used."""
    used = np.ascontiguousarray(counts.T).astype("<i8").view(np.uint8).reshape(2, -1, 8)
    width = max(1, int(counts.max()).bit_length() + 7 >> 3)
    return zlib.compress(used[..., :width].transpose(0, 2, 1).tobytes(), 1)


def odds_of(zeros: np.ndarray, ones: np.ndarray, left: int | None) -> np.ndarray:
    """Log-odds from counts, without one occurrence of the bit ``left``."""
    zeros, ones = np.maximum(zeros - (left == 0), 0), np.maximum(ones - (left == 1), 0)
    odds = np.log((ones + PRIOR) / (zeros + PRIOR)) * 256
    odds = np.clip(np.rint(odds), -32000, 32000).astype(np.int16)
    odds[(zeros | ones) == 0] = UNSEEN
    return odds


def loosened(table: tuple[list[tuple[int, bytes]], int | None]) -> np.ndarray:
    """The odds by order and slot from squeezed chunks of counts, with the bit to leave one out of."""
    found, left = table
    odds = np.full((len(ORDERS) << TABLE_BITS - CHUNK_BITS, 1 << CHUNK_BITS), UNSEEN, np.int16)
    # of counts below 256, which nearly all are
    small = odds_of(np.arange(1 << 16) >> 8, np.arange(1 << 16) & 255, left)
    for chunk, data in found:
        planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(2, -1, 1 << CHUNK_BITS)
        odds[chunk] = small[planes[0, 0].astype(np.uint16) << 8 | planes[1, 0]]
        large = np.flatnonzero(planes[:, 1:].any(axis=(0, 1)))
        if len(large):
            counts = sum(planes[:, i, large].astype(np.int64) << 8 * i for i in range(planes.shape[1]))
            odds[chunk, large] = odds_of(*counts, left)
    return odds.reshape(len(ORDERS), -1)


def different(texts: DataFrame, buckets: int) -> DataFrame:
    """The different grams of column ``text`` and how often each occurs, as one row for each of so
    many buckets."""

    def shares(grams: np.ndarray) -> Iterator[tuple]:
        kinds, times = kinds_of(grams)
        # buckets have places of their own in the table of frequent grams
        bucket = place_of(kinds) * buckets >> KNOWN_BITS
        if buckets <= 1 << 16:
            bucket = bucket.astype(np.uint16)
        order = np.argsort(bucket, kind="stable")
        ends = np.cumsum(np.bincount(bucket, minlength=buckets))
        for name, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
            if end > start:
                own = order[start:end]
                yield [name], [packed(kinds[own], times[own])]

    def count(batches: Iterator[list[list]]) -> Iterator[tuple]:
        held, n = np.empty(SORTED_TOGETHER, np.uint64), 0
        for (column,) in batches:
            grams, _ = grams_of([lowered(t) for t in column])
            while len(grams):
                part, grams = grams[: len(held) - n], grams[len(held) - n :]
                held[n : n + len(part)] = part
                n += len(part)
                if n == len(held):
                    yield from shares(held)
                    n = 0
        if n:
            yield from shares(held[:n])

    def merge(batches: Iterator[list[list]]) -> Iterator[tuple]:
        bucket, held = None, []

        def merged() -> tuple:
            kinds, times = map(np.concatenate, zip(*held, strict=True))
            # the parts ascend: this sort merges them
            order = np.argsort(kinds, kind="stable")
            kinds, times = kinds[order], times[order]
            starts = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]]))
            return [bucket], [packed(kinds[starts], np.add.reduceat(times, starts))]

        for columns in batches:
            for name, data in zip(*columns, strict=True):
                if name != bucket:
                    if held:
                        yield merged()
                    bucket, held = name, []
                held.append(unpacked(data))
        if held:
            yield merged()

    schema = "bucket int, data binary"
    parts = map_batches(texts.select("text"), count, schema)
    dealt = parts.repartition(width(texts.sparkSession), "bucket").sortWithinPartitions("bucket")
    return cut(map_batches(dealt, merge, schema), "grams")


def gathered(grams: DataFrame) -> list[tuple[list[tuple[int, bytes]], int | None]]:
    """Three tables of log-odds from all grams: of all occurrences, without a 0 at each slot, without
    a 1. All come from the same squeezed chunks of counts, whose size is fixed."""
    per_chunk = 1 << CHUNK_BITS

    def chunks_of(counts: np.ndarray) -> Iterator[tuple]:
        chunks = counts.reshape(len(ORDERS), 2, -1, per_chunk)
        for i, part in np.ndindex(len(ORDERS), chunks.shape[2]):
            own = chunks[i, :, part]
            used = np.flatnonzero(own.any(axis=0))
            if len(used):
                data = used.astype("<u2").tobytes() + own[:, used].T.astype("<i8").tobytes()
                yield [i * chunks.shape[2] + part], [len(used)], [zlib.compress(data, 1)]

    def count(batches: Iterator[list[list]]) -> Iterator[tuple]:
        counts, n, most = no_counts(), 0, np.iinfo(np.int32).max
        for (column,) in batches:
            for data in column:
                kinds, times = unpacked(data)
                while len(kinds):
                    # as many as no count can overflow on; one alone may be more than that
                    fit = int(np.searchsorted(np.cumsum(times), most - n, side="right"))
                    if fit:
                        added(counts, kinds[:fit], times[:fit])
                        n += int(times[:fit].sum())
                        kinds, times = kinds[fit:], times[fit:]
                    if len(kinds):
                        yield from chunks_of(counts)
                        counts[:], n = 0, 0
                        if times[0] > most:
                            times[0] -= most
                            added(counts, kinds[:1], np.array([most]))
                            n = most
        yield from chunks_of(counts)

    def add(batches: Iterator[list[list]]) -> Iterator[tuple]:
        chunk, total = None, None
        for columns in batches:
            for name, n, packed in zip(*columns, strict=True):
                if name != chunk:
                    if chunk is not None:
                        yield [chunk], [squeezed(total)]
                    chunk, total = name, np.zeros((per_chunk, 2), np.int64)
                data = zlib.decompress(packed)
                total[np.frombuffer(data, "<u2", n)] += np.frombuffer(data, "<i8", offset=2 * n).reshape(n, 2)
        if chunk is not None:
            yield [chunk], [squeezed(total)]

    parts = map_batches(grams.select("data"), count, "chunk int, n int, data binary")
    dealt = parts.repartition("chunk").sortWithinPartitions("chunk")
    # one table, some 20 MB; the driver never opens it
    found = [(r["chunk"], r["data"]) for r in map_batches(dealt, add, "chunk int, data binary").collect()]
    return [(found, left) for left in (None, 0, 1)]


def fitted(grams: DataFrame, alone: list[tuple[list[tuple[int, bytes]], int | None]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and map from all grams, with the odds without a 0 and without a 1: each bucket goes through them in an order of its own, and what
    the buckets come to is averaged after each pass, by their occurrences at every gate and place."""
    start = fresh(np.zeros(0, np.int16))
    weights, refined = start.weights, start.refined
    for turn in range(PASSES):

        def fit(batches: Iterator[list[list]], turn=turn, weights=weights, refined=refined) -> Iterator[tuple]:
            total, odds = None, np.stack([loosened(x) for x in alone])
            for columns in batches:
                for bucket, data in zip(*columns, strict=True):
                    kinds, times = unpacked(data)
                    order = np.random.default_rng(bucket).permutation(len(kinds))
                    own = Model(odds, weights.copy(), refined.copy())
                    met, cells = passed(own, kinds[order], times[order], turn, odds)
                    shares = np.concatenate([np.repeat(met, weights.shape[1]), cells])
                    values = np.concatenate([own.weights.reshape(-1), own.refined.reshape(-1)])
                    found = np.stack([shares, shares * values])
                    total = found if total is None else total + found
            if total is not None:
                yield list(range(total.shape[1])), total[0].tolist(), total[1].tolist()

        sums = map_batches(grams, fit, "place int, share double, value double")
        found = sums.groupBy("place").agg(F.sum("share"), F.sum("value")).collect()
        values = np.concatenate([weights.reshape(-1), refined.reshape(-1)])
        for place, share, value in found:
            if share:
                values[place] = value / share
        weights, refined = values[: weights.size].reshape(weights.shape), values[weights.size :].reshape(refined.shape)
    return weights, refined


@dataclass
class Squeezed:
    """A model with its odds in squeezed chunks."""

    odds: tuple[list[tuple[int, bytes]], int | None]
    weights: np.ndarray
    refined: np.ndarray

    def whole(self) -> Model:
        return Model(loosened(self.odds), self.weights, self.refined)


def frequent(grams: DataFrame, model: Squeezed) -> list[bytes]:
    """Grams and their information in bits: for each place of a table of fixed size the one that occurs most often there."""

    def choose(batches: Iterator[list[list]]) -> Iterator[tuple]:
        whole = model.whole()
        for (column,) in batches:
            for data in column:
                kinds, times = unpacked(data)
                place = place_of(kinds)
                order = np.lexsort((times, place))
                last = np.flatnonzero(np.diff(place[order], append=-1))
                chosen = np.sort(kinds[order[last]])
                yield ([packed(chosen, whole.bits(chosen).astype("<f4").view("<u4"))],)

    # 50 MB at most before they are packed
    return [r["data"] for r in map_batches(grams.select("data"), choose, "data binary").collect()]


@dataclass
class Trained:
    """``vocabulary`` has block, word and count; ``frequent`` grams and their information by place;
    the rest are numbers over training documents."""

    vocabulary: DataFrame
    tokens: int
    kinds: int
    docs: int
    blocks: int
    model: Squeezed
    frequent: list[bytes]


def _keyed(df: DataFrame, allowed: Column, text: str, key: str) -> DataFrame:
    return df.select(
        F.col(key).alias("key"), text_of(text).alias("text"), F.coalesce(allowed, F.lit(False)).alias("learn")
    )


def _blocked(keyed: DataFrame, blocks: int) -> DataFrame:
    mark = F.xxhash64(F.col("key").cast("string"), F.octet_length("text"))
    return keyed.withColumn("block", F.pmod(mark, F.lit(blocks)).cast("int"))


def fit(df: DataFrame, allowed: Column, *, text: str = "text", key: str = "doc_id") -> Trained:
    """Learn from all rows where ``allowed`` holds; the vocabulary has a part for every block of
    about 16 MB of text, so that scoring needs no dictionary of the whole corpus."""
    keyed = _keyed(df, allowed, text, key)
    size, docs = keyed.agg(F.sum(F.octet_length("text").cast("long")), F.count_if("learn")).first()
    blocks = max(1, -(-(size or 0) // BLOCK_BYTES))

    def count(batches: Iterator[list[list]]) -> Iterator[tuple]:
        block, met, learnt = None, set(), Counter()

        def finished():
            names = list(met)
            for at in range(0, len(names), 8192):
                part = names[at : at + 8192]
                yield [block] * len(part), [w.decode() for w in part], [learnt[w] for w in part]

        for columns in batches:
            for own, body, learn in zip(*columns, strict=True):
                if own != block:
                    yield from finished()
                    block, met, learnt = own, set(), Counter()
                found = words(body)
                met.update(found)
                if learn:
                    learnt.update(found)
        yield from finished()

    dealt = _blocked(keyed, blocks).select("block", "text", "learn").repartition(
        width(df.sparkSession), "block"
    ).sortWithinPartitions("block")
    met = map_batches(dealt, count, "block int, word string, n long").repartition("word")
    # with the number of blocks, both sides of the join need the same columns: one exchange serves
    sums = met.groupBy(F.col("word").alias("_word")).agg(
        F.sum("n").alias("count"), F.count("block").alias("blocks")
    )
    counted_words = met.join(sums, F.col("word") == F.col("_word")).where("blocks > 0").select(
        "block", "word", "count", "n"
    )
    vocabulary = cut(counted_words, "vocabulary")
    # a word's count stands in every block that has it, so sums go by the blocks' own shares
    tokens = vocabulary.agg(F.sum("n")).first()[0] or 0
    kinds = vocabulary.where("count > 0").select("word").distinct().count()

    learnt = keyed.where("learn")
    grams = different(learnt, blocks)
    odds, *alone = gathered(grams)
    model = Squeezed(odds, *fitted(grams, alone))
    del alone
    vocabulary = vocabulary.select("block", "word", "count")
    return Trained(vocabulary, tokens + docs, kinds + (docs > 0), docs, blocks, model, frequent(grams, model))


def score(df: DataFrame, trained: Trained, allowed: Column, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores of every row: ``key``, ``learn``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, the last two log10 probabilities; ``bits_per_byte`` is the model's
    information for each byte of the text with its end.

    Words are separated by ASCII white space, only A-Z is lowered, and an end is counted after the
    last word. A null text is empty. Repeated rows and null keys are scored each. Without any
    training row every word is unknown and every bit even.
    """
    end, kinds, tokens = trained.docs, trained.kinds, trained.tokens
    # with the task's code, not as a variable: workers would keep it when they are idle
    model, common = trained.model, trained.frequent
    floor = np.log10(tokens + kinds + 1)

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        scorer, block, counts = Scorer(model.whole(), common), None, {}
        for columns in batches:
            out, bodies = [], []
            for own, _, name, body, learn, number in zip(*columns, strict=True):
                if own != block:
                    block, counts = own, {}
                if learn is None:
                    counts[body.encode()] = number
                    continue
                found = body.encode().lower()
                seen = [*map(counts.__getitem__, found.split()), end]
                seen = np.array(seen, np.float64)
                base = float(np.log10(seen + 1).sum() - len(seen) * floor)
                out.append((name, learn, len(seen), int((seen > 0).sum()), tokens, base))
                bodies.append(found)
            if out:
                bits = scorer.bits(bodies)
                sizes = np.array([len(b) + 1 for b in bodies])
                yield (
                    *map(list, zip(*out, strict=True)),
                    (-bits * np.log10(2)).tolist(),
                    (bits / sizes).tolist(),
                )

    kind = df.schema[key].dataType.simpleString()
    docs = _blocked(_keyed(df, allowed, text, key), trained.blocks).select(
        "block", F.lit(1).alias("turn"), "key", "text", "learn", F.lit(0).cast("long").alias("number")
    )
    terms = trained.vocabulary.select(
        "block", F.lit(0).alias("turn"), F.lit(None).cast(kind).alias("key"), F.col("word").alias("text"),
        F.lit(None).cast("boolean").alias("learn"), F.col("count").alias("number"),
    )
    dealt = terms.unionByName(docs).repartition(width(df.sparkSession), "block").sortWithinPartitions("block", "turn")
    schema = (
        f"{key} {kind}, learn boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double, bits_per_byte double"
    )
    return map_batches(dealt, task, schema)
