"""Near-duplicate documents by SimHash, compared bit-sliced.

Fingerprints are compared where they can be close: of ``pieces`` stretches of bits, two
fingerprints that differ in at most ``pieces - agree`` bits share at least ``agree`` whole
stretches, so a bucket for every choice of ``agree`` stretches holds every such pair.

In a bucket the fingerprints' bits stand as 64 planes of machine words, 64 fingerprints side by
side. Adding a plane's differences to bitwise counters with carry-save steps updates 64 distances
at once; the counters start so that they overflow just above the radius, and a query whose block
has overflowed everywhere is abandoned. Equal fingerprints are one node. Small buckets are compared
many at a time; one above :data:`SMALL` gives a spanning forest instead of its pairs. A large bucket
is cut into blocks, and every two blocks meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import cut, map_batches, text_of, words
from threadloom.llm.components import components

BITS = 64
SEED = 42
# Fingerprints of one block of a large bucket.
BLOCK = 8192
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
# Groups of at most so many values are compared side by side, so many values at a time, in steps
# of so many words.
SMALL, VALUES_TOGETHER, PAIRS_TOGETHER = 512, 8192, 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 without words."""
    found = words(text)
    if not found:
        return 0
    if len(found) < shingle:
        found = [b" ".join(found)]
    else:
        found = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in found], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    df: DataFrame, shingle: int = 3, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``key`` and ``fp``, the fingerprint as a signed long."""

    def task(batches):
        for keys, texts in batches:
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
            yield keys, found.view(np.int64).tolist()

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(key, text_of(text).alias("text")), task, f"{key} {kind}, fp long")


def planes_of(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all values, 64 to a word."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((BITS, -(-len(values) // 64) * 64), np.uint8)
    padded[:, : len(values)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def counters_for(shape: tuple[int, ...], radius: int) -> list[np.ndarray]:
    """Bitwise counters, one array for each binary digit, that overflow just above the radius."""
    digits = radius.bit_length()
    start = (1 << digits) - 1 - radius
    return [np.full(shape, ALL if start >> b & 1 else 0, np.uint64) for b in range(digits)]


def added(counters: list[np.ndarray], carry: np.ndarray) -> np.ndarray:
    """Add a plane's differences to the counters; what overflows them comes back."""
    for counter in counters:
        spill = counter & carry
        counter ^= carry
        carry = spill
    return carry


def close(planes: np.ndarray, n: int, queries: np.ndarray, radius: int) -> np.ndarray:
    """For each query a row of bits, one for each of the ``n`` values: 1 within the radius."""
    width = planes.shape[1]
    over = np.zeros((len(queries), width), np.uint64)
    if n % 64:
        over[:, -1] = ALL << np.uint64(n % 64)
    counters = counters_for(over.shape, radius)
    result = np.zeros(over.shape, np.uint64)
    alive, live = np.arange(len(queries)), queries
    for plane in range(BITS):
        flip = np.where(live >> np.uint64(plane) & np.uint64(1), ALL, np.uint64(0))
        over |= added(counters, planes[plane][None, :] ^ flip[:, None])
        if plane % 8 == 7:
            going = (over != ALL).any(axis=1)
            if not going.all():
                alive, live, over = alive[going], live[going], over[going]
                counters = [c[going] for c in counters]
                if not len(alive):
                    return result
    result[alive] = ~over
    return result


def close_pairs(groups: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Close pairs inside many small groups at once: group number and the two places in it.

    Every value meets the words of its own group's planes; the groups' words lie side by side, so a
    plane is added for all of them by a few array operations.
    """
    sizes = np.fromiter(map(len, groups), np.int64, len(groups))
    values, words = np.concatenate(groups), -(-sizes // 64)
    first = np.cumsum(words) - words
    group = np.repeat(np.arange(len(groups)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    lanes = np.full(int(words.sum()) * 64, -1, np.int64)
    lanes[64 * first[group] + place] = np.arange(len(values))
    planes = planes_of(np.where(lanes >= 0, values[lanes], np.uint64(0)))
    empty = np.packbits(lanes < 0, bitorder="little").view("<u8")
    query = np.repeat(np.arange(len(values)), words[group])
    word = np.arange(len(query)) - np.repeat(np.cumsum(words[group]) - words[group], words[group])
    word += first[group][query]
    found = []
    for at in range(0, len(query), PAIRS_TOGETHER):
        q, w = query[at : at + PAIRS_TOGETHER], word[at : at + PAIRS_TOGETHER]
        over = empty[w]
        counters = counters_for(over.shape, radius)
        live = values[q]
        for plane in range(BITS):
            flip = np.uint64(0) - (live >> np.uint64(plane) & np.uint64(1))
            over |= added(counters, planes[plane][w] ^ flip)
            if plane % 8 == 7:
                going = over != ALL
                if not going.all():
                    q, w, live, over = q[going], w[going], live[going], over[going]
                    counters = [c[going] for c in counters]
        bits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(bits)
        found.append(np.stack([q[row], lanes[64 * w[row] + lane]]))
    one, two = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    keep = one < two
    one, two = one[keep], two[keep]
    return group[one], place[one], place[two]


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links, as places in ``values``, that connect all values that links within the radius do."""
    n, planes = len(values), planes_of(values)
    rows = np.concatenate(
        [close(planes, n, values[at : at + 512], radius) for at in range(0, n, 512)]
    )
    new = np.full(planes.shape[1], ALL)
    links, one = [], np.uint64(1)
    linked = np.bitwise_count(rows).sum(axis=1) > 1
    for root in np.flatnonzero(linked):
        if not new[root >> 6] >> np.uint64(root & 63) & one:
            continue
        new[root >> 6] &= ~(one << np.uint64(root & 63))
        waiting = [root]
        while waiting:
            node = waiting.pop()
            found = rows[node] & new
            new &= ~found
            for other in np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little")):
                links.append((node, other))
                waiting.append(other)
    return links


def stretch_masks(pieces: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` of ``pieces`` stretches, as signed longs."""
    ends = [BITS * i // pieces for i in range(pieces + 1)]
    stretches = [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:], strict=False)]
    masks = (sum(chosen) for chosen in combinations(stretches, agree))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def close_links(values: DataFrame, radius: int, pieces: int, agree: int) -> DataFrame:
    """Links ``u``, ``v`` between distinct fingerprints ``fp`` that connect all close ones."""
    if pieces - agree < radius:
        raise ValueError("these stretches can miss pairs within the radius")

    def bucket(i: int, mask: int) -> Column:
        return F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(mask).cast("long")))

    buckets = [bucket(i, mask) for i, mask in enumerate(stretch_masks(pieces, agree))]
    keyed = values.select("fp", F.explode(F.array(*buckets)).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    large = cut(sizes.select(F.col("bucket").alias("_bucket"), blocks), "large-buckets")
    sized = keyed.join(large, F.col("bucket") == F.col("_bucket"), "left").drop("_bucket")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # in a large bucket, a fingerprint goes wherever its block meets another one
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda i: i != F.col("own"))
    met = F.when(F.col("blocks").isNull(), F.array(F.lit(-1))).otherwise(others)
    placed = sized.withColumn("own", own).select(
        "bucket", "fp", "own", F.explode(met).alias("other")
    )
    pair = [F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    groups = (
        placed.groupBy("bucket", *pair)
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select("fps")
    )

    def task(batches: Iterator[list[list]]) -> Iterator[tuple]:
        for (lists,) in batches:
            small, held = [], 0
            for fps in lists:
                own = np.array(fps, np.int64)
                if len(own) > SMALL:
                    links = np.array(forest(own.view(np.uint64), radius), np.int64).reshape(-1, 2)
                    yield own[links[:, 0]].tolist(), own[links[:, 1]].tolist()
                    continue
                small.append(own)
                held += len(own)
                if held >= VALUES_TOGETHER:
                    yield linked(small)
                    small, held = [], 0
            if small:
                yield linked(small)

    def linked(lists: list[np.ndarray]) -> tuple[list, list]:
        group, one, two = close_pairs([own.view(np.uint64) for own in lists], radius)
        ends = np.cumsum([len(own) for own in lists])
        start = np.concatenate([[0], ends[:-1]])[group]
        values = np.concatenate(lists)
        return values[start + one].tolist(), values[start + two].tolist()

    return map_batches(groups, task, "u long, v long")


def near_duplicates(
    df: DataFrame,
    *,
    shingle: int = 3,
    radius: int = 2,
    pieces: int = 5,
    agree: int = 3,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """``key``, ``fp`` and ``component``, the smallest key that links lead to, itself included.

    Two rows are linked when their fingerprints differ in at most ``radius`` bits; no such link is
    lost. Texts without words, null ones too, have fingerprint 0 and are linked like any others.
    Repeated rows come out each; the component of rows whose keys are all null is null.
    """
    found = cut(fingerprints(df, shingle, text, key), "fingerprints")
    distinct = cut(found.groupBy("fp").agg(F.min(key).alias("least")), "distinct-fingerprints")
    roots = components(close_links(distinct, radius, pieces, agree))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy(F.col("root").alias("_root")).agg(F.min("least").alias("component"))
    # only groups of several fingerprints need the join back
    labels = rooted.join(least, F.col("root") == F.col("_root")).select(
        F.col("fp").alias("_fp"), "component"
    )
    return found.join(labels, F.col("fp") == F.col("_fp")).select(key, "fp", "component")
