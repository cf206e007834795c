"""Sharding by proportional stratified interleaving, with DataFrame functions only.

The rows of each source are shuffled by a seeded hash and ranked; a row's rank over its source's
size, shifted by a phase of the source's own, is its fraction. Sorted by fraction, every stretch of
the table holds each source in its share, so cutting the sorted table into equal stretches gives
shards that all match the mixture, with row counts at most one apart.

No task ranks a whole source and none sorts the whole table: hashes and fractions are uniform, so
both rankings run in buckets of near equal size, and a table of bucket sizes says how many rows come
before each bucket. Exact copies of a row are counted before the shuffle and numbered after it;
the number is part of the hash, so that many copies scatter as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import cut

SEED = 42

# Fixed at every size and for the plan only: the table of bucket sizes stays this long for each
# source, and a bucket of a source holds its rows divided by this.
BUCKETS = 4096

# Copies of one row that a task numbers at once; changes no result.
COPIES_TOGETHER = 65_536

# Digits of a hash that make a number below 1: 52 bits, exact in a double.
DIGITS = 13


def _number(digest: Column, digits: int = DIGITS) -> Column:
    """The first hexadecimal digits as a number from 0 to below 1."""
    whole = F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")
    return whole / F.lit(float(16**digits))


def _numbered_copies(df: DataFrame) -> DataFrame:
    """``row``, the columns as a struct, and ``copy``, which numbers equal rows from 0."""
    counted = df.select(F.struct("*").alias("row")).groupBy("row").agg(F.count("*").alias("n"))
    counted = cut(counted, "counted-rows")
    some = counted.where(F.col("n") <= COPIES_TOGETHER).select(
        "row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")
    )
    first = F.col("chunk") * COPIES_TOGETHER
    last = F.least(F.col("n"), first + COPIES_TOGETHER) - 1
    chunks = F.expr(f"sequence(0L, (n - 1) div {COPIES_TOGETHER})")
    many = (
        counted.where(F.col("n") > COPIES_TOGETHER)
        .select("row", "n", F.explode(chunks).alias("chunk"))
        .repartition("row", "chunk")
        .select("row", F.explode(F.sequence(first, last)).alias("copy"))
    )
    return some.unionByName(many)


def _before(counts: DataFrame, *keys: str) -> DataFrame:
    """Bucket sizes ``n`` as ``before``, the rows in earlier buckets, and ``size``, the rows in all."""
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys,
        "bucket",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("size"),
    )


def interleave(
    df: DataFrame,
    n_shards: int,
    *,
    stratum: str = "source",
    tokens: Sequence[str] | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Every row's place: ``row`` (the columns of ``df`` as a struct, so that no name can clash),
    ``shard`` from 0, ``slot`` from 0 without gaps in its shard, and ``position`` in the whole order.

    The columns ``tokens`` (all by default) make the hash that shuffles a source's rows; equal hashes
    are put in the order of the rows themselves, so the result depends on the rows and the seed alone,
    not on files, partitions or retries. Rows that equal each other each get a place. A null
    ``stratum`` is a source of its own. There may be more shards than rows; then some are empty. An
    empty table gives an empty result. Columns must be of types that can be grouped and ordered.
    """
    if n_shards < 1:
        raise ValueError("give at least one shard")
    copies = _numbered_copies(df)
    value = lambda name: F.coalesce(F.col("row")[name].cast("string"), F.lit(""))
    token = F.md5(F.concat_ws("|", F.lit(str(seed)), *map(value, tokens or df.columns), "copy"))
    source = F.coalesce(F.concat(F.lit("="), F.col("row")[stratum].cast("string")), F.lit("null"))
    keyed = copies.select("row", source.alias("source"), "copy", token.alias("token")).withColumn(
        "bucket", F.floor(_number(F.col("token")) * BUCKETS).cast("int")
    )
    sizes = _before(keyed.groupBy("source", "bucket").agg(F.count("*").alias("n")), "source")

    by_hash = Window.partitionBy("source", "bucket").orderBy("token", "row", "copy")
    in_bucket = keyed.withColumn("in_bucket", F.row_number().over(by_hash))
    phase = _number(F.md5(F.concat_ws("|", F.lit(str(seed)), "source")))
    rank = F.col("before") + F.col("in_bucket") - 1
    ranked = in_bucket.join(cut(sizes, "hash-buckets"), ["source", "bucket"]).select(
        "row", "source", rank.alias("rank"), ((rank + phase) / F.col("size")).alias("fraction")
    )
    # rounding may give a fraction of 1, which is a bucket of its own and keeps the order
    ranked = cut(ranked.withColumn("bucket", F.floor(F.col("fraction") * BUCKETS).cast("int")), "ranked")

    places = _before(ranked.groupBy("bucket").agg(F.count("*").alias("n")))
    by_fraction = Window.partitionBy("bucket").orderBy("fraction", "source", "rank")
    position = F.col("before") + F.col("in_bucket") - 1
    placed = ranked.withColumn("in_bucket", F.row_number().over(by_fraction)).join(
        cut(places, "fraction-buckets"), "bucket"
    )
    shard = F.expr(f"position * {n_shards} div size")
    slot = F.expr(f"position - (shard * size + {n_shards - 1}) div {n_shards}")
    return (
        placed.select("row", "size", position.alias("position"))
        .withColumn("shard", shard.cast("int"))
        .select("row", "shard", slot.alias("slot"), "position")
    )


def write_shards(df: DataFrame, n_shards: int, path: str, **options) -> None:
    """Write the rows as Parquet, a folder ``shard=…`` for each shard, in the order of ``slot``.

    Large shards get several files, dealt by ranges of ``position``; options are those of
    :func:`interleave`.
    """
    placed = interleave(df, n_shards, **options)
    ranges = placed.repartitionByRange("position").sortWithinPartitions("position")
    ranges.write.partitionBy("shard").parquet(path)
