"""Sets of whole numbers as bitmaps that can be merged: exact distinct counts from a rollup.

A set is rows of (block, bits), one for each block of 32,768 neighbouring numbers that holds a
member. The union of sets is the OR of the bits of a block, so distinct counts add up over
stores, months and micro-batches, which plain distinct counts do not. A row is 4 KB before
Parquet compresses it: smaller than the numbers themselves where a group holds more than
about a thousand members of a block, larger where members are spread over very many groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = "block"
BITS = "bits"
BLOCK_BYTES = 4096  # of a bitmap of Spark's functions: 32,768 numbers


def collect(df: DataFrame, keys, number: str) -> DataFrame:
    """The set of ``number`` for each value of ``keys``; a null is a block of its own (null)."""
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias(BLOCK)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS))


def union(sets: DataFrame, keys) -> DataFrame:
    """Sets of the same keys merged."""
    return sets.groupBy(*keys, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count(sets: DataFrame, keys, name: str) -> DataFrame:
    """Distinct numbers, without null, of the union of the sets of each value of ``keys``."""
    merged = union(sets, keys)
    number = F.when(F.col(BLOCK).isNotNull(), F.bitmap_count(BITS)).otherwise(F.lit(0))
    return merged.groupBy(*keys).agg(F.sum(number).cast("bigint").alias(name))


def members(sets: DataFrame, keys, name: str) -> DataFrame:
    """The numbers of the union of the sets of each value of ``keys``, null as null."""
    merged = union(sets, keys)
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    byte = F.conv(F.hex(F.substring(F.col(BITS), F.col("place") + 1, F.lit(1))), 16, 10).cast("int")
    bits = (merged.filter(F.col(BLOCK).isNotNull())
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(BLOCK_BYTES - 1))).alias("place"))
            .withColumn("byte", byte).filter("byte <> 0")
            .select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit"))
            .filter(F.expr("shiftright(byte, bit) & 1 = 1")))
    numbers = bits.select(*keys, _number(F.col(BLOCK), F.col("place") * 8 + F.col("bit")).alias(name))
    missing = merged.filter(F.col(BLOCK).isNull()).select(*keys, F.lit(None).cast("bigint").alias(name))
    return numbers.unionByName(missing)


def _number(block: Column, position: Column) -> Column:
    """The number at a bit of a block: blocks above 0 hold the positive ones, from 1 on."""
    size = F.lit(8 * BLOCK_BYTES).cast("bigint")
    return F.when(block > 0, (block - 1) * size + position + 1).otherwise(block * size - position)
