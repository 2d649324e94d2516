"""A map of bits of fixed size that keeps most rows without a partner out of a shuffle.

The keys of the smaller side of a join set one bit each; the larger side is filtered by it
before it is shuffled. The map has ``MAP_BITS`` bits (1 MB) however many keys there are: a full
map lets more rows through to the join, which drops them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parvis.staging import stage

MAP_BITS = 1 << 23


def bit_map(keys: DataFrame) -> Column:
    """A map of ``MAP_BITS`` bits, as a scalar: those that the ``key`` column sets."""
    words = MAP_BITS // 64
    word = F.shiftrightunsigned("key", 6).bitwiseAND(words - 1).cast("int").alias("word")
    bits = keys.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))"))
                                  .alias("bits"))
    every = keys.sparkSession.range(words).select(F.col("id").cast("int").alias("word"))
    filled = stage(every.join(bits, "word", "left").select(
        "word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")), "bit-map")
    return filled.agg(F.transform(
        F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda s: s["bits"])
        .alias("map")).scalar()


def in_map(bits: Column, key: Column) -> Column:
    """Whether the bit of ``key`` is set; false only for keys the map has not seen."""
    word = F.get(bits, F.shiftrightunsigned(key, 6).bitwiseAND(MAP_BITS // 64 - 1).cast("int"))
    return F.call_function("getbit", word, key.bitwiseAND(63).cast("int")) == 1
