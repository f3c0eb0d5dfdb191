"""A filter over key hashes: which rows of a long history can belong to the keys of a short load.

A Bloom filter of a fixed number of bits, built with partial aggregation from the load's
keys and applied where the history is scanned, before anything of it is shuffled. It lets
every wanted row pass and few others; the join behind it decides. With 32 bits a key about
one row in 6000 passes without being wanted; a fuller filter only lets more pass, and one of
very many keys is not built at all, because it would let nearly everything pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter; 2 MB whatever the load holds. That is 32 bits for each of 524288 keys.
BITS = 1 << 24
#: Positions that a key sets.
HASHES = 4
#: A filter with fewer bits for each different key is left out; at 4 bits a key 16 % pass.
LEAST_BITS = 4
#: The filter is kept as words of this many bits, and has so many bits at least.
WORD, BUCKET = 64, 32_768


def _positions(key: Column, bits: int) -> list[Column]:
    """Double hashing: two hashes, the second one odd, give all positions."""
    first, second = F.xxhash64(key), F.xxhash64(key, F.lit("step")).bitwiseOR(F.lit(1))
    # Only the low bits count, so nothing is lost by keeping them before multiplying.
    low = [h.bitwiseAND(F.lit(bits - 1)) for h in (first, second)]
    return [(low[0] + k * low[1]).bitwiseAND(F.lit(bits - 1)) for k in range(HASHES)]


def key_filter(df: DataFrame, key: str, bits: int = BITS) -> Column:
    """The filter of df's keys as a scalar subquery: an array of words, NULL if it lets all pass.

    bits is a power of two, BUCKET at least. Words are numbers that tasks fill in their hash
    tables, so nothing is sorted, and a task sends each word once at most: a key that fills a
    third of the rows costs nothing extra. NULL keys are left out.
    """
    place = F.explode(F.array(*_positions(F.col(key), bits))).alias("place")
    keys = df.where(F.col(key).isNotNull()).select(key)
    # Counted by a sketch first: a pass over the keys without a shuffle of them.
    few = keys.agg(F.approx_count_distinct(key) * LEAST_BITS <= bits).scalar()
    # Each key once: a load names most of its parents many times, and a place costs more than a key.
    places = keys.where(few).distinct().select(place)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % WORD).cast("int"))
    filled = places.select(F.shiftright("place", 6).alias("word"), one.alias("filled"))
    # Every word once, empty ones too, so that a word is found by its number.
    empty = df.sparkSession.range(bits // WORD).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("filled"))
    words = filled.unionByName(empty).groupBy("word").agg(F.bit_or("filled").alias("filled"))
    in_order = F.sort_array(F.collect_list(F.struct("word", "filled")))
    return words.agg(F.when(few, F.transform(in_order, lambda w: w["filled"]))).scalar()


def may_be_in(filtered: Column, key: str, bits: int = BITS) -> Column:
    """False for rows whose key is certainly not among the filter's keys, or is NULL."""

    def is_set(place: Column) -> Column:
        word = F.get(filtered, F.shiftright(place, 6).cast("int"))
        return F.getbit(word, (place % WORD).cast("int")) == 1

    every = reduce(Column.__and__, map(is_set, _positions(F.col(key), bits)))
    return F.col(key).isNotNull() & (filtered.isNull() | every)
