"""Which folders may hold a key: Bloom filters of one 64-bit word a key, beside the keys in slices by hash.

A key's hash names a slice of its folder and a word of that slice's filter, and sets a few bits of that word. So a filter
is an ordinary table of words, built by one aggregation and asked by one equi-join: neither is ever whole
in one task, however many keys a folder holds.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PER_SLICE = 1 << 20
"""Keys of a slice, at most on average. A slice is the least that is read when a filter says "maybe"."""
BITS_PER_KEY = 12
PROBES = 5
"""Bits that a key sets. With 12 to 24 bits a key, as the words are a power of two, under 1% of absent keys pass."""
PLACE = ("slices", "words", "slice", "word")


def layout(keys: int, per_slice: int = PER_SLICE) -> tuple[int, int]:
    """Slices of a folder with that many keys, and filter words of a slice, both powers of two."""
    slices = _power_of_two(keys / per_slice)
    return slices, _power_of_two(keys / slices * BITS_PER_KEY / 64)


def _power_of_two(least: float) -> int:
    return 1 << ceil(log2(least)) if least > 1 else 1


def placed(keys: DataFrame) -> DataFrame:
    """``keys(key, slices, words, ...)`` with the slice and word of each key, and the ``mask`` of its bits there."""
    spot = F.xxhash64("key", F.lit(1))  # another hash than the slice's, whose keys share the low bits of that
    return keys.withColumn("slice", F.pmod(F.xxhash64("key"), "slices").cast("int")).withColumn(
        "word", F.pmod(F.shiftrightunsigned(spot, 40), "words").cast("int")
    ).withColumn("mask", reduce(Column.bitwiseOR, [_bit(spot, i) for i in range(PROBES)]))


def _bit(spot: Column, i: int) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright(spot, 6 * i).bitwiseAND(63).cast("int"))


def filter_words(keys: DataFrame) -> DataFrame:
    """The filters of ``keys(part, key, slices, words)``: a row per word in use, the bits of its keys together."""
    return placed(keys).groupBy("part", *PLACE).agg(F.bit_or("mask").alias("mask"))


def may_hold(words: DataFrame, keys: DataFrame, layouts: Iterable[tuple[int, int]]) -> DataFrame:
    """(part, slice, key) for each of the distinct ``keys(key)`` that a filter lets pass; every key held is among them.

    ``layouts`` are the (slices, words) that occur in ``words``: powers of two, so a few dozen at most.
    """
    shapes = F.array(*[F.struct(F.lit(s).alias("slices"), F.lit(w).alias("words")) for s, w in sorted(set(layouts))])
    asked = keys.select("key", F.explode(shapes).alias("layout")).select("key", "layout.*")
    asked = placed(asked).withColumnRenamed("mask", "needed")
    passed = F.col("mask").bitwiseAND(F.col("needed")) == F.col("needed")
    return words.join(asked, list(PLACE)).where(passed).select("part", "slice", "key")
