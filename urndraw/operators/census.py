"""Rows of a dense fact counted by draw and number, without a group for each draw and number.

A draw has 100 numbers, so a group for each of them is a group for every row: nothing gets less before the shuffle, and hash
tables go to disk. Here a draw is one group. The counts of its numbers stand side by side in the bits of a few sums; rows are
counted in stretches so short that no count is beyond its bits, and the counts of stretches are added up as numbers of their own.
Whatever is none of the 100 numbers is a group of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMBERS = tuple(f"{i:02d}" for i in range(100))
#: Bits of a count, and counts in a sum.
BITS, COUNTS = 21, 3
#: Rows of a task that are counted together, as a power of two: a count of so many rows has its bits.
STRETCH = BITS - 1
_SUMS = -(-len(NUMBERS) // COUNTS)


def count_numbers(rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """A row for each draw (``keys``) with ``counts`` of the 100 numbers in order, and a row for each other ``number`` of it, which is ``odd``.

    ``rows`` and ``value`` are how many rows it stands for and the sum over them; keys and numbers may be null.
    """
    number = F.col("number_2d").cast("string")
    place = F.when(number.isin(*NUMBERS), number.cast("int"))
    coded = rows.select(
        *keys, value.alias("_value"), number.alias("_number"), place.alias("_place"),
        F.shiftright(F.monotonically_increasing_id(), STRETCH).alias("_stretch"))
    coded = coded.select(
        *keys, "_value", "_stretch", F.col("_place").isNull().alias("odd"), F.when(F.col("_place").isNull(), F.col("_number")).alias("number"),
        F.expr(f"_place div {COUNTS}").alias("_sum"), F.expr(f"shiftleft(1L, _place % {COUNTS} * {BITS})").alias("_one"))
    sums = [F.coalesce(F.sum(F.when(F.col("_sum") == i, F.col("_one"))), F.lit(0).cast("long")).alias(f"_s{i}") for i in range(_SUMS)]
    stretches = coded.groupBy(*keys, "odd", "number", "_stretch").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_value").alias("_value"), *sums)
    packed = F.when(~F.col("odd"), F.array(*[F.col(f"_s{i}") for i in range(_SUMS)]))
    draws = stretches.groupBy(*keys, "odd", "number").agg(
        F.sum("_rows").alias("rows"), F.sum("_value").alias("value"), F.collect_list(packed).alias("_packed"))
    counts = F.expr(
        f"transform(sequence(0, {len(NUMBERS) - 1}), n -> aggregate(_packed, 0L, (c, p) -> "
        f"c + (shiftright(p[cast(n div {COUNTS} as int)], n % {COUNTS} * {BITS}) & {(1 << BITS) - 1}L)))")
    return draws.select(*keys, "odd", "number", "rows", "value", F.when(~F.col("odd"), counts).alias("counts"))


def different() -> Column:
    """Of a row of ``count_numbers``: how many of the 100 numbers it has."""
    return F.when(~F.col("odd"), F.size(F.filter("counts", lambda c: c > 0))).otherwise(0)


def repeated() -> Column:
    """Of a row of ``count_numbers``: how many rows have a number that stands more than once."""
    several = F.aggregate(F.filter("counts", lambda c: c > 1), F.lit(0).cast("long"), lambda a, c: a + c)
    return F.when(~F.col("odd"), several).when(F.col("rows") > 1, F.col("rows")).otherwise(0)


def repeated_numbers(counted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, number_2d, rows) of every number that stands more than once in its draw."""
    own = F.transform("counts", lambda c, n: F.struct(F.lpad(n.cast("string"), 2, "0").alias("number_2d"), c.alias("rows")))
    entries = F.when(F.col("odd"), F.array(F.struct(F.col("number").alias("number_2d"), F.col("rows")))).otherwise(own)
    return counted.select(*keys, F.inline(F.filter(entries, lambda e: e["rows"] > 1)))
