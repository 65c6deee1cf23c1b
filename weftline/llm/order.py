"""Seeded random order within groups of any size, and sums over what comes before a row in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of the order of one group: a group's rows are ranked slice by slice, each on its own.
SLICES = 4096


def seeded(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns)


def running(rows: DataFrame, keys: list[str], draw: str, tie: list[str], weight: Column, out: str) -> DataFrame:
    """``out``: the sum of ``weight`` over the rows of the same keys that come earlier in the order of ``draw``, then ``tie``.

    ``draw`` is a 64-bit hash. Sums of whole slices are aggregated before they are summed up, so no task holds a whole group.
    """
    sliced = rows.withColumn("_slice", F.shiftrightunsigned(draw, 52).cast("int")).withColumn("_weight", weight.cast("bigint"))
    sums = sliced.groupBy(*keys, "_slice").agg(F.sum("_weight").alias("_sum"))
    order = F.col("_slice")
    earlier = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    earlier = earlier.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_slice").alias("_key_slice"), "_before")
    condition = F.col("_slice") == F.col("_key_slice")
    for k in keys:
        condition &= F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    joined = sliced.join(earlier, condition).select(*sliced.columns, "_before")
    # unsigned order of the hash within a slice is its signed order, as the slice fixes the sign
    within = Window.partitionBy(*keys, "_slice").orderBy(draw, *tie).rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn(out, F.col("_before") + F.coalesce(F.sum("_weight").over(within), F.lit(0))).drop("_slice", "_weight", "_before")
