"""Ranks over a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.storage import materialize

def place(value: Column) -> Column:
    """A double as a long of the same order: sign, exponent, mantissa. NaN is the largest, the two zeros are equal."""
    size = F.abs(value)
    smallest, largest = F.lit(2.0**-1022), F.lit(2047 << 52)
    normal = (size >= smallest) & (size < float("inf"))
    safe = F.when(normal, size).otherwise(1.0)
    guess = F.floor(F.log2(safe))
    power = F.pow(F.lit(2.0), guess)
    # The logarithm may be off by one next to a power of two.
    exponent = guess + (safe >= power * 2).cast("long") - (safe < power).cast("long")
    mantissa = (safe / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)
    tiny = F.when(size < smallest, size).otherwise(0.0) / F.lit(2.0**-1000) * F.lit(2.0**74)
    bits = F.when(normal, (exponent + 1023) * F.lit(1 << 52) + mantissa.cast("long"))
    bits = F.when(F.isnan(value), largest + 1).when(size == float("inf"), largest).otherwise(F.coalesce(bits, tiny.cast("long")))
    return F.when(value < 0, -bits).otherwise(bits)


def report_ranks(df: DataFrame, metrics: dict[str, str], descending: bool = True) -> DataFrame:
    """``RANK()`` for tables with a row per actor, which one task can order; null ranks as null."""
    order = lambda c: F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last()
    ranks = {out: F.when(F.col(m).isNotNull(), F.rank().over(Window.partitionBy(F.lit(0)).orderBy(order(m))).cast("bigint")) for m, out in metrics.items()}
    return df.withColumns(ranks)


def global_ranks(df: DataFrame, metrics: dict[str, str], descending: bool = True) -> DataFrame:
    """Add ``RANK()`` over a table of any size for each numeric ``metric -> output`` pair; null ranks as null.

    Rows are first counted per distinct value, so ties cost nothing. The values are range-partitioned and written once: a
    rank is one more than the rows in the ranges before and, by a window inside its range, those before it there. NaN is
    the largest value, the two zeros are equal.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    counts = df.select(pairs.alias("p")).select("p.*").filter(F.col("value").isNotNull()).groupBy("metric", "value").agg(F.count(F.lit(1)).alias("n"))
    order = F.col("value").desc() if descending else F.col("value").asc()
    counts = materialize(counts.repartitionByRange("metric", order).withColumn("range", F.spark_partition_id()), "ranges")
    sizes = counts.groupBy("metric", "range").agg(F.sum("n").alias("size"))  # a row per range and metric
    earlier = Window.partitionBy("metric").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("metric", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("metric", "range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = counts.select("metric", "range", "value", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inside"))
    rank = (F.col("before") + F.col("inside") + 1).cast("bigint")
    ranks = materialize(within.join(sizes, ["metric", "range"]).select("metric", "value", rank.alias("rank")), "ranks")
    result = df
    for metric, out in metrics.items():
        own = ranks.filter(F.col("metric") == metric).select(F.col("value").alias("__value"), F.lit(0).alias("__spread"), F.col("rank").alias(out))
        # Rows without a value match nothing; spread out, they don't meet in one task.
        spread = F.when(F.col(metric).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != metric]), F.lit(1_000_000)) + 1).otherwise(0)
        own_key = F.coalesce(F.col(metric).cast("double"), F.lit(0.0))
        result = result.join(own, (own_key == F.col("__value")) & (spread == F.col("__spread")), "left").drop("__value", "__spread")
    return result
