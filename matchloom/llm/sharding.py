"""Rendezvous hashing of stable record keys over weighted shards.

For every shard a record draws a number that depends on its key and the shard alone; the shard with the smallest
weighted draw takes it. A further shard therefore only takes records, and none moves between the others.

Defined results. A null key draws like the text ``\\N``. Repeated rows get the same shard and slots of their own.
Columns besides those named are not read. A shard of weight 0 gets nothing. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.llm.common import partitions

NULL = "\\N"


def choose(key: Column, weights: list[float]) -> Column:
    """The shard for ``key``: its position in ``weights``.

    Half an MD5 digest of key and pair of shards gives 52 bits u in (0, 1]; the draw is -ln(u) / weight.
    """
    key = F.coalesce(key.cast("string"), F.lit(NULL))
    digests = [F.md5(F.concat(key, F.lit(f":{pair}"))) for pair in range(-(-len(weights) // 2))]

    def draw(shard: int) -> Column:
        bits = F.conv(F.substring(digests[shard // 2], 1 + 16 * (shard % 2), 13), 16, 10).cast("double")
        return -F.log((bits + 1) / F.lit(float(1 << 52))) / F.lit(float(weights[shard]))

    draws = [F.struct(draw(s).alias("draw"), F.lit(s).alias("shard")) for s in range(len(weights)) if weights[s] > 0]
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def assign(rows: DataFrame, key: str, weights: list[float], grown: list[float] | None = None) -> DataFrame:
    """``rows`` (narrow ones; all columns are shuffled) with shard, slot and grown_shard.

    Slots of a shard run from 0 without gaps in the order of a digest of the whole row. Equal rows are counted
    before the shuffle and a shard is numbered in slices of that order, so neither a repeated key nor a heavy shard
    meets in one task. ``grown`` has the weights after growth; without it grown_shard is null.
    """
    names = rows.columns
    digest = F.md5(F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit(NULL)) for c in names]))
    slices = partitions(rows.sparkSession)
    counted = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__copies"))
    counted = counted.withColumn("__order", digest).withColumn("shard", choose(F.col(key), weights))
    counted = counted.withColumn("grown_shard", choose(F.col(key), grown) if grown else F.lit(None).cast("int"))
    first = F.conv(F.substring("__order", 1, 8), 16, 10).cast("long")
    counted = counted.withColumn("__slice", F.floor(first * slices / F.lit(1 << 32)).cast("int"))

    sizes = counted.groupBy("shard", "__slice").agg(F.sum("__copies").alias("__size"))
    before = Window.partitionBy("shard").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "__slice", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("shard", "__slice").orderBy("__order").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__inside", F.coalesce(F.sum("__copies").over(inside), F.lit(0))).join(starts, ["shard", "__slice"])
    copies = placed.withColumn("__copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__copies") - 1)))
    return copies.select(*names, "shard", (F.col("__start") + F.col("__inside") + F.col("__copy")).alias("slot"), "grown_shard")
