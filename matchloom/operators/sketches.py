"""Distinct counts and quantiles from sketches that are stored by group and merged upwards.

A stored row holds a HyperLogLog sketch of the values of a column and a KLL sketch of another's numbers, both of bounded
size, for the finest groups. Any coarser group, or a longer span of months, is a merge of stored rows; the facts are not
read again. Nulls are not counted; a group without values has an estimate of 0 and no quantile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12
KLL_SIZE = 200
# Bounds that hold with overwhelming probability: five standard errors of the count, and of a quantile's rank.
COUNT_ERROR = 5 * 1.04 / 2 ** (LOG_BUCKETS / 2)
RANK_ERROR = 0.035


def sketched(df: DataFrame, groups: list[str], distinct: str, number: str) -> DataFrame:
    """``groups``, values (HLL of ``distinct``) and numbers (KLL of ``number``)."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(distinct, LOG_BUCKETS).alias("values"), F.kll_sketch_agg_double(F.col(number).cast("double"), F.lit(KLL_SIZE)).alias("numbers"))


def merged(sketches: DataFrame, groups: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*groups).agg(F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("numbers").alias("numbers"))


def estimate(values: Column) -> Column:
    return F.hll_sketch_estimate(values)


def quantile(numbers: Column, share: float) -> Column:
    return F.when(F.kll_sketch_get_n_double(numbers) > 0, F.kll_sketch_get_quantile_double(numbers, F.lit(share)))
