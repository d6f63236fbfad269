"""Table sinks. Writers run on the executors; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, replacing what is there. ``single_file`` is for tables that are reports by construction."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_feature_store(df: DataFrame, path: str, partition: str) -> None:
    """Parquet partitioned by a low-cardinality column. Rows spread over tasks, so a hot value is no hot task."""
    df.write.mode("overwrite").partitionBy(partition).parquet(path)


def rewrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace those partitions of a feature store that ``df`` has rows of; the files of the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_lookup(df: DataFrame, path: str, key: str, row_group_bytes: int = 8 << 20) -> None:
    """Parquet for point lookups: range-sorted by ``key``, so that few row groups can hold a value, with Bloom filters of it
    that rule out most of those. Small row groups, as a lookup reads whole ones."""
    ordered = df.repartitionByRange(key).sortWithinPartitions(key)
    writer = ordered.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def nested_summary(table: DataFrame, total: int | F.Column, key: str, count: str, percent: str, top: int = 10) -> DataFrame:
    """One record: total, best ``top`` rows, all rows, both best first.

    The document is one array, so it is for frequency tables with a row per actor, which don't grow with the facts.
    """
    entry = F.struct((-F.col(count)).alias("__o"), F.col(key), F.col(count), F.col(percent))
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.struct(e[key].alias(key), e[count].alias(count), e[percent].alias(percent)))
    one = table.agg(ordered.alias("all_results"))
    return one.select((total if isinstance(total, F.Column) else F.lit(total)).alias("n_simulations"), F.slice("all_results", 1, top).alias("top_10"), "all_results")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
