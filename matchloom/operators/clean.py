"""Row cleaning: nulls, duplicates, versions and renames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first under a total order.

    Spark turns the ``row_number() = 1`` filter into a group limit that also runs before the shuffle,
    so a hot key sends one row per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rank).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_key(df: DataFrame, keys: list[str], version: str, values: list[str]) -> DataFrame:
    """The values of the highest version per key, by partial aggregation."""
    best = F.max_by(F.struct(*values), F.col(version)).alias("__best")
    return df.groupBy(*keys).agg(F.max(version).alias(version), best).select(*keys, version, *[f"__best.{v}" for v in values])


def interval_bins(names: DataFrame) -> DataFrame:
    """(former, month, candidates): one row per former name and month, with the intervals that reach into the month.

    Candidates are in the order of precedence: the latest start, then the latest end, then the name.
    """
    fit = names.where("former IS NOT NULL AND current IS NOT NULL AND start_date <= end_date")
    months = F.sequence(F.trunc("start_date", "month"), F.trunc("end_date", "month"), F.expr("INTERVAL 1 MONTH"))
    binned = fit.select("former", F.explode(months).alias("month"), F.struct("start_date", "end_date", "current").alias("c")).distinct()
    return binned.groupBy("former", "month").agg(F.sort_array(F.collect_list("c"), asc=False).alias("candidates"))


def rename_in_interval(df: DataFrame, name: str, on_date: str, names: DataFrame) -> DataFrame:
    """Replace ``name`` by the current one if the date lies in the former name's interval.

    ``names`` holds (current, former, start_date, end_date), both ends included. Months turn the range condition into an
    equi-join with one row per name and month, so there are as many rows as in ``df``, whatever intervals overlap: of
    several the one that starts last wins, then the one that ends last, then the greatest name. Intervals without a start
    or an end, or that end before they start, rename nothing, nor do rows without name or date.
    """
    bins = interval_bins(names).select(F.col("former").alias("__former"), F.col("month").alias("__month"), F.col("candidates").alias("__candidates"))
    joined = df.join(bins, (F.col(name) == F.col("__former")) & (F.trunc(on_date, "month") == F.col("__month")), "left")
    hits = F.filter("__candidates", lambda c: F.col(on_date).cast("date").between(c["start_date"], c["end_date"]))
    return joined.withColumn(f"{name}_current", F.coalesce(F.get(hits, F.lit(0))["current"], F.col(name))).drop("__former", "__month", "__candidates")
