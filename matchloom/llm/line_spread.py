"""Boilerplate lines by the number of distinct sites that have them.

Every line adds its site to a HyperLogLog sketch of its hash; sketches merge by aggregation, on the map side first.
Lines whose estimate is surely below or above the threshold are decided by it, those near it by an exact count of
distinct sites. Lines on enough sites are boilerplate and leave every document.

Defined results. Null and empty texts have one empty line. Lines are compared without white space at their ends, and
blank ones are never boilerplate. A null site counts as one site. Repeated rows are treated alike. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.storage import materialize

LINE = ["h1", "h2"]


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def boilerplate(lines: DataFrame, min_sites: int, lg_k: int = 12) -> DataFrame:
    """(h1, h2, site) -> the hashes on at least ``min_sites`` distinct sites.

    The relative error of a sketch is 1.04 / sqrt(2^lg_k); estimates within three of them, and one site, are counted.
    """
    spread = lines.groupBy(*LINE).agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
    margin = max(1, round(3 * 1.04 / 2 ** (lg_k / 2) * min_sites))
    spread = materialize(spread.where(F.col("sites") >= min_sites - margin), "spread")
    near = spread.where(F.col("sites") <= min_sites + margin).select(*LINE)
    exact = lines.join(near, LINE).groupBy(*LINE, "site").agg(F.lit(1).alias("one")).groupBy(*LINE).agg(F.count("one").alias("sites"))
    return spread.where(F.col("sites") > min_sites + margin).select(*LINE).union(exact.where(F.col("sites") >= min_sites).select(*LINE))


def clean_lines(docs: DataFrame, min_sites: int, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source") -> DataFrame:
    """(doc_id, text, n_lines, n_removed): the texts without boilerplate lines."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.coalesce(F.col(site_column).cast("string"), F.lit("\\N")).alias("site"))
    # Rows with equal id and text lose equal lines, so this names a document well enough.
    rows = rows.withColumn("row", F.struct("doc_id", F.xxhash64("text", F.length("text")).alias("hash")))
    line = F.trim(F.regexp_replace("line", "[\\t\\r]", " "))
    lines = rows.select("row", "site", F.posexplode(_lines(F.col("text"))).alias("at", "line")).withColumn("line", line).where("line <> ''")
    lines = lines.select("row", "site", "at", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    found = materialize(boilerplate(lines.select(*LINE, "site"), min_sites), "boilerplate")
    removed = lines.join(found, LINE).groupBy("row").agg(F.collect_set("at").alias("removed"))
    out = rows.join(removed, rows["row"].eqNullSafe(removed["row"]), "left").withColumn("lines", _lines(F.col("text")))
    kept = F.when(F.col("removed").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.array_join(F.filter("lines", lambda _, i: ~F.array_contains("removed", i)), "\n"))
    return out.select("doc_id", kept.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
