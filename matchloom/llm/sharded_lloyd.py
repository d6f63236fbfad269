"""Lloyd's clustering with the dimensions dealt over shards.

Vectors are cut into blocks of columns, which are written apart. Tasks over a block see only its slice of the centroids and
give each vector's exact partial distances to all of them; a sum by vector adds the blocks, and the least sum names the
cluster. The clusters go back to the blocks, where each one sums the columns of its own slice and moves it.

All is whole numbers, so results don't depend on the order of sums. What the driver holds is the centroids: clusters
times dimensions. Sums by vector are combined before their shuffle, and those by cluster leave a row per task.

Defined results. Rows whose vector is null, has another length, or holds nulls or numbers that aren't finite are left out.
Rows that share an id are vectors of their own; for the start, rows with equal ids are ordered by their components, and
rows without id come last. With fewer vectors than clusters there is a cluster for each. A cluster without vectors stays
where it is. Extra columns are not read. An empty table gives an empty result. Components beyond 2^25 in size aren't
meant: squared distances of 64 of them leave the range of a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]


def whole(vector: Column, scale: int) -> Column:
    """Components as whole numbers: floor(scale * x)."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


def usable(vector: Column, dimensions: int) -> Column:
    """Whether a vector has this length and finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def _partials(slices: list[np.ndarray]) -> Callable[[Batches], Batches]:
    """Exact squared distances over a block's columns, a column d0, d1, ... for each centroid."""
    clusters = len(slices[0])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            out = np.empty((clusters, len(batch)), np.int64)
            for block in np.unique(blocks):
                mine = blocks == block
                x = batch.column("x").filter(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(mine.sum(), -1)
                for c, centroid in enumerate(slices[block]):
                    out[c, mine] = ((x - centroid) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("row"), *map(pa.array, out)], ["row", *(f"d{c}" for c in range(clusters))])

    return run


def assign(blocks: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """row, cluster, distance: the blocks' partial distances added, the smallest, and the first cluster that has it."""
    names = [f"d{c}" for c in range(len(slices[0]))]
    partial = blocks.select("row", "block", "x").mapInArrow(_partials(slices), "row long, " + ", ".join(f"{n} long" for n in names))
    sums = partial.groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
    all_ = F.array(*names)
    return sums.select("row", (F.array_position(all_, F.array_min(all_)) - 1).cast("int").alias("cluster"), F.array_min(all_).alias("distance"))


def move(blocks: DataFrame, assigned: DataFrame, width: int) -> DataFrame:
    """block, cluster, x: floor of the mean of each block's columns over the vectors of each cluster."""
    sums = blocks.join(assigned.select("row", "cluster"), "row").groupBy("block", "cluster")
    sums = sums.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(width)])
    return sums.selectExpr("block", "cluster", "array(" + ", ".join(f"(s{i} - pmod(s{i}, n)) DIV n" for i in range(width)) + ") AS x")


def cluster(
    table: DataFrame,
    order: Column,
    clusters: int = 8,
    rounds: int = 10,
    dimensions: int = 64,
    scale: int = 1024,
    width: int = 16,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of each vector that takes part, and the final centroids.

    ``order``: expression over the id column; the vectors with the smallest values are the first centroids. ``width``:
    columns of a block.
    """
    spark = table.sparkSession
    batch_settings(spark)
    vector = F.col(vector_column)
    kept = table.where(usable(vector, dimensions)).select(F.col(id_column).alias("vec_id"), order.alias("order"), whole(vector, scale).alias("x"))
    kept = materialize(kept.withColumn("row", F.monotonically_increasing_id()), "whole_vectors")  # once written, a row keeps its number
    first = kept.orderBy(F.col("order").asc_nulls_last(), "x").limit(clusters).select("x").collect()  # as many rows as clusters
    if not first:
        return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []

    starts = range(0, dimensions, width)
    cut = F.array(*[F.struct(F.lit(b).alias("block"), F.slice("x", at + 1, width).alias("x")) for b, at in enumerate(starts)])
    cut = kept.select("row", F.explode(cut).alias("b")).select("row", "b.block", "b.x")
    blocks = materialize(cut.repartitionByRange("block", "row"), "column_blocks")

    slices = [np.array([r["x"][at : at + width] for r in first], np.int64) for at in starts]
    for _ in range(rounds):
        for r in move(blocks, assign(blocks, slices), width).collect():  # a row per block and cluster
            slices[r["block"]][r["cluster"]] = [v for v in r["x"] if v is not None]
    found = kept.select("vec_id", "row").join(assign(blocks, slices), "row").select("vec_id", "cluster", "distance")
    return found, np.concatenate(slices, axis=1).tolist()
