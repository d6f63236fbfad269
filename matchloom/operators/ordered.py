"""Ordered state per key that stays parallel when one key holds much of the data.

A plain window puts all rows of a key into one task. Here every key is cut into buckets of its own
order column (months, say). Windows run inside a bucket; what earlier buckets contribute is a small
table with one row per (key, bucket), summed over buckets and joined back. Results are those of the
plain window. Keys must not be null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNBOUNDED = Window.unboundedPreceding


def expanding_before(
    df: DataFrame, keys: list[str], bucket: str, order: list[str], sums: dict[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Add, per name in ``sums``, the sum over all earlier rows of the key (0 when there are none).

    Here and below ``source`` holds the same rows as ``df`` with fewer steps behind them; bucket tables are
    taken from it, so that a chain of such operators does not run its first steps again for each bucket table.
    """
    scope = [*keys, bucket]
    inside = Window.partitionBy(*scope).orderBy(*order).rowsBetween(UNBOUNDED, -1)
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(UNBOUNDED, -1)
    zero = F.lit(0)
    carried = (
        (source or df).groupBy(*scope)
        .agg(*[F.sum(v).alias(f"__t_{n}") for n, v in sums.items()])
        .select(*scope, *[F.coalesce(F.sum(f"__t_{n}").over(earlier), zero).alias(f"__c_{n}") for n in sums])
    )
    local = df.withColumns({n: F.coalesce(F.sum(v).over(inside), zero) for n, v in sums.items()})
    joined = local.join(carried, scope)
    return joined.withColumns({n: F.col(n) + F.col(f"__c_{n}") for n in sums}).drop(*[f"__c_{n}" for n in sums])


def rolling_before(
    df: DataFrame, keys: list[str], bucket: str, order: list[str], value: str, out: str, size: int, source: DataFrame | None = None
) -> DataFrame:
    """Add the sum of ``value`` over the ``size`` rows before each row of the key (0 when there are none)."""
    scope = [*keys, bucket]
    inside = Window.partitionBy(*scope).orderBy(*order)
    from_end = F.row_number().over(Window.partitionBy(*scope).orderBy(*[F.col(c).desc() for c in order]))
    # Last rows of every bucket, oldest first; then, per bucket, the last rows of the buckets before it.
    tails = (
        (source or df).select(*scope, value, from_end.alias("__e"))
        .filter(F.col("__e") <= size)
        .groupBy(*scope)
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("__e")).alias("e"), F.col(value).alias("v")))).alias("__tail"))
    )
    previous = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(-size, -1)
    carried = tails.select(
        *scope, F.transform(F.flatten(F.collect_list("__tail").over(previous)), lambda x: x["v"]).alias("__carry")
    )
    local = df.withColumns(
        {
            "__pos": F.row_number().over(inside),
            "__in": F.coalesce(F.sum(value).over(inside.rowsBetween(-size, -1)), F.lit(0)),
        }
    )
    missing = F.lit(size) - F.col("__pos") + 1
    first = F.greatest(F.array_size("__carry") - missing + 1, F.lit(1))
    rest = F.aggregate(F.slice("__carry", first, missing), F.lit(0).cast("bigint"), lambda a, v: a + v)
    total = F.col("__in") + F.when(F.col("__pos") <= size, rest).otherwise(F.lit(0))
    return local.join(carried, scope).withColumn(out, total).drop("__carry", "__pos", "__in")


def asof_before(
    facts: DataFrame,
    history: DataFrame,
    keys: list[str],
    fact_time: str,
    history_time: str,
    values: dict[str, object],
    grain: str = "MM",
    source: DataFrame | None = None,
) -> DataFrame:
    """Latest history row strictly before each fact, per key; ``values`` maps column to its default.

    Facts and history are merged into one ordered stream. On equal times facts come first, which makes
    the comparison strict. History must be unique per key and time.
    """
    left = facts.withColumns(
        {"__t": F.col(fact_time), "__side": F.lit(0), **{v: F.lit(None).cast(history.schema[v].dataType) for v in values}}
    )
    right = history.select(*keys, F.col(history_time).alias("__t"), F.lit(1).alias("__side"), *values)
    both = left.unionByName(right, allowMissingColumns=True).withColumn("__b", F.trunc("__t", grain))
    scope = [*keys, "__b"]
    inside = Window.partitionBy(*scope).orderBy("__t", "__side").rowsBetween(UNBOUNDED, 0)
    earlier = Window.partitionBy(*keys).orderBy("__b").rowsBetween(UNBOUNDED, -1)
    # Buckets are those with facts or history; only history has values.
    fact_buckets = (source or facts).select(*keys, F.trunc(fact_time, grain).alias("__b")).distinct()
    own = right.withColumn("__b", F.trunc("__t", grain)).groupBy(*scope).agg(*[F.max_by(v, "__t").alias(f"__l_{v}") for v in values])
    carried = (
        fact_buckets.join(own, scope, "full")
        .select(*scope, *[F.last(f"__l_{v}", ignorenulls=True).over(earlier).alias(f"__c_{v}") for v in values])
    )
    local = both.withColumns({v: F.last(v, ignorenulls=True).over(inside) for v in values})
    matched = local.filter(F.col("__side") == 0).join(carried, scope)
    filled = {v: F.coalesce(v, f"__c_{v}", F.lit(default)) for v, default in values.items()}
    return matched.withColumns(filled).drop("__t", "__side", "__b", *[f"__c_{v}" for v in values])


def group_offsets(df: DataFrame, part: list[str], groups: list[str]) -> DataFrame:
    """Per group its row count ``n`` and the number ``before`` of rows in earlier groups of the same part.

    One row per group, so the ordered pass sees groups and never rows.
    """
    sizes = df.groupBy(*part, *groups).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*(part or [F.lit(0)])).orderBy(*groups).rowsBetween(UNBOUNDED, -1)
    return sizes.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def with_ordinal(df: DataFrame, part: list[str], groups: list[str], order: list[str], out: str) -> DataFrame:
    """1-based position in (``groups``, ``order``) within ``part``; only a group is ever sorted as a whole."""
    scope = [*part, *groups]
    inside = F.row_number().over(Window.partitionBy(*scope).orderBy(*order))
    offsets = group_offsets(df, part, groups).drop("n")
    return df.withColumn("__r", inside).join(offsets, scope).withColumn(out, (F.col("__r") + F.col("before")).cast("bigint")).drop("__r", "before")


def chronological_split(df: DataFrame, groups: list[str], order: list[str], train_share: float) -> DataFrame:
    """Label rows ``train`` or ``test``: the first floor(share * rows) in (``groups``, ``order``) train.

    The cut falls into one group. All other rows are decided by their group's offset alone; only the
    group that holds the cut is sorted.
    """
    offsets = group_offsets(df, [], groups)
    cut = offsets.select(F.floor(F.sum("n") * F.lit(train_share)).alias("cut")).scalar()
    marked = df.join(offsets, groups).withColumn("__cut", cut)
    straddles = (F.col("before") < F.col("__cut")) & (F.col("before") + F.col("n") > F.col("__cut"))
    whole = marked.filter(~straddles).withColumn("split", F.when(F.col("before") < F.col("__cut"), "train").otherwise("test"))
    position = F.row_number().over(Window.partitionBy(*groups).orderBy(*order)) + F.col("before")
    sliced = marked.filter(straddles).withColumn("split", F.when(position <= F.col("__cut"), "train").otherwise("test"))
    return whole.unionByName(sliced).drop("n", "before", "__cut")


def time_folds(df: DataFrame, groups: list[str], order: list[str], folds: int, out: str = "fold") -> DataFrame:
    """Number ``folds`` + 1 consecutive blocks of equal size in (``groups``, ``order``), from 0.

    Fold k is tested with the rows before it, so none is judged by later ones and block 0 is only learned from.
    """
    placed = with_ordinal(df, [], groups, order, "__place")
    total = df.agg(F.count(F.lit(1))).scalar()
    return placed.withColumn("__rows", total).withColumn(out, F.expr(f"((__place - 1) * {folds + 1}) DIV __rows").cast("int")).drop("__place", "__rows")
