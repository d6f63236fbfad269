"""Mixing sources to target weights by hierarchical budgeting.

The tree has one level for each of the given columns (domain, language, source). A node's budget is divided among its
children by weight. A child whose subtree can't supply its share gives what it has, and its shortage goes to its
siblings; only when a whole subtree is short does the shortage reach the siblings of its ancestor. All of this is exact
integer arithmetic on a table with one row per node of the tree. A leaf then reads its documents in seeded epochs, each
in an order of its own, until its budget of tokens is spent: whole epochs first, then the prefix of one more.

The cut of each leaf's last epoch is found from sums per slice of the seeded order; only the slice with the cut is
ordered row by row. What is taken of a document follows from its leaf's row, so texts are never shuffled.

Defined results. Null texts have no tokens and are never selected, nor are texts without words. Null levels are one
child named ``(none)``. A weight of 0 excludes a subtree; unlisted nodes weigh 1. Equal ids with equal token counts
share one place in the order; if the cut falls there, each gets an equal part, rounded down. Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchloom.storage import materialize

NONE = "(none)"
WORD = "[^ \\t-\\r]+"
EXACT = "decimal(38,0)"


def tokens(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[tuple[str, ...], int], percent: int, epochs: int) -> DataFrame:
    """(levels..., supply) -> (levels..., supply, budget).

    The whole budget is ``percent`` of all tokens, at most ``epochs`` times what is there. ``weights``: path from the
    root -> whole number.
    """
    top = leaves.agg(F.floor(F.sum("supply") * percent / F.lit(100)).alias("budget"))
    nodes = leaves.withColumn("cap", F.col("supply") * epochs)
    for depth in range(len(levels), 0, -1):
        for path, weight in weights.items():
            if len(path) == depth and weight == 0:
                mine = F.lit(True)
                for level, name in zip(levels, path):
                    mine &= F.col(level) == name
                nodes = nodes.withColumn("cap", F.when(mine, F.lit(0).cast("long")).otherwise(F.col("cap")))
    nodes = materialize(nodes, "leaves")
    known = top.select(F.least("budget", nodes.agg(F.sum("cap")).scalar()).alias("budget"))
    for depth in range(1, len(levels) + 1):
        path = list(levels[:depth])
        children = nodes.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(path, weights))
        children = children.join(known, path[:-1]) if path[:-1] else children.withColumn("budget", known.scalar())
        known = _divide(children, path[:-1], path[-1]).select(*path, "share").withColumnRenamed("share", "budget")
    return nodes.join(known, list(levels)).select(*levels, "supply", "budget")


def _weight(path: list[str], weights: Mapping[tuple[str, ...], int]) -> Column:
    weight = F.lit(1).cast("long")
    for names, value in weights.items():
        if len(names) == len(path):
            mine = F.lit(True)
            for level, name in zip(path, names):
                mine &= F.col(level) == name
            weight = F.when(mine, F.lit(value).cast("long")).otherwise(weight)
    return weight


def _divide(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Share of each child: all it has if that is less than its part of what the poorer ones leave."""
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.greatest("weight", F.lit(1)), name)
    whole = Window.partitionBy(*parent)
    upto, after = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(0, Window.unboundedFollowing)
    exact = lambda c: F.col(c).cast(EXACT)
    rows = children.withColumn("spent", F.sum("cap").over(upto) - F.col("cap")).withColumn("weights", F.sum("weight").over(after))
    short = exact("cap") * exact("weights") <= exact("weight") * (exact("budget") - exact("spent"))
    rows = rows.withColumn("short", F.min(short.cast("int")).over(upto) == 1)
    rows = rows.withColumn("rest", F.col("budget") - F.sum(F.when(F.col("short"), F.col("cap")).otherwise(0)).over(whole))
    rows = rows.withColumn("open", F.when(F.col("short"), 0).otherwise(F.col("weight")))
    rows = rows.withColumn("all", F.sum("open").over(whole)).withColumn("sofar", F.sum("open").over(upto))
    rows = rows.selectExpr("*", f"(CAST(sofar AS {EXACT}) * CAST(rest AS {EXACT})) DIV nullif(CAST(all AS {EXACT}), 0) AS high", f"(CAST(sofar - open AS {EXACT}) * CAST(rest AS {EXACT})) DIV nullif(CAST(all AS {EXACT}), 0) AS low")
    return rows.withColumn("share", F.when(F.col("short"), F.col("cap")).otherwise(F.col("high") - F.col("low")).cast("long"))


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[tuple[str, ...], int],
    percent: int,
    epochs: int,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    slice_digits: int = 3,
    prefix: str = "__",
) -> DataFrame:
    """``docs`` with a column for each level, epoch, tokens and taken (tokens of the prefix), a row per epoch that takes some.

    ``prefix`` goes before the names of these columns; ``free_prefix`` gives one that clashes with none of ``docs``.
    """
    names = [f"{prefix}{level}" for level in levels]
    count, id_, epoch_, taken_ = (f"{prefix}{c}" for c in ("tokens", "id", "epoch", "taken"))
    keys = list(levels)  # names of the narrow tables, which have no columns of ``docs``
    tagged = docs.withColumns({n: F.coalesce(v.cast("string"), F.lit(NONE)) for n, v in zip(names, levels.values())})
    tagged = tagged.withColumn(count, tokens(F.col(text_column))).where(F.col(count) > 0).withColumn(id_, F.col(id_column))
    narrow = materialize(tagged.select(*[F.col(n).alias(f"l_{k}") for n, k in zip(names, keys)], F.col(id_).alias("id"), F.col(count).alias("tokens")), "tagged")
    keys = [f"l_{k}" for k in keys]
    leaves = narrow.groupBy(*keys).agg(F.sum("tokens").alias("supply"))
    plan = budgets(leaves, keys, {tuple(p): w for p, w in weights.items()}, percent, epochs)
    plan = plan.withColumn("full", F.expr("budget DIV supply")).withColumn("left", F.expr("budget % supply"))
    plan = materialize(plan, "plan")

    def order(epoch: Column, id_: Column, count: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(id_.cast("string"), F.lit("\\N")), count.cast("string")))

    # Where the last epoch of each leaf ends.
    last = narrow.join(plan, keys).where("left > 0").withColumn("place", order(F.col("full"), F.col("id"), F.col("tokens")))
    last = last.withColumn("slice", F.substring("place", 1, slice_digits))
    sums = last.groupBy(*keys, "slice", "left").agg(F.sum("tokens").alias("size"))
    before = Window.partitionBy(*keys).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    cut = sums.where("start < left AND left <= start + size").select(*keys, "slice", "start")
    places = last.join(cut, [*keys, "slice"]).groupBy(*keys, "left", "start", "place").agg(F.sum("tokens").alias("size"), F.count(F.lit(1)).alias("copies"))
    inside = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    places = places.withColumn("start", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    ends = places.where("start < left AND left <= start + size").select(*keys, F.col("place").alias("end"), F.expr("(left - start) DIV copies").alias("part"))
    # Written, so that its size is known: a row per leaf, which Spark sends to the documents, not the other way round.
    plan = materialize(plan.join(ends, keys, "left").select(*keys, F.struct("full", "end", "part").alias("leaf")), "cuts")
    plan = plan.withColumnsRenamed({**dict(zip(keys, names)), "leaf": f"{prefix}leaf"})

    leaf = F.col(f"{prefix}leaf")
    chosen = tagged.join(plan, names).withColumn(epoch_, F.explode(F.sequence(F.lit(0).cast("long"), leaf["full"])))
    place = order(F.col(epoch_), F.col(id_), F.col(count))
    taken = F.when(F.col(epoch_) < leaf["full"], F.col(count)).when(place < leaf["end"], F.col(count)).when(place == leaf["end"], leaf["part"]).otherwise(0)
    return chosen.withColumn(taken_, taken).where(F.col(taken_) > 0).select(*docs.columns, *names, epoch_, count, taken_)


def cut_text(text: Column, taken: Column, whole: Column) -> Column:
    """The first ``taken`` words of a text of ``whole`` words, with the white space between them."""
    words = F.slice(F.regexp_extract_all(text, F.lit(f"[ \\t-\\r]*{WORD}"), F.lit(0)), F.lit(1), taken.cast("int"))
    return F.when(taken < whole, F.array_join(words, "")).otherwise(text)
