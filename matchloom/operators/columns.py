"""Column-level table operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.names import canonical_name, literal_map, normalized_id


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by mapping; names may hold dots and spaces. Unknown names are ignored."""
    return df.withColumnsRenamed(mapping)


def cast_or_default(text: Column, kind: str, default=None) -> Column:
    """Cast that yields null on bad text, then the default."""
    value = text.try_cast(kind)
    return value if default is None else F.coalesce(value, F.lit(default).cast(kind))


def difference_features(df: DataFrame, metrics: list[str], reversed_metrics: tuple[str, ...] = ()) -> DataFrame:
    """Add ``<metric>_diff``: home minus away, or away minus home where lower is better."""

    def gap(m: str) -> Column:
        return F.col(f"away_{m}") - F.col(f"home_{m}") if m in reversed_metrics else F.col(f"home_{m}") - F.col(f"away_{m}")

    return df.withColumns({f"{m}_diff": gap(m) for m in metrics})


def contains_anywhere(df: DataFrame, text: str) -> DataFrame:
    """Rows in which any column, read as text, contains ``text`` in any case."""
    hits = [F.contains(F.lower(F.col(c).cast("string")), F.lit(text.lower())) for c in df.columns]
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hits]))


def canonical_map(sources: list[DataFrame], aliases: dict[str, str]) -> DataFrame:
    """(key, name): display name per normalised name. Later sources win, aliases win over all sources.

    Each source has one column ``name``; within one source the last name in text order wins.
    """
    ranked = [s.select(normalized_id(F.col("name")).alias("key"), F.trim("name").alias("name"), F.lit(i).alias("priority")) for i, s in enumerate(sources)]
    if aliases:
        one = sources[0].sparkSession.range(1)
        ranked.append(one.select(F.explode(literal_map(aliases)).alias("key", "name"), F.lit(len(sources)).alias("priority")))
    everything = reduce(lambda a, b: a.unionByName(b), ranked).filter(F.col("key") != "")
    return everything.groupBy("key").agg(F.max(F.struct("priority", "name"))["name"].alias("name"))


def resolve_names(df: DataFrame, column: str, names: DataFrame, out: str) -> DataFrame:
    """Add the canonical name of ``column``; empty when it is unknown."""
    keyed = df.withColumn("__key", normalized_id(F.col(column)))
    mapped = names.select(F.col("key").alias("__key"), F.col("name").alias(out))
    return keyed.join(mapped, "__key", "left").withColumn(out, F.coalesce(out, F.lit(""))).drop("__key")


def lookup(df: DataFrame, dim: DataFrame, on: Column, value: str, default) -> DataFrame:
    """Left join to a table unique on its key, with a default for misses."""
    return df.join(dim, on, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def merge_by_precedence(universe: DataFrame, sources: list[DataFrame], key: str, value: str, default) -> DataFrame:
    """Per key the value of the first source that has one. Sources are unique on ``key``."""
    joined = universe
    for i, source in enumerate(sources):
        joined = joined.join(source.select(key, F.col(value).alias(f"__v{i}")), key, "left")
    first = F.coalesce(*[F.col(f"__v{i}") for i in range(len(sources))], F.lit(default))
    return joined.withColumn(value, first).drop(*[f"__v{i}" for i in range(len(sources))])


def canonical_columns(df: DataFrame, columns: list[str], aliases: dict[str, str]) -> DataFrame:
    return df.withColumns({c: canonical_name(F.col(c), aliases) for c in columns})
