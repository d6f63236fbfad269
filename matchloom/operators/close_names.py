"""Names that stay unmatched: one wrong character, or unknown characters spelt ``?``.

Candidates come from equal signatures, never from pairs. Keys at most one edit apart share a signature when each is given
with every one of its characters left out, and as it is. A ``?`` stands for exactly one character, so such a key and its
match have equal lengths, and equal characters at equal places: signatures are short runs of characters with their place
and the key's length. Candidates are then verified character by character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "?"
RUN = 4


def left_out(key: Column) -> Column:
    """The key, and the key without each one of its characters."""
    at = F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1)))
    return F.array_distinct(F.concat(F.array(key), F.transform(at, lambda i: F.concat(F.substr(key, F.lit(1), i - 1), F.substr(key, i + 1)))))


def _run(key: Column, at: Column, size: int) -> Column:
    return F.concat_ws(":", F.length(key), at, F.substr(key, at, F.lit(size)))


def placed_runs(key: Column, size: int) -> Column:
    """All runs of that many characters, with the key's length and their place."""
    count = F.length(key) - size + 1
    return F.when(count > 0, F.transform(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: _run(key, i, size))).otherwise(F.array().cast("array<string>"))


def known_run(key: Column) -> Column:
    """The first longest run without unknown characters, up to ``RUN`` of them; null if all are unknown."""
    out = F.lit(None).cast("string")
    for size in range(1, RUN + 1):
        at = F.filter(F.sequence(F.lit(1), F.greatest(F.length(key) - size + 1, F.lit(1))), lambda i: (F.length(F.substr(key, i, F.lit(size))) == size) & (F.instr(F.substr(key, i, F.lit(size)), UNKNOWN) == 0))  # noqa: B023
        out = F.when(F.size(at) > 0, _run(key, at[0], size)).otherwise(out)
    return out


def fits(key: Column, other: Column) -> Column:
    """Whether two keys have one length and equal characters wherever the first one's is known."""
    at = F.sequence(F.lit(1), F.greatest(F.length(key), F.lit(1)))
    same = lambda i: (F.substr(key, i, F.lit(1)) == UNKNOWN) | (F.substr(key, i, F.lit(1)) == F.substr(other, i, F.lit(1)))
    return (F.length(key) == F.length(other)) & F.forall(at, same)


def close_matches(asked: DataFrame, known: DataFrame) -> DataFrame:
    """(key, match): for each distinct ``key`` of ``asked`` the best ``key`` of ``known``, if there is one.

    An equal key comes first, then one edit away or, for keys with ``?``, one that fits; of several the smallest. Null
    and empty keys match nothing, nor do those of unknown characters only.
    """
    keys = asked.select("key").where("key <> ''").distinct()
    there = known.select(F.col("key").alias("match")).where("match <> ''").distinct()
    unsure = F.instr("key", UNKNOWN) > 0
    near = keys.where(~unsure).select("key", F.explode(left_out(F.col("key"))).alias("signature"))
    near = near.join(there.select("match", F.explode(left_out(F.col("match"))).alias("signature")), "signature").select("key", "match")
    near = near.where(F.levenshtein("key", "match", 1) >= 0)
    runs = there.select("match", F.explode(F.array_distinct(F.concat(*[placed_runs(F.col("match"), n) for n in range(1, RUN + 1)]))).alias("signature"))
    holed = keys.where(unsure).select("key", known_run(F.col("key")).alias("signature")).join(runs, "signature").select("key", "match")
    found = near.union(holed.where(fits(F.col("key"), F.col("match"))))
    best = found.groupBy("key").agg(F.min(F.struct((F.col("key") != F.col("match")).alias("far"), "match")).alias("best"))
    return best.select("key", "best.match")


def resolve_close(df: DataFrame, key: str, known: DataFrame, out: str) -> DataFrame:
    """``df`` with the best match of its normalised ``key`` as ``out``; null where there is none. As many rows as before."""
    matches = close_matches(df.select(F.col(key).alias("key")), known)
    return df.join(matches.select(F.col("key").alias("__key"), F.col("match").alias(out)), F.col(key) == F.col("__key"), "left").drop("__key")
