"""Sequential two-sided rating.

Both ratings of a contest move by ``weight * (score - expectation)`` computed from the values before it,
so a row depends on another actor's state and no window can express it. Rows of a pool are folded in
order. With ``chunks`` above 1 the rows are cut into that many consecutive chunks, which run in parallel:

* pass 1 folds every chunk from the start rating;
* each further pass folds again the chunks whose start state changed, starting from the state the
  chunk before reached in the previous pass;
* it ends when no start state changes at all, so the ratings are those of one fold.

After pass k the first k chunks of each pool are final, so it always ends. A fold is sequential by nature: a chunk
forgets its start state only if it holds very many contests of each actor, and otherwise there are as many passes as
chunks in a pool. Several pools run side by side in any case, so more than one chunk is for single pools that are
too long for one task. The number of chunks is the caller's and never looks at the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.storage import materialize

START = 1500.0
RATED = ("elo_home", "elo_away", "elo_home_post", "elo_away_post")
END_SCHEMA = "__chunk int, pool string, actor string, rating double"


def _numbered(batch: pa.RecordBatch, side: str, places: dict[tuple, int]) -> list[int]:
    """The place of each row's (pool, actor); new ones are added to ``places``."""
    pool, actor = (pc.dictionary_encode(batch.column(n), null_encoding="encode") for n in ("pool", side))
    width = max(1, len(actor.dictionary))
    both = pool.indices.to_numpy(zero_copy_only=False).astype(np.int64) * width + actor.indices.to_numpy(zero_copy_only=False)
    found, at = np.unique(both, return_inverse=True)
    pools, actors = pool.dictionary.to_pylist(), actor.dictionary.to_pylist()
    own = [places.setdefault((pools[c // width], actors[c % width]), len(places)) for c in found.tolist()]
    return np.array(own, np.int64)[at].tolist() if own else []


def _walk(batches: Iterator[pa.RecordBatch], start: float, emit_rows: bool) -> Iterator[pa.RecordBatch]:
    """Fold sorted rows; yields the rows with ratings, or the state of the last pool at the end of each chunk.

    Chunks come one after the other. Inside one, rows of several pools may be mixed, as each pool's are in order.
    """
    chunk = last = None
    places: dict[tuple, int] = {}
    ratings: list[float | None] = []
    ends: list[tuple] = []

    def end() -> None:
        ends.extend((chunk, p, a, ratings[i]) for (p, a), i in places.items() if p == last and ratings[i] is not None)

    for batch in batches:
        if not batch.num_rows:
            continue
        homes, aways = _numbered(batch, "home", places), _numbered(batch, "away", places)
        ratings += [None] * (len(places) - len(ratings))
        chunks, pools = batch.column("__chunk").to_numpy(zero_copy_only=False), batch.column("pool")
        scores, weights = batch.column("__score").to_pylist(), batch.column("__weight").to_pylist()
        states = batch.column("__state").to_pylist() if "__state" in batch.schema.names else [None] * len(scores)
        cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
        out: tuple[list, ...] = ([], [], [], [])
        before_home, before_away, after_home, after_away = (o.append for o in out)
        for low, high in zip(cuts, cuts[1:]):
            if chunks[low] != chunk:
                if chunk is not None and not emit_rows:
                    end()
                chunk, ratings = int(chunks[low]), [None] * len(places)
            for h, a, score, weight, state in zip(homes[low:high], aways[low:high], scores[low:high], weights[low:high], states[low:high]):
                if state is not None:
                    ratings[h] = state
                    rh = ra = new_home = new_away = None
                else:
                    rh, ra = ratings[h], ratings[a]
                    rh, ra = start if rh is None else rh, start if ra is None else ra
                    expected_home = 1.0 / (1.0 + 10.0 ** ((ra - rh) / 400.0))
                    expected_away = 1.0 / (1.0 + 10.0 ** ((rh - ra) / 400.0))
                    ratings[h] = rh + weight * (score - expected_home)
                    ratings[a] = ra + weight * ((1.0 - score) - expected_away)
                    new_home, new_away = ratings[h], ratings[a]
                before_home(rh)
                before_away(ra)
                after_home(new_home)
                after_away(new_away)
            last = pools[high - 1].as_py()
        if emit_rows:
            arrays = [*batch.columns, *[pa.array(v, pa.float64()) for v in out]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, *RATED])
    if not emit_rows and chunk is not None:
        end()
        types = (pa.int32(), pa.string(), pa.string(), pa.float64())
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*ends), types)]
        if arrays:
            yield pa.RecordBatch.from_arrays(arrays, names=["__chunk", "pool", "actor", "rating"])


def _fold(rows: DataFrame, starts: DataFrame | None, order: list[str], chunks: int, start: float, emit_rows: bool) -> DataFrame:
    stream = rows
    if starts is not None:
        loaded = starts.select("__chunk", "pool", F.col("actor").alias("home"), F.col("rating").alias("__state"))
        stream = stream.withColumn("__state", F.lit(None).cast("double")).unionByName(loaded, allowMissingColumns=True)
    # With several chunks a partition holds whole chunks; otherwise whole pools.
    key = "__chunk" if chunks > 1 else "pool"
    parts = max(chunks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Whole pools may be mixed, so their rows are sorted by the number that tells them apart, not by a long common prefix.
    state = [F.col("__state").asc_nulls_last()] * (starts is not None)
    by = ["__chunk", "pool", *state, *order] if chunks > 1 else [*order, "pool"]
    stream = stream.repartition(parts, key).sortWithinPartitions(*by)
    if emit_rows:
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema) + "".join(f", {n} double" for n in RATED)
    else:
        schema = END_SCHEMA
    return stream.mapInArrow(lambda batches: _walk(batches, start, emit_rows), schema)


def sequential_rating(
    contests: DataFrame, order: list[str], score: str, weight: str, start: float = START, chunks: int = 1
) -> DataFrame:
    """Add the ratings of both sides before and after each contest.

    ``contests`` has string columns ``pool``, ``home`` and ``away``; ``order`` is a total order within a pool.
    """
    base = contests.withColumns({"__score": F.col(score).cast("double"), "__weight": F.col(weight).cast("double")})
    if chunks == 1:
        rated = _fold(base.withColumn("__chunk", F.lit(0)), None, order, 1, start, emit_rows=True)
        return rated.drop("__chunk", "__score", "__weight")
    # Range partitions of (pool, order) are consecutive slices of equal size, whatever the pool sizes.
    # They are written out, so that a chunk means the same rows in every pass.
    sliced = base.repartitionByRange(chunks, "pool", *order).withColumn("__chunk", F.spark_partition_id())
    sliced = materialize(sliced, "rating-chunks")
    ends = materialize(_fold(sliced, None, order, chunks, start, emit_rows=False), "rating-ends")
    starts = None
    # The first chunk is final after the first pass, and every pass makes at least one more final.
    for _ in range(chunks):
        following = ends.withColumn("__chunk", F.col("__chunk") + 1).filter(F.col("__chunk") < chunks)
        moved = _moved_chunks(following, starts, start)
        starts = following
        if moved.isEmpty():
            break
        again = _fold(sliced.join(moved, "__chunk", "left_semi"), starts.join(moved, "__chunk", "left_semi"), order, chunks, start, emit_rows=False)
        ends = materialize(ends.join(moved, "__chunk", "left_anti").unionByName(again), "rating-ends")
    rated = _fold(sliced, starts, order, chunks, start, emit_rows=True)
    if starts is not None:
        rated = rated.filter(F.col("__state").isNull())
    return rated.drop("__chunk", "__state", "__score", "__weight")


def _moved_chunks(new: DataFrame, old: DataFrame | None, start: float) -> DataFrame:
    """Chunks whose start state differs between two passes; an absent actor stands at the start rating."""
    key = ["__chunk", "pool", "actor"]
    before = old.select(*key, F.col("rating").alias("was")) if old is not None else new.limit(0).select(*key, F.col("rating").alias("was"))
    both = new.select(*key, "rating").join(before, key, "full")
    gap = F.abs(F.coalesce("rating", F.lit(start)) - F.coalesce("was", F.lit(start)))
    return materialize(both.filter(gap > 0).select("__chunk").distinct(), "rating-moved")


def final_ratings(rated: DataFrame, seq: str) -> DataFrame:
    """Rating of each (pool, actor) after its last contest."""
    side = lambda who: F.struct(F.col(who).alias("actor"), F.col(f"elo_{who}_post").alias("rating"))
    long = rated.select("pool", seq, F.explode(F.array(side("home"), side("away"))).alias("s")).select("pool", seq, "s.*")
    return long.groupBy("pool", "actor").agg(F.max_by("rating", seq).alias("rating"))
