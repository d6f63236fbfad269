"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are halved; each half has a codebook of its own, fitted by k-means on a bounded sample. The two nearest
code words of a vector name its cell in the product grid. To find the neighbours of a vector, cells are visited in
the order of a lower bound on the distance to anything inside them: a half's bound is the distance to the bisector
between its nearest code word and the cell's. A multi-sequence traversal over both sorted lists yields the cells in that
order and stops at 2 - 2 * threshold, the squared distance at the threshold. Nothing beyond that can be a link, so no
link is missed, whatever the table holds. What a cell holds is verified by cosine in double precision.

Bounds of that width exclude few cells, so vectors would be sent to most of them. Therefore cells lie on shelves, and a vector
is sent once to each pair of its own shelf and one that it visits a cell of, with the cells it visits there as bits. What is
sent first is a sketch, a byte for each component with a bound on its error: it tells which vectors can have a link in a pair of
shelves. Only those are sent there whole and verified, in double precision.

Equal vectors are one representative with a count, so copies cost nothing. A cell with very many vectors lies on several
shelves. A pair of shelves is a step of a task and returns link counts and a spanning forest of its links, never all pairs.

Defined results. Vectors that are null, empty, zero, or hold nulls or numbers that aren't finite link with nothing, nor
does a row without id; such a row has a null component and is kept. Vectors of different lengths aren't compared; those
of each length have an index of their own.
Rows that share an id are one vector with the links of all of them. Extra columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import batch_settings, components, partitions
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]
# What rounding can add to a squared distance of unit vectors, with a wide margin.
ROUNDING = 1e-12
# Components and cells of a shelf at most: its sketches are held by a task, and a bit stands for each of its cells.
SHELF = 1 << 23
CELLS = 62


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / largest  # so that squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def codebook(points: np.ndarray, words: int, rounds: int = 12) -> np.ndarray:
    if not points.shape[1]:  # a half of vectors of one component
        return np.zeros((1, 0))
    rng = np.random.default_rng(1)
    points = np.unique(points, axis=0)
    centres = points[rng.choice(len(points), min(words, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = ((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class Index:
    """Two codebooks; cells are numbered row by row."""

    def __init__(self, first: np.ndarray, second: np.ndarray) -> None:
        self.books = (first, second)
        self.gaps = [np.sqrt(((b[:, None] - b[None]) ** 2).sum(2)) for b in self.books]

    def halves(self, units: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: nearest code word and squared bounds for all words."""
        half = units.shape[1] // 2
        out = []
        for points, book, gaps in zip((units[:, :half], units[:, half:]), self.books, self.gaps):
            squares = (points**2).sum(1)[:, None] - 2 * points @ book.T + (book**2).sum(1)
            nearest = squares.argmin(1)
            apart = squares - squares[np.arange(len(points)), nearest][:, None]
            bound = np.maximum(apart - ROUNDING, 0) / (2 * np.maximum(gaps[nearest], 1e-12))
            bound[np.arange(len(points)), nearest] = 0
            out.append((nearest, bound**2))
        return out

    def cells(self, halves) -> np.ndarray:
        return halves[0][0] * len(self.books[1]) + halves[1][0]


def multi_sequence(first: np.ndarray, second: np.ndarray, radius: float) -> Iterator[tuple[int, int]]:
    """Pairs of positions in two lists in the order of the sums, up to ``radius``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(float(first[a[0]] + second[b[0]]), 0, 0)], {(0, 0)}
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > radius:
            return
        yield int(a[i]), int(b[j])
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (float(first[a[x]] + second[b[y]]), x, y))


def _measure(index: Index, width: int) -> Callable[[Batches], Batches]:
    """(cell, n): vectors in each cell."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            cells, counts = np.unique(index.cells(index.halves(unit(matrix(batch.column("vector"), width)))), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int64)), pa.array(counts.astype(np.int64))], ["cell", "n"])

    return run


Places = dict[int, list[tuple[int, int]]]


def shelves(sizes: dict[int, int], most: int) -> Places:
    """For each cell its places: shelf and number on it. A cell of more than ``most`` vectors has several shelves of its own."""
    places: Places = {}
    shelf, held, cells = 0, 0, 0
    for cell, n in sorted(sizes.items()):
        if cells and (held + n > most or cells == CELLS):
            shelf, held, cells = shelf + 1, 0, 0
        parts = -(-n // most)
        places[cell] = [(shelf + part, cells) for part in range(parts)]
        shelf, held, cells = (shelf, held + n, cells + 1) if parts == 1 else (shelf + parts, 0, 0)
    return places


def _own(places: list[tuple[int, int]], h1: int, h2: int) -> tuple[int, int]:
    """The place of a vector in its cell."""
    return places[hash((h1, h2, 7)) % len(places)]


def sketch(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers of a byte, the scale that makes them a vector again, and a bound on the distance between it and the given one."""
    scale = (np.abs(units).max(axis=1) / 127).astype(np.float32)
    whole = np.rint(units / scale.astype(float)[:, None]).clip(-127, 127).astype(np.int8)
    error = np.linalg.norm(units - whole * scale.astype(float)[:, None], axis=1)
    return whole, scale, np.nextafter(error.astype(np.float32), np.float32(np.inf))


SKETCHES = pa.schema([("low", pa.int32()), ("high", pa.int32()), ("side", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("own", pa.int32()), ("mask", pa.int64()), ("scale", pa.float32()), ("error", pa.float32()), ("whole", pa.binary())])


def _visit(index: Index, radius: float, places: Places, width: int) -> Callable[[Batches], Batches]:
    """The sketch of each vector, once for each pair of its own shelf and one that it visits."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            units = unit(matrix(batch.column("vector"), width))
            halves = index.halves(units)
            cells = index.cells(halves)
            whole, scale, error = sketch(units)
            rows: list[tuple] = []
            for k, (h1, h2) in enumerate(zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist())):
                shelf, own = _own(places[int(cells[k])], h1, h2)
                masks: dict[int, int] = {}
                for i, j in multi_sequence(halves[0][1][k], halves[1][1][k], radius):
                    for other, number in places.get(i * len(index.books[1]) + j, ()):
                        masks[other] = masks.get(other, 0) | 1 << number
                raw = whole[k].tobytes(), float(scale[k]), float(error[k])
                rows += [(min(shelf, other), max(shelf, other), int(shelf > other), h1, h2, own, mask, raw[1], raw[2], raw[0]) for other, mask in masks.items()]
                if len(rows) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), SKETCHES)], schema=SKETCHES)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), SKETCHES)], schema=SKETCHES)

    return run


def _pairs(batches: Batches) -> Iterator[tuple[tuple[int, int], int, pa.RecordBatch]]:
    """Runs of rows of one pair of shelves and one side, in order; a side comes in as many runs as there are batches."""
    for batch in batches:
        low, high, side = (batch.column(c).to_numpy() for c in ("low", "high", "side"))
        edges = np.flatnonzero((np.diff(low) != 0) | (np.diff(high) != 0) | (np.diff(side) != 0)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(low)]):
            if a < b:
                yield (int(low[a]), int(high[a])), int(side[a]), batch.slice(a, b - a)


class _Sketches:
    """Rows of one side of a pair, ordered by their cells."""

    def __init__(self, parts: list[pa.RecordBatch], width: int) -> None:
        rows = pa.Table.from_batches(parts).sort_by("own").combine_chunks()
        self.h1, self.h2, self.own, self.mask, scale, self.error = (rows.column(c).to_numpy() for c in ("h1", "h2", "own", "mask", "scale", "error"))
        whole = np.frombuffer(b"".join(rows.column("whole").to_pylist()), np.int8).reshape(-1, width)
        self.vectors = whole * scale[:, None]
        self.found = np.zeros(len(whole), bool)

    def candidates(self, pair: tuple[int, int], side: int) -> pa.RecordBatch:
        n, at = int(self.found.sum()), self.found
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, x, np.int32)) for x in (*pair, side)] + [pa.array(self.h1[at]), pa.array(self.h2[at])], ["low", "high", "side", "h1", "h2"])


def _candidates(threshold: float, width: int, step: int = 2048) -> Callable[[Batches], Batches]:
    """Which vectors may have a link in a pair of shelves, by sketches: those of the low side come first."""
    rounding = 2e-7 * (width + 64)  # of sums in single precision

    def compare(low: _Sketches, high: _Sketches, at: int, rows: int) -> None:
        """``rows`` of the low side from ``at`` on with the cells they visit on the high side."""
        mask, error = low.mask[at : at + rows], low.error[at : at + rows]
        for cell in np.unique(high.own):
            mine = np.flatnonzero(mask >> int(cell) & 1)
            first, end = np.searchsorted(high.own, [cell, cell + 1])
            for b in range(first, end, step) if len(mine) else ():
                other = slice(b, min(b + step, end))
                e, f = float(error[mine].max()), float(high.error[other].max())
                near = low.vectors[at + mine] @ high.vectors[other].T >= threshold - (e + f + e * f + rounding)
                if low is high:
                    near &= (at + mine)[:, None] != np.arange(b, other.stop)
                if near.any():
                    low.found[at + mine] |= near.any(axis=1)
                    high.found[other] |= near.any(axis=0)

    def run(batches: Batches) -> Batches:
        pair, sides = None, ([], [])

        def done() -> Batches:
            low, high = (_Sketches(s, width) if s else None for s in sides)
            if pair[0] == pair[1]:
                high = low
            if low and high:
                for at in range(0, len(low.own), step):
                    compare(low, high, at, step)
                yield low.candidates(pair, 0)
                if low is not high:
                    yield high.candidates(pair, 1)

        for here, side, rows in _pairs(batches):
            if here != pair:
                if pair is not None:
                    yield from done()
                pair, sides = here, ([], [])
            sides[side].append(rows)
        if pair is not None:
            yield from done()

    return run


def forest(hits: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that join what ``hits`` (rows x columns) connects: each id with the smallest of its part."""
    out: list[tuple[int, int]] = []
    fresh, unseen = hits.any(axis=1), np.ones(len(columns), bool)
    for start in np.flatnonzero(fresh):
        if not fresh[start]:
            continue
        inside_rows, inside_columns = [np.array([start])], []
        fresh[start] = False
        front = inside_rows[0]
        while len(front):
            reached = hits[front].any(axis=0) & unseen
            unseen &= ~reached
            at = np.flatnonzero(reached)
            inside_columns.append(at)
            front = np.flatnonzero(hits[:, at].any(axis=1) & fresh)
            fresh[front] = False
            inside_rows.append(front)
        ids = np.unique(np.concatenate([rows[np.concatenate(inside_rows)], columns[np.concatenate(inside_columns)]]))
        out += [(int(i), int(ids[0])) for i in ids[1:]]
    return out


def _verify(threshold: float, width: int, step: int = 1000) -> Callable[[Batches], Batches]:
    """Candidates of a pair of shelves, those of the low side first. Gives (kind, id, value): links counted, or a linked id."""

    def run(batches: Batches) -> Batches:
        pair, sides = None, ([], [])

        def done() -> Batches:
            low, high = ([pa.Table.from_batches(s)] if s else [] for s in sides)
            if pair[0] == pair[1]:
                high = low
            if not low or not high:
                return
            (ids, copies, units), (other_ids, other_copies, other_units) = ((t.column("id").to_numpy(), t.column("copies").to_numpy(), unit(matrix(t.column("vector").combine_chunks(), width))) for t in (*low, *high))
            counts, other_counts, joined = np.zeros(len(ids), np.int64), np.zeros(len(other_ids), np.int64), []
            for a in range(0, len(ids), step):
                for b in range(0, len(other_ids), step):
                    x, y = slice(a, a + step), slice(b, b + step)
                    hits = (units[x] @ other_units[y].T >= threshold) & (ids[x][:, None] != other_ids[y][None])
                    if hits.any():
                        counts[x] += hits @ other_copies[y]
                        other_counts[y] += copies[x] @ hits
                        joined += forest(hits, ids[x], other_ids[y])
            found = [(0, int(i), int(n)) for i, n in zip(ids, counts) if n] + [(1, u, v) for u, v in joined]
            if pair[0] != pair[1]:
                found += [(0, int(i), int(n)) for i, n in zip(other_ids, other_counts) if n]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64()) for i in range(3)], ["kind", "id", "value"])

        for here, side, rows in _pairs(batches):
            if here != pair:
                if pair is not None:
                    yield from done()
                pair, sides = here, ([], [])
            sides[side].append(rows)
        if pair is not None:
            yield from done()

    return run


def near_vectors(
    table: DataFrame,
    threshold: float = 0.95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    words: int = 32,
    sample: int = 20_000,
    recall: float = 1.0,
    block: int = 2048,
) -> DataFrame:
    """One row per row of ``table``: vec_id, n_links, component_id, kept.

    ``sample`` bounds the vectors the codebooks are fitted on; everything else covers all vectors. ``words``: code words
    per half at most. Every link is found, which meets any ``recall``.
    """
    spark = table.sparkSession
    batch_settings(spark)
    vector = F.col("vector")
    # Floats stay floats on disk; all that is compared or hashed is double.
    kind = "array<float>" if table.select(vector_column).dtypes[0][1] == "array<float>" else "array<double>"
    rows = table.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(kind).alias("vector"))
    fine = vector.isNotNull() & F.col("vec_id").isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vector, lambda x: x != 0)
    fine = F.coalesce(fine, F.lit(False))
    rows = rows.select("vec_id", F.when(fine, F.xxhash64(vector.cast("array<double>"))).alias("h1"), F.when(fine, F.xxhash64(F.lit(1), vector.cast("array<double>"))).alias("h2"), F.when(fine, vector).alias("vector"))
    unlinked = rows.where("h1 IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    named = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector"))
    named = materialize(named, "vectors")
    lengths = sorted(r["n"] for r in named.select(F.size("vector").alias("n")).distinct().collect())  # a row per length
    if not lengths:
        return unlinked.withColumn("kept", F.lit(True))
    links = reduce(DataFrame.union, [_links(named.where(F.size("vector") == n), n, threshold, words, sample, block) for n in lengths])
    counts = links.where("kind = 0").groupBy("id").agg(F.sum("value").alias("n"))
    found = components(links.where("kind = 1").select(F.col("id").alias("u"), F.col("value").alias("v")))
    known = named.select("h1", "h2", "id", "copies").join(counts, "id", "left").join(found, "id", "left")
    known = known.select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    linked = rows.where("h1 IS NOT NULL").select("vec_id", "h1", "h2").join(known, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    return linked.union(unlinked).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(named: DataFrame, dimension: int, threshold: float, words: int, sample: int, block: int) -> DataFrame:
    """(kind, id, value) of the links among vectors of one length: links counted, or a linked id."""
    spark = named.sparkSession
    drawn = named.select("id", "vector").orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    units = unit(np.array([r["vector"] for r in drawn]))
    half = dimension // 2
    words = min(words, math.ceil(math.sqrt(named.count() / block)))
    index = Index(codebook(units[:, :half], words), codebook(units[:, half:], words))
    measured = named.mapInArrow(_measure(index, dimension), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    sizes = {r["cell"]: r["n"] for r in measured}
    # About four pairs of shelves for each core, if there are enough vectors.
    total, cores = sum(sizes.values()), spark.sparkContext.defaultParallelism
    places = shelves(sizes, min(max(1, SHELF // dimension), max(block, math.ceil(total / math.ceil(math.sqrt(8 * cores))))))

    schema = "low int, high int, side int, h1 long, h2 long, own int, mask long, scale float, error float, whole binary"
    sketches = named.select("h1", "h2", "vector").mapInArrow(_visit(index, 2 - 2 * threshold + ROUNDING, places, dimension), schema)
    sketches = sketches.repartition(partitions(spark), "low", "high").sortWithinPartitions("low", "high", "side")
    found = materialize(sketches.mapInArrow(_candidates(threshold, dimension), "low int, high int, side int, h1 long, h2 long"), "candidates")
    whole = found.join(named, ["h1", "h2"]).select("low", "high", "side", "id", "copies", "vector")
    whole = whole.repartition(partitions(spark), "low", "high").sortWithinPartitions("low", "high", "side")
    return materialize(whole.mapInArrow(_verify(threshold, dimension), "kind long, id long, value long"), "links")
