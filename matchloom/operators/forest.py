"""Random forest for several classes, by histograms.

Features are cut at quantiles into bins and written as bytes, in blocks of rows. A tree takes each row as often as a Poisson draw
says and each of its nodes looks at some features only. All trees grow level by level: a task has a block and some of
the trees and counts, for each node of the level, its features, their bins and the classes, the rows drawn. Counts
of a tree are added up in one task, which picks the best cut of each node by the Gini impurity of the weighted classes. What
reaches the driver are the cuts.

Blocks are large, because counts are shuffled once for each block. They are sent in the narrowest whole numbers that hold them,
and added up exactly, so a fit doesn't depend on how tasks are cut, only on how the rows were written to blocks.

Defined results. Nulls and NaN in features are an error, as are rows whose label is none of the classes and an empty table. A
class without rows has probability 0. Leaves below a node that predict the same class become one leaf.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators.boosting import quantile_cuts
from matchloom.session import settings
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]
BLOCK = 1 << 20
# A task reads one of the files the blocks were dealt to, and a block, or a tree's counts, at a time.
PASSES = {
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.files.openCostInBytes": "128m",
    "spark.sql.files.minPartitionNum": "1",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1",
}


@dataclass(frozen=True)
class Growth:
    """Settings: ``least_rows`` counts the rows drawn, on each side of a cut."""

    trees: int = 300
    depth: int = 12
    least_rows: int = 10
    bins: int = 32
    seed: int = 42


@dataclass
class Tree:
    """Nodes in the order they were made: feature (-1 at a leaf), highest bin of the left side, left child (the right one follows), gain times weight, rows drawn by class."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def narrow(self) -> Tree:
        """What ``ends`` reads, in few bytes."""
        return Tree(self.feature.astype(np.int16), self.bin.astype(np.uint8), self.left.astype(np.int32), np.zeros(0), np.zeros(0))

    def ends(self, codes: np.ndarray, at: np.ndarray, depth: int, classes: int = 1) -> np.ndarray:
        """Node each of the rows ``at`` ends in; ``codes`` (rows x features) are bins times classes plus the place of the row's class."""
        flat, width = codes.reshape(-1), codes.shape[1]
        # A leaf's child is the leaf itself, as no code is beyond its cut.
        leaf = self.feature < 0
        feature, cut = np.where(leaf, 0, self.feature).astype(np.intp), np.where(leaf, np.iinfo(codes.dtype).max, (self.bin.astype(int) + 1) * classes - 1).astype(codes.dtype)
        left = np.where(leaf, np.arange(len(leaf)), self.left).astype(np.intp)
        node, start = np.zeros(len(at), np.intp), at * width
        for _ in range(depth):
            right = flat.take(start + feature.take(node)) > cut.take(node)
            node = left.take(node) + right
        return node


@dataclass
class Forest:
    """A fitted model: cuts per feature, weight per class, and the trees."""

    features: list[str]
    classes: list[int]
    cuts: list[list[float]]
    weights: list[float]
    depth: int
    trees: list[Tree] = field(default_factory=list)

    @property
    def tree_count(self) -> int:
        return len(self.trees)

    def bins(self, values: list[np.ndarray]) -> np.ndarray:
        """rows x features: how many cuts are below each value."""
        out = np.empty((len(values[0]), len(values)), np.uint8)
        for f, (x, cuts) in enumerate(zip(values, self.cuts)):
            if np.isnan(x).any():
                raise ValueError(f"null or NaN in {self.features[f]}")
            out[:, f] = np.searchsorted(np.array(cuts), x, side="left")
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability``: the mean over trees of the class shares in a row's leaf, and ``prediction``, the likeliest class."""

        trees = [(tree.narrow(), self.shares(tree)) for tree in self.trees]
        empty = Forest(self.features, self.classes, self.cuts, self.weights, self.depth)

        @F.arrow_udf("array<double>")
        def score(*columns: pa.Array) -> pa.Array:
            bins = empty.bins([c.to_numpy(zero_copy_only=False).astype(float) for c in columns])
            p = np.zeros((len(bins), len(empty.classes)))
            for tree, shares in trees:
                p += shares.take(tree.ends(bins, np.arange(len(bins)), empty.depth), axis=0)
            p /= len(trees)
            return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))

        scored = df.withColumn("probability", score(*[F.col(f).cast("double") for f in self.features]))
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return scored.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), best).cast("double"))

    def shares(self, tree: Tree) -> np.ndarray:
        """nodes x classes; a tree that drew no row knows nothing."""
        weighted = tree.rows * np.array(self.weights)
        whole = weighted.sum(axis=1, keepdims=True)
        return np.where(whole > 0, weighted / np.where(whole > 0, whole, 1), 1 / len(self.classes))

    def importances(self) -> list[float]:
        """Gain of the cuts on each feature, weighted by rows, as shares of a tree and then of the forest."""
        total = np.zeros(len(self.features))
        for tree in self.trees:
            cut = tree.feature >= 0
            gains = np.bincount(tree.feature[cut], tree.gain[cut], len(self.features))
            total += gains / (gains.sum() or 1)
        return (total / (total.sum() or 1)).tolist()

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "trees": [{k: v.tolist() for k, v in t.__dict__.items()} for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Forest:
        kept = json.loads(text)
        return cls(**{**kept, "trees": [Tree(**{k: np.array(v) for k, v in t.items()}) for t in kept["trees"]]})


def train_forest(df: DataFrame, features: Sequence[str], label: str = "label", classes: Sequence[int] = (0, 1, 2), growth: Growth = Growth()) -> Forest:
    """Fit on the rows of ``df``, classes weighted so that each has the same sum."""
    if not 2 <= growth.bins <= 255:
        raise ValueError("bins must be between 2 and 255")
    sizes = df.agg(*[F.count(F.when(F.col(label) == c, 1)) for c in classes], F.count(F.lit(1))).first()
    rows, sizes = sizes[-1], sizes[:-1]
    if not rows or rows != sum(sizes):
        raise ValueError("a forest needs rows, all of a known class")
    present = sum(n > 0 for n in sizes)
    weights = [rows / (present * n) if n else 0.0 for n in sizes]
    # One bin less, as these cuts have no bin for missing values.
    model = Forest(list(features), list(classes), quantile_cuts(df, features, growth.bins + 1), weights, growth.depth)
    units = _units(df, model, label, rows, growth)
    with settings(df.sparkSession, PASSES):
        model.trees = [_pruned(t, model) for t in _grow(units, model, growth)]
    return model


def _units(df: DataFrame, model: Forest, label: str, rows: int, growth: Growth) -> DataFrame:
    """Blocks of rows, written, each with every group of trees: number of the block, group, codes of bins and classes as bytes."""
    spark = df.sparkSession
    cores, blocks = spark.sparkContext.defaultParallelism, -(-rows // BLOCK)
    groups = min(growth.trees, -(-2 * cores // blocks))
    classes, features = np.array(model.classes), model.features
    kind = _code_type(growth, len(classes))

    def coded(batches: Batches) -> Batches:
        for batch in batches:
            if len(batch):
                places = (batch.column("class").to_numpy()[:, None] == classes).argmax(axis=1)
                codes = model.bins([batch.column(f"f{i}").to_numpy(zero_copy_only=False).astype(float) for i in range(len(features))]).astype(kind) * kind(len(classes))
                yield pa.RecordBatch.from_arrays([pa.array([(codes + places.astype(kind)[:, None]).tobytes()], pa.binary())], ["codes"])

    def joined(batches: Batches) -> Batches:
        held = [(block, codes) for batch in batches for block, codes in zip(*(c.to_pylist() for c in batch.columns))]
        if held:
            codes = b"".join(h[1] for h in held)
            for group in range(groups):
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in ((held[0][0], pa.int64()), (group, pa.int32()), (codes, pa.binary()))], ["block", "group", "codes"])

    columns = [F.col(label).cast("int").alias("class"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]]
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(1 << 14)}):
        dealt = df.select(*columns).mapInArrow(coded, "codes binary").repartition(blocks).select(F.monotonically_increasing_id().alias("block"), "codes")
        return materialize(dealt.mapInArrow(joined, "block long, group int, codes binary").repartition(groups * blocks), "units")


def _code_type(growth: Growth, classes: int) -> type[np.unsignedinteger]:
    """One value is left for leaves."""
    return np.min_scalar_type(growth.bins * classes).type


def _looked_at(tree: int, level: int, nodes: int, width: int, seed: int) -> np.ndarray:
    """nodes x features: those each node of a tree's level may be cut on."""
    most = max(1, math.ceil(math.sqrt(width)))
    return np.random.default_rng((seed, tree, level)).random((nodes, width)).argsort(axis=1)[:, :most]


def _counts(trees: list[Tree], live: list[np.ndarray], level: int, groups: int, width: int, classes: int, growth: Growth) -> Callable[[Batches], Batches]:
    """(tree, kind, sums): features looked at x live nodes x bins x classes, how many rows were drawn."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for block, group, raw in zip(*(c.to_pylist() for c in batch.columns)):
                codes = np.frombuffer(raw, _code_type(growth, classes)).reshape(-1, width)
                for number in range(group, len(trees), groups):
                    if len(live[number]):
                        sums = _tree_counts(codes, number, block, trees[number], live[number], level, classes, growth)
                        sums = sums.astype(np.min_scalar_type(int(sums.max(initial=0))))
                        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([sums.dtype.str]), pa.array([sums.tobytes()], pa.binary())], ["tree", "kind", "sums"])

    return run


def _drawn(rows: int, number: int, block: int, seed: int) -> np.ndarray:
    """How often a tree takes each row of a block: Poisson draws of mean 1, to 16 bits."""
    return _POISSON.take(np.random.default_rng((seed, number, block)).integers(0, 1 << 16, rows, np.uint16))


# For each 16 bits the number whose share of the distribution they fall into.
_POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def _tree_counts(codes: np.ndarray, number: int, block: int, tree: Tree, live: np.ndarray, level: int, classes: int, growth: Growth) -> np.ndarray:
    width, size = codes.shape[1], growth.bins * classes
    times = _drawn(len(codes), number, block, growth.seed)
    at = np.flatnonzero(times)
    places = np.full(len(tree.feature), -1, np.intp)
    places[live] = np.arange(len(live))
    place = places.take(tree.ends(codes, at, level, classes))
    if level:
        still = np.flatnonzero(place >= 0)
        at, place = at.take(still), place.take(still)
    weight, start, own = times.take(at).astype(float), at * width, place * size
    looked_at = _looked_at(number, level, len(live), width, growth.seed)
    flat = codes.reshape(-1)
    out = np.empty((looked_at.shape[1], len(live) * size), np.int64)
    for i, feature in enumerate(looked_at.T):
        cell = feature.take(place)
        cell += start
        out[i] = np.bincount(own + flat.take(cell), weight, len(live) * size)
    return out


def _cuts(live: list[int], level: int, width: int, weights: list[float], growth: Growth) -> Callable[[Batches], Batches]:
    """From the counts of all blocks, ordered by tree: (tree, feature, bin, gain, left, right), for each node its best cut and the rows of its two sides by class."""

    def found(tree: int, sums: np.ndarray) -> pa.RecordBatch:
        looked_at = _looked_at(tree, level, live[tree], width, growth.seed)
        feature, cut, gain, left, right = best_cuts(sums.reshape(looked_at.shape[1], live[tree], growth.bins, len(weights)), looked_at, np.array(weights), growth.least_rows)
        values = [feature.astype(np.int32), cut.astype(np.int32), gain, left.astype(np.int64), right.astype(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *[pa.array([v.tobytes()], pa.binary()) for v in values]], ["tree", "feature", "bin", "gain", "left", "right"])

    def run(batches: Batches) -> Batches:
        tree, sums = None, None
        for batch in batches:
            for other, kind, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if other != tree:
                    if tree is not None:
                        yield found(tree, sums)
                    tree, sums = other, 0
                sums = sums + np.frombuffer(raw, kind).astype(np.int64)
        if tree is not None:
            yield found(tree, sums)

    return run


def best_cuts(sums: np.ndarray, looked_at: np.ndarray, weights: np.ndarray, least_rows: int) -> tuple[np.ndarray, ...]:
    """Of each node (feature, bin, gain times weight, rows left, rows right); feature -1 where no cut gains.

    ``sums``: features looked at x nodes x bins x classes. Ties: the feature looked at first, lowest bin.
    """
    left = sums.cumsum(axis=2)[:, :, :-1]
    all_rows = sums[0].sum(axis=1)
    right = all_rows[None, :, None] - left

    def impure(rows: np.ndarray) -> np.ndarray:
        """Gini impurity times weight."""
        weighted = rows * weights
        whole = weighted.sum(axis=-1)
        return whole - (weighted**2).sum(axis=-1) / np.where(whole > 0, whole, 1)

    gain = impure(all_rows)[None, :, None] - impure(left) - impure(right)
    gain = np.where((left.sum(axis=-1) >= least_rows) & (right.sum(axis=-1) >= least_rows), gain, -np.inf)
    nodes = np.arange(sums.shape[1])
    flat = gain.transpose(1, 0, 2).reshape(len(nodes), -1)
    at = flat.argmax(axis=1)
    i, cut, best = at // gain.shape[2], at % gain.shape[2], flat[nodes, at]
    gains = best > 1e-9 * (all_rows * weights).sum(axis=1)
    return np.where(gains, looked_at[nodes, i], -1), cut, np.where(gains, best, 0.0), left[i, nodes, cut], right[i, nodes, cut]


def _grow(units: DataFrame, model: Forest, growth: Growth) -> list[Tree]:
    """All trees, a level at a time."""
    classes, width = len(model.classes), len(model.features)
    weights = np.array(model.weights)
    groups = units.agg(F.max("group")).first()[0] + 1
    trees = [Tree(np.full(1, -1), np.zeros(1, int), np.zeros(1, int), np.zeros(1), np.zeros((1, classes), np.int64)) for _ in range(growth.trees)]
    live = [np.zeros(1, int) for _ in trees]
    tasks = units.sparkSession.sparkContext.defaultParallelism
    for level in range(growth.depth):
        counted = units.mapInArrow(_counts([t.narrow() for t in trees], [n.astype(np.int32) for n in live], level, groups, width, classes, growth), "tree int, kind string, sums binary")
        ordered = counted.repartition(tasks, "tree").sortWithinPartitions("tree")
        cuts = ordered.mapInArrow(_cuts([len(n) for n in live], level, width, model.weights, growth), "tree int, feature binary, bin binary, gain binary, left binary, right binary")
        found = cuts.agg(F.collect_list(F.struct("*")).alias("trees")).first()["trees"]
        for number, *raw in found:
            feature, cut, gain, left, right = (np.frombuffer(r, t) for r, t in zip(raw, (np.int32, np.int32, np.float64, np.int64, np.int64)))
            left, right = left.reshape(-1, classes), right.reshape(-1, classes)
            tree, nodes, is_cut = trees[number], live[number], feature >= 0
            if level == 0:
                tree.rows[0] = left[0] + right[0]
            first, more = len(tree.feature), 2 * int(is_cut.sum())
            tree.feature[nodes], tree.bin[nodes], tree.gain[nodes] = feature, cut, gain
            tree.left[nodes[is_cut]] = first + 2 * np.arange(more // 2)
            below = np.stack([left[is_cut], right[is_cut]], axis=1).reshape(more, classes)
            trees[number] = Tree(*[np.concatenate([a, b]) for a, b in zip(tree.__dict__.values(), (np.full(more, -1), np.zeros(more, int), np.zeros(more, int), np.zeros(more), below))])
            # A node of one class, or too small for a cut, stays a leaf.
            worth = ((below * weights > 0).sum(axis=1) > 1) & (below.sum(axis=1) >= 2 * growth.least_rows)
            live[number] = first + np.flatnonzero(worth)
        still = {r[0] for r in found}
        live = [n if number in still else n[:0] for number, n in enumerate(live)]
        if not any(len(n) for n in live):
            break
    return trees


def _pruned(tree: Tree, model: Forest) -> Tree:
    """Two leaves of a node that predict the same class become one, from the bottom up."""
    best, feature = model.shares(tree).argmax(axis=1), tree.feature.copy()
    for node in range(len(feature) - 1, -1, -1):  # children come after their node
        if feature[node] >= 0:
            a, b = tree.left[node], tree.left[node] + 1
            if feature[a] < 0 and feature[b] < 0 and best[a] == best[b]:
                feature[node] = -1
    kept = [0]
    for node in kept:  # grows as it is read
        if feature[node] >= 0:
            kept += [tree.left[node], tree.left[node] + 1]
    kept = np.array(kept)
    places = np.zeros(len(feature), int)
    places[kept] = np.arange(len(kept))
    left = np.where(feature[kept] >= 0, places[tree.left[kept]], 0)
    return Tree(feature[kept], tree.bin[kept], left, np.where(feature[kept] >= 0, tree.gain[kept], 0.0), tree.rows[kept])
