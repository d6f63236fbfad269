"""Gradient boosted trees for several classes at once, by histograms.

Features are cut at quantiles into bins and the bins written as bytes, in blocks of rows that numpy reads without a copy. A
round grows one tree per class, all level by level: one pass over the blocks sums, for every class, node, feature and bin, the
slopes and curvatures of the softmax loss, and the driver picks each node's best cut from those sums. Below a cut only one of
the two nodes is summed; the other is what is left of the node above. Margins are written again every few rounds; between, tasks add up
the trees that are newer than the written margins.

Slopes and curvatures are rounded to whole multiples of 2^-32, so sums are exact and a fit doesn't depend on how tasks are
cut. Which rows a round samples follows from the numbers they got when they were written. What reaches the driver per pass is at most classes x nodes x features x bins
sums a task, added up on the executors first where tasks are many.

Defined results. Nulls and NaN in features are their own lowest bin, below every cut. Rows without a label are an error of
the caller. A class without rows keeps a low margin. An empty table can't be fitted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.session import settings
from matchloom.storage import materialize

Batches = Iterator[pa.RecordBatch]
UNIT = float(1 << 32)
BLOCK = 1 << 14
# A task reads one of the files the blocks were dealt to.
PASSES = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.files.openCostInBytes": "128m", "spark.sql.files.minPartitionNum": "1"}


@dataclass
class Tree:
    """A full binary tree in breadth-first order: feature (-1 at a leaf), highest bin of the left side, value."""

    feature: list[int]
    bin: list[int]
    value: list[float]
    gain: list[float]

    def is_cut(self, at: int) -> bool:
        """Whether a place, filled or not, has children."""
        return at < len(self.feature) and self.feature[at] >= 0

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Node each row ends in; ``bins`` is features x rows."""
        size, rows = len(self.feature), bins.shape[1]
        flat, column = np.ascontiguousarray(bins).reshape(-1), np.arange(rows)
        # A leaf's child is the leaf itself, as no bin is beyond its cut.
        feature, own = np.array(self.feature), np.arange(size)
        start, cut = np.where(feature < 0, 0, feature) * rows, np.where(feature < 0, 255, self.bin).astype(np.uint8)
        left = np.where(feature < 0, own, 2 * own + 1)
        at = np.full(rows, left[0])
        if feature[0] >= 0:
            at += bins[feature[0]] > cut[0]
        for _ in range(size.bit_length() - 2):
            place = start.take(at)
            place += column
            right = flat.take(place) > cut.take(at)
            at = left.take(at)
            at += right
        return at

    def margins(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value).take(self.leaves(bins))


@dataclass
class BoostedTrees:
    """A fitted model: cuts per feature, and for each round a tree per class."""

    features: list[str]
    classes: list[int]
    cuts: list[list[float]]
    start: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)

    @property
    def tree_count(self) -> int:
        return sum(map(len, self.rounds))

    def bins(self, values: list[np.ndarray]) -> np.ndarray:
        """features x rows: 0 for a missing value, else one more than the cuts below it."""
        out = np.empty((len(values), len(values[0]) if values else 0), np.uint8)
        for f, (x, cuts) in enumerate(zip(values, self.cuts)):
            out[f] = np.where(np.isnan(x), 0, np.searchsorted(np.array(cuts), x, side="left") + 1)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability``: one per class, by the softmax of the margins, and ``prediction``, the class of the largest."""

        @F.arrow_udf("array<double>")
        def score(*columns: pa.Array) -> pa.Array:
            bins = self.bins([c.to_numpy(zero_copy_only=False) for c in columns])
            p = softmax(margins(self.rounds, bins, np.array(self.start)[:, None]))
            offsets = np.arange(p.shape[1] + 1, dtype=np.int32) * p.shape[0]
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(p.T.ravel()))

        scored = df.withColumn("probability", score(*[F.col(f).cast("double") for f in self.features]))
        best = F.array_position("probability", F.array_max("probability")).cast("int")
        return scored.withColumn("prediction", F.element_at(F.array(*[F.lit(c) for c in self.classes]), best).cast("double"))

    def importances(self) -> list[float]:
        """Mean gain of the cuts on each feature, as shares."""
        gains, uses = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in (t for trees in self.rounds for t in trees):
            for f, gain in zip(tree.feature, tree.gain):
                if f >= 0:
                    gains[f] += gain
                    uses[f] += 1
        mean = gains / np.maximum(uses, 1)
        return (mean / (mean.sum() or 1)).tolist()

    def to_json(self) -> str:
        return json.dumps({**self.__dict__, "rounds": [[t.__dict__ for t in trees] for trees in self.rounds]})

    @classmethod
    def from_json(cls, text: str) -> BoostedTrees:
        kept = json.loads(text)
        return cls(**{**kept, "rounds": [[Tree(**t) for t in trees] for trees in kept["rounds"]]})


def softmax(m: np.ndarray) -> np.ndarray:
    e = np.exp(m - m.max(axis=0))
    return e / e.sum(axis=0)


def margins(rounds: list[list[Tree]], bins: np.ndarray, start: np.ndarray) -> np.ndarray:
    """classes x rows."""
    out = np.repeat(start, bins.shape[1], axis=1) if start.shape[1] == 1 else start.copy()
    for trees in rounds:
        for k, tree in enumerate(trees):
            out[k] += tree.margins(bins)
    return out


def drawn(rows: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """Which rows a round takes: by a hash of the row's number and the round's."""
    x = (rows.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((number * 0xD1B54A32D192ED03 + seed) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share


@dataclass(frozen=True)
class Fit:
    """Settings: ``l2`` and ``least_curvature`` (of a side of a cut) are those of the usual regularised trees."""

    rounds: int = 300
    depth: int = 5
    step: float = 0.05
    subsample: float = 0.8
    columns: float = 0.8
    bins: int = 64
    l2: float = 1.0
    least_curvature: float = 1.0
    seed: int = 42
    keep: int = 10


Block = tuple[int, bytes, bytes, bytes]


def _unpack(block: Block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of a block's rows, features x rows of bins, places of the classes, classes x rows of margins."""
    first, bins, label, before = block
    places = np.frombuffer(label, np.int32)
    rows = np.arange(first, first + len(places), dtype=np.int64)
    return rows, np.frombuffer(bins, np.uint8).reshape(width, -1), places, np.frombuffer(before, np.float64).reshape(-1, len(places))


Slopes = tuple[int, bytes, bytes]


def _slopes(fit: Fit, number: int, recent: list[list[Tree]], classes: int, width: int) -> Callable[[Block], Slopes]:
    """Of a block the rows that a round takes: how many, their bins, and slopes and curvatures of each class as whole multiples of 2^-32."""

    def run(block: Block) -> Slopes:
        rows, bins, label, margin = _unpack(block, width)
        taken = drawn(rows, number, fit.seed, fit.subsample)
        bins, label = bins[:, taken], label[taken]
        p = softmax(margins(recent, bins, margin[:, taken]))
        is_class = label == np.arange(classes)[:, None]
        return len(label), bins.tobytes(), np.rint(np.stack([p - is_class, 2 * p * (1 - p)], axis=1) * UNIT).tobytes()

    return run


def _histograms(growing: list[Tree], chosen: list[np.ndarray], summed: list[np.ndarray], level: int, width: int, most: int) -> Callable[[Iterator[Slopes]], Iterator[np.ndarray]]:
    """Sums over a task's rows: 2 (slopes, curvatures) x for each class the ``summed`` nodes x chosen features x bins."""
    first, sizes = (1 << level) - 1, [int(s.sum()) for s in summed]
    # Where each node of the tree so far has its sums; -1 where it has none.
    places = [np.concatenate([np.full(first, -1), np.where(s, s.cumsum() - 1, -1)]) for s in summed]

    def run(blocks: Iterator[Slopes]) -> Iterator[np.ndarray]:
        sums = [np.zeros((2, len(f), n * most), np.int64) for f, n in zip(chosen, sizes)]
        for count, bins, weights in blocks:
            bins, weights = np.frombuffer(bins, np.uint8).reshape(width, count), np.frombuffer(weights).reshape(len(growing), 2, count)
            for k, tree in enumerate(growing):
                place = places[k].take(tree.leaves(bins))
                live = np.flatnonzero(place >= 0)
                start, slope, curve = place.take(live) * most, weights[k, 0].take(live), weights[k, 1].take(live)
                for i, f in enumerate(chosen[k]):
                    cell = start + bins[f].take(live)
                    for s, values in enumerate((slope, curve)):  # a block's sums stay whole in doubles
                        sums[k][s, i] += np.bincount(cell, values, sizes[k] * most).astype(np.int64)
        yield np.concatenate([s.reshape(2, -1) for s in sums], axis=1)

    return run


def best_cut(slope: np.ndarray, curve: np.ndarray, fit: Fit) -> tuple[float, int, int]:
    """(gain, feature's place, bin) of the best cut of a node; sums are features x bins. Ties: first feature, lowest bin."""
    left_g, left_h = slope.cumsum(axis=1)[:, :-1], curve.cumsum(axis=1)[:, :-1]
    g, h = slope.sum(axis=1, keepdims=True), curve.sum(axis=1, keepdims=True)
    right_g, right_h = g - left_g, h - left_h
    gain = left_g**2 / (left_h + fit.l2) + right_g**2 / (right_h + fit.l2) - g**2 / (h + fit.l2)
    gain = np.where((left_h >= fit.least_curvature) & (right_h >= fit.least_curvature), gain, -np.inf)
    at = int(gain.argmax())
    return float(gain.flat[at]), at // gain.shape[1], at % gain.shape[1]


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most bins - 2 cuts per feature, so that bins (with the one for missing values) fit a byte."""
    at = [i / (bins - 1) for i in range(1, bins - 1)]
    shares = F.array(*[F.lit(a) for a in at])
    row = df.agg(*[F.percentile_approx(F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")), shares, 10_000).alias(f"c{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(row[f"c{i}"] or [])) for i in range(len(features))]


def train_boosted(df: DataFrame, features: Sequence[str], label: str = "label", classes: Sequence[int] = (0, 1, 2), fit: Fit = Fit()) -> BoostedTrees:
    """Fit on the rows of ``df``; labels are among ``classes``."""
    if not 3 <= fit.bins <= 256:
        raise ValueError("bins must be between 3 and 256")
    model = BoostedTrees(list(features), list(classes), quantile_cuts(df, features, fit.bins), [0.0] * len(classes))
    rows = _binned(df, model, label)
    with settings(df.sparkSession, PASSES):
        _grow(rows, model, fit)
    return model


def _binned(df: DataFrame, model: BoostedTrees, label: str) -> DataFrame:
    """Blocks of rows, written: number of the first row, bins, classes (their places) and margins as bytes."""
    features, classes, begin = model.features, np.array(model.classes), np.array(model.start)[:, None]

    def packed(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                part = batch.slice(at, BLOCK)
                bins = model.bins([part.column(f"f{i}").to_numpy(zero_copy_only=False) for i in range(len(features))])
                is_class = part.column("class").to_numpy()[:, None] == classes
                places = np.where(is_class.any(axis=1), is_class.argmax(axis=1), -1).astype(np.int32)
                values = [part.column("row")[0].as_py()], [bins.tobytes()], [places.tobytes()], [np.repeat(begin, len(part), axis=1).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["row", "bins", "class", "margins"])

    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(label).cast("int").alias("class"), *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)])
    spark = df.sparkSession
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BLOCK)}):
        # The blocks are dealt over all cores, whatever files the rows came from.
        return materialize(rows.mapInArrow(packed, "row long, bins binary, class binary, margins binary").repartition(spark.sparkContext.defaultParallelism), "binned")


def _cached(rows: DataFrame) -> RDD[Block]:
    """The blocks as an RDD: a pass is one job without a plan, whose cost would be most of the time of a fit."""
    return rows.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def _grow(rows: DataFrame, model: BoostedTrees, fit: Fit) -> None:
    """Add all rounds to the model."""
    classes, width, most = model.classes, len(model.features), fit.bins
    rng = np.random.default_rng(fit.seed)
    recent: list[list[Tree]] = []
    blocks = _cached(rows)
    # Sums of very many tasks are added up on the executors first.
    depth = 1 if blocks.getNumPartitions() <= 32 else 2
    for number in range(fit.rounds):
        chosen = [np.sort(rng.choice(width, max(1, round(fit.columns * width)), replace=False)) for _ in classes]
        growing = [Tree([-1], [0], [0.0], [0.0]) for _ in classes]
        above: list[np.ndarray] = []
        # All levels of a round read the same slopes.
        slopes = blocks.map(_slopes(fit, number, recent, len(classes), width)).persist(StorageLevel.MEMORY_AND_DISK)
        for level in range(fit.depth):
            nodes, first = 1 << level, (1 << level) - 1
            summed = [_summed(tree, features, above[k][1] if level else None) for k, (tree, features) in enumerate(zip(growing, chosen))]
            pass_ = slopes.mapPartitions(_histograms(growing, chosen, summed, level, width, most))
            sums, at, whole = pass_.treeReduce(np.add, depth), 0, []
            for k, features in enumerate(chosen):  # 2 x features x nodes x bins of each class
                size = len(features) * int(summed[k].sum()) * most
                whole.append(np.zeros((2, len(features), nodes, most), np.int64))
                whole[k][:, :, summed[k]] = sums[:, at : at + size].reshape(2, len(features), -1, most)
                at += size
                for node in np.flatnonzero(summed[k]) if level else ():
                    whole[k][:, :, node ^ 1] = above[k][:, :, node // 2] - whole[k][:, :, node]
            above, grown = whole, False
            for k, tree in enumerate(growing):
                for node in range(nodes):
                    if level == 0 or tree.is_cut((first + node - 1) // 2):
                        slope, curve = whole[k][:, :, node] / UNIT
                        grown |= _split(tree, first + node, slope, curve, chosen[k], fit)
            if not grown:
                break
        slopes.unpersist()
        recent = [*recent, growing]
        model.rounds.append(growing)
        if len(recent) == fit.keep and number + 1 < fit.rounds:
            rows, recent = materialize(rows.mapInArrow(_written(recent, width), rows.schema), "margins"), []
            blocks.unpersist()
            blocks = _cached(rows)
    blocks.unpersist()


def _summed(tree: Tree, features: np.ndarray, curves: np.ndarray | None) -> np.ndarray:
    """Which nodes of a level a pass sums: of the two below a cut the one of smaller curvature, as the other is the rest.

    ``curves`` holds the level above: the chosen features x nodes x bins.
    """
    if curves is None:
        return np.ones(1, bool)
    nodes = curves.shape[1]
    out = np.zeros(2 * nodes, bool)
    for parent in range(nodes):
        at = nodes - 1 + parent
        if tree.is_cut(at):
            bins = curves[np.searchsorted(features, tree.feature[at]), parent]
            out[2 * parent + int(2 * bins[: tree.bin[at] + 1].sum() > bins.sum())] = True
    return out


def _split(tree: Tree, at: int, slope: np.ndarray, curve: np.ndarray, chosen: np.ndarray, fit: Fit) -> bool:
    """Give a node its value and, if a cut gains, two children with theirs."""
    def value(g: float, h: float) -> float:
        return -fit.step * g / (h + fit.l2)

    if at == 0:
        tree.value[0] = value(slope[0].sum(), curve[0].sum())
    gain, f, cut = best_cut(slope, curve, fit)
    if not gain > 1e-9:
        return False
    more = 2 * at + 3 - len(tree.feature)
    if more > 0:
        for name, empty in (("feature", -1), ("bin", 0), ("value", 0.0), ("gain", 0.0)):
            getattr(tree, name).extend([empty] * more)
    tree.feature[at], tree.bin[at], tree.gain[at] = int(chosen[f]), cut, gain
    left_g, left_h = slope[f, : cut + 1].sum(), curve[f, : cut + 1].sum()
    tree.value[2 * at + 1] = value(left_g, left_h)
    tree.value[2 * at + 2] = value(slope[f].sum() - left_g, curve[f].sum() - left_h)
    return True


def _written(recent: list[list[Tree]], width: int) -> Callable[[Batches], Batches]:
    """Rows with the margins after the recent rounds."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            unpacked = [_unpack(block, width) for block in zip(*[c.to_pylist() for c in batch.columns])]
            after = [margins(recent, bins, before).tobytes() for _, bins, _, before in unpacked]
            yield batch.set_column(3, "margins", pa.array(after, pa.binary()))

    return run
