"""What a round sums: slopes are made once for all its levels."""

from __future__ import annotations

import numpy as np

from matchloom.operators import boosting as B


def walked(tree: B.Tree, bins: np.ndarray) -> list[int]:
    out = []
    for row in bins.T:
        at = 0
        while at < len(tree.feature) and tree.feature[at] >= 0:
            at = 2 * at + 1 + int(row[tree.feature[at]] > tree.bin[at])
        out.append(at)
    return out


def test_slopes_of_a_round_serve_all_its_levels():
    rng = np.random.default_rng(4)
    width, rows, most, fit = 3, 500, 8, B.Fit(subsample=0.7)
    bins, label = rng.integers(0, most, (width, rows)).astype(np.uint8), rng.integers(0, 3, rows).astype(np.int32)
    margin = rng.normal(size=(3, rows))
    made = B._slopes(fit, 5, [], 3, width)((10, bins.tobytes(), label.tobytes(), margin.tobytes()))
    taken = B.drawn(np.arange(10, 10 + rows), 5, fit.seed, fit.subsample)
    assert made[0] == taken.sum() < rows
    trees = [B.Tree([0, 1, -1], [3, 2, 0], [0.0] * 3, [0.0] * 3), B.Tree([2, -1, 0], [5, 0, 1], [0.0] * 3, [0.0] * 3), B.Tree([-1], [0], [0.0], [0.0])]
    chosen = [np.array([0, 2])] * 3
    p = B.softmax(margin)
    for level, summed in ((0, [np.ones(1, bool)] * 3), (1, [np.array([True, False]), np.array([False, True]), np.zeros(2, bool)])):
        grown = [B.Tree([-1], [0], [0.0], [0.0])] * 3 if level == 0 else [B.Tree(t.feature[:1], t.bin[:1], [0.0], [0.0]) for t in trees]
        (sums,) = B._histograms(grown, chosen, summed, level, width, most)(iter([made]))
        at = 0
        for k, tree in enumerate(grown):
            ends, nodes = walked(tree, bins), np.flatnonzero(summed[k])
            for f in chosen[k]:
                for node in nodes:
                    for b in range(most):
                        rows_ = [r for r in range(rows) if taken[r] and ends[r] == (1 << level) - 1 + node and bins[f, r] == b]
                        slope = sum(int(np.rint((p[k, r] - (label[r] == k)) * B.UNIT)) for r in rows_)
                        assert sums[0, at] == slope
                        at += 1
        assert at == sums.shape[1]


def test_leaves_of_deep_trees():
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 64, (4, 300)).astype(np.uint8)
    for depth in (1, 5, 9):
        inner, size = (1 << depth) - 1, (1 << depth + 1) - 1
        feature = [int(f) if i < inner else -1 for i, f in enumerate(rng.integers(-1, 4, size))]
        for i in range(1, size):
            if feature[(i - 1) // 2] < 0:
                feature[i] = -1
        tree = B.Tree(feature, rng.integers(0, 63, size).tolist(), [0.0] * size, [0.0] * size)
        assert tree.leaves(bins).tolist() == walked(tree, bins)
