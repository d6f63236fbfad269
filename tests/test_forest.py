"""The histogram forest against loops over rows and cuts, and its properties."""

from __future__ import annotations

import numpy as np
import pytest

from matchloom.operators import forest, models

GROWTH = forest.Growth(trees=6, depth=4, least_rows=3, bins=8)


def table(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5)).round(2)
    label = np.where(x[:, 0] > 0.4, 2, np.where(x[:, 1] + 0.3 * rng.normal(size=n) > 0, 1, 0))
    df = spark.createDataFrame([(int(c), *map(float, r)) for c, r in zip(label, x)], "label int, a double, b double, c double, d double, e double")
    return df, label, x


def impurity(rows, weights):
    w = rows * weights
    return w.sum() * (1 - ((w / w.sum()) ** 2).sum()) if w.sum() else 0.0


def test_cuts_are_the_best_of_all():
    rng = np.random.default_rng(1)
    weights, looked_at = np.array([0.5, 2.0, 1.0]), np.array([[3, 0], [1, 2], [0, 4]])
    sums = rng.integers(0, 9, (2, 3, 6, 3))
    sums[1] = sums[0].sum(axis=1, keepdims=True) // 6
    sums[1, :, 0] += sums[0].sum(axis=1) - sums[1].sum(axis=1)
    sums[:, 2, :, 1:] = 0  # one class only
    feature, cut, gain, left, right = forest.best_cuts(sums, looked_at, weights, 4)
    for node in range(3):
        best = (0.0, -1, 0)
        for i in range(2):
            for b in range(5):
                a, z = sums[i, node, : b + 1].sum(axis=0), sums[i, node, b + 1 :].sum(axis=0)
                g = impurity(a + z, weights) - impurity(a, weights) - impurity(z, weights)
                if a.sum() >= 4 and z.sum() >= 4 and g > best[0] + 1e-9:
                    best, sides = (g, looked_at[node, i], b), (a, z)
        assert feature[node] == best[1] and gain[node] == pytest.approx(best[0])
        if best[1] >= 0:
            assert cut[node] == best[2] and left[node].tolist() == sides[0].tolist() and right[node].tolist() == sides[1].tolist()
    assert feature[2] == -1


def test_counts_and_leaves_are_those_of_single_rows(spark, monkeypatch):
    """With rows in one block and in several: each node holds the drawn rows that meet its cuts."""
    df, label, x = table(spark)
    for block in (forest.BLOCK, 90):
        monkeypatch.setattr(forest, "BLOCK", block)
        grown = []
        monkeypatch.setattr(forest, "_pruned", lambda tree, model: grown.append(tree) or tree)
        model = forest.train_forest(df, list("abcde"), growth=GROWTH)
        monkeypatch.undo()
        assert model.tree_count == 6 and len({t.rows[0].tolist()[0] for t in grown}) > 1
        size = np.bincount(label, minlength=3)
        assert model.weights == pytest.approx([len(x) / (3 * n) for n in size])
        for tree in grown:
            for node in np.flatnonzero(tree.feature >= 0):
                below = tree.rows[tree.left[node]] + tree.rows[tree.left[node] + 1]
                assert below.tolist() == tree.rows[node].tolist() and tree.gain[node] > 0
                assert min(tree.rows[tree.left[node]].sum(), tree.rows[tree.left[node] + 1].sum()) >= 3
            assert abs(tree.rows[0].sum() - 400) < 120
        bins = model.bins(list(x.T))
        got = {i: r.probability for i, r in enumerate(model.transform(df).select("probability").collect())}
        for i in range(0, 400, 37):
            p = np.zeros(3)
            for tree in model.trees:
                at = 0
                while tree.feature[at] >= 0:
                    at = tree.left[at] + int(bins[i, tree.feature[at]] > tree.bin[at])
                p += tree.rows[at] * np.array(model.weights) / (tree.rows[at] * np.array(model.weights)).sum() / 6
            assert got[i] == pytest.approx(p.tolist())


def test_level_counts(spark):
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 24, (500, 5)).astype(np.uint8)
    codes -= codes % 3
    label = rng.integers(0, 3, 500).astype(np.uint8)
    codes += label[:, None]
    tree = forest.Tree(np.array([1, -1, 2, -1, -1]), np.array([3, 0, 5, 0, 0]), np.array([1, 0, 3, 0, 0]), np.zeros(5), np.zeros((5, 3)))
    sums = forest._tree_counts(codes, 4, 70, tree, np.array([3, 4]), 2, 3, GROWTH)
    times, looked_at = forest._drawn(500, 4, 70, GROWTH.seed), forest._looked_at(4, 2, 2, 5, GROWTH.seed)
    assert looked_at.shape == (2, 3) and all(len(set(r)) == 3 for r in looked_at.tolist())
    want = np.zeros((3, 2, 8, 3), int)
    for row, t, c in zip(codes // 3, times, label):
        if row[1] > 3:
            node = int(row[2] > 5)
            for i, f in enumerate(looked_at[node]):
                want[i, node, row[f], c] += t
    assert sums.reshape(3, 2, 8, 3).tolist() == want.tolist()
    assert forest._drawn(200_000, 0, 0, 1).mean() == pytest.approx(1, abs=0.02) and forest._drawn(200_000, 0, 0, 1).var() == pytest.approx(1, abs=0.03)


def test_pruned_leaves_predict_the_same(spark):
    model = forest.Forest(["a"], [0, 1, 2], [[0.0, 1.0, 2.0]], [1.0, 1.0, 1.0], 2)
    tree = forest.Tree(np.array([0, 0, -1, -1, -1]), np.array([1, 0, 0, 0, 0]), np.array([1, 3, 0, 0, 0]), np.array([5.0, 1.0, 0, 0, 0]), np.array([[5, 4, 0], [5, 1, 0], [0, 3, 0], [2, 1, 0], [3, 0, 0]]))
    kept = forest._pruned(tree, model)
    assert kept.feature.tolist() == [0, -1, -1] and kept.left[0] == 1 and kept.rows.tolist() == [[5, 4, 0], [5, 1, 0], [0, 3, 0]]


def test_saved_and_refused(spark, tmp_path):
    df, _, _ = table(spark, 120)
    model = forest.train_forest(df, list("abcde"), growth=GROWTH)
    assert sum(model.importances()) == pytest.approx(1) and max(model.importances()[:2]) > max(model.importances()[2:])
    models.save(model, str(tmp_path / "m"))
    back, features = models.load(str(tmp_path / "m"))
    rows = lambda m: [tuple(r) for r in m.transform(df).select("prediction", "probability").collect()]
    assert features == list("abcde") and rows(back) == rows(model)
    with pytest.raises(ValueError, match="known class"):
        forest.train_forest(df.limit(0), list("abcde"), growth=GROWTH)
    with pytest.raises(ValueError, match="known class"):
        forest.train_forest(df.selectExpr("label + 1 AS label", *"abcde"), list("abcde"), growth=GROWTH)
    with pytest.raises(Exception, match="null or NaN in b"):
        forest.train_forest(df.selectExpr("label", "a", "nullif(b, b) AS b", *"cde"), list("abcde"), growth=GROWTH)
    one = forest.train_forest(df.where("label = 1"), list("abcde"), growth=GROWTH)
    assert {tuple(r.probability) for r in one.transform(df).collect()} == {(0.0, 1.0, 0.0)}


def test_settings_train_this_forest(spark):
    df, _, _ = table(spark, 120)
    model = models.train("random_forest", df, models.Settings(forest_trees=3, forest_depth=2), list("abcde"))
    assert isinstance(model, forest.Forest) and model.tree_count == 3 and model.depth == 2
