"""The histogram booster against loops over all cuts, and its properties."""

from __future__ import annotations

import numpy as np
import pytest

from matchloom.operators import boosting, models

FIT = boosting.Fit(rounds=3, depth=2, step=0.3, subsample=1.0, columns=1.0, bins=8, keep=2)


def table(spark, n=240, seed=0, missing=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)).round(2)
    label = np.where(x[:, 0] > 0.4, 2, np.where(x[:, 1] + 0.3 * rng.normal(size=n) > 0, 1, 0))
    rows = [(int(c), *(None if missing and i % 17 == 0 and f == 2 else float(v) for f, v in enumerate(r))) for i, (c, r) in enumerate(zip(label, x))]
    return spark.createDataFrame(rows, "label int, a double, b double, c double"), label, np.array([[np.nan if v is None else v for v in r[1:]] for r in rows], float)


def plain_tree(bins, g, h, rows, depth, fit):
    """Nested tuples (feature, bin, left, right) or a leaf's value, by trying every cut."""
    score = lambda r: g[r].sum() ** 2 / (h[r].sum() + fit.l2)
    value = -fit.step * g[rows].sum() / (h[rows].sum() + fit.l2)
    best = None
    for f in range(len(bins)):
        for cut in range(fit.bins - 1):
            left, right = rows[bins[f, rows] <= cut], rows[bins[f, rows] > cut]
            if h[left].sum() >= fit.least_curvature and h[right].sum() >= fit.least_curvature:
                gain = score(left) + score(right) - score(rows)
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, f, cut, left, right)
    if not depth or best is None or best[0] <= 1e-9:
        return value
    _, f, cut, left, right = best
    return f, cut, plain_tree(bins, g, h, left, depth - 1, fit), plain_tree(bins, g, h, right, depth - 1, fit)


def nested(tree, at=0):
    return tree.value[at] if tree.feature[at] < 0 else (tree.feature[at], tree.bin[at], nested(tree, 2 * at + 1), nested(tree, 2 * at + 2))


def same(a, b):
    return a == pytest.approx(b, abs=1e-7) if not isinstance(a, tuple) else isinstance(b, tuple) and a[:2] == b[:2] and same(a[2], b[2]) and same(a[3], b[3])


@pytest.mark.parametrize("depth", [1, 2])
def test_trees_are_those_of_all_cuts(spark, depth):
    df, label, x = table(spark)
    fit = boosting.Fit(**{**FIT.__dict__, "depth": depth})
    model = boosting.train_boosted(df, ["a", "b", "c"], fit=fit)
    bins = model.bins(list(x.T))
    assert bins[2, 0] == 0 and bins.max() < fit.bins
    margins = np.zeros((3, len(label)))
    for trees in model.rounds:
        p = boosting.softmax(margins)
        for k, tree in enumerate(trees):
            want = plain_tree(bins, p[k] - (label == k), 2 * p[k] * (1 - p[k]), np.arange(len(label)), depth, fit)
            assert same(nested(tree), want)
        margins = boosting.margins([trees], bins, margins)
    scored = model.transform(df).select("label", "probability", "prediction").collect()
    assert all(sum(r.probability) == pytest.approx(1, abs=1e-12) and r.prediction == int(np.argmax(r.probability)) for r in scored)
    got = sorted(tuple(r.probability) for r in scored)
    assert np.allclose(got, sorted(map(tuple, boosting.softmax(margins).T)), atol=1e-9)


def test_fit_does_not_depend_on_partitions(spark):
    df, *_ = table(spark)
    fit = boosting.Fit(**{**FIT.__dict__, "columns": 0.7})
    one, many = (boosting.train_boosted(df.coalesce(1).sortWithinPartitions("a").repartition(n, "a"), ["a", "b"], fit=fit) for n in (1, 7))
    assert one.to_json() == many.to_json()


def test_sampling_learning_and_storing(spark, tmp_path):
    df, label, _ = table(spark, 900, 3)
    fit = boosting.Fit(rounds=12, depth=3, step=0.3, keep=5)
    model = boosting.train_boosted(df, ["a", "b", "c"], fit=fit)
    assert model.tree_count == 36
    hits = model.transform(df).where("label = prediction").count()
    assert hits > 0.85 * len(label)
    shares = model.importances()
    assert sum(shares) == pytest.approx(1) and min(shares[:2]) > shares[2]
    models.save(model, str(tmp_path / "m"))
    again, features = models.load(str(tmp_path / "m"))
    assert features == ["a", "b", "c"] and again.to_json() == model.to_json()
    share = boosting.drawn(np.arange(100_000), 7, 42, 0.8).mean()
    assert abs(share - 0.8) < 0.01 and (boosting.drawn(np.arange(100), 1, 42, 0.8) != boosting.drawn(np.arange(100), 2, 42, 0.8)).any()


def test_labels_of_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(1, 0.0, None)] * 30, "label int, a double, b double")
    model = boosting.train_boosted(df, ["a", "b"], fit=FIT)
    rows = model.transform(df).collect()
    assert {r.prediction for r in rows} == {1.0} and model.importances() == [0.0, 0.0]


def test_trees_may_end_at_any_level(spark):
    """One class's tree ends at its root while another's goes on."""
    rows = [(0 if i % 2 else 1, float(i % 2), float(i % 7)) for i in range(200)]
    df = spark.createDataFrame(rows, "label int, a double, b double")
    fit = boosting.Fit(rounds=2, depth=4, step=0.3, subsample=1.0, columns=1.0, bins=8, keep=1, l2=1.0, least_curvature=0.5)
    model = boosting.train_boosted(df, ["a", "b"], fit=fit)
    assert any(t.feature == [-1] for trees in model.rounds for t in trees)
    assert model.transform(df).filter("prediction <> label").isEmpty()


def test_a_level_of_one_tree_ends_above_another():
    rng = np.random.default_rng(5)
    sums = rng.integers(1, 9, (2, 3, 1, 8))
    tree = boosting.Tree([-1], [0], [0.0], [0.0])
    assert boosting._summed(tree, np.arange(3), sums[1]).tolist() == [False, False]
    assert not any(tree.is_cut(at) for at in range(31))
    tree = boosting.Tree([2, -1, -1], [3, 0, 0], [0.0] * 3, [1.0, 0.0, 0.0])
    left = 2 * sums[1, 2, 0, :4].sum() > sums[1, 2, 0].sum()
    assert boosting._summed(tree, np.arange(3), sums[1]).tolist() == [not left, bool(left)]


def test_a_fit_does_not_depend_on_tasks(spark, monkeypatch):
    df, _, _ = table(spark, n=400)
    fit = boosting.Fit(**{**FIT.__dict__, "depth": 3, "subsample": 0.7, "columns": 0.7, "rounds": 5})
    one = df.coalesce(1)
    want = boosting.train_boosted(one, ["a", "b", "c"], fit=fit).to_json()
    cuts = boosting._cached
    monkeypatch.setattr(boosting, "_cached", lambda rows: cuts(rows.repartition(40)))  # also sums in two steps
    monkeypatch.setattr(boosting, "BLOCK", 7)
    assert boosting.train_boosted(one, ["a", "b", "c"], fit=fit).to_json() == want
