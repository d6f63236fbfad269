"""The figures of the models, not only their properties; small ensembles keep it short."""

from __future__ import annotations

import pytest

from matchloom.operators import models
from matchloom.operators.features import FEATURES
from matchloom.plans import registry
from matchloom.plans.catalogue import models as catalogue

registry.load()


@pytest.fixture
def figures(spark, sf_dir, monkeypatch):
    """Query by name, with small models that are kept apart from the full ones."""
    monkeypatch.setattr(catalogue, "SETTINGS", models.Settings(max_iter=100, forest_trees=20, forest_depth=8, boost_rounds=5))
    return lambda name: registry.QUERIES[f"{name}_figures"](spark, f"{sf_dir}/.").collect()


def test_models_beat_nothing_but_are_sane(figures):
    table = {r.model_name: r for r in figures("m6_model_table")}
    assert set(table) == set(models.NAMES)
    assert sum(r.best for r in table.values()) == 1
    for r in table.values():
        cells = sum(map(sum, r.confusion_matrix))
        hits = sum(r.confusion_matrix[i][i] for i in range(3))
        assert r.accuracy == pytest.approx(hits / cells, abs=1e-4) and r.accuracy > 1 / 4
        assert r.performance_rank == 1 + sum(o.accuracy > r.accuracy for o in table.values())
    for code, name in (("m3_logreg", "logistic_regression"), ("m4_forest", "random_forest"), ("m5_boosted", "boosted_trees")):
        (own,) = figures(code)
        assert (own.model_name, own.accuracy, own.f1_macro, own.f1_weighted) == (name, table[name].accuracy, table[name].f1_macro, table[name].f1_weighted)
    told = {r.model_name: tuple(r) for r in figures("report_model_ranking")}
    assert told == {n: (n, r.accuracy, r.f1_macro, r.f1_weighted, r.performance_rank) for n, r in table.items()}
    importance = {r.feature: r.importance for r in figures("m6b_importance")}
    assert set(importance) == set(FEATURES) and sum(importance.values()) == pytest.approx(1) and len(set(importance.values())) > 5
    scored = figures("m7_batch_score")
    percents = [(r.away_pct, r.draw_pct, r.home_pct) for r in scored]
    assert len(scored) == sum(map(sum, table["boosted_trees"].confusion_matrix)) and len(set(percents)) > len(scored) / 2
    names = [(f"{r.away_team} Win", "Draw", f"{r.home_team} Win") for r in scored]
    assert all(sum(p) == pytest.approx(100, abs=1e-3) and p[r.pred] == max(p) and n[r.pred] == r.outcome for r, p, n in zip(scored, percents, names))
