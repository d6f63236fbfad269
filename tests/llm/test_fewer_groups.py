"""A group of near copies isn't compared once more in every tree."""

from __future__ import annotations

import numpy as np

from matchloom.llm import set_join
from matchloom.storage import materialize


def test_large_root_nodes_are_joined_in_few_trees(documents, monkeypatch):
    rows = [(i, " ".join([*[f"c{k}" for k in range(120)], f"o{i}"])) for i in range(200)]
    written = []

    def counted(df, label):
        out = materialize(df, label)
        if label == "groups":
            written.append(out.count())
        return out

    monkeypatch.setattr(set_join, "materialize", counted)
    out = set_join.near_copies(documents(*rows), small=20).collect()
    assert {r.component_id for r in out} == {0} and sum(r.kept for r in out) == 1
    assert sum(written) <= 6 * len(rows)


def test_further_trees_come_a_level_at_a_time(documents, monkeypatch):
    rng = np.random.default_rng(8)
    common = [f"c{i}" for i in range(80)]
    rows = [(i, " ".join(common + [f"o{i}x{k}" for k in rng.permutation(60)])) for i in range(160)]
    plans, grow = [], set_join._Join.grow
    monkeypatch.setattr(set_join._Join, "grow", lambda self, frontier, known, depth, last: plans.append(depth) or grow(self, frontier, known, depth, last))
    set_join.near_copies(documents(*rows), small=9)
    assert plans[:2] == [3, 4] and plans == sorted(set(plans))
    assert [set_join.next_level(n) for n in (1, 2, 3, 4, 7)] == [4, 4, 4, 7, 10]
