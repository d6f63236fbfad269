"""Documents that resemble a large group of near copies without being linked to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.llm import set_join


def test_strays_meet_the_group_and_each_other_at_once(documents, monkeypatch):
    common = [f"c{k}" for k in range(120)]
    group = [(i, " ".join([*common, f"o{i}"])) for i in range(200)]
    # Two of each are near copies of each other; similarity 0.63 with the group, less with other strays.
    strays = [(1000 + i, " ".join([*common, *[f"s{i // 2}x{k}" for k in range(60)], f"o{i}"])) for i in range(60)]
    levels, branch = [], set_join._Join.branch
    monkeypatch.setattr(set_join._Join, "branch", lambda self, frontier, known, level, last, low=None: levels.append(level) or branch(self, frontier, known, level, last, low))
    out = {r.doc_id: r.component_id for r in set_join.near_copies(documents(*group, *strays), small=20).collect()}
    assert out == {i: 0 for i, _ in group} | {i: i - i % 2 for i, _ in strays}
    assert levels == [1]


def test_levels_in_between_are_not_rows(spark):
    low = spark.range(300).select("id", F.transform(F.sequence(F.lit(1), F.lit(set_join.COORDINATES)), lambda i: F.hash(F.col("id") % 5, i)).alias("low"))
    join = set_join._Join(spark.range(0), low, 5, 75, 20)
    rows = spark.range(300).select("id", F.xxhash64(F.col("id") % 7).alias("node"))
    down = join.children(rows.join(low, "id"), range(2, 5))
    assert down._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1
    for level in (2, 3, 4):
        rows = join.children(rows.join(low, "id"), range(level, level + 1))
    assert sorted(map(tuple, down.collect())) == sorted(map(tuple, rows.collect()))
