"""What the join behind the contests moves."""

from __future__ import annotations

from matchloom.plans import views as V


def test_lines_are_shuffled_by_order_only_and_narrow(spark, sf_dir):
    lines = V.contest_lines(spark, sf_dir)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(l_suppkey" not in plan
    assert set(lines.columns) == {*V.CONTEST_KEY, *V.CONTEST_ORDER, "o_orderpriority"}


def test_columns_follow_from_the_first_complete_line(spark, sf_dir):
    once = V.contest_once(spark, sf_dir)
    assert once.columns == ["pool", "d", "home", "away", "home_score", "away_score", "tournament", "neutral", "stage", "attendance"]
    assert once.count() == once.select(*V.CONTEST_KEY).distinct().count()
    assert once.where("home_score IS NULL OR away_score IS NULL OR home = away").isEmpty()
