"""Plans and source text: what must not be there when the tables are large."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from matchloom.plans import registry

registry.load()
PACKAGE = Path(__file__).resolve().parents[1] / "matchloom"
CHEAP = sorted(n for n in registry.CHECKS if n[0] in "aefjopuwx")


def plan_of(df) -> str:
    return df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("word", ["toPandas", "localCheckpoint", "crossJoin", r"\.collect\(", r"\.rdd\b", "F.broadcast", "toLocalIterator"])
def test_source_avoids(word):
    main = [p for p in PACKAGE.rglob("*.py") if PACKAGE / "llm" not in p.parents]
    assert [p.name for p in main if re.search(word, p.read_text())] == []


@pytest.mark.parametrize("name", CHEAP)
def test_no_pairwise_join(spark, sf_dir, name):
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(registry.QUERIES["f3_threshold"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert all(f in pushed for f in ("EqualTo(o_orderstatus,F)", "GreaterThan(o_totalprice,250000.0)", "GreaterThanOrEqual(o_orderdate,"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_custkey" not in schema
    plan = plan_of(registry.QUERIES["s7_feature_store"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(pool" in plan


def test_dedup_limits_before_the_shuffle(spark, sf_dir):
    plan = registry.QUERIES["a1_dedup"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
