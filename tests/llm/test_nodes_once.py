"""A document in many nodes and groups meets its signature once."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.llm import set_join
from matchloom.storage import materialize


def test_signatures_are_joined_by_document(spark, monkeypatch):
    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialize(df, label)

    monkeypatch.setattr(set_join, "materialize", seen)
    lows = spark.range(40).select("id", F.sequence(F.lit(1), F.lit(set_join.COORDINATES)).alias("low"), F.unhex(F.repeat(F.lit("07"), set_join.COORDINATES)).alias("check"))
    texts = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"))
    join = set_join._Join(texts, lows, 5, 75, 3)
    in_many = spark.range(40).select("id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(30).cast("long"))).alias("g"))
    found = {tuple(r) for r in join.links(in_many.select("g", "id")).collect()}
    assert found == {(i, 0) for i in range(1, 40)}
    plan = plans["possible"]
    assert -1 < plan.index("Generate ") < plan.index("Join ")  # groups become rows again above the join

    known = spark.range(0).select("id", F.col("id").alias("component_id"))
    deeper, _, more = join.branch(in_many.select(F.col("g").alias("node"), "id"), known, 1, 1)
    assert not more and deeper.isEmpty()
    plan = plans["children"]
    assert -1 < plan.index("Generate ")
