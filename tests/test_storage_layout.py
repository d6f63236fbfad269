"""Layouts that let readers and writers leave most files alone; sketches; figures over a stream."""

from __future__ import annotations

import datetime as dt
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from matchloom.operators import sketches
from matchloom.sources import writers
from matchloom.streaming.form import FormStream


def parts(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_rewriting_one_partition(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(90).select((F.col("id") % 3).alias("pool"), "id")
    writers.write_feature_store(rows, path, "pool")
    before = parts(path)
    writers.rewrite_partitions(rows.where("pool = 1 AND id < 10"), path, "pool")
    after = parts(path)
    kept = {p for p in before if "pool=1" not in p}
    assert kept and {p: before[p] for p in kept} == {p: after[p] for p in kept} and not any(p in after for p in before if "pool=1" in p)
    store = spark.read.parquet(path)
    assert {r.pool: r["count"] for r in store.groupBy("pool").count().collect()} == {0: 30, 1: 3, 2: 30}
    wanted = spark.createDataFrame([(1, "x"), (2, "y")], "pool int, name string").where("name = 'y'")
    wanted.write.parquet(str(tmp_path / "wanted"))
    joined = store.join(spark.read.parquet(str(tmp_path / "wanted")).where("name = 'y'"), "pool")
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString() and joined.count() == 30


def test_lookup_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "lookup")
    rows = spark.range(40_000).select((F.xxhash64("id") % 1_000_000).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    writers.write_lookup(rows, path, "key", row_group_bytes=64 << 10)
    files = [pq.ParquetFile(p) for p in Path(path).rglob("*.parquet")]
    key = rows.orderBy("text").first()["key"]
    groups = [f.metadata.row_group(i).column(0) for f in files for i in range(f.metadata.num_row_groups)]
    assert len(groups) >= 8
    assert sum(g.statistics.min <= key <= g.statistics.max for g in groups) == 1
    found = spark.read.parquet(path).where(F.col("key") == int(key))
    plan = found._jdf.queryExecution().executedPlan()
    assert found.count() >= 1 and "PushedFilters: [IsNotNull(key), EqualTo(key" in plan.toString()


def test_sketches_merge(spark):
    rng = random.Random(1)
    rows = [(i % 2, i % 7, rng.randrange(3000), rng.random()) for i in range(20_000)] + [(3, 1, None, None)]
    df = spark.createDataFrame(rows, "g int, m int, v int, x double")
    stored = sketches.sketched(df, ["g", "m"], "v", "x")
    for group in (["g"], ["m"], []):
        got = sketches.merged(stored.where("g < 3"), group).select(*group, sketches.estimate(F.col("values")).alias("e"), sketches.quantile(F.col("numbers"), 0.5).alias("q")).collect()
        for r in got:
            mine = [t for t in rows if t[0] < 3 and all(t["gm".index(g)] == r[g] for g in group)]
            exact = len({t[2] for t in mine})
            assert abs(r.e - exact) <= exact * sketches.COUNT_ERROR
            assert abs(sum(t[3] <= r.q for t in mine) / len(mine) - 0.5) <= sketches.RANK_ERROR
    empty = sketches.merged(stored.where("g = 3"), ["g"]).select(sketches.estimate(F.col("values")).alias("e"), sketches.quantile(F.col("numbers"), 0.5).alias("q")).first()
    assert (empty.e, empty.q) == (0, None)


SIDES = "pool string, actor string, d date, seq long, gf int, ga int, points int, form string"


@pytest.mark.parametrize("cuts, files", [((), None), ((7, 20), None), ((3, 9, 15, 24), 1)])
def test_figures_over_a_stream(spark, cuts, files):
    """Equal to a loop over all rows, in any batching and after restarts; late rows get nothing and change nothing."""
    rng = random.Random(3)
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n // 2)
    rows = [("p" if rng.random() < 0.8 else None, rng.choice("aab"), day(n), n, rng.randrange(4), rng.randrange(4), rng.choice([0, 1, 3]), "x") for n in range(30)]
    late = [("p", "a", day(0), -1, 9, 9, 3, "x"), ("p", "a", None, 99, 9, 9, 3, "x")]
    stream = FormStream(spark.createDataFrame([], SIDES))
    edges = [0, *cuts, len(rows)]
    for low, high in zip(edges, edges[1:]):
        stream.land(spark.createDataFrame(rows[low:high], SIDES).repartition(2, "seq") if high > low else spark.createDataFrame([], SIDES), files if len(cuts) < 3 else None)
    stream.land(spark.createDataFrame(late, SIDES))
    want = set()
    for i, (pool, actor, d, seq, *_rest) in enumerate(rows):
        mine = [r for r in rows[:i] if r[:2] == (pool, actor)]
        want.add((pool, actor, seq, sum(r[6] for r in mine[-5:]), len(mine), sum(r[4] for r in mine), sum(r[5] for r in mine), sum(r[6] == 3 for r in mine), False))
    want |= {("p", "a", s, None, None, None, None, None, True) for s in (-1, 99)}
    got = [tuple(r) for r in stream.figures().collect()]
    assert len(got) == len(rows) + 2 and set(got) == want
