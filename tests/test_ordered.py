"""Bucketed ordered operators against plain loops, with one key holding most rows."""

from __future__ import annotations

import datetime as dt
import random
import struct

import pytest
from pyspark.sql import functions as F

from matchloom.operators import ordered as O
from matchloom.operators.features import history_stats, rolling_form
from matchloom.operators.ranks import global_ranks, place, report_ranks


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = []
    for i in range(400):
        key = "hot" if rng.random() < 0.6 else rng.choice("abc")
        out.append((key, dt.date(2000, 1, 1) + dt.timedelta(days=rng.randrange(200)), i, rng.randrange(4)))
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, "k string, d date, i int, v int").withColumn("m", F.trunc("d", "MM"))


def per_key(rows):
    groups: dict = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_expanding_equals_loop(table, rows):
    got = {r.i: (r.s, r.n) for r in O.expanding_before(table, ["k"], "m", ["d", "i"], {"s": F.col("v"), "n": F.lit(1)}).collect()}
    for group in per_key(rows).values():
        for j, r in enumerate(group):
            assert got[r[2]] == (sum(x[3] for x in group[:j]), j)


@pytest.mark.parametrize("size", [1, 5, 40])
def test_rolling_equals_loop(table, rows, size):
    got = {r.i: r.f for r in O.rolling_before(table, ["k"], "m", ["d", "i"], "v", "f", size).collect()}
    assert len(got) == len(rows)
    for group in per_key(rows).values():
        for j, r in enumerate(group):
            assert got[r[2]] == sum(x[3] for x in group[max(0, j - size) : j])


def test_asof_is_strict_and_defaults(spark, table, rows):
    rng = random.Random(5)
    history = [(k, dt.date(2000, 1, 1) + dt.timedelta(days=d), rng.randrange(100)) for k in ("hot", "a") for d in rng.sample(range(200), 12)]
    hist = spark.createDataFrame(history, "k string, t date, rank int")
    got = {r.i: r.rank for r in O.asof_before(table.drop("m"), hist, ["k"], "d", "t", {"rank": 200}).collect()}
    assert len(got) == len(rows)
    for k, d, i, _ in rows:
        earlier = [(t, rank) for key, t, rank in history if key == k and t < d]
        assert got[i] == (max(earlier)[1] if earlier else 200)


def test_asof_same_day(spark):
    facts = spark.createDataFrame([("a", dt.date(2000, 5, 1)), ("b", dt.date(2000, 5, 1))], "k string, d date")
    hist = spark.createDataFrame([("a", dt.date(2000, 5, 1), 7), ("b", dt.date(2000, 4, 30), 9)], "k string, t date, rank int")
    assert sorted(tuple(r) for r in O.asof_before(facts, hist, ["k"], "d", "t", {"rank": 200}).select("k", "rank").collect()) == [("a", 200), ("b", 9)]


def test_ordinal_and_split(table, rows):
    order = {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])), 1)}
    got = {r.i: r.pos for r in O.with_ordinal(table, [], ["d"], ["i"], "pos").collect()}
    assert got == order
    for share in (0.0, 0.37, 0.8, 1.0):
        cut = int(len(rows) * share)
        split = {r.i: r.split for r in O.chronological_split(table, ["d"], ["i"], share).collect()}
        assert split == {i: "train" if n <= cut else "test" for i, n in order.items()}


def contests(spark, games):
    rows = [(p, s, dt.date(2000, 1, 1) + dt.timedelta(days=s // 2), a, gf, ga, 3 if gf > ga else 1 if gf == ga else 0) for p, s, a, gf, ga in games]
    return spark.createDataFrame(rows, "pool string, seq bigint, d date, actor string, gf bigint, ga bigint, points int")


def test_form_is_capped_and_sees_only_the_past(spark):
    games = [("p", i, "x", 2, 0) for i in range(7)]
    long = contests(spark, games)
    form = {r.seq: r.form for r in rolling_form(long).collect()}
    assert form == {0: 0, 1: 3, 2: 6, 3: 9, 4: 12, 5: 15, 6: 15}
    # Dropping the future leaves earlier rows as they are; two contests on one day are ordered.
    cut = {r.seq: (r.games, r.scored_avg) for r in history_stats(long.filter("seq < 4")).collect()}
    full = {r.seq: (r.games, r.scored_avg) for r in history_stats(long).collect()}
    assert cut == {s: full[s] for s in cut}
    assert full[0] == (0, 0.0) and full[1] == (1, 2.0)


@pytest.mark.parametrize("descending", [True, False])
def test_global_rank(spark, descending):
    rng = random.Random(1)
    data = [(i, float(rng.randrange(30)) if rng.random() > 0.1 else None, 5 if rng.random() < 0.7 else rng.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(data, "i int, x double, y int")
    got = {r.i: (r.rx, r.ry) for r in global_ranks(df, {"x": "rx", "y": "ry"}, descending).collect()}
    better = (lambda a, b: a > b) if descending else (lambda a, b: a < b)
    rank = lambda v, c: None if v is None else 1 + sum(1 for r in data if r[c] is not None and better(r[c], v))
    assert got == {i: (rank(x, 1), rank(y, 2)) for i, x, y in data}


@pytest.mark.parametrize("descending", [True, False])
def test_ranks_of_one_frequent_value(spark, descending):
    data = [(i, 7.0 if i % 10 else (None if i % 20 else 1e-300 * i), None) for i in range(400)]
    df = spark.createDataFrame(data, "i int, x double, y double")
    got = {r.i: (r.rx, r.ry) for r in global_ranks(df, {"x": "rx", "y": "ry"}, descending).collect()}
    small = {r.i: (r.rx, r.ry) for r in report_ranks(df, {"x": "rx", "y": "ry"}, descending).collect()}
    assert got == small and len(got) == 400 and all(ry is None for _, ry in got.values())
    assert global_ranks(df, {"x": "rx"}).columns == ["i", "x", "y", "rx"]


def test_places_have_the_order_of_doubles(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 1.0, 2.0, 4.0, 0.1, 1e308, -1e308, float("inf"), float("-inf"), float("nan"), 1 - 2**-53, 1 + 2**-52]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(2000)] + [2.0**e * (1 + d * 2**-52) for e in range(-40, 40) for d in (0, 1)]
    values = [v for v in values if v == v] + [float("nan")]
    got = {r.v: r.p for r in spark.createDataFrame([(v,) for v in values], "v double").select("v", place(F.col("v")).alias("p")).collect() if r.v == r.v}
    bits = lambda v: (1 if v >= 0 else -1) * (struct.unpack("<q", struct.pack("<d", abs(v)))[0])
    assert got == {v: bits(v) for v in values if v == v}
