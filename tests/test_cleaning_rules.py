"""Renames in overlapping intervals, close names, bad lines and rows by rule."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from matchloom.functions.names import normalized_id
from matchloom.operators import clean
from matchloom.operators.close_names import close_matches, resolve_close
from matchloom.operators.ordered import time_folds
from matchloom.sources import describe, readers

DAY = dt.date(2000, 1, 1)


def test_renames_in_overlapping_intervals(spark):
    """As many rows out as in; of several intervals the latest start, then the latest end, then the greatest name wins."""
    rng = random.Random(5)
    day = lambda n: DAY + dt.timedelta(days=n)
    names = [(f"new{i}", f"old{i % 3}", day(a := rng.randrange(900)), day(a + rng.randrange(400))) for i in range(40)]
    names += [("x", "old0", None, day(5)), ("y", "old0", day(5), None), ("z", "old0", day(9), day(3)), ("w", None, day(0), day(900)), (None, "old1", day(0), day(900)), names[0]]
    facts = [(f"old{0 if rng.random() < 0.7 else rng.randrange(4)}", day(rng.randrange(1400))) for _ in range(800)] + [(None, day(3)), ("old0", None)]
    df = spark.createDataFrame(facts, "n string, d date").withColumn("month", F.lit(1))
    out = clean.rename_in_interval(df, "n", "d", spark.createDataFrame(names, "current string, former string, start_date date, end_date date"))
    assert out.columns == ["n", "d", "month", "n_current"]

    def current(n, d):
        hits = [(s, e, c) for c, f, s, e in names if c and f and s and e and d and f == n and s <= d <= e]
        return max(hits)[2] if hits else n

    key = lambda r: (r[0] or "", r[1] or DAY, r[2] or "")
    assert sorted(((r.n, r.d, r.n_current) for r in out.collect()), key=key) == sorted(((n, d, current(n, d)) for n, d in facts), key=key)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i] + [0] * len(b) if (before := row) else []
        for j, y in enumerate(b, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
    return row[-1]


def test_close_names(spark):
    rng = random.Random(2)
    known = sorted({"".join(rng.choice("abc ") for _ in range(rng.randrange(1, 7))).strip() or "a" for _ in range(60)}) + ["", None, "sao tome and principe"]
    asked = ["".join(rng.choice("abc? ") for _ in range(rng.randrange(1, 7))) for _ in range(150)] + ["", None, "?", "??", "s?o tom? and pr?ncipe", "s?o tom? and pr?ncip", known[3], known[3]]
    there = [k for k in known if k]

    def best(key):
        if not key or not key.strip("?"):
            return None
        fits = [k for k in there if (len(k) == len(key) and all(c in ("?", d) for c, d in zip(key, k)) if "?" in key else distance(key, k) <= 1)]
        return min(fits, key=lambda k: (k != key, k), default=None)

    table = spark.createDataFrame([(i, k, "x") for i, k in enumerate(asked)], "i int, k string, match string").drop("match")
    out = resolve_close(table, "k", spark.createDataFrame([(k,) for k in known], "key string"), "found")
    assert {r.i: r.found for r in out.collect()} == {i: best(k) for i, k in enumerate(asked)}
    assert best("s?o tom? and pr?ncipe") == "sao tome and principe"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    none = spark.createDataFrame([], "key string")
    assert close_matches(none, none).collect() == []


def test_broken_letters_find_their_team(spark):
    teams = spark.createDataFrame([("São Tomé and Príncipe",), ("Côte d'Ivoire",)], "team string")
    asked = spark.createDataFrame([("S?o Tom? and Pr?ncipe",), ("Cote d’Ivoir",)], "name string")
    out = resolve_close(asked.withColumn("key", normalized_id(F.col("name"))), "key", teams.select(normalized_id(F.col("team")).alias("key")), "found")
    assert {r.name: r.found for r in out.collect()} == {"S?o Tom? and Pr?ncipe": "sao tome and principe", "Cote d’Ivoir": "cote d'ivoire"}


def test_bad_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,day\n1,x,2020-01-01\nx,y,2020-01-01\n2,,\n3,z\n4,z,2020-02-31\n5,a,2020-01-02,more\n 6 ,\"q,r\",2020-01-03\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("id,name,day\n7,w,2020-01-04\n", encoding="utf-8")
    good, bad = readers.read_checked(spark, str(tmp_path), {"id": "int", "day": "date"})
    assert sorted((r.id, r.name, r.day) for r in good.collect()) == [(1, "x", dt.date(2020, 1, 1)), (2, None, None), (6, "q,r", dt.date(2020, 1, 3)), (7, "w", dt.date(2020, 1, 4))]
    told = {r.line: r.reason for r in bad.collect()}
    assert told == {"x,y,2020-01-01": "cast id", "3,z": "columns", "4,z,2020-02-31": "cast day", "5,a,2020-01-02,more": "columns"}
    assert all(r.file.endswith("a.csv") for r in bad.collect())
    (tmp_path / "none").mkdir()
    (tmp_path / "none/c.csv").write_text("")
    assert [t.count() for t in readers.read_checked(spark, str(tmp_path / "none"), {"id": "int"})] == [0, 0]


def test_steps(spark):
    steps = describe.Steps("t")
    rows = steps(steps(steps(spark.range(10), "read").where("id > 2"), "small").where("id % 2 = 0"), "odd")
    assert rows.count() == 3
    assert [(r.dataset, r.step, r.rule, r.n) for r in steps.report(spark).orderBy("step").collect()] == [("t", 0, "read", 10), ("t", 1, "small", 3), ("t", 2, "odd", 4), ("t", 3, "kept", 3)]


def test_time_folds(spark):
    rows = spark.createDataFrame([(DAY + dt.timedelta(days=i // 5), i) for i in range(23)], "d date, i int")
    got = {r.i: r.fold for r in time_folds(rows, ["d"], ["i"], 3).collect()}
    assert got == {i: i * 4 // 23 for i in range(23)}
