"""Sequential rating: one pass and chunks give what a plain loop gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchloom.operators.rating import final_ratings, sequential_rating


@pytest.fixture(scope="module")
def games():
    rng = random.Random(11)
    out = []
    for pool, n in (("big", 900), ("small", 60), ("tiny", 3)):
        for seq in range(n):
            home, away = rng.sample("abcdefgh", 2)
            out.append((pool, seq, home, away, rng.choice([0.0, 0.5, 1.0]), float(rng.choice([20, 30, 40, 60]))))
    return out


def loop(games):
    state: dict = {}
    out = {}
    for pool, seq, h, a, s, k in sorted(games):
        rh, ra = state.get((pool, h), 1500.0), state.get((pool, a), 1500.0)
        out[pool, seq] = (rh, ra)
        state[pool, h] = rh + k * (s - 1 / (1 + 10 ** ((ra - rh) / 400)))
        state[pool, a] = ra + k * ((1 - s) - 1 / (1 + 10 ** ((rh - ra) / 400)))
    return out, state


@pytest.mark.parametrize("chunks", [1, 3, 8])
def test_equals_loop(spark, games, chunks):
    want, want_final = loop(games)
    df = spark.createDataFrame(games, "pool string, seq bigint, home string, away string, s double, k double").repartition(7, "away")
    rated = sequential_rating(df, ["seq"], "s", "k", chunks=chunks).cache()
    got = {(r.pool, r.seq): (r.elo_home, r.elo_away) for r in rated.collect()}
    assert got.keys() == want.keys()
    assert max(abs(x - y) for key in want for x, y in zip(got[key], want[key])) < 1e-7
    final = {(r.pool, r.actor): r.rating for r in final_ratings(rated, "seq").collect()}
    assert final.keys() == want_final.keys()
    assert max(abs(final[k] - want_final[k]) for k in final) < 1e-7
    rated.unpersist()


def test_zero_sum(spark, games):
    df = spark.createDataFrame(games, "pool string, seq bigint, home string, away string, s double, k double")
    gained = final_ratings(sequential_rating(df, ["seq"], "s", "k"), "seq").agg(F.sum(F.col("rating") - 1500.0)).first()[0]
    assert abs(gained) < 1e-6
