"""The stages of the corpus pipeline and the whole of it, against plain Python versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edges import EXACT, clashing, exact_groups, near_components, varied
from test_llm_queries import check_pieces

import corpus_pipeline
from matchloom.llm import language
from matchloom.llm.queries import MIX_SEED

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(autouse=True)
def untrained(monkeypatch):
    monkeypatch.setattr(language, "learn", lambda docs: language.Network.fresh(["aa", "bb"], 4, 1))


def has_letter(text):
    return any(c.isalpha() for c in text or "")


def exact_kept(rows):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        best[key] = min(best.get(key, r), r, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
    return list(best.values())


def near_kept(rows):
    low = near_components(rows)
    return [r for r in rows if low[r[0]][1] == r[0]]


def mix_kept(rows):
    """Of one leaf: 90 % of the words, documents in the order of a seeded digest, the last one cut."""
    sized = [(i, t, len(t.split())) for i, t in rows if t and t.split()]
    left, out = sum(n for *_, n in sized) * 90 // 100, {}
    for i, t, n in sorted(sized, key=lambda r: hashlib.md5(f"{MIX_SEED}:0:{r[0]}:{r[2]}".encode()).hexdigest()):
        if left > 0:
            out[i] = t if n <= left else " ".join(t.split()[:left])
        left -= n
    return out


def corpus(seed):
    rng = np.random.default_rng(seed)
    base = [[f"w{rng.integers(1 << 30)}" for _ in range(100)] for _ in range(4)]
    rows = [(i, varied(rng, base[i % 4], 0.012)) for i in range(1, 25)]
    rows += [(30 + i, " ".join(f"u{rng.integers(1 << 30)}" for _ in range(20 + i))) for i in range(10)]
    return [*rows, (50, rows[3][1]), (51, " " + rows[30][1]), (52, "12 34"), (53, ""), (54, None)]


def of(rows):
    return Counter((r[0], r[1]) for r in rows)


def run_stage(spark, name, docs):
    out = STAGES[name](spark, docs, "")
    assert name == "packing" or out.columns == docs.columns
    return out.collect()


def test_language(spark, documents):
    rows = [(1, "clean text"), (2, None), (3, ""), (4, "12 . 3"), (5, "x"), (5, "y"), (None, "z")]
    assert of(run_stage(spark, "language", clashing(documents(*rows)))) == of(r for r in rows if has_letter(r[1]))


def test_language_keeps_low_scores(spark, documents, monkeypatch):
    """With many languages no mean probability is high; the texts are clean all the same."""
    monkeypatch.setattr(language, "learn", lambda docs: language.Network.fresh([f"l{i}" for i in range(12)], 4, 1))
    rows = [(i, t) for i, t in enumerate(["clean text", "no", "ja und yes et si", "1"])]
    assert of(run_stage(spark, "language", documents(*rows))) == of(rows[:3])


def test_exact(spark, documents):
    rows = [r for r in EXACT if r != (2, "ab")]
    assert len(exact_kept(rows)) == len({key for *_, key in exact_groups(rows)})
    assert of(run_stage(spark, "exact_dedup", clashing(documents(*rows)))) == of(exact_kept(rows))


def test_near(spark, documents):
    rows = corpus(1)
    assert of(run_stage(spark, "near_dedup", clashing(documents(*rows)))) == of(near_kept(rows))


def test_near_row_by_row(spark, documents):
    """A copy goes; another text that shares its id stays, and so do nulls."""
    rows = [(3, "a b c d e f"), (5, "a b c d e f"), (5, "quite another text than that one"), (None, "a b c d e f"), (6, None)]
    assert of(run_stage(spark, "near_dedup", documents(*rows))) == of([rows[0], *rows[2:]])


def test_mixing(spark, documents):
    rows = corpus(2)
    out = run_stage(spark, "mixing", clashing(documents(*[(*r, "en", "src1") for r in rows])))
    assert {r.doc_id: r.text.split() for r in out} == {i: t.split() for i, t in mix_kept(rows).items()}
    assert len(out) == len(mix_kept(rows)) and all(r.n_chars == len(r.text) for r in out)


def test_packing(spark, documents):
    rows = corpus(3)
    check_pieces(run_stage(spark, "packing", clashing(documents(*rows))), dict(rows))


@pytest.mark.parametrize("name", STAGES)
def test_nothing(spark, documents, name):
    assert run_stage(spark, name, documents()) == []


def test_run(spark, documents, tmp_path):
    rows = corpus(4)
    docs = documents(*[(*r, "en", "src1") for r in rows]).withColumn("extra", F.lit(1))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    want = mix_kept(near_kept(exact_kept([r for r in rows if has_letter(r[1])])))
    check_pieces(corpus_pipeline.run(spark, str(tmp_path)).collect(), want)
