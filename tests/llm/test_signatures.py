"""Order MinHash, sharded Lloyd and whitening by slicing: against plain versions, with the edge rows."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_edges import LONG, clashing

from matchloom.llm import order_minhash, queries, sharded_lloyd, spectrum_whitening

# --- order MinHash

MASK = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & MASK
    x = ((x ^ (x >> 29)) * 0xCF1BBCDCB7A56463) & MASK
    return x ^ (x >> 32)


def plain_fingerprint(text, maker):
    """The same by a loop over k-mers, a dictionary of occurrences and a sort for each order."""
    if not text:
        return ""
    values = [mixed(ord(c) + 1) for c in text]
    values += [0] * (maker.k - len(values))
    weights = [int(w) for w in maker.weights]
    kmers = [mixed(sum(v * w for v, w in zip(values[i:], weights)) & MASK) for i in range(len(values) - maker.k + 1)]
    seen, numbered = Counter(), []
    for kmer in kmers:
        n = mixed((kmer + seen[kmer] * 0x9E3779B97F4A7C15) & MASK)
        numbered.append((n ^ (n >> 32)) & 0xFFFFFFFF)
        seen[kmer] += 1
    out = ""
    for a, b in zip(maker.a[:, 0].tolist(), maker.b[:, 0].tolist()):
        ranked = sorted(range(len(kmers)), key=lambda i: ((numbered[i] * a + b) & 0xFFFFFFFF, i))[: maker.size]
        state = 0
        for i in sorted(ranked):
            state = mixed((state * 0x9E3779B97F4A7C15 + kmers[i] + 1) & MASK)
        out += f"{state >> 32:08x}"
    return out


@pytest.mark.parametrize("k, size", [(8, 2), (5, 3), (1, 1)])
def test_fingerprints(k, size):
    maker = order_minhash.OrderMinHash(k, size, 16)
    for text in ("", "a", "abcabcabcabcabc", "ä€😀 b\x00c" * 9, "x" * 300, "the dog and the cat " * 40, " ".join(f"w{i % 91}" for i in range(3000))):
        assert maker.fingerprint(text) == plain_fingerprint(text, maker)
    assert maker.fingerprint(None) == ""


def test_order_of_passages_counts():
    """The same k-mers in another order are less alike than under a set; small edits stay near."""
    rng = random.Random(1)
    parts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(40)]
    moved = parts[:]
    rng.shuffle(moved)
    maker = order_minhash.OrderMinHash()
    text, shuffled, edited = " ".join(parts), " ".join(moved), " ".join(parts[:-1])
    of = maker.fingerprint
    assert order_minhash.alike(of(text), of(shuffled)) < 0.75 < order_minhash.alike(of(text), of(edited))
    assert order_minhash.alike(of(text), of("other " * 100)) == 0


def plain_comparison(rows, maker):
    """Rows by falling id, each with the next one."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for i, (id_, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + other[:third]
        marks = [maker.fingerprint(t) for t in (text, edited, other)]
        near = [1.0 if not marks[0] and not m else 0.0 if not marks[0] or not m else np.mean([marks[0][j : j + 8] == m[j : j + 8] for j in range(0, len(m), 8)]) for m in marks[1:]]
        out.append((id_, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks[0], marks[1], *near))
    return Counter(out)


def test_compare_next_rows(documents):
    maker = order_minhash.OrderMinHash()
    rows = [(1, None), (2, ""), (5, LONG), (4, "ab"), (9, "é" * 10 + "😀" * 9), (8, "the dog and the cat"), (7, "the dog and the cat"), (3, LONG + " end"), (None, "none of these")]
    out = order_minhash.compare_next(clashing(documents(*rows)).withColumns({"part": F.lit(1), "first": F.lit("x"), "tie": F.lit(2), "other": F.lit(3)}))
    assert Counter(map(tuple, out.collect())) == plain_comparison(rows, maker)
    for few in ([(1, "just this one")], [(1, ""), (2, "abc abc abc abc")]):
        assert Counter(map(tuple, order_minhash.compare_next(documents(*few)).collect())) == plain_comparison(few, maker)
    same = order_minhash.compare_next(documents((1, "one text"), (1, "one text"), (1, "one text"))).collect()
    assert len(same) == 3 and all(r.near_next == 1 for r in same)
    assert order_minhash.compare_next(documents()).collect() == []


def test_compare_next_over_a_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    out = queries.QUERIES["op11_order_minhash"](spark, sf_dir).collect()
    assert Counter(map(tuple, out)) == plain_comparison(rows, order_minhash.OrderMinHash())
    assert sum(r.near_edited > r.near_next for r in out) >= 0.98 * len(out)


def test_likeness_of_columns(spark, documents):
    docs = documents((1, "the dog and the cat"), (2, "the dog and the cow"), (3, ""), (4, None))
    mark = order_minhash.fingerprint()
    rows = docs.select("doc_id", mark(F.coalesce("text", F.lit(""))).alias("f"))
    pairs = rows.alias("a").join(rows.withColumnsRenamed({"doc_id": "o", "f": "g"}), F.col("doc_id") <= F.col("o")).select("f", "g", order_minhash.likeness(F.col("f"), F.col("g")).alias("l"))
    assert all(r.l == order_minhash.alike(r.f, r.g) for r in pairs.collect())


# --- sharded Lloyd

VECTORS = "vec_id long, embedding array<double>, x string, row string, block string, cluster string"


def plain_lloyd(rows, clusters, rounds, dimensions):
    kept = [(i, [int(np.floor(1024 * c)) for c in v]) for i, v in rows if v is not None and len(v) == dimensions and all(c is not None and np.isfinite(c) for c in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [x for _, x in start[:clusters]]
    distance = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c))
    nearest = lambda x: min(range(len(centres)), key=lambda j: (distance(x, centres[j]), j))
    for _ in range(rounds):
        of = [nearest(x) for _, x in kept]
        for j in set(of):
            mine = [x for (_, x), c in zip(kept, of) if c == j]
            centres[j] = [sum(column) // len(mine) for column in zip(*mine)]
    of = [nearest(x) for _, x in kept]
    return Counter((i, j, distance(x, centres[j])) for (i, x), j in zip(kept, of)), centres


def lloyd(spark, rows, clusters, rounds, dimensions, width):
    table = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], VECTORS)
    order = F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256)
    found, centres = sharded_lloyd.cluster(table, order, clusters, rounds, dimensions, width=width)
    return Counter((r.vec_id, r.cluster, r.distance) for r in found.collect()), centres


def test_lloyd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(80)]
    rows += [(100, None), (101, []), (102, [1.0] * 5), (103, [1.0] * 5 + [None]), (104, [1.0] * 5 + [float("nan")]), (105, [float("inf")] * 6), (106, rows[3][1]), (3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (107, [-0.0] * 6)]
    for clusters, rounds, width in ((5, 4, 2), (5, 0, 4), (3, 3, 6)):  # also a last block that is narrower
        assert lloyd(spark, rows, clusters, rounds, 6, width) == plain_lloyd(rows, clusters, rounds, 6)


def test_lloyd_ties_and_few_vectors(spark):
    rows = [(i, [0.5, -0.25]) for i in range(7)] + [(9, [1.0, 1.0])]
    for some in (rows, rows[:1], rows[:3]):
        assert lloyd(spark, some, 4, 3, 2, 1) == plain_lloyd(some, 4, 3, 2)
    assert lloyd(spark, [], 4, 3, 2, 1) == (Counter(), [])
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert queries.lloyd_columns(table).collect() == []


# --- whitening


def symmetric(rng, values):
    basis, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    return basis @ np.diag(values) @ basis.T


def test_inertia():
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 20):
        for _ in range(10):
            a = rng.normal(size=(n, n))
            a = a + a.T
            assert spectrum_whitening.inertia(a) == (np.linalg.eigvalsh(a) < 0).sum()
    assert spectrum_whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]])) == 1
    assert spectrum_whitening.inertia(np.zeros((3, 3))) == 0


@pytest.mark.parametrize("values", [[9.0, 5.0, 4.0, 1.0, 0.5], [3.0, 3.0, 3.0, 1.0, 1.0], [2.0, 2.0 - 1e-9, 1.0, 1e-3, 0.0], [1e8, 1.0, 1.0, 0.0, 0.0], [0.0] * 5, [7.0]])
def test_leading_eigenvalues(values):
    v = symmetric(np.random.default_rng(1), values)
    v = (v + v.T) / 2
    found = spectrum_whitening.leading(v, 4)
    want = [x for x in values[:4] if x > 0]
    assert len(found) == len(want)
    assert np.allclose([f[0] for f in found], want, rtol=1e-12, atol=1e-13 * max(values))
    vectors = np.array([f[1] for f in found]).reshape(-1, len(values))
    assert np.allclose(vectors @ vectors.T, np.eye(len(found)), atol=1e-10)
    assert all(np.linalg.norm(v @ u - e * u) <= 1e-13 * max(values) for e, u in found)


def test_exact_products():
    rng = np.random.default_rng(2)
    for size in (100, 1 << 27, 1 << 40):
        x = rng.integers(-size, size, (7, 3))
        want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(3)] for i in range(3)]
        assert np.array(spectrum_whitening.exact_products(x)).tolist() == want


def check_whitened(out, rows, components=8):
    """Against numpy's eigenvectors, up to signs; deviations in Python's whole numbers."""
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in rows], np.int64)
    n = len(x)
    sums = [int(s) for s in x.sum(axis=0)]
    want = Counter((i, sum((n * int(a) - s) ** 2 for a, s in zip(r, sums))) for (i, _), r in zip(rows, x))
    e, u = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    e, u = e[::-1], u[:, ::-1]
    k = min(components, x.shape[1])
    for c in range(k):
        mine = [r for r in out if r.component == c + 1]
        assert Counter((r.vec_id, r.deviation) for r in mine) == want and {r.n for r in mine} == {n}
        assert all(abs(r.explained - e[c] / e.sum()) < 1e-10 and r.identity_error < 1e-9 for r in mine)
        assert np.allclose(sorted(abs(r.whitened) for r in mine), sorted(abs((x - x.mean(axis=0)) @ u[:, c] / np.sqrt(e[c]))), atol=1e-7)
    assert len(out) == k * n


def test_whitening_of_a_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check_whitened(queries.QUERIES["op13_spectrum_whitening"](spark, sf_dir).collect(), rows)


def test_whitening_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=5) * [5, 4, 3, 2, 1]).tolist()) for i in range(40)] + [(3, [9.0] * 5), (3, [9.0] * 5), (None, [2.0] * 5)]
    bad = [(50, None), (51, []), (52, [1.0] * 4), (53, [1.0] * 4 + [None]), (54, [float("nan")] * 5), (55, [1.0] * 4 + [float("-inf")])]
    schema = "vec_id long, embedding array<double>, v string, x string, n string, i string"
    table = spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in good + bad], schema)
    check_whitened(spectrum_whitening.whiten(table).collect(), good)
    assert spectrum_whitening.whiten(table.limit(0)).collect() == []
    assert spectrum_whitening.whiten(table.where("vec_id = 3 AND embedding[0] = 9")).collect() == []  # no variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<float>")
    out = spectrum_whitening.whiten(line).collect()  # one dimension of variance
    assert {r.component for r in out} == {1} and abs(out[0].explained - 1) < 1e-12 and out[0].identity_error < 1e-12
    far = spark.createDataFrame([(i, [1e9 * i, 1.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert [r.deviation for r in spectrum_whitening.whiten(far).collect()] == [None] * 4
