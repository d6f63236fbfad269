"""What the vector index sends: a sketch to each pair of shelves, whole vectors only where they can have a link."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from matchloom.llm import vector_index as V


def units(rng, rows, width):
    return V.unit(rng.normal(size=(rows, width)))


def batch(vectors):
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]), pa.array(vectors.ravel()))
    at = np.arange(len(vectors), dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(at + 7), lists], ["h1", "h2", "vector"])


def test_cells_on_shelves():
    places = V.shelves({0: 5, 1: 4, 2: 30, 4: 3, 5: 9} | {c: 0 for c in range(10, 10 + 2 * V.CELLS)}, 10)
    assert places[0] == [(0, 0)] and places[1] == [(0, 1)] and [p[0] for p in places[2]] == [1, 2, 3] and places[4] == [(4, 0)]
    full = V.shelves({c: 1 for c in range(3 * V.CELLS)}, 10_000)
    assert {p for ((p, _),) in full.values()} == {0, 1, 2} and max(n for ((_, n),) in full.values()) == V.CELLS - 1


def test_sketches_bound_the_cosine():
    rng = np.random.default_rng(2)
    for width in (1, 3, 64):
        a, b = units(rng, 200, width), units(rng, 200, width)
        (wa, sa, ea), (wb, sb, eb) = V.sketch(a), V.sketch(b)
        assert wa.nbytes == 200 * width
        near = (wa * sa[:, None].astype(float)) @ (wb * sb[:, None].astype(float)).T
        assert (np.abs(near - a @ b.T) <= ea[:, None] + eb[None] + ea[:, None] * eb[None] + 1e-9).all() and ea.max() < 0.06


def test_a_vector_is_sent_once_to_a_pair_of_shelves():
    rng = np.random.default_rng(3)
    points, words = units(rng, 600, 32), 8
    index = V.Index(V.codebook(points[:, :16], words), V.codebook(points[:, 16:], words))
    halves = index.halves(points)
    cells = index.cells(halves)
    places = V.shelves(dict(zip(*np.unique(cells, return_counts=True))), 150)
    shelf_count = 1 + max(p for cell in places.values() for p, _ in cell)
    sent = [r for out in V._visit(index, 0.1, places, 32)([batch(points)]) for r in out.to_pylist()]
    visits = sum(sum(i * len(index.books[1]) + j in places for i, j in V.multi_sequence(halves[0][1][k], halves[1][1][k], 0.1)) for k in range(600))
    assert len({(r["low"], r["high"], r["h1"]) for r in sent}) == len(sent) <= 600 * shelf_count < visits / 2
    assert all(len(r["whole"]) == 32 for r in sent)


def test_whole_vectors_are_sent_for_candidates_only(spark, monkeypatch):
    rng = np.random.default_rng(4)
    points = units(rng, 500, 24).astype(np.float32)
    points[100:130] = points[:30] + 0.02 * rng.normal(size=(30, 24))
    rows, written = [(i, v.tolist()) for i, v in enumerate(points)], {}

    def kept(df, label, write=V.materialize):
        return written.setdefault(label, write(df, label))

    monkeypatch.setattr(V, "materialize", kept)
    out = {r.vec_id: r for r in V.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), block=40).collect()}
    fine = V.unit(points.astype(float))
    hits = fine @ fine.T >= 0.95
    np.fill_diagonal(hits, False)
    assert hits.sum() >= 60 and [out[i].n_links for i in range(500)] == hits.sum(axis=1).tolist()
    found = written["candidates"]
    assert 60 <= found.count() < 200 and found.select("low", "high").distinct().count() > 3
    assert written["vectors"].schema["vector"].dataType.elementType.typeName() == "float"
