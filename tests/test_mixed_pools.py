"""Rows of several pools may be mixed in one chunk, as long as each pool's are in order."""

from __future__ import annotations

import pyarrow as pa
import pytest

from matchloom.operators.rating import RATED, _walk


def test_pools_may_be_mixed_inside_a_chunk():
    rows = [(p, h, a) for h, a in (("x", "y"), ("y", "z"), ("x", "z")) for p in ("one", "two")]

    def folded(rows):
        names = ["__chunk", "pool", "home", "away", "__score", "__weight"]
        columns = [pa.array([0] * len(rows), pa.int32()), *map(pa.array, zip(*rows)), pa.array([1.0] * len(rows)), pa.array([30.0] * len(rows))]
        out = next(_walk(iter([pa.RecordBatch.from_arrays(columns, names)]), 1500.0, True))
        return {tuple(out.column(n)[i].as_py() for n in ("pool", "home", "away")): tuple(out.column(n)[i].as_py() for n in RATED) for i in range(len(rows))}

    mixed = folded(rows)
    assert mixed == folded(sorted(rows, key=lambda r: r[0]))
    assert mixed["one", "x", "z"][0] == pytest.approx(1515.0) and mixed["two", "x", "z"][0] == pytest.approx(1515.0)
