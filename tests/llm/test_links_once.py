"""Links that were found many times over."""

from __future__ import annotations

from matchloom.llm import common
from matchloom.storage import materialize


def test_repeated_links_are_joined_once(spark, monkeypatch):
    links = [(i, i % 3) for i in range(3, 60)] + [(1, 0), (2, 1), (2, 2)]
    rows = [pair if copy % 2 else pair[::-1] for copy in range(20) for pair in links]
    edges = materialize(spark.createDataFrame(rows, "u long, v long"), "edges")
    written = []

    def counted(df, label):
        out = materialize(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(common, "materialize", counted)
    assert sorted(map(tuple, common.components(edges).collect())) == [(i, 0) for i in range(60)]
    assert max(written) <= len(links)
