"""Reports that grow with the facts are written from all partitions."""

from __future__ import annotations

from test_batch import raw_dir  # noqa: F401

from matchloom.operators.models import Settings
from matchloom.plans import batch


def test_only_small_reports_are_one_file(spark, raw_dir, tmp_path, monkeypatch):  # noqa: F811
    told = {}
    monkeypatch.setattr(batch, "write_csv", lambda df, path, single_file=False: told.update({path.rsplit("/", 1)[1]: single_file}))
    odds = spark.createDataFrame([("Spain", 3, 75.0), ("Japan", 1, 25.0)], "team string, champion_count long, championship_probability double")
    batch.run(spark, raw_dir, str(tmp_path / "out"), odds, settings=Settings(max_iter=5, forest_trees=2, forest_depth=2, boost_rounds=1))
    assert {name for name, single in told.items() if not single} == {"historical_match_summary"} and len(told) > 10


def test_report_of_several_files(spark, tmp_path):
    store = batch.Store(spark, str(tmp_path))
    for single, files in ((True, 1), (False, 4)):
        store.report(f"t{single}", spark.range(0, 100_000, 1, 4), single_file=single)
        assert len(list((tmp_path / f"csv/t{single}").glob("*.csv"))) == files
