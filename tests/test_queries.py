"""Every registered query against DuckDB on the smallest tables; queries without a statement must return rows."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import difference

from matchloom.plans import registry

registry.load()


@pytest.mark.parametrize("name", sorted(registry.CHECKS))
def test_matches_duckdb(spark, sf_dir, duck, name):
    assert difference(registry.QUERIES[name](spark, sf_dir), duck, registry.CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.CHECKS)))
def test_returns_rows(spark, sf_dir, name):
    assert not registry.QUERIES[name](spark, sf_dir).isEmpty()


def test_entry_point(spark):
    import importlib.util
    from pathlib import Path

    spec = importlib.util.spec_from_file_location("entry", Path(__file__).resolve().parents[1] / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert module.entry(spark).count() == 20
    assert module.queries().keys() >= registry.QUERIES.keys() and module.oracle_sql().items() >= registry.CHECKS.items()


def test_checks_belong_to_queries():
    assert set(registry.CHECKS) <= set(registry.QUERIES)


def test_executors_get_the_package(tmp_path):
    """From an empty folder, without PYTHONPATH, Python workers still find the package."""
    import os
    import subprocess
    import sys

    root = Path(__file__).resolve().parents[1]
    code = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("entry", {str(root / "__spark_entry__.py")!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
queries = module.queries()
assert queries["w6_elo_final"](spark, "/root/testdata/sf0.001").count() > 0
assert queries["p15_normalize_id"](spark, "/root/testdata/sf0.001").where("normalized <> ''").count() > 0
"""
    bare = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=bare, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
