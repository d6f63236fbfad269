"""Written tables that cut lineage and are shared between jobs.

A table is written as Parquet below the cluster's ``spark.checkpoint.dir`` and read back, so a lost
executor never forces the upstream to be recomputed and readers get column pruning and real sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, tempfile.TemporaryDirectory] = {}
_STORED: dict[tuple[str, str, str], tuple[str, object]] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach; a temporary one only for a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.TemporaryDirectory(prefix="matchloom-", ignore_cleanup_errors=True)  # goes with the process
    return _LOCAL_DIRS[app].name


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/matchloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the reader of the written table."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored(spark: SparkSession, scope: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Feature-store table ``name`` of input ``scope``: built by the first reader, reused by the others.

    An input folder is taken to stay as it is for the life of a session.
    """
    key = (spark.sparkContext.applicationId, scope, name)
    if key not in _STORED:
        df = build()
        path = new_path(spark, name)
        df.write.parquet(path)
        _STORED[key] = (path, df.schema)
    path, schema = _STORED[key]
    return spark.read.schema(schema).parquet(path)
