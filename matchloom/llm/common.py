"""Small helpers that several operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.storage import materialize

# A Python worker gets Arrow batches of about this size, however long the texts are.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
# ASCII white space, as the contracts define it: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def batch_settings(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session; results don't depend on it."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the length of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plain(text: Column) -> Column:
    """The text without ASCII white space; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


_HELD: dict[str, Callable[[], object]] = {}


def hold(name: str, forget: Callable[[], object] = lambda: None) -> None:
    """Say what this Python worker remembers from task to task; what other operators left behind is forgotten.

    Workers outlive stages, so without this their memories would add up over the operators of a session.
    """
    for other in [o for o in _HELD if o != name]:
        _HELD.pop(other)()
    _HELD[name] = forget


def give_back() -> None:
    """Return what Arrow and the C library have freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator], name: str = "") -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, which starts without other operators' memories and gives back its own buffers."""

    def wrapped(batches: Iterator) -> Iterator:
        if not name:
            hold(name)
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column's name starts with, two at least: names made with it clash with none."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


PLACE = "row_place"


def place_of(docs: DataFrame) -> str | None:
    """The column of a frame that ``located`` made."""
    return next((f.name for f in docs.schema if f.metadata.get(PLACE)), None)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct that names each row: file and row number. ``place_of`` tells the column's name.

    A frame that isn't a plain file scan is written below the checkpoint folder first.
    """
    name = f"{free_prefix(docs.columns)}at"
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(name, metadata={PLACE: True})
    try:
        found = docs.select("*", at)
        found.schema  # noqa: B018  resolves the columns
        return found
    except AnalysisException:
        return materialize(docs, "located").select("*", at)


def components(edges: DataFrame) -> DataFrame:
    """(u, v) long pairs of a written table -> (id, component_id): each linked id and the smallest id it can reach.

    Alternating large and small stars. Each round is written, so that lineage stays short; the number of
    rounds grows with the logarithm of the longest path. A star's centre may be in very many pairs: minima
    are aggregated before the shuffle and the join with them is one that Spark splits when it is skewed.
    """
    # A link may have been found many times over; each counts once, so that a star has a row per member.
    pairs = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "pairs")
    done = False
    while not done:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        large = materialize(large, "pairs")  # a row per pair at most; repeated ones go in the next step
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest).where("u > v").distinct()
        pairs = materialize(small, "pairs")
        done = _stars(pairs)
    centres = pairs.select("v").distinct()
    return pairs.union(centres.select("v", "v")).toDF("id", "component_id")


def _stars(pairs: DataFrame) -> bool:
    """Whether every id hangs on one other, which hangs on none."""
    ends = pairs.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(pairs.select("v", F.lit(0), F.lit(1)))
    degrees = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return degrees.where("up > 1 or up + down > 1").isEmpty()
