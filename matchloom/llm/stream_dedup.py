"""Exact duplicates by a stream with keyed state on disk.

One narrow record per document (SHA-256 of the text without white space, length, id, where the row lies) lands
below the checkpoint folder and is read as a stream in several micro-batches. The stream's state, in RocksDB and
without expiry, keeps for every digest the number of its documents and the best one: its stable id and the place of
its content. The final state is read with the ``statestore`` source. Rows that hit a digest of another row are then
compared with the content at that place, byte for byte.

Defined results. Null text counts as empty, so null, empty and blank texts are copies of each other. A null id sorts
after all others. Repeated rows are told apart by file and row number, and exactly one of them stays. An empty table
gives an empty result. Other columns are not read. Texts with equal digests but different bytes are separate groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import located, place_of, plain, settings
from matchloom.storage import materialize, new_path

# Native memory for all state stores of an executor; the rest of the state is on disk.
ROCKS = "spark.sql.streaming.stateStore.rocksdb"
STREAM = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKS}.boundedMemoryUsage": "true",
    f"{ROCKS}.maxMemoryUsageMB": "256",
    f"{ROCKS}.changelogCheckpointing.enabled": "true",
    f"{ROCKS}.allowFAllocate": "false",  # else each of many small stores takes megabytes of empty files
}


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", batches: int = 3) -> DataFrame:
    """One row per document: __at (its place), doc_id, keep_id, group_size, kept, text_sha256. ``docs`` may have come from ``located``.

    ``batches``: micro-batches the stream is cut into; it doesn't change the result.
    """
    spark = docs.sparkSession
    rows = docs if place_of(docs) else located(docs)
    source = rows.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), F.col(place_of(rows)).alias("__at"))
    text = F.coalesce("text", F.lit(""))
    landed = source.select("doc_id", digest(plain(F.col("text"))).alias("digest"), F.length(text).alias("points"), "__at")
    folder = new_path(spark, "landed")
    landed.write.parquet(folder)
    landed = spark.read.schema(landed.schema).parquet(folder)
    state = _state(landed, folder, batches)

    rows = landed.join(state, "digest")
    mine = F.col("__at") == F.col("best.__at")
    hits = rows.where("group_size > 1").select("digest", "__at", mine.alias("kept"))
    odd = materialize(_different(source, hits), "odd")
    if not odd.isEmpty():
        rows = _regroup(landed, odd)
        mine = F.col("__at") == F.col("best.__at")
    return rows.select("__at", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", mine.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def _best():
    """Longest text first, then smallest id, then place."""
    return F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", "__at")


def _state(landed: DataFrame, folder: str, batches: int) -> DataFrame:
    spark = landed.sparkSession
    files = max(1, -(-len(landed.inputFiles()) // batches))
    with settings(spark, STREAM):
        stream = spark.readStream.schema(landed.schema).option("maxFilesPerTrigger", files).parquet(folder)
        seen = stream.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(_best()).alias("best"))
        checkpoint = new_path(spark, "state")
        query = seen.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.lastProgress is None:  # nothing landed, so there is no state
            return landed.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.min(_best()).alias("best"))
        stored = spark.read.format("statestore").load(checkpoint)
        size, best = stored.schema["value"].dataType.names
        found = stored.select(F.col("key.digest").alias("digest"), F.col("value")[size].alias("group_size"), F.col("value")[best].alias("best"))
        return materialize(found, "seen")


def _different(source: DataFrame, hits: DataFrame) -> DataFrame:
    """Rows whose bytes are not those of the row that stays: (__at, other), the second names their content."""
    bytes_ = source.select("__at", plain(F.col("text")).alias("text")).join(hits, "__at")
    kept = bytes_.where("kept").select("digest", F.col("text").alias("stays"))
    rest = bytes_.where("not kept").join(kept, "digest").where("text <> stays")
    return rest.select("__at", F.md5("text").alias("other"))


def _regroup(landed: DataFrame, odd: DataFrame) -> DataFrame:
    rows = landed.join(odd, "__at", "left").withColumn("other", F.coalesce("other", F.lit("")))
    best = rows.groupBy("digest", "other").agg(F.count(F.lit(1)).alias("group_size"), F.min(_best()).alias("best"))
    return rows.join(best, ["digest", "other"])
