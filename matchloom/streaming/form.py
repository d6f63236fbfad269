"""Rolling form and running totals over a stream of contests.

Each actor of a pool has state of its own, on disk: the points of its last contests and its totals so far. A row gets the
figures of the contests before it, the same as those of the batch operators over all rows, however the stream is cut into
micro-batches and wherever it restarts.

Rows are in order by (date, seq). One that isn't after all rows its actor has had in earlier micro-batches is late: it gets
no figures, is marked, and leaves the state as it is. Rows of one micro-batch are ordered first. Rows without pool or
actor count as their own pool or actor; rows without date or seq are late.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from matchloom.operators.features import FORM_GAMES
from matchloom.storage import new_path

ROCKS = "spark.sql.streaming.stateStore"
STATE_CONF = {
    f"{ROCKS}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKS}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{ROCKS}.rocksdb.boundedMemoryUsage": "true",
}
RESULT = "pool string, actor string, seq long, form long, games long, scored long, conceded long, wins long, late boolean"
COLUMNS = [field.split()[0] for field in RESULT.split(", ")]


class FormProcessor(StatefulProcessor):
    """State of one actor: the last ``games`` points, oldest first, and totals with the place of the latest row."""

    def __init__(self, games: int = FORM_GAMES) -> None:
        self.games = games

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.points = handle.getListState("points", "points long")
        self.totals = handle.getValueState("totals", "games long, scored long, conceded long, wins long, d date, seq long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["d", "seq"], na_position="last")
        points = [p[0] for p in self.points.get()]
        games, scored, conceded, wins, day, seq = self.totals.get() if self.totals.exists() else (0, 0, 0, 0, None, None)
        before, out = (day, seq), []
        for d, number, gf, ga, p in zip(batch["d"], batch["seq"], batch["gf"], batch["ga"], batch["points"]):
            missing = pd.isna(d) or pd.isna(number)
            if missing or (before[0] is not None and (d, number) <= before):
                out.append((*key, None if pd.isna(number) else number, None, None, None, None, None, True))
                continue
            out.append((*key, number, sum(points), games, scored, conceded, wins, False))
            points = [*points, int(p)][-self.games :]
            games, scored, conceded, wins, day, seq = games + 1, scored + int(gf), conceded + int(ga), wins + (p == 3), d, int(number)
        if day is not None:
            self.points.put([(p,) for p in points])
            self.totals.update((games, scored, conceded, wins, day, seq))
        yield pd.DataFrame(out, columns=COLUMNS).astype({c: "Int64" for c in COLUMNS[2:8]})

    def close(self) -> None:
        pass


def stream_form(sides: DataFrame) -> DataFrame:
    """A stream of (pool, actor, d, seq, gf, ga, points) with the figures before each row."""
    narrow = sides.select("pool", "actor", "d", "seq", "gf", "ga", "points")
    return narrow.groupBy("pool", "actor").transformWithStateInPandas(statefulProcessor=FormProcessor(), outputStructType=RESULT, outputMode="Append", timeMode="None")


class FormStream:
    """A landing folder, and the figures of all that has landed. Every ``land`` is a run of its own from the checkpoint."""

    def __init__(self, like: DataFrame) -> None:
        self.spark, self.schema = like.sparkSession, like.schema
        self.landing, self.results, self.checkpoint = (new_path(self.spark, name) for name in ("landing", "figures", "figures-state"))

    def land(self, rows: DataFrame, files_per_batch: int | None = None) -> None:
        rows.write.mode("append").parquet(self.landing)
        before = {key: self.spark.conf.get(key, None) for key in STATE_CONF}
        for key, value in STATE_CONF.items():
            self.spark.conf.set(key, value)
        try:
            source = self.spark.readStream.schema(self.schema)
            source = source.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else source
            writer = stream_form(source.parquet(self.landing)).writeStream.format("parquet").option("checkpointLocation", self.checkpoint)
            writer.trigger(availableNow=True).start(self.results).awaitTermination()
        finally:
            for key, value in before.items():
                self.spark.conf.unset(key) if value is None else self.spark.conf.set(key, value)

    def figures(self) -> DataFrame:
        return self.spark.read.schema(RESULT).parquet(self.results)
