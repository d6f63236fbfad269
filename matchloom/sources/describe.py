"""What a table holds: data dictionary and cleaning report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

NUMERIC = ("int", "bigint", "double", "float", "smallint", "tinyint")


def kind_of(simple: str) -> str:
    return "numeric" if simple in NUMERIC or simple.startswith("decimal") else simple


def described(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Attach column descriptions as field metadata."""
    return df.select(*[F.col(c).alias(c, metadata={"description": texts.get(c, "")}) for c in df.columns])


def data_dictionary(datasets: dict[str, DataFrame]) -> DataFrame:
    """(dataset, column_name, data_type, description, filled): one row per column, ``filled`` counts its values."""
    parts = []
    for name, df in datasets.items():
        counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(df.columns)])
        rows = [
            F.struct(
                F.lit(name).alias("dataset"),
                F.lit(f.name).alias("column_name"),
                F.lit(kind_of(f.dataType.simpleString())).alias("data_type"),
                F.lit(f.metadata.get("description", "")).alias("description"),
                F.col(f"n{i}").alias("filled"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
        parts.append(counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count taken while its first action runs, instead of by a second pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


class Steps:
    """Row counts along the cleaning of one table, all taken while its result is written.

    A step is ``df = steps(df, rule)`` after the rule; the first one is called ``read``.
    """

    def __init__(self, table: str) -> None:
        self.table = table
        self.seen: list[tuple[str, Observation]] = []

    def __call__(self, df: DataFrame, rule: str) -> DataFrame:
        seen = Observation(f"{self.table} {rule}")
        self.seen.append((rule, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def report(self, spark: SparkSession) -> DataFrame:
        """(dataset, step, rule, n): rows read, dropped by each rule, and kept. The table has been written by then."""
        counts = [(rule, seen.get["rows"]) for rule, seen in self.seen]
        dropped = [(rule, before - n) for (_, before), (rule, n) in zip(counts, counts[1:])]
        rows = [("read", counts[0][1]), *dropped, ("kept", counts[-1][1])]
        return spark.createDataFrame([(self.table, i, rule, n) for i, (rule, n) in enumerate(rows)], "dataset string, step int, rule string, n long")


def unseen(df: DataFrame, rule: str) -> DataFrame:
    """In place of ``Steps`` where nobody counts."""
    return df
