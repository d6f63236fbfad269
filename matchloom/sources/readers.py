"""Table sources with explicit schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from matchloom.storage import materialize

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with header. A line that does not fit the schema keeps its text in ``_corrupt_record``."""
    wanted = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    return spark.read.schema(wanted).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)


def read_checked(spark: SparkSession, path: str, kinds: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad lines) of a CSV with header, from one scan that is written once.

    ``kinds``: column -> type; other columns of the file stay text. Good rows have the file's columns, cast. A bad line has
    (file, line, reason): ``columns`` if it has too few or too many fields, else ``cast`` and the first column whose text
    isn't of its type. Empty fields are null. A line is a record, so quoted line breaks aren't for this reader.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    head = lines.first()
    if head is None:
        nothing = spark.createDataFrame([], ", ".join(f"`{c}` {k}" for c, k in kinds.items()))
        return nothing, spark.createDataFrame([], "file string, line string, reason string")
    names = list(spark.read.option("header", True).csv(path).columns)
    schema = ", ".join(f"`{c}` string" for c in [*names, CORRUPT])
    body = lines.where(F.col("value") != head["value"]).withColumn("r", F.from_csv("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    field = lambda c: F.col("r")[c]
    casts = {c: field(c).try_cast(kinds[c]) if c in kinds else field(c) for c in names}
    reason = F.when(field(CORRUPT).isNotNull(), "columns")
    for c in names:
        if c in kinds:
            reason = reason.when((F.trim(field(c)) != "") & casts[c].isNull(), f"cast {c}")
    marked = body.select("file", F.col("value").alias("line"), reason.alias("reason"), F.struct(*[v.alias(c) for c, v in casts.items()]).alias("row"))
    marked = materialize(marked, "checked")
    return marked.where("reason IS NULL").select("row.*"), marked.where("reason IS NOT NULL").select("file", "line", "reason")


def read_optional(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet") -> DataFrame:
    """The table, or an empty one of that schema when there is no such path."""
    try:
        table = spark.read.schema(schema).format(kind).option("header", True).load(path)
        table.schema  # noqa: B018  looks the path up
        return table
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_non_empty(candidates: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """The first candidate with rows, columns renamed by its mapping; the last one if all are empty."""
    for table, names in candidates[:-1]:
        if not table.isEmpty():
            return table.withColumnsRenamed(names)
    table, names = candidates[-1]
    return table.withColumnsRenamed(names)


def read_reports(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Evaluation reports: (model_name, actual, predicted, n), one row per cell of each confusion matrix.

    A file is one JSON array, or with ``multi_line`` off one object per line, which Spark can split.
    """
    schema = "model_name string, confusion_matrix array<array<bigint>>"
    reports = spark.read.schema(schema).option("multiLine", multi_line).json(path)
    lines = reports.select("model_name", F.posexplode("confusion_matrix").alias("actual", "line"))
    return lines.select("model_name", "actual", F.posexplode("line").alias("predicted", "n"))
