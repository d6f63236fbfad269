from __future__ import annotations

import pytest
from pyspark.sql import Row
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture
def documents(spark):
    """(id, text[, lang[, source]]) rows -> a table of documents."""

    def make(*rows):
        return spark.createDataFrame([Row(*[*r, *[None] * (4 - len(r))], None if r[1] is None else len(r[1])) for r in rows], DOCUMENTS)

    return make
