"""Uniform draws that depend on their key only, not on order or partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *key: Column) -> Column:
    """Draw in [0, 1): the first 52 bits of an md5 of seed and key."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in key])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return bits.cast("double") / F.lit(float(2**52))
