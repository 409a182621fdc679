"""Unifying the same subject from several systems."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(frames: Mapping[str, DataFrame], tag: str = "source_system") -> DataFrame:
    """Union frames by name, tagging rows with their source.

    A column missing on one side is NULL there, of the other side's type.
    """
    tagged = [df.select(F.lit(name).alias(tag), *df.columns) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
