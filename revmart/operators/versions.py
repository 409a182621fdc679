"""Resolving to the rows that count: soft deletes, current versions, first row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def live(df: DataFrame, flag: str = "is_deleted", keep_unknown: bool = False) -> DataFrame:
    """Drop soft-deleted rows. Rows with an unknown flag go too unless ``keep_unknown``."""
    deleted = F.coalesce(F.col(flag), F.lit(False)) if keep_unknown else F.col(flag)
    return df.where(~deleted)


def current(df: DataFrame, flag: str = "is_current") -> DataFrame:
    """Keep the current version of every row; unknown counts as not current."""
    return df.where(F.col(flag))


def first_per_key(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key in ``order``, which must end in a unique column.

    The rank filter becomes a group limit before and after the shuffle, so each map task
    sends at most one row per key however often the key occurs.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def first_places(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row of every key in ``order`` and ``_rows``, how many rows of the key are equal in it.

    For narrow rows: what ranks a row moves alone, so wide rows need not move before it is known which of them stay.
    Where ``_rows`` is more than one, the other columns are those of any of these rows.
    """
    place = F.rank().over(Window.partitionBy(key).orderBy(*order))
    firsts = df.withColumn("_place", place).where(F.col("_place") == 1)
    # One aggregate over all columns: readers of some of them share one shuffle, since none is pruned below it.
    whole = F.first(F.struct(*[n for n in df.columns if n != key])).alias("_whole")
    return firsts.groupBy(key).agg(whole, F.count("*").alias("_rows")).select(key, "_whole.*", "_rows")


def latest_per_key(df: DataFrame, key: str, newest_by: Sequence[str], tie: str | None = None) -> DataFrame:
    """Keep the newest row per key; unknown times are oldest.

    Rows of equal age are ordered by ``tie``, by default by a digest of their content, so the
    outcome never depends on how the rows are distributed.
    """
    last = F.col(tie) if tie else F.xxhash64(*sorted(df.columns))
    order = [F.col(c).desc_nulls_last() for c in newest_by] + [last.desc_nulls_last()]
    return first_per_key(df, [F.col(key)], order)
