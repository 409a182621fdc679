"""Pre-aggregated rollups that marts join by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.functions.columns import is_true
from revmart.operators.lookups import Lookup, enrich


def change_rollup(history: DataFrame, field: str, key: str = "opportunity_id") -> DataFrame:
    """Per key: value before the latest change, number of changes, number of push-outs.

    Ties on the change time are broken by the prior value, later first and NULL last.
    """
    micros = lambda c: F.unix_micros(c).cast("decimal(19,0)")
    changes = history.where(
        ~F.coalesce(F.col("is_deleted"), F.lit(False))
        & (F.lower(F.coalesce(F.col("field_name"), F.lit(""))) == field)
    ).select(
        key,
        F.col("created_date").alias("changed_at"),
        F.col("old_value").try_cast("timestamp").alias("prior"),
        F.col("new_value").try_cast("timestamp").alias("new"),
    )
    # Both times in one number of fixed width, so that the aggregation hashes and needs no sort.
    missing = F.lit(-(10**18) + 1).cast("decimal(19,0)")
    latest = F.coalesce(micros("changed_at"), missing) * F.lit(10**18).cast("decimal(19,0)") + F.coalesce(micros("prior"), missing)
    return changes.groupBy(key).agg(
        F.max_by("prior", latest).alias("prior_value"),
        F.count("*").alias("change_count"),
        F.count_if(F.col("new") > F.col("prior")).alias("push_count"),
    )


def distinct_count_rollup(df: DataFrame, key: str, counted: str, alias: str) -> DataFrame:
    """Distinct values of ``counted`` per non-NULL key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(counted).alias(alias))


def line_rollup(lines: DataFrame) -> DataFrame:
    """Per quote: number of lines and whether any line is a refresh, in one pass."""
    return lines.groupBy("quote_id").agg(
        F.count("*").alias("line_count"),
        F.bool_or(is_true("is_refresh_quote_line")).alias("any_refresh_line"),
    )


def bridged_max(left: DataFrame, left_key: str, bridge: DataFrame, bridge_key: str, by: str, value: str) -> DataFrame:
    """Largest ``left.value`` per ``bridge.by`` over the inner join of the two on their keys.

    Repeated pairs do not change a maximum, so the bridge is reduced to distinct pairs
    first; the group key then tells the rows of one bridge key apart.
    """
    matched = left.select(left_key, value, F.lit(True).alias("_matched"))
    step = Lookup(matched, bridge_key, left_key, {value: value, "_matched": "_matched"})
    pairs = enrich(bridge.select(bridge_key, by).distinct(), [step]).where("_matched")
    return pairs.groupBy(by).agg(F.max(value).alias(value))
