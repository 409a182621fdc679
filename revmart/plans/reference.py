"""Small reference dimensions shared by several marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.operators.versions import current, first_per_key, live


def accounts(account: DataFrame) -> DataFrame:
    """Account attributes, current version only where versions are kept."""
    return current(account) if "is_current" in account.columns else account


def _with_id(recordtype: DataFrame) -> DataFrame:
    """The id column goes by two names in the extracts."""
    if "record_type_id" in recordtype.columns:
        return recordtype
    return recordtype.withColumnRenamed("recordtype_id", "record_type_id")


def record_types(recordtype: DataFrame) -> DataFrame:
    """Id and name of the current, undeleted record types."""
    return live(current(_with_id(recordtype)), keep_unknown=True).select("record_type_id", "record_type_name")


def any_record_types(recordtype: DataFrame) -> DataFrame:
    """Id and name of every record type, retired ones too: one row per id, the current version if there is one."""
    order = [F.col("is_current").desc_nulls_last(), F.col("record_type_name")]
    return first_per_key(_with_id(recordtype), [F.col("record_type_id")], order).select("record_type_id", "record_type_name")
