"""Opportunity dimension: current opportunities with history, coverage and classifications."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.config import Config
from revmart.functions.columns import blank_to_null, contains_any, in_list
from revmart.operators.conform import narrowed, project
from revmart.operators.lookups import Lookup, enrich, needed, presence, value_map
from revmart.operators.rollups import change_rollup, distinct_count_rollup
from revmart.operators.versions import current
from revmart.plans import contracts
from revmart.plans.reference import accounts, record_types

# ---------------------------------------------------------------------------------------
# Stages in order with their group, reasons, categories and labels.
# ---------------------------------------------------------------------------------------
STAGES = {
    "Prospect": (1, "Unqualified"),
    "Qualify": (2, "Unqualified"),
    "Build & Validate": (3, "Qualified"),
    "Negotiate": (4, "Qualified"),
    "Confirm": (5, "Qualified"),
    "Customer PO In Process": (6, "Qualified"),
    "PO In House": (7, "Qualified"),
    "Awaiting Service Delivery": (8, "Qualified"),
    "Closed Won": (9, "Closed"),
    "Closed Lost": (10, "Closed"),
    "Closed": (11, "Closed"),
}
EARLY_STAGES = ("Prospect", "Qualify")
LOST_STAGE = "Closed Lost"
EXCLUDED_LOSS_WORDS = ("DUPLICATE OPPORTUNITY", "UNQUALIFIED")
EXCLUDED_REASONS = ("Co-Termed", "Duplicate Opportunity", "Co-Termed / Duplicate Opportunity")
EXCLUDED_SECONDARY_REASONS = ("Duplicate Opportunity",)
FORECAST_BY_STAGE = {
    "Build & Validate": "Pipeline",
    "Closed Lost": "Closed Lost",
    "Closed Won": "Closed Won",
    "Confirm": "Strong Upside",
    "Negotiate": "Upside",
    "Prospect": "Omitted",
    "Qualify": "Omitted",
    "Customer PO In Process": "Commit",
}
CLOSE_DATE_FIELD = "closedate"
SUPPORT_TASK_TYPE = "BVA Support Request"
# ---------------------------------------------------------------------------------------

STAGE_ORDER = {stage: order for stage, (order, _) in STAGES.items()}
STAGE_GROUP = {stage: group for stage, (_, group) in STAGES.items()}


def non_qualified_loss() -> Column:
    return in_list("stage_prior_to_close", EARLY_STAGES)


def closed_lost_exclusion() -> Column:
    excluded = (
        contains_any("win_loss_reason", EXCLUDED_LOSS_WORDS)
        | contains_any("secondary_win_loss_reason", EXCLUDED_LOSS_WORDS)
        | non_qualified_loss()
    )
    return in_list("stage_name", (LOST_STAGE,)) & excluded


def reporting_exclusion() -> Column:
    return in_list("win_loss_reason", EXCLUDED_REASONS) | in_list(
        "secondary_win_loss_reason", EXCLUDED_SECONDARY_REASONS
    )


def forecast_bridge() -> Column:
    """The given forecast category, else the one implied by the stage."""
    return F.coalesce(F.col("sales_forecast_category"), value_map(F.col("stage_name"), FORECAST_BY_STAGE))


def synced_quote() -> dict[str, Column]:
    """Id and system of the quote an opportunity is synced with."""
    rca, cpq = blank_to_null("synced_quote_id"), blank_to_null("sbqq_primary_quote")
    return {
        "resolved_synced_quote_id": F.coalesce(rca, cpq),
        "resolved_quote_source_system": F.when(rca.isNotNull(), "RCA").when(cpq.isNotNull(), "CPQ"),
    }


def stage_attributes() -> dict[str, Column]:
    return {
        "stage_group": value_map(F.col("stage_name"), STAGE_GROUP),
        "stage_order": value_map(F.col("stage_name"), STAGE_ORDER),
    }


def close_date_history(history: DataFrame) -> DataFrame:
    metrics = change_rollup(history, CLOSE_DATE_FIELD)
    return metrics.select(
        "opportunity_id",
        F.col("prior_value").alias("close_date_prior"),
        F.col("change_count").alias("close_date_change_count"),
        F.col("push_count").alias("close_date_push_count"),
    )


def support_tasks(task: DataFrame) -> DataFrame:
    wanted = task.where(F.col("record_type_name") == SUPPORT_TASK_TYPE)
    counts = distinct_count_rollup(wanted, "resolved_opportunity_id", "task_id", "bva_support_task_count")
    return counts.withColumnRenamed("resolved_opportunity_id", "opportunity_id")


def history_lookup(history: DataFrame) -> Lookup:
    """What changed of an opportunity's close date."""
    return Lookup(close_date_history(history), "opportunity_id", "opportunity_id", {c: c for c in HISTORY_COLUMNS})


def coverage_lookups(task: DataFrame, proposition: DataFrame) -> list[Lookup]:
    """The support tasks of an opportunity and whether it has a value proposition."""
    count = "bva_support_task_count"
    return [
        Lookup(support_tasks(task), "opportunity_id", "opportunity_id", {count: count}),
        presence(proposition, "opportunity_id", "opportunity_id", "_recorded"),
    ]


def covered(df: DataFrame) -> DataFrame:
    """The coverage columns from what ``coverage_lookups`` found."""
    count = F.coalesce(F.col("bva_support_task_count"), F.lit(0))
    return (
        df.withColumn("bva_support_task_count", count)
        .withColumn("has_bva_task_without_bva_record", (F.col("bva_support_task_count") > 0) & F.col("_recorded").isNull())
        .drop("_recorded")
    )


def with_coverage(opportunity: DataFrame, task: DataFrame, proposition: DataFrame) -> DataFrame:
    """Add the support task count and whether a value proposition is missing despite tasks."""
    return covered(enrich(opportunity, coverage_lookups(task, proposition)))


def billing_countries(address: DataFrame, account: DataFrame) -> DataFrame:
    """Country of the account behind every billing address."""
    step = Lookup(accounts(account), "account_id", "account_id", {"bill_country": "bill_country"})
    return enrich(address.select("address_id", "account_id"), [step])


def opportunity_lookups(users: DataFrame, address: DataFrame, account: DataFrame, recordtype: DataFrame) -> list[Lookup]:
    """Owner, billing country and record type of an opportunity."""
    owner = {"user_name": "opportunity_owner_name", "geo": "opportunity_owner_geo", "region": "opportunity_owner_region"}
    return [
        Lookup(users, "owner_id", "user_id", owner),
        Lookup(
            billing_countries(address, account),
            "bill_to",
            "address_id",
            {"bill_country": "opportunity_owner_country"},
            sized_by=(address, account),
        ),
        Lookup(
            record_types(recordtype),
            "record_type_id",
            "record_type_id",
            {"record_type_name": "opportunity_record_type_desc"},
        ),
    ]


# The published columns of each rollup.
HISTORY_COLUMNS = ("close_date_prior", "close_date_change_count", "close_date_push_count")
COVERAGE_COLUMNS = ("bva_support_task_count", "has_bva_task_without_bva_record")


def build_dim_opportunity(
    opportunity: DataFrame,
    history: DataFrame,
    task: DataFrame,
    proposition: DataFrame,
    address: DataFrame,
    account: DataFrame,
    recordtype: DataFrame,
    users: DataFrame,
    cfg: Config,
    columns: Collection[str] | None = None,
) -> DataFrame:
    """Rollups and lookups are found for narrow rows; the wide rows move once, to meet them."""

    def wanted(*names: str) -> bool:
        return columns is None or not set(columns).isdisjoint(names)

    lookups = needed(opportunity_lookups(users, address, account, recordtype), columns)
    if wanted(*COVERAGE_COLUMNS):
        lookups = [*coverage_lookups(task, proposition), *lookups]
    if wanted(*HISTORY_COLUMNS):
        lookups = [history_lookup(history), *lookups]
    named = enrich(current(opportunity), lookups, ["opportunity_id"], cfg.guard_lookups)
    if wanted(*COVERAGE_COLUMNS):
        named = covered(named)
    computed = (
        synced_quote()
        | stage_attributes()
        | {
            "close_date_change_count": F.coalesce(F.col("close_date_change_count"), F.lit(0)),
            "close_date_push_count": F.coalesce(F.col("close_date_push_count"), F.lit(0)),
            "non_qualified_loss_flag": non_qualified_loss(),
            "closed_lost_exclusion_flag": closed_lost_exclusion(),
            "revops_reporting_exclusion_flag": reporting_exclusion(),
            "sales_forecast_category_bridge": forecast_bridge(),
        }
    )
    return project(named, narrowed(contracts.published(contracts.OPPORTUNITY, cfg), columns), computed)
