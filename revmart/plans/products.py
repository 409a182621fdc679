"""Product dimension: every product column plus table-driven classifications."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.config import Config
from revmart.functions.columns import in_list, is_true, relabel, surrogate_key
from revmart.operators.conform import narrowed, project
from revmart.operators.lookups import Lookup, enrich
from revmart.operators.rollups import bridged_max
from revmart.operators.versions import current, live
from revmart.plans import contracts

# ---------------------------------------------------------------------------------------
# Categories, families and labels the classifications depend on.
# ---------------------------------------------------------------------------------------
ACV_CATEGORIES = (
    "Term Software",
    "Maintenance",
    "Subscription Feed",
    "SaaS",
    "Term Software - Consumption",
    "SaaS - Consumption",
)
ANNUAL_MODEL = "Subscription - Annual"
NACV_PRICING = ("Fixed Price", "Percent Of Total")
VALUE_ADD_GROUP = "DDI Val Add"
VALUE_ADD_LABEL = "DDI Value-Add (DDI+)"
SAAS_CATEGORY = "saas"
SAAS_DDI_GROUPS = ("bloxone ddi", "b1 platform")
SAAS_SECURITY_GROUP = "security"
SAAS_SECURITY_FAMILIES = ("activetrust cloud", "bloxone threat defense")
DDI_GROUP = "BloxOne DDI"
SECURITY_FAMILY = "BloxOne Threat Defense"
DDI_LABEL = "B1DDI"
SECURITY_LABEL = "B1TD"
SECURITY_WORDS = "Threat Defense"
NON_RECURRING_CATEGORIES = (
    "Appliance Software",
    "Hardware",
    "Other",
    "Add-on Software",
    "Professional Services",
    "Trainings",
)
CATEGORY_ROLLUP = {("Add-on Software", "Appliance Software"): "Product SW", ("Freight",): "Other"}
CATEGORY_SUMMARY = {("Add-on Software", "Appliance Software", "Freight", "Hardware", "Other"): "Product"}
# ---------------------------------------------------------------------------------------


def classifications() -> dict[str, Column]:
    """Published classification -> rule over the product's own columns and its selling model."""
    category, group, family = F.col("finance_product_category"), F.col("product_group"), F.col("family")
    saas = F.lower(category) == SAAS_CATEGORY
    saas_ddi = saas & F.lower(group).isin(*SAAS_DDI_GROUPS)
    security_family = F.lower(family).isin(*SAAS_SECURITY_FAMILIES)
    return {
        "acv_eligible_flag": in_list(category, ACV_CATEGORIES),
        "nacv_pricing_eligible_flag": in_list("product_selling_model_name", (ANNUAL_MODEL,))
        | in_list("sbqq_subscription_pricing", NACV_PRICING),
        "product_group_name": relabel(group, {(VALUE_ADD_GROUP,): VALUE_ADD_LABEL}, group),
        "saas_prod_group_old": F.when(saas_ddi, DDI_LABEL).when(
            saas & (F.lower(group) == SAAS_SECURITY_GROUP) & security_family, SECURITY_LABEL
        ),
        "saas_prod_group": F.when(saas_ddi, DDI_LABEL).when(security_family, SECURITY_LABEL),
        "blox_one_product_group": F.when(group == DDI_GROUP, DDI_LABEL)
        .when(family == SECURITY_FAMILY, SECURITY_LABEL)
        .when(group == VALUE_ADD_GROUP, VALUE_ADD_LABEL)
        .otherwise(group),
        "subscription_type_desc": F.when(is_true("is_assetizable"), "Renewable").otherwise("One-time"),
        "revenue_category": F.when(in_list(category, NON_RECURRING_CATEGORIES), "NRR").otherwise("ARR"),
        "finance_product_category_rollup": relabel(category, CATEGORY_ROLLUP, category),
        "finance_product_category_summary": relabel(category, CATEGORY_SUMMARY, category),
        "product_group_new": F.when(family.contains(SECURITY_WORDS), SECURITY_WORDS).otherwise("Other"),
    }


def selling_models(model: DataFrame, option: DataFrame) -> DataFrame:
    """One selling model name per product: the last in text order among its live options."""
    named = live(model).select("productsellingmodel_id", F.col("name").alias("product_selling_model_name"))
    return bridged_max(
        named,
        "productsellingmodel_id",
        live(option),
        "product_selling_model_id",
        by="product2_id",
        value="product_selling_model_name",
    )


def with_selling_model(product: DataFrame, model: DataFrame, option: DataFrame) -> DataFrame:
    step = Lookup(
        selling_models(model, option),
        "product2_id",
        "product2_id",
        {"product_selling_model_name": "product_selling_model_name"},
        sized_by=(model, option),
    )
    return enrich(product, [step])


def build_dim_product(
    product: DataFrame, model: DataFrame, option: DataFrame, cfg: Config, columns: Collection[str] | None = None
) -> DataFrame:
    named = live(current(product))
    if columns is None or not set(columns).issubset({*named.columns, "product_sk"}):
        named = with_selling_model(named, model, option)
    computed = classifications() | {
        "model_logic_version": F.lit(cfg.product_logic_version),
        "product_sk": surrogate_key("product2_id"),
    }
    return project(named, narrowed(contracts.published(contracts.PRODUCT, cfg), columns), computed)
