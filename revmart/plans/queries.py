"""Named queries over the derived inputs: every operator on its own, then every mart."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.config import Config
from revmart.functions.columns import email_in_domain, positive_amount, surrogate_key
from revmart.operators import conform
from revmart.operators.conform import unparsed_times
from revmart.operators.hierarchy import chain_depth, level_column, manager_chain, top_value, with_manager_flag
from revmart.operators.lineage import shared_folder, stored
from revmart.operators.lookups import Lookup, duplicated_lookup_keys
from revmart.operators.quality import (
    ACCEPTED_VALUES,
    EXPRESSION,
    NOT_NULL,
    RELATIONSHIP,
    ROW_COUNT,
    UNIQUE,
    UNIQUE_COMBINATION,
    RowRuleWatch,
    Rule,
    scorecard,
)
from revmart.operators.versions import current, live
from revmart.plans import contracts, opportunities, products, quotes, registrations, users
from revmart.plans.checks import all_rules, select_rules
from revmart.plans.models import MODELS, build_folded, build_models, check_inputs, check_models, lookup_sides
from revmart.session import tune
from revmart.sources.catalog import TableStore, read_inputs
from revmart.sources.derived import TEST_TABLES, DerivedInputs

# A fixed load time makes results repeatable; quote numbers tell equally old versions apart.
CFG = Config(as_of=datetime(2024, 1, 1), quote_tie="quote_number")

# Published column names.
# Portal columns shown as they are; the query results fold the others into one digest.
PORTAL_SHOWN = (
    "vartopia_registration_id",
    "opportunity_id",
    "partner_account_id",
    "vartopia_sf_registration_id",
    "migrated_to_vartopia",
    "is_native_vartopia_registration",
    "is_deleted",
    "is_clone",
    "is_created_by_auto_reg",
    "expected_close_date",
    "last_modified_date",
)
UNIFIED_SHOWN = ("opportunity_id", "partner_account_name", "opportunity_owner_id", "is_clone", "expected_close_date", "migrated_to_vartopia")
OBSERVED = ("dim_deal_registration", "dim_vartopia_deal_registration", "dim_unified_deal_registration")
PORTAL_NAMES_SHOWN = ("partner_account_name", "distributor_account_name", "opportunity_owner_name")


class Frames:
    """Raw inputs and models over one test data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.inputs = DerivedInputs(tune(spark), sf_dir, CFG)

    def __getitem__(self, name: str) -> DataFrame:
        if name in MODELS:
            return build_models(self.inputs, CFG, only=[name])[name]
        return self.inputs[name]


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as text with 15 digits after the point, so results compare digit by digit at one scale."""
    return df.select(
        *[
            F.col(f.name).cast(quotes.WIDE_AMOUNT).cast("string").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
            for f in df.schema
        ]
    )


def digest(columns: Sequence[Column]) -> Column:
    """One MD5 over the text of all given columns."""
    return F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("~")) for c in columns]))


def folded(f: Frames, name: str, shown: Sequence[str]) -> DataFrame:
    """The shown columns of a model and a digest of all others, for very wide results."""
    return build_folded(f.inputs, name, conform.Fold(shown, "other_columns_digest", digest), CFG)


# --- conforming ------------------------------------------------------------------------


def truthy_flags(f: Frames) -> DataFrame:
    flags = [x.name for x in contracts.legacy_staging(CFG) if x.kind == "flag"]
    return f["stg_deal_registration"].select("deal_registration_id", *flags)


def rename_conform(f: Frames) -> DataFrame:
    return f["stg_deal_registration"]


def portal_staging(f: Frames) -> DataFrame:
    return folded(f, "stg_vartopia_deal_registration", PORTAL_SHOWN)


def unreadable_times(f: Frames) -> DataFrame:
    """Values a lenient parse would lose, over change histories that contain some."""
    fields = contracts.parse_fields("old_value:time new_value:time created_date:time")
    return unparsed_times(f["opportunity_field_history"], fields)


def set_aside_counts(f: Frames) -> DataFrame:
    """What a build that sets unreadable rows aside leaves out, over change histories that contain some."""
    fields = contracts.parse_fields("old_value:time new_value:time created_date:time")
    return conform.set_aside_counts(conform.set_aside_rows(f["opportunity_field_history"], fields))


def readable_history(f: Frames) -> DataFrame:
    """The rows such a build keeps, read strictly."""
    fields = contracts.parse_fields("opportunity_id field_name old_value:time new_value:time")
    history = f["opportunity_field_history"]
    return conform.conform(conform.readable_rows(history, fields), fields)


def source_scan(f: Frames) -> DataFrame:
    """Rows per raw table, read as files below one path."""
    tables = read_inputs(f.spark, base_path=f.sf_dir, names=[f"{t}.parquet" for t in TEST_TABLES])
    counts = [df.agg(F.lit(name.removesuffix(".parquet")).alias("table_name"), F.count("*").alias("n_rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def stored_registrations(f: Frames) -> DataFrame:
    """The registrations from a stored build of one tag: views, tables rebuilt and read back, stored parts reused."""
    store = TableStore(base_path=shared_folder(f.spark, "store"))
    build_models(f.inputs, CFG, only=["dim_deal_registration", "dim_vartopia_deal_registration"], store=store)
    built = build_models(f.inputs, CFG, only=["unified"], store=store)
    return built["dim_unified_deal_registration"].select("source_system", "registration_id", *UNIFIED_SHOWN)


def load_time(f: Frames) -> DataFrame:
    """Without a fixed time, published rows carry the time of their query."""
    people_now = build_models(f.inputs, replace(CFG, as_of=None), only=["dim_user"], columns={"dim_user": {"user_id", "edp_updated_at"}})
    return people_now["dim_user"].select("user_id", (F.col("edp_updated_at") == F.current_timestamp()).alias("is_query_time"))


def latest_by_content(f: Frames) -> DataFrame:
    """Quote versions of equal age settled by their content alone: still one row per quote, of the newest age."""
    return quotes.latest_quotes(f["quote"], replace(CFG, quote_tie=None)).select("quote_id", "system_modstamp", "created_date")


def fallback_key(f: Frames) -> DataFrame:
    portal = registrations.conform_portal(f["salesforce_vartopiadrs__registration__c"], CFG)
    return portal.select("vartopia_registration_id", registrations.portal_dedupe_key().alias("dedupe_key"))


def surrogate_keys(f: Frames) -> DataFrame:
    return f["quote"].select(
        "quote_number",
        surrogate_key("quote_id").alias("one_part"),
        surrogate_key("quote_id", "legacy_quote_id").alias("two_parts"),
    )


# --- versions --------------------------------------------------------------------------


def strict_vs_lenient_delete(f: Frames) -> DataFrame:
    quote = f["quote"].select("quote_number", "is_deleted")
    strict = live(quote).select("quote_number", F.lit("strict").alias("mode"))
    lenient = live(quote, keep_unknown=True).select("quote_number", F.lit("lenient").alias("mode"))
    return strict.unionByName(lenient)


def current_version(f: Frames) -> DataFrame:
    return current(f["opportunity"]).select("opportunity_id", "stage_name", "owner_id", "is_deleted")


def latest_per_key(f: Frames) -> DataFrame:
    return quotes.latest_quotes(f["quote"], CFG).select(
        "quote_id", "quote_number", "system_modstamp", "created_date", "gross_refresh_acv"
    )


def priority_dedupe(f: Frames) -> DataFrame:
    portal = registrations.conform_portal(f["salesforce_vartopiadrs__registration__c"], CFG)
    return registrations.dedupe_portal(portal).select(
        "vartopia_registration_id", registrations.portal_dedupe_key().alias("dedupe_key"), "is_clone", "last_modified_date"
    )


# --- lookups ---------------------------------------------------------------------------


# Published column names.
ROLE_NAMES = (
    "partner_account_name",
    "distributor_account_name",
    "internal_contact_name",
    "partner_sales_rep_name",
    "distributor_rep_name",
    "opportunity_owner_name",
    "opportunity_owner_rd_name",
)


# Raw lookup inputs that hold several versions of a row, and their keys.
VERSIONED_SIDES = {"user": "user_id", "recordtype": "record_type_id", "opportunity": "opportunity_id"}


def role_lookup(f: Frames) -> DataFrame:
    return f["dim_deal_registration"].select("deal_registration_id", *ROLE_NAMES)


def two_hop_lookup(f: Frames) -> DataFrame:
    return opportunities.billing_countries(f["dim_address"], f["dim_account"]).select("address_id", "bill_country")


def owner_lookup(f: Frames) -> DataFrame:
    return f["dim_opportunity"].select(
        "opportunity_id", "opportunity_owner_name", "opportunity_owner_geo", "opportunity_owner_region"
    )


def record_type_lookup(f: Frames) -> DataFrame:
    return f["dim_opportunity"].select("opportunity_id", "opportunity_record_type", "opportunity_record_type_desc")


def bridge_inner_join(f: Frames) -> DataFrame:
    return products.selling_models(f["productsellingmodel"], f["productsellingmodeloption"])


def selling_model(f: Frames) -> DataFrame:
    return f["dim_product"].select("product2_id", "product_selling_model_name", "nacv_pricing_eligible_flag")


def exists_flag(f: Frames) -> DataFrame:
    return f["stg_vartopia_deal_registration"].select(
        "vartopia_registration_id", "opportunity_id", "migrated_to_vartopia", "is_native_vartopia_registration"
    )


def fan_out_guard(f: Frames) -> DataFrame:
    """Lookup keys that would multiply rows, of every lookup the models make and of raw sides that keep versions."""
    versions = {f"raw.{name}": Lookup(f[name], "", key, {}) for name, key in VERSIONED_SIDES.items()}
    return duplicated_lookup_keys(lookup_sides(f.inputs, CFG) | versions)


def task_without_record(f: Frames) -> DataFrame:
    covered = opportunities.with_coverage(
        current(f["opportunity"]).select("opportunity_id"), f["dim_task"], f["dim_vc_value_proposition"]
    )
    return covered.select("opportunity_id", "bva_support_task_count", "has_bva_task_without_bva_record")


# --- people ----------------------------------------------------------------------------


def _flagged_people(f: Frames) -> DataFrame:
    return with_manager_flag(f["int_people"].select("user_id", "manager_id", "user_name", "title"))


def manager_chains(f: Frames) -> DataFrame:
    levels = range(1, CFG.manager_levels + 1)
    above = [level_column(level, attr) for level in levels for attr in ("user_id", "name", "title")]
    chained = manager_chain(_flagged_people(f), CFG.manager_levels)
    return chained.select("user_id", *above, chain_depth(CFG.manager_levels).alias("manager_chain_depth"))


def top_manager(f: Frames) -> DataFrame:
    chained = manager_chain(_flagged_people(f), CFG.manager_levels)
    return chained.select(
        "user_id",
        top_value("name", CFG.manager_levels).alias("top_manager_name"),
        top_value("title", CFG.manager_levels).alias("top_manager_title"),
    )


def is_manager(f: Frames) -> DataFrame:
    return _flagged_people(f).select("user_id", "is_manager_flag")


def user_display_name(f: Frames) -> DataFrame:
    return f["int_people"].select("user_id", "first_name", "last_name", "user_name")


def internal_domain(f: Frames) -> DataFrame:
    flag = email_in_domain("email", CFG.internal_domain)
    return f["user"].select("user_id", "is_current", flag.alias("is_internal_user"))


# --- opportunity classifications -------------------------------------------------------


def _classified(f: Frames, columns: dict[str, Column]) -> DataFrame:
    return current(f["opportunity"]).select("opportunity_id", *[c.alias(n) for n, c in columns.items()])


def stage_map(f: Frames) -> DataFrame:
    return _classified(f, {"stage_name": F.col("stage_name")} | opportunities.stage_attributes())


def change_rollup(f: Frames) -> DataFrame:
    return opportunities.close_date_history(f["opportunity_field_history"])


def closed_lost_exclusion(f: Frames) -> DataFrame:
    return _classified(
        f,
        {
            "non_qualified_loss_flag": opportunities.non_qualified_loss(),
            "closed_lost_exclusion_flag": opportunities.closed_lost_exclusion(),
        },
    )


def reporting_exclusion(f: Frames) -> DataFrame:
    return _classified(f, {"revops_reporting_exclusion_flag": opportunities.reporting_exclusion()})


def forecast_bridge(f: Frames) -> DataFrame:
    return _classified(f, {"sales_forecast_category_bridge": opportunities.forecast_bridge()})


def synced_quote(f: Frames) -> DataFrame:
    return _classified(f, opportunities.synced_quote())


# --- products and quotes ---------------------------------------------------------------


def product_classifiers(f: Frames) -> DataFrame:
    rules = products.classifications()
    return products.with_selling_model(
        f["product2"], f["productsellingmodel"], f["productsellingmodeloption"]
    ).select("product2_id", *[rule.alias(name) for name, rule in rules.items()])


def quote_union(f: Frames) -> DataFrame:
    return f["dim_quote_unified"].select(
        "quote_unified_sk", "source_system", "quote_id", "quote_number", "quote_line_count", "record_type_name"
    )


def refresh_flags(f: Frames) -> DataFrame:
    """Refresh tests of both systems, with the second system's amount at both precisions."""
    rca = f["quote"].select(F.col("quote_number").alias("quote"), *[c.alias(n) for n, c in quotes.rca_flags().items()])
    cpq = f["sbqq__quote__c"].select(
        F.col("sbqq_quote_id").alias("quote"),
        *[c.alias(n) for n, c in quotes.cpq_flags(quotes.WIDE_AMOUNT).items()],
        positive_amount("refresh_acv", quotes.NARROW_AMOUNT).alias("positive_at_four_digits"),
    )
    return rca.unionByName(cpq, allowMissingColumns=True)


def line_rollup(f: Frames) -> DataFrame:
    return f["int_quote_lines"]


# Published column names that only one system supplies.
PADDED = (
    "opportunity_owner_id",
    "partner_sales_rep_id",
    "add_teaming_partner",
    "company",
    "products_of_interest",
    "customer_name",
    "deal_name",
    "is_registration_extended",
    "reg_denied_date",
)


def null_padded_union(f: Frames) -> DataFrame:
    """How many values each system supplies to the columns only one of them has."""
    counts = [F.count(c).alias(c) for c in PADDED]
    return f["dim_unified_deal_registration"].groupBy("source_system").agg(F.count("*").alias("n_rows"), *counts)


# --- marts -----------------------------------------------------------------------------


def mart(name: str) -> Callable[[Frames], DataFrame]:
    return lambda f: plain_numbers(f[name])


def portal_registration(f: Frames) -> DataFrame:
    return folded(f, "dim_vartopia_deal_registration", [*PORTAL_SHOWN, *PORTAL_NAMES_SHOWN])


# --- checks ----------------------------------------------------------------------------


def checks_of(*kinds: str) -> Callable[[Frames], DataFrame]:
    """Report on the declared rules of some kinds, over all models."""

    def report(f: Frames) -> DataFrame:
        return _report(f, kinds).select("model_name", "rule_name", "severity", "failures", "status")

    return report


def _report(f: Frames, kinds: Sequence[str] | None = None) -> DataFrame:
    return _checked(f, [r for r in all_rules(CFG) if kinds is None or r.kind in kinds])


def _checked(f: Frames, rules: Sequence[Rule]) -> DataFrame:
    """The report on the rules; a mart that several of its passes read is computed once."""
    return check_inputs(f.inputs, CFG, rules, keep=stored, scratch=TableStore(base_path=shared_folder(f.spark, "aside")))


def dq_blocking(f: Frames) -> DataFrame:
    """Report on the rules of one cadence."""
    rules = select_rules(all_rules(CFG), cadence="dq_blocking")
    return _checked(f, rules).select("model_name", "rule_name", "severity", "failures", "status")


def dq_observed(f: Frames) -> DataFrame:
    """Row rules of the stored registrations, counted while their tables are written."""
    rules = [r for r in all_rules(CFG) if r.kind in (NOT_NULL, ACCEPTED_VALUES, EXPRESSION) and r.model in OBSERVED]
    watch = RowRuleWatch(rules)
    models = build_models(f.inputs, CFG, only=OBSERVED, store=TableStore(base_path=shared_folder(f.spark, "store")), watch=watch)
    return check_models(f.inputs, models, CFG, rules, watch).select("model_name", "rule_name", "severity", "failures", "status")


def dq_scorecard(f: Frames) -> DataFrame:
    return scorecard(_report(f))


QUERIES: dict[str, Callable[[Frames], DataFrame]] = {
    "truthy_flags": truthy_flags,
    "rename_conform": rename_conform,
    "portal_staging": portal_staging,
    "unreadable_times": unreadable_times,
    "set_aside_counts": set_aside_counts,
    "readable_history": readable_history,
    "source_scan": source_scan,
    "stored_registrations": stored_registrations,
    "load_time": load_time,
    "latest_by_content": latest_by_content,
    "fallback_key": fallback_key,
    "surrogate_key": surrogate_keys,
    "strict_vs_lenient_delete": strict_vs_lenient_delete,
    "current_version": current_version,
    "latest_per_key": latest_per_key,
    "priority_dedupe": priority_dedupe,
    "role_lookup": role_lookup,
    "two_hop_lookup": two_hop_lookup,
    "owner_lookup": owner_lookup,
    "record_type_lookup": record_type_lookup,
    "bridge_inner_join": bridge_inner_join,
    "selling_model": selling_model,
    "exists_flag": exists_flag,
    "fan_out_guard": fan_out_guard,
    "task_without_record": task_without_record,
    "manager_chain": manager_chains,
    "top_manager": top_manager,
    "is_manager": is_manager,
    "user_display_name": user_display_name,
    "internal_domain": internal_domain,
    "stage_map": stage_map,
    "change_rollup": change_rollup,
    "closed_lost_exclusion": closed_lost_exclusion,
    "reporting_exclusion": reporting_exclusion,
    "forecast_bridge": forecast_bridge,
    "synced_quote": synced_quote,
    "product_classifiers": product_classifiers,
    "quote_union": quote_union,
    "refresh_flags": refresh_flags,
    "line_rollup": line_rollup,
    "null_padded_union": null_padded_union,
    "legacy_registration": mart("dim_deal_registration"),
    "portal_registration": portal_registration,
    "unified_registration": mart("dim_unified_deal_registration"),
    "dim_user": mart("dim_user"),
    "dim_opportunity": mart("dim_opportunity"),
    "dim_product": mart("dim_product"),
    "dim_quote": mart("dim_quote_unified"),
    "fct_quote": mart("fct_quote_unified"),
    "dq_row_rules": checks_of(NOT_NULL, ACCEPTED_VALUES, EXPRESSION),
    "dq_unique": checks_of(UNIQUE, UNIQUE_COMBINATION),
    "dq_relationships": checks_of(RELATIONSHIP),
    "dq_reconciliation": checks_of(ROW_COUNT),
    "dq_blocking": dq_blocking,
    "dq_observed": dq_observed,
    "dq_scorecard": dq_scorecard,
}
