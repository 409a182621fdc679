"""The comparison SQL of every query: a final SELECT plus the relations it needs."""

from __future__ import annotations

import re
from functools import cache

from oracle.checks import report
from oracle.parts import (
    OPPORTUNITY_RULES,
    PARTS,
    PRODUCT_RULES,
    RCA_RULES,
    amount,
    cpq_rules,
    digest,
)
from revmart.plans import contracts
from revmart.plans.queries import CFG, OBSERVED, PORTAL_NAMES_SHOWN, PORTAL_SHOWN, UNIFIED_SHOWN
from revmart.sources.derived import TEST_TABLES

_WORD = re.compile(r"\b[a-z]\w*\b")


def _needed(text: str) -> set[str]:
    return {w for w in _WORD.findall(text) if w in PARTS}


def with_parts(select: str) -> str:
    """Prepend the relations a SELECT needs, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        if not name.startswith("raw_"):
            for other in sorted(_needed(PARTS[name]) - {name}):
                visit(other)
        ordered.append(name)

    for name in sorted(_needed(select)):
        visit(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n].strip()})" for n in ordered) + "\n" + select


def _folded(relation: str, columns: list[str], shown: tuple[str, ...]) -> str:
    rest = sorted(set(columns) - set(shown))
    return f"SELECT {', '.join(shown)}, {digest(rest)} AS other_columns_digest FROM {relation}"


def _rules(rules: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in rules.items())


def _opportunity(*names: str) -> str:
    picked = {n: OPPORTUNITY_RULES[n] for n in names}
    return f"SELECT opportunity_id, {_rules(picked)} FROM raw_opportunity WHERE is_current"


_CHAIN_COLUMNS = ", ".join(f"manager_level_{i}_{a}" for i in range(1, 8) for a in ("user_id", "name", "title"))
_PORTAL_STAGED = [f.name for f in contracts.portal_staging(CFG)] + [
    "migrated_to_vartopia",
    "is_native_vartopia_registration",
]
_PORTAL_PUBLISHED = [f.name for f in contracts.published(contracts.PORTAL_REGISTRATION, CFG)]
_LEGACY_FLAGS = ", ".join(f.name for f in contracts.legacy_staging(CFG) if f.kind == "flag")
_PADDED = (
    "opportunity_owner_id", "partner_sales_rep_id", "add_teaming_partner", "company", "products_of_interest",
    "customer_name", "deal_name", "is_registration_extended", "reg_denied_date",
)

def _with_amounts(relation: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{amount(c)} AS {c}' for c in columns)}) FROM {relation}"


ROW_KINDS = ("not_null", "accepted_values", "expression_is_true")

# Every lookup, with the relation and column that have to be unique, and relations that are not.
_LOOKUP_SIDES = {
    "dim_deal_registration.partner_account_id": ("raw_dim_account", "account_id"),
    "dim_deal_registration.distributor_account_id": ("raw_dim_account", "account_id"),
    "dim_deal_registration.internal_contact_id": ("raw_dim_contact", "contact_id"),
    "dim_deal_registration.partner_sales_rep_id": ("people", "user_id"),
    "dim_deal_registration.distributor_rep_id": ("people", "user_id"),
    "dim_deal_registration.opportunity_owner": ("people", "user_id"),
    "dim_deal_registration.opportunity_owner_rd": ("people", "user_id"),
    "dim_vartopia_deal_registration.partner_account_id": ("raw_dim_account", "account_id"),
    "dim_vartopia_deal_registration.distributor_account_id": ("raw_dim_account", "account_id"),
    "dim_vartopia_deal_registration.opportunity_owner_id": ("people", "user_id"),
    "dim_opportunity.owner_id": ("people", "user_id"),
    "dim_opportunity.bill_to": ("billing", "address_id"),
    "dim_opportunity.record_type_id": ("record_types", "record_type_id"),
    "dim_quote_unified.record_type_id": ("quote_record_types", "record_type_id"),
    "dim_user.user_role_id": ("(SELECT * FROM raw_userrole WHERE is_current)", "userrole_id"),
    "dim_user.profile_id": ("(SELECT * FROM raw_profile WHERE is_current)", "profile_id"),
    "dim_user.vp_sales_id": ("people", "user_id"),
    "raw.user": ("raw_user", "user_id"),
    "raw.recordtype": ("raw_recordtype", "record_type_id"),
    "raw.opportunity": ("raw_opportunity", "opportunity_id"),
}

SELECTS: dict[str, str] = {
    "truthy_flags": f"SELECT deal_registration_id, {_LEGACY_FLAGS} FROM stg_legacy",
    "rename_conform": "SELECT * FROM stg_legacy",
    "portal_staging": _folded("stg_portal", _PORTAL_STAGED, PORTAL_SHOWN),
    "unreadable_times": "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS unparsed FROM raw_opportunity_field_history "
        f"WHERE {c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL"
        for c in ("old_value", "new_value", "created_date")
    ),
    "set_aside_counts": "SELECT column_name, value, count(*) AS n_rows FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM raw_opportunity_field_history "
        f"WHERE {c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL"
        for c in ("old_value", "new_value", "created_date")
    )
    + ") GROUP BY column_name, value",
    "readable_history": "SELECT opportunity_id, field_name, TRY_CAST(old_value AS TIMESTAMP) AS old_value, "
    "TRY_CAST(new_value AS TIMESTAMP) AS new_value FROM raw_opportunity_field_history "
    "WHERE (old_value IS NULL) = (TRY_CAST(old_value AS TIMESTAMP) IS NULL) "
    "AND (new_value IS NULL) = (TRY_CAST(new_value AS TIMESTAMP) IS NULL)",
    "source_scan": " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TEST_TABLES),
    "stored_registrations": f"SELECT source_system, registration_id, {', '.join(UNIFIED_SHOWN)} FROM dim_unified",
    "load_time": "SELECT user_id, TRUE AS is_query_time FROM people",
    "latest_by_content": "SELECT DISTINCT quote_id, system_modstamp, created_date FROM (SELECT quote_id, system_modstamp, created_date, "
    "row_number() OVER (PARTITION BY quote_id ORDER BY system_modstamp DESC NULLS LAST, created_date DESC NULLS LAST) AS place "
    "FROM raw_quote WHERE is_deleted = FALSE) WHERE place = 1",
    "fallback_key": "SELECT vartopia_registration_id, dedupe_key FROM keyed_portal",
    "surrogate_key": "SELECT quote_number, md5(quote_id) AS one_part, "
    "md5(quote_id || '-' || ifnull(legacy_quote_id, '_dbt_utils_surrogate_key_null_')) AS two_parts FROM raw_quote",
    "strict_vs_lenient_delete": "SELECT quote_number, 'strict' AS mode FROM raw_quote WHERE is_deleted = FALSE "
    "UNION ALL SELECT quote_number, 'lenient' FROM raw_quote WHERE is_deleted IS NOT TRUE",
    "current_version": "SELECT opportunity_id, stage_name, owner_id, is_deleted FROM raw_opportunity WHERE is_current",
    "latest_per_key": "SELECT quote_id, quote_number, system_modstamp, created_date, gross_refresh_acv FROM latest_quotes",
    "priority_dedupe": "SELECT vartopia_registration_id, dedupe_key, is_clone, last_modified_date FROM deduped_portal",
    "role_lookup": "SELECT deal_registration_id, partner_account_name, distributor_account_name, internal_contact_name, "
    "partner_sales_rep_name, distributor_rep_name, opportunity_owner_name, opportunity_owner_rd_name FROM dim_legacy",
    "two_hop_lookup": "SELECT address_id, bill_country FROM billing",
    "owner_lookup": "SELECT o.opportunity_id, w.user_name AS opportunity_owner_name, w.geo AS opportunity_owner_geo, "
    "w.region AS opportunity_owner_region FROM raw_opportunity o LEFT JOIN people w ON w.user_id = o.owner_id "
    "WHERE o.is_current",
    "record_type_lookup": "SELECT o.opportunity_id, o.record_type_id AS opportunity_record_type, "
    "t.record_type_name AS opportunity_record_type_desc FROM raw_opportunity o "
    "LEFT JOIN record_types t ON t.record_type_id = o.record_type_id WHERE o.is_current",
    "bridge_inner_join": "SELECT product2_id, product_selling_model_name FROM selling_models",
    "selling_model": "SELECT product2_id, product_selling_model_name, nacv_pricing_eligible_flag FROM dim_product",
    "exists_flag": "SELECT vartopia_registration_id, opportunity_id, migrated_to_vartopia, "
    "is_native_vartopia_registration FROM stg_portal",
    "fan_out_guard": "SELECT lookup, key, count(*) AS n_rows FROM ("
    + " UNION ALL ".join(f"SELECT '{name}' AS lookup, {key} AS key FROM {side}" for name, (side, key) in _LOOKUP_SIDES.items())
    + ") WHERE key IS NOT NULL GROUP BY lookup, key HAVING count(*) > 1",
    "task_without_record": "SELECT opportunity_id, bva_support_task_count, has_bva_task_without_bva_record FROM covered",
    "manager_chain": f"SELECT p.user_id, {_CHAIN_COLUMNS}, coalesce(w.depth, 0) AS manager_chain_depth "
    "FROM people p LEFT JOIN chain_wide w ON w.user_id = p.user_id",
    "top_manager": "SELECT p.user_id, w.top_name AS top_manager_name, w.top_title AS top_manager_title "
    "FROM people p LEFT JOIN chain_wide w ON w.user_id = p.user_id",
    "is_manager": "SELECT user_id, user_id IN (SELECT s.manager_id FROM people s WHERE s.manager_id IS NOT NULL) "
    "AS is_manager_flag FROM people",
    "user_display_name": "SELECT user_id, first_name, last_name, user_name FROM people",
    "internal_domain": "SELECT user_id, is_current, "
    "if(email IS NULL, NULL, lower(regexp_extract(email, '@([^@]*)', 1)) = 'corp.example') AS is_internal_user FROM raw_user",
    "stage_map": "SELECT o.opportunity_id, o.stage_name, s.stage_group, s.stage_order FROM raw_opportunity o "
    "LEFT JOIN stages s ON s.stage_name = o.stage_name WHERE o.is_current",
    "change_rollup": "SELECT * FROM close_dates",
    "closed_lost_exclusion": _opportunity("non_qualified_loss_flag", "closed_lost_exclusion_flag"),
    "reporting_exclusion": _opportunity("revops_reporting_exclusion_flag"),
    "forecast_bridge": _opportunity("sales_forecast_category_bridge"),
    "synced_quote": _opportunity("resolved_synced_quote_id", "resolved_quote_source_system"),
    "product_classifiers": f"SELECT product2_id, {_rules(PRODUCT_RULES)} FROM modelled_products",
    "quote_union": "SELECT quote_unified_sk, source_system, quote_id, quote_number, quote_line_count, record_type_name "
    "FROM dim_quote",
    "refresh_flags": f"SELECT quote_number AS quote, {_rules(RCA_RULES)}, NULL AS positive_at_four_digits FROM raw_quote "
    f"UNION ALL SELECT sbqq_quote_id, {_rules(cpq_rules('DECIMAL(33,15)'))}, "
    "ifnull(TRY_CAST(refresh_acv AS DECIMAL(30,4)), 0) > 0 FROM raw_sbqq__quote__c",
    "line_rollup": "SELECT * FROM lines",
    "null_padded_union": "SELECT source_system, count(*) AS n_rows, "
    + ", ".join(f"count({c}) AS {c}" for c in _PADDED)
    + " FROM dim_unified GROUP BY source_system",
    "legacy_registration": "SELECT * FROM dim_legacy",
    "portal_registration": _folded("dim_portal", _PORTAL_PUBLISHED, (*PORTAL_SHOWN, *PORTAL_NAMES_SHOWN)),
    "unified_registration": "SELECT * FROM dim_unified",
    "dim_user": "SELECT * FROM dim_user",
    "dim_opportunity": _with_amounts("dim_opportunity", "renewal_forecast"),
    "dim_product": _with_amounts(
        "dim_product",
        "deferred_revenue_account",
        "percent_renewal_uplift",
        "renewal_uplift_eligible",
        "revenue_product_category",
        "royalty_amount_per_unit",
    ),
    "dim_quote": "SELECT COLUMNS(*) FROM dim_quote",
    "fct_quote": "SELECT * FROM fct_quote",
    "dq_row_rules": f"SELECT * EXCLUDE (dimension) FROM ({report(*ROW_KINDS)})",
    "dq_unique": f"SELECT * EXCLUDE (dimension) FROM ({report('unique', 'unique_combination_of_columns')})",
    "dq_relationships": f"SELECT * EXCLUDE (dimension) FROM ({report('relationships')})",
    "dq_reconciliation": f"SELECT * EXCLUDE (dimension) FROM ({report('row_count_reconciliation')})",
    "dq_blocking": f"SELECT * EXCLUDE (dimension) FROM ({report(cadence='dq_blocking')})",
    "dq_observed": f"SELECT * EXCLUDE (dimension) FROM ({report(*ROW_KINDS, models=OBSERVED)})",
    "dq_scorecard": "SELECT dimension, count(*) AS rules, count(*) FILTER (status = 'pass') AS passed, "
    "count(*) FILTER (status = 'warn') AS warned, count(*) FILTER (status = 'error') AS failed, "
    f"CAST(sum(failures) AS BIGINT) AS failures FROM ({report()}) GROUP BY dimension",
}


@cache
def oracle_texts() -> dict[str, str]:
    return {name: with_parts(select) for name, select in SELECTS.items()}
