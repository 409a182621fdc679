"""The declared checks a second time: each as its name, severity, quality dimension, cadence and the SQL that counts its failures.

Nothing here comes from the package: conditions are those under which a row fails, written out.
"""

from __future__ import annotations

from typing import NamedTuple

MODEL_PARTS = {
    "stg_deal_registration": "stg_legacy",
    "stg_vartopia_deal_registration": "stg_portal",
    "dim_user": "dim_user",
    "dim_deal_registration": "dim_legacy",
    "dim_vartopia_deal_registration": "dim_portal",
    "dim_unified_deal_registration": "dim_unified",
    "dim_opportunity": "dim_opportunity",
    "dim_product": "dim_product",
    "dim_quote_unified": "dim_quote",
    "fct_quote_unified": "fct_quote",
}
LEGACY, PORTAL, UNIFIED = "dim_deal_registration", "dim_vartopia_deal_registration", "dim_unified_deal_registration"
STAGED_LEGACY, STAGED_PORTAL = "stg_deal_registration", "stg_vartopia_deal_registration"
RAW_LEGACY, RAW_PORTAL = "deal_registration__c", "salesforce_vartopiadrs__registration__c"


class Check(NamedTuple):
    model: str
    rule_name: str
    kind: str
    severity: str
    dimension: str
    cadence: str | None
    failures: str


def part(model: str) -> str:
    return MODEL_PARTS.get(model, f"raw_{model}")


# Severity and cadence of the declared levels.
BLOCKING = ("error", "dq_blocking")
MONITORING = ("warn", "dq_monitoring")
MONTHLY = ("warn", "dq_monthly")
DEFAULT = ("error", None)


def _check(model: str, kind: str, subject: str, level: tuple[str, str | None], dimension: str, failures: str) -> Check:
    return Check(model, f"{kind}({subject})", kind, level[0], dimension, level[1], failures)


def missing(model: str, level: tuple[str, str | None], dimension: str, *columns: str) -> list[Check]:
    return [_check(model, "not_null", c, level, dimension, f"SELECT count(*) - count({c}) FROM {part(model)}") for c in columns]


def repeated(model: str, level: tuple[str, str | None], dimension: str, *columns: str) -> list[Check]:
    return [
        _check(
            model,
            "unique",
            c,
            level,
            dimension,
            f"SELECT count(*) FROM (SELECT count(*) AS n FROM {part(model)} GROUP BY {c} HAVING {c} IS NOT NULL) WHERE n > 1",
        )
        for c in columns
    ]


def repeated_together(model: str, level: tuple[str, str | None], columns: str, kept: str) -> Check:
    counted = f"SELECT count(*) AS n FROM {part(model)} WHERE {kept} GROUP BY {columns}"
    return _check(model, "unique_combination_of_columns", columns, level, "uniqueness", f"SELECT count(*) FROM ({counted}) WHERE n > 1")


def unlisted(model: str, level: tuple[str, str | None], dimension: str, column: str, fails: str) -> Check:
    return _check(model, "accepted_values", column, level, dimension, f"SELECT count(*) FROM {part(model)} WHERE {fails}")


def stated(model: str, level: tuple[str, str | None], dimension: str, name: str, fails: str) -> Check:
    return _check(model, "expression_is_true", name, level, dimension, f"SELECT count(*) FROM {part(model)} WHERE {fails}")


def orphaned(model: str, parent: str, key: str, *columns: str) -> list[Check]:
    return [
        _check(
            model,
            "relationships",
            c,
            MONITORING,
            "referential_integrity",
            f"SELECT count(*) FROM {part(model)} x ANTI JOIN {part(parent)} y ON y.{key} = x.{c} WHERE x.{c} IS NOT NULL",
        )
        for c in columns
    ]


def odd_length(model: str, *columns: str) -> list[Check]:
    return [
        stated(
            model,
            MONTHLY,
            "validity",
            f"length(trim({c})) IN (15, 18)",
            f"length(trim({c})) < 15 OR length(trim({c})) IN (16, 17) OR length(trim({c})) > 18",
        )
        for c in columns
    ]


def not_18(model: str, column: str) -> Check:
    return stated(model, MONTHLY, "validity", f"length(trim({column})) IN (18)", f"length(trim({column})) <> 18")


def registration_dates(model: str) -> list[Check]:
    return [
        *missing(model, BLOCKING, "completeness", "created_date", "last_modified_date", "edp_updated_at"),
        stated(model, MONTHLY, "accuracy", "days_since_approval >= 0", "days_since_approval < 0"),
        stated(
            model,
            MONTHLY,
            "validity",
            "CAST(expected_close_date AS DATE) >= DATE '2015-01-01'",
            "expected_close_date < TIMESTAMP '2015-01-01 00:00:00'",
        ),
        stated(model, MONITORING, "consistency", "created_date <= last_modified_date", "last_modified_date < created_date"),
    ]


def undeclined_denials(model: str) -> Check:
    return stated(
        model,
        MONITORING,
        "consistency",
        "denial_reason IS NULL OR registration_status IN ('Denied', 'Rejected', 'Declined', 'Deny', 'Reject')",
        "denial_reason IS NOT NULL AND NOT regexp_full_match(registration_status, 'Denied|Rejected|Declined|Deny|Reject')",
    )


CHECKS: list[Check] = [
    # legacy registrations
    *missing(LEGACY, BLOCKING, "completeness", "deal_registration_id", "is_deleted"),
    *repeated(LEGACY, BLOCKING, "uniqueness", "deal_registration_id"),
    *odd_length(LEGACY, "deal_registration_id", "distributor_account_id", "opportunity_id", "partner_account_id"),
    not_18(LEGACY, "x18_digit_deal_registration_id"),
    not_18(LEGACY, "x18_digit_owner_id"),
    unlisted(LEGACY, BLOCKING, "validity", "is_deleted", "is_deleted"),
    *registration_dates(LEGACY),
    undeclined_denials(LEGACY),
    stated(
        LEGACY,
        MONITORING,
        "consistency",
        "NOT (coalesce(am_approved, FALSE) AND coalesce(am_rejected, FALSE))",
        "am_approved IS TRUE AND am_rejected IS TRUE",
    ),
    *orphaned(LEGACY, "dim_user", "user_id", "created_by_id", "distributor_rep_id", "partner_sales_rep_id"),
    *orphaned(LEGACY, "dim_account", "account_id", "distributor_account_id", "partner_account_id"),
    *orphaned(LEGACY, "dim_contact", "contact_id", "internal_contact_id"),
    *orphaned(LEGACY, "dim_opportunity", "opportunity_id", "opportunity_id"),
    # portal registrations
    *missing(PORTAL, BLOCKING, "completeness", "vartopia_registration_id", "migrated_to_vartopia", "is_native_vartopia_registration"),
    *repeated(PORTAL, BLOCKING, "uniqueness", "vartopia_registration_id"),
    *odd_length(PORTAL, "vartopia_registration_id", "opportunity_id"),
    *registration_dates(PORTAL),
    stated(
        PORTAL,
        BLOCKING,
        "consistency",
        "migrated_to_vartopia != is_native_vartopia_registration",
        "migrated_to_vartopia = is_native_vartopia_registration",
    ),
    repeated_together(PORTAL, BLOCKING, "vartopia_sf_registration_id", "trim(vartopia_sf_registration_id) <> ''"),
    *orphaned(PORTAL, "dim_user", "user_id", "created_by_id", "opportunity_owner_id"),
    *orphaned(PORTAL, "dim_account", "account_id", "customer_account_id", "distributor_account_id", "partner_account_id"),
    *orphaned(PORTAL, "dim_opportunity", "opportunity_id", "opportunity_id"),
    # unified registrations
    *missing(UNIFIED, BLOCKING, "completeness", "source_system", "registration_id", "is_clone", "is_deleted"),
    repeated_together(UNIFIED, BLOCKING, "source_system,registration_id", "TRUE"),
    _check(
        UNIFIED,
        "row_count_reconciliation",
        f"{LEGACY}+{PORTAL}",
        MONITORING,
        "reconciliation",
        f"SELECT CAST((SELECT count(*) FROM {part(UNIFIED)}) - (SELECT count(*) FROM {part(LEGACY)}) "
        f"<> (SELECT count(*) FROM {part(PORTAL)}) AS BIGINT)",
    ),
    unlisted(UNIFIED, BLOCKING, "validity", "source_system", "source_system <> 'LEGACY' AND source_system <> 'VARTOPIA'"),
    stated(
        UNIFIED,
        BLOCKING,
        "completeness",
        "source_system = 'LEGACY' OR migrated_to_vartopia IS NOT NULL",
        "source_system <> 'LEGACY' AND migrated_to_vartopia IS NULL",
    ),
    stated(
        UNIFIED,
        BLOCKING,
        "completeness",
        "source_system = 'LEGACY' OR is_native_vartopia_registration IS NOT NULL",
        "source_system <> 'LEGACY' AND is_native_vartopia_registration IS NULL",
    ),
    stated(
        UNIFIED,
        BLOCKING,
        "consistency",
        "source_system = 'LEGACY' OR migrated_to_vartopia != is_native_vartopia_registration",
        "source_system <> 'LEGACY' AND migrated_to_vartopia = is_native_vartopia_registration",
    ),
    stated(
        UNIFIED,
        BLOCKING,
        "validity",
        "source_system = 'VARTOPIA' OR coalesce(migrated_to_vartopia, is_native_vartopia_registration) IS NULL",
        "source_system <> 'VARTOPIA' AND (migrated_to_vartopia IS NOT NULL OR is_native_vartopia_registration IS NOT NULL)",
    ),
    *odd_length(UNIFIED, "registration_id", "opportunity_id"),
    unlisted(UNIFIED, BLOCKING, "validity", "is_deleted", "is_deleted"),
    *registration_dates(UNIFIED),
    undeclined_denials(UNIFIED),
    *orphaned(UNIFIED, "dim_user", "user_id", "created_by_id", "opportunity_owner_id"),
    *orphaned(UNIFIED, "dim_account", "account_id", "distributor_account_id", "partner_account_id"),
    *orphaned(UNIFIED, "dim_opportunity", "opportunity_id", "opportunity_id"),
    # other marts
    *missing("dim_opportunity", DEFAULT, "none", "opportunity_id"),
    *repeated("dim_opportunity", DEFAULT, "none", "opportunity_id"),
    *missing("dim_product", DEFAULT, "none", "product2_id", "product_sk"),
    *repeated("dim_product", DEFAULT, "none", "product2_id", "product_sk"),
    *missing("dim_user", DEFAULT, "none", "user_id", "is_internal_user", "edp_updated_at"),
    *repeated("dim_user", DEFAULT, "none", "user_id"),
    *missing("dim_quote_unified", DEFAULT, "none", "quote_id", "quote_unified_sk", "source_system"),
    *repeated("dim_quote_unified", DEFAULT, "none", "quote_unified_sk"),
    unlisted("dim_quote_unified", DEFAULT, "none", "source_system", "source_system <> 'RCA' AND source_system <> 'CPQ'"),
    *missing("fct_quote_unified", DEFAULT, "none", "quote_unified_sk", "source_system"),
    *repeated("fct_quote_unified", DEFAULT, "none", "quote_unified_sk"),
    unlisted("fct_quote_unified", DEFAULT, "none", "source_system", "source_system <> 'RCA' AND source_system <> 'CPQ'"),
    # staging and raw inputs
    *missing(STAGED_LEGACY, DEFAULT, "none", "deal_registration_id", "is_deleted"),
    *repeated(STAGED_LEGACY, DEFAULT, "none", "deal_registration_id"),
    *missing(
        STAGED_PORTAL, DEFAULT, "none", "vartopia_registration_id", "migrated_to_vartopia", "is_native_vartopia_registration", "is_deleted"
    ),
    *repeated(STAGED_PORTAL, DEFAULT, "none", "vartopia_registration_id"),
    *missing(RAW_LEGACY, DEFAULT, "none", "id"),
    *repeated(RAW_LEGACY, DEFAULT, "none", "id"),
    *missing(RAW_PORTAL, DEFAULT, "none", "id"),
    *repeated(RAW_PORTAL, DEFAULT, "none", "id"),
    *missing("opportunity", DEFAULT, "none", "opportunity_id"),
]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def report(*kinds: str, cadence: str | None = None, models: tuple[str, ...] = ()) -> str:
    rows = [
        f"SELECT {_text(c.model)} AS model_name, {_text(c.rule_name)} AS rule_name, {_text(c.severity)} AS severity, "
        f"{_text(c.dimension)} AS dimension, ({c.failures}) AS failures"
        for c in CHECKS
        if (not kinds or c.kind in kinds) and cadence in (None, c.cadence) and (not models or c.model in models)
    ]
    return "SELECT *, if(failures = 0, 'pass', severity) AS status FROM (" + "\nUNION ALL ".join(rows) + ")"
