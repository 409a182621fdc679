"""User dimension: conformed people, manager chain, role and profile names."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.config import Config
from revmart.functions.columns import blank_to_null, email_in_domain, proper_case
from revmart.operators.conform import narrowed, project
from revmart.operators.hierarchy import chain_depth, level_column, manager_chain, top_value, with_manager_flag
from revmart.operators.lookups import Lookup, enrich, needed
from revmart.operators.versions import current
from revmart.plans import contracts

# Published name -> raw column, where it differs, for text that is trimmed and blanked.
_TEXTS = {
    "assigned_territory": "territory",
    "company_name": "company_name",
    "created_by_id": "created_by_id",
    "department": "department",
    "email": "email",
    "manager_id": "manager_id",
    "profile_id": "profile_id",
    "title": "title",
    "user_role_id": "user_role_id",
    "user_type": "user_type",
    "login_username": "username",
    "vp_sales_id": "vp_sales",
}
_AS_IS = ("user_id", "created_date", "geo", "region", "is_active", "last_modified_date", "role_start_date", "system_modstamp")


def display_name(first: str = "first_name", last: str = "last_name", full: str = "name") -> Column:
    """First and last name when both are present, else the full name, in proper case."""
    both = F.concat(proper_case(first), F.lit(" "), proper_case(last))
    return F.coalesce(both, proper_case(full))


def people(user: DataFrame, cfg: Config) -> DataFrame:
    """Current users with conformed attributes; what other marts look names up in."""
    return current(user).select(
        *_AS_IS,
        *[blank_to_null(raw).alias(name) for name, raw in _TEXTS.items()],
        proper_case("first_name").alias("first_name"),
        proper_case("last_name").alias("last_name"),
        display_name().alias("user_name"),
        email_in_domain("email", cfg.internal_domain).alias(cfg.employee_flag),
    )


def user_lookups(users: DataFrame, userrole: DataFrame, profile: DataFrame) -> list[Lookup]:
    """Names of a user's role, profile and vice president."""
    roles = current(userrole).select("userrole_id", blank_to_null("name").alias("user_role_name"))
    profiles = current(profile).select("profile_id", blank_to_null("name").alias("profile_name"))
    links = users.select("user_id", "manager_id", "user_name", "title")
    return [
        Lookup(roles, "user_role_id", "userrole_id", {"user_role_name": "user_role_name"}),
        Lookup(profiles, "profile_id", "profile_id", {"profile_name": "profile_name"}),
        Lookup(links, "vp_sales_id", "user_id", {"user_name": "vp_sales_name", "title": "vp_sales_title"}),
    ]


def build_dim_user(
    user: DataFrame, userrole: DataFrame, profile: DataFrame, cfg: Config, columns: Collection[str] | None = None
) -> DataFrame:
    base = people(user, cfg)
    levels = cfg.manager_levels
    fields = narrowed(contracts.published(contracts.USER, cfg), columns)
    lookups = needed(user_lookups(base, userrole, profile), columns)
    own = {*base.columns, "has_manager_flag", "has_vp_sales_flag", "edp_updated_at"}
    own |= {alias for step in lookups for alias in step.attrs.values()}
    if any(f.name not in own for f in fields):  # manager columns
        base = manager_chain(with_manager_flag(base), levels)
    named = enrich(base, lookups, ["user_id"], cfg.guard_lookups)
    computed = {
        "direct_manager_name": F.col(level_column(1, "name")),
        "direct_manager_title": F.col(level_column(1, "title")),
        "has_manager_flag": F.col("manager_id").isNotNull(),
        "has_vp_sales_flag": F.col("vp_sales_id").isNotNull(),
        "manager_chain_depth": chain_depth(levels),
        "top_manager_name": top_value("name", levels),
        "top_manager_title": top_value("title", levels),
        "edp_updated_at": cfg.load_time(),
    }
    return project(named, fields, computed)
