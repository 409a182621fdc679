"""Deal registrations: legacy and portal staging, their dimensions and the unified one."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.config import Config
from revmart.functions.columns import fallback_key, is_true, proper_case
from revmart.operators.conform import Field, Fold, conform, folded, narrowed, project, readable_rows
from revmart.operators.lookups import Lookup, enrich, needed, presence
from revmart.operators.unions import union_sources
from revmart.operators.versions import first_per_key, first_places, live
from revmart.plans import contracts
from revmart.plans.reference import accounts
from revmart.sources.catalog import Stage


def _conformed(raw: DataFrame, fields: list[Field], cfg: Config) -> DataFrame:
    return conform(readable_rows(raw, fields) if cfg.set_aside else raw, fields, cfg.lenient_times)


def build_stg_legacy(raw: DataFrame, cfg: Config) -> DataFrame:
    return _conformed(raw, contracts.legacy_staging(cfg), cfg)


def conform_portal(raw: DataFrame, cfg: Config) -> DataFrame:
    """Portal rows under their published names, without the migration flags."""
    return _conformed(raw, contracts.portal_staging(cfg), cfg)


def legacy_presence(stg_legacy: DataFrame) -> Lookup:
    """Whether a portal row's opportunity has a live legacy registration."""
    return presence(live(stg_legacy), "opportunity_id", "opportunity_id", "migrated_to_vartopia")


def migration_flags() -> dict[str, Column]:
    """Migrated or native, one the inverse of the other, never NULL."""
    migrated = is_true("migrated_to_vartopia")
    return {"migrated_to_vartopia": migrated, "is_native_vartopia_registration": ~migrated}


def build_stg_portal(raw: DataFrame, stg_legacy: DataFrame, cfg: Config, fold: Fold | None = None) -> DataFrame:
    """Portal rows with the migration flags.  With a ``fold`` its columns are folded before the rows move."""
    portal, names = conform_portal(raw, cfg), [f.name for f in contracts.portal_staging(cfg)]
    if fold is not None:
        portal = folded(portal, [Field(name, name) for name in names], {}, fold)
        names = [*[name for name in names if name in fold.shown], fold.name]
    flagged = enrich(portal.select(*dict.fromkeys([*names, "opportunity_id"])), [legacy_presence(stg_legacy)])
    at = names.index("is_deleted")
    flags = [flag.alias(name) for name, flag in migration_flags().items()]
    return flagged.select(*names[:at], *flags, *names[at:])


def legacy_lookups(account: DataFrame, contact: DataFrame, users: DataFrame, cfg: Config) -> list[Lookup]:
    """Names of the accounts, the contact and the users of a legacy registration."""
    org = cfg.org_prefix
    account_names = accounts(account)

    def account_as(fk: str, alias: str) -> Lookup:
        return Lookup(account_names, fk, "account_id", {"account_name": alias})

    def user_as(fk: str, alias: str) -> Lookup:
        return Lookup(users, fk, "user_id", {"user_name": alias})

    return [
        account_as("partner_account_id", "partner_account_name"),
        account_as("distributor_account_id", "distributor_account_name"),
        Lookup(contact, f"{org}_contact_id", "contact_id", {"name": f"{org}_contact_name"}),
        user_as("partner_sales_rep_id", "partner_sales_rep_name"),
        user_as("distributor_rep_id", "distributor_rep_name"),
        user_as("opportunity_owner", "opportunity_owner_name"),
        user_as("opportunity_owner_rd", "opportunity_owner_rd_name"),
    ]


def build_dim_legacy(
    stg_legacy: DataFrame,
    account: DataFrame,
    contact: DataFrame,
    users: DataFrame,
    cfg: Config,
    columns: Collection[str] | None = None,
) -> DataFrame:
    lookups = needed(legacy_lookups(account, contact, users, cfg), columns)
    named = enrich(live(stg_legacy), lookups, ["deal_registration_id"], cfg.guard_lookups)
    trimmed = ("champion_contact_email", "champion_contact_phone", "company", "lead_owner_email")
    proper = ("champion_contact_first_name", "champion_contact_last_name")
    computed = (
        {name: F.trim(name) for name in trimmed}
        | {name: proper_case(name) for name in proper}
        | {"current_user_id": F.col("current_user_id").cast("string"), "edp_updated_at": cfg.load_time()}
    )
    return project(named, narrowed(contracts.published(contracts.LEGACY_REGISTRATION, cfg), columns), computed)


def portal_dedupe_key() -> Column:
    """The portal's own registration id, or partner, opportunity and close date together."""
    # Placeholders for missing parts.
    return fallback_key(
        "vartopia_sf_registration_id",
        {
            "NO_PARTNER": F.col("partner_account_id"),
            "NO_OPP": F.col("opportunity_id"),
            "NO_DATE": F.to_date("expected_close_date"),
        },
    )


def portal_order() -> list[Column]:
    """Originals before clones, manual before automatic, newest first."""
    return [
        is_true("is_clone").asc(),
        is_true("is_created_by_auto_reg").asc(),
        F.col("last_modified_date").desc_nulls_last(),
        F.col("vartopia_registration_id").asc_nulls_first(),
    ]


def dedupe_portal(portal: DataFrame) -> DataFrame:
    """One live row per dedupe key, the first in the portal's order."""
    return first_per_key(live(portal), [portal_dedupe_key()], portal_order())


# What the portal's order reads.
PORTAL_PLACES = ("is_clone", "is_created_by_auto_reg", "last_modified_date", "vartopia_registration_id")


def enriched_survivors(portal: DataFrame, lookups: list[Lookup], columns: Collection[str], guard: bool) -> DataFrame:
    """The ``columns`` of ``dedupe_portal`` with what ``lookups`` find, while the wide rows move once.

    Survivors are found and enriched as narrow rows, and the wide rows move to meet them in a hash join.  Where rows of a
    key are equal in the portal's order (an id occurs twice), one with the survivor's references is kept, where they meet.
    """
    if not lookups:
        return dedupe_portal(portal).select(*columns)
    rows, fks = live(portal), sorted({step.fk for step in lookups})
    narrow = rows.select(portal_dedupe_key().alias("_first_key"), *dict.fromkeys([*PORTAL_PLACES, *fks]))
    firsts = enrich(first_places(narrow, "_first_key", portal_order()), lookups, ["_first_key"], guard, in_place=True)
    found = [b for step in lookups for b in step.attrs.values()]
    references = F.struct(*fks)
    # A lookup key that occurs twice gives a survivor several rows, as a join does.
    copy = F.row_number().over(Window.partitionBy("_first_key").orderBy(*found)).alias("_copy")
    places = firsts.select("_first_key", F.struct(*PORTAL_PLACES).alias("_first_places"), references.alias("_references"), *found, copy)
    is_first = (portal_dedupe_key() == F.col("_first_key")) & (F.struct(*PORTAL_PLACES) == F.col("_first_places"))
    met = rows.join(places.hint("shuffle_hash"), is_first)
    kept = first_per_key(met, [F.col("_first_key"), F.col("_first_places"), F.col("_copy")], [(references == F.col("_references")).desc()])
    return kept.select(*columns, *found)


def staged_survivors(portal: DataFrame, lookups: list[Lookup], columns: Collection[str], guard: bool, stage: Stage) -> DataFrame:
    """The same of rows that are put aside by their key: none of the wide rows is shuffled or sorted once they lie there.

    Each row gets a mark when it is put aside, which orders rows that are equal in the portal's order.
    """
    fks = sorted({step.fk for step in lookups})
    kept = dict.fromkeys([*columns, *PORTAL_PLACES, *fks])
    aside = live(portal).select(portal_dedupe_key().alias("_first_key"), F.monotonically_increasing_id().alias("_mark"), *kept)
    rows = stage(aside, "_first_key")
    narrow = rows.select("_first_key", "_mark", *dict.fromkeys([*PORTAL_PLACES, *fks]))
    firsts = first_per_key(narrow, [F.col("_first_key")], [*portal_order(), F.col("_mark")])
    named = enrich(firsts.select("_first_key", "_mark", *fks), lookups, ["_first_key"], guard, in_place=True)
    found = [b for step in lookups for b in step.attrs.values()]
    places = named.select(F.col("_first_key").alias("_place_key"), F.col("_mark").alias("_place_mark"), *found)
    # The marks are compared beside the key: as a key of the join they would move the rows.
    is_first = (F.col("_first_key") == F.col("_place_key")) & (F.col("_mark").bitwiseXOR(F.col("_place_mark")) == 0)
    return rows.join(places.hint("shuffle_hash"), is_first).select(*columns, *found)


def portal_lookups(account: DataFrame, users: DataFrame) -> list[Lookup]:
    """Names of the accounts and the owner of a portal registration."""
    account_names = accounts(account)
    return [
        Lookup(account_names, "partner_account_id", "account_id", {"account_name": "partner_account_name"}),
        Lookup(account_names, "distributor_account_id", "account_id", {"account_name": "distributor_account_name"}),
        Lookup(users, "opportunity_owner_id", "user_id", {"user_name": "opportunity_owner_name"}),
    ]


def build_dim_portal(
    raw: DataFrame,
    stg_legacy: DataFrame,
    account: DataFrame,
    users: DataFrame,
    cfg: Config,
    columns: Collection[str] | None = None,
    fold: Fold | None = None,
    stage: Stage | None = None,
) -> DataFrame:
    """Survivors first, flags and names afterwards: neither influences which row survives.

    With a ``fold`` its columns, which no lookup may supply, are folded before the rows move; with a ``stage`` the rows are put aside.
    """
    flags = migration_flags()
    lookups = needed(portal_lookups(account, users), columns)
    if columns is None or not set(columns).isdisjoint(flags):
        lookups = [legacy_presence(stg_legacy), *lookups]
    fields = narrowed(contracts.published(contracts.PORTAL_REGISTRATION, cfg), columns)
    portal, now = conform_portal(raw, cfg), {"edp_updated_at": cfg.load_time()}
    if fold is not None:
        portal = folded(portal, fields, now, fold)
        fields = [*[f for f in fields if f.name in fold.shown], Field(fold.name, fold.name)]
    read = [c for c in portal.columns if c in {f.source for f in fields}]
    if stage is not None and lookups:
        named = staged_survivors(portal, lookups, read, cfg.guard_lookups, stage)
    else:
        named = enriched_survivors(portal, lookups, read, cfg.guard_lookups)
    return project(named, fields, flags | now)


# What each system calls the unified registration id.
UNIFIED_IDS = {"dim_deal_registration": "deal_registration_id", "dim_vartopia_deal_registration": "vartopia_registration_id"}


def build_dim_unified(
    dim_legacy: DataFrame, dim_portal: DataFrame, cfg: Config, columns: Collection[str] | None = None
) -> DataFrame:
    """Both systems under one contract; what a system lacks is NULL."""
    contract = [f.name for f in narrowed(contracts.published(contracts.UNIFIED_REGISTRATION, cfg), columns)]

    def side(df: DataFrame, registration_id: str) -> DataFrame:
        df = df.withColumnRenamed(registration_id, "registration_id")
        return df.select(*[c for c in contract if c in df.columns])

    both = union_sources(
        {
            "LEGACY": side(dim_legacy, UNIFIED_IDS["dim_deal_registration"]),
            "VARTOPIA": side(dim_portal, UNIFIED_IDS["dim_vartopia_deal_registration"]),
        }
    )
    return both.select(*contract)
