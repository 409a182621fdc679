"""All models in build order, and building a selection of them."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame

from revmart.config import Config
from revmart.operators.conform import Fold, set_aside_rows, typed
from revmart.operators.lookups import Lookup
from revmart.operators.quality import RowRuleWatch, Rule, evaluate, names_read, passes
from revmart.plans import contracts, opportunities, products, quotes, registrations, users
from revmart.plans.checks import all_rules
from revmart.sources.catalog import Stage, TableStore

Get = Callable[[str], DataFrame]


#: Columns wanted of a model; None for all.
Columns = Collection[str] | None


@dataclass(frozen=True)
class Model:
    """A named result: its layer, tags, whether it is stored and by which key it is bucketed, and how it is built.

    A build that is asked for some columns leaves out the joins that only supply others.
    """

    layer: str
    tags: tuple[str, ...]
    stored: bool
    build: Callable[[Get, Config, Columns], DataFrame]
    bucket_by: tuple[str, ...] = ()
    build_folded: Callable[[Get, Config, Fold], DataFrame] | None = None
    build_staged: Callable[[Get, Config, Columns, Stage], DataFrame] | None = None


# Names read by several marts come from ``int_people``, the conformed current users behind
# the user dimension: the dimension's own lookups add columns, never rows.
MODELS: dict[str, Model] = {
    "stg_deal_registration": Model(
        "staging",
        ("staging", "salesforce", "deal_registration"),
        False,
        lambda get, cfg, columns: registrations.build_stg_legacy(get("deal_registration__c"), cfg),
    ),
    "stg_vartopia_deal_registration": Model(
        "staging",
        ("staging", "salesforce", "vartopia", "deal_registration"),
        False,
        lambda get, cfg, columns: registrations.build_stg_portal(
            get("salesforce_vartopiadrs__registration__c"), get("stg_deal_registration"), cfg
        ),
        build_folded=lambda get, cfg, fold: registrations.build_stg_portal(
            get("salesforce_vartopiadrs__registration__c"), get("stg_deal_registration"), cfg, fold
        ),
    ),
    "int_people": Model("intermediate", ("intermediate",), False, lambda get, cfg, columns: users.people(get("user"), cfg)),
    "int_latest_quote": Model(
        "intermediate",
        ("intermediate",),
        True,
        lambda get, cfg, columns: quotes.latest_quotes(get("quote"), cfg),
        bucket_by=("quote_id",),
    ),
    "int_quote_lines": Model(
        "intermediate",
        ("intermediate",),
        True,
        lambda get, cfg, columns: quotes.quote_lines(get("fct_quote_line_unified")),
        bucket_by=("quote_id",),
    ),
    "dim_user": Model(
        "gold",
        ("gold", "common", "dimension", "salesforce"),
        True,
        lambda get, cfg, columns: users.build_dim_user(get("user"), get("userrole"), get("profile"), cfg, columns),
    ),
    "dim_deal_registration": Model(
        "gold",
        ("gold", "common", "deal_registration"),
        True,
        lambda get, cfg, columns: registrations.build_dim_legacy(
            get("stg_deal_registration"), get("dim_account"), get("dim_contact"), get("int_people"), cfg, columns
        ),
    ),
    "dim_vartopia_deal_registration": Model(
        "gold",
        ("gold", "common", "vartopia", "deal_registration"),
        True,
        lambda get, cfg, columns: registrations.build_dim_portal(
            get("salesforce_vartopiadrs__registration__c"),
            get("stg_deal_registration"),
            get("dim_account"),
            get("int_people"),
            cfg,
            columns,
        ),
        build_folded=lambda get, cfg, fold: registrations.build_dim_portal(
            get("salesforce_vartopiadrs__registration__c"),
            get("stg_deal_registration"),
            get("dim_account"),
            get("int_people"),
            cfg,
            fold=fold,
        ),
        build_staged=lambda get, cfg, columns, stage: registrations.build_dim_portal(
            get("salesforce_vartopiadrs__registration__c"),
            get("stg_deal_registration"),
            get("dim_account"),
            get("int_people"),
            cfg,
            columns,
            stage=stage,
        ),
    ),
    "dim_unified_deal_registration": Model(
        "gold",
        ("gold", "common", "deal_registration", "unified"),
        True,
        lambda get, cfg, columns: registrations.build_dim_unified(
            get("dim_deal_registration"), get("dim_vartopia_deal_registration"), cfg, columns
        ),
    ),
    "dim_opportunity": Model(
        "gold",
        ("gold", "common", "dimension", "salesforce"),
        True,
        lambda get, cfg, columns: opportunities.build_dim_opportunity(
            get("opportunity"),
            get("opportunity_field_history"),
            get("dim_task"),
            get("dim_vc_value_proposition"),
            get("dim_address"),
            get("dim_account"),
            get("recordtype"),
            get("int_people"),
            cfg,
            columns,
        ),
    ),
    "dim_product": Model(
        "gold",
        ("gold", "common", "dimension", "salesforce"),
        True,
        lambda get, cfg, columns: products.build_dim_product(
            get("product2"), get("productsellingmodel"), get("productsellingmodeloption"), cfg, columns
        ),
    ),
    "dim_quote_unified": Model(
        "gold",
        ("gold", "common"),
        True,
        lambda get, cfg, columns: quotes.build_dim_quote(
            get("int_latest_quote"), get("sbqq__quote__c"), get("int_quote_lines"), get("recordtype"), cfg, columns
        ),
    ),
    "fct_quote_unified": Model(
        "gold",
        ("gold", "common"),
        True,
        lambda get, cfg, columns: quotes.build_fct_quote(
            get("int_latest_quote"), get("sbqq__quote__c"), get("int_quote_lines"), cfg, columns
        ),
    ),
}


def selected(only: Iterable[str] | None) -> list[str]:
    """Model names picked by name, tag or layer, in build order; all without a selection."""
    if only is None:
        return list(MODELS)
    wanted = set(only)
    return [n for n, m in MODELS.items() if wanted & {n, m.layer, *m.tags}]


# Raw inputs with strictly read times, and the staging models that read them.
STRICT_INPUTS = {
    "stg_deal_registration": ("deal_registration__c", contracts.legacy_staging),
    "stg_vartopia_deal_registration": ("salesforce_vartopiadrs__registration__c", contracts.portal_staging),
}


def build_folded(inputs: Mapping[str, DataFrame], name: str, fold: Fold, cfg: Config = Config()) -> DataFrame:
    """One model that is not stored, with the columns the fold shows and one value of all others, computed before its rows move."""

    def get(part: str) -> DataFrame:
        return build_models(inputs, cfg, only=[part])[part] if part in MODELS else inputs[part]

    built = MODELS[name].build_folded(get, cfg, fold)
    return built.select(*fold.shown, fold.name)


def set_aside(inputs: Mapping[str, DataFrame], cfg: Config = Config()) -> dict[str, DataFrame]:
    """The raw registrations with unreadable times, by the staging model that would fail on them."""
    return {name: set_aside_rows(inputs[raw], fields(cfg)) for name, (raw, fields) in STRICT_INPUTS.items()}


def _with_parts(columns: Mapping[str, Collection[str]]) -> dict[str, set[str]]:
    """The wanted columns, with those the unified registrations take from their parts."""
    out = {name: set(wanted) for name, wanted in columns.items()}
    unified = out.get("dim_unified_deal_registration", set())
    for part, own_id in registrations.UNIFIED_IDS.items():
        out[part] = out.get(part, set()) | {own_id if c == "registration_id" else c for c in unified}
    return out


def build_models(
    inputs: Mapping[str, DataFrame],
    cfg: Config = Config(),
    only: Iterable[str] | None = None,
    store: TableStore | None = None,
    columns: Mapping[str, Collection[str]] | None = None,
    watch: RowRuleWatch | None = None,
    keep: Callable[[str, DataFrame], DataFrame] | None = None,
    stages: Mapping[str, Stage] | None = None,
) -> dict[str, DataFrame]:
    """Build the selected models from raw inputs.

    With a store, every selected stored model replaces its table, and later models read that
    table back; stored models they need are read from their tables, and built only where there
    is none yet; gold tables are written with their declared types, and an input type that drifted fails under its
    column's name.  Without a store all results stay lazy.  Views are registered under their names
    when a store is given.

    ``columns`` names the columns wanted of some models, for results that are not stored.  ``watch`` gathers the outcome of row
    rules while tables are written.  ``keep`` may replace a model that is not stored by an equal frame, from which others are built.
    ``stages`` puts rows of some of these aside while they are built.
    """
    if columns is not None and store is not None:
        raise ValueError("stored models keep all their columns")
    wanted = selected(only)
    narrow = {} if columns is None else _with_parts(columns)
    built: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in MODELS:
            if name not in inputs:
                raise KeyError(f"input '{name}' is missing; given: {sorted(inputs)}")
            return inputs[name]
        if name not in built:
            model = MODELS[name]
            df = None
            if store is not None and model.stored and name not in wanted:
                df = store.read(name, model.layer)
            if df is None:
                if store is not None and model.stored:
                    with store.staging() as stage:
                        staged = stage is not None and model.build_staged is not None
                        df = model.build_staged(get, cfg, None, stage) if staged else model.build(get, cfg, narrow.get(name))
                        df = typed(df, contracts.published_types(df.columns, cfg)) if model.layer == "gold" else df
                        df = watch.attach(name, df) if watch is not None else df
                        df = store.rebuild(df, name, model.layer, bucket_by=model.bucket_by)
                    built[name] = df
                    return df
                stage = (stages or {}).get(name)
                staged = stage is not None and model.build_staged is not None
                df = model.build_staged(get, cfg, narrow.get(name), stage) if staged else model.build(get, cfg, narrow.get(name))
                if store is None:
                    df = keep(name, df) if keep is not None else df
                else:
                    df.createOrReplaceTempView(name)
                    if cfg.set_aside and name in STRICT_INPUTS:
                        raw, fields = STRICT_INPUTS[name]
                        store.rebuild(set_aside_rows(get(raw), fields(cfg)), f"{name}_unreadable", "set_aside")
            built[name] = df
        return built[name]

    return {name: get(name) for name in wanted}


def check_models(
    inputs: Mapping[str, DataFrame],
    models: Mapping[str, DataFrame],
    cfg: Config = Config(),
    rules: Sequence[Rule] | None = None,
    watch: RowRuleWatch | None = None,
) -> DataFrame:
    """Report on the declared checks over built models and their inputs; no job runs before the report is read.

    Row rules that ``watch`` saw while the models were written are taken from there, without reading the tables.
    """
    rules = all_rules(cfg) if rules is None else rules
    return evaluate(ChainMap(dict(models), inputs), rules, watch)


def check_inputs(
    inputs: Mapping[str, DataFrame],
    cfg: Config = Config(),
    rules: Sequence[Rule] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
    scratch: TableStore | None = None,
) -> DataFrame:
    """Report on checks over models that are not stored: only what the rules read is computed of each.

    ``keep`` computes a frame now and returns it as read back.  It is given the models that the report would compute more
    than once: those several passes read, and those another model is made of.  With ``scratch`` their rows may be put aside there meanwhile.
    """
    rules = all_rules(cfg) if rules is None else rules
    names = names_read(rules)
    repeated = _read_repeatedly(rules) if keep else set()
    with scratch.staging() if scratch is not None else nullcontext() as stage:
        models = build_models(
            inputs,
            cfg,
            only=set(names) & set(MODELS),
            columns=names,
            keep=lambda n, df: keep(df) if n in repeated and df.columns else df,
            stages=dict.fromkeys(repeated, stage) if stage is not None else None,
        )
    return check_models(inputs, models, cfg, rules)


def _read_repeatedly(rules: Sequence[Rule]) -> set[str]:
    """Models with joins or rankings of their own that a report on the rules would compute more than once."""
    reads = passes(rules)
    for part in registrations.UNIFIED_IDS:
        reads[part] += reads["dim_unified_deal_registration"]  # the unified registrations are read from their parts
    return {n for n, times in reads.items() if times > 1 and n in MODELS and MODELS[n].layer == "gold" and n not in UNIONS}


# Fixed value: models that only put others together, cheaper to read from their kept parts than to keep.
UNIONS = ("dim_unified_deal_registration",)


def lookup_sides(inputs: Mapping[str, DataFrame], cfg: Config = Config()) -> dict[str, Lookup]:
    """Every lookup the models make, by model and reference; the keys of their sides have to be unique."""
    built = build_models(inputs, cfg, only=["int_people", "stg_deal_registration"])
    people = built["int_people"]
    steps = {
        "dim_deal_registration": registrations.legacy_lookups(inputs["dim_account"], inputs["dim_contact"], people, cfg),
        "dim_vartopia_deal_registration": [
            registrations.legacy_presence(built["stg_deal_registration"]),
            *registrations.portal_lookups(inputs["dim_account"], people),
        ],
        "dim_opportunity": opportunities.opportunity_lookups(
            people, inputs["dim_address"], inputs["dim_account"], inputs["recordtype"]
        ),
        "dim_quote_unified": quotes.quote_lookups(inputs["recordtype"]),
        "dim_user": users.user_lookups(people, inputs["userrole"], inputs["profile"]),
    }
    return {f"{model}.{step.fk}": step for model, of_model in steps.items() for step in of_model}
