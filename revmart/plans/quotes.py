"""Quote dimension and fact: two quote systems under one contract."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.config import Config
from revmart.functions.columns import blank_to_null, is_true, positive_amount, surrogate_key
from revmart.operators.conform import narrowed, project
from revmart.operators.lookups import Lookup, enrich, needed
from revmart.operators.rollups import line_rollup
from revmart.operators.unions import union_sources
from revmart.operators.versions import current, latest_per_key, live
from revmart.plans import contracts
from revmart.plans.reference import any_record_types

# The precisions at which refresh amounts are read; published amounts keep the wide one.
WIDE_AMOUNT = "decimal(33,15)"
NARROW_AMOUNT = "decimal(30,4)"


def latest_quotes(quote: DataFrame, cfg: Config) -> DataFrame:
    """Newest live version of every first-system quote; both quote models start here."""
    return latest_per_key(live(quote), "quote_id", ("system_modstamp", "created_date"), cfg.quote_tie)


def live_cpq(cpq: DataFrame) -> DataFrame:
    return live(current(cpq))


def measure(df: DataFrame, name: str) -> Column:
    """A money column; text is read as a decimal and unreadable text is NULL."""
    is_text = df.schema[name].dataType.simpleString() == "string"
    return F.col(name).try_cast(WIDE_AMOUNT) if is_text else F.col(name)


def unread_amounts(quote: DataFrame, name: str = "gross_refresh_acv") -> DataFrame:
    """The texts of a money column that are no amounts, with the number of rows that have them."""
    given = quote.select(blank_to_null(name).alias("text"))
    unread = given.where(F.col("text").isNotNull() & F.col("text").try_cast(WIDE_AMOUNT).isNull())
    return unread.groupBy("text").agg(F.count("*").alias("n_rows"))


def rca_flags() -> dict[str, Column]:
    return {
        "is_migrated_quote": blank_to_null("legacy_quote_id").isNotNull(),
        "is_refresh_quote": is_true("refresh_quote") | positive_amount("gross_refresh_acv", WIDE_AMOUNT),
        "refresh_quote_flag": is_true("refresh_quote"),
    }


def cpq_flags(amount_type: str) -> dict[str, Column]:
    return {
        "is_migrated_quote": F.lit(False),
        "is_refresh_quote": is_true("refresh_quote") | positive_amount("refresh_acv", amount_type),
        "refresh_quote_flag": F.col("refresh_quote"),
    }


def _header(
    df: DataFrame, contract: list[str], names: Mapping[str, str], absent: tuple[str, ...], computed: dict[str, Column]
) -> DataFrame:
    """The contract's columns this system has, under shared names."""
    picked = []
    for name in contract:
        if name in computed:
            picked.append(computed[name].alias(name))
        elif name in contracts.QUOTE_COMPUTED or name in absent:
            continue
        else:
            raw = names.get(name, name)
            picked.append((measure(df, raw) if name in _MEASURES else F.col(raw)).alias(name))
    return df.select(*picked)


def _contract(text: str) -> list[str]:
    return text.split()


_MEASURES = frozenset(_contract(contracts.QUOTE_FACT)[_contract(contracts.QUOTE_FACT).index("acv") :])


def quote_lookups(recordtype: DataFrame) -> list[Lookup]:
    """Record type of a quote, retired ones too."""
    return [Lookup(any_record_types(recordtype), "record_type_id", "record_type_id", {"record_type_name": "record_type_name"})]


def build_dim_quote(
    quotes: DataFrame,
    cpq: DataFrame,
    lines: DataFrame,
    recordtype: DataFrame,
    cfg: Config,
    columns: Collection[str] | None = None,
) -> DataFrame:
    """``quotes`` are the latest versions, ``lines`` the per-quote rollup."""
    contract = _contract(contracts.QUOTE_DIMENSION)
    is_counted = columns is None or "quote_line_count" in columns
    counted = quotes.join(lines.select("quote_id", "line_count"), "quote_id", "left") if is_counted else quotes
    rca = _header(
        counted,
        contract,
        contracts.RCA_QUOTE_NAMES,
        ("discount_justification",),
        rca_flags() | {"quote_line_count": F.coalesce(F.col("line_count") if is_counted else F.lit(None), F.lit(0))},
    )
    second = live_cpq(cpq)
    cpq_side = _header(
        second,
        contract,
        contracts.CPQ_QUOTE_NAMES,
        contracts.CPQ_MISSING,
        cpq_flags(WIDE_AMOUNT) | {"quote_line_count": F.col(contracts.CPQ_QUOTE_NAMES["quote_line_count"])},
    )
    both = union_sources({"RCA": rca, "CPQ": cpq_side})
    named = enrich(both, needed(quote_lookups(recordtype), columns), guard=cfg.guard_lookups)
    fields = narrowed(contracts.published(contracts.QUOTE_DIMENSION, cfg), columns)
    return project(named, fields, {"quote_unified_sk": surrogate_key("source_system", "quote_id")})


def build_fct_quote(
    quotes: DataFrame, cpq: DataFrame, lines: DataFrame, cfg: Config, columns: Collection[str] | None = None
) -> DataFrame:
    """``quotes`` are the latest versions, ``lines`` the per-quote rollup."""
    contract = _contract(contracts.QUOTE_FACT)
    rca = _header(quotes, contract, contracts.RCA_QUOTE_NAMES, (), rca_flags())
    zeros = {name: F.lit(0).cast(WIDE_AMOUNT) for name in contracts.CPQ_ZERO_MEASURES}
    cpq_side = _header(
        live_cpq(cpq), contract, contracts.CPQ_QUOTE_NAMES, contracts.CPQ_MISSING, cpq_flags(NARROW_AMOUNT) | zeros
    )
    both = union_sources({"RCA": rca, "CPQ": cpq_side})
    computed = {"quote_unified_sk": surrogate_key("source_system", "quote_id")}
    if columns is None or "has_refresh_quote_line" in columns:
        both = both.join(lines.select("quote_id", "any_refresh_line"), "quote_id", "left")
        computed["has_refresh_quote_line"] = is_true("any_refresh_line")
    return project(both, narrowed(contracts.published(contracts.QUOTE_FACT, cfg), columns), computed)


def quote_lines(lines: DataFrame) -> DataFrame:
    """Per-quote rollup shared by both quote models."""
    return line_rollup(lines)
