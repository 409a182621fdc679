"""Declarative data checks, evaluated with as few passes over the data as possible.

All row rules of a model share one aggregate pass, or are counted while its table is written; all referential rules
of all models share one pre-aggregating shuffle, and so do all unique keys.  The report has one row per rule.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

NOT_NULL = "not_null"
ACCEPTED_VALUES = "accepted_values"
EXPRESSION = "expression_is_true"
UNIQUE = "unique"
UNIQUE_COMBINATION = "unique_combination_of_columns"
RELATIONSHIP = "relationships"
ROW_COUNT = "row_count_reconciliation"

_ROW_KINDS = (NOT_NULL, ACCEPTED_VALUES, EXPRESSION)
_UNIQUE_KINDS = (UNIQUE, UNIQUE_COMBINATION)


@dataclass(frozen=True)
class Rule:
    """One check on one model.

    ``expression`` is a full row predicate; a NULL outcome passes.  ``parent`` is the
    ``(model, column)`` a reference must exist in, ``parts`` the models whose row counts
    must add up, ``where`` a filter applied before the check.
    """

    model: str
    kind: str
    columns: tuple[str, ...] = ()
    expression: str | None = None
    values: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None
    parts: tuple[str, ...] = ()
    where: str | None = None
    severity: str = "error"
    dimension: str | None = None
    cadence: str | None = None

    @property
    def label(self) -> str:
        subject = ",".join(self.columns) or self.expression or "+".join(self.parts)
        return f"{self.kind}({subject})"


_META = "check_id int, model_name string, rule_name string, kind string, severity string, dimension string, cadence string"


def _unfold(counts: DataFrame, numbers: Sequence[int]) -> DataFrame:
    """Turn one row holding a failure count ``c<number>`` per rule into rows."""
    pairs = ", ".join(f"{n}, CAST(coalesce(c{n}, 0) AS BIGINT)" for n in numbers)
    return counts.selectExpr(f"stack({len(numbers)}, {pairs}) AS (check_id, failures)")


def _violation(rule: Rule) -> str:
    """Row predicate that is TRUE exactly where the rule fails."""
    if rule.kind == NOT_NULL:
        bad = f"{rule.columns[0]} IS NULL"
    elif rule.kind == ACCEPTED_VALUES:
        allowed = ", ".join(f"'{v}'" for v in rule.values)
        bad = f"CAST({rule.columns[0]} AS STRING) NOT IN ({allowed})"
    else:
        bad = f"NOT ({rule.expression})"
    return bad if rule.where is None else f"({bad}) AND ({rule.where})"


def check_rows(df: DataFrame, rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """Failing rows per row rule, all rules in one aggregate pass."""
    counts = df.agg(*[F.expr(f"count_if({_violation(r)})").alias(f"c{n}") for n, r in rules])
    return _unfold(counts, [n for n, _ in rules])


def _together(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _by_model(rules: Sequence[tuple[int, Rule]]) -> list[tuple[str, list[tuple[int, Rule]]]]:
    order = sorted(rules, key=lambda nr: nr[1].model)
    return [(model, list(group)) for model, group in groupby(order, key=lambda nr: nr[1].model)]


def _key_of(rule: Rule, value: Column) -> Column:
    return value if rule.where is None else F.when(F.expr(rule.where), value)


def check_unique(models: Mapping[str, DataFrame], rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """Keys that occur more than once; a single key column ignores NULL.

    Every row is unfolded into its keys, so all keys of all models are counted in one scan a model and one shuffle.
    """

    def key(number: int, rule: Rule) -> Column:
        parts = F.array(*[F.col(c).cast("string") for c in rule.columns])
        if rule.kind == UNIQUE:
            parts = F.when(F.col(rule.columns[0]).isNotNull(), parts)
        return F.struct(F.lit(number).alias("rule"), _key_of(rule, parts).alias("key"))

    unfolded = [models[m].select(F.inline(F.array(*[key(n, r) for n, r in of_model]))) for m, of_model in _by_model(rules)]
    counts = _together(unfolded).where(F.col("key").isNotNull()).groupBy("rule", "key").agg(F.count("*").alias("n"))
    repeated = [F.count_if((F.col("rule") == n) & (F.col("n") > 1)).alias(f"c{n}") for n, _ in rules]
    return _unfold(counts.agg(*repeated), [n for n, _ in rules])


def check_references(models: Mapping[str, DataFrame], rules: Sequence[tuple[int, Rule]]) -> DataFrame:
    """Rows whose non-NULL reference has no parent, for all references of all models at once.

    Every row is unfolded into the references it holds and the keys it supplies.  They are counted per parent and value,
    so each model is scanned once and one shuffle brings references and keys together: a value held by a large share of
    the rows travels as one row per task.
    """
    parents = {r.parent: f"{r.parent[0]}.{r.parent[1]}" for _, r in rules}
    entries: dict[str, list[Column]] = {}

    def enter(model: str, parent: str, key: Column, rule: Column) -> None:
        entry = F.struct(F.lit(parent).alias("parent"), key.alias("key"), rule.cast("int").alias("rule"))
        entries.setdefault(model, []).append(entry)

    for n, r in rules:
        enter(r.model, parents[r.parent], _key_of(r, F.col(r.columns[0]).cast("string")), F.lit(n))
    for (model, column), name in parents.items():
        enter(model, name, F.col(column).cast("string"), F.lit(None))
    unfolded = _together([models[m].select(F.inline(F.array(*of_model))) for m, of_model in sorted(entries.items())])
    counted = (
        unfolded.where(F.col("key").isNotNull())
        .groupBy("parent", "key")
        .agg(F.count_if(F.col("rule").isNull()).alias("known"), *[F.count_if(F.col("rule") == n).alias(f"c{n}") for n, _ in rules])
    )
    orphans = counted.where(F.col("known") == 0)
    return _unfold(orphans.agg(*[F.sum(f"c{n}").alias(f"c{n}") for n, _ in rules]), [n for n, _ in rules])


def check_row_count(models: Mapping[str, DataFrame], number: int, rule: Rule) -> DataFrame:
    """One failure when the model's row count differs from the sum over its parts."""
    signed = [(rule.model, 1)] + [(part, -1) for part in rule.parts]
    total = _together([models[name].agg((F.count("*") * sign).alias("n")) for name, sign in signed]).agg(F.sum("n").alias("n"))
    return _unfold(total.select((F.col("n") != 0).cast("bigint").alias(f"c{number}")), [number])


def names_read(rules: Iterable[Rule]) -> dict[str, set[str]]:
    """Per model the names its rules use, on it, on it as a parent or on it as a part."""
    names: dict[str, set[str]] = {}
    for rule in rules:
        names.setdefault(rule.model, set()).update({*rule.columns, *re.findall(r"\w+", f"{rule.expression} {rule.where}")})
        if rule.parent:
            names.setdefault(rule.parent[0], set()).add(rule.parent[1])
        for part in rule.parts:
            names.setdefault(part, set())
    return names


def passes(rules: Iterable[Rule]) -> Counter[str]:
    """How often a report reads each model: once for its row rules, references, keys and every count."""
    read = set()
    for n, rule in enumerate(rules):
        kind = "row" if rule.kind in _ROW_KINDS else "unique" if rule.kind in _UNIQUE_KINDS else (rule.kind, n if rule.kind == ROW_COUNT else 0)
        read |= {(kind, model) for model in (rule.model, *rule.parts, *([rule.parent[0]] if rule.parent else []))}
    return Counter(model for _, model in read)


class RowRuleWatch:
    """Row rules evaluated while tables are written, by metrics that Spark gathers on the way.

    Attach a model's frame before it is written; after the write the failures are there without another scan.
    """

    def __init__(self, rules: Iterable[Rule]) -> None:
        self.rules = [r for r in rules if r.kind in _ROW_KINDS]
        self._seen: dict[str, tuple[list[Rule], Observation]] = {}

    def attach(self, model: str, df: DataFrame) -> DataFrame:
        """The frame, with its rows' failures counted as they pass."""
        rules = [r for r in self.rules if r.model == model]
        if not rules:
            return df
        observation = Observation()
        self._seen[model] = rules, observation
        return df.observe(observation, *[F.expr(f"count_if({_violation(r)})").alias(f"c{i}") for i, r in enumerate(rules)])

    def failures(self, rule: Rule) -> int | None:
        """Failures of a rule, None where its model was not written under watch."""
        rules, observation = self._seen.get(rule.model, ([], None))
        return observation.get[f"c{rules.index(rule)}"] if rule in rules else None


def evaluate(models: Mapping[str, DataFrame], rules: Iterable[Rule], watch: RowRuleWatch | None = None) -> DataFrame:
    """Evaluate rules against the models they name; one report row per rule.

    A model is read once for its row rules (unless ``watch`` has seen them), once for all references and once for all keys.
    """
    numbered = list(enumerate(rules, start=1))
    missing = sorted(set(names_read(r for _, r in numbered)) - set(models))
    if missing:
        raise KeyError(f"models needed by the rules are missing: {missing}")

    seen = {n: watch.failures(r) for n, r in numbered} if watch is not None else {}
    seen = {n: failures for n, failures in seen.items() if failures is not None}
    row_rules = [(n, r) for n, r in numbered if r.kind in _ROW_KINDS and n not in seen]
    references = [(n, r) for n, r in numbered if r.kind == RELATIONSHIP]
    unique = [(n, r) for n, r in numbered if r.kind in _UNIQUE_KINDS]
    reports = [check_rows(models[model], of_model) for model, of_model in _by_model(row_rules)]
    reports += [check_references(models, references)] if references else []
    reports += [check_unique(models, unique)] if unique else []
    reports += [check_row_count(models, n, r) for n, r in numbered if r.kind == ROW_COUNT]
    spark = models[numbered[0][1].model].sparkSession
    reports += [spark.createDataFrame(list(seen.items()), "check_id int, failures bigint")] if seen else []
    described = spark.createDataFrame(
        [(n, r.model, r.label, r.kind, r.severity, r.dimension, r.cadence) for n, r in numbered], _META
    )
    # One row per rule on both sides.
    report = F.broadcast(described).join(_together(reports), "check_id")
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise(F.col("severity")))


def scorecard(report: DataFrame) -> DataFrame:
    """Rules and outcomes per quality dimension."""
    return report.groupBy(F.coalesce("dimension", F.lit("none")).alias("dimension")).agg(
        F.count("*").alias("rules"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
        F.count_if(F.col("status") == "error").alias("failed"),
        F.sum("failures").alias("failures"),
    )


class DataCheckError(Exception):
    """Raised when a rule of severity ``error`` fails."""


def enforce(report: DataFrame) -> None:
    """Raise when a rule of severity ``error`` fails. Reads at most one row per rule."""
    failed = report.where(F.col("status") == "error").orderBy("check_id").collect()
    if failed:
        lines = [f"{r.model_name}: {r.rule_name} ({r.failures})" for r in failed]
        raise DataCheckError(f"{len(failed)} checks failed\n" + "\n".join(lines))
