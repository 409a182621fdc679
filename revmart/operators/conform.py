"""Conforming projections: rename, trim, parse and normalise raw columns in one select."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from revmart.functions.columns import timestamp_of, truthy


class Fold(NamedTuple):
    """Published columns that are handed on only as one value ``name``, by ``value`` of them in the order of their names.

    Where a builder computes it of the conformed row, the columns themselves need not move with the row.
    """

    shown: Sequence[str]
    name: str
    value: Callable[[Sequence[Column]], Column]


class Field(NamedTuple):
    """A published column, the raw column it comes from and how its value is conformed."""

    name: str
    source: str
    kind: str = "keep"


def parse_fields(text: str, default_source: Callable[[str, str], str] | None = None) -> list[Field]:
    """Read a field list: ``name``, ``name:kind`` or ``name:kind<source`` separated by blanks."""
    fields = []
    for token in text.split():
        head, _, source = token.partition("<")
        name, _, kind = head.partition(":")
        kind = kind or "keep"
        if not source:
            source = default_source(name, kind) if default_source else name
        fields.append(Field(name, source, kind))
    return fields


def _renamed(name: str, source: str) -> Column | str:
    return name if name == source else F.col(source).alias(name)


def conform(df: DataFrame, fields: Iterable[Field], lenient_times: bool = False) -> DataFrame:
    """Project raw columns to their published names, conforming values by field kind."""
    by_kind = {"flag": truthy, "time": lambda c: timestamp_of(c, lenient_times), "text": F.trim}
    return df.select(
        *[
            by_kind[f.kind](F.col(f.source)).alias(f.name) if f.kind in by_kind else _renamed(f.name, f.source)
            for f in fields
        ]
    )


def unparsed_times(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """Count, per time column, the values that are present but unreadable (one pass)."""
    times = [f for f in fields if f.kind == "time"]
    counts = df.agg(
        *[
            F.count_if(F.col(f.source).isNotNull() & F.col(f.source).try_cast("timestamp").isNull()).alias(f.name)
            for f in times
        ]
    )
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("unparsed")) for f in times])
    return counts.select(F.inline(rows))


def unreadable(fields: Iterable[Field]) -> Column:
    """The times of a raw row that are present but unreadable: ``column_name, value`` of each, in order."""
    found = [
        F.when(
            F.col(f.source).isNotNull() & F.col(f.source).try_cast("timestamp").isNull(),
            F.struct(F.lit(f.name).alias("column_name"), F.col(f.source).cast("string").alias("value")),
        )
        for f in fields
        if f.kind == "time"
    ]
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.array()


def readable_rows(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """The raw rows whose times can all be read."""
    return df.where(F.size(unreadable(fields)) == 0)


def set_aside_rows(df: DataFrame, fields: Iterable[Field]) -> DataFrame:
    """The other raw rows as they are, with ``unreadable_values``: which columns cannot be read, and what they hold."""
    return df.select("*", unreadable(fields).alias("unreadable_values")).where(F.size("unreadable_values") > 0)


def set_aside_counts(aside: DataFrame) -> DataFrame:
    """``column_name, value, n_rows`` of what could not be read."""
    return aside.select(F.inline("unreadable_values")).groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))


def typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The frame with the declared types; a column of a type that does not fit fails under its name.

    Types that hold every value of the column's own are widened to; nothing is parsed, cut or rounded.
    """
    fields = [StructField(f.name, _parse_type(types[f.name]) if f.name in types else f.dataType) for f in df.schema]
    return df.to(StructType(fields))


def _parse_type(text: str) -> DataType:
    return StructType.fromDDL(f"x {text}")[0].dataType


def narrowed(fields: Iterable[Field], columns: Collection[str] | None) -> list[Field]:
    """The fields of the wanted columns; all of them without a choice."""
    return [f for f in fields if columns is None or f.name in columns]


def folded(df: DataFrame, fields: Iterable[Field], computed: Mapping[str, Column], fold: Fold) -> DataFrame:
    """The frame with the value of the fold beside its columns; what is folded is a rename or one of ``computed``."""
    rest = {f.name: computed.get(f.name, F.col(f.source)) for f in fields if f.name not in fold.shown}
    return df.withColumn(fold.name, fold.value([rest[name] for name in sorted(rest)]))


def project(df: DataFrame, fields: Iterable[Field], computed: Mapping[str, Column]) -> DataFrame:
    """Select the published columns in order; ``computed`` supplies those that are not renames."""
    return df.select(
        *[computed[f.name].alias(f.name) if f.name in computed else _renamed(f.name, f.source) for f in fields]
    )
