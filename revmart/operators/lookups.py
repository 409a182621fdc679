"""Left-join enrichment: lookups, role-playing lookups, existence flags.

No job runs while joins are declared.  A side is marked for broadcast when its estimated size in memory, by the bytes of its files
and by the rows their Parquet footers tell, is within the session's ``spark.sql.autoBroadcastJoinThreshold``; other sides
are kept from being broadcast where the planner, who knows the bytes only, would do so.  What is left over are lookups into large sides.  A single one is an
ordinary join; several are unfolded where the caller names the row's key: the narrow rows (key, role, reference) are
shuffled once per lookup side, however many roles it plays, the values found are folded back to one narrow row per key,
and the wide row moves once, to meet them.  Keys spread evenly, missing references are not shuffled at all, and the partitions of
frequent references are split by adaptive execution while they hold narrow rows.  All ways give the same rows.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
#: Estimates are of compressed columnar files; in memory their rows take several times as much.
EXPANSION = 3
#: Bytes that a row takes in memory beside its columns, and a column of fixed and of other width; footers read of a frame at most.
ROW_BYTES, FIXED_BYTES, TEXT_BYTES = 8, 8, 32
FOOTERS = 64


class DuplicateLookupKeyError(Exception):
    """Raised when lookup keys that would multiply rows are found."""


@dataclass(frozen=True)
class Lookup:
    """Fetch ``attrs`` (lookup column -> alias) from ``dim`` where ``dim.pk`` equals ``fk``.

    ``sized_by`` names the frames ``dim`` was joined from; the planner multiplies the sizes
    of join inputs, so their sum is the better estimate for a key-preserving join.
    """

    dim: DataFrame
    fk: str
    pk: str
    attrs: Mapping[str, str]
    sized_by: Sequence[DataFrame] = ()


def broadcast_limit(df: DataFrame) -> int:
    """The session's broadcast threshold in bytes (-1 turns broadcasting off)."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * _UNITS[unit]


_SIZES: WeakKeyDictionary[DataFrame, dict[tuple[str, ...], int]] = WeakKeyDictionary()


def estimated_bytes(df: DataFrame, *columns: str) -> int:
    """The planner's size estimate of a frame or some of its columns; asked once, as every question optimizes a plan."""
    known = _SIZES.setdefault(df, {})
    if columns not in known:
        part = df.select(*columns) if columns else df
        known[columns] = int(str(part._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return known[columns]


_ROWS: WeakKeyDictionary[DataFrame, int | None] = WeakKeyDictionary()


def stored_rows(df: DataFrame) -> int | None:
    """Rows in the Parquet files below a frame, by their footers and without a job; None where files cannot tell.

    Well compressed files hold many more rows than their bytes suggest.  Of many files some are read, and the others taken to be alike.
    """
    if df not in _ROWS:
        files, jvm, conf = df.inputFiles(), df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        some = files[:: -(-len(files) // FOOTERS)] if files else []
        rows: int | None = 0
        for name in some:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
            try:
                reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, conf))
            except Py4JJavaError:  # no Parquet file
                rows = None
                break
            rows += reader.getRecordCount()
            reader.close()
        _ROWS[df] = rows * len(files) // len(some) if rows is not None and some else None
    return _ROWS[df]


def row_bytes(df: DataFrame, columns: Sequence[str] = ()) -> int:
    """What a row of a frame, or of some of its columns, takes in memory, about."""
    kinds = [f.dataType for f in df.schema if not columns or f.name in columns]
    return ROW_BYTES + sum(TEXT_BYTES if k.typeName() in ("string", "binary", "struct", "array", "map") else FIXED_BYTES for k in kinds)


def fits_broadcast(dim: DataFrame, columns: Sequence[str] = (), sized_by: Sequence[DataFrame] = (), times: int = 1) -> bool:
    """Whether the columns' estimated size in memory, held ``times`` over, is within the session's broadcast threshold.

    Both the bytes and the rows of the files below have to say so.
    """
    limit = broadcast_limit(dim)
    if limit <= 0:
        return False
    size = sum(estimated_bytes(f) for f in sized_by) if sized_by else estimated_bytes(dim, *columns)
    if times * EXPANSION * size > limit:
        return False
    rows = stored_rows(dim)
    return rows is None or times * rows * row_bytes(dim, columns) <= limit


def needed(lookups: Sequence[Lookup], columns: Collection[str] | None) -> list[Lookup]:
    """The lookups that find any of the wanted columns.

    The optimizer cannot drop the others' joins, since it does not know that they keep the number of rows.
    """
    return [s for s in lookups if columns is None or not set(columns).isdisjoint(s.attrs.values())]


def _guarded(side: DataFrame, key: str, step: Lookup) -> DataFrame:
    """Fail where a key occurs twice, counted where the join's own shuffle puts the key's rows."""
    text = F.concat(F.lit(f"{step.fk}: {step.pk} "), F.col(key).cast("string"), F.lit(" occurs more than once"))
    counted = side.where(F.col(key).isNotNull()).withColumn("_rows", F.count("*").over(Window.partitionBy(key)))
    return counted.where(F.when(F.col("_rows") > 1, F.raise_error(text).cast("boolean")).otherwise(True)).drop("_rows")


@dataclass(frozen=True)
class _Side:
    """Lookups into one frame by one key, whether the frame is to be broadcast, and whether the planner would do so by itself."""

    steps: tuple[Lookup, ...]
    small: bool
    tempting: bool = False

    def frame(self, key: str, columns: Mapping[str, str], guard: bool) -> DataFrame:
        step = self.steps[0]
        side = step.dim.select(F.col(step.pk).alias(key), *[F.col(a).alias(b) for a, b in columns.items()])
        side = _guarded(side, key, step) if guard else side
        return F.broadcast(side) if self.small else side.hint("merge") if self.tempting else side


def _sides(df: DataFrame, lookups: Sequence[Lookup]) -> list[_Side]:
    groups: dict[tuple, list[Lookup]] = {}
    for step in lookups:
        groups.setdefault((id(step.dim), step.pk, df.schema[step.fk].dataType), []).append(step)
    out = []
    for steps in groups.values():
        read = sorted({steps[0].pk, *[a for s in steps for a in s.attrs]})
        small = fits_broadcast(steps[0].dim, read, steps[0].sized_by)
        tempting = not small and estimated_bytes(steps[0].dim, *read) <= broadcast_limit(df)
        out.append(_Side(tuple(steps), small, tempting))
    return out


def enrich(
    df: DataFrame, lookups: Sequence[Lookup], row_key: Sequence[str] = (), guard: bool = False, in_place: bool = False
) -> DataFrame:
    """Left-join every lookup; the row count never changes for unique lookup keys.

    ``row_key`` names columns that tell the rows apart, or nearly so: they decide where rows go, while rows that share a key
    keep their own references.  ``in_place`` says that no row key is NULL: what is found comes to rows that lie by it.
    ``guard`` fails the query when a lookup key that would multiply rows occurs.
    """
    out, names = df, list(df.columns)
    waiting = list(lookups)
    while waiting:
        # A lookup may start from what another one found.
        ready = [s for s in waiting if s.fk in out.columns]
        if not ready:
            raise KeyError(f"no column {sorted({s.fk for s in waiting})} to look up from")
        waiting = [s for s in waiting if s not in ready]
        sides = _sides(out, ready)
        large = [side for side in sides if not side.small]
        if row_key and sum(len(side.steps) for side in large) > 1:
            out = _unfolded(out, large, row_key, guard, in_place)
            sides = [side for side in sides if side.small]
        for side in sides:
            for i, step in enumerate(side.steps):
                key = f"_lookup_key_{i}"
                out = out.join(side.frame(key, step.attrs, guard), F.col(step.fk) == F.col(key), "left").drop(key)
    return out.select(*names, *[b for s in lookups for b in s.attrs.values() if b not in names])


def _unfolded(df: DataFrame, sides: Sequence[_Side], row_key: Sequence[str], guard: bool, in_place: bool) -> DataFrame:
    """All lookups of ``sides`` with one shuffle of ``df``; each row of a repeated lookup key gives a row, as a join does."""
    steps = [s for side in sides for s in side.steps]
    number = {id(s): i for i, s in enumerate(steps)}
    fks = sorted({s.fk for s in steps})
    # Rows of one key with other references are told apart by the mark; NULLs by their places, as hashes skip them.
    marked = [F.col(c) for c in fks] + [F.col(c).isNull() for c in [*row_key, *fks]]
    place = {f"_row_{i}": F.col(c) if in_place else F.coalesce(F.col(c).cast("string"), F.lit("")) for i, c in enumerate(row_key)}
    lie_by = list(place)
    place["_row_mark"] = F.xxhash64(*marked)
    keys = list(place)
    narrow = df.select(*[c.alias(n) for n, c in place.items()], *fks).distinct()
    found = []
    for side in sides:
        roles = F.array(*[F.struct(F.lit(number[id(s)]).alias("_role"), F.col(s.fk).alias("_reference")) for s in side.steps])
        asked = narrow.select(*keys, F.inline(roles)).where(F.col("_reference").isNotNull())
        attrs = {a: f"_attr_{a}" for s in side.steps for a in s.attrs}
        matched = asked.join(side.frame("_lookup_key", attrs, guard), F.col("_reference") == F.col("_lookup_key"))
        values = [
            F.when(F.col("_role") == number[id(s)], F.struct(*[F.col(f"_attr_{a}").alias(b) for a, b in s.attrs.items()])).alias(
                f"_found_{number[id(s)]}"
            )
            for s in side.steps
        ]
        found.append(matched.select(*keys, *values))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found)
    if in_place:
        together = together.repartition(*lie_by)
    folded = together.groupBy(*keys).agg(*[F.collect_list(f"_found_{i}").alias(f"_found_{i}") for i in range(len(steps))])
    for i in range(len(steps)):
        folded = folded.withColumn(f"_found_{i}", F.explode_outer(f"_found_{i}"))
    named = [F.col(f"_found_{i}")[b].alias(b) for i, s in enumerate(steps) for b in s.attrs.values()]
    placed = df.select("*", *[c.alias(n) for n, c in place.items()])
    # A hash join leaves the wide rows unsorted; what it holds is a partition's narrow rows.
    if not in_place:
        return placed.join(folded.select(*keys, *named).hint("shuffle_hash"), keys, "left").drop(*keys)
    # Rows lie by the row key alone, so the marks are compared beside it: as a key of the join they would move the rows.
    values = folded.select(*[F.col(n).alias(f"_found{n}") for n in keys], *named).hint("shuffle_hash")
    same_key = reduce(Column.__and__, [F.col(n) == F.col(f"_found{n}") for n in lie_by])
    same_mark = F.col("_row_mark").bitwiseXOR(F.col("_found_row_mark")) == 0
    return placed.join(values, same_key & same_mark, "left").drop(*keys, *[f"_found{n}" for n in keys])


def lookup_keys(lookups: Mapping[str, Lookup]) -> DataFrame:
    """``lookup, key`` of the non-NULL keys of every lookup side."""
    return reduce(
        DataFrame.unionAll,
        [
            step.dim.where(F.col(step.pk).isNotNull()).select(F.lit(name).alias("lookup"), F.col(step.pk).cast("string").alias("key"))
            for name, step in lookups.items()
        ],
    )


def duplicated_lookup_keys(lookups: Mapping[str, Lookup]) -> DataFrame:
    """``lookup, key, n_rows`` of the lookup keys that would multiply rows, in one shuffle; empty for sound lookups."""
    return duplicate_keys(lookup_keys(lookups), "lookup", "key")


def check_lookup_keys(lookups: Mapping[str, Lookup]) -> None:
    """Raise when a lookup key would multiply rows. Reads a few of them."""
    found = duplicated_lookup_keys(lookups).limit(20).collect()
    if found:
        raise DuplicateLookupKeyError("; ".join(sorted(f"{r.lookup}: {r.key} ({r.n_rows} rows)" for r in found)))


def presence(keys: DataFrame, key: str, fk: str, alias: str) -> Lookup:
    """A lookup giving TRUE where ``fk`` occurs among the values of ``keys.key``, else NULL."""
    present = keys.where(F.col(key).isNotNull()).select(key).distinct().withColumn(alias, F.lit(True))
    return Lookup(present, fk, key, {alias: alias})


def exists_flag(df: DataFrame, keys: DataFrame, fk: str, key: str, flag: str) -> DataFrame:
    """Add ``flag``: whether ``fk`` occurs among the non-NULL values of ``keys.key``."""
    out = enrich(df, [presence(keys, key, fk, flag)])
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Key combinations that occur more than once, with their counts."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def value_map(c: Column, pairs: Mapping[str, Column | str | int]) -> Column:
    """Look a value up in a constant map held in the plan; unknown values give NULL."""
    entries = reduce(lambda acc, kv: acc + [F.lit(kv[0]), F.lit(kv[1])], pairs.items(), [])
    return F.try_element_at(F.create_map(*entries), c)
