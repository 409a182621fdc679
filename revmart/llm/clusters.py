"""Centroid clustering of whole-number vectors, with Ptolemaic lower bounds.

Lloyd's rounds, exact to the last digit.  Distances are squared Euclidean; of equally near centroids the smaller number
wins; a new centroid is the componentwise floor of its vectors' mean; an empty one stays where it is.

1. Vectors become whole numbers and are stored once, with their distances to a few fixed pivots.  The
   pivots are far apart from each other in a fixed sample of ``SAMPLE`` vectors; they decide speed only.
2. A round sends the centroids and their pivot distances to the tasks (both bounded by ``k``, the components and the pivots).
   For a vector x, a centroid c and a pivot pair p, s, Ptolemy's inequality gives
   ``d(x, c) >= |d(x, p) d(c, s) - d(x, s) d(c, p)| / d(p, s)``.  The centroid of the smallest bound is measured first;
   another one is measured only if its bound does not exceed that.  Bounds are rounded down by far more
   than doubles can err, so that no nearer centroid and no tie is lost.
3. Every task adds its vectors up per cluster and component, without overflow, in one row of ``k * components`` numbers.  Beyond
   ``FEW_TASKS`` rows other tasks add these up first, so that no more than the root of their number reach the driver.
   Rounds end early where no centroid moves, as further ones would change nothing.

Seeds are the ``k`` vectors with the smallest digest of ``<seed>:<vec_id>``.

Defined cases: vectors that are null, hold a null or non-finite component, or do not have ``dim`` components are left out;
fewer vectors than ``k`` give fewer centroids; rows of equal digest (repeated ids) are taken as seeds by their components,
rows without an id after all others; repeated rows count as often as they occur; an empty table gives an empty result; other columns
are ignored, whatever their names.  Components saturate at 2**62, distances and their sums at 2**63 - 1.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import stored
from revmart.llm.vectors import TOP, exact, matrix, most, usable, whole_numbers

#: Vectors the pivots are chosen from, and how many are chosen.
SAMPLE = 64
PIVOTS = 6
#: Rows of sums that may go to the driver (some 8 kB each) without being added up before.
FEW_TASKS = 64
SUMS = "sums array<decimal(38,0)>"
#: Relative slack of a bound; doubles err by some 2**-50 of the products here.
SLACK = 2.0**-40


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to ``c``, as 64 bits or Python's numbers."""
    span = 2 * most(x, c)
    bits = 2 * span.bit_length() + max(x.shape[1], 1).bit_length()
    x, c = exact(bits, x, c)
    out = ((x - c) ** 2).sum(axis=1)
    return out if out.dtype == object else out.astype(np.int64)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, from exact squares."""
    if not len(centres):
        return np.zeros((len(x), 0))
    return np.sqrt(np.stack([squared(x, c).astype(float) for c in centres], axis=1))


@dataclass(frozen=True)
class Pivots:
    """Fixed points, the pairs of them that differ, and the distances within the pairs."""

    points: np.ndarray

    @property
    def pairs(self) -> list[tuple[int, int, float]]:
        gaps = distances(self.points, self.points)
        return [(p, s, float(gaps[p, s])) for p, s in combinations(range(len(self.points)), 2) if gaps[p, s] > 0]


def far_apart(points: np.ndarray, n: int) -> Pivots:
    """Up to ``n`` points, each as far as can be from those before it."""
    chosen = [0] if len(points) else []
    while chosen and len(chosen) < n:
        least = distances(points, points[chosen]).min(axis=1)
        if least.max() == 0:
            break
        chosen.append(int(least.argmax()))
    return Pivots(points[chosen])


def lower_bounds(to_pivots: np.ndarray, centroids_to_pivots: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Ptolemaic lower bounds of the distances (rows by centroids), rounded down."""
    bound = np.zeros((len(to_pivots), len(centroids_to_pivots)))
    for p, s, gap in pairs:
        one = np.outer(to_pivots[:, p], centroids_to_pivots[:, s])
        other = np.outer(to_pivots[:, s], centroids_to_pivots[:, p])
        np.maximum(bound, (np.abs(one - other) - SLACK * (one + other)) / (gap * (1 + SLACK)), out=bound)
    return bound


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and exact squared distance of every row's nearest centroid, and how many distances were measured."""
    bound = lower_bounds(to_pivots, distances(centroids, pivots.points), pivots.pairs)
    least = bound * bound * (1 - SLACK)
    cluster = least.argmin(axis=1)
    wide = most(x, centroids) >= 1 << 27
    best = np.zeros(len(x), object if wide else np.int64)
    for c in range(len(centroids)):
        rows = np.nonzero(cluster == c)[0]
        best[rows] = squared(x[rows], centroids[c])
    first, measured = cluster.copy(), len(x)
    for c in range(len(centroids)):
        rows = np.nonzero((first != c) & (least[:, c] <= best.astype(float) * (1 + SLACK)))[0]
        if not len(rows):
            continue
        found = squared(x[rows], centroids[c])
        better = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        best[rows[better]], cluster[rows[better]] = found[better], c
        measured += len(rows)
    return cluster, best, measured


def kept_vectors(vectors: DataFrame, dim: int, scale: int) -> DataFrame:
    """``vec_id, parts`` of the vectors that take part."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, flat, begins = usable(batch.column(1))
            rows = np.nonzero(lengths == dim)[0]
            parts = whole_numbers(flat[(begins[rows][:, None] + np.arange(dim)).ravel()], scale)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(rows) + 1) * dim, dim), pa.int32()), pa.array(parts))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], ["vec_id", "parts"])

    narrow = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return narrow.mapInArrow(run, f"vec_id {kind}, parts array<bigint>")


def with_pivot_distances(kept: DataFrame, pivots: Pivots, dim: int) -> DataFrame:
    kind = kept.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = distances(matrix(batch.column(1), dim), pivots.points)
            n = far.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, far.size + 1, n), pa.int32()), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["vec_id", "parts", "far"])

    return kept.mapInArrow(run, f"vec_id {kind}, parts array<bigint>, far array<double>")


def round_sums(table: DataFrame, centroids: np.ndarray, pivots: Pivots) -> tuple[np.ndarray, list[int], list[int]]:
    """Sums of the components of every cluster's vectors, their numbers, and their distances summed."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim + 1), object)
        counts = np.zeros(k, np.int64)
        for batch in batches:
            x = matrix(batch.column(0), dim)
            cluster, best, _ = nearest(x, _far(batch.column(1), pivots), centroids, pivots)
            wide = x.astype(object) if most(x) >= 1 << 40 else x
            for c in np.unique(cluster).tolist():
                rows = cluster == c
                counts[c] += rows.sum()
                sums[c, :dim] += wide[rows].sum(axis=0).astype(object)
                sums[c, dim] += sum(min(d, TOP) for d in best[rows].tolist())
        yield _sums_row(np.concatenate((counts.astype(object), sums.ravel())))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _added(row for batch in batches for row in batch.column(0).to_pylist())
        if total is not None:
            yield _sums_row(total)

    parts = table.select("parts", "far").mapInArrow(run, SUMS)
    tasks = parts.rdd.getNumPartitions()
    if tasks > FEW_TASKS:
        parts = parts.repartition(math.isqrt(tasks)).mapInArrow(add, SUMS)
    total = _added(r["sums"] for r in parts.collect())
    sums = total[k:].reshape(k, dim + 1)
    return sums[:, :dim], total[:k].tolist(), sums[:, dim].tolist()


def _sums_row(sums: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([[Decimal(int(v)) for v in sums]], pa.list_(pa.decimal128(38, 0)))], ["sums"])


def _added(rows: Iterable[list[Decimal]]) -> np.ndarray | None:
    total = None
    for row in rows:
        numbers = np.array([int(v) for v in row], object)
        total = numbers if total is None else total + numbers
    return total


def _far(column: pa.Array, pivots: Pivots) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(pivots.points))


def _seed_order(seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    return [digest.asc_nulls_last(), F.col("parts").asc()]


def cluster_vectors(vectors: DataFrame, k: int = 8, dim: int = 64, scale: int = 1024, rounds: int = 10, seed: int = 3) -> DataFrame:
    """Return ``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` for every vector of ``vectors`` (vec_id,
    embedding) that takes part; ``centroid`` holds the components of the vector's final centroid."""
    kept = stored(kept_vectors(vectors, dim, scale))
    first = kept.orderBy(*_seed_order(seed)).limit(max(k, SAMPLE)).collect()
    sample = np.array([r["parts"] for r in first], np.int64).reshape(len(first), dim)
    pivots = far_apart(sample, PIVOTS)
    table = stored(with_pivot_distances(kept, pivots, dim)) if len(first) else None
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance bigint"
    named = "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
    spark = vectors.sparkSession
    if table is None:
        return spark.createDataFrame([], f"{schema}, {named.split(', ', 1)[1]}")
    centroids = sample[:k]
    for _ in range(rounds):
        sums, counts, _ = round_sums(table, centroids, pivots)
        moved = np.array([[int(v) // n for v in row] if n else list(old) for row, n, old in zip(sums, counts, centroids)], np.int64)
        if (moved == centroids).all():
            break
        centroids = moved
    _, _, inertia = round_sums(table, centroids, pivots)
    total = min(sum(inertia), TOP)
    rows = [(c, min(inertia[c], TOP), total, centroids[c].tolist()) for c in range(len(centroids))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim)
            cluster, best, _ = nearest(x, _far(batch.column(2), pivots), centroids, pivots)
            distance = pa.array([min(d, TOP) for d in best.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), distance], ["vec_id", "cluster", "distance"])

    # One row per centroid.
    return table.mapInArrow(run, schema).join(F.broadcast(spark.createDataFrame(rows, named)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )


def clusters_sql(k: int = 8, dim: int = 64, scale: int = 1024, rounds: int = 10, seed: int = 3) -> str:
    """DuckDB SQL for the rows of :func:`cluster_vectors` over ``embeddings``, with the centroid as a digest."""
    squares = "list_sum(list_transform(list_zip(v.parts, c.parts), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS parts
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0)""",
        f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, parts) - 1 AS cluster, parts
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, parts FROM kept ORDER BY h NULLS LAST, parts LIMIT {k}))""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT v.r, min(({squares}, c.cluster)) AS best FROM kept v CROSS JOIN c{i} c GROUP BY v.r)"""
        )
        if i < rounds:
            steps.append(
                f"""s{i} AS MATERIALIZED (
  SELECT cluster, i, sum(x) AS total, count(*) AS n
  FROM (SELECT a.best[2] AS cluster, unnest(v.parts) AS x, generate_subscripts(v.parts, 1) AS i FROM a{i} a JOIN kept v USING (r))
  GROUP BY cluster, i)"""
            )
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.parts, c.parts) AS parts FROM c{i} c LEFT JOIN (
    SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS parts FROM s{i} GROUP BY cluster) m USING (cluster))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT v.vec_id, CAST(a.best[2] AS INTEGER) AS cluster, CAST(a.best[1] AS BIGINT) AS distance,
  CAST(sum(a.best[1]) OVER (PARTITION BY a.best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(a.best[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.parts, ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept v USING (r) JOIN c{rounds} c ON c.cluster = a.best[2]"""
    )


CLUSTERS_SQL = clusters_sql()
