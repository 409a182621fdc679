"""Embedding near-duplicates: tiles compared in PCA order, with bounds from suffix norms.

Vectors are compared only within a label (and number of components), by cosine in double precision.

1. Equal vectors are grouped; each different vector is compared once, with its number of copies as weight.
2. The second moments of all unit vectors give principal directions (a matrix of components squared, the only thing
   that comes to the driver).  Unit vectors with cosine ``t`` or more are at most ``sqrt(2 - 2 t)`` apart, so
   they lie in the same or neighbouring cells of that width along each of the leading directions.  As many directions
   make cells as have a spread of at least that width, at least one and at most three.
3. Cells are dealt into tiles of about ``TILE`` rows; one task compares two tiles.  It sums the products of the
   leading directions first; what the rest can add is at most the product of the norms of both suffixes.  Pairs that
   cannot reach the threshold are given up, the few others go on; those left at the end are checked with the vectors as
   they were given.
4. A task returns per row its number of links and one link to its root within the task, never all pairs; the roots
   are joined to components.

The result is exact.  The tile pairs of one cell grow with the square of its rows where the leading directions do not
spread the vectors.

Defined cases: vectors that are null, zero, empty or hold null or non-finite components, or whose label is null, link
with nothing; copies link with each other, repeated rows too; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revmart.llm.components import connected_components
from revmart.operators.lineage import cut_lineage

TILE = 1024
#: Components per step of a comparison.
STEP = 8
#: How far below the threshold a sum in another order of the components may lie.
SLACK = 1e-9
MOST_CELL_DIRECTIONS = 3


def _vector(values: list | None) -> np.ndarray | None:
    """The vector if it can be compared: finite, not zero, without nulls."""
    if not values or any(v is None for v in values):
        return None
    v = np.array(values, float)
    return v if np.isfinite(v).all() and v.any() and np.isfinite(v @ v) and v @ v > 0 else None


def _keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, dim, key, embedding``; key is a digest of the vector, null if it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_vector(v) for v in batch.column(2).to_pylist()]
            keys = [None if v is None else hashlib.md5((v + 0.0).tobytes()).digest() for v in found]
            arrays = [
                batch.column(0),
                batch.column(1),
                pa.array([0 if v is None else len(v) for v in found], pa.int32()),
                pa.array(keys, pa.binary()),
                pa.array([None if v is None else v.tolist() for v in found], pa.list_(pa.float64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "dim", "key", "embedding"])

    kinds = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]
    narrow = vectors.select("vec_id", "label", "embedding")
    return narrow.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, dim int, key binary, embedding array<double>")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim)


def principal_directions(distinct: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per number of components: directions (columns, widest spread first) and spreads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                x = _matrix(batch.column(1).filter(pa.array(dims == dim)), dim)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                n, first, second = sums.get(dim, (0, 0.0, 0.0))
                sums[dim] = (n + len(x), first + x.sum(axis=0), second + x.T @ x)
        columns = [list(c) for c in zip(*[(d, n, a.tolist(), b.ravel().tolist()) for d, (n, a, b) in sums.items()])]
        kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        arrays = [pa.array(c, k) for c, k in zip(columns or [[]] * 4, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["dim", "n", "first", "second"])

    sums = distinct.select("dim", "embedding").mapInArrow(run, "dim int, n long, first array<double>, second array<double>")
    pos = sums.select("dim", "n", F.posexplode(F.concat("first", "second")).alias("i", "v"))
    total = pos.groupBy("dim", "i").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    out = {}
    for row in total.groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("i", "v", "n"))).alias("x")).toLocalIterator():
        dim, values, n = row["dim"], np.array([x["v"] for x in row["x"]]), row["x"][0]["n"]
        mean, second = values[:dim] / n, values[dim:].reshape(dim, dim) / n
        spread, directions = np.linalg.eigh(second - np.outer(mean, mean))
        out[dim] = directions[:, ::-1], np.sqrt(np.maximum(spread[::-1], 0))
    return out


def tile_links(x: np.ndarray, y: np.ndarray, directions: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of ``x`` and ``y`` with cosine at or above ``threshold``; of one tile with itself i < j."""
    norm_x, norm_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    a, b = x / norm_x[:, None] @ directions, y / norm_y[:, None] @ directions
    rest = lambda u: np.sqrt(np.cumsum((u * u)[:, ::-1], axis=1)[:, ::-1])
    rest_a, rest_b = rest(a), rest(b)
    dim = a.shape[1]
    step = min(STEP, dim)
    sums = a[:, :step] @ b[:, :step].T
    bound = sums + np.outer(rest_a[:, step], rest_b[:, step]) if step < dim else sums
    i, j = np.nonzero(bound >= threshold - SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    kept = sums[i, j]
    while step < dim and len(i):
        end = min(step + STEP, dim)
        kept = kept + np.einsum("ij,ij->i", a[i, step:end], b[j, step:end])
        open_ = kept + (rest_a[i, end] * rest_b[j, end] if end < dim else 0.0) >= threshold - SLACK
        i, j, kept, step = i[open_], j[open_], kept[open_], end
    exact = np.einsum("ij,ij->i", x[i], y[j]) / (norm_x[i] * norm_y[j]) >= threshold
    return i[exact], j[exact]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` indices by the pairs."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(group: pd.DataFrame, directions: dict[int, tuple[np.ndarray, np.ndarray]], threshold: float) -> pd.DataFrame:
    group = group.sort_values(["side", "node"])
    same = bool(group["same"].iloc[0])
    vectors = np.stack(group["embedding"].to_numpy())
    split = len(group) if same else int((group["side"] == 0).sum())
    x, y, offset = (vectors, vectors, 0) if same else (vectors[:split], vectors[split:], split)
    nodes, weights = group["node"].to_numpy(), group["copies"].to_numpy()
    if not len(x) or not len(y):
        return pd.DataFrame({"node": nodes[:0], "links": weights[:0], "root": nodes[:0]})
    i, j = tile_links(x, y, directions[x.shape[1]][0], threshold, same)
    j = j + offset
    links = np.bincount(i, weights[j], len(nodes)) + np.bincount(j, weights[i], len(nodes))
    root = _roots(len(nodes), i, j)
    hit = links > 0
    return pd.DataFrame({"node": nodes[hit], "links": links[hit].astype(np.int64), "root": nodes[root[hit]]})


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Return ``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (vec_id, embedding, label)."""
    rows = _keyed(vectors)
    comparable = rows.where("key IS NOT NULL AND label IS NOT NULL")
    distinct = comparable.groupBy("label", "key").agg(
        F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("embedding").alias("embedding")
    )
    distinct = cut_lineage(distinct.withColumn("node", F.monotonically_increasing_id()))
    directions = principal_directions(distinct)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    used = {d: min(MOST_CELL_DIRECTIONS, d, max(1, int((s >= reach).sum()))) for d, (_, s) in directions.items()}
    most = max(used.values(), default=1)
    cells = [f"c{k}" for k in range(most)]

    def cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            at = np.zeros((len(dims), most), np.int32)
            for dim in np.unique(dims):
                x = _matrix(batch.column(2).filter(pa.array(dims == dim)), dim)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                at[dims == dim, : used[dim]] = np.floor(x @ directions[dim][0][:, : used[dim]] / reach)
            arrays = [batch.column(1), *[pa.array(at[:, k]) for k in range(most)]]
            yield pa.RecordBatch.from_arrays(arrays, ["node", *cells])

    placed = distinct.select("dim", "node", "embedding").mapInArrow(cell, "node long, " + ", ".join(f"{c} int" for c in cells))
    placed = cut_lineage(placed)
    block = ["label", "dim", *cells]
    located = distinct.join(placed, "node")
    counts = located.groupBy(*block).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    counts = cut_lineage(counts)
    # Of each two neighbouring cells one finds the other: offsets that are not before zero.
    ahead = [o for o in product((-1, 0, 1), repeat=most) if o >= (0,) * most]
    offsets = F.array(*[F.array(*[F.lit(v) for v in o]) for o in ahead])
    one = counts.withColumn("o", F.explode(offsets)).withColumnRenamed("tiles", "tiles_a")
    other = counts.withColumnRenamed("tiles", "tiles_b")
    beside = one.select("label", "dim", "tiles_a", *cells, *[(F.col(c) + F.col("o")[k]).alias(f"to_{c}") for k, c in enumerate(cells)])
    other = other.select("label", "dim", "tiles_b", *[F.col(c).alias(f"to_{c}") for c in cells])
    pairs = beside.join(other, ["label", "dim", *[f"to_{c}" for c in cells]])
    is_own = F.lit(True)
    for c in cells:
        is_own = is_own & (F.col(c) == F.col(f"to_{c}"))
    tasks = (
        pairs.withColumn("own", is_own)
        .withColumn("ta", F.explode(F.sequence(F.lit(0), F.col("tiles_a") - 1)))
        .withColumn("tb", F.explode(F.sequence(F.when(F.col("own"), F.col("ta")).otherwise(0), F.col("tiles_b") - 1)))
        .withColumn("same", F.col("own") & (F.col("ta") == F.col("tb")))
        .withColumn("task", F.monotonically_increasing_id())
    )
    tasks = cut_lineage(tasks)
    side_a = tasks.select("label", "dim", *cells, F.col("ta").alias("tile"), "task", "same", F.lit(0).alias("side"))
    side_b = tasks.where("NOT same").select(
        "label", "dim", *[F.col(f"to_{c}").alias(c) for c in cells], F.col("tb").alias("tile"), "task", "same", F.lit(1).alias("side")
    )
    tiled = located.join(counts, block).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = tiled.join(side_a.union(side_b), [*block, "tile"]).select("task", "side", "same", "node", "copies", "embedding")
    compare = lambda group: _compare(group, directions, threshold)
    found = cut_lineage(dealt.groupBy("task").applyInPandas(compare, "node long, links long, root long"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    nodes = (
        distinct.select("label", "key", "first_id", "copies", "node")
        .join(linked, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    named = nodes.groupBy("root").agg(F.min("first_id").alias("component"))
    known = nodes.join(named, "root").select(
        F.col("label").alias("_label"),
        F.col("key").alias("_key"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        "component",
    )
    out = rows.join(known, (F.col("label") == F.col("_label")) & (F.col("key") == F.col("_key")), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
