"""Hard-negative mining, with bounds along a spanning tree of the anchors.

Vectors become whole numbers; a row's score is its inner product with the anchor, higher first, ties by the smaller
``vec_id``.  An anchor's positives are its best ``positives`` rows of the same label; for each of them the best ``negatives``
rows of other labels are returned whose score lies between ``low`` and ``high`` hundredths of the positive's.

1. Anchors are dealt into blocks of about ``ANCHORS``, all rows into blocks of about ``ROWS``; a task meets one block of each.
   A row travels once per block of anchors; no pairs are emitted, only the best few rows per anchor and block.
2. In a task the anchors are joined by a minimum spanning tree.  The root's scores are computed; from a parent anchor p to
   its child c, ``score(c, x)`` lies within ``|c - p| * |x|`` of ``score(p, x)`` (or of its bounds), rounded outwards.
3. First the positives: only rows of the same label whose upper bound reaches the last place's best lower bound are
   scored.  They are merged per anchor.  Then the negatives: only rows whose bounds overlap the window of
   a positive, and reach the lower bound of the last place among rows surely inside, are scored.  Scores are exact, so results are
   the same as without bounds.

Defined cases: rows with a null label, a null vector or a null or non-finite component take no part; rows of one id,
label and vector are one row, rows that differ in any of them are different rows, ties of one id by label and vector; a row
without an id is never an anchor and comes last among ties; vectors meet only vectors of as many components, those without
any score 0; negative positives have no window, one of score 0 has the window 0; anchors with fewer rows return what there is; an empty table
gives an empty result; other columns are ignored, whatever their names.  Components saturate at 2**62, scores in the result at 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import stored
from revmart.llm.vectors import TOP, exact, matrix, most, usable, whole_numbers

ANCHORS = 1024
ROWS = 4096
#: Relative slack of a bound, far above what doubles can err.
SLACK = 1e-9


def participants(vectors: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, dim, parts`` of the rows that take part."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, flat, begins = usable(batch.column(2))
            rows = np.nonzero(lengths >= 0)[0]
            ends = np.cumsum(lengths[rows])
            at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[rows] - ends + lengths[rows], lengths[rows])
            offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
            parts = pa.ListArray.from_arrays(offsets, pa.array(whole_numbers(flat[at], scale)))
            take = pa.array(rows)
            arrays = [batch.column(0).take(take), batch.column(1).take(take), pa.array(lengths[rows], pa.int32()), parts]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "dim", "parts"])

    narrow = vectors.where("label IS NOT NULL AND embedding IS NOT NULL").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")
    )
    return narrow.mapInArrow(run, f"vec_id {kinds[0]}, label {kinds[1]}, dim int, parts array<bigint>")


def spanning_tree(anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the anchors, the parent of each (-1 for the root), and the length of the edge to it, rounded up."""
    n = len(anchors)
    x = anchors.astype(float)
    norms = (x * x).sum(axis=1)
    near = np.full(n, np.inf)
    parent = np.full(n, -1)
    order = np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    now = 0
    for i in range(n):
        order[i], open_[now] = now, False
        far = np.maximum(norms + norms[now] - 2 * (x @ x[now]), 0)
        closer = open_ & (far < near)
        near[closer], parent[closer] = far[closer], now
        if i + 1 < n:
            now = int(np.where(open_, near, np.inf).argmin()) if np.isfinite(near[open_]).any() else int(np.nonzero(open_)[0][0])
    edges = np.array([0.0 if p < 0 else float(np.sqrt(((x[i] - x[p]) ** 2).sum())) for i, p in enumerate(parent)])
    return order, parent, edges * (1 + SLACK)


class Block:
    """Scores of a block of rows, computed on demand, and their bounds for one anchor after another of the tree."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray) -> None:
        bits = 2 * max(most(anchors), most(rows)).bit_length() + max(anchors.shape[1], 1).bit_length()
        self.anchors, self.rows = exact(bits, anchors, rows)
        self.order, self.parent, self.edges = spanning_tree(anchors)
        self.norms = np.sqrt((rows.astype(float) ** 2).sum(axis=1)) * (1 + SLACK)
        self.scored = 0

    def scores(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        """Exact scores."""
        self.scored += len(rows)
        return self.rows[rows] @ self.anchors[anchor]

    def __iter__(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Anchors with lower and upper bounds of all rows; who scores rows writes the scores into both."""
        children = np.bincount(self.parent[self.parent >= 0], minlength=len(self.order))
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        everything = np.arange(len(self.rows))
        for anchor in self.order.tolist():
            p = int(self.parent[anchor])
            if p < 0:
                lower = self.scores(anchor, everything).astype(float)
                # Doubles hold scores beyond 2**53 only nearly.
                slack = SLACK * np.abs(lower) * (self.rows.dtype != float)
                lower, upper = lower - slack, lower + slack
            else:
                step = self.edges[anchor] * self.norms
                lower, upper = known[p]
                slack = SLACK * (step + np.maximum(np.abs(lower), np.abs(upper)))
                lower, upper = lower - step - slack, upper + step + slack
                children[p] -= 1
                if not children[p]:
                    del known[p]
            yield anchor, lower, upper
            if children[anchor]:
                known[anchor] = lower, upper

    def settle(self, anchor: int, rows: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Score ``rows`` and tighten their bounds."""
        found = self.scores(anchor, rows)
        near = found.astype(float)
        slack = SLACK * np.abs(near) * (self.rows.dtype != float)
        lower[rows], upper[rows] = near - slack, near + slack
        return found


def _floor(column: np.ndarray, place: int) -> float:
    """The ``place``-th largest number, or minus infinity."""
    return float(np.partition(column, len(column) - place)[len(column) - place]) if len(column) >= place else -np.inf


def _first(found: np.ndarray, rank: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` best of ``found``, ties by the smaller ``rank``."""
    if found.dtype == object:
        return np.array(sorted(range(len(found)), key=lambda i: (-found[i], rank[i]))[:n], np.int64)
    return np.lexsort((rank, -found))[:n]


def best_positives(block: Block, labels: np.ndarray, nodes: np.ndarray, own: np.ndarray, own_labels: np.ndarray, n: int) -> list[tuple]:
    """(anchor, row, score) of the best rows of each anchor's label; ``nodes`` order ties."""
    out = []
    for anchor, lower, upper in block:
        rows = np.nonzero((labels == own_labels[anchor]) & (nodes != own[anchor]))[0]
        rows = rows[upper[rows] >= _floor(lower[rows], n)]
        found = block.settle(anchor, rows, lower, upper)
        out += [(anchor, int(rows[i]), found[i]) for i in _first(found, nodes[rows], n).tolist()]
    return out


def best_negatives(
    block: Block, labels: np.ndarray, nodes: np.ndarray, own_labels: np.ndarray, windows: list[list[tuple[int, int]]], n: int
) -> list[tuple]:
    """(anchor, number of the window, row, score) of the best rows of other labels within each window."""
    out = []
    for anchor, lower, upper in block:
        wanted = windows[anchor]
        other = labels != own_labels[anchor]
        overlapping = []
        for least, largest in wanted:
            rows = np.nonzero(other & (upper >= least) & (lower <= largest))[0]
            sure = rows[(lower[rows] >= least) & (upper[rows] <= largest)]
            overlapping.append(rows[upper[rows] >= _floor(lower[sure], n)])
        rows = np.unique(np.concatenate(overlapping)) if overlapping else np.zeros(0, np.int64)
        found = block.settle(anchor, rows, lower, upper)
        for number, (least, largest) in enumerate(wanted):
            inside = np.nonzero((found >= least) & (found <= largest))[0]
            best = inside[_first(found[inside], nodes[rows[inside]], n)]
            out += [(anchor, number, int(rows[i]), found[i]) for i in best.tolist()]
    return out


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest whole score between ``low`` and ``high`` hundredths of ``score``."""
    return -(-score * low // 100), score * high // 100


def _sides(group: pa.Table) -> tuple[pa.Table, pa.Table]:
    side = group.column("side").to_numpy()
    group = group.combine_chunks()
    return group.filter(pa.array(side == 0)), group.filter(pa.array(side == 1))


def _matrix(table: pa.Table) -> np.ndarray:
    dim = table.column("dim")[0].as_py()
    parts = table.column("parts").combine_chunks()
    return matrix(parts, dim) if dim else np.zeros((len(table), 0), np.int64)


def _clipped(values: list) -> pa.Array:
    return pa.array([max(-TOP - 1, min(TOP, int(v))) for v in values], pa.int64())


def _taken(table: pa.Table, rows: list[int], *names: str) -> list[pa.Array]:
    at = pa.array(rows, pa.int64())
    return [table.column(n).combine_chunks().take(at) for n in names]


def mine_negatives(
    vectors: DataFrame,
    anchors: str = "vec_id % 50 = 0",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """Return ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vectors`` (vec_id, label,
    embedding); ``anchors`` is the condition (on vec_id and label) that makes a row an anchor."""
    id_kind = vectors.schema["vec_id"].dataType.simpleString()
    rows = participants(vectors, scale).groupBy("vec_id", "label", "dim", "parts").agg(F.expr(f"coalesce({anchors}, false)").alias("anchor"))
    # The place in this order settles ties: ids first, then label and vector; rows without an id come last.
    rows = stored(rows.orderBy(F.col("vec_id").asc_nulls_last(), "label", "parts").withColumn("node", F.monotonically_increasing_id()))
    rows = rows.withColumn("anchor", F.col("anchor") & F.col("vec_id").isNotNull())
    counts = rows.groupBy("dim").agg(
        F.ceil(F.count("*") / ROWS).cast("int").alias("row_blocks"), F.ceil(F.count_if("anchor") / ANCHORS).cast("int").alias("anchor_blocks")
    )
    counts = stored(counts.where("anchor_blocks > 0"))
    dealt = rows.join(counts, "dim")

    def block(count: str) -> F.Column:
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    def every(count: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    narrow = ["dim", "vec_id", "label", "node", "parts"]
    meeting = [F.col("dim"), F.col("anchor_block"), F.col("row_block")]
    side_rows = dealt.withColumn("row_block", block("row_blocks")).withColumn("anchor_block", every("anchor_blocks"))
    side_anchors = dealt.where("anchor").withColumn("anchor_block", block("anchor_blocks")).withColumn("row_block", every("row_blocks"))
    empty = F.array().cast("array<decimal(38,0)>")

    def meet(anchor_side: DataFrame) -> DataFrame:
        left = anchor_side.select(*meeting, *narrow[1:], F.lit(0).alias("side"), "sought")
        right = side_rows.select(*meeting, *narrow[1:], F.lit(1).alias("side"), empty.alias("sought"))
        return left.unionAll(right)

    def find_positives(group: pa.Table) -> pa.Table:
        own, other = _sides(group)
        found = []
        if len(own) and len(other):
            labels = [t.column("label").to_numpy() for t in (own, other)]
            nodes = [t.column("node").to_numpy() for t in (own, other)]
            found = best_positives(Block(_matrix(own), _matrix(other)), labels[1], nodes[1], nodes[0], labels[0], positives)
        arrays = _taken(own, [f[0] for f in found], "node") + _taken(other, [f[1] for f in found], "node", "vec_id")
        exactly = pa.array([int(f[2]) for f in found], pa.decimal128(38, 0))
        return pa.Table.from_arrays([*arrays, exactly], ["anchor", "positive", "positive_id", "score"])

    schema = f"anchor bigint, positive bigint, positive_id {id_kind}, score decimal(38,0)"
    near = meet(side_anchors.withColumn("sought", empty)).groupBy("dim", "anchor_block", "row_block").applyInArrow(find_positives, schema)
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive")
    near = stored(near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives))

    def find_negatives(group: pa.Table) -> pa.Table:
        own, other = _sides(group)
        found, windows = [], []
        if len(own) and len(other):
            windows = [[window(int(s), low, high) for s in sought] for sought in own.column("sought").to_pylist()]
            labels = [t.column("label").to_numpy() for t in (own, other)]
            found = best_negatives(
                Block(_matrix(own), _matrix(other)), labels[1], other.column("node").to_numpy(), labels[0], windows, negatives
            )
        arrays = _taken(own, [f[0] for f in found], "node") + [pa.array([f[1] + 1 for f in found], pa.int32())]
        arrays += _taken(other, [f[2] for f in found], "node", "vec_id")
        exactly = pa.array([int(f[3]) for f in found], pa.decimal128(38, 0))
        return pa.Table.from_arrays([*arrays, exactly], ["anchor", "place", "negative", "negative_id", "negative_score"])

    # At most ``positives`` scores an anchor.
    sought = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("sought"))
    sought = sought.select(F.col("anchor").alias("of"), F.transform("sought", lambda s: s["score"]).alias("sought"))
    schema = f"anchor bigint, place int, negative bigint, negative_id {id_kind}, negative_score decimal(38,0)"
    asked = side_anchors.join(sought, F.col("node") == F.col("of"))
    far = meet(asked).groupBy("dim", "anchor_block", "row_block").applyInArrow(find_negatives, schema)
    best = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    names = rows.where("anchor").select(F.col("node").alias("anchor"), F.col("vec_id").alias("anchor_id"))

    def clipped(name: str) -> F.Column:
        return F.least(F.greatest(F.col(name), F.lit(-TOP - 1).cast("decimal(38,0)")), F.lit(TOP).cast("decimal(38,0)")).cast("bigint")

    return (
        far.join(near.select("anchor", "place", "positive_id", "score"), ["anchor", "place"])
        .join(names, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            clipped("score").alias("positive_score"),
            clipped("negative_score").alias("negative_score"),
        )
    )


#: DuckDB SQL for the rows of the query: labels of every seventh id moved on by one, then the default parameters.
NEGATIVES_SQL = """
WITH part AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
rows AS (SELECT DISTINCT vec_id, label, parts FROM part),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id AS vec_id, r.label AS label,
    CAST(list_inner_product(a.parts, r.parts) AS BIGINT) AS score
  FROM rows a JOIN rows r ON len(a.parts) = len(r.parts) AND a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negative AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND s.label <> s.anchor_label
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 3
"""
