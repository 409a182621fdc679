"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words.  A document's expected number of copies is its source's
target over its source's size: the whole part is taken for certain, the rest is a probability of inclusion.
For that rest, documents are ranked by ``(u / (1 - u)) / (p / (1 - p))`` with ``u`` a keyed random number and
``p`` the probability, and the first ones are taken until the source's remaining words are used up.

Where the ranking stops is found without sorting a source: word counts are summed in 4096 slices of the
ranking, then in 4096 slices of the slice in which the target lies; only the rows of that slice of a slice
(one in 16 million of a source) are ranked one by one.

Defined cases: a null text has size 0; a null source is a source of its own, ranked last; a row without ``doc_id`` draws by
its text; rows with equal ``doc_id``, or equal texts and none, share a random number and are ordered by size; equal rows are
taken equally often; an empty table gives an empty result; a table without any word takes no words (targets 0); other
columns come back as they are, whatever their names, but a column ``mix``, which :func:`mix_sources` replaces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmart.llm.common import text_of, word_count
from revmart.operators.lineage import cut_lineage

SLICES = 4096
#: Sources whose plan (some 100 bytes each) may be broadcast.
BROADCAST_SOURCES = 10_000


def draw_key() -> Column:
    """What a document's random number depends on: its id, or its text where it has none."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("~"), F.md5(text_of().cast("binary"))))


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the key and the seed alone (48 bits of an MD5 digest)."""
    digest = F.md5(F.concat(F.lit(seed + ":"), key).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """Per source: place, size and target words.

    ``share`` of all words is dealt out by weight; a target stops at ``cap`` times its source's size and the
    excess goes to the others by weight until none is above.  Sources that are filled first are those with the
    smallest cap for their weight, so one ordered pass finds them.  One row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    dealt = F.array(*[F.lit(w) for w in weights])
    placed = (
        per_source.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(dealt, (F.col("place") % len(weights)).cast("int") + 1))
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    filling = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onwards = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    filled = (
        placed.withColumn("left_words", left)
        .withColumn("left_weight", F.sum("weight").over(onwards))
        .withColumn("is_full", F.col("most") * F.col("left_weight") <= F.col("weight") * F.col("left_words"))
    )
    # The first source that is not full sets the level for all that are not.
    level = F.min(F.when(~F.col("is_full"), F.struct(F.col("most") / F.col("weight"), "place", "left_words", "left_weight")))
    levelled = filled.withColumn("level", level.over(everything))
    rate = F.col("level.left_words") / F.col("level.left_weight")
    target = F.when(F.col("is_full"), F.col("most")).otherwise(F.col("weight") * rate)
    return levelled.select("source", "place", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _crossing(sums: DataFrame, slice_col: str) -> DataFrame:
    """Per place: the first slice that ends beyond the words wanted, and the words before it."""
    running = Window.partitionBy("place").orderBy(slice_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("words").over(running) + F.col("base")
    return (
        sums.withColumn("end", end)
        .where(F.col("end") > F.col("wanted"))
        .groupBy("place")
        .agg(F.min(F.struct(F.col(slice_col).alias("slice"), (F.col("end") - F.col("words")).alias("before"))).alias("x"))
        .select("place", F.col("x.slice").alias(f"cut_{slice_col}"), F.col("x.before").alias("base"))
    )


def _if_few(per_source: DataFrame) -> DataFrame:
    """A stored table with at most a row per source, marked for broadcast if the rows are few."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_SOURCES else per_source


def _ranked(docs: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """``docs`` (source, size, key and others) with their source's plan, rank among the drawn, and slices of the ranking.

    The plan has a row per source; it is broadcast if these are few, else Spark chooses the join.
    """
    side = _if_few(plan)
    u = uniform(F.col("key"), seed)
    odds = (u / (1 - u)) / (F.col("_mix.p") / (1 - F.col("_mix.p")))
    joined = docs.join(side, F.col("source").eqNullSafe(F.col("_mix.source")), "inner")
    rank = F.col("_q") / (1 + F.col("_q"))
    return (
        joined.withColumn("_q", F.when(F.col("_mix.p") > 0, odds))
        .withColumn("_s1", F.floor(rank * SLICES).cast("int"))
        .withColumn("_s2", F.floor((rank * SLICES - F.col("_s1")) * SLICES).cast("int"))
    )


def _narrow() -> list[Column]:
    """What the mix reads of a document."""
    return [F.col("source").cast("string").alias("source"), word_count().alias("size"), draw_key().alias("key")]


def mixing_plan(docs: DataFrame, weights: Sequence[int], share: float, cap: float, seed: str) -> DataFrame:
    """One row per source, column ``_mix``: its targets, certain copies, probability, and where its ranking stops."""
    sizes = cut_lineage(docs.select(*_narrow()))
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = cut_lineage(
        source_targets(sizes, weights, share, cap)
        .withColumn("whole", F.floor(factor).cast("long"))
        .withColumn("p", factor - F.floor(factor))
        .withColumn("wanted", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    drawn = (
        _ranked(sizes, targets.select(F.struct("*").alias("_mix")), seed)
        .where("_mix.p > 0")
        .select("key", "size", "_mix.place", "_mix.wanted", F.col("_q").alias("q"), F.col("_s1").alias("s1"), F.col("_s2").alias("s2"))
    )
    first = drawn.groupBy("place", "s1").agg(
        F.sum("size").alias("words"), F.first("wanted").alias("wanted"), F.lit(0).cast("long").alias("base")
    )
    cut1 = cut_lineage(_crossing(first, "s1"))
    in_first = drawn.join(_if_few(cut1), "place").where("s1 = cut_s1")
    second = in_first.groupBy("place", "s2").agg(
        F.sum("size").alias("words"), F.first("wanted").alias("wanted"), F.first("base").alias("base")
    )
    cut2 = cut_lineage(_crossing(second, "s2"))
    in_order = Window.partitionBy("place").orderBy("q", "key", "size")
    before = F.coalesce(F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = (
        in_first.drop("base")
        .join(_if_few(cut2), "place")
        .where("s2 = cut_s2")
        .withColumn("inside", F.col("base") + before + F.col("size") / 2 <= F.col("wanted"))
        .where("inside")
        .groupBy("place")
        .agg(F.max(F.struct("q", "key", "size")).alias("last"))
    )
    cuts = cut1.drop("base").join(cut2.drop("base"), "place", "left").join(last, "place", "left")
    return cut_lineage(targets.join(cuts, "place", "left").select(F.struct("*").alias("_mix")))


def _mixed(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """``row``, a structure of the columns of ``docs``, and ``mix``."""
    plan = mixing_plan(docs, weights, share, cap, seed)
    ranked = _ranked(docs.select(F.struct(*docs.columns).alias("row"), *_narrow()), plan, seed)
    s1, s2 = F.col("_mix.cut_s1"), F.col("_mix.cut_s2")
    own = F.struct(F.col("_q").alias("q"), F.col("key"), F.col("size"))
    ahead = (
        s1.isNull()
        | (F.col("_s1") < s1)
        | ((F.col("_s1") == s1) & (s2.isNull() | (F.col("_s2") < s2)))
        | ((F.col("_s1") == s1) & (F.col("_s2") == s2) & (own <= F.col("_mix.last")))
    )
    extra = F.when((F.col("_mix.p") > 0) & F.coalesce(ahead, F.lit(False)), 1).otherwise(0)
    copies = F.col("_mix.whole") + extra
    mix = F.struct(
        F.col("size"),
        F.col("_mix.source_size").alias("source_size"),
        F.col("_mix.target").alias("target"),
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
    return ranked.select("row", mix.alias("mix"))


def mix_sources(docs: DataFrame, **settings) -> DataFrame:
    """Every column of ``docs`` and ``mix``: a structure of ``size, source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document, ``taken`` its words times copies.  The texts are not shuffled
    unless there are more sources than may be broadcast.  Settings: ``weights, share, cap, seed``.
    """
    return _mixed(docs, **settings).select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "mix"], "mix")


def repeated(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them."""
    times = F.explode(F.array_repeat(F.lit(0), F.col("mix.copies").cast("int"))).alias("time")
    return _mixed(docs, **settings).select("row", times).select(*[F.col("row")[c].alias(c) for c in docs.columns])


#: The query's rows in DuckDB SQL: weights 5, 2, 1, share 1.5, cap 2, seed "mix".
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    coalesce(CAST(doc_id AS VARCHAR), '~' || md5(coalesce(text, ''))) AS key
  FROM documents
), per_source AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, 2.0::DOUBLE * source_size AS most,
    1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM per_source
), weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM placed
), filled AS (
  SELECT *, total - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_words,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM weighed
), marked AS (
  SELECT *, most * left_weight <= weight * left_words AS is_full FROM filled
), lev AS (
  SELECT left_words / left_weight AS rate FROM marked WHERE NOT is_full ORDER BY most / weight, place LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * (SELECT rate FROM lev) END AS target FROM marked
), factors AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS factor FROM targets
), parts AS (
  SELECT *, CAST(floor(factor) AS BIGINT) AS whole, factor - floor(factor) AS p, target - floor(factor) * source_size AS wanted FROM factors
), drawn AS (
  SELECT s.doc_id, s.key, s.size, t.*, (CAST(('0x' || substr(md5('mix:' || s.key), 1, 12)) AS BIGINT) + 0.5::DOUBLE) / 281474976710656 AS u
  FROM sizes s JOIN parts t ON s.source IS NOT DISTINCT FROM t.source
), ranked AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (p / (1 - p)), key, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM drawn
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST((whole + CASE WHEN p > 0 AND before + size / 2.0::DOUBLE <= wanted THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM ranked
"""
