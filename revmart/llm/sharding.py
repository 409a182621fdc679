"""Sharding by vector bin packing: bytes, tokens and rows of the shards are balanced together.

The things to place are groups of rows with equal text.  Groups above ``1 / HEAVY`` of a total are placed one by
one; all other groups are gathered into ``BUNDLES`` bundles by a digest of their text, so a bundle holds whole groups.
At most ``BUNDLES + 3 * HEAVY`` things remain, whatever the size of the table; the driver places them, largest
first, each into the shard where the dot product of its vector with the shard's residual capacity is highest.
Rows find their shard by a join with that bounded list.

A group larger than a shard's even share cannot stay whole in near equal shards; it alone is split, by a hash of
``doc_id``, into pieces of at most an eighth of the share.

Defined cases: a null text counts as the empty text (size 1, the separator); rows with equal ``doc_id`` are separate
rows; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revmart.llm.common import text_of, word_count
from revmart.operators.lineage import cut_lineage

BUNDLES = 4096
HEAVY = 1024
#: Parts into which a thing's rows are divided for numbering, so that no task numbers a whole group.
NUMBERED_IN = 64


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every vector: greedy by the highest dot product with the residual capacity.

    Each measure is scaled to one total capacity per shard; equal products go to the lowest shard.
    """
    totals = np.maximum(vectors.sum(axis=0), 1.0)
    scaled = vectors / totals * shards
    residual = np.ones((shards, vectors.shape[1]))
    out = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -scaled.max(axis=1))):
        out[i] = np.argmax(residual @ scaled[i])
        residual[out[i]] -= scaled[i]
    return out


def shard_rows(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Return ``doc_id, size, tokens, text_crc32, shard, slot`` for every row of ``docs``."""
    spark = docs.sparkSession
    text = text_of()
    digest = F.md5(text.cast("binary"))
    rows = cut_lineage(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            word_count().alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.substring(digest, 1, 16).alias("g1"),
            F.substring(digest, 17, 16).alias("g2"),
            F.pmod(F.xxhash64(digest), F.lit(BUNDLES)).cast("int").alias("bundle"),
        )
    )
    measures = [F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    total = rows.agg(*measures).first()
    sums = [int(total[c] or 0) for c in ("bytes", "tokens", "rows")]
    is_heavy = F.greatest(*[F.col(c) * HEAVY / max(n, 1) for c, n in zip(("bytes", "tokens", "rows"), sums)]) > 1
    share = F.greatest(*[F.col(c) * shards / max(n, 1) for c, n in zip(("bytes", "tokens", "rows"), sums)])
    heavy = cut_lineage(
        rows.groupBy("g1", "g2")
        .agg(*measures)
        .where(is_heavy)
        .select("g1", "g2", F.when(share > 1, F.ceil(share * 8)).otherwise(1).cast("int").alias("pieces"))
    )
    piece = F.when(F.col("pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).cast("int")
    own = F.col("pieces").isNotNull()
    things = (
        rows.join(F.broadcast(heavy), ["g1", "g2"], "left")  # at most 3 * HEAVY rows
        .withColumn("piece", piece)
        .withColumn("g1", F.when(own, F.col("g1")).otherwise(""))
        .withColumn("g2", F.when(own, F.col("g2")).otherwise(""))
        .withColumn("bundle", F.when(own, -1).otherwise(F.col("bundle")))
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("slot")), F.lit(NUMBERED_IN)).cast("int"))
    )
    things = cut_lineage(things.drop("pieces"))
    thing = ["bundle", "g1", "g2", "piece"]
    found = things.groupBy(*thing).agg(*measures).orderBy(*thing).collect()  # bounded: see the module's text
    vectors = np.array([[r["bytes"], r["tokens"], r["rows"]] for r in found], dtype=float).reshape(-1, 3)
    placed = [(*[r[c] for c in thing], int(s)) for r, s in zip(found, place(vectors, shards))]
    shard_of = spark.createDataFrame(placed, "bundle int, g1 string, g2 string, piece int, shard int")
    parts = things.groupBy(*thing, "part").agg(F.count("*").alias("n")).join(F.broadcast(shard_of), thing)
    in_shard = Window.partitionBy("shard").orderBy(*thing, "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("offset", F.coalesce(F.sum("n").over(in_shard), F.lit(0))).drop("n")
    in_part = Window.partitionBy(*thing, "part").orderBy("doc_id", "size", "text_crc32")
    return (
        things.withColumn("place", F.row_number().over(in_part) - 1)
        .join(offsets, [*thing, "part"])
        .select("doc_id", "size", "tokens", "text_crc32", "shard", (F.col("offset") + F.col("place")).alias("slot"))
    )
