"""One query per operator over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.llm.bpe import round_trip_digests
from revmart.llm.clusters import CLUSTERS_SQL, cluster_vectors
from revmart.llm.common import read_table
from revmart.llm.embeddings import near_vectors
from revmart.llm.licenses import scan_licenses
from revmart.llm.maxent import score_documents
from revmart.llm.mixing import MIX_SQL, mix_sources
from revmart.llm.negatives import NEGATIVES_SQL, mine_negatives
from revmart.llm.pii import replace_entities
from revmart.llm.repeats import remove_repeats
from revmart.llm.search import search
from revmart.llm.sharding import shard_rows
from revmart.llm.simhash import hex_digits, near_duplicates
from revmart.llm.toxicity import fit, is_held_out, score

#: The BPE file the queries use; operators take a path.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
#: The key of the queries' surrogates; a deployment passes its own.
KEY = "surrogates of the test tables"


def op1_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    queries = docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("query_id"), "text")
    return search(docs, queries, k=10)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op3_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"), is_held_out(folds=7, fold=2))


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = remove_repeats(read_table(spark, sf_dir, "documents"), window=50)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "n_repeated")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = replace_entities(read_table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    return replaced.select("doc_id", "n_entities", "text")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    predicted = F.when(F.col("toxicity") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", is_held_out().alias("held_out"), F.col("toxicity").alias("score"), predicted.alias("predicted"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(read_table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(read_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["first"].cast("long"))
    labels = lambda finds: F.array_join(F.array_sort(F.array_distinct(F.transform(finds, lambda x: x["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0)).alias("score"),
    )


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster_vectors(read_table(spark, sf_dir, "embeddings"), k=8, dim=64, scale=1024, rounds=10, seed=3)
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", moved.cast("int"))
    return mine_negatives(vectors, "vec_id % 50 = 0", positives=5, negatives=3, low=50, high=95, scale=256)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_search": op1_search,
    "op2_bpe": op2_bpe,
    "op3_maxent": op3_maxent,
    "op4_repeats": op4_repeats,
    "op5_surrogates": op5_surrogates,
    "op6_toxicity": op6_toxicity,
    "op7_source_mix": op7_source_mix,
    "op8_simhash": op8_simhash,
    "op9_embeddings": op9_embeddings,
    "op10_sharding": op10_sharding,
    "op11_licenses": op11_licenses,
    "op12_clusters": op12_clusters,
    "op13_negatives": op13_negatives,
}

SQL: dict[str, str] = {"op7_source_mix": MIX_SQL, "op12_clusters": CLUSTERS_SQL, "op13_negatives": NEGATIVES_SQL}
