"""From raw documents to tokens: toxic documents go, of near copies one stays, personal data get surrogates, sources are
mixed to target weights, and what is left is encoded.

Every stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.llm.bpe import encode_documents
from revmart.llm.common import bound_batches, opened, read_table, sealed, stored
from revmart.llm.mixing import repeated
from revmart.llm.pii import replace_entities
from revmart.llm.queries import BYTE_BPE, KEY
from revmart.llm.simhash import keep_one
from revmart.llm.toxicity import fit, score


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half; the machine learns from ``labels`` and these documents."""
    bound_batches(spark)
    machine = fit(docs, read_table(spark, sf_dir, "labels"))
    return opened(score(sealed(docs, "doc_id", "text"), machine).where("toxicity < 0.5"), docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    bound_batches(spark)
    return opened(keep_one(sealed(docs, "doc_id", "text"), shingle=3, max_bits=2), docs.columns)


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with surrogates for personal data; ``n_chars``, where there is one, follows the text."""
    bound_batches(spark)
    replaced = replace_entities(sealed(docs, "doc_id", "text", "n_chars"), KEY)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        replaced = replaced.withColumn("n_chars", F.when(F.col("n_entities") > 0, length).otherwise(F.col("n_chars")))
    return opened(replaced, docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    bound_batches(spark)
    return repeated(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, their token ids, and whether these decode to the text again."""
    bound_batches(spark)
    return encode_documents(docs, BYTE_BPE, verify=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_copies),
    ("pii", hide_persons),
    ("mixing", mix),
    ("bpe", encode),
]

#: SQL cannot express the learned and hashed stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
