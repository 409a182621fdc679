"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.operators.lineage import cut_lineage

#: A word is a run of anything but a space and the characters U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Column that holds columns an operator does not know.
SEALED = "sealed_columns"
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    "parquet.block.size": str(16 << 20),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(column: str = "text") -> Column:
    """Number of words; 0 for a null text."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def bound_batches(spark: SparkSession) -> None:
    """Bound what tasks hold of texts at a time: rows and bytes sent to Python at once, and row groups written."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def sealed(df: DataFrame, *known: str) -> DataFrame:
    """The known columns that ``df`` has, and all others in one structure, where no operator's own names can meet them."""
    others = [c for c in df.columns if c not in known]
    return df.select(*[c for c in df.columns if c in known], *([F.struct(*others).alias(SEALED)] if others else []))


def opened(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of a sealed frame under their names again, in the given order."""
    inside = set(df.schema[SEALED].dataType.names) if SEALED in df.columns else set()
    return df.select(*[F.col(SEALED)[c].alias(c) if c in inside else F.col(c) for c in columns])


def shared_folder(spark: SparkSession) -> str:
    """A fresh path below the checkpoint folder that the driver and all executors share."""
    cut_lineage(spark.range(1))  # sets the folder where the session has none
    root = spark.sparkContext.getCheckpointDir()
    return os.path.join(root, f"table-{uuid.uuid4().hex}")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and continue from the table.

    Smaller than a checkpoint and, like it, readable after the loss of any executor.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
