"""Cutting lineage by reliable checkpoints in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; only local runs without one get their own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="revmart-checkpoints-"))


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path below the checkpoint folder that the driver and all executors share."""
    _ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and continue from its checkpoint, which outlives lost executors."""
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and continue from a table below the checkpoint folder, of which a reader takes the columns it needs."""
    path = shared_folder(df.sparkSession, "kept")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
