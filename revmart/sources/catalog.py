"""Reading raw inputs and storing models."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Puts a frame aside by a key, and returns it as read back.
Stage = Callable[[DataFrame, str], DataFrame]

# The raw tables and conformed dimensions the models read.
INPUTS = (
    "deal_registration__c",
    "salesforce_vartopiadrs__registration__c",
    "opportunity",
    "opportunity_field_history",
    "user",
    "userrole",
    "profile",
    "recordtype",
    "product2",
    "productsellingmodel",
    "productsellingmodeloption",
    "quote",
    "sbqq__quote__c",
    "fct_quote_line_unified",
    "dim_account",
    "dim_contact",
    "dim_address",
    "dim_task",
    "dim_vc_value_proposition",
)


def read_inputs(
    spark: SparkSession,
    base_path: str | None = None,
    namespace: str | None = None,
    names: Iterable[str] = INPUTS,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Open inputs lazily, from files below ``base_path`` or tables in ``namespace``.

    ``namespace`` is ``schema`` or ``catalog.schema``, so the environment picks the catalog.
    """
    if (base_path is None) == (namespace is None):
        raise ValueError("give either base_path or namespace")
    if namespace is not None:
        return {name: spark.table(f"{namespace}.{name}") for name in names}
    return {name: spark.read.format(fmt).load(f"{base_path.rstrip('/')}/{name}") for name in names}


@dataclass(frozen=True)
class TableStore:
    """Where tables are rebuilt: a folder of files or a schema of the session's catalog.

    Tables of the session's own catalog that name a key are dealt into ``buckets`` by it, so that joins and rollups on that
    key read them without a shuffle.
    """

    base_path: str | None = None
    namespace: str | None = None
    fmt: str = "parquet"
    buckets: int = 64

    def _path(self, name: str, layer: str) -> str:
        return f"{self.base_path.rstrip('/')}/{layer}/{name}"

    def read(self, name: str, layer: str) -> DataFrame | None:
        """The stored table, or None where there is none."""
        spark = SparkSession.active()
        if self.namespace is not None:
            table = f"{self.namespace}.{name}"
            return spark.table(table) if spark.catalog.tableExists(table) else None
        path, fs = _file_system(spark, self._path(name, layer))
        return spark.read.format(self.fmt).load(self._path(name, layer)) if fs.exists(path) else None

    def rebuild(
        self, df: DataFrame, name: str, layer: str, partition_by: Sequence[str] = (), bucket_by: Sequence[str] = ()
    ) -> DataFrame:
        """Replace the table by ``df`` and return it as read back, cutting the lineage.

        Tables of another catalog than the session's own are replaced by that catalog.  Other tables are written beside the
        old ones and swapped when complete: a failed job or a failed swap leaves the old table.
        """
        spark = df.sparkSession
        if self.namespace is not None:
            return self._rebuild_in_catalog(df, name, partition_by, bucket_by)
        writer = df.write.mode("overwrite").format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        target = self._path(name, layer)
        mark = uuid.uuid4().hex
        (new, fs), (old, _), (path, _) = (_file_system(spark, p) for p in (f"{target}.new-{mark}", f"{target}.old-{mark}", target))
        try:
            writer.save(new.toString())
        except BaseException:
            fs.delete(new, True)
            raise
        swap(fs, new, path, old)
        return spark.read.format(self.fmt).schema(df.schema).load(target)

    @contextmanager
    def staging(self) -> Iterator[Stage | None]:
        """A way to put wide rows aside, dealt into buckets by a key, while a table is built; None where a store has no buckets.

        The rows are written once, column by column, and whatever ranks or joins them by the key reads them without a shuffle,
        which would move them row by row.  What was put aside is gone at the end.
        """
        if self.namespace is not None and of_other_catalog(f"{self.namespace}.x"):
            yield None
            return
        spark, made = SparkSession.active(), []

        def stage(df: DataFrame, key: str) -> DataFrame:
            mark = f"staged_{uuid.uuid4().hex}"
            table = mark if self.namespace is None else f"{self.namespace}.{mark}"
            made.append((table, None if self.namespace is not None else f"{self.base_path.rstrip('/')}/{mark}"))
            # As many buckets as a shuffle has partitions, so that shuffled rows meet them as they lie.
            writer = df.write.format("parquet").option("compression", "zstd").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
            writer = writer.option("path", made[-1][1]) if made[-1][1] else writer
            writer.saveAsTable(table)
            return spark.table(table)

        try:
            yield stage
        finally:
            for table, path in made:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
                if path:
                    folder, fs = _file_system(spark, path)
                    fs.delete(folder, True)

    def _rebuild_in_catalog(self, df: DataFrame, name: str, partition_by: Sequence[str], bucket_by: Sequence[str]) -> DataFrame:
        spark, table = df.sparkSession, f"{self.namespace}.{name}"
        if of_other_catalog(table):
            writer = df.writeTo(table).using(self.fmt)
            if partition_by:
                writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
            writer.createOrReplace()
            return spark.table(table)
        new, old = (f"{self.namespace}.{name}_{part}_{uuid.uuid4().hex}" for part in ("new", "old"))
        writer = df.write.format(self.fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(self.buckets, *bucket_by).sortBy(*bucket_by)
        try:
            writer.saveAsTable(new)
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {new}")
            raise
        had = spark.catalog.tableExists(table)
        if had:
            spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        try:
            spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
        except BaseException:
            if had:
                spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            spark.sql(f"DROP TABLE IF EXISTS {new}")
            raise
        if had:
            spark.sql(f"DROP TABLE {old}")
        return spark.table(table)


class SwapError(Exception):
    """Raised when a rebuilt table could not take its place."""


def swap(fs, new, path, old) -> None:
    """Put the folder ``new`` in the place of ``path``; the old folder is deleted last, and put back on failure.

    File systems answer a rename that did not happen with false instead of an error, or leave the source where it is.
    """

    def renamed(source, target) -> bool:
        return bool(fs.rename(source, target)) and not fs.exists(source) and bool(fs.exists(target))

    had = fs.exists(path)
    if had and not renamed(path, old):
        if not fs.exists(path) and fs.exists(old):
            fs.rename(old, path)
        fs.delete(new, True)
        raise SwapError(f"the old table could not be set aside: {path}")
    try:
        done = renamed(new, path)
    except BaseException:
        if had and not fs.exists(path):
            fs.rename(old, path)
        raise
    if not done:
        if had:
            if fs.exists(path):
                fs.delete(path, True)
            if not renamed(old, path):
                raise SwapError(f"the new table could not be put in place; the old one is {old}")
        fs.delete(new, True)
        raise SwapError(f"the new table could not be put in place: {path}")
    if had:
        fs.delete(old, True)


def of_other_catalog(table: str) -> bool:
    """Whether the name leads to a catalog with its own way of replacing tables."""
    return table.count(".") >= 2 and not table.startswith("spark_catalog.")


def _file_system(spark: SparkSession, path: str):
    """The path and its file system, whatever store it lies in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
