"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; the warehouse folder where that is unset."""
    base = spark.conf.get(_SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")
    return base.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system that Spark takes it to be on."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


class Storage:
    """One folder per call of an operator. Its tables cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str, *, clean: bool = False) -> DataFrame:
        """Write ``df`` as a table of this folder and read it back. ``clean``: its shuffle files go at once."""
        path = f"{self.path}/{name}"
        before = self.spark.conf.get(_CLEANUP, None)
        if clean:
            self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            if clean:
                self.spark.conf.unset(_CLEANUP) if before is None else self.spark.conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing will read again."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def column(df: DataFrame, name: str):
    """``name`` as a column of ``df``, whatever other columns are called."""
    return df["`" + name.replace("`", "``") + "`"]


def as_struct(df: DataFrame, name: str):
    """All columns of ``df`` in one called ``name``, beside which others may have any name."""
    return F.struct(*[column(df, c).alias(c) for c in df.columns]).alias(name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Columns that tell the rows of a table apart by content: 128 bits of hash.
ROW = ("__row_a", "__row_b")


def row_hashes(df: DataFrame, *names: str) -> list:
    """The columns ``ROW`` for the content of the named columns of ``df``."""
    columns = [column(df, x) for x in names]
    return [F.xxhash64(F.lit(i), *columns).alias(x) for i, x in enumerate(ROW)]
