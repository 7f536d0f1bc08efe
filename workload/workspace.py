"""Folders every executor can reach, for the files of the queries."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
