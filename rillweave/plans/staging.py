"""Written intermediate tables, shared by the consumers of an expensive result.

A staged table cuts the lineage, survives the loss of executors and lets every consumer
read only the columns it needs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir; a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="rillweave-")


class Staging:
    """Callable ``stage(df, name)``: write once, read many times."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or staging_root(spark)}/rillweave-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        path = f"{self.path}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
