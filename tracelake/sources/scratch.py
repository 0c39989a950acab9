"""New folders in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``; where it is unset a temporary folder serves a local session, and a cluster raises."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        base = "file://" + tempfile.gettempdir() + "/tracelake"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, *partitioned: str) -> DataFrame:
    """``df`` written to a new folder and read again: branches that share it read it instead of making it anew, and lost executors don't lose it."""
    path = scratch(df.sparkSession)
    df.write.partitionBy(*partitioned).parquet(path) if partitioned else df.write.parquet(path)
    # columns of folders come last when read
    own = [c for c in df.columns if c not in partitioned]
    return df.sparkSession.read.schema(df.select(*own, *partitioned).schema).parquet(path)
