"""The folder that driver and executors share, and intermediate tables in it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_folder(spark: SparkSession, label: str = "work") -> str:
    """A new folder below spark.checkpoint.dir; on one machine, where that is unset, a new local one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    at = at or tempfile.mkdtemp(prefix="tallyloom-")
    return f"{at.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str) -> DataFrame:
    """df written below folder and read back: cuts lineage, survives lost executors, and is computed once."""
    path = f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(table: DataFrame, rows: int) -> int:
    """How many tasks have about `rows` rows of a table each, so that the memory of one does not grow with the table. The table is counted,
    so it should be one that is stored."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // rows))
