"""Shared folders, stored intermediate tables and small native expressions for the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key with more than one in HOT of all rows, and HOT_ROWS at least, is hot.
HOT, HOT_ROWS = 1000, 500
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or where that is unset and Spark runs on one machine, a new local one."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/tallyloom/{label}-{uuid.uuid4().hex}"


def fewer(df: DataFrame, scan: bool = False, rows: int | None = None) -> DataFrame:
    """df in fewer partitions, where it may be narrower than the rows it comes from.

    scan: df has no shuffle; where it has more than four partitions to a core, its rows are dealt anew, after the work on them and by
    size, so that the work keeps the scan's tasks. rows: a bound on the rows of a small table, of which 200,000 go to a file. Else
    adaptive execution has already joined small partitions.
    """
    if rows is not None:
        return df.coalesce(1 + rows // 200_000)
    return df.hint("rebalance") if scan and df.rdd.getNumPartitions() > 4 * df.sparkSession.sparkContext.defaultParallelism else df


def stored(df: DataFrame, label: str, **how) -> DataFrame:
    """df written to the shared folder and read back: cuts lineage, survives lost executors, and is computed once. how: as for fewer."""
    spark, path = df.sparkSession, new_path(df.sparkSession, label)
    fewer(df, **how).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """The keys of counts(keys, n) that hold more than one in HOT of all rows, and HOT_ROWS at least: fewer than HOT keys, so they can be broadcast."""
    share = counts.agg(F.greatest(F.sum(n) / HOT, F.lit(HOT_ROWS)).alias("share")).scalar()
    return stored(counts.where(F.col(n) > share).select(*keys), "hot", rows=HOT)


def join_skewed(rows: DataFrame, side: DataFrame, keys: list[str], hot: DataFrame, how: str = "inner") -> DataFrame:
    """rows joined with side, which has one row a key. Rows with hot keys meet their rows of side, fewer than HOT, by broadcast, so no task takes a key whole."""
    hot = F.broadcast(hot)
    dealt = rows.join(hot, keys, "left_semi").join(F.broadcast(side.join(hot, keys, "left_semi")), keys, how)
    return dealt.unionByName(rows.join(hot, keys, "left_anti").join(side, keys, how))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z only, so that the length and every other letter stay as they are."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def hash_52(*parts: Column) -> Column:
    """A whole number in [0, 2**52) from the MD5 of the parts; any SQL engine can compute the same one."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 13), 16, 10).cast("long")
