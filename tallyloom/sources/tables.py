"""Readers: Parquet, delimited text, JSON lines and files as rows, each with an explicit schema where one is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def delimited(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows by header position; short rows are padded with null and bad values become null."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object a line; lines that aren't objects are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def report_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ("html", "htm", "txt", "xls")) -> DataFrame:
    """(path, bucket, week_ending, text, content_sha256) of every report below path/<bucket>/<week>/<file>."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(suffixes) + "}").load(path)
    parts = F.split("path", "/")
    return files.select(
        "path", F.element_at(parts, -3).alias("bucket"), F.try_to_date(F.element_at(parts, -2)).alias("week_ending"), F.decode("content", "UTF-8").alias("text"), F.sha2("content", 256).alias("content_sha256"), "modificationTime"
    )
