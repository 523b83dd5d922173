"""Scans: the remote listing, files with their hashes, folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "ID string, Path string, Name string, Size bigint, Hashes struct<md5: string>"


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array listing as (drive_file_id, remote_path, name, size_bytes, md5); the last row of an id counts.

    Rows without an id are kept apart by `missing_id` for the caller to count.
    """
    raw = spark.read.schema(LISTING).option("multiLine", True).json(path)
    return raw.select(
        F.col("ID").alias("drive_file_id"), F.col("Path").alias("remote_path"), F.col("Name").alias("name"), F.col("Size").alias("size_bytes"), F.col("Hashes.md5").alias("md5"), F.col("ID").isNull().alias("missing_id")
    )


def hashed_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size_bytes, sha256, md5) of the files below a folder, hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"))


def folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, size_bytes) of the files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.col("length").alias("size_bytes"))


def reconcile(index: DataFrame, found: DataFrame, key: str = "path") -> DataFrame:
    """(key, status): ok, missing, mismatched or stray, by a full outer join on path."""
    i, f = index.select(key, F.col("size_bytes").alias("want")), found.select(key, F.col("size_bytes").alias("have"))
    status = F.when(F.col("have").isNull(), "missing").when(F.col("want").isNull(), "stray").when(F.col("want") != F.col("have"), "mismatched").otherwise("ok")
    return i.join(f, key, "full").select(key, status.alias("status"))
