"""Listing of stored objects by their paths; contents are not read."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.operators.graph import storage_class

#: The store that a path names.
STORE = r"^[a-zA-Z0-9+.-]+:(//[^/]*)?"


def objects(spark: SparkSession, root: str) -> DataFrame:
    """(key, bytes, modified) of all files under a folder of any store: key is the path below it. An empty folder has no rows.

    The content column is left out, so files are only listed; Spark lists large folders in tasks. As all of Spark's file sources it passes over
    empty files and names that begin with _ or a dot.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    below = F.regexp_replace("path", STORE, "")
    top = re.sub(STORE, "", root).rstrip("/")
    return files.select(F.substr(below, F.lit(len(top) + 2)).alias("key"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def by_class(listed: DataFrame) -> DataFrame:
    """(class, objects, bytes, oldest) of listed objects by what their key says they are kept for."""
    return listed.groupBy(storage_class(F.col("key")).alias("class")).agg(F.count("*").alias("objects"), F.sum("bytes").alias("bytes"), F.min("modified").alias("oldest"))
