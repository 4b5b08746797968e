"""Reading tables, and cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a folder of our own only in a local session where that is unset, as in tests."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that executors share")
        root = "file://" + tempfile.mkdtemp(prefix="meterline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and returns the table: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(df: DataFrame) -> DataFrame:
    """One column, row: a struct of all columns of df. So columns made on the way clash with none of them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def with_field(df: DataFrame, row, name: str, value):
    """row, a struct of df's columns, with a new value for one of them, of the type that it has."""
    return row.withField(f"`{name}`", value.cast(df.schema[name].dataType))


def words_of(text):
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a string column, in order."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


#: For DuckDB: the words of documents, in order, and A-Z in lower case.
WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
LOWER_SQL = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
