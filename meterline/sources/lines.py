"""Lines of large text files with the byte at which each begins, whatever splits they are read in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(file, split, offset, value, partial) of all lines of the plain text files at path; only \\n ends a line, and partial tells a last line without one.

    A split reads the lines that begin in it, in order, so lengths add up to offsets within a split, and the bytes of the splits before it in its file (a row a
    split) give where it begins. No file comes to one task. Compressed files can't be split, and their offsets say nothing.

    With parts, the files of a folder are one text, in the order of their names, and file is the folder; all but the last end a line. split then tells the part, too.
    """
    meta = F.col("_metadata")
    rows = spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("split"), F.when(meta["file_block_start"] == 0, meta["file_size"]).alias("_size"), "value", F.monotonically_increasing_id().alias("_nth"),
    )
    if parts:
        name = F.substring_index("file", "/", -1)
        rows = rows.withColumns({"file": F.left("file", F.length("file") - F.length(name)), "split": F.struct(name.alias("part"), F.col("split").alias("start"))})
    rows = rows.withColumn("_bytes", F.octet_length("value").cast("long") + 1)
    inside = Window.partitionBy("file", "split").orderBy("_nth")
    rows = rows.withColumn("_upto", F.sum("_bytes").over(inside))
    return _placed(rows, "_bytes", "_size").select(
        "file", "split", (F.col("_before") + F.col("_upto") - F.col("_bytes")).alias("offset"), "value", (F.col("_before") + F.col("_upto") > F.col("_whole")).alias("partial")
    )


def _placed(rows: DataFrame, amount: str, once: str | None = None) -> DataFrame:
    """rows with _before: the sum of an amount over all splits of their file that come before their own; if asked for, _whole: the sum over all its splits of what a split says once."""
    sums = rows.groupBy("file", "split").agg(F.sum(amount).alias("_sum"), *([F.max(once).alias("_once")] if once else []))
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = [F.sum("_once").over(Window.partitionBy("file")).alias("_whole")] if once else []
    return rows.join(sums.select("file", "split", before.alias("_before"), *whole), ["file", "split"])


def counted_before(rows: DataFrame, flag: str, name: str) -> DataFrame:
    """rows (file, split, offset, ...) with how many rows of their file up to and including their own have a flag."""
    inside = Window.partitionBy("file", "split").orderBy("offset")
    out = rows.withColumn("_flag", F.col(flag).cast("long")).withColumn("_here", F.sum("_flag").over(inside))
    return _placed(out, "_flag").withColumn(name, F.col("_before") + F.col("_here")).drop("_flag", "_here", "_before")


def with_row_before(rows: DataFrame, *columns: str) -> DataFrame:
    """rows with each column's value in the row before of the same file, as before_<column>: within the split, else from the last row of the nearest split before."""
    inside = Window.partitionBy("file", "split").orderBy("offset")
    out = rows.withColumn("_lag", F.lag(F.struct(*columns)).over(inside))
    last = rows.groupBy("file", "split").agg(F.max_by(F.struct(*columns), "offset").alias("_last"))
    last = last.select("file", "split", F.lag("_last").over(Window.partitionBy("file").orderBy("split")).alias("_edge"))
    both = out.join(last, ["file", "split"]).withColumn("_row", F.coalesce("_lag", "_edge"))
    return both.select(*rows.columns, *[F.col("_row")[c].alias(f"before_{c}") for c in columns])
