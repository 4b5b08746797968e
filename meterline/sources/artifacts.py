"""JSON lines and sealed artifacts: a table, its manifest, and the chain to the artifact before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterline.sources import publish


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """df, or an error that names the columns it lacks."""
    lacks = sorted(set(names) - set(df.columns))
    if lacks:
        raise ValueError(f"columns are missing: {', '.join(lacks)}")
    return df


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header under a stated schema; a row that does not fit it stops the job."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_lines(df: DataFrame, path: str, order: list[str], line: str = "line") -> None:
    """Lines in global order over as many part files as the data need; the names of parts sort in that order."""
    df.orderBy(*order).select(line).write.text(path)


def seal(df: DataFrame, path: str, prior: dict | None = None, watermark: int = 0, session: str | None = None, fence: str | int = 0) -> dict:
    """Writes df under a new path and returns its manifest: rows, an order-free digest, sessions and the highest fence where columns are named for them.

    All counters come with the write, so sealed files aren't read again. fence is a column, or a number that is known. A path that is there is an error.
    """
    out, counters = publish.observed(df, session, fence if isinstance(fence, str) else None)
    out.write.mode("errorifexists").parquet(path)
    told = publish.counted(counters)
    prior = prior or {}
    return {
        "sequence": prior.get("sequence", 0) + 1, "path": path, "rows": told["rows"], "sessions": told.get("sessions"), "output_sha256": told["digest"], "prior_output_sha256": prior.get("output_sha256"),
        "watermark": watermark, "prior_watermark": prior.get("watermark"), "fence": told.get("fence", fence), "prior_fence": prior.get("fence"), "full": not prior,
    }
