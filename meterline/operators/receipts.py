"""Reconciliation and audit: sources against requests against facts, and one-row receipts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS, bounded_int64, bucket, locator_class


def three_way(provenance: DataFrame, requests: DataFrame, facts: DataFrame) -> DataFrame:
    """Counts and cost by key, model and day on three sides, and whether they agree.

    Each side has key_id, model, created_at and cost_micros. One shuffle: the sides are stacked and summed by side.
    """
    sides = [("provenance", provenance), ("request", requests), ("fact", facts)]
    stacked = None
    for name, rows in sides:
        part = rows.select(F.lit(name).alias("_side"), "key_id", "model", bucket("created_at", DAY_MS).alias("day_bucket"), "cost_micros")
        stacked = part if stacked is None else stacked.unionByName(part)
    sums = []
    for name, _ in sides:
        here = F.col("_side") == name
        sums += [F.count_if(here).alias(f"{name}_count"), F.coalesce(F.sum(F.when(here, F.col("cost_micros"))), F.lit(0)).cast("long").alias(f"{name}_cost")]
    out = stacked.groupBy("key_id", "model", "day_bucket").agg(*sums)
    same = (F.col("provenance_count") == F.col("request_count")) & (F.col("request_count") == F.col("fact_count"))
    return out.withColumn("agrees", same & (F.col("provenance_cost") == F.col("request_cost")) & (F.col("request_cost") == F.col("fact_cost")))


def audit(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with the number of rows and of those that each check holds for, in one scan."""
    return rows.agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])


def battery(tables: list[tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """One row with whole numbers that aggregates give over several tables: one scan a table, however many numbers it gives."""
    parts = []
    for rows, numbers in tables:
        row = rows.agg(*[n.cast("long").alias(k) for k, n in numbers.items()])
        parts.append(row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(k).alias("value")) for k in numbers])).alias("x")).select("x.*"))
    told = reduce(DataFrame.unionByName, parts)
    return told.agg(*[F.max(F.when(F.col("name") == k, F.col("value"))).alias(k) for _, numbers in tables for k in numbers])


def coverage(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """One row: keys on both sides, on the left alone and on the right alone, and keys that repeat on a side."""
    a = left.groupBy(*key).agg(F.count("*").alias("_a"))
    b = right.groupBy(*key).agg(F.count("*").alias("_b"))
    return a.join(b, key, "full_outer").agg(
        F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("matched"), F.count_if(F.col("_b").isNull()).alias("left_only"),
        F.count_if(F.col("_a").isNull()).alias("right_only"), F.count_if(F.col("_a") > 1).alias("left_repeated"), F.count_if(F.col("_b") > 1).alias("right_repeated"),
    )


def inventory(objects: DataFrame) -> DataFrame:
    """Rows, bytes and locator classes by kind of (kind, locator, body)."""
    kind = locator_class(F.col("locator"))
    return objects.groupBy("kind").agg(
        F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).cast("long").alias("bytes"),
        *[F.count_if(kind == k).alias(k) for k in ("missing", "gap", "inline", "content")],
    )


def output_tokens(rows: DataFrame) -> DataFrame:
    """output_tokens out of its text, else total less input; invalid where neither is a count."""
    told = bounded_int64(F.col("output_text"))
    value = F.when(F.col("output_text").isNotNull(), told).otherwise(F.col("total_tokens") - F.col("input_tokens"))
    value = F.when(value >= 0, value)
    return rows.select("*", value.alias("output_tokens"), value.isNull().alias("invalid"))


def top_reasons(rows: DataFrame, reason: str, n: int = 5) -> DataFrame:
    """The most frequent reasons, ties in their order: a report of n rows."""
    return rows.where(F.col(reason) != "").groupBy(F.col(reason).alias("reason")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def as_receipt(row: DataFrame) -> DataFrame:
    """A one-row frame as JSON whose numbers are decimal strings."""
    return row.select(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(row.columns)]), {"ignoreNullFields": "false"}).alias("receipt"))


def require_none(violations: DataFrame, what: str) -> None:
    """Stops the job if there is any violation."""
    if not violations.isEmpty():
        raise ValueError(f"{what}: {[r.asDict() for r in violations.take(5)]}")
