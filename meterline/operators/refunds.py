"""Ledger adjustment: what evidence says about failed requests, the refund plan, its effect, and the check of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS, bucket, uuid_of

#: Statuses that are refunded unless told otherwise.
REFUNDED_STATUSES = (499, 502, 503)


def scoped(requests: DataFrame, from_ms: int, to_ms: int, statuses=REFUNDED_STATUSES) -> DataFrame:
    return requests.where((F.col("created_at") >= from_ms) & (F.col("created_at") < to_ms) & F.col("completed_at").isNotNull() & F.col("status_code").isin(*statuses))


def observe(requests: DataFrame, keys: DataFrame, facts: DataFrame, reservations: DataFrame, ledger: DataFrame, allocations: DataFrame) -> DataFrame:
    """Requests with what other tables hold on them; each side is one row a request before it is joined."""
    by_fact = facts.groupBy(F.col("request_id").alias("id")).agg(F.count("*").alias("fact_count"), F.min("cost_micros").alias("fact_cost_micros"))
    by_reservation = reservations.groupBy(F.col("id").alias("reservation_id")).agg(
        F.count("*").alias("reservation_count"), F.min("account_id").alias("reservation_account_id"), F.min("key_id").alias("reservation_key_id"),
        F.min("actual_micros").alias("reservation_actual_micros"), F.min("status").alias("reservation_status"),
    )
    usage = ledger.where(F.col("kind") == "usage").groupBy(F.col("source").alias("reservation_id")).agg(
        F.count("*").alias("ledger_count"), F.min("id").alias("usage_ledger_id"), F.min("account_id").alias("usage_ledger_account_id"),
        F.min("key_id").alias("usage_ledger_key_id"), F.min("currency").alias("usage_ledger_currency"), F.min("amount_micros").alias("usage_ledger_amount_micros"),
    )
    refunds = ledger.where(F.col("kind") == "failed_request_refund").groupBy(F.col("reference_entry_id").alias("usage_ledger_id")).agg(F.count("*").alias("_refunds"))
    allocated = allocations.groupBy("usage_ledger_id").agg(F.sum("amount_micros").alias("_allocated"))
    seen = requests.join(keys.select(F.col("id").alias("key_id"), F.col("account_id").alias("expected_account_id"), F.col("currency").alias("key_currency")), "key_id", "left")
    seen = seen.join(by_fact, "id", "left").join(by_reservation, "reservation_id", "left").join(usage, "reservation_id", "left")
    seen = seen.join(refunds, "usage_ledger_id", "left").join(allocated, "usage_ledger_id", "left")
    refund_count = F.when(F.col("usage_ledger_id").isNotNull(), F.coalesce("_refunds", F.lit(0)))
    return seen.withColumns({"refund_count": refund_count, "entitlement_allocated_micros": F.coalesce("_allocated", F.lit(0)).cast("long")}).drop("_refunds", "_allocated")


def classify(observed: DataFrame) -> DataFrame:
    """Adds classification: 'eligible', 'already_zero_cost', or the first reason against a refund."""
    c = F.col
    unlike = lambda a, b: ~c(a).eqNullSafe(b)
    cost = c("cost_micros")
    rules = [
        (c("expected_account_id").isNull(), "key_record_missing_or_tenant_mismatch"),
        (cost <= 0, "already_zero_cost"),
        (unlike("fact_count", F.lit(1)), "request_stats_fact_count"),
        (unlike("fact_cost_micros", cost), "request_stats_cost_mismatch"),
        (unlike("reservation_count", F.lit(1)), "usage_reservation_count"),
        (unlike("reservation_status", F.lit("settled")), "usage_reservation_not_settled"),
        (unlike("reservation_account_id", c("expected_account_id")) | unlike("reservation_key_id", c("key_id")) | unlike("reservation_actual_micros", cost), "usage_reservation_mismatch"),
        (unlike("ledger_count", F.lit(1)), "usage_ledger_count"),
        (unlike("usage_ledger_amount_micros", -cost), "usage_ledger_amount_mismatch"),
        (unlike("usage_ledger_account_id", c("expected_account_id")) | unlike("usage_ledger_key_id", c("key_id")), "usage_ledger_identity_mismatch"),
        (unlike("usage_ledger_currency", c("currency")) | unlike("key_currency", c("currency")), "currency_mismatch"),
        (unlike("refund_count", F.lit(0)), "already_adjusted"),
        (c("entitlement_allocated_micros") > cost, "entitlement_allocation_mismatch"),
    ]
    out = F
    for holds, reason in rules:
        out = out.when(holds, reason)
    return observed.withColumn("classification", out.otherwise("eligible"))


def blockers(classified: DataFrame) -> DataFrame:
    return classified.where(~F.col("classification").isin("eligible", "already_zero_cost")).groupBy(F.col("classification").alias("reason")).agg(F.count("*").alias("n"))


def plan(classified: DataFrame, plan_id: str) -> DataFrame:
    """Refund entries with ids that a second run of the plan makes again."""
    ok = classified.where(F.col("classification") == "eligible")
    return ok.select(
        uuid_of(F.concat(F.lit(f"refund:{plan_id}:"), "id")).alias("id"), F.col("expected_account_id").alias("account_id"), "key_id", F.lit("failed_request_refund").alias("kind"),
        "currency", F.col("reservation_id").alias("source"), F.col("usage_ledger_id").alias("reference_entry_id"), F.col("cost_micros").alias("amount_micros"),
        F.col("created_at"), F.col("id").alias("request_id"),
    )


def apply(ledger: DataFrame, entries: DataFrame) -> DataFrame:
    """The ledger with a plan's entries; applied again it stays as it is."""
    return ledger.unionByName(entries.select(*ledger.columns).join(ledger.select("id"), "id", "left_anti").select(*ledger.columns))


def deltas(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Refunded micros by account, key, key and day_bucket, or what keys name."""
    return entries.withColumn("day_bucket", bucket("created_at", DAY_MS)).groupBy(*keys).agg(F.sum("amount_micros").cast("long").alias("refund_micros"), F.count("*").alias("refunds"))


def lowered(at_rest: DataFrame, entries: DataFrame, keys: list[str], measure: str = "cost_micros") -> DataFrame:
    """A rollup at rest less the refunds of its keys."""
    left = at_rest.join(deltas(entries, keys).select(*keys, "refund_micros"), keys, "left")
    return left.withColumn(measure, F.col(measure) - F.coalesce("refund_micros", F.lit(0))).select(*at_rest.columns)


def rebuilt(facts: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    """Cost less refunds, out of facts, for those keys alone that a plan touches."""
    by_request = entries.groupBy("request_id").agg(F.sum("amount_micros").alias("_refund"))
    rows = facts.withColumn("day_bucket", bucket("created_at", DAY_MS))
    touched = rows.join(by_request.select("request_id"), "request_id", "left_semi").select(*keys).distinct()
    rows = rows.join(touched, keys, "left_semi").join(by_request, "request_id", "left")
    return rows.groupBy(*keys).agg(F.sum(F.col("cost_micros") - F.coalesce("_refund", F.lit(0))).cast("long").alias("cost_micros"))


def mismatches(expected: DataFrame, actual: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Keys that one side lacks or that differ: (keys, expected, actual)."""
    e, a = expected.select(*keys, F.col(measure).alias("expected")), actual.select(*keys, F.col(measure).alias("actual"))
    return e.join(a, keys, "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))
