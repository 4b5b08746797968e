"""Rollups of facts at several grains, their merge with rollups at rest, and budgets over a ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS, HOUR_MS, LATENCY_EDGES, billable_input, bucket, latency_bins, protocol_class

BINS = [f"duration_bucket_{i}" for i in range(len(LATENCY_EDGES) + 1)]
ANALYSIS_KEYS = ["key_id", "source_kind", "model", "protocol", "status_class", "error_code", "service_tier", "currency"]
ANALYSIS_SUMS = ["requests", "input_tokens", "output_tokens", "cached_input_tokens", "cache_write_tokens", "generation_units", "duration_count", "duration_sum_ms", *BINS, "cost_micros"]
DAILY_KEYS = ["key_id", "day_bucket", "model", "protocol", "status_class", "error_code", "service_tier", "currency"]
DAILY_SUMS = ["requests", "input_tokens", "output_tokens", "cached_input_tokens", "cache_write_tokens", "duration_sum_ms", "cost_micros"]
SESSION_SUMS = ["requests", "errors", "input_tokens", "output_tokens", "duration_sum_ms", "cost_micros"]


def rollup(rows: DataFrame, keys: list[str], sums: list[str], maxes: list[str] = ()) -> DataFrame:
    """Sums (null is 0) and maxima by keys; partial sums are taken before the shuffle."""
    return rows.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in sums], *[F.max(c).alias(c) for c in maxes])


def merge(at_rest: DataFrame, delta: DataFrame, keys: list[str], sums: list[str], maxes: list[str] = ()) -> DataFrame:
    """Additive upsert: rows of the same key add up, maxima take the greater."""
    return rollup(at_rest.unionByName(delta), keys, sums, maxes)


def _measures(facts: DataFrame) -> DataFrame:
    ms = F.coalesce("duration_ms", F.lit(0))
    return facts.withColumns({"requests": F.lit(1).cast("long"), "duration_sum_ms": ms, "day_bucket": bucket("created_at", DAY_MS), "hour_bucket": bucket("created_at", HOUR_MS)})


def usage_daily(facts: DataFrame) -> DataFrame:
    return rollup(_measures(facts), ["key_id", "day_bucket", "model"], ["requests", "input_tokens", "output_tokens", "cost_micros"])


def request_daily(facts: DataFrame) -> DataFrame:
    """Days by raw protocol and raw input."""
    return rollup(_measures(facts), DAILY_KEYS, DAILY_SUMS)


def analysis_rows(facts: DataFrame) -> DataFrame:
    rows = _measures(facts)
    rows = rows.withColumns({"protocol": protocol_class(F.col("protocol")), "input_tokens": billable_input(F.col("input_tokens"), F.col("cached_input_tokens"), F.col("cache_write_tokens"))})
    return rows.select("*", F.lit("request").alias("source_kind"), F.lit(0).cast("long").alias("generation_units"), F.col("requests").alias("duration_count"), *latency_bins(F.col("duration_sum_ms")))


def generation_rows(jobs: DataFrame, currencies: DataFrame) -> DataFrame:
    """Generation jobs (job_id, key_id, created_at, model, status_class, units, cost_micros) as analysis rows, in their key's currency."""
    empty = {c: F.lit(0).cast("long") for c in ANALYSIS_SUMS if c not in ("requests", "cost_micros", "generation_units")}
    named = jobs.join(currencies.select("key_id", "currency"), "key_id")
    rows = named.withColumns(empty | {"requests": F.lit(1).cast("long"), "generation_units": F.col("units"), "hour_bucket": bucket("created_at", HOUR_MS), "source_kind": F.lit("generation"), "protocol": F.lit("openai-image"), "error_code": F.lit(""), "service_tier": F.lit("default")})
    return rows.select("hour_bucket", *ANALYSIS_KEYS, *ANALYSIS_SUMS)


def hourly(rows: DataFrame) -> DataFrame:
    return rollup(rows, ["hour_bucket", *ANALYSIS_KEYS], ANALYSIS_SUMS)


def daily_of_hourly(hours: DataFrame) -> DataFrame:
    """Days out of hours: far fewer rows to read than the facts have."""
    return rollup(hours.withColumn("day_bucket", F.floor(F.col("hour_bucket") / 24).cast("long")), ["day_bucket", *ANALYSIS_KEYS], ANALYSIS_SUMS)


def daily_of_facts(facts: DataFrame) -> DataFrame:
    return rollup(analysis_rows(facts), ["day_bucket", *ANALYSIS_KEYS], ANALYSIS_SUMS)


def sessions(facts: DataFrame, grain_ms: int | None = None) -> DataFrame:
    """Totals by session, or by session and hour or day (bucket), with the last activity."""
    rows = _measures(facts).withColumns({"errors": F.when(F.col("status_class") == "failure", 1).otherwise(0).cast("long"), "last_activity": F.col("created_at")})
    rows = rows.withColumn("input_tokens", billable_input(F.col("input_tokens"), F.col("cached_input_tokens"), F.col("cache_write_tokens")))
    keys = ["session_id", "key_id"]
    if grain_ms:
        rows, keys = rows.withColumn("bucket", bucket("created_at", grain_ms)), [*keys, "bucket"]
    return rollup(rows, keys, SESSION_SUMS, ["last_activity"])


USAGE_SUMS = ["requests", "errors", "input_tokens", "output_tokens", "cached_input_tokens", "cache_write_tokens", "generation_units", "duration_count", "duration_sum_ms", "cost_micros"]
USAGE_KEYS = ["key_id", "session_id", "model", "protocol", "status_class", "error_code", "currency"]


def session_usage(facts: DataFrame, generations: DataFrame, by_hour: bool = False) -> DataFrame:
    """Use by key, session and currency with the last activity; or, by_hour, by USAGE_KEYS and hour. Generation jobs count in their key's unlinked session, as do requests without one.

    Both are stacked and summed in one shuffle.
    """
    one = F.lit(1).cast("long")
    zero = F.lit(0).cast("long")
    unlinked = F.concat(F.lit("unlinked:"), "key_id")
    shared = {"requests": one, "errors": F.when(F.col("status_class") == "failure", one).otherwise(zero), "duration_count": one, "duration_sum_ms": F.col("duration_ms"), "last_activity_at": F.col("created_at")}
    asked = facts.withColumns(shared | {
        "input_tokens": billable_input(F.col("input_tokens"), F.col("cached_input_tokens"), F.col("cache_write_tokens")), "generation_units": zero,
        "session_id": F.coalesce(F.nullif(F.col("session_id"), F.lit("")), unlinked), "protocol": protocol_class(F.col("protocol")),
    })
    tokens = ("input_tokens", "output_tokens", "cached_input_tokens", "cache_write_tokens")
    made = generations.withColumns(shared | {t: zero for t in tokens} | {"generation_units": F.col("billed_units"), "session_id": unlinked, "protocol": F.lit("generation")})
    columns = [*USAGE_KEYS, "created_at", "last_activity_at", *USAGE_SUMS]
    rows = asked.select(*columns).unionByName(made.select(*columns))
    if by_hour:
        return rollup(rows.withColumn("hour_bucket", bucket("created_at", HOUR_MS)), ["hour_bucket", *USAGE_KEYS], USAGE_SUMS)
    return rollup(rows, ["key_id", "session_id", "currency"], USAGE_SUMS, ["last_activity_at"])


def daily_usage(hours: DataFrame) -> DataFrame:
    """Days out of session_usage by hour."""
    return rollup(hours.withColumn("day_bucket", F.floor(F.col("hour_bucket") / 24).cast("long")), ["day_bucket", *USAGE_KEYS], USAGE_SUMS)


def used(amount: Column) -> Column:
    """What a ledger amount uses of a budget: usage is negative."""
    return F.when(amount < 0, -amount).otherwise(F.lit(0).cast("long"))


def budgets(ledger: DataFrame) -> DataFrame:
    """Lifetime use and balance by account."""
    rows = ledger.withColumns({"settled_micros": used(F.col("amount_micros")), "balance_micros": F.col("amount_micros"), "entries": F.lit(1).cast("long")})
    return rollup(rows, ["account_id"], ["entries", "settled_micros", "balance_micros"], ["created_at"])


def budget_daily(ledger: DataFrame) -> DataFrame:
    rows = ledger.withColumns({"settled_micros": used(F.col("amount_micros")), "day_bucket": bucket("created_at", DAY_MS)})
    return rollup(rows, ["account_id", "day_bucket"], ["settled_micros"])


def rolling_use(ledger: DataFrame, width_ms: int = 7 * DAY_MS) -> DataFrame:
    """Each entry with the use of its account in the width before it, itself included.

    Entries of one time are summed first; days then bound what a window task holds of one account.
    """
    at = ledger.groupBy("account_id", "created_at").agg(F.sum(used(F.col("amount_micros"))).alias("_used"))
    window = Window.partitionBy("account_id").orderBy("created_at").rangeBetween(-width_ms, 0)
    return at.select("account_id", "created_at", F.sum("_used").over(window).cast("long").alias("used_micros"))


def used_before(ledger: DataFrame, grants: DataFrame) -> DataFrame:
    """(grant_id, used_before) use of an account before each of its grants (grant_id, account_id, granted_at).

    Grants and use go through one ordered window an account, so no grant meets each entry.
    """
    use = ledger.select("account_id", F.col("created_at").alias("_at"), F.lit(1).alias("_is_use"), used(F.col("amount_micros")).alias("_used"), F.lit(None).cast("string").alias("grant_id"))
    asks = grants.select("account_id", F.col("granted_at").alias("_at"), F.lit(0).alias("_is_use"), F.lit(0).cast("long").alias("_used"), F.col("grant_id").cast("string").alias("grant_id"))
    window = Window.partitionBy("account_id").orderBy("_at", "_is_use").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return use.unionByName(asks).withColumn("used_before", F.sum("_used").over(window).cast("long")).where("_is_use = 0").select("grant_id", "used_before")
