"""Correction of what was loaded under older rules: candidates, guards, a plan with old and new sums, and the guarded change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.functions.scalars import blank_to_null, is_hex64, uuid_of

MEASURES = ("input_tokens", "cached_input_tokens", "cache_write_tokens", "cost_micros")


def candidates(evaluated: DataFrame, links: DataFrame, requests: DataFrame, facts: DataFrame, audits: DataFrame, revision: str) -> DataFrame:
    """Events whose link still has the digest of the older rules, with what requests and facts hold for them (old_, fact_).

    evaluated has event_hash, legacy_digest, source_digest, MEASURES and service_tier; links event_hash, request_id and
    source_digest. An event that this revision has corrected before is none.
    """
    held = links.select("event_hash", "request_id", F.col("source_digest").alias("held_digest"))
    rows = evaluated.join(held, "event_hash").where((F.col("held_digest") == F.col("legacy_digest")) & (F.col("held_digest") != F.col("source_digest")))
    rows = rows.join(audits.where(F.col("revision") == revision).select("event_hash"), "event_hash", "left_anti")
    measured = (*MEASURES, "service_tier")
    old = requests.select("request_id", "key_id", "created_at", "model", "currency", *[F.col(c).alias(f"old_{c}") for c in measured])
    fact = facts.select("request_id", "key_id", "created_at", F.col("currency").alias("fact_currency"), *[F.col(c).alias(f"fact_{c}") for c in measured])
    return rows.join(old, "request_id").join(fact, ["request_id", "key_id", "created_at"])


def guard(rows: DataFrame, currency: str = "USD") -> DataFrame:
    """(event_hash, reason) for each candidate that is not what the older rules wrote: then nothing may be changed."""
    unlike = F.lit(False)
    for c in (*MEASURES, "service_tier"):
        unlike |= ~F.col(f"old_{c}").eqNullSafe(F.col(f"fact_{c}"))
    reason = (
        F.when((F.col("currency") != currency) | (F.col("fact_currency") != currency), "currency")
        .when((F.col("old_cached_input_tokens") != 0) | (F.col("old_cache_write_tokens") != 0) | (F.col("old_service_tier") != "default"), "already partly corrected")
        .when(unlike, "request and fact differ")
    )
    return rows.select("event_hash", reason.alias("reason")).where("reason IS NOT NULL")


def plan(rows: DataFrame) -> DataFrame:
    """By UTC day, model and key: events, and each measure before and after."""
    day = F.date_format(F.to_utc_timestamp(F.timestamp_millis("created_at"), F.current_timezone()), "yyyy-MM-dd")
    sums = [F.sum(x).cast("long").alias(f"{when}_{c}") for c in MEASURES for when, x in (("old", f"old_{c}"), ("new", c))]
    return rows.groupBy(day.alias("utc_day"), "model", "key_id").agg(F.count("*").alias("events"), *sums)


def apply(target: DataFrame, rows: DataFrame, prefix: str = "old_") -> DataFrame:
    """target after the change, and outcome: 'changed', 'kept', or 'stale' where a candidate's row no longer holds what the plan saw.

    A stale row is left as it is; whoever writes the result refuses it if there is any.
    """
    measured = (*MEASURES, "service_tier")
    new = rows.select("request_id", *[F.col(f"{prefix}{c}").alias(f"was_{c}") for c in measured], *[F.col(c).alias(f"new_{c}") for c in measured], F.lit(True).alias("planned"))
    both = target.join(new, "request_id", "left")
    same = F.lit(True)
    for c in measured:
        same &= F.col(c).eqNullSafe(F.col(f"was_{c}"))
    changes = F.col("planned").isNotNull() & same
    outcome = F.when(changes, "changed").when(F.col("planned").isNotNull(), "stale").otherwise("kept")
    values = [F.when(changes, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) if c in measured else F.col(c) for c in target.columns]
    return both.select(*values, outcome.alias("outcome"))


def identities(usage: DataFrame, aliases: DataFrame, tenant: str, unnamed: str = "Key ") -> DataFrame:
    """(api_key_hash, key_id, account_id, alias) for the hashes of events and of aliases, each once; ids are made again by a replay."""
    hashes = usage.select("api_key_hash").union(aliases.select("api_key_hash")).distinct().where(F.length("api_key_hash") == 64)
    made = {kind: uuid_of(F.concat_ws(":", F.lit(kind), F.lit(tenant), "api_key_hash")) for kind in ("key", "account")}
    alias = F.coalesce(blank_to_null(F.col("alias")), F.concat(F.lit(unnamed), F.substr("api_key_hash", F.lit(1), F.lit(8))))
    return hashes.join(aliases.select("api_key_hash", "alias"), "api_key_hash", "left").select("api_key_hash", made["key"].alias("key_id"), made["account"].alias("account_id"), alias.alias("alias"))


def staging_counts(usage: DataFrame, aliases: DataFrame) -> DataFrame:
    """One row: staged events, those without a key identity, and aliases without one."""
    bad = F.count_if(~F.coalesce(is_hex64(F.col("api_key_hash")), F.lit(False)))
    return usage.agg(F.count("*").alias("staged"), bad.alias("unmapped")).crossJoin(F.broadcast(aliases.agg(bad.alias("invalid_aliases"))))  # two rows of one


def generation_facts(jobs: DataFrame) -> DataFrame:
    """Facts of finished jobs; a job without a right end has no duration."""
    wrong = F.col("completed_at").isNull() | (F.col("completed_at") < F.col("created_at"))
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return jobs.where(F.col("status").isin("succeeded", "failed", "cancelled")).select(
        "job_id", "key_id", "created_at", "model", F.when(F.col("status") == "succeeded", "success").otherwise("failure").alias("status_class"), text("error_code"), text("upstream_account_id"),
        F.when(wrong, 0).otherwise(F.col("completed_at") - F.col("created_at")).cast("long").alias("duration_ms"), "cost_micros", F.coalesce("billed_units", F.lit(0)).cast("long").alias("billed_units"),
    )


def generation_daily(facts: DataFrame, day_ms: int = 86_400_000) -> DataFrame:
    keys = ("model", "status_class", "error_code", "upstream_account_id")
    sums = [F.sum(c).cast("long").alias(c) for c in ("billed_units", "cost_micros")]
    return facts.groupBy("key_id", F.floor(F.col("created_at") / day_ms).alias("day_bucket"), *keys).agg(F.count("*").alias("requests"), *sums)


def price_presence(usage: DataFrame, tiers: DataFrame) -> DataFrame:
    """By model and tier of events that cost: events, cost and the price that is held for them now; price_id is null where there is none."""
    held = tiers.groupBy("model", "service_tier").agg(F.max("price_id").alias("price_id"))
    sums = usage.groupBy("model", "service_tier").agg(F.count("*").alias("events"), F.sum("cost_micros").cast("long").alias("cost_micros"))
    return sums.join(held, ["model", "service_tier"], "left")


def refund_sums(items: DataFrame, allocations: DataFrame, facts: DataFrame, keys: dict[str, list]) -> dict[str, DataFrame]:
    """Refunds by account, by key, by key and day, by entitlement cycle, and by each set of rollup keys of the facts."""
    total = F.sum("refund_micros").cast("long").alias("refund_micros")
    day = F.floor(F.col("usage_created_at") / 86_400_000).alias("day_bucket")
    cycles = allocations.join(items.select("usage_entry_id"), "usage_entry_id", "left_semi").groupBy("cycle_id").agg(F.sum("amount_micros").cast("long").alias("refund_micros"))
    out = {"account": items.groupBy("account_id").agg(total), "key": items.groupBy("key_id").agg(total), "key_day": items.groupBy("key_id", day).agg(total), "cycle": cycles}
    rows = facts.join(items.select("request_id", "refund_micros"), "request_id")
    return out | {name: rows.groupBy(*by).agg(total) for name, by in keys.items()}


def ledger_mismatches(items: DataFrame, ledger: DataFrame) -> DataFrame:
    """Items whose use or refund entry is absent or says something else: (request_id, reason)."""
    def side(name: str) -> DataFrame:
        return ledger.select(F.col("id").alias(f"{name}_entry_id"), *[F.col(c).alias(f"{name}_{c}") for c in ("kind", "amount_micros", "account_id", "key_id", "reference_id")])

    both = items.join(side("usage"), "usage_entry_id", "left").join(side("refund"), "refund_entry_id", "left")
    def unlike(name: str, kind: str, amount):
        wrong = ~F.col(f"{name}_kind").eqNullSafe(F.lit(kind)) | ~F.col(f"{name}_amount_micros").eqNullSafe(amount)
        for c in ("account_id", "key_id"):
            wrong |= ~F.col(f"{name}_{c}").eqNullSafe(F.col(c))
        return wrong

    reason = (
        F.when(unlike("usage", "usage", -F.col("refund_micros")), "usage entry")
        .when(unlike("refund", "refund", F.col("refund_micros")), "refund entry")
        .when(~F.col("refund_reference_id").eqNullSafe(F.col("usage_entry_id")), "reference")
    )
    return both.select("request_id", reason.alias("reason")).where("reason IS NOT NULL")


def state_mismatches(items: DataFrame, ledger: DataFrame, state: DataFrame, by: list, name: str) -> DataFrame:
    """Of the keys that items touch (by), those whose settled state isn't use minus refunds: (relation, id, settled, expected)."""
    used = ledger.where("kind = 'usage'").groupBy(*by).agg((-F.sum("amount_micros")).alias("used"))
    refunded = items.groupBy(*by).agg(F.sum("refund_micros").alias("refunded"))
    both = refunded.join(used, by, "left").join(state, by, "left")
    expected = (F.coalesce("used", F.lit(0)) - F.col("refunded")).cast("long")
    key = F.concat_ws(":", *[F.col(c).cast("string") for c in by])
    return both.where(~F.col("settled_micros").eqNullSafe(expected)).select(F.lit(name).alias("relation"), key.alias("id"), "settled_micros", expected.alias("expected_micros"))


def plan_mismatches(plans: DataFrame, items: DataFrame) -> DataFrame:
    """Plans (plan_id, candidates, refund_micros) whose counts or sums aren't those of their items."""
    got = items.groupBy("plan_id").agg(F.count("*").alias("n"), F.sum("refund_micros").alias("total"))
    both = plans.join(got, "plan_id", "left")
    return both.where((F.col("candidates") != F.coalesce("n", F.lit(0))) | (F.col("refund_micros") != F.coalesce("total", F.lit(0)))).select("plan_id")


def usage_event_mismatches(items: DataFrame, events: DataFrame, since_ms: int) -> DataFrame:
    """Items used since a time whose refund is no budget event of its own with the same reservation, key, account, amount and time: (refund_entry_id)."""
    wanted = items.where(F.col("usage_created_at") >= since_ms).select(
        "refund_entry_id", "reservation_id", "key_id", "account_id", (-F.col("refund_micros")).alias("amount_micros"), F.col("usage_created_at").alias("settled_at")
    )
    key = ["refund_entry_id", "reservation_id", "key_id", "account_id", "amount_micros", "settled_at"]
    held = events.select(F.col("usage_entry_id").alias("refund_entry_id"), *key[1:]).distinct()
    return wanted.join(held, key, "left_anti").select("refund_entry_id")


def entitlement_mismatches(items: DataFrame, allocations: DataFrame, cycles: DataFrame) -> DataFrame:
    """Cycles that items' uses were allocated to, and which are absent or have consumed something else than all their allocations: (cycle_id)."""
    touched = allocations.join(items.select("usage_entry_id"), "usage_entry_id", "left_semi").select("cycle_id").distinct()
    sums = allocations.groupBy("cycle_id").agg(F.sum("amount_micros").cast("long").alias("_sum"))
    both = touched.join(sums, "cycle_id", "left").join(cycles.select("cycle_id", "consumed_micros", F.lit(True).alias("_there")), "cycle_id", "left")
    return both.where(F.col("_there").isNull() | ~F.col("consumed_micros").eqNullSafe(F.coalesce("_sum", F.lit(0)))).select("cycle_id")


DAILY_KEY = ("key_id", "day_bucket", "currency", "status_code")


def correction_daily_mismatches(items: DataFrame, daily: DataFrame) -> DataFrame:
    """Days of corrections that differ from their items, on either side: DAILY_KEY."""
    day = F.floor(F.col("request_created_at") / 86_400_000).cast("long").alias("day_bucket")
    due = items.groupBy("key_id", day, "currency", "status_code").agg(F.count("*").alias("_n"), F.sum("refund_micros").cast("long").alias("_sum"))
    both = due.join(daily, list(DAILY_KEY), "full_outer")
    return both.where(~F.col("adjustment_count").eqNullSafe(F.col("_n")) | ~F.col("refund_micros").eqNullSafe(F.col("_sum"))).select(*DAILY_KEY)


def rollup_mismatches(items: DataFrame, facts: DataFrame, rollup: DataFrame, by: list[str]) -> DataFrame:
    """Of the rollup rows that items touch, those whose cost isn't that of their facts less refunds: (by).

    Facts are summed once for all keys and cut down to the touched ones by a semi-join.
    """
    refunds = items.groupBy("request_id").agg(F.sum("refund_micros").cast("long").alias("_refund"))
    rows = facts.join(refunds, "request_id", "left")
    sums = rows.groupBy(*by).agg(F.sum(F.col("cost_micros") - F.coalesce("_refund", F.lit(0))).cast("long").alias("_cost"), F.count("_refund").alias("_touched"))
    both = sums.where("_touched > 0").join(rollup.select(*by, F.col("cost_micros").alias("_held")), by, "left")
    return both.where(~F.col("_held").eqNullSafe(F.col("_cost"))).select(*by)
