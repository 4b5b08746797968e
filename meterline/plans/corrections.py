"""Queries of corrections, identities, generations and refund checks, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS
from meterline.operators import correction
from meterline.sources import tables
from meterline.sources.tables import duck

REVISION = "cache-pricing-2"
#: Requests as the older rules wrote them; some have another currency, or were changed since.
STATE = f"""
SELECT request_id, n, key_id, created_at, model, CASE WHEN n % 17 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
  input_tokens, CASE WHEN n % 19 = 0 THEN CAST(3 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS cached_input_tokens,
  CAST(0 AS BIGINT) AS cache_write_tokens, 'default' AS service_tier, cost_micros
FROM (SELECT *, CAST(request_id AS BIGINT) AS n FROM ({tables.FACTS}) f) t"""
#: The same events under the newer rules. Digests of some did not change.
EVALUATED = f"""
SELECT request_id AS event_hash, 'o' || request_id AS legacy_digest,
  CASE WHEN n % 9 = 0 THEN 'o' || request_id ELSE 'n' || request_id END AS source_digest,
  input_tokens + 7 AS input_tokens, cached_input_tokens, cache_write_tokens, service_tier, cost_micros + 5 AS cost_micros
FROM (SELECT *, CAST(request_id AS BIGINT) AS n FROM ({tables.FACTS}) f) t"""
LINKS = f"""
SELECT request_id AS event_hash, request_id, CASE WHEN n % 5 = 0 THEN 'n' || request_id ELSE 'o' || request_id END AS source_digest, n
FROM (SELECT *, CAST(request_id AS BIGINT) AS n FROM ({tables.FACTS}) f) t"""


def _view(spark, sf_dir, sql):
    return tables.view(spark, sf_dir, sql, "events")


def _candidates(spark, sf_dir):
    state, links = _view(spark, sf_dir, STATE), _view(spark, sf_dir, LINKS)
    audits = links.where("n % 11 = 0").select("event_hash", F.lit(REVISION).alias("revision"))
    facts = state.withColumn("cost_micros", F.when(F.col("n") % 13 == 0, F.col("cost_micros") + 1).otherwise(F.col("cost_micros")))
    return correction.candidates(_view(spark, sf_dir, EVALUATED), links, state, facts, audits, REVISION)


CANDIDATES = f"""WITH state AS ({duck(STATE)}), evaluated AS ({duck(EVALUATED)}), links AS ({duck(LINKS)}),
c AS (SELECT s.*, e.input_tokens AS new_input, e.cached_input_tokens AS new_cached, e.cache_write_tokens AS new_write,
    e.service_tier AS new_tier, e.cost_micros AS new_cost, CASE WHEN s.n % 13 = 0 THEN 1 ELSE 0 END AS apart
  FROM state s JOIN links l USING (request_id) JOIN evaluated e ON e.event_hash = l.event_hash
  WHERE l.source_digest = e.legacy_digest AND l.source_digest <> e.source_digest AND s.n % 11 <> 0)"""


def correction_plan(spark, sf_dir):
    return correction.plan(_candidates(spark, sf_dir))


CORRECTION_PLAN_SQL = f"""{CANDIDATES}
SELECT strftime(epoch_ms(created_at), '%Y-%m-%d') AS utc_day, model, key_id, count(*) AS events,
  CAST(sum(input_tokens) AS BIGINT) AS old_input_tokens, CAST(sum(new_input) AS BIGINT) AS new_input_tokens,
  CAST(sum(cached_input_tokens) AS BIGINT) AS old_cached_input_tokens, CAST(sum(new_cached) AS BIGINT) AS new_cached_input_tokens,
  CAST(sum(cache_write_tokens) AS BIGINT) AS old_cache_write_tokens, CAST(sum(new_write) AS BIGINT) AS new_cache_write_tokens,
  CAST(sum(cost_micros) AS BIGINT) AS old_cost_micros, CAST(sum(new_cost) AS BIGINT) AS new_cost_micros
FROM c GROUP BY ALL"""


def correction_guard(spark, sf_dir):
    return correction.guard(_candidates(spark, sf_dir))


CORRECTION_GUARD_SQL = f"""{CANDIDATES}
SELECT * FROM (SELECT request_id AS event_hash, CASE WHEN currency <> 'USD' THEN 'currency'
  WHEN cached_input_tokens <> 0 THEN 'already partly corrected' WHEN apart = 1 THEN 'request and fact differ' END AS reason FROM c) t
WHERE reason IS NOT NULL"""


def correction_apply(spark, sf_dir):
    """Requests after the change; some moved on since the plan was made, and stay."""
    moved = _view(spark, sf_dir, STATE).withColumn("cost_micros", F.when(F.col("n") % 23 == 0, F.col("cost_micros") + 2).otherwise(F.col("cost_micros")))
    out = correction.apply(moved, _candidates(spark, sf_dir))
    return out.select("request_id", "input_tokens", "cached_input_tokens", "service_tier", "cost_micros", "outcome")


CORRECTION_APPLY_SQL = f"""{CANDIDATES}, moved AS (SELECT *, CASE WHEN n % 23 = 0 THEN 2 ELSE 0 END AS moved_by FROM state),
m AS (SELECT m.*, c.new_input, c.new_cached, c.new_tier, c.new_cost, c.request_id IS NOT NULL AS planned,
    c.request_id IS NOT NULL AND moved_by = 0 AS changes FROM moved m LEFT JOIN c USING (request_id))
SELECT request_id, CASE WHEN changes THEN new_input ELSE input_tokens END AS input_tokens,
  CASE WHEN changes THEN new_cached ELSE cached_input_tokens END AS cached_input_tokens,
  CASE WHEN changes THEN new_tier ELSE service_tier END AS service_tier,
  CASE WHEN changes THEN new_cost ELSE cost_micros + moved_by END AS cost_micros,
  CASE WHEN changes THEN 'changed' WHEN planned THEN 'stale' ELSE 'kept' END AS outcome FROM m"""

HASHES = "SELECT CASE WHEN user_id % 29 = 0 THEN 'x' || CAST(user_id AS STRING) ELSE {sha} END AS api_key_hash, user_id FROM {events}"


def _hashes(spark, sf_dir):
    usage = tables.view(spark, sf_dir, HASHES.replace("{sha}", "sha2(CAST(user_id AS STRING), 256)"), "events")
    own = tables.read(spark, sf_dir, "customer").select(F.sha2(F.col("c_custkey").cast("string"), 256).alias("api_key_hash"), "c_custkey")
    n = F.col("c_custkey") % 4
    aliases = own.select(F.when(F.col("c_custkey") % 31 == 0, "short").otherwise(F.col("api_key_hash")).alias("api_key_hash"), F.when(n == 0, "").otherwise(F.concat(F.lit("k"), "c_custkey")).alias("alias"))
    return usage, aliases


HASHES_CTE = "WITH usage AS (" + duck(HASHES).replace("{sha}", "sha256(CAST(user_id AS VARCHAR))") + """),
aliases AS (SELECT CASE WHEN c_custkey % 31 = 0 THEN 'short' ELSE sha256(CAST(c_custkey AS VARCHAR)) END AS api_key_hash,
  CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'k' || c_custkey END AS alias FROM customer)"""


def import_identities(spark, sf_dir):
    usage, aliases = _hashes(spark, sf_dir)
    return correction.identities(usage, aliases, "main")


def _uuid(h: str) -> str:
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-a' || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)"


IDENTITIES_SQL = f"""{HASHES_CTE}, h AS (SELECT api_key_hash, md5('key:main:' || api_key_hash) AS k, md5('account:main:' || api_key_hash) AS a
  FROM (SELECT api_key_hash FROM usage UNION SELECT api_key_hash FROM aliases) t WHERE length(api_key_hash) = 64)
SELECT api_key_hash, {_uuid('k')} AS key_id, {_uuid('a')} AS account_id,
  coalesce(nullif(alias, ''), 'Key ' || substr(api_key_hash, 1, 8)) AS alias FROM h LEFT JOIN aliases USING (api_key_hash)"""


def staging_counts(spark, sf_dir):
    return correction.staging_counts(*_hashes(spark, sf_dir))


STAGING_SQL = f"""{HASHES_CTE} SELECT count(*) AS staged, count(*) FILTER (WHERE api_key_hash LIKE 'x%') AS unmapped,
  (SELECT count(*) FROM aliases WHERE api_key_hash = 'short') AS invalid_aliases FROM usage"""

JOBS = f"""
SELECT request_id AS job_id, key_id, created_at, model, CASE n % 5 WHEN 0 THEN 'succeeded' WHEN 1 THEN 'failed' WHEN 2 THEN 'cancelled' WHEN 3 THEN 'running' ELSE 'succeeded' END AS status,
  CASE WHEN n % 5 = 1 THEN error_code END AS error_code, CASE WHEN n % 3 = 0 THEN 'u' || key_id END AS upstream_account_id,
  CASE WHEN n % 7 = 0 THEN NULL WHEN n % 11 = 0 THEN created_at - 1 ELSE created_at + duration_ms END AS completed_at,
  cost_micros, CASE WHEN n % 6 = 0 THEN NULL ELSE n % 4 END AS billed_units
FROM (SELECT *, CAST(request_id AS BIGINT) AS n FROM ({tables.FACTS}) f) t"""


def generation_facts(spark, sf_dir):
    return correction.generation_facts(_view(spark, sf_dir, JOBS))


def generation_daily(spark, sf_dir):
    return correction.generation_daily(generation_facts(spark, sf_dir))


GENERATIONS = f"""WITH facts AS (SELECT job_id, key_id, created_at, model, CASE WHEN status = 'succeeded' THEN 'success' ELSE 'failure' END AS status_class,
  coalesce(error_code, '') AS error_code, coalesce(upstream_account_id, '') AS upstream_account_id,
  CASE WHEN completed_at IS NULL OR completed_at < created_at THEN 0 ELSE completed_at - created_at END AS duration_ms,
  cost_micros, coalesce(billed_units, 0) AS billed_units FROM ({duck(JOBS)}) t WHERE status IN ('succeeded', 'failed', 'cancelled'))"""
GENERATION_DAILY_SQL = f"""{GENERATIONS} SELECT key_id, created_at // {DAY_MS} AS day_bucket, model, status_class, error_code, upstream_account_id,
  count(*) AS requests, CAST(sum(billed_units) AS BIGINT) AS billed_units, CAST(sum(cost_micros) AS BIGINT) AS cost_micros FROM facts GROUP BY ALL"""


def price_presence(spark, sf_dir):
    facts = tables.facts(spark, sf_dir)
    tiers = facts.where("service_tier <> 'flex' OR model = 'view'").groupBy("model", "service_tier").agg(F.max("key_id").alias("price_id"))
    return correction.price_presence(facts.where("cost_micros > 0"), tiers)


PRICE_PRESENCE_SQL = f"""WITH facts AS ({duck(tables.FACTS)}),
tiers AS (SELECT model, service_tier, max(key_id) AS price_id FROM facts WHERE service_tier <> 'flex' OR model = 'view' GROUP BY 1, 2)
SELECT model, service_tier, count(*) AS events, CAST(sum(cost_micros) AS BIGINT) AS cost_micros, max(price_id) AS price_id
FROM facts LEFT JOIN tiers USING (model, service_tier) WHERE cost_micros > 0 GROUP BY 1, 2"""

#: Refund items of failed requests, and the ledger that they were written to, with faults.
ITEMS = f"""
SELECT request_id, 'p' || CAST(n % 50 AS STRING) AS plan_id, 'a' || key_id AS account_id, key_id, created_at, created_at AS usage_created_at,
  'u' || request_id AS usage_entry_id, 'r' || request_id AS refund_entry_id, cost_micros AS refund_micros, n
FROM (SELECT *, CAST(request_id AS BIGINT) AS n FROM ({tables.FACTS}) f) t WHERE status_class = 'failure'"""
LEDGER = f"""
SELECT 'u' || request_id AS id, 'usage' AS kind, -cost_micros AS amount_micros, 'a' || key_id AS account_id, key_id, CAST(NULL AS STRING) AS reference_id, created_at
FROM (SELECT *, CAST(request_id AS BIGINT) AS n FROM ({tables.FACTS}) f) t WHERE NOT (status_class = 'failure' AND n % 7 = 0)
UNION ALL SELECT refund_entry_id, CASE WHEN n % 5 = 0 THEN 'grant' ELSE 'refund' END, refund_micros, account_id, key_id,
  CASE WHEN n % 3 = 0 THEN 'x' ELSE usage_entry_id END, created_at FROM ({ITEMS}) i"""


def refund_ledger_mismatches(spark, sf_dir):
    return correction.ledger_mismatches(_view(spark, sf_dir, ITEMS), _view(spark, sf_dir, LEDGER))


LEDGER_SQL = f"""SELECT * FROM (SELECT request_id, CASE WHEN n % 7 = 0 THEN 'usage entry' WHEN n % 5 = 0 THEN 'refund entry' WHEN n % 3 = 0 THEN 'reference' END AS reason
FROM ({duck(ITEMS)}) t) u WHERE reason IS NOT NULL"""


def refund_state_mismatches(spark, sf_dir):
    """Accounts, keys and days whose settled state isn't use minus refunds; states with faults, and states that lack."""
    items, ledger = _view(spark, sf_dir, ITEMS), _view(spark, sf_dir, LEDGER)
    day = F.floor(F.col("created_at") / DAY_MS).alias("day_bucket")
    items, ledger = items.withColumn("day_bucket", day), ledger.withColumn("day_bucket", day)
    out = None
    for name, by in (("account", ["account_id"]), ("key", ["key_id"]), ("key day", ["key_id", "day_bucket"])):
        used = ledger.where("kind = 'usage'").groupBy(*by).agg((-F.sum("amount_micros")).alias("used")).join(items.groupBy(*by).agg(F.sum("refund_micros").alias("back")), by, "left")
        right = (F.col("used") - F.coalesce("back", F.lit(0))).cast("long")
        n = F.pmod(F.abs(right), F.lit(10))
        state = used.where(n != 3).select(*by, F.when(n == 4, right + 1).otherwise(right).alias("settled_micros"))
        part = correction.state_mismatches(items, ledger, state, by, name)
        out = part if out is None else out.unionByName(part)
    return out.groupBy("relation").agg(F.count("*").alias("n"), F.sum("expected_micros").cast("long").alias("expected_micros"))


def _state_sql(name: str, by: str) -> str:
    return f"""SELECT '{name}' AS relation, count(*) AS n, CAST(sum(e) AS BIGINT) AS expected_micros FROM (
  SELECT {by}, coalesce(used, 0) - back AS e, used FROM (SELECT {by}, sum(refund_micros) AS back FROM i GROUP BY ALL) a
  LEFT JOIN (SELECT {by}, -sum(amount_micros) AS used FROM l WHERE kind = 'usage' GROUP BY ALL) b USING ({by})) t WHERE used IS NULL OR abs(e) % 10 IN (3, 4)"""


STATE_SQL = f"""WITH i AS (SELECT *, created_at // {DAY_MS} AS day_bucket FROM ({duck(ITEMS)}) t), l AS (SELECT *, created_at // {DAY_MS} AS day_bucket FROM ({duck(LEDGER)}) t)
SELECT * FROM ({_state_sql('account', 'account_id')} UNION ALL {_state_sql('key', 'key_id')} UNION ALL {_state_sql('key day', 'key_id, day_bucket')}) t WHERE n > 0"""


def refund_plan_mismatches(spark, sf_dir):
    items = _view(spark, sf_dir, ITEMS)
    n = F.substr("plan_id", F.lit(2)).cast("int")
    told = items.groupBy("plan_id").agg(F.count("*").alias("candidates"), F.sum("refund_micros").alias("refund_micros"))
    told = told.withColumn("candidates", F.when(n % 4 == 0, F.col("candidates") + 1).otherwise(F.col("candidates"))).withColumn("refund_micros", F.when(n % 6 == 0, F.col("refund_micros") - 1).otherwise(F.col("refund_micros")))
    empty = spark.createDataFrame([("p none", 1, 5)], "plan_id string, candidates long, refund_micros long")
    return correction.plan_mismatches(told.unionByName(empty), items)


PLAN_MISMATCHES_SQL = f"""SELECT DISTINCT plan_id FROM ({duck(ITEMS)}) t WHERE CAST(substr(plan_id, 2) AS INT) % 4 = 0 OR CAST(substr(plan_id, 2) AS INT) % 6 = 0
UNION ALL SELECT 'p none'"""


def refund_sums(spark, sf_dir):
    """Refunds along all the dimensions that are lowered by them; one row each with how many keys and how much."""
    items = _view(spark, sf_dir, ITEMS)
    allocations = items.select("usage_entry_id", F.concat(F.lit("c"), (F.col("n") % 9).cast("string")).alias("cycle_id"), (F.col("refund_micros") - 1).alias("amount_micros"))
    facts = tables.facts(spark, sf_dir).withColumn("hour_bucket", F.floor(F.col("created_at") / 3_600_000))
    sums = correction.refund_sums(items, allocations, facts, {"hourly": ["key_id", "hour_bucket", "model", "status_class", "error_code", "service_tier", "currency"], "model": ["model", "protocol"]})
    out = None
    for name, part in sums.items():
        part = part.agg(F.count("*").alias("groups"), F.sum("refund_micros").cast("long").alias("refund_micros")).select(F.lit(name).alias("relation"), "groups", "refund_micros")
        out = part if out is None else out.unionByName(part)
    return out


def _sums_sql(name: str, by: str, amount: str = "refund_micros") -> str:
    return f"SELECT '{name}' AS relation, count(DISTINCT ({by})) AS groups, CAST(sum({amount}) AS BIGINT) AS refund_micros FROM i"


REFUND_SUMS_SQL = f"""WITH i AS (SELECT i.*, model, protocol, status_class, error_code, service_tier, currency FROM ({duck(ITEMS)}) i JOIN ({duck(tables.FACTS)}) f USING (request_id))
{_sums_sql('account', 'account_id')} UNION ALL {_sums_sql('key', 'key_id')} UNION ALL {_sums_sql('key_day', f'key_id, usage_created_at // {DAY_MS}')}
UNION ALL {_sums_sql('cycle', 'n % 9', 'refund_micros - 1')} UNION ALL {_sums_sql('model', 'model, protocol')}
UNION ALL {_sums_sql('hourly', 'key_id, usage_created_at // 3600000, model, status_class, error_code, service_tier, currency')}"""

QUERIES = {
    "correction_plan": correction_plan, "correction_guard": correction_guard, "correction_apply": correction_apply, "import_identities": import_identities, "staging_counts": staging_counts,
    "generation_facts": generation_facts, "generation_daily": generation_daily, "price_presence": price_presence, "refund_ledger_mismatches": refund_ledger_mismatches,
    "refund_state_mismatches": refund_state_mismatches, "refund_plan_mismatches": refund_plan_mismatches, "refund_sums": refund_sums,
}
ORACLE_SQL = {
    "correction_plan": CORRECTION_PLAN_SQL, "correction_guard": CORRECTION_GUARD_SQL, "correction_apply": CORRECTION_APPLY_SQL, "import_identities": IDENTITIES_SQL, "staging_counts": STAGING_SQL,
    "generation_facts": f"{GENERATIONS} SELECT * FROM facts", "generation_daily": GENERATION_DAILY_SQL, "price_presence": PRICE_PRESENCE_SQL, "refund_ledger_mismatches": LEDGER_SQL,
    "refund_state_mismatches": STATE_SQL, "refund_plan_mismatches": PLAN_MISMATCHES_SQL, "refund_sums": REFUND_SUMS_SQL,
}
