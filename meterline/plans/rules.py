"""Rating of events with faults of every kind, totals that generations are part of, resets and purges; each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators import purge, rating, rollups
from meterline.plans.usage import rated_sql
from meterline.sources import tables
from meterline.sources.tables import FACTS, duck

#: Usage with faults by the first letters of an event's hash, and prices that lack components.
_FAULTS = {
    "normalized_cache_read_tokens": "CASE WHEN substr(event_hash, 1, 2) = '01' THEN CAST(NULL AS BIGINT) ELSE normalized_cache_read_tokens END",
    "reasoning_tokens": "CASE WHEN substr(event_hash, 1, 2) = '02' THEN CAST(-1 AS BIGINT) ELSE reasoning_tokens END",
    "cache_read_tokens": "CASE WHEN substr(event_hash, 1, 2) = '03' THEN cache_read_tokens + 50 ELSE cache_read_tokens END",
    "cache_creation_tokens": "CASE WHEN substr(event_hash, 1, 2) = '04' THEN cache_creation_tokens + 3 ELSE cache_creation_tokens END",
    "normalized_uncached_input_tokens": "CASE WHEN substr(event_hash, 1, 1) = 'f' THEN CAST(0 AS BIGINT) ELSE normalized_uncached_input_tokens END",
    "normalized_total_input_tokens": "CASE WHEN substr(event_hash, 1, 1) = 'f' THEN normalized_cache_read_tokens + normalized_cache_creation_tokens ELSE normalized_total_input_tokens END",
    "output_tokens": "CASE WHEN substr(event_hash, 2, 1) < '8' THEN CAST(0 AS BIGINT) ELSE output_tokens END",
}
_KEPT = "event_hash, timestamp_ms, api_key_hash, provider, model, resolved_model, service_tier, input_tokens, cached_tokens, cache_tokens, separate_cache, latency_ms, failed, fail_status_code, normalized_cache_creation_tokens, total_tokens"
FAULTY = f"""SELECT f.*, greatest(greatest(cached_tokens, cache_tokens) - cache_read_tokens - cache_creation_tokens, CAST(0 AS BIGINT)) AS residual_cached_tokens
FROM (SELECT {_KEPT}, {', '.join(f'{v} AS {k}' for k, v in _FAULTS.items())} FROM ({tables.NORMALISED}) n) f"""
_PRICES = ", ".join(f"{c}_per_1m" for c in rating.COMPONENTS)
LACKING = f"""SELECT model, {_PRICES}, CASE WHEN b IN (6, 12, 20) THEN CAST(0 AS BIGINT) ELSE prompt_configured END AS prompt_configured, CASE WHEN b IN (13, 17) THEN CAST(0 AS BIGINT) ELSE completion_configured END AS completion_configured,
  cache_configured, cache_read_configured, cache_creation_configured, source FROM (SELECT *, CAST(substr(model, 7) AS BIGINT) AS b FROM ({tables.PRICES}) p) t"""
#: Service tiers under names with spaces and capitals, which count as plain ones.
SPELLED = tables.SERVICE_TIERS.replace("'fast' AS mode, 'priority' AS tier", "' Fast ' AS mode, 'Priority' AS tier")
RATES = ["prompt", "legacy_cache", "cache_read", "cache_creation", "output"]


def validation_rules(spark, sf_dir):
    """Each event with the first of the eleven rules that it breaks, and its rates."""
    usage = tables.view(spark, sf_dir, FAULTY, "lineitem", "orders", "part")
    prices, context, service = (tables.view(spark, sf_dir, sql, "part") for sql in (LACKING, tables.CONTEXT_TIERS, SPELLED))
    return rating.rate(usage, prices, context, service).select("event_hash", "validation_error", "pricing_rule", *[f"{r}_micros_per_million" for r in RATES])


#: Generation jobs out of orders; request facts out of events, some without a session.
GENERATIONS = """SELECT CAST(o_orderkey AS STRING) AS job_id, CAST(o_custkey % 1000 AS STRING) AS key_id, {days} * 86400000 + o_orderkey % 86400000 AS created_at, o_orderpriority AS model, CASE o_orderstatus WHEN 'F' THEN 'failure' ELSE 'success' END AS status_class,
  CASE o_orderstatus WHEN 'F' THEN 'http_500' ELSE '' END AS error_code, 'USD' AS currency, o_orderkey % 5 AS billed_units, o_orderkey % 977 AS duration_ms, CAST(round(o_totalprice * 100) AS BIGINT) AS cost_micros FROM {orders}"""
LINKED = f"SELECT f.request_id, key_id, created_at, model, protocol, status_class, error_code, currency, duration_ms, input_tokens, output_tokens, cached_input_tokens, cache_write_tokens, cost_micros, CASE WHEN input_tokens % 9 = 0 THEN '' ELSE session_id END AS session_id FROM ({FACTS}) f"


def _both(spark, sf_dir):
    return tables.view(spark, sf_dir, LINKED, "events"), tables.view(spark, sf_dir, GENERATIONS, "orders")


def session_usage(spark, sf_dir):
    return rollups.session_usage(*_both(spark, sf_dir))


def session_usage_daily(spark, sf_dir):
    return rollups.daily_usage(rollups.session_usage(*_both(spark, sf_dir), by_hour=True))


_UNIT = """SELECT key_id, coalesce(nullif(session_id, ''), 'unlinked:' || key_id) AS session_id, currency, created_at, model, CASE WHEN protocol = 'anthropic' OR protocol LIKE 'anthropic-%' THEN 'anthropic' WHEN protocol = 'openai-image' THEN protocol ELSE 'openai' END AS protocol, status_class, error_code,
  greatest(input_tokens - cached_input_tokens - cache_write_tokens, 0) AS input_tokens, output_tokens, cached_input_tokens, cache_write_tokens, 0 AS billed_units, duration_ms, cost_micros FROM ({linked}) f
UNION ALL SELECT key_id, 'unlinked:' || key_id, currency, created_at, model, 'generation', status_class, error_code, 0, 0, 0, 0, billed_units, duration_ms, cost_micros FROM ({generations}) g"""
_SUMS = """count(*) AS requests, count(*) FILTER (WHERE status_class = 'failure') AS errors, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens, CAST(sum(cached_input_tokens) AS BIGINT) AS cached_input_tokens,
  CAST(sum(cache_write_tokens) AS BIGINT) AS cache_write_tokens, CAST(sum(billed_units) AS BIGINT) AS generation_units, count(*) AS duration_count, CAST(sum(duration_ms) AS BIGINT) AS duration_sum_ms, CAST(sum(cost_micros) AS BIGINT) AS cost_micros"""
_WITH_UNITS = f"WITH u AS ({_UNIT.format(linked=duck(LINKED), generations=duck(GENERATIONS))})"


def ordered_reset(spark, sf_dir):
    """What a reset of one nation's customers takes from three tables, children first, and the guards that forbid it."""
    read = lambda t: tables.read(spark, sf_dir, t)
    orders, lines, customers = read("orders"), read("lineitem").select("l_orderkey", "l_linenumber"), read("customer")
    steps = [
        purge.Step("lineitem", lines, "l_orderkey", "orders", "o_orderkey"), purge.Step("orders", orders, "o_custkey", "customer", "c_custkey"),
        purge.Step("customer", customers, "c_nationkey", "owned", "nation"),
    ]
    owned = read("nation").where("n_name LIKE '%3'").select(F.col("n_nationkey").alias("nation"))
    guards = {"open orders": ("orders", "o_orderstatus = 'P'"), "rich customers": ("customer", "c_acctbal > 1000000")}
    done = purge.ordered_reset(steps, {"owned": owned}, guards)
    return done.receipt


RESET_SQL = """WITH c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name LIKE '%3')), o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)), l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o))
SELECT 1 AS step, 'lineitem' AS name, (SELECT count(*) FROM l) AS deleted, (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM l) AS kept, 'delete' AS kind
UNION ALL SELECT 2, 'orders', (SELECT count(*) FROM o), (SELECT count(*) FROM orders) - (SELECT count(*) FROM o), 'delete' UNION ALL SELECT 3, 'customer', (SELECT count(*) FROM c), (SELECT count(*) FROM customer) - (SELECT count(*) FROM c), 'delete'
UNION ALL SELECT 4, 'open orders', (SELECT count(*) FROM o WHERE o_orderstatus = 'P'), CAST(NULL AS BIGINT), 'guard' UNION ALL SELECT 4, 'rich customers', (SELECT count(*) FROM c WHERE c_acctbal > 1000000), CAST(NULL AS BIGINT), 'guard'"""


def exact_purge(spark, sf_dir):
    """Receipts of purging toxic documents: as expected (a dry run and an applied one), again with that receipt, and with a cohort that differs."""
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", "source")
    toxic = tables.read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    held = docs.join(toxic, "doc_id", "left_semi").select("doc_id")
    dry = purge.exact_purge(docs, toxic, held, ["doc_id"], docs.where("source IS NOT NULL"))
    applied = purge.exact_purge(docs, toxic, held, ["doc_id"], docs.where("source IS NOT NULL"), dry_run=False)
    again = purge.exact_purge(applied.left, toxic, held, ["doc_id"], applied.left.where("source IS NOT NULL"), dry_run=False, receipts=applied.receipt)
    other = purge.exact_purge(docs, toxic, held.where("doc_id % 2 = 0"), ["doc_id"], docs, dry_run=False)
    out = None
    for name, p in (("dry", dry), ("applied", applied), ("again", again), ("other", other)):
        row = p.receipt.drop("cohort_digest").withColumn("run", F.lit(name)).withColumn("left", F.lit(p.left.count()))
        out = row if out is None else out.unionByName(row)
    return out


PURGE_SQL = """WITH t AS (SELECT doc_id FROM labels WHERE toxic = 1 GROUP BY 1), n AS (SELECT (SELECT count(*) FROM documents) AS docs, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM t)) AS bad, (SELECT count(*) FROM documents WHERE source IS NOT NULL) AS named,
  (SELECT count(*) FROM documents WHERE source IS NOT NULL AND doc_id IN (SELECT doc_id FROM t)) AS named_bad, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM t) AND doc_id % 2 = 0) AS even)
SELECT 'dry' AS run, 'planned' AS outcome, bad AS expected, bad AS found, 0 AS missing, 0 AS unexpected, bad AS deleted, named AS protected_before, named - named_bad AS protected_after, docs AS left FROM n
UNION ALL SELECT 'applied', 'applied', bad, bad, 0, 0, bad, named, named - named_bad, docs - bad FROM n
UNION ALL SELECT 'again', 'already', bad, 0, bad, 0, 0, named - named_bad, named - named_bad, docs - bad FROM n
UNION ALL SELECT 'other', 'cohort differs', even, bad, 0, bad - even, 0, docs, docs, docs FROM n"""

QUERIES = {"validation_rules": validation_rules, "session_usage": session_usage, "session_usage_daily": session_usage_daily, "ordered_reset": ordered_reset, "exact_purge": exact_purge}
ORACLE_SQL = {
    "validation_rules": f"WITH {rated_sql(FAULTY, LACKING, service=SPELLED)} SELECT event_hash, validation_error, pricing_rule, {', '.join(f'{r}_micros_per_million' for r in RATES)} FROM rated",
    "session_usage": f"{_WITH_UNITS} SELECT key_id, session_id, currency, max(created_at) AS last_activity_at, {_SUMS} FROM u GROUP BY 1, 2, 3",
    "session_usage_daily": f"{_WITH_UNITS} SELECT key_id, session_id, created_at // 86400000 AS day_bucket, model, protocol, status_class, error_code, currency, {_SUMS} FROM u GROUP BY 1, 2, 3, 4, 5, 6, 7, 8",
    "ordered_reset": RESET_SQL, "exact_purge": PURGE_SQL,
}
