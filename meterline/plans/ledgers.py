"""Queries of refunds, receipts and inventories, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS
from meterline.operators import inventory, receipts, refunds
from meterline.sources import tables
from meterline.sources.tables import duck

#: Requests, their keys, facts, reservations and ledger, out of orders, with faults by order key.
REQUESTS = "SELECT 'q' || CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS key_id, 'v' || CAST(o_orderkey AS STRING) AS reservation_id, {days} * 86400000 AS created_at, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE {days} * 86400000 + 5 END AS completed_at, CAST(CASE o_orderstatus WHEN 'F' THEN 502 WHEN 'P' THEN 503 ELSE CASE WHEN o_orderkey % 2 = 0 THEN 200 ELSE 504 END END AS BIGINT) AS status_code, 'USD' AS currency, CASE WHEN o_orderkey % 17 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS cost_micros, o_orderkey FROM {orders}"
KEYS = "SELECT CAST(c_custkey AS STRING) AS id, 'a' || CAST(c_custkey % 50 AS STRING) AS account_id, CASE WHEN c_custkey % 29 = 0 THEN 'EUR' ELSE 'USD' END AS currency FROM {customer} WHERE c_custkey % 37 <> 5"
FACTS = "SELECT id AS request_id, key_id, created_at, cost_micros + CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END AS cost_micros FROM (" + REQUESTS + ") r WHERE o_orderkey % 23 <> 0"
RESERVATIONS = "SELECT reservation_id AS id, 'a' || CAST(CAST(key_id AS BIGINT) % 50 AS STRING) AS account_id, key_id, CASE WHEN o_orderkey % 31 = 0 THEN 'open' ELSE 'settled' END AS status, cost_micros AS actual_micros FROM (" + REQUESTS + ") r"
LEDGER = (
    "SELECT 'l' || CAST(o_orderkey AS STRING) AS id, 'a' || CAST(CAST(key_id AS BIGINT) % 50 AS STRING) AS account_id, key_id, 'usage' AS kind, currency, reservation_id AS source, CAST(NULL AS STRING) AS reference_entry_id, -cost_micros AS amount_micros, created_at FROM (" + REQUESTS + ") r WHERE o_orderkey % 43 <> 0"
    " UNION ALL SELECT 'f' || CAST(o_orderkey AS STRING), 'a' || CAST(CAST(key_id AS BIGINT) % 50 AS STRING), key_id, 'failed_request_refund', currency, reservation_id, 'l' || CAST(o_orderkey AS STRING), cost_micros, created_at FROM (" + REQUESTS + ") r WHERE o_orderkey % 13 = 0"
)
ALLOCATIONS = "SELECT 'l' || CAST(o_orderkey AS STRING) AS usage_ledger_id, CAST(round(o_totalprice * 100) AS BIGINT) * 2 AS amount_micros FROM {orders} WHERE o_orderkey % 47 = 0"
FROM_MS, TO_MS = 800_000_000_000, 990_000_000_000
PLAN_ID = "plan-1"


def _classified(spark, sf_dir):
    v = lambda sql, *t: tables.view(spark, sf_dir, sql, *t)
    requests = refunds.scoped(v(REQUESTS, "orders"), FROM_MS, TO_MS)
    observed = refunds.observe(requests, v(KEYS, "customer"), v(FACTS, "orders"), v(RESERVATIONS, "orders"), v(LEDGER, "orders"), v(ALLOCATIONS, "orders"))
    return refunds.classify(observed)


CLASSIFIED = f"""WITH requests AS ({duck(REQUESTS)}), keys AS ({duck(KEYS)}), facts AS ({duck(FACTS)}), reservations AS ({duck(RESERVATIONS)}), ledger AS ({duck(LEDGER)}), allocations AS ({duck(ALLOCATIONS)}),
scoped AS (SELECT * FROM requests WHERE created_at >= {FROM_MS} AND created_at < {TO_MS} AND completed_at IS NOT NULL AND status_code IN (499, 502, 503)),
classified AS (SELECT r.*, k.account_id, CASE WHEN k.account_id IS NULL THEN 'key_record_missing_or_tenant_mismatch' WHEN r.cost_micros <= 0 THEN 'already_zero_cost' WHEN f.request_id IS NULL THEN 'request_stats_fact_count' WHEN f.cost_micros <> r.cost_micros THEN 'request_stats_cost_mismatch'
  WHEN v.status <> 'settled' THEN 'usage_reservation_not_settled' WHEN l.id IS NULL THEN 'usage_ledger_count' WHEN k.currency <> r.currency THEN 'currency_mismatch' WHEN p.id IS NOT NULL THEN 'already_adjusted' WHEN a.amount_micros > r.cost_micros THEN 'entitlement_allocation_mismatch' ELSE 'eligible' END AS classification
  FROM scoped r LEFT JOIN keys k ON k.id = r.key_id LEFT JOIN facts f ON f.request_id = r.id LEFT JOIN reservations v ON v.id = r.reservation_id LEFT JOIN ledger l ON l.source = r.reservation_id AND l.kind = 'usage'
  LEFT JOIN ledger p ON p.reference_entry_id = l.id AND p.kind <> 'usage' LEFT JOIN allocations a ON a.usage_ledger_id = l.id),
entries AS (SELECT *, md5('refund:{PLAN_ID}:' || id) AS h FROM classified WHERE classification = 'eligible')"""


def refund_evidence(spark, sf_dir):
    return _classified(spark, sf_dir).select("id", "classification", "cost_micros")


def refund_blockers(spark, sf_dir):
    return refunds.blockers(_classified(spark, sf_dir))


def _plan(spark, sf_dir):
    return refunds.plan(_classified(spark, sf_dir), PLAN_ID)


def refund_plan(spark, sf_dir):
    return _plan(spark, sf_dir).drop("kind", "source")


def refund_deltas(spark, sf_dir):
    return refunds.deltas(_plan(spark, sf_dir), ["key_id", "day_bucket"])


def refund_apply(spark, sf_dir):
    """Balances by account after a plan, which is applied twice."""
    entries = _plan(spark, sf_dir)
    after = refunds.apply(refunds.apply(tables.view(spark, sf_dir, LEDGER, "orders"), entries), entries)
    return after.groupBy("account_id").agg(F.count("*").alias("entries"), F.sum("amount_micros").alias("balance_micros"))


def refund_rebuild(spark, sf_dir):
    return refunds.rebuilt(tables.view(spark, sf_dir, FACTS, "orders"), _plan(spark, sf_dir), ["key_id", "day_bucket"])


def refund_verify(spark, sf_dir):
    """Touched keys whose lowered rollup is not the rebuilt one: a fault is planted on every fifth day."""
    facts, entries = tables.view(spark, sf_dir, FACTS, "orders"), _plan(spark, sf_dir)
    keys = ["key_id", "day_bucket"]
    at_rest = facts.withColumn("day_bucket", F.floor(F.col("created_at") / DAY_MS).cast("long")).groupBy(*keys).agg(F.sum("cost_micros").cast("long").alias("cost_micros"))
    lowered = refunds.lowered(at_rest, entries, keys).join(refunds.deltas(entries, keys).select(*keys), keys, "left_semi")
    lowered = lowered.withColumn("cost_micros", F.when(F.col("day_bucket") % 5 == 0, F.col("cost_micros") + 3).otherwise(F.col("cost_micros")))
    return refunds.mismatches(refunds.rebuilt(facts, entries, keys), lowered, keys, "cost_micros")


def three_way(spark, sf_dir):
    facts = tables.view(spark, sf_dir, FACTS, "orders").select("key_id", F.lit("m").alias("model"), "created_at", "cost_micros")
    requests = tables.view(spark, sf_dir, REQUESTS, "orders").select("key_id", F.lit("m").alias("model"), "created_at", "cost_micros")
    provenance = tables.view(spark, sf_dir, RESERVATIONS.replace("reservation_id AS id", "created_at"), "orders").select("key_id", F.lit("m").alias("model"), "created_at", F.col("actual_micros").alias("cost_micros"))
    return receipts.three_way(provenance, requests, facts)


THREE_WAY_SQL = f"""WITH requests AS ({duck(REQUESTS)}), facts AS ({duck(FACTS)}), sides AS (SELECT key_id, created_at, cost_micros AS r, NULL AS f FROM requests UNION ALL SELECT key_id, created_at, NULL, cost_micros FROM facts)
SELECT key_id, 'm' AS model, created_at // {DAY_MS} AS day_bucket, count(r) AS provenance_count, CAST(coalesce(sum(r), 0) AS BIGINT) AS provenance_cost, count(r) AS request_count, CAST(coalesce(sum(r), 0) AS BIGINT) AS request_cost, count(f) AS fact_count, CAST(coalesce(sum(f), 0) AS BIGINT) AS fact_cost,
count(r) = count(f) AND coalesce(sum(r), 0) = coalesce(sum(f), 0) AS agrees FROM sides GROUP BY ALL"""


def audit(spark, sf_dir):
    rows = tables.view(spark, sf_dir, REQUESTS, "orders")
    return receipts.audit(rows, {"unfinished": F.col("completed_at").isNull(), "failed": ~F.col("status_code").between(200, 399), "free": F.col("cost_micros") == 0})


def coverage(spark, sf_dir):
    """Order keys of lines against those of orders that are not pending."""
    return receipts.coverage(tables.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")), tables.read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("k")), ["k"])


def object_inventory(spark, sf_dir):
    docs = tables.read(spark, sf_dir, "documents")
    locator = F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 5 == 1, F.concat(F.lit("gap://usage/"), "doc_id")).when(F.col("doc_id") % 5 == 2, "inline-json:{}").otherwise(F.concat(F.lit("objects/"), "doc_id"))
    return receipts.inventory(docs.select(F.col("source").alias("kind"), locator.alias("locator"), F.col("text").alias("body")))


def output_tokens(spark, sf_dir):
    rows = tables.facts(spark, sf_dir)
    n = F.col("created_at") % 5
    text = F.when(n == 0, None).when(n == 1, "9999999999999999999").when(n == 2, "12x").otherwise(F.col("output_tokens").cast("string"))
    rows = rows.select("request_id", text.alias("output_text"), (F.col("input_tokens") + F.col("output_tokens") - 3).alias("total_tokens"), "input_tokens")
    return receipts.output_tokens(rows).select("request_id", "output_tokens", "invalid")


def top_reasons(spark, sf_dir):
    return receipts.top_reasons(tables.facts(spark, sf_dir), "error_code", 3)


def receipt(spark, sf_dir):
    return receipts.as_receipt(audit(spark, sf_dir))


def set_cover(spark, sf_dir):
    s = tables.read(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("long").alias("k"))
    n = tables.read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("k"))
    return inventory.cover(n.where("k > 3"), s.distinct(), ["k"])


MODELS = "SELECT CAST(p_partkey AS STRING) AS model_id, p_name AS name, p_brand AS prefix, p_type AS kind FROM {part} WHERE p_partkey % 3 = 0"
GRANTS = "SELECT CAST(p_partkey % 40 AS STRING) AS key_hash, p_name || CASE WHEN p_partkey % 10 = 0 THEN '!' ELSE '' END AS model, p_brand AS prefix FROM {part}"
GRANTS_SQL = f"""WITH models AS ({duck(MODELS)}), grants AS ({duck(GRANTS)}), one AS (SELECT name, count(*) AS n, min(model_id) AS only_id FROM models GROUP BY 1),
resolved AS (SELECT g.*, coalesce(m.model_id, CASE WHEN n = 1 THEN only_id END) AS model_id, CASE WHEN m.model_id IS NOT NULL THEN 'exact' WHEN n = 1 THEN 'unique' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS resolution FROM grants g LEFT JOIN models m ON m.name = g.model AND m.prefix = g.prefix LEFT JOIN one ON one.name = g.model)"""


def _resolved(spark, sf_dir):
    models = tables.view(spark, sf_dir, MODELS, "part")
    return inventory.resolve_grants(tables.view(spark, sf_dir, GRANTS, "part"), models), models


def grants(spark, sf_dir):
    return inventory.grant_counts(_resolved(spark, sf_dir)[0])


def key_policies(spark, sf_dir):
    return inventory.policies(*_resolved(spark, sf_dir))


WANTED = "SELECT p_name AS public_model, p_type AS protocol, CAST(p_size AS BIGINT) AS priority, min(p_brand) AS definition FROM {part} GROUP BY ALL"
LIVE = "SELECT p_name AS public_model, p_type AS protocol, CAST(p_size AS BIGINT) AS priority, p_brand AS definition FROM {part} WHERE p_partkey % 4 < 2"


def route_plan(spark, sf_dir):
    return inventory.route_plan(tables.view(spark, sf_dir, WANTED, "part"), tables.view(spark, sf_dir, LIVE, "part"))


ROUTE_SQL = f"""WITH wanted AS ({duck(WANTED)}), live AS (SELECT public_model, protocol, priority, count(*) AS n, min(definition) AS now FROM ({duck(LIVE)}) t GROUP BY ALL)
SELECT w.public_model, w.protocol, w.priority, CASE WHEN n IS NULL THEN 'create' WHEN n > 1 THEN 'conflict' WHEN now = definition THEN 'replay' ELSE 'update' END AS action FROM wanted w LEFT JOIN live USING (public_model, protocol, priority)"""


def merged_routes(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "part").select(F.col("p_name").alias("pattern"), F.col("p_type").alias("driver"), F.lit("c").alias("config"), F.col("p_brand").alias("candidate"), (F.col("p_partkey") % 50 < 2).alias("enabled"))
    return inventory.merge_routes(rows)


TARGETS = "SELECT CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey ELSE s_suppkey + 100000000 END AS id, CASE WHEN s_suppkey % 10 = 1 THEN 'same' ELSE s_name END AS name, 'n' || CAST(s_nationkey AS STRING) AS base_url, CASE WHEN s_suppkey % 9 = 0 THEN 'x' ELSE 'c' END AS config FROM {supplier} WHERE s_suppkey % 7 <> 2"
SOURCES = "SELECT s_suppkey AS id, CASE WHEN s_suppkey % 20 = 1 THEN 'same' ELSE s_name END AS name, 'n' || CAST(s_nationkey AS STRING) AS base_url, 'c' AS config FROM {supplier}"


def transports(spark, sf_dir):
    return inventory.transports(tables.view(spark, sf_dir, SOURCES, "supplier"), tables.view(spark, sf_dir, TARGETS, "supplier"))


TRANSPORT_SQL = f"""WITH a AS (SELECT *, count(*) OVER (PARTITION BY name) AS own FROM ({duck(SOURCES)}) t), b AS ({duck(TARGETS)}), n AS (SELECT name, count(*) AS names, min(id) AS name_id, min(base_url) AS url, min(config) AS cfg FROM b GROUP BY 1), s AS (SELECT base_url, count(DISTINCT config) AS configs FROM b GROUP BY 1),
r AS (SELECT a.id, name_id, CASE WHEN b.id IS NOT NULL THEN CASE WHEN b.base_url = a.base_url AND b.config = a.config THEN 'matched by id' ELSE 'config differs' END WHEN names IS NULL THEN CASE WHEN configs > 1 THEN 'base mixed' ELSE 'absent' END WHEN names > 1 OR own > 1 THEN 'name ambiguous'
  WHEN url <> a.base_url OR cfg <> a.config THEN 'config differs' ELSE 'matched by name' END AS result, b.id AS b_id FROM a LEFT JOIN b ON b.id = a.id LEFT JOIN n ON n.name = a.name LEFT JOIN s ON s.base_url = a.base_url)
SELECT id, CASE WHEN b_id IS NOT NULL THEN id WHEN result = 'matched by name' THEN name_id END AS target_id, result FROM r"""


def top_ups(spark, sf_dir):
    return inventory.top_ups(tables.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("account_id"), F.round(F.col("c_acctbal") * 100).cast("long").alias("balance_micros")), 500_000)


def cohort_purge(spark, sf_dir):
    cohort = tables.read(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return inventory.purge(tables.read(spark, sf_dir, "documents").select("doc_id", "source"), cohort, ["doc_id"])


QUERIES = {
    "refund_evidence": refund_evidence, "refund_blockers": refund_blockers, "refund_plan": refund_plan, "refund_deltas": refund_deltas, "refund_apply": refund_apply, "refund_rebuild": refund_rebuild, "refund_verify": refund_verify,
    "three_way": three_way, "audit": audit, "receipt": receipt, "coverage": coverage, "object_inventory": object_inventory, "output_tokens": output_tokens, "top_reasons": top_reasons, "set_cover": set_cover, "grants": grants,
    "key_policies": key_policies, "route_plan": route_plan, "merged_routes": merged_routes, "transports": transports, "top_ups": top_ups, "cohort_purge": cohort_purge,
}
UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-a' || substr(h, 18, 3) || '-' || substr(h, 21, 12)"
AUDIT = "count(*) AS rows, count(*) FILTER (WHERE completed_at IS NULL) AS unfinished, count(*) FILTER (WHERE status_code NOT BETWEEN 200 AND 399) AS failed, count(*) FILTER (WHERE cost_micros = 0) AS free"
ORACLE_SQL = {
    "refund_evidence": f"{CLASSIFIED} SELECT id, classification, cost_micros FROM classified",
    "refund_blockers": f"{CLASSIFIED} SELECT classification AS reason, count(*) AS n FROM classified WHERE classification NOT IN ('eligible', 'already_zero_cost') GROUP BY 1",
    "refund_plan": f"{CLASSIFIED} SELECT {UUID} AS id, account_id, key_id, currency, 'l' || o_orderkey AS reference_entry_id, cost_micros AS amount_micros, created_at, id AS request_id FROM entries",
    "refund_deltas": f"{CLASSIFIED} SELECT key_id, created_at // {DAY_MS} AS day_bucket, CAST(sum(cost_micros) AS BIGINT) AS refund_micros, count(*) AS refunds FROM entries GROUP BY 1, 2",
    "refund_apply": f"{CLASSIFIED} SELECT account_id, count(*) AS entries, CAST(sum(amount_micros) AS BIGINT) AS balance_micros FROM (SELECT account_id, amount_micros FROM ledger UNION ALL SELECT account_id, cost_micros FROM entries) t GROUP BY 1",
    "refund_rebuild": f"{CLASSIFIED} SELECT f.key_id, f.created_at // {DAY_MS} AS day_bucket, CAST(sum(f.cost_micros - coalesce(e.cost_micros, 0)) AS BIGINT) AS cost_micros FROM facts f LEFT JOIN entries e ON e.id = f.request_id GROUP BY 1, 2 HAVING count(e.id) > 0",
    "refund_verify": f"""{CLASSIFIED} SELECT key_id, day_bucket, cost AS expected, cost + 3 AS actual FROM (
  SELECT f.key_id, f.created_at // {DAY_MS} AS day_bucket, CAST(sum(f.cost_micros - coalesce(e.cost_micros, 0)) AS BIGINT) AS cost FROM facts f LEFT JOIN entries e ON e.id = f.request_id
  GROUP BY 1, 2 HAVING count(e.id) > 0) t WHERE day_bucket % 5 = 0""",
    "three_way": THREE_WAY_SQL,
    "audit": f"SELECT {AUDIT} FROM ({duck(REQUESTS)}) t",
    "receipt": f"""SELECT '{{"failed":"' || failed || '","free":"' || free || '","rows":"' || rows || '","unfinished":"' || unfinished || '"}}' AS receipt FROM (SELECT {AUDIT} FROM ({duck(REQUESTS)}) t) u""",
    "coverage": "WITH a AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS k, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) SELECT count(*) FILTER (WHERE a.k IS NOT NULL AND b.k IS NOT NULL) AS matched, count(*) FILTER (WHERE b.k IS NULL) AS left_only, count(*) FILTER (WHERE a.k IS NULL) AS right_only, count(*) FILTER (WHERE a.n > 1) AS left_repeated, count(*) FILTER (WHERE b.n > 1) AS right_repeated FROM a FULL JOIN b ON a.k = b.k",
    "object_inventory": "SELECT source AS kind, count(*) AS rows, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS bytes, count(*) FILTER (WHERE doc_id % 5 = 0) AS missing, count(*) FILTER (WHERE doc_id % 5 = 1) AS gap, count(*) FILTER (WHERE doc_id % 5 = 2) AS inline, count(*) FILTER (WHERE doc_id % 5 > 2) AS content FROM documents GROUP BY 1",
    "output_tokens": f"WITH facts AS ({duck(tables.FACTS)}) SELECT request_id, CASE created_at % 5 WHEN 0 THEN CASE WHEN output_tokens >= 3 THEN output_tokens - 3 END WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE output_tokens END AS output_tokens, created_at % 5 IN (1, 2) OR (created_at % 5 = 0 AND output_tokens < 3) AS invalid FROM facts",
    "top_reasons": f"WITH facts AS ({duck(tables.FACTS)}) SELECT error_code AS reason, count(*) AS n FROM facts WHERE error_code <> '' GROUP BY 1 ORDER BY n DESC, reason LIMIT 3",
    "set_cover": "WITH a AS (SELECT CAST(n_nationkey AS BIGINT) AS k FROM nation WHERE n_nationkey > 3), b AS (SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS k FROM supplier) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' ELSE 'unexpected' END AS reason FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL",
    "grants": f"{GRANTS_SQL} SELECT key_hash, resolution, count(*) AS n, max(model_id) AS last_id FROM resolved GROUP BY 1, 2",
    "key_policies": f"{GRANTS_SQL} SELECT key_hash, coalesce(string_agg(DISTINCT model_id, ',' ORDER BY model_id), '') AS models, bool_and(model_id IS NOT NULL) AS complete FROM resolved GROUP BY 1",
    "route_plan": ROUTE_SQL,
    "merged_routes": "SELECT p_name AS pattern, min(p_type) AS driver, string_agg(DISTINCT p_brand, ',' ORDER BY p_brand) AS candidates, count(DISTINCT p_type) > 1 AS rejected FROM part WHERE p_partkey % 50 < 2 GROUP BY 1",
    "transports": TRANSPORT_SQL,
    "top_ups": "SELECT c_custkey AS account_id, 500000 - CAST(round(c_acctbal * 100) AS BIGINT) AS grant_micros FROM customer WHERE CAST(round(c_acctbal * 100) AS BIGINT) < 500000",
    "cohort_purge": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
}
