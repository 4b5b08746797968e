"""The mismatch sets of applied refunds: budget events, entitlements, daily corrections and rollups, with planted faults."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS, HOUR_MS
from meterline.operators import correction
from meterline.sources import tables
from meterline.sources.tables import FACTS, duck

ITEMS = f"""SELECT request_id, 'u' || request_id AS usage_entry_id, 'f' || request_id AS refund_entry_id, 'r' || request_id AS reservation_id, key_id, 'a' || key_id AS account_id, currency, 400 + cost_micros % 5 AS status_code,
  cost_micros AS refund_micros, created_at + 1000 AS usage_created_at, created_at AS request_created_at FROM ({FACTS}) f WHERE status_class = 'failure' AND cost_micros > 0"""
BUDGET_EVENTS = f"""SELECT refund_entry_id AS usage_entry_id, reservation_id, CASE WHEN refund_micros % 31 = 0 THEN 'other' ELSE key_id END AS key_id, account_id, CASE WHEN refund_micros % 37 = 0 THEN refund_micros ELSE -refund_micros END AS amount_micros,
  usage_created_at + CASE WHEN refund_micros % 41 = 0 THEN 1 ELSE 0 END AS settled_at FROM ({ITEMS}) i WHERE refund_micros % 29 <> 0"""
ALLOCATIONS = f"""SELECT 'u' || request_id AS usage_entry_id, 'c' || key_id AS cycle_id, CASE WHEN status_class = 'failure' AND cost_micros > 0 THEN 0 ELSE cost_micros END AS amount_micros FROM ({FACTS}) f WHERE input_tokens % 3 > 0"""
CYCLES = f"SELECT cycle_id, CAST(sum(amount_micros) AS BIGINT) + CASE WHEN sum(amount_micros) % 11 = 0 THEN 5 ELSE 0 END AS consumed_micros FROM ({ALLOCATIONS}) a GROUP BY cycle_id HAVING sum(amount_micros) % 13 <> 0"
_DAY, _HOUR = {"spark": f"div {DAY_MS}", "duckdb": f"// {DAY_MS}"}, {"spark": f"div {HOUR_MS}", "duckdb": f"// {HOUR_MS}"}
DAILY = f"""SELECT key_id, day_bucket, currency, status_code, count(*) + CASE WHEN sum(refund_micros) % 17 = 0 THEN 1 ELSE 0 END AS adjustment_count, CAST(sum(refund_micros) AS BIGINT) + CASE WHEN sum(refund_micros) % 19 = 0 THEN 1 ELSE 0 END AS refund_micros
FROM (SELECT i.*, request_created_at {{div_day}} + CASE WHEN refund_micros % 101 = 0 THEN 1000 ELSE 0 END AS day_bucket FROM ({ITEMS}) i) d GROUP BY key_id, day_bucket, currency, status_code"""
ROLLUP = f"""SELECT key_id, bucket, model, protocol, status_class, error_code, service_tier, currency, CAST(sum(cost_micros - coalesce(refund_micros, 0)) AS BIGINT) + CASE WHEN sum(cost_micros) % 23 = 0 THEN 1 ELSE 0 END AS cost_micros
FROM (SELECT f.*, i.refund_micros, created_at {{div}} AS bucket FROM ({FACTS}) f LEFT JOIN ({ITEMS}) i ON i.request_id = f.request_id) r GROUP BY key_id, bucket, model, protocol, status_class, error_code, service_tier, currency"""
BY = ["key_id", "bucket", "model", "protocol", "status_class", "error_code", "service_tier", "currency"]


def _sql(text: str, engine: str) -> str:
    return text.replace("{div_day}", _DAY[engine]).replace("{div}", _DAY[engine])


def refund_sets(spark, sf_dir):
    """(relation, id) of every mismatch in the four sets that refunds left; rollups by day and by hour."""
    view = lambda sql: tables.view(spark, sf_dir, sql, "events")
    items, facts = view(ITEMS), tables.facts(spark, sf_dir)
    since = items.agg(F.max("usage_created_at")).head()[0] - 7 * DAY_MS if not items.isEmpty() else 0
    sets = [
        ("usage event", correction.usage_event_mismatches(items, view(BUDGET_EVENTS), since), ["refund_entry_id"]),
        ("entitlement", correction.entitlement_mismatches(items, view(ALLOCATIONS), view(CYCLES)), ["cycle_id"]),
        ("correction day", correction.correction_daily_mismatches(items, view(_sql(DAILY, "spark"))), list(correction.DAILY_KEY)),
    ]
    for name, div in (("rollup day", _DAY), ("rollup hour", _HOUR)):
        rollup = view(ROLLUP.replace("{div}", div["spark"]))
        rows = facts.withColumn("bucket", F.expr(f"created_at {div['spark']}"))
        sets.append((name, correction.rollup_mismatches(items, rows, rollup, BY), BY))
    out = None
    for name, rows, key in sets:
        part = rows.select(F.lit(name).alias("relation"), F.concat_ws("|", *[F.col(c).cast("string") for c in key]).alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


def _rollup_sql(name: str, div: str) -> str:
    on = " AND ".join(f"h.{c} = t.{c}" for c in BY)
    return f"""SELECT '{name}', concat_ws('|', {', '.join(f't.{c}' for c in BY)}) FROM (SELECT {', '.join(BY)}, CAST(sum(cost_micros - coalesce(refund_micros, 0)) AS BIGINT) AS cost, count(refund_micros) AS n
  FROM (SELECT f.*, refund_micros, created_at {div} AS bucket FROM f LEFT JOIN i USING (request_id)) x GROUP BY ALL) t LEFT JOIN ({duck(ROLLUP.replace('{div}', div))}) h ON {on} WHERE t.n > 0 AND h.cost_micros IS DISTINCT FROM t.cost"""


SETS_SQL = f"""WITH i AS ({duck(ITEMS)}), f AS ({duck(FACTS)}), e AS ({duck(BUDGET_EVENTS)}), a AS ({duck(ALLOCATIONS)}), c AS ({duck(CYCLES)}), d AS ({duck(_sql(DAILY, 'duckdb'))}),
due AS (SELECT key_id, request_created_at // {DAY_MS} AS day_bucket, currency, status_code, count(*) AS n, CAST(sum(refund_micros) AS BIGINT) AS total FROM i GROUP BY 1, 2, 3, 4)
SELECT 'usage event' AS relation, refund_entry_id AS id FROM i WHERE usage_created_at >= (SELECT max(usage_created_at) - {7 * DAY_MS} FROM i) AND NOT EXISTS (SELECT 1 FROM e WHERE e.usage_entry_id = i.refund_entry_id AND e.reservation_id = i.reservation_id
  AND e.key_id = i.key_id AND e.account_id = i.account_id AND e.amount_micros = -i.refund_micros AND e.settled_at = i.usage_created_at)
UNION ALL SELECT 'entitlement', t.cycle_id FROM (SELECT DISTINCT cycle_id FROM a WHERE usage_entry_id IN (SELECT usage_entry_id FROM i)) t LEFT JOIN c USING (cycle_id)
  WHERE consumed_micros IS DISTINCT FROM (SELECT sum(amount_micros) FROM a WHERE a.cycle_id = t.cycle_id)
UNION ALL SELECT 'correction day', concat_ws('|', coalesce(due.key_id, d.key_id), coalesce(due.day_bucket, d.day_bucket), coalesce(due.currency, d.currency), coalesce(due.status_code, d.status_code)) FROM due
  FULL JOIN d ON d.key_id = due.key_id AND d.day_bucket = due.day_bucket AND d.currency = due.currency AND d.status_code = due.status_code WHERE adjustment_count IS DISTINCT FROM n OR d.refund_micros IS DISTINCT FROM total
UNION ALL {_rollup_sql('rollup day', _DAY['duckdb'])} UNION ALL {_rollup_sql('rollup hour', _HOUR['duckdb'])}"""

QUERIES = {"refund_sets": refund_sets}
ORACLE_SQL = {"refund_sets": SETS_SQL}
