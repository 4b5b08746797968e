"""Queries of patterns, candidates, transports and keyed digests, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions import scalars
from meterline.operators import routing
from meterline.sources import tables
from meterline.sources.tables import duck

#: Patterns in order; the first one that fits counts.
PATTERNS = ("*RED*/*#1*", "small *", "blue widget/*", "*(x)*", "*/econOMY", "b*t/*2*", "green*", "*ge*r*")
PARTS = "SELECT p_partkey, p_name || '/' || p_brand || '/' || p_type AS value FROM {part}"


def _patterns(spark):
    return spark.createDataFrame(list(enumerate(PATTERNS)), "place int, pattern string")


def wildcard_matches(spark, sf_dir):
    """How many parts fit each pattern, parts read once."""
    parts = tables.view(spark, sf_dir, PARTS, "part")
    names = parts.groupBy("value").agg(F.count("*").alias("n"))
    return routing.matches(names, _patterns(spark)).join(names, "value").groupBy("pattern").agg(F.sum("n").alias("n"))


def first_patterns(spark, sf_dir):
    """Each part with the first pattern that it fits."""
    return routing.first_match(tables.view(spark, sf_dir, PARTS, "part"), _patterns(spark)).select("p_partkey", "pattern")


#: Models are parts; a supplier has those that it shipped registered.
REQUESTS = "SELECT p_partkey AS request, CASE WHEN p_partkey % 2 = 0 THEN 'M' ELSE 'm' END || CAST(p_partkey AS STRING) AS model, CASE WHEN p_partkey % 3 = 0 THEN 'g' || CAST(p_partkey % 4 AS STRING) END AS grp, CASE WHEN p_partkey % 5 = 0 THEN 'east' END AS upstream_prefix FROM {part}"
AUTHS = "SELECT s_suppkey AS auth, CASE s_suppkey % 4 WHEN 0 THEN 'east' WHEN 1 THEN 'west' END AS prefix, s_nationkey FROM {supplier}"
REGISTERED = "SELECT DISTINCT l_suppkey AS auth, CASE WHEN l_linenumber = 1 THEN 'east/' ELSE '' END || 'm' || CAST(l_partkey AS STRING) AS model FROM {lineitem}"
ALIASES = """SELECT DISTINCT l_suppkey AS auth, l_linenumber AS place, 'm' || CAST(l_partkey AS STRING) AS alias, 'M' || CAST(l_partkey + l_linenumber AS STRING) AS name FROM {lineitem} WHERE l_suppkey % 3 = 0 AND l_partkey % 7 = 0
UNION ALL SELECT NULL, 1, 'M' || CAST(p_partkey AS STRING), 'm' || CAST(p_partkey + 1 AS STRING) FROM {part} WHERE p_partkey % 6 = 0"""
EXCLUDED = "SELECT s_suppkey AS auth, CASE WHEN s_suppkey % 2 = 0 THEN 'm*5' ELSE '*1*7' END AS pattern FROM {supplier} WHERE s_suppkey % 3 > 0"


def route_candidates(spark, sf_dir):
    view = lambda sql, *t: tables.view(spark, sf_dir, sql, *t)
    auths = view(AUTHS, "supplier").select("auth", "prefix", F.array(F.concat(F.lit("g"), (F.col("s_nationkey") % 4).cast("string")), F.lit("g1")).alias("groups"))
    requests = view(REQUESTS, "part").withColumnRenamed("grp", "group")
    return routing.candidates(requests, auths, view(ALIASES, "lineitem", "part"), view(EXCLUDED, "supplier"), view(REGISTERED, "lineitem"), force_prefix=True)


CANDIDATES_SQL = f"""WITH q AS ({duck(REQUESTS)}), a AS ({duck(AUTHS)}), reg AS ({duck(REGISTERED)}), al AS ({duck(ALIASES)}), ex AS ({duck(EXCLUDED)}),
own AS (SELECT auth, lower(alias) AS low, arg_min(name, place) AS name FROM al WHERE auth IS NOT NULL GROUP BY 1, 2), shared AS (SELECT lower(alias) AS low, arg_min(name, place) AS name FROM al WHERE auth IS NULL GROUP BY 1),
pairs AS (SELECT request, reg.auth FROM q JOIN reg ON reg.model = lower(concat_ws('/', upstream_prefix, q.model)) UNION SELECT request, own.auth FROM q JOIN own ON own.low = lower(q.model)
  UNION SELECT request, reg.auth FROM q LEFT JOIN shared ON shared.low = lower(q.model) JOIN reg ON reg.model = lower(coalesce(shared.name, q.model))),
r AS (SELECT q.*, a.*, coalesce(own.name, shared.name, q.model) AS upstream_model FROM pairs JOIN q USING (request) JOIN a USING (auth) LEFT JOIN own ON own.auth = a.auth AND own.low = lower(q.model) LEFT JOIN shared ON shared.low = lower(q.model))
SELECT request, auth, upstream_model FROM r WHERE (grp IS NULL OR grp IN ('g1', 'g' || s_nationkey % 4)) AND CASE WHEN upstream_prefix IS NULL THEN prefix IS NULL ELSE prefix IS NOT DISTINCT FROM upstream_prefix END
  AND EXISTS (SELECT 1 FROM reg WHERE reg.auth = r.auth AND reg.model IN (lower(concat_ws('/', upstream_prefix, r.model)), lower(upstream_model)))
  AND NOT EXISTS (SELECT 1 FROM ex WHERE ex.auth = r.auth AND upstream_model ILIKE replace(pattern, '*', '%'))"""

SOURCES = "SELECT c_custkey AS source_id, 'p' || CAST(c_nationkey AS STRING) AS provider, 'n' || CAST(c_custkey AS STRING) AS name, c_custkey % 17 = 0 AS disabled, c_custkey % 19 = 0 AS proxied, 'https://u' || CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey - c_custkey % 2 ELSE c_custkey END AS STRING) AS base_url, 'none' AS config FROM {customer}"
TARGETS = """SELECT c_custkey + k AS target_id, 'n' || CAST(c_custkey AS STRING) AS name, CASE WHEN c_custkey % 31 = 0 THEN 'paused' ELSE 'active' END AS status, CASE WHEN c_custkey % 37 = 0 THEN 'other' ELSE 'http-json' END AS driver,
  'https://u' || CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey - c_custkey % 2 ELSE c_custkey END AS STRING) AS base_url, CASE WHEN c_custkey % 41 = 0 THEN 'odd' WHEN c_custkey % 43 = 0 THEN 'private' ELSE 'public' END AS scope,
  CASE WHEN c_custkey % 53 = 0 THEN 'ftp://x' WHEN c_custkey % 10 = 9 THEN 'https://' || CAST(c_nationkey AS STRING) END AS origin, CASE WHEN c_custkey % 47 = 0 THEN 'x' ELSE 'none' END AS config
FROM (SELECT *, 0 AS k FROM {customer} WHERE c_custkey % 23 > 0 UNION ALL SELECT *, 1000000000 FROM {customer} WHERE c_custkey % 29 = 0) c"""
WANTED = "SELECT c_custkey + CASE WHEN c_custkey % 61 = 0 THEN 1000000000 ELSE 0 END AS source_id, 'p' || CAST(CASE WHEN c_custkey % 11 = 0 THEN 99 ELSE c_nationkey END AS STRING) AS provider FROM {customer} WHERE c_custkey % 13 > 0"


def transport_reconciliation(spark, sf_dir):
    sources, targets, wanted = (tables.view(spark, sf_dir, sql, "customer") for sql in (SOURCES, TARGETS, WANTED))
    return routing.reconcile_transports(sources, targets.withColumn("origins", F.when(F.col("origin").isNotNull(), F.array("origin"))), wanted)


TRANSPORT_SQL = f"""WITH s AS ({duck(SOURCES)}), t AS ({duck(TARGETS)}), w AS ({duck(WANTED)}),
n AS (SELECT name, count(*) AS names, min(target_id) AS target_id, arg_min(status, target_id) AS status, arg_min(driver, target_id) AS driver, arg_min(base_url, target_id) AS url, arg_min(scope, target_id) AS scope, arg_min(coalesce(origin, ''), target_id) AS origin, arg_min(config, target_id) AS cfg FROM t GROUP BY 1),
r AS (SELECT w.source_id, s.base_url, n.target_id, scope, origin, CASE WHEN s.source_id IS NULL OR disabled THEN 'source_candidate_unavailable' WHEN s.provider <> w.provider THEN 'source_candidate_metadata_mismatch' WHEN proxied THEN 'source_proxy_unverifiable'
  WHEN names IS NULL THEN 'target_absent' WHEN names > 1 THEN 'target_ambiguous' WHEN status <> 'active' THEN 'target_inactive' WHEN driver <> 'http-json' THEN 'target_driver_mismatch' WHEN scope NOT IN ('public', 'private') THEN 'target_transport_invalid'
  WHEN scope = 'private' THEN 'source_proxy_unverifiable' WHEN url <> s.base_url OR cfg <> s.config THEN 'target_config_mismatch' WHEN origin LIKE 'ftp%' THEN 'target_transport_invalid' END AS reason FROM w LEFT JOIN s USING (source_id) LEFT JOIN n ON n.name = s.name),
g AS (SELECT base_url, count(DISTINCT scope || origin) AS kinds, count(*) AS members FROM r WHERE reason IS NULL GROUP BY 1), b AS (SELECT base_url, count(*) AS n FROM s GROUP BY 1),
x AS (SELECT r.*, kinds, b.n - members AS uncovered, reason IS NULL AND (kinds <> 1 OR b.n <> members) AS clash FROM r LEFT JOIN g USING (base_url) LEFT JOIN b USING (base_url))
SELECT source_id, CASE WHEN reason IS NULL AND NOT clash THEN target_id END AS target_id, CASE WHEN clash THEN 'shared_base_transport_conflict' ELSE reason END AS reason, CASE WHEN clash THEN uncovered END AS uncovered, CASE WHEN clash THEN kinds END AS distinct_transports FROM x"""


def keyed_ids(spark, sf_dir):
    """Customers under identifiers that only who has the key can make: one key for all, and one of each customer's own."""
    c = tables.spread(tables.read(spark, sf_dir, "customer").select("c_custkey", "c_name"))
    i = F.col("c_custkey").cast("string")
    own = F.repeat(F.col("c_name"), F.when(F.col("c_custkey") % 3 == 0, 5).otherwise(1))
    return c.select("c_custkey", scalars.hmac_sha256(b"route key", i).alias("keyed"), scalars.hmac_sha256(own, i).alias("own_keyed"), scalars.uuid8_of(F.concat_ws("\0", F.lit("customer"), i)).alias("uuid"))


def _hmac(key: str, message: str) -> str:
    """HMAC in DuckDB over a blob key; every byte of the filled-up key is xored in hex."""
    digits = f"rpad(hex(CASE WHEN octet_length({key}) > 64 THEN unhex(sha256({key})) ELSE {key} END), 128, '0')"
    pad = lambda byte: f"unhex(array_to_string(list_transform(range(64), lambda i: format('{{:02x}}', xor(CAST('0x' || substr({digits}, CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER), {byte}))), ''))"
    return f"sha256({pad(0x5C)} || unhex(sha256({pad(0x36)} || encode({message}))))"


KEYED_SQL = f"""WITH c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS m, encode('route key') AS k, encode(repeat(c_name, CASE WHEN c_custkey % 3 = 0 THEN 5 ELSE 1 END)) AS o, sha256('customer' || chr(0) || c_custkey) AS h FROM customer)
SELECT c_custkey, {_hmac('k', 'm')} AS keyed, {_hmac('o', 'm')} AS own_keyed,
  substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-8' || substr(h, 14, 3) || '-' || format('{{:x}}', CAST('0x' || substr(h, 17, 1) AS INTEGER) & 3 | 8) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS uuid FROM c"""

_LIKE = " ".join(f"WHEN value ILIKE '{p.replace('*', '%')}' THEN '{p}'" for p in PATTERNS)
QUERIES = {
    "wildcard_matches": wildcard_matches, "first_patterns": first_patterns, "route_candidates": route_candidates, "transport_reconciliation": transport_reconciliation, "keyed_ids": keyed_ids,
}
ORACLE_SQL = {
    "wildcard_matches": " UNION ALL ".join(f"SELECT '{p}' AS pattern, count(*) AS n FROM ({duck(PARTS)}) t WHERE value ILIKE '{p.replace('*', '%')}' HAVING count(*) > 0" for p in PATTERNS),
    "first_patterns": f"SELECT p_partkey, CASE {_LIKE} END AS pattern FROM ({duck(PARTS)}) t",
    "route_candidates": CANDIDATES_SQL, "transport_reconciliation": TRANSPORT_SQL, "keyed_ids": KEYED_SQL,
}
