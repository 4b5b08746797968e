"""Queries of session archives, conversation graphs and objects, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions.scalars import is_hex64, shard_of
from meterline.operators import archive, graph
from meterline.sources import tables
from meterline.sources.tables import duck

#: Turns as archive records; some lines are broken.
RECORDS = "SELECT CAST(conv_id AS STRING) AS session_id, 'r' || substr(CAST(1000 + turn AS STRING), 2) AS request_id, coalesce(role, '') || ':' || coalesce(text, '') AS line, conv_id, turn FROM {conversations}"


def _records(spark, sf_dir):
    return tables.view(spark, sf_dir, RECORDS, "conversations")


def archive_lines(spark, sf_dir):
    """Lines by type and problem: a repeated key, a wrong version and an empty session are planted."""
    rows = _records(spark, sf_dir)
    n = F.col("conv_id") % 10
    fields = F.struct(F.when(n == 1, 9).otherwise(2).alias("schema_version"), F.when(n == 2, "").otherwise(F.col("session_id")).alias("session_id"), "request_id", F.col("turn").alias("started_at"))
    record = F.to_json(fields)
    record = F.when(n == 3, F.regexp_replace(record, r"^\{", '{"schema_version":1,')).when(n == 4, F.concat(record, F.lit(" x"))).otherwise(record)
    summary = F.to_json(F.struct(F.lit("session_summary").alias("_mtc_delta_type"), F.lit(2).alias("schema_version"), "session_id", F.lit(1).cast("long").alias("requests")))
    lines = rows.select(record.alias("value")).unionByName(rows.where("turn = 0").select(summary.alias("value")))
    return archive.parse(lines).groupBy("line_type", F.coalesce("problem", F.lit("")).alias("problem")).agg(F.count("*").alias("n"))


def session_digests(spark, sf_dir):
    return archive.session_digests(_records(spark, sf_dir))


DIGESTS = f"WITH records AS ({duck(RECORDS)}), digests AS (SELECT session_id, count(*) AS records, sha256(string_agg(sha256(line), chr(10) ORDER BY request_id, sha256(line)) || chr(10)) AS sha256 FROM records GROUP BY 1)"


def archive_set_digest(spark, sf_dir):
    return archive.set_digest(session_digests(spark, sf_dir))


def archive_completeness(spark, sf_dir):
    """Summaries with planted faults against what the records are."""
    digests = session_digests(spark, sf_dir)
    n = F.col("session_id").cast("long") % 7
    told = digests.where("session_id NOT LIKE '%9'").select("session_id", F.when(n == 1, F.col("records") + 1).otherwise(F.col("records")).alias("requests"), F.when(n == 2, "0").otherwise(F.col("sha256")).alias("records_sha256"))
    return archive.completeness(told, digests)


EVENTS = "SELECT event_id, {ms} AS at_ms, CAST(user_id AS STRING) AS key_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM {events}"


def _events(spark, sf_dir):
    return tables.view(spark, sf_dir, EVENTS, "events")


EVENTS_CTE = f"WITH e AS ({duck(EVENTS)})"


def archive_totals(spark, sf_dir):
    e = _events(spark, sf_dir)
    done = F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("at_ms") + F.col("cents"))
    status = F.when(F.col("event_type") == "error", 500).when(F.col("event_id") % 13 == 0, 101).otherwise(200)
    return archive.totals(e.select(F.col("key_id").alias("session_id"), F.col("at_ms").alias("started_at"), done.alias("completed_at"), status.alias("status_code")))


MANIFESTS = """SELECT CAST(n_regionkey AS BIGINT) AS source, CAST((n_nationkey - n_nationkey % 5) / 5 AS BIGINT) + 1 AS sequence, 'd' || CAST(n_nationkey AS STRING) AS output_sha256, CASE WHEN n_nationkey >= 5 THEN 'd' || CAST(CASE WHEN n_nationkey = 12 THEN 0 ELSE n_nationkey - 5 END AS STRING) END AS prior_output_sha256,
CAST(n_nationkey AS BIGINT) AS watermark, CASE WHEN n_nationkey >= 5 THEN CAST(n_nationkey - CASE WHEN n_nationkey = 18 THEN 4 ELSE 5 END AS BIGINT) END AS prior_watermark, CAST(1 AS BIGINT) AS fence, CASE WHEN n_nationkey >= 5 THEN CAST(1 AS BIGINT) END AS prior_fence, n_nationkey < 4 AS full FROM {nation} WHERE n_nationkey <> 11"""


def chain_breaks(spark, sf_dir):
    return archive.chain_breaks(tables.view(spark, sf_dir, MANIFESTS, "nation"))


CHAIN_SQL = f"""WITH m AS (SELECT *, lag(sequence) OVER w AS s, lag(output_sha256) OVER w AS d, lag(watermark) OVER w AS k FROM ({duck(MANIFESTS)}) t WINDOW w AS (PARTITION BY source ORDER BY sequence))
SELECT * FROM (SELECT source, sequence, CASE WHEN s IS NULL THEN CASE WHEN sequence <> 1 OR NOT "full" THEN 'first is no full snapshot' END WHEN sequence <> s + 1 THEN 'sequence gap' WHEN prior_output_sha256 IS DISTINCT FROM d THEN 'prior digest' WHEN prior_watermark IS DISTINCT FROM k THEN 'prior watermark' END AS reason FROM m) r WHERE reason IS NOT NULL"""


def live_sessions(spark, sf_dir):
    """Sessions whose last delta is no tombstone."""
    return archive.apply_deltas(_events(spark, sf_dir).select(F.col("key_id").alias("session_id"), F.col("event_id").alias("sequence"), (F.col("event_type") == "error").alias("deleted"), "cents"))


def retired_records(spark, sf_dir):
    e = _events(spark, sf_dir).select(F.col("key_id").alias("session_id"), F.col("event_id").alias("request_id"), F.col("cents").cast("string").alias("digest"))
    staged = e.where("CAST(session_id AS BIGINT) % 3 = 0 AND request_id % 5 <> 0").withColumn("digest", F.when(F.col("request_id") % 7 == 0, "new").otherwise(F.col("digest")))
    return archive.retired(e, staged)


def correlation(spark, sf_dir):
    """Archive records against requests whose ids repeat, whose clocks are off, whose models differ, and of which two match but for tokens."""
    e = _events(spark, sf_dir)
    external = F.floor(F.col("event_id") / 3).cast("string").alias("external_id")  # three events an id, however many events
    spent = [(F.col("event_id") % m).alias(c) for c, m in (("input_tokens", 7), ("output_tokens", 3))]
    records = e.select(F.col("event_id").alias("record_id"), external, F.col("at_ms").alias("started_at"), F.col("event_type").alias("requested_model"), F.lit("view").alias("resolved_model"), "key_id", *spent)
    off = F.when(F.col("event_id") % 5 == 0, 300_001).otherwise(F.lit(300_000))
    model = F.when(F.col("event_id") % 7 == 0, "other").otherwise(F.col("event_type"))
    requests = e.where("event_id % 10 <> 0").select("event_id", external, (F.col("at_ms") + off).alias("created_at"), model.alias("model"), "key_id", *spent)
    again = requests.where("event_id % 4 = 1").withColumn("output_tokens", F.when(F.col("event_id") % 8 == 1, F.lit(9).cast("long")).otherwise(F.col("output_tokens")))
    return archive.correlate(records, requests.unionByName(again))


CORRELATION_SQL = f"""{EVENTS_CTE}, q AS (SELECT event_id // 3 AS x, at_ms + CASE WHEN event_id % 5 = 0 THEN 300001 ELSE 300000 END AS t,
    CASE WHEN event_id % 7 = 0 THEN 'other' ELSE event_type END AS m, key_id AS k, event_id % 7 AS i, event_id % 3 AS o, event_id FROM e WHERE event_id % 10 <> 0),
r AS (SELECT * FROM q UNION ALL SELECT * REPLACE (CASE WHEN event_id % 8 = 1 THEN 9 ELSE o END AS o) FROM q WHERE event_id % 4 = 1),
p AS (SELECT e.event_id AS record_id, x, abs(t - at_ms) <= 300000 AND m IN (event_type, 'view') AND k = key_id AS fits, i = e.event_id % 7 AND o = e.event_id % 3 AS alike
  FROM e LEFT JOIN r ON x = e.event_id // 3),
c AS (SELECT record_id, count(x) AS same, count(*) FILTER (WHERE fits) AS matches, count(*) FILTER (WHERE fits AND alike) AS alike FROM p GROUP BY 1)
SELECT record_id, matches, CASE WHEN matches = 1 OR (matches > 1 AND alike = 1) THEN 'exact' WHEN matches > 1 THEN 'ambiguous' WHEN same > 0 THEN 'incompatible' ELSE 'absent' END AS disposition FROM c"""


def identities(spark, sf_dir):
    e = _events(spark, sf_dir)
    a = e.select((F.col("event_id") % 500).alias("hash"), F.lit("t").alias("tenant"), (F.col("event_id") % 500 % 60).cast("string").alias("key"), F.lit("p").alias("principal"), F.lit("policy").alias("kind"))
    b = e.where("event_id % 500 < 200").select((F.col("event_id") % 500).alias("hash"), F.lit("t").alias("tenant"), F.when(F.col("event_id") % 500 % 9 == 0, "x").otherwise((F.col("event_id") % 500 % 60).cast("string")).alias("key"), F.lit("p").alias("principal"), F.lit("binding").alias("kind"))
    return archive.identities(a.unionByName(b))


def quarantine(spark, sf_dir):
    e = _events(spark, sf_dir)
    versions = e.select((F.col("event_id") % 3000).alias("occurrence"), F.col("event_id").alias("version"), F.col("event_type").alias("reason"))
    resolutions = e.where("event_id % 4 = 0").select((F.col("event_id") % 3000).alias("occurrence"), F.col("event_id").alias("version"), F.when(F.col("event_id") % 8 == 0, "link").otherwise("dismiss").alias("action"), F.col("at_ms").alias("at"))
    return archive.quarantine_state(versions, resolutions)


def context_nodes(spark, sf_dir):
    return graph.context_nodes(tables.read(spark, sf_dir, "conversations"))


NODES_SQL = """WITH RECURSIVE turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, sha256(coalesce(role, '') || chr(0) || coalesce(text, ''))) - 1 AS depth, sha256(coalesce(role, '') || chr(0) || coalesce(text, '')) AS atom_hash FROM conversations),
nodes AS (SELECT conv_id, depth, sha256('root' || chr(0) || atom_hash) AS node_hash, CAST(NULL AS VARCHAR) AS parent_hash, atom_hash FROM turns WHERE depth = 0
UNION ALL SELECT t.conv_id, t.depth, sha256(n.node_hash || chr(0) || t.atom_hash), n.node_hash, t.atom_hash FROM nodes n JOIN turns t ON t.conv_id = n.conv_id AND t.depth = n.depth + 1)"""


def broken_nodes(spark, sf_dir):
    """Nodes with planted faults: other atoms, and second turns that are gone."""
    nodes = context_nodes(spark, sf_dir).where("NOT (conv_id % 10 = 3 AND depth = 1)")
    nodes = nodes.withColumn("atom_hash", F.when((F.col("conv_id") % 10 == 4) & (F.col("depth") == 0), F.lit("0")).otherwise(F.col("atom_hash")))
    return graph.broken_nodes(nodes).groupBy("reason").agg(F.countDistinct("node_hash").alias("nodes"))


def dialogues(spark, sf_dir):
    nodes = context_nodes(spark, sf_dir)
    tables.shared_checkpoints(spark)
    leaves = nodes.groupBy("conv_id").agg(F.max_by("node_hash", "depth").alias("node_hash"))
    return graph.dialogue(leaves, nodes)


def foreign_edges(spark, sf_dir):
    e = _events(spark, sf_dir)
    observations = e.where("event_id % 50 <> 0").select(F.col("event_id").alias("id"), F.when(F.col("event_id") % 17 == 0, "b").otherwise("a").alias("tenant_id"))
    return graph.foreign_edges(e.where("event_id > 0").select(F.col("event_id").alias("id"), (F.col("event_id") - 1).alias("from_id"), F.col("event_id").alias("to_id")), observations)


def _locators(spark, sf_dir):
    docs = tables.read(spark, sf_dir, "documents")
    body = F.concat(F.lit("objects/sha256/"), F.substr(F.sha2("text", 256), F.lit(1), F.lit(2)), F.lit("/"), F.sha2("text", 256))
    docs = docs.select("doc_id", F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("gap://usage/"), "doc_id")).otherwise(body).alias("locator"))
    pages = tables.read(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 4 == 0, F.lit("inline-json:{}")).otherwise(F.lit("")).alias("locator"))
    return docs, graph.locator_union({"document": (docs, "doc_id", "locator"), "page": (pages, "page_id", "locator")})


def locator_classes(spark, sf_dir):
    return _locators(spark, sf_dir)[1].groupBy("kind", "class").agg(F.count("*").alias("n"))


def gap_candidates(spark, sf_dir):
    docs, all_of_them = _locators(spark, sf_dir)
    held = docs.where("doc_id % 7 <> 0").select(F.col("locator").alias("key")).distinct()
    return graph.gap_candidates(all_of_them, held).select("id", "reason")


LOCATORS = "WITH d AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN 'gap://usage/' || doc_id ELSE 'objects/sha256/' || sha256(text) END AS locator FROM documents)"


def storage_classes(spark, sf_dir):
    h = F.sha2("text", 256)
    two = F.substr(h, F.lit(1), F.lit(2))
    n = F.col("doc_id") % 7
    names = ["raw-cache/", "tenants/t/cas/v1/sha256/", "tenants/t/other/", "staging/", "conversation-staging/", "readiness/", "objects/sha256/"]
    prefix = F.element_at(F.array(*[F.lit(x) for x in names]), (n + 1).cast("int"))
    key = F.concat(prefix, two, F.lit("/"), h)
    return tables.read(spark, sf_dir, "documents").groupBy(graph.storage_class(key).alias("class")).agg(F.count("*").alias("n"), F.count_if(is_hex64(h)).alias("hex"))


def _multiset_sql() -> str:
    """Sums of eight 32-bit parts, carried on by hand: HUGEINT holds each."""
    parts = ", ".join(f"sum(CAST('0x' || substr(d, {57 - 8 * k}, 8) AS HUGEINT)) AS s{k}" for k in range(8))
    carried = ["s0 AS t0"] + [f"s{k} + (t{k - 1} >> 32) AS t{k}" for k in range(1, 8)]
    sql = f"SELECT count(*) AS rows, {parts} FROM (SELECT sha256(coalesce(text, '')) AS d FROM documents) t"
    for step in carried:
        sql = f"SELECT *, {step} FROM ({sql}) t"
    digits = " || ".join(f"lpad(lower(to_hex(CAST(t{k} % 4294967296 AS BIGINT))), 8, '0')" for k in reversed(range(8)))
    return f"SELECT rows, {digits} AS digest FROM ({sql}) t"


def multiset_digest(spark, sf_dir):
    return graph.multiset_digest(tables.read(spark, sf_dir, "documents").select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("d")), "d")


def shards(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("k"))
    return rows.groupBy(shard_of(F.col("k"), 16).alias("shard")).agg(F.count("*").alias("n"))


def chunk_problems(spark, sf_dir):
    """Orders as objects whose lines are chunks; lines repeat and lack numbers."""
    lines = tables.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("object_id"), (F.col("l_linenumber") - 1).cast("long").alias("seq"), F.col("l_quantity").cast("long").alias("n_bytes"))
    headers = lines.groupBy("object_id").agg(F.max(F.col("seq") + 1).alias("chunks"), F.sum("n_bytes").alias("bytes")).where("object_id % 20 <> 0").withColumn("bytes", F.when(F.col("object_id") % 6 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")))
    return graph.chunk_problems(lines, headers)


CHUNK_SQL = """WITH g AS (SELECT l_orderkey AS o, count(*) AS n, count(DISTINCT l_linenumber) AS d, min(l_linenumber) AS low, max(l_linenumber) AS high FROM lineitem GROUP BY 1)
SELECT * FROM (SELECT o AS object_id, CASE WHEN o % 20 = 0 THEN 'no header' WHEN n <> high THEN 'count' WHEN d <> n OR low <> 1 THEN 'gap' WHEN o % 6 = 0 THEN 'bytes' END AS reason FROM g) t WHERE reason IS NOT NULL"""

QUERIES = {
    "archive_lines": archive_lines, "session_digests": session_digests, "archive_set_digest": archive_set_digest, "archive_completeness": archive_completeness, "archive_totals": archive_totals, "chain_breaks": chain_breaks,
    "live_sessions": live_sessions, "retired_records": retired_records, "correlation": correlation, "identities": identities, "quarantine": quarantine, "context_nodes": context_nodes, "broken_nodes": broken_nodes, "dialogues": dialogues,
    "foreign_edges": foreign_edges, "locator_classes": locator_classes, "gap_candidates": gap_candidates, "storage_classes": storage_classes, "multiset_digest": multiset_digest, "shards": shards, "chunk_problems": chunk_problems,
}
ORACLE_SQL = {
    "archive_lines": "SELECT * FROM (SELECT 'record' AS line_type, CASE conv_id % 10 WHEN 1 THEN 'unknown schema version' WHEN 2 THEN 'no session' WHEN 3 THEN 'not strict JSON' WHEN 4 THEN 'not strict JSON' ELSE '' END AS problem, count(*) AS n FROM conversations GROUP BY ALL UNION ALL SELECT 'session_summary', '', count(*) FROM conversations WHERE turn = 0) t",
    "session_digests": f"{DIGESTS} SELECT * FROM digests",
    "archive_set_digest": f"{DIGESTS}, b AS (SELECT substr(sha256(session_id), 1, 2) AS p, count(*) AS n, sha256(string_agg(sha256(session_id || chr(0) || records || chr(0) || sha256), '' ORDER BY session_id)) AS h FROM digests GROUP BY 1) SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS sessions, sha256(coalesce(string_agg(h, '' ORDER BY p), '')) AS set_sha256 FROM b",
    "archive_completeness": f"{DIGESTS} SELECT * FROM (SELECT session_id, CASE WHEN session_id LIKE '%9' THEN NULL WHEN CAST(session_id AS BIGINT) % 7 = 1 THEN records + 1 ELSE records END AS expected, records AS actual, CASE WHEN session_id LIKE '%9' THEN 'no summary' WHEN CAST(session_id AS BIGINT) % 7 = 1 THEN 'count' WHEN CAST(session_id AS BIGINT) % 7 = 2 THEN 'digest' END AS reason FROM digests) t WHERE reason IS NOT NULL",
    "archive_totals": f"{EVENTS_CTE} SELECT key_id AS session_id, count(*) AS requests, count(*) FILTER (WHERE event_type = 'error' OR event_id % 13 = 0) AS errors, min(at_ms) AS first_at, max(at_ms + cents) FILTER (WHERE event_id % 11 <> 0) AS last_at, count(*) FILTER (WHERE event_id % 11 <> 0) AS duration_count, CAST(coalesce(sum(cents) FILTER (WHERE event_id % 11 <> 0), 0) AS BIGINT) AS duration_sum_ms FROM e GROUP BY 1",
    "chain_breaks": CHAIN_SQL,
    "live_sessions": f"{EVENTS_CTE} SELECT key_id AS session_id, event_id AS sequence, false AS deleted, cents FROM e WHERE event_type <> 'error' AND event_id = (SELECT max(event_id) FROM e x WHERE x.key_id = e.key_id)",
    "retired_records": f"{EVENTS_CTE} SELECT key_id AS session_id, event_id AS request_id, CAST(cents AS VARCHAR) AS digest FROM e WHERE CAST(key_id AS BIGINT) % 3 = 0 AND (event_id % 5 = 0 OR event_id % 7 = 0) AND key_id IN (SELECT key_id FROM e WHERE event_id % 5 <> 0)",
    "correlation": CORRELATION_SQL,
    "identities": f"{EVENTS_CTE}, h AS (SELECT DISTINCT event_id % 500 AS hash FROM e) SELECT hash, CASE WHEN hash < 200 AND hash % 9 = 0 THEN NULL ELSE CAST(hash % 60 AS VARCHAR) END AS key, CASE WHEN hash < 200 THEN 'binding+policy' ELSE 'policy' END AS proof, NOT (hash < 200 AND hash % 9 = 0) AS proven FROM h",
    "quarantine": f"{EVENTS_CTE} SELECT event_id % 3000 AS occurrence, max(event_id) AS version, arg_max(event_type, event_id) AS reason, CASE WHEN max(event_id) % 8 = 0 THEN 'resolved' WHEN max(event_id) % 4 = 0 THEN 'dismissed' ELSE 'pending' END AS state FROM e GROUP BY 1",
    "context_nodes": f"{NODES_SQL} SELECT * FROM nodes",
    "broken_nodes": f"{NODES_SQL}, kept AS (SELECT DISTINCT node_hash, parent_hash, atom_hash, depth FROM (SELECT * REPLACE (CASE WHEN conv_id % 10 = 4 AND depth = 0 THEN '0' ELSE atom_hash END AS atom_hash) FROM nodes WHERE NOT (conv_id % 10 = 3 AND depth = 1)) t), r AS (SELECT k.node_hash, CASE WHEN k.node_hash <> sha256(coalesce(k.parent_hash, 'root') || chr(0) || k.atom_hash) THEN 'hash' WHEN k.parent_hash IS NOT NULL AND NOT EXISTS (SELECT 1 FROM kept p WHERE p.node_hash = k.parent_hash) THEN 'no parent' END AS reason FROM kept k) SELECT reason, count(DISTINCT node_hash) AS nodes FROM r WHERE reason IS NOT NULL GROUP BY 1",
    "dialogues": f"{NODES_SQL} SELECT leaf_hash, max(length) AS length FROM (SELECT arg_max(node_hash, depth) AS leaf_hash, max(depth) + 1 AS length FROM nodes GROUP BY conv_id) t GROUP BY 1",
    "foreign_edges": f"{EVENTS_CTE} SELECT event_id AS id, CASE WHEN event_id % 50 = 0 OR (event_id - 1) % 50 = 0 THEN 'missing end' ELSE 'cross tenant' END AS reason FROM e WHERE event_id > 0 AND (event_id % 50 = 0 OR (event_id - 1) % 50 = 0 OR (event_id % 17 = 0) <> ((event_id - 1) % 17 = 0))",
    "locator_classes": "SELECT 'document' AS kind, CASE WHEN doc_id % 6 = 0 THEN 'gap' ELSE CASE WHEN text IS NULL THEN 'missing' ELSE 'content' END END AS class, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'page', CASE WHEN page_id % 4 = 0 THEN 'inline' ELSE 'missing' END, count(*) FROM pages GROUP BY ALL",
    "gap_candidates": f"{LOCATORS} SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 6 = 0 THEN 'gap' ELSE 'object absent' END AS reason FROM d WHERE doc_id % 6 = 0 OR (locator IS NOT NULL AND locator NOT IN (SELECT locator FROM d WHERE doc_id % 7 <> 0 AND locator IS NOT NULL))",
    "storage_classes": """SELECT CASE doc_id % 7 WHEN 0 THEN 'cache_candidate_requires_reference_and_retention_proof' WHEN 1 THEN 'protected_training_or_shared_cas' WHEN 3 THEN 'staging_requires_owner_fence'
  WHEN 4 THEN 'staging_requires_owner_fence' WHEN 5 THEN 'readiness_requires_owner_fence' ELSE 'unclassified_protected' END AS class, count(*) AS n, count(text) AS hex FROM documents GROUP BY 1""",
    "shards": "SELECT CAST(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS BIGINT) AS shard, count(*) AS n FROM orders GROUP BY 1",
    "chunk_problems": CHUNK_SQL, "multiset_digest": _multiset_sql(),
}
