"""Queries of snapshots, extraction, references and guards, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.operators import extraction, references, snapshots
from meterline.sources import tables
from meterline.sources.tables import duck

EVENTS = "SELECT event_id, {ms} AS at_ms, CAST(user_id AS STRING) AS key_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM {events}"
EVENTS_CTE = f"WITH e AS ({duck(EVENTS)})"


def _events(spark, sf_dir):
    return tables.view(spark, sf_dir, EVENTS, "events")


def _lines(spark, sf_dir):
    e = _events(spark, sf_dir)
    return e.select(F.col("key_id").alias("session_id"), F.col("event_id").alias("request_id"), F.concat_ws("|", F.col("event_id").cast("string"), "event_type", F.lit("\n")).alias("line"))


def ordered_digests(spark, sf_dir):
    return snapshots.ordered_digests(_lines(spark, sf_dir))


DIGESTS = f"{EVENTS_CTE}, d AS (SELECT key_id AS session_id, count(*) AS records, sha256(string_agg(event_id || '|' || event_type || '|' || chr(10), '' ORDER BY event_id)) AS sha256 FROM e GROUP BY 1)"


def chained_digests(spark, sf_dir):
    return snapshots.chained_digests(_lines(spark, sf_dir), "session_id", ("request_id",), "line")


CHAINED_SQL = f"""{EVENTS_CTE} SELECT key_id AS session_id, count(*) AS records,
  list_reduce(list_prepend('', list(event_id || '|' || event_type || '|' || chr(10) ORDER BY event_id)), lambda a, b: sha256(a || b)) AS sha256 FROM e GROUP BY 1"""


def session_set_digest(spark, sf_dir):
    """Sessions by user; those whose last event is an error are deleted."""
    e = _events(spark, sf_dir)
    rows = e.groupBy(F.col("key_id").alias("session_id")).agg(F.min("at_ms").alias("first_at"), F.max("at_ms").alias("last_at"), F.count("*").alias("requests"), (F.max_by("event_type", "event_id") == "error").alias("deleted"))
    rows = rows.withColumn("records_sha256", F.sha2("session_id", 256)).withColumn("deleted_at", F.col("last_at"))
    return snapshots.session_set_digest(rows)


SET_SQL = f"""{EVENTS_CTE}, s AS (SELECT key_id AS id, min(at_ms) AS a, max(at_ms) AS z, count(*) AS n, arg_max(event_type, event_id) = 'error' AS gone FROM e GROUP BY 1)
SELECT count(*) AS sessions, sha256('[' || string_agg(CASE WHEN gone THEN '{{"last_at":' || z || ',"requests":0,"session_id":"' || id || '","deleted":true,"deleted_at":' || z || '}}'
  ELSE '{{"first_at":' || a || ',"last_at":' || z || ',"records_sha256":"' || sha256(id) || '","requests":' || n || ',"session_id":"' || id || '"}}' END, ',' ORDER BY id) || ']') AS sha256 FROM s"""


def double_read(spark, sf_dir):
    """Two reads of the events; between them some went, came or changed."""
    e = _events(spark, sf_dir).select("event_id", F.sha2(F.concat_ws("|", "event_type", F.col("cents").cast("string")), 256).alias("digest"))
    again = e.where("event_id % 101 <> 0").withColumn("digest", F.when(F.col("event_id") % 103 == 0, "x").otherwise(F.col("digest")))
    new = e.where("event_id % 107 = 0").withColumn("event_id", F.col("event_id") + 1_000_000_000)
    return snapshots.changed_between(e, again.unionByName(new), "event_id", "digest")


DOUBLE_READ_SQL = f"""{EVENTS_CTE} SELECT event_id, CASE WHEN event_id % 101 = 0 THEN 'gone' ELSE 'changed' END AS reason FROM e WHERE event_id % 101 = 0 OR event_id % 103 = 0
UNION ALL SELECT event_id + 1000000000, 'new' FROM e WHERE event_id % 107 = 0"""


def beyond_clock(spark, sf_dir):
    return snapshots.beyond_clock(_events(spark, sf_dir).withColumn("done_ms", F.col("at_ms") + F.col("cents")), 1_704_500_000_000, 300_000, "at_ms", "done_ms").select("event_id")


def order_breaks(spark, sf_dir):
    """Sessions in the order of the source; some pairs stand the wrong way round."""
    o = tables.read(spark, sf_dir, "orders").select((F.col("o_orderkey") + F.when(F.col("o_orderkey") % 50 == 0, 1).when(F.col("o_orderkey") % 50 == 1, -1).otherwise(0)).alias("position"), F.col("o_orderkey").alias("k"))
    return snapshots.order_breaks(o.select("position", (F.lit(10**9) - F.floor(F.col("k") / 3)).alias("last_at"), F.lpad(F.col("k").cast("string"), 12, "0").alias("session_id")))


ORDER_SQL = """WITH o AS (SELECT o_orderkey AS k, o_orderkey + CASE o_orderkey % 50 WHEN 0 THEN 1 WHEN 1 THEN -1 ELSE 0 END AS position,
  1000000000 - o_orderkey // 3 AS last_at, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS session_id FROM orders)
SELECT b.position, b.session_id FROM o a JOIN o b ON b.position = a.position + 1
WHERE NOT (b.last_at < a.last_at OR (b.last_at = a.last_at AND b.session_id > a.session_id))"""


def seek_page(spark, sf_dir):
    """Fifty customers behind a place in the order of nation and key."""
    return snapshots.page_after(tables.read(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name"), ["c_nationkey", "c_custkey"], (7, 60), 50)


def latest_page(spark, sf_dir):
    return snapshots.latest_page(_events(spark, sf_dir).select("event_id", "at_ms", "key_id"), "at_ms", "event_id", 20)


#: Snapshots that come in, and the last ones taken, by source; each kind of fault occurs.
INCOMING = """
SELECT s_suppkey AS source, 'f' AS fingerprint, CASE s_suppkey % 13 WHEN 0 THEN CAST(0 AS BIGINT) WHEN 1 THEN CAST(1 AS BIGINT) ELSE CAST(4 AS BIGINT) END AS sequence,
  s_suppkey % 13 = 1 AS full, 'o4' AS output, CASE WHEN s_suppkey % 13 = 1 THEN NULL WHEN s_suppkey % 13 = 2 THEN 'x' ELSE 'o3' END AS prior_output,
  CASE WHEN s_suppkey % 13 = 1 THEN NULL ELSE CAST(7 AS BIGINT) END AS prior_fence,
  CASE WHEN s_suppkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS schema_version, CAST(9 AS BIGINT) AS fence,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL WHEN s_suppkey % 13 = 4 THEN CAST(8 AS BIGINT) ELSE CAST(5 AS BIGINT) END AS safe_fence FROM {supplier}"""
LAST = """
SELECT s_suppkey AS source, CASE WHEN s_suppkey % 13 = 5 THEN 'g' ELSE 'f' END AS fingerprint,
  CASE WHEN s_suppkey % 13 = 6 THEN CAST(4 AS BIGINT) ELSE CAST(3 AS BIGINT) END AS sequence, false AS full,
  CASE WHEN s_suppkey % 13 = 6 THEN 'o4' ELSE 'o3' END AS output, CASE WHEN s_suppkey % 13 = 6 THEN 'o3' ELSE 'o2' END AS prior_output,
  CASE WHEN s_suppkey % 13 = 6 THEN CAST(7 AS BIGINT) ELSE CAST(6 AS BIGINT) END AS prior_fence,
  CASE WHEN s_suppkey % 13 = 6 THEN CASE WHEN s_suppkey % 3 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(2 AS BIGINT) END WHEN s_suppkey % 2 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(2 AS BIGINT) END AS schema_version,
  CASE WHEN s_suppkey % 13 = 6 THEN CAST(9 AS BIGINT) ELSE CAST(7 AS BIGINT) END AS fence,
  CASE WHEN (s_suppkey % 13 = 6 AND s_suppkey % 3 <> 0) OR (s_suppkey % 13 <> 6 AND s_suppkey % 2 = 1) THEN CAST(5 AS BIGINT) END AS safe_fence
FROM {supplier} WHERE s_suppkey % 13 <> 1 AND s_suppkey % 13 <> 7"""


def chain_outcomes(spark, sf_dir):
    incoming, last = (tables.view(spark, sf_dir, sql, "supplier") for sql in (INCOMING, LAST))
    return snapshots.chain_outcome(incoming, last, incoming.where("source % 31 = 0").select("source"))


CHAIN_SQL = f"""WITH i AS ({duck(INCOMING)}), p AS ({duck(LAST)})
SELECT i.source, CASE WHEN i.sequence <= 0 OR i.fence < 0 OR (i.schema_version = 2) <> (i.safe_fence IS NOT NULL) OR coalesce(i.safe_fence < 0 OR i.safe_fence > i.fence, false) THEN 'invalid'
  WHEN i.schema_version = 2 AND i.source % 31 = 0 THEN 'rows lack provenance'
  WHEN p.source IS NULL THEN CASE WHEN i.full AND i.sequence = 1 AND i.prior_output IS NULL AND i.prior_fence IS NULL THEN 'baseline' ELSE 'no baseline' END
  WHEN i.fingerprint = p.fingerprint AND i.sequence = p.sequence AND i.full = p.full AND i.output = p.output AND i.prior_output IS NOT DISTINCT FROM p.prior_output
    AND i.prior_fence IS NOT DISTINCT FROM p.prior_fence AND i.schema_version = p.schema_version AND i.fence = p.fence AND i.safe_fence IS NOT DISTINCT FROM p.safe_fence THEN 'replay'
  WHEN NOT i.full AND i.fingerprint = p.fingerprint AND i.sequence = p.sequence + 1 AND i.prior_output IS NOT DISTINCT FROM p.output AND i.prior_fence IS NOT DISTINCT FROM p.fence AND i.fence >= p.fence
    AND NOT (p.schema_version = 2 AND (i.schema_version <> 2 OR i.safe_fence IS DISTINCT FROM p.safe_fence))
    AND NOT (p.schema_version = 1 AND i.schema_version = 2 AND coalesce(i.prior_fence < i.safe_fence, true)) THEN 'next' ELSE 'conflict' END AS outcome
FROM i LEFT JOIN p ON p.source = i.source"""


def generations(spark, sf_dir):
    e = _events(spark, sf_dir)
    return snapshots.generations(e.select(F.col("key_id").alias("session_id"), F.col("event_id").alias("sequence"), (F.col("event_type") == "error").alias("deleted")))


GENERATIONS_SQL = f"""{EVENTS_CTE}, g AS (SELECT *, event_type = 'error' AS d, coalesce(lag(event_type = 'error') OVER (PARTITION BY key_id ORDER BY event_id), true) AS b FROM e)
SELECT key_id AS session_id, count(*) FILTER (WHERE NOT d AND b) AS generations, count(*) FILTER (WHERE d AND NOT b) AS deletions, NOT arg_max(d, event_id) AS live FROM g GROUP BY 1"""

COUNTS = "SELECT s_nationkey AS source, count(*) AS records, count(DISTINCT s_name) AS sessions, sum(s_suppkey) AS bytes, max(s_suppkey) AS fence FROM {supplier} GROUP BY s_nationkey"


def recovery_preflight(spark, sf_dir):
    sealed = tables.view(spark, sf_dir, COUNTS, "supplier").withColumn("source", F.col("source").cast("long")).withColumn("bytes", F.col("bytes").cast("long"))
    n = F.col("source") % 5
    live = sealed.withColumn("records", F.when(n == 0, F.col("records") + 1).otherwise(F.col("records"))).withColumn("fence", F.when(n == 1, None).when(n == 2, F.col("fence") + 1).when(n == 3, F.col("fence") - 1).otherwise(F.col("fence")))
    return snapshots.preflight(sealed, live)


PREFLIGHT_SQL = """SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS source, CASE s_nationkey % 5 WHEN 0 THEN 'source counts changed' WHEN 1 THEN 'fences unknown'
  WHEN 2 THEN 'changed after the seal' WHEN 3 THEN 'fence went back' ELSE 'equal fences' END AS delta FROM supplier"""


def plan_problems(spark, sf_dir):
    e = _events(spark, sf_dir).where("event_type = 'error'")
    rows = e.select(F.col("event_id").alias("request_id"), F.col("at_ms").alias("created_at"))
    rows = rows.unionByName(rows.where("request_id % 10 = 0"))
    return snapshots.plan_problems(rows, 100, 1_704_200_000_000, 1_705_500_000_000, most=50)


PLAN_SQL = f"""{EVENTS_CTE}, r AS (SELECT * FROM e WHERE event_type = 'error' UNION ALL SELECT * FROM e WHERE event_type = 'error' AND event_id % 10 = 0)
SELECT greatest(count(*) - 50, 0) AS too_many, abs(count(*) - 100) AS told_wrong, count(*) - count(DISTINCT event_id) AS repeated,
  count(*) FILTER (WHERE at_ms < 1704200000000 OR at_ms >= 1705500000000) AS out_of_scope FROM r"""


def transition_problems(spark, sf_dir):
    c = tables.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("position"), F.lpad((F.col("c_custkey") - F.when(F.col("c_custkey") % 40 == 0, 1).otherwise(0)).cast("string"), 9, "0").alias("key_id"), (F.col("c_acctbal") > 0).alias("changes"))
    result = c.agg(F.count_if("changes").alias("changed"), (F.count_if(~F.col("changes")) + 2).alias("already"), F.count("*").alias("balances"), (F.count("*") - 1).alias("grants"))
    return snapshots.transition_problems(c, result)


TRANSITION_SQL = """WITH c AS (SELECT c_custkey AS p, c_custkey - CASE WHEN c_custkey % 40 = 0 THEN 1 ELSE 0 END AS k FROM customer)
SELECT (SELECT count(*) FROM c a JOIN c b ON b.p = a.p + 1 WHERE b.k <= a.k) AS out_of_order, CAST(0 AS BIGINT) AS changed_wrong, CAST(2 AS BIGINT) AS sum_wrong, CAST(1 AS BIGINT) AS preserved_wrong"""


def archive_usage(spark, sf_dir):
    """Protocol, tokens and error code of records whose JSON comes in every shape."""
    e = _events(spark, sf_dir)
    n, a, b = F.col("event_id") % 8, F.col("cents").cast("string"), (F.col("event_id") % 90).cast("string")
    pair = lambda x, y: F.concat(F.lit('{"input_tokens":'), x, F.lit(',"output_tokens":'), y, F.lit("}"))
    inner = F.concat(F.lit('{"response":{"usage":'), pair(a, b), F.lit('},"usage":'), pair(F.lit("1"), F.lit("1")), F.lit("}"))
    top = lambda x, y: F.concat(F.lit('{"usage":'), pair(x, y), F.lit("}"))
    response = F.when(n == 0, inner).when(n == 1, top(a, b)).when(n == 2, top(F.concat(F.lit('"'), a, F.lit('"')), b)).when(n == 3, top(F.lit("-1"), b)).when(n == 4, "{}").when(n == 5, '{"response":{"usage":7},"usage":{"input_tokens":1,"output_tokens":1}}').when(n == 6, None).otherwise("not json")
    path = F.when(F.col("event_id") % 4 == 0, F.lit(" /v1/x ")).otherwise(" ")
    facets = F.when(F.col("event_id") % 4 == 1, F.create_map(F.lit("request.path"), F.array(F.lit(" "), F.lit("/facet")))).when(F.col("event_id") % 4 == 3, F.create_map(F.lit("client"), F.array(F.lit("cli"))))
    metadata = F.when(F.col("event_id") % 12 == 2, '{"request_path":"/meta"}').otherwise('{"request_path":5e0}')
    outcome = F.when(F.col("event_type") == "error", "Bad request: é!").when(F.col("event_id") % 3 == 0, "Success").otherwise(" ")
    status = F.when(F.col("event_id") % 6 == 0, 502).otherwise(200)
    tokens = extraction.usage(response)
    return e.select("event_id", extraction.protocol(path, facets, metadata).alias("protocol"), tokens[0].cast("long").alias("input_tokens"), tokens[1].cast("long").alias("output_tokens"), F.coalesce(extraction.error_code(outcome, status), F.lit("")).alias("error_code"))


ARCHIVE_USAGE_SQL = f"""{EVENTS_CTE} SELECT event_id, CASE event_id % 4 WHEN 0 THEN '/v1/x' WHEN 1 THEN '/facet' WHEN 3 THEN 'cli' ELSE CASE WHEN event_id % 12 = 2 THEN '/meta' ELSE protocol END END AS protocol,
  CASE WHEN event_id % 8 IN (0, 1) AND cents >= 0 THEN cents ELSE 0 END AS input_tokens, CASE WHEN event_id % 8 IN (0, 1) AND cents >= 0 THEN event_id % 90 ELSE 0 END AS output_tokens,
  CASE WHEN event_type = 'error' THEN 'bad_request:___' WHEN event_id % 6 = 0 THEN 'http_502' ELSE '' END AS error_code FROM (SELECT *, 'session-archive' AS protocol FROM e) t"""


def archive_labels(spark, sf_dir):
    """Labels with forbidden keys, long values, numbers, and more than are kept."""
    e = _events(spark, sf_dir).where("event_id > 0")
    many = ",".join(f'"m{k:02d}":"v{k}"' for k in range(20))
    text = F.concat(F.lit('{"team":" t'), F.col("event_id").cast("string"), F.lit(' ","Api-Key":"x","n":5,"bad key":"y","empty":" ","long":"' + "v" * 129 + '"'), F.when(F.col("event_id") % 10 == 0, F.lit("," + many)).otherwise(""), F.lit("}"))
    return e.select("event_id", F.array_join(F.transform(F.map_entries(extraction.labels(text)), lambda x: F.concat_ws("=", x["key"], x["value"])), ",").alias("labels"))


ARCHIVE_LABELS_SQL = f"""{EVENTS_CTE} SELECT event_id, CASE WHEN event_id % 10 = 0 THEN '{",".join(f"m{k:02d}=v{k}" for k in range(16))}' ELSE 'team=t' || event_id END AS labels FROM e WHERE event_id > 0"""


def archive_overlap(spark, sf_dir):
    e = _events(spark, sf_dir).withColumn("done_ms", F.col("at_ms") + F.col("cents") * 10_000)
    return e.where(extraction.in_overlap(F.col("at_ms"), F.col("done_ms"), 1_705_000_000_000)).groupBy("event_type").agg(F.count("*").alias("n"))


def ordered_json(spark, sf_dir):
    """Customers of a nation as one JSON array in order, read back as rows."""
    rows = tables.read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("long").alias("nation"), F.col("c_custkey").cast("long").alias("id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"))
    arrays = extraction.json_array(rows, ["nation"], "id", "id", "name")
    back = extraction.recordset(arrays, "rows", "id bigint, name string", "nation", F.sha2("rows", 256).alias("sha256"))
    return back.groupBy("nation", "sha256").agg(F.count("*").alias("n"), F.count("name").alias("named"), F.sum("id").cast("long").alias("ids"))


ORDERED_JSON_SQL = """SELECT CAST(c_nationkey AS BIGINT) AS nation, sha256('[' || string_agg('{"id":' || c_custkey || ',"name":' || CASE WHEN c_custkey % 5 <> 0 THEN '"' || c_name || '"' ELSE 'null' END || '}', ',' ORDER BY c_custkey) || ']') AS sha256,
  count(*) AS n, count(*) FILTER (WHERE c_custkey % 5 <> 0) AS named, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer GROUP BY 1"""


def receipt_outcomes(spark, sf_dir):
    o = tables.read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("tenant"), F.col("o_orderkey").alias("request"))
    n = F.col("request") % 6
    receipts = o.select("tenant", "request", F.concat(F.lit("ref"), "request").alias("reference"), F.lit("m").alias("source_md5"), F.lit(10).cast("long").alias("size"))
    current = o.where("request % 6 <> 5").select(
        "tenant", "request", F.when(n == 0, 2).otherwise(1).alias("format"), F.when(n == 0, F.concat(F.lit("ref"), "request")).alias("reference"),
        F.when(n == 1, "other").otherwise("m").alias("stored_md5"), F.lit(10).cast("long").alias("stored_bytes"), F.when(n == 2, 11).otherwise(10).cast("long").alias("encoded_bytes"),
    )
    return references.receipt_outcome(receipts, current).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("request").cast("long").alias("requests"))


RECEIPT_SQL = """SELECT CASE WHEN o_orderkey % 6 = 0 THEN 'already' WHEN o_orderkey % 6 IN (3, 4) THEN 'eligible' ELSE 'skipped' END AS outcome, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS requests FROM orders GROUP BY 1"""


def read_back(spark, sf_dir):
    """Objects of a customer's orders: audits that repeat, that lack a receipt, whose row moved on, and rows with two receipts."""
    o = tables.read(spark, sf_dir, "orders").select(F.lit("t").alias("tenant"), F.col("o_orderkey").alias("request"), F.concat(F.lit("l"), "o_custkey").alias("locator"))
    n = F.col("request") % 10
    audit = o.select("tenant", "request", F.concat(F.lit("c"), "request").alias("receipt"), F.concat(F.lit("ref"), "request").alias("reference"), F.when(n == 0, "pending").otherwise("committed").alias("status"))
    again = audit.where(n == 1).withColumn("status", F.lit("committed_confirmed_by_reread"))
    second = audit.where(n == 2).withColumn("receipt", F.concat(F.lit("d"), "request"))
    receipts = o.where(n != 3).select(F.concat(F.lit("c"), "request").alias("receipt"), "locator", F.lit("b").alias("digest"), F.lit(1).alias("bytes"))
    receipts = receipts.unionByName(o.where(n == 2).select(F.concat(F.lit("d"), "request").alias("receipt"), "locator", F.lit("b").alias("digest"), F.lit(1).alias("bytes")))
    current = o.where(n != 4).select("tenant", "request", F.when(n == 5, "moved").otherwise(F.concat(F.lit("ref"), "request")).alias("reference"))
    return references.read_back(audit.unionByName(again).unionByName(second), receipts, current).select("locator", "members", "waiting", "conflicts")


READ_BACK_SQL = """SELECT 'l' || o_custkey AS locator, count(*) FILTER (WHERE o_orderkey % 10 IN (1, 6, 7, 8, 9)) AS members, count(*) FILTER (WHERE o_orderkey % 10 IN (4, 5)) AS waiting,
  count(*) FILTER (WHERE o_orderkey % 10 = 2) AS conflicts FROM orders WHERE o_orderkey % 10 NOT IN (0, 3) GROUP BY 1"""


def batch_report(spark, sf_dir):
    li = tables.read(spark, sf_dir, "lineitem").select(
        F.lit("t").alias("tenant"), F.col("l_orderkey").alias("request"), F.when(F.col("l_linenumber") % 2 == 0, "request").otherwise("response").alias("side"), F.col("l_partkey").alias("target"),
        (F.col("l_linenumber") == 3).alias("pending"), (F.col("l_linenumber") == 5).alias("bound"),
    )
    return references.batch_report(li)


BATCH_SQL = """SELECT count(*) AS references, count(DISTINCT l_partkey) AS targets, count(*) - count(DISTINCT l_partkey) AS repeats, count(*) FILTER (WHERE l_linenumber IN (3, 5)) AS forbidden,
  (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber % 2 HAVING count(*) > 1) t) AS repeated_identities FROM lineitem"""


def provenance(spark, sf_dir):
    """Suppliers as accounts: inactive ones, older generations and revoked credentials fall out."""
    s = tables.read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("id"))
    text = lambda p: F.concat(F.lit(p), F.col("id").cast("string"))
    requested = s.where("id % 11 <> 0").select(text("s").alias("source_id"), text("k").alias("source_key"))
    imports = s.select(F.when(F.col("id") % 7 == 0, "other").otherwise("managed").alias("kind"), text("k").alias("source_key"), F.sha2(text("k"), 256).alias("payload_digest"), text("a").alias("account_id"))
    accounts = s.select(text("a").alias("account_id"), F.when(F.col("id") % 5 == 0, "x").otherwise("codex").alias("driver"), F.when(F.col("id") % 3 == 0, "disabled").otherwise("active").alias("status"), (F.col("id") % 4).alias("generation"))
    credentials = s.crossJoin(spark.range(1, 4).toDF("generation")).select(text("a").alias("account_id"), "generation", F.when((F.col("id") + F.col("generation")) % 6 == 0, 1).alias("revoked_at"))  # three rows each
    return references.provenance(requested, imports, accounts, credentials, "managed", "codex").select("source_id", "account_id", "generation", "payload_digest")


PROVENANCE_SQL = """SELECT 's' || s_suppkey AS source_id, 'a' || s_suppkey AS account_id, CAST(s_suppkey % 4 AS BIGINT) AS generation, sha256('k' || s_suppkey) AS payload_digest FROM supplier
WHERE s_suppkey % 11 <> 0 AND s_suppkey % 7 <> 0 AND s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 4 >= 1 AND (s_suppkey + s_suppkey % 4) % 6 <> 0"""


def gap_replacements(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("gap://u/"), "doc_id")).otherwise(F.concat(F.lit("o/"), "doc_id")).alias("now"))
    new = F.when(F.col("doc_id") % 4 == 0, None).when(F.col("doc_id") % 5 == 0, F.concat(F.lit("o/"), "doc_id")).otherwise("n")
    after, refused = references.gap_replacement(F.col("now"), new)
    return rows.select("doc_id", after.alias("locator"), refused.alias("refused"))


GAP_SQL = """WITH d AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'gap://u/' || doc_id ELSE 'o/' || doc_id END AS now, CASE WHEN doc_id % 4 = 0 THEN NULL WHEN doc_id % 5 = 0 THEN 'o/' || doc_id ELSE 'n' END AS new FROM documents)
SELECT doc_id, CASE WHEN new IS NOT NULL AND (now LIKE 'gap://%' OR now = new) THEN new ELSE now END AS locator, new IS NOT NULL AND NOT (now LIKE 'gap://%' OR now = new) AS refused FROM d"""


def route_names(spark, sf_dir):
    p = tables.read(spark, sf_dir, "part")
    n = F.col("p_partkey") % 6
    prefix = F.when(n == 0, " /team/ ").when(n == 1, "a/b").when(n == 2, "//").when(n == 3, None).otherwise("x")
    alias = F.when(n < 3, F.concat(F.lit(" "), "p_brand", F.lit(" "))).when(n == 4, " ")
    return p.groupBy(references.route_alias(alias, F.col("p_type")).alias("alias"), F.coalesce(references.route_prefix(prefix), F.lit("-")).alias("prefix")).agg(F.count("*").alias("n"))


ROUTE_NAMES_SQL = """SELECT CASE WHEN p_partkey % 6 < 3 THEN p_brand ELSE p_type END AS alias, CASE p_partkey % 6 WHEN 0 THEN 'team' WHEN 1 THEN '-' WHEN 2 THEN '-' WHEN 3 THEN '-' ELSE 'x' END AS prefix, count(*) AS n FROM part GROUP BY 1, 2"""


def clusters(spark, sf_dir):
    e = _events(spark, sf_dir)
    seen = e.select(F.col("event_id").alias("id"), (F.col("event_id") % 50).alias("key_id"), (F.col("event_id") % 350).alias("cluster_id"), F.when(F.col("event_id") % 3 == 0, F.col("key_id")).alias("session_id"), F.col("at_ms").alias("created_at"))
    edges = e.select((F.col("event_id") - F.when(F.col("event_id") % 2 == 0, 50).otherwise(1)).alias("from_id"), F.col("event_id").alias("to_id"), F.when(F.col("event_id") % 5 == 0, "explicit").otherwise("candidate").alias("relation_kind"))
    return references.clusters(seen, edges)


CLUSTERS_SQL = f"""{EVENTS_CTE}, o AS (SELECT event_id AS id, event_id % 50 AS key_id, event_id % 350 AS cluster_id, CASE WHEN event_id % 3 = 0 THEN key_id END AS session_id, at_ms FROM e),
n AS (SELECT event_id % 50 AS key_id, event_id % 350 AS cluster_id, count(*) AS n FROM e WHERE event_id % 2 = 0 AND event_id % 5 <> 0 AND event_id - 50 IN (SELECT event_id FROM e) GROUP BY 1, 2)
SELECT key_id, cluster_id, min(session_id) AS session_id, max(at_ms) AS updated_at, count(*) AS requests, coalesce(max(n), 0) AS candidate_edges FROM o LEFT JOIN n USING (key_id, cluster_id) GROUP BY 1, 2"""


def cohorts(spark, sf_dir):
    p = tables.read(spark, sf_dir, "part").select(F.col("p_brand").alias("model"), F.col("p_type").alias("key_hash"))
    told = p.groupBy("model").agg(F.countDistinct("key_hash").alias("expected")).withColumn("expected", F.when(F.col("model").endswith("3"), 0).otherwise(F.col("expected"))).where("model NOT LIKE '%4'")
    return references.cohorts(p, told)


COHORTS_SQL = "SELECT p_brand AS model, count(DISTINCT p_type) AS keys, CAST(0 AS BIGINT) AS expected FROM part WHERE p_brand LIKE '%3' OR p_brand LIKE '%4' GROUP BY 1"


def import_stats(spark, sf_dir):
    n = F.col("event_id")
    return references.import_stats(_events(spark, sf_dir).select((n % 7 != 0).alias("eligible"), (n % 3 == 0).alias("mapped"), (n % 5 == 0).alias("quarantined"), (n % 2 == 0).alias("replayed")))


STATS_SQL = """SELECT count(*) AS scanned, count(*) FILTER (WHERE event_id % 7 <> 0) AS eligible, count(*) FILTER (WHERE event_id % 7 = 0) AS before_overlap, count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 3 = 0) AS mapped,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 3 <> 0 AND event_id % 5 <> 0) AS unmapped, count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 5 = 0) AS quarantined,
  count(*) FILTER (WHERE event_id % 7 <> 0 AND event_id % 3 = 0 AND event_id % 2 = 0) AS replayed FROM events"""


def capture_digests(spark, sf_dir):
    files = tables.read(spark, sf_dir, "pages").select((F.col("page_id") % 20).alias("capture"), F.lpad(F.col("page_id").cast("string"), 9, "0").alias("path"), F.sha2(F.coalesce("url", F.lit("")), 256).alias("sha256"))
    return references.capture_digest(files)


CAPTURE_SQL = """SELECT page_id % 20 AS capture, count(*) AS files, sha256('{"version":1,"auth":[' || string_agg('{"path":"' || lpad(CAST(page_id AS VARCHAR), 9, '0') || '","sha256":"' || sha256(coalesce(url, '')) || '"}', ',' ORDER BY page_id) || ']}' || chr(10)) AS digest FROM pages GROUP BY 1"""


def guarded_reset(spark, sf_dir):
    """What is left of orders without an import's own, and the guards that forbid it, as rows of one kind."""
    o = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    owned = o.where("id % 3 = 0").select("id")
    guards = {"open work": o.where("o_orderstatus = 'P' AND id % 3 = 0"), "foreign rows": o.where("id % 3 = 0 AND id < 0")}
    left, held = references.reset(o, owned, ["id"], guards)
    return left.agg(F.count("*").alias("rows")).select(F.lit("left").alias("guard"), "rows").unionByName(held)


RESET_SQL = """SELECT * FROM (SELECT 'left' AS guard, count(*) FILTER (WHERE o_orderkey % 3 <> 0) AS rows FROM orders
UNION ALL SELECT 'open work', count(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 3 = 0) t WHERE guard = 'left' OR rows > 0"""


QUERIES = {
    "ordered_digests": ordered_digests, "chained_digests": chained_digests, "session_set_digest": session_set_digest, "double_read": double_read, "beyond_clock": beyond_clock, "order_breaks": order_breaks,
    "seek_page": seek_page, "latest_page": latest_page, "chain_outcomes": chain_outcomes, "generations": generations, "recovery_preflight": recovery_preflight, "plan_problems": plan_problems,
    "transition_problems": transition_problems, "archive_usage": archive_usage, "archive_labels": archive_labels, "archive_overlap": archive_overlap, "ordered_json": ordered_json,
    "receipt_outcomes": receipt_outcomes, "read_back": read_back, "batch_report": batch_report, "provenance": provenance, "gap_replacements": gap_replacements, "route_names": route_names,
    "clusters": clusters, "cohorts": cohorts, "import_stats": import_stats, "capture_digests": capture_digests, "guarded_reset": guarded_reset,
}
ORACLE_SQL = {
    "ordered_digests": f"{DIGESTS} SELECT * FROM d", "chained_digests": CHAINED_SQL, "session_set_digest": SET_SQL, "double_read": DOUBLE_READ_SQL,
    "beyond_clock": f"{EVENTS_CTE} SELECT event_id FROM e WHERE greatest(at_ms, at_ms + cents) > 1704500000000 + 300000", "order_breaks": ORDER_SQL,
    "seek_page": "SELECT c_nationkey, c_custkey, c_name FROM customer WHERE (c_nationkey, c_custkey) > (7, 60) ORDER BY 1, 2 LIMIT 50",
    "latest_page": f"{EVENTS_CTE} SELECT event_id, at_ms, key_id, (SELECT count(*) FROM e) > 20 AS has_more FROM e ORDER BY at_ms DESC, event_id DESC LIMIT 20",
    "chain_outcomes": CHAIN_SQL, "generations": GENERATIONS_SQL, "recovery_preflight": PREFLIGHT_SQL, "plan_problems": PLAN_SQL, "transition_problems": TRANSITION_SQL, "archive_usage": ARCHIVE_USAGE_SQL,
    "archive_labels": ARCHIVE_LABELS_SQL, "archive_overlap": f"{EVENTS_CTE} SELECT event_type, count(*) AS n FROM e WHERE at_ms >= 1705000000000 OR at_ms + cents * 10000 >= 1705000000000 GROUP BY 1",
    "ordered_json": ORDERED_JSON_SQL, "receipt_outcomes": RECEIPT_SQL, "read_back": READ_BACK_SQL, "batch_report": BATCH_SQL, "provenance": PROVENANCE_SQL,
    "gap_replacements": GAP_SQL, "route_names": ROUTE_NAMES_SQL, "clusters": CLUSTERS_SQL, "cohorts": COHORTS_SQL, "import_stats": STATS_SQL,
    "capture_digests": CAPTURE_SQL, "guarded_reset": RESET_SQL,
}
