"""Archive files written from events with planted breaks, and the query that finds each with its place."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from meterline.operators import archive, graph, line_checks
from meterline.sources import tables
from meterline.sources.lines import numbered_lines
from meterline.sources.tables import FACTS, duck

#: Files; each holds the sessions of some users.
FILES = 8
#: About so many lines a task sorts and writes: a file comes in parts.
PART_LINES = 200_000
#: Lines by file (k), user and place: a summary at place 0, then records; amounts plant faults. said is the session that a record names.
LINES = f"""WITH e AS (SELECT event_id, user_id, user_id % {FILES} AS k, CAST(round(value * 100) AS BIGINT) AS cents, 'r' || CAST(1000000000 + event_id AS STRING) AS request FROM {{events}}),
records AS (SELECT k, user_id, event_id AS place, CASE WHEN cents % 97 = 0 THEN 'uX' ELSE 'u' || CAST(user_id AS STRING) END AS said, CASE WHEN cents % 89 = 0 THEN 'r0' ELSE request END AS request,
  CASE WHEN cents % 101 = 0 THEN 'not JSON' WHEN cents % 103 = 0 THEN 'repeated key' WHEN cents % 107 = 0 THEN 'bad record' WHEN cents % 109 = 0 THEN 'unsafe whole number' ELSE '' END AS fault FROM e),
summaries AS (SELECT k, user_id, CAST(-1 AS BIGINT) AS place, 'u' || CAST(user_id AS STRING) AS said, CAST(count(*) AS STRING) AS request, CASE WHEN user_id % 41 = 3 THEN 'bad summary' ELSE '' END AS fault FROM e GROUP BY k, user_id),
again AS (SELECT k, user_id, CAST(9000000000 AS BIGINT) AS place, said, '0' AS request, 'twice' AS fault FROM summaries WHERE user_id % 37 = 5)
SELECT k, user_id, place, said, request, fault, CASE WHEN place = 9000000000 THEN '{{{{"_mtc_delta_type":"session_summary","schema_version":2,"session_id":"' || said || '","requests":0,"last_at":"2024-01-02T00:00:00Z","deleted":true,"deleted_at":"2024-01-02T00:00:00Z"}}}}'
  WHEN place < 0 THEN '{{{{"_mtc_delta_type":"session_summary","schema_version":' || CASE WHEN fault = '' THEN '2' ELSE '1' END || ',"session_id":"' || said || '","requests":' || request || ',"first_at":"2024-01-01T00:00:00Z","last_at":"2024-01-02T00:00:00Z","records_sha256":"' || repeat('0a', 32) || '","deleted":false}}}}'
  ELSE '{{{{"schema_version":2,' || CASE fault WHEN 'repeated key' THEN '"model":"a","model":"b",' WHEN 'unsafe whole number' THEN '"status_code":9007199254740993,' ELSE '' END || '"session_id":"' || said || '","request_id":"' || request
    || '","started_at":"2024-01-01T00:00:00Z","completed_at":"' || CASE fault WHEN 'bad record' THEN '2023' ELSE '2024' END || '-01-01T00:00:01Z"' || CASE fault WHEN 'not JSON' THEN '' ELSE '}}}}' END END AS line
FROM (SELECT * FROM summaries UNION ALL SELECT * FROM records UNION ALL SELECT * FROM again) l"""


def session_breaks(spark, sf_dir):
    """Files of sessions by user, one in each folder, in parts; every break with its file, offset and reason."""
    tables.shared_checkpoints(spark)
    path = f"{spark.conf.get('spark.checkpoint.dir')}/lines-{uuid.uuid4().hex}"
    events = tables.read(spark, sf_dir, "events")
    rows = spark.sql(LINES, events=events)
    rows.repartitionByRange(max(FILES, events.count() // PART_LINES + 1), "k", "user_id", "place").sortWithinPartitions("k", "user_id", "place").select("k", "line").write.partitionBy("k").text(path)
    found = line_checks.session_breaks(numbered_lines(spark, path, parts=True))
    return found.select(F.regexp_extract("file", "/k=([0-9]+)/", 1).cast("long").alias("k"), "offset", "reason")


_LINES = duck(LINES).replace("{{", "{").replace("}}", "}")
BREAKS_SQL = f"""WITH l AS (SELECT *, row_number() OVER w AS n, sum(octet_length(encode(line)) + 1) OVER w - octet_length(encode(line)) - 1 AS spot FROM ({_LINES}) t WINDOW w AS (PARTITION BY k ORDER BY user_id, place)),
ok AS (SELECT *, place < 0 OR fault = 'twice' AS summary FROM l WHERE fault IN ('', 'twice')),
g AS (SELECT *, count(*) FILTER (WHERE summary) OVER w AS nth, lag(summary) OVER w AS before_summary, lag(request) OVER w AS before FROM ok WINDOW w AS (PARTITION BY k ORDER BY n)),
h AS (SELECT k, nth, said AS head, CAST(request AS BIGINT) AS requests, spot, row_number() OVER (PARTITION BY k, said ORDER BY n) AS times FROM g WHERE summary),
c AS (SELECT k, nth, count(*) AS n FROM g WHERE NOT summary GROUP BY 1, 2)
SELECT k, CAST(spot AS BIGINT) AS offset, reason FROM (
  SELECT k, spot, fault AS reason FROM l WHERE fault NOT IN ('', 'twice')
  UNION ALL SELECT g.k, g.spot, CASE WHEN head IS NULL THEN 'record without summary' WHEN head <> said THEN 'other session' WHEN NOT before_summary AND before >= request THEN 'order' END FROM g LEFT JOIN h ON h.k = g.k AND h.nth = g.nth WHERE NOT summary
  UNION ALL SELECT h.k, spot, 'count' FROM h LEFT JOIN c ON c.k = h.k AND c.nth = h.nth WHERE coalesce(n, 0) <> requests
  UNION ALL SELECT k, spot, 'session twice' FROM h WHERE times > 1) t WHERE reason IS NOT NULL"""


#: Letters of a chunk.
CHUNK = 97


def assembled_objects(spark, sf_dir):
    """Documents cut into chunks, put together again: some lack a chunk, some have two changed places, some headers are gone."""
    docs = tables.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("object_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = F.greatest(F.ceil(F.char_length("text") / CHUNK), F.lit(1)).cast("int")
    cut = docs.select("object_id", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr("text", i * CHUNK + 1, F.lit(CHUNK)))).alias("at", "part"))
    seq = F.when((F.col("object_id") % 13 == 0) & (F.col("at") < 2), 1 - F.col("at")).otherwise(F.col("at")).cast("long")
    chunks = cut.where("NOT (object_id % 17 = 0 AND at = 1)").select("object_id", seq.alias("seq"), F.encode("part", "UTF-8").alias("body"))
    headers = docs.where("object_id % 19 <> 0").select("object_id", n.cast("long").alias("chunks"), F.octet_length("text").cast("long").alias("bytes"), F.sha2("text", 256).alias("sha256"))
    return graph.assembled_problems(chunks, headers)


ASSEMBLED_SQL = f"""WITH d AS (SELECT doc_id AS id, coalesce(text, '') AS t, greatest((length(coalesce(text, '')) + {CHUNK - 1}) // {CHUNK}, 1) AS n FROM documents),
r AS (SELECT id, CASE WHEN id % 19 = 0 THEN 'no header' WHEN id % 17 = 0 AND n > 1 THEN 'count' WHEN id % 13 = 0 AND n = 1 THEN 'gap' WHEN id % 13 = 0 AND substr(t, 1, {CHUNK}) || substr(t, {CHUNK + 1}, {CHUNK}) <> substr(t, {CHUNK + 1}, {CHUNK}) || substr(t, 1, {CHUNK}) THEN 'digest' END AS reason FROM d)
SELECT id AS object_id, reason FROM r WHERE reason IS NOT NULL"""


def unlinked_requests(spark, sf_dir):
    """Requests out of associated quarantine versions; of two resolutions of one version the first counts."""
    e = tables.facts(spark, sf_dir).select(F.col("request_id").cast("long").alias("version"), "key_id", "created_at", "model", "cost_micros")
    versions = e.select((F.col("version") % 3000).alias("occurrence"), "version", F.col("model").alias("reason"))
    asked = e.where("cost_micros % 4 < 3").select((F.col("version") % 3000).alias("occurrence"), "version", F.when(F.col("cost_micros") % 4 == 0, "dismiss").otherwise("link").alias("action"), F.when(F.col("cost_micros") % 5 > 0, F.col("key_id")).alias("key_id"), F.col("created_at").alias("at"))
    later = asked.withColumn("action", F.when(F.col("action") == "link", "dismiss").otherwise("link")).withColumn("at", F.col("at") + F.when(F.col("version") % 2 == 0, 1).otherwise(-1))
    return archive.unlinked(versions, asked.unionByName(later.where("version % 3 = 0")))


UNLINKED_SQL = f"""WITH f AS (SELECT CAST(request_id AS BIGINT) AS v, * FROM ({duck(FACTS)}) t WHERE cost_micros % 4 < 3)
SELECT v % 3000 AS occurrence, v AS version, key_id, model AS reason FROM f WHERE cost_micros % 5 > 0 AND (cost_micros % 4 <> 0) = NOT (v % 3 = 0 AND v % 2 = 1)"""

QUERIES = {"session_breaks": session_breaks, "assembled_objects": assembled_objects, "unlinked_requests": unlinked_requests}
ORACLE_SQL = {"session_breaks": BREAKS_SQL, "assembled_objects": ASSEMBLED_SQL, "unlinked_requests": UNLINKED_SQL}
