"""Queries of the stateful stream operators over events that arrive in parts, with late rows, each with the SQL of a batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.sources import tables
from meterline.sources.tables import duck
from meterline.streaming import state

EVENTS = "SELECT event_id AS seq, {ms} AS at_ms, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM {events}"
#: Parts in which rows arrive. Every ninth row comes one part late.
PARTS = 3

#: Claims of 4000 requests: those of one request mostly say the same.
CLAIMS = f"SELECT seq % 4000 AS request, at_ms, seq, CASE WHEN user_id % 3 = 0 THEN event_type ELSE 'same' END AS digest FROM ({EVENTS}) e"
#: Lines and decisions about 401 records; a line's number repeats now and then.
RECORDS = f"""SELECT seq % 401 AS record, at_ms, seq, CASE WHEN event_type = 'error' THEN 'resolve' ELSE 'record' END AS kind, user_id % 4 AS batch, seq % 9 AS line,
  CASE WHEN cents % 3 = 0 THEN 'a' WHEN cents % 3 = 1 THEN 'b' ELSE 'c' END AS digest, CASE WHEN user_id % 11 = 0 THEN 'moved' ELSE 'first' END AS session,
  CASE WHEN cents % 2 = 0 THEN 'link' ELSE 'dismiss' END AS action FROM ({EVENTS}) e"""
#: Steps of 300 chains: an error repeats the last step or skips one, a large amount breaks one of the rules.
STEPS = f"""SELECT source, at_ms, seq, CASE WHEN cents % 41 = 0 THEN 'other' ELSE 'print' END AS fingerprint, k AS sequence, k = 1 AS full, 'o' || CAST(k AS STRING) AS output,
  CASE WHEN k > 1 THEN 'o' || CAST(k - 1 AS STRING) END AS prior_output, CASE WHEN k > 1 THEN 10 * (k - 1) + CASE WHEN cents % 37 = 0 THEN 1 ELSE 0 END END AS prior_fence,
  CASE WHEN k < 4 THEN 1 ELSE 2 END AS schema_version, CASE WHEN cents % 43 = 0 THEN -1 ELSE 10 * k END AS fence, CASE WHEN k >= 4 THEN CAST(20 AS BIGINT) END AS safe_fence
FROM (SELECT source, at_ms, seq, cents, good + CASE WHEN event_type = 'error' AND cents % 2 = 0 THEN 2 ELSE 0 END AS k FROM
  (SELECT user_id % 300 AS source, at_ms, seq, cents, event_type,
    sum(CASE WHEN event_type <> 'error' AND cents % 37 <> 0 AND cents % 41 <> 0 AND cents % 43 <> 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END) OVER (PARTITION BY user_id % 300 ORDER BY at_ms, seq) AS good
   FROM ({EVENTS}) e) g) s"""


def _taken(spark: SparkSession, sf_dir: str, sql: str, key: str, processor: type[state.Ordered]) -> DataFrame:
    """What the processor says after all parts have arrived, each in a run of the stream of its own."""
    tables.shared_checkpoints(spark)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/stream-{uuid.uuid4().hex}"
    rows = tables.view(spark, sf_dir, sql, "events").withColumn(key, F.col(key).cast("long"))
    first, last = rows.agg(F.min("at_ms"), F.max("at_ms")).head()
    if first is None:
        return spark.createDataFrame([], f"{key} long, at_ms long, seq long, {processor.RESULT}")
    width = (last - first) // PARTS + 1
    part = F.least(F.floor((F.col("at_ms") - first) / width) + (F.col("seq") % 9 == 0).cast("int"), F.lit(PARTS - 1))
    for k in range(PARTS):
        rows.where(part == k).write.parquet(f"{folder}/in/{k}")
    # a row of no key that counts moves the watermark behind all others
    end = rows.limit(1).withColumn(key, F.lit(-1).cast("long")).withColumn("at_ms", F.lit(last + 4 * width))
    end.write.parquet(f"{folder}/in/{PARTS}")
    for k in range(PARTS + 1):  # one part more each time, as if the others had not been there yet
        paths = f"{folder}/in/{{{','.join(map(str, range(k + 1)))}}}"
        stream = spark.readStream.schema(rows.schema).parquet(paths)
        state.take(state.outcomes(stream, key, processor, f"{2 * width // 1000 + 1} seconds", max(width // 8, 1)), f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").where(F.col(key) >= 0)


def stream_claims(spark, sf_dir):
    return _taken(spark, sf_dir, CLAIMS, "request", state.Claims)


def stream_quarantine(spark, sf_dir):
    return _taken(spark, sf_dir, RECORDS, "record", state.Quarantine)


def stream_chains(spark, sf_dir):
    return _taken(spark, sf_dir, STEPS, "source", state.Chain)


QUERIES = {"stream_claims": stream_claims, "stream_quarantine": stream_quarantine, "stream_chains": stream_chains}
ORACLE_SQL = {
    "stream_claims": f"""WITH c AS (SELECT *, first_value(digest) OVER w AS held, first_value(seq) OVER w AS holder, row_number() OVER w AS n FROM ({duck(CLAIMS)}) t WINDOW w AS (PARTITION BY request ORDER BY at_ms, seq))
SELECT request, at_ms, seq, CASE WHEN n = 1 THEN 'claimed' WHEN digest = held THEN 'replay' ELSE 'conflict' END AS outcome, holder FROM c""",
    "stream_quarantine": f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY record ORDER BY at_ms, seq) AS n FROM ({duck(RECORDS)}) t),
l AS (SELECT *, kind = 'record' AND row_number() OVER (PARTITION BY record, batch, line, kind ORDER BY n) = 1 AS taken, first_value(digest || session) OVER (PARTITION BY record, batch, line, kind ORDER BY n) AS told FROM r),
born AS (SELECT record, digest, session, min(n) AS since, row_number() OVER (PARTITION BY record ORDER BY min(n)) AS version FROM l WHERE taken GROUP BY 1, 2, 3),
v AS (SELECT l.*, CASE WHEN born.since < n THEN version END AS known, CASE WHEN taken THEN version END AS head_here FROM l LEFT JOIN born USING (record, digest, session)),
h AS (SELECT *, last_value(head_here IGNORE NULLS) OVER (PARTITION BY record ORDER BY n) AS head, last_value(head_here IGNORE NULLS) OVER (PARTITION BY record ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v),
acts AS (SELECT record, known AS version, min(n) AS since, arg_min(action, n) AS done FROM h WHERE kind = 'resolve' AND known IS NOT NULL GROUP BY 1, 2)
SELECT h.record, h.at_ms, h.seq, CASE WHEN kind = 'record' THEN CASE WHEN NOT taken THEN CASE WHEN told = digest || session THEN 'replay' ELSE 'conflict' END
    WHEN known IS NULL THEN 'new' WHEN known = before THEN 'again' ELSE 'returned' END
  WHEN known IS NULL THEN 'not found' WHEN own.since = n THEN CASE action WHEN 'link' THEN 'resolved' ELSE 'dismissed' END WHEN own.done = action THEN 'replay' ELSE 'conflict' END AS outcome,
  head AS version, CASE WHEN head IS NULL THEN NULL WHEN top.since <= n THEN CASE top.done WHEN 'link' THEN 'resolved' ELSE 'dismissed' END ELSE 'pending' END AS state
FROM h LEFT JOIN acts own ON own.record = h.record AND own.version = h.known LEFT JOIN acts top ON top.record = h.record AND top.version = h.head""",
    "stream_chains": f"""WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY at_ms, seq) AS n FROM ({duck(STEPS)}) t),
j AS (SELECT source, at_ms, seq, n, {{'fingerprint': fingerprint, 'sequence': sequence, 'full': "full", 'output': "output", 'prior_output': prior_output, 'prior_fence': prior_fence,
    'schema_version': schema_version, 'fence': fence, 'safe_fence': safe_fence}} AS s FROM r),
walk AS (SELECT source, CAST(NULL AS BIGINT) AS at_ms, CAST(NULL AS BIGINT) AS seq, CAST(0 AS BIGINT) AS n, '' AS outcome, CASE WHEN false THEN any_value(s) END AS last FROM j GROUP BY source
  UNION ALL SELECT source, at_ms, seq, n, outcome, CASE WHEN outcome IN ('baseline', 'next') THEN s ELSE last END FROM (
    SELECT j.source, j.at_ms, j.seq, j.n, s, last, CASE
      WHEN s.sequence <= 0 OR s.fence < 0 OR (s.schema_version = 2) <> (s.safe_fence IS NOT NULL) OR coalesce(s.safe_fence < 0 OR s.safe_fence > s.fence, false) THEN 'invalid'
      WHEN last IS NULL THEN CASE WHEN s."full" AND s.sequence = 1 AND s.prior_output IS NULL AND s.prior_fence IS NULL THEN 'baseline' ELSE 'no baseline' END
      WHEN s = last THEN 'replay'
      WHEN NOT s."full" AND s.fingerprint = last.fingerprint AND s.sequence = last.sequence + 1 AND s.prior_output IS NOT DISTINCT FROM last."output" AND s.prior_fence IS NOT DISTINCT FROM last.fence AND s.fence >= last.fence
        AND CASE WHEN last.schema_version = 2 THEN s.schema_version = 2 AND s.safe_fence IS NOT DISTINCT FROM last.safe_fence ELSE s.schema_version = 1 OR coalesce(s.prior_fence >= s.safe_fence, false) END THEN 'next'
      ELSE 'conflict' END AS outcome
    FROM walk JOIN j ON j.source = walk.source AND j.n = walk.n + 1) t)
SELECT source, at_ms, seq, outcome, last.sequence AS last FROM walk WHERE n > 0""",
}
