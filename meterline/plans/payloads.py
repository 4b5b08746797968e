"""Queries of JSON payloads, blobs and references between objects, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline.functions import json_text
from meterline.operators import ancestry, blobs, references
from meterline.sources import tables
from meterline.sources.tables import duck


def canonical_json(spark, sf_dir):
    """Labels as JSON with fields out of order, nested objects, and numbers in more than one spelling; some are no strict JSON."""
    rows = tables.read(spark, sf_dir, "labels").select("doc_id", "quality")
    i, n = F.col("doc_id").cast("string"), F.col("doc_id") % 8
    usual = F.concat(F.lit('{ "z": 1.0, "b": {"y": null, "A": ['), i, F.lit(', 2.50, 1e3]}, "a": "\\u00e9", "q": '), F.when(F.col("quality") == 1, "true").otherwise("false"), F.lit("}"))
    text = (
        F.when(n == 1, F.concat(F.lit("[100000000000000016.0, 12345678901234567890"), F.lpad(i, 6, "0"), F.lit(", -0.0, 1E21, 0.0000001]")))
        .when(n == 2, F.concat(F.lit('{"a": 1, "'), F.when(F.col("quality") == 1, "a").otherwise("b"), F.lit('": 2}')))
        .when(n == 3, F.concat(F.lit("{'id': "), i, F.lit("}"))).when(n == 4, F.concat(F.lit("["), i, F.lit(", 1e999]")))
        .otherwise(usual)
    )
    return rows.select("doc_id", json_text.canonical(text).alias("c")).select("doc_id", F.col("c.json").alias("canonical"), "c.problem")


CANONICAL_SQL = """SELECT doc_id, CASE doc_id % 8
  WHEN 1 THEN '[100000000000000020,1.2345678901234568e+25,0,1e+21,1e-7]'
  WHEN 2 THEN CASE WHEN quality = 1 THEN NULL ELSE '{"a":1,"b":2}' END WHEN 3 THEN NULL WHEN 4 THEN NULL
  ELSE '{"a":"é","b":{"A":[' || doc_id || ',2.5,1000],"y":null},"q":' || CASE WHEN quality = 1 THEN 'true' ELSE 'false' END || ',"z":1}' END AS canonical,
  CASE WHEN doc_id % 8 = 2 AND quality = 1 THEN 'repeated key' WHEN doc_id % 8 = 3 THEN 'not JSON' WHEN doc_id % 8 = 4 THEN 'number out of range' END AS problem FROM labels"""

#: Blobs of the deep chain; from the 13th on a payload with it has more than 64 levels.
CHAIN = 15


def expanded_blobs(spark, sf_dir):
    """Payloads whose references have all four encodings and odd spacing; some lead to blobs that are absent, no gzip, in a circle, too deep, or of an unknown encoding."""
    tables.shared_checkpoints(spark)
    d = tables.read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    i = F.col("id").cast("string")
    sha = lambda kind, k=i: F.sha2(F.concat(F.lit(kind), k), 256)
    ref = lambda kind, encoding, k=i: F.concat(F.lit('{"$blob": "'), sha(kind, k), F.lit(f'", "encoding": "{encoding}"}}'))
    before = (F.col("id") - 1).cast("string")
    kinds = {
        "leaf": (d.where("id % 5 <> 0"), F.concat(F.lit(' "v'), i, F.lit('"\n'))),
        "text": (d, F.concat(F.lit('say "é'), i, F.lit('"'))),
        "tree": (d, F.concat(F.lit("["), ref("leaf", "json"), F.lit(" ,1]"))),
        "ring": (d.where("id % 7 = 3"), F.concat(F.lit("["), ref("back", "json"), F.lit("]"))),
        "back": (d.where("id % 7 = 3"), F.concat(F.lit('{"to":'), ref("ring", "json"), F.lit("}"))),
        "deep": (d.where(f"id < {CHAIN}"), F.when(F.col("id") == 0, "1").otherwise(F.concat(F.lit('{"n":[[['), ref("deep", "json", before), F.lit("]]]}")))),
    }
    held = None
    for kind, (rows, text) in kinds.items():
        some = rows.select(sha(kind).alias("hash"), F.when(F.col("id") % 2 == 0, "gzip").otherwise("none").alias("codec"), text.alias("text"))
        held = some if held is None else held.unionByName(some)
    held = held.select("hash", "codec", zipped(F.col("text"), F.col("codec")).alias("body"))
    broken = d.where("id % 13 = 0").select(sha("broken").alias("hash"), F.lit("gzip").alias("codec"), F.lit("no gzip").cast("binary").alias("body"))
    media = F.concat(F.lit('{"media_type":"text/plain" , "encoding":"data-url","$blob":"'), sha("text"), F.lit('"}'))
    text = F.concat(
        F.lit('{ "z" :'), ref("tree", "json"), F.lit(',"u":['), ref("text", "utf8"), F.lit(","), ref("text", "raw"), F.lit("],\n\t\"d\":"), media,
        F.when(F.col("id") % 7 == 3, F.concat(F.lit(',"c":'), ref("ring", "json"))).otherwise(""),
        F.when(F.col("id") % 13 == 0, F.concat(F.lit(',"b":'), ref("broken", "utf8"))).otherwise(""),
        F.when(F.col("id") % 11 == 0, F.concat(F.lit(',"e":'), ref("text", "zip"))).otherwise(""),
        F.when(F.col("id") < CHAIN, F.concat(F.lit(',"n":'), ref("deep", "json"))).otherwise(""), F.lit("}"),
    )
    out = blobs.expand_blobs(d.select("id", text.alias("text")), held.unionByName(broken))
    return out.select("id", F.sha2("text", 256).alias("sha256"), "complete", "problem")


def zipped(text, codec):
    import gzip

    from pyspark.sql.functions import pandas_udf

    return pandas_udf(lambda texts, codecs: texts.combine(codecs, lambda t, c: gzip.compress(t.encode(), mtime=0) if c == "gzip" else t.encode()), "binary")(text, codec)


_REF = "'{{\"$blob\":\"' || sha256('{0}' || id) || '\",\"encoding\":\"{1}\"}}'"
EXPANDED_SQL = f"""WITH RECURSIVE deep(k, j) AS (SELECT 0, '1' UNION ALL SELECT k + 1, '{{"n":[[[' || j || ']]]}}' FROM deep WHERE k < {CHAIN}),
d AS (SELECT doc_id AS id, 'say "é' || doc_id || '"' AS t FROM documents),
p AS (SELECT *, '"' || replace(t, '"', '\\"') || '"' AS q, CASE WHEN id BETWEEN 13 AND {CHAIN - 1} THEN 'too deep' WHEN id % 7 = 3 THEN 'cycle' WHEN id % 11 = 0 THEN 'unsupported encoding' WHEN id % 13 = 0 THEN 'bad blob' WHEN id % 5 = 0 THEN 'absent' END AS problem
  FROM d LEFT JOIN deep ON k = id)
SELECT id, CASE WHEN problem IS DISTINCT FROM 'too deep' THEN sha256('{{' || CASE WHEN id % 13 = 0 THEN '"b":' || {_REF.format('broken', 'utf8')} || ',' ELSE '' END
  || CASE WHEN id % 7 = 3 THEN '"c":' || {_REF.format('ring', 'json')} || ',' ELSE '' END || '"d":"data:text/plain;base64,' || base64(encode(t)) || '"'
  || CASE WHEN id % 11 = 0 THEN ',"e":' || {_REF.format('text', 'zip')} ELSE '' END || CASE WHEN id < {CHAIN} THEN ',"n":' || j ELSE '' END
  || ',"u":[' || q || ',' || q || '],"z":[' || CASE WHEN id % 5 <> 0 THEN '"v' || id || '"' ELSE {_REF.format('leaf', 'json')} END || ',1]}}') END AS sha256, problem IS NULL AS complete, problem FROM p"""


def reference_closure(spark, sf_dir):
    """Orders of some customers refer to others by halves of their keys, some to doubles; some are absent, foreign, referred to twice unlike, or lead in a circle."""
    tables.shared_checkpoints(spark)
    o = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"))
    objects = o.where("id % 29 <> 0").select("id", F.when(F.col("id") % 31 == 0, "b").otherwise("a").alias("tenant"))
    digest = F.when(F.col("id") % 37 == 0, "y").otherwise("x").alias("digest")
    refs = o.where("id > 1").select(F.col("id").alias("from_id"), F.floor(F.col("id") / 2).alias("to_id"), digest)
    refs = refs.unionByName(o.where("id % 640 = 0").select(F.col("id").alias("from_id"), (2 * F.col("id")).alias("to_id"), digest))
    return references.closure(o.where("id % 10 = 0").select("id", F.lit("a").alias("tenant")), refs, objects)


CLOSURE_SQL = """WITH RECURSIVE e AS (SELECT o_orderkey AS a, o_orderkey // 2 AS z, o_orderkey % 37 = 0 AS y FROM orders WHERE o_orderkey > 1
  UNION ALL SELECT o_orderkey, 2 * o_orderkey, o_orderkey % 37 = 0 FROM orders WHERE o_orderkey % 640 = 0),
f AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 10 = 0 UNION SELECT z FROM f JOIN e ON a = f.id),
c AS (SELECT x.a AS id FROM e x JOIN e w ON w.a = x.z AND w.z = x.a UNION SELECT a FROM c JOIN e ON z = c.id),
d AS (SELECT z AS id, count(DISTINCT y) AS n FROM e GROUP BY 1)
SELECT f.id, 'a' AS tenant, CASE WHEN o_orderkey IS NULL OR f.id % 29 = 0 THEN 'absent' WHEN f.id % 31 = 0 THEN 'other tenant' WHEN n > 1 THEN 'two digests' WHEN c.id IS NOT NULL THEN 'circle' ELSE '' END AS problem
FROM f LEFT JOIN orders ON o_orderkey = f.id LEFT JOIN d ON d.id = f.id LEFT JOIN c ON c.id = f.id"""

#: Each user's events as a chain; amounts plant faults.
NODES = """SELECT event_id AS id, user_id, CASE WHEN n > 1 THEN CASE WHEN cents % 997 = 0 THEN -event_id ELSE before END END AS parent, n + CASE WHEN cents % 499 = 0 THEN 1 ELSE 0 END AS event_count,
  CASE WHEN cents % 401 = 0 AND n > 2 THEN first ELSE name END AS event_id, CASE WHEN user_id % 9 = 0 THEN 'side' ELSE 'main' END AS branch_id, CASE WHEN n > 1 THEN CASE WHEN cents % 601 = 0 THEN later ELSE last END END AS parent_event_id
FROM (SELECT event_id, user_id, cents, name, row_number() OVER w AS n, lag(event_id) OVER w AS before, lag(name) OVER w AS last, first_value(name) OVER w AS first, lead(name) OVER w AS later
  FROM (SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) AS cents, 'e' || CAST(event_id AS STRING) AS name FROM {events}) e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)) t"""
HEADS = f"""SELECT head, user_id, CASE WHEN user_id % 17 = 0 THEN n + 1 ELSE n END AS event_count, CASE WHEN user_id % 23 = 0 THEN 'other' ELSE branch END AS branch_id,
  CASE WHEN user_id % 3 = 0 THEN CASE WHEN user_id % 2 = 0 THEN 'e' || CAST(first AS STRING) ELSE 'e-1' END END AS parent_event_id, CASE WHEN user_id % 3 = 0 AND user_id % 19 <> 0 THEN branch END AS parent_branch_id
FROM (SELECT user_id, CASE WHEN user_id % 29 = 0 THEN -max(id) ELSE max(id) END AS head, max_by(event_count, id) AS n, min(id) AS first, max_by(branch_id, id) AS branch FROM ({NODES}) n GROUP BY user_id) h"""


def chain_ancestry(spark, sf_dir):
    """Chains of events by user, and what is wrong with them."""
    tables.shared_checkpoints(spark)
    nodes, heads = (tables.view(spark, sf_dir, sql, "events").checkpoint() for sql in (NODES, HEADS))
    return ancestry.ancestry_problems(heads.drop("user_id"), nodes.drop("user_id"))


ANCESTRY_SQL = f"""WITH n AS ({duck(NODES)}), h AS ({duck(HEADS)}),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY id) AS place FROM n),
-- the chain of a head ends above at the last node whose parent is absent
top AS (SELECT user_id, max(CASE WHEN parent < 0 OR place = 1 THEN place END) AS first FROM c GROUP BY 1),
l AS (SELECT c.*, p.event_count AS above FROM c JOIN top USING (user_id) LEFT JOIN c p ON p.id = c.parent WHERE c.place >= top.first),
bad AS (SELECT user_id, 4 AS rank FROM l WHERE CASE WHEN parent IS NULL THEN event_count <> 1 ELSE above IS NULL OR event_count <> above + 1 END
  UNION ALL SELECT a.user_id, 6 FROM l a JOIN l b ON a.user_id = b.user_id AND a.event_id = b.event_id AND b.place < a.place
  UNION ALL SELECT a.user_id, 7 FROM l a WHERE parent_event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM l b WHERE b.user_id = a.user_id AND b.event_id = a.parent_event_id AND b.place < a.place)),
worst AS (SELECT user_id, min(rank) AS rank FROM bad GROUP BY 1),
own AS (SELECT h.head, CASE WHEN c.id IS NULL THEN 0 WHEN (h.parent_event_id IS NULL) <> (h.parent_branch_id IS NULL) THEN 1 WHEN c.event_count <> h.event_count THEN 2 WHEN c.branch_id <> h.branch_id THEN 5
    WHEN h.parent_event_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM l WHERE l.user_id = h.user_id AND l.event_id = h.parent_event_id AND l.branch_id = h.parent_branch_id) THEN 8 END AS mine, CASE WHEN c.id IS NOT NULL THEN rank END AS rank
  FROM h LEFT JOIN c ON c.id = h.head LEFT JOIN worst ON worst.user_id = h.user_id)
SELECT head, ['head missing', 'branch parent half set', 'count', 'circle', 'order', 'branch', 'identity', 'parent event', 'branch parent'][least(mine, rank) + 1] AS problem FROM own WHERE coalesce(mine, rank) IS NOT NULL"""

QUERIES = {"canonical_json": canonical_json, "expanded_blobs": expanded_blobs, "reference_closure": reference_closure, "chain_ancestry": chain_ancestry}
ORACLE_SQL = {"canonical_json": CANONICAL_SQL, "expanded_blobs": EXPANDED_SQL, "reference_closure": CLOSURE_SQL, "chain_ancestry": ANCESTRY_SQL}
