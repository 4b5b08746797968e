"""Queries of published tables, sealed files, listings and batteries, each with the SQL that says the same."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterline.functions.scalars import DAY_MS, bucket
from meterline.operators import receipts
from meterline.operators.graph import multiset_digest
from meterline.sources import artifacts, listing, publish, tables
from meterline.sources.tables import FACTS, duck

DAILY = "key_id string, model string, requests long, cost_micros long, day_bucket long"


def _folder(spark, name: str) -> str:
    tables.shared_checkpoints(spark)
    return f"{spark.conf.get('spark.checkpoint.dir')}/{name}-{uuid.uuid4().hex}"


def _daily(facts):
    sums = facts.groupBy("key_id", "model", "day_bucket").agg(F.count("*").alias("requests"), F.sum("cost_micros").alias("cost_micros"))
    return sums.select("key_id", "model", "requests", "cost_micros", "day_bucket")


def scoped_rebuild(spark, sf_dir):
    """Daily sums as published, after costs were corrected and the days of all candidates were worked out anew; what a writer left that died before its manifest isn't seen."""
    root = _folder(spark, "daily")
    facts = tables.facts(spark, sf_dir).withColumn("day_bucket", bucket("created_at", DAY_MS))
    publish.publish_days(_daily(facts), root, "day_bucket")
    facts = facts.withColumn("cost_micros", F.col("cost_micros") + 1)
    _daily(facts).write.partitionBy("day_bucket").parquet(f"{root}/data/version=dead")
    candidates = facts.where("day_bucket % 3 = 0 AND cost_micros % 50 = 0")
    publish.rebuild(facts, candidates, root, "day_bucket", _daily)
    return publish.published(spark, root, DAILY, "day_bucket")


REBUILD_SQL = f"""WITH f AS (SELECT *, created_at // 86400000 AS day_bucket FROM ({duck(FACTS)}) t), touched AS (SELECT DISTINCT day_bucket AS d FROM f WHERE day_bucket % 3 = 0 AND (cost_micros + 1) % 50 = 0)
SELECT key_id, model, count(*) AS requests, CAST(sum(cost_micros + CASE WHEN d IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS cost_micros, day_bucket FROM f LEFT JOIN touched ON d = day_bucket GROUP BY key_id, model, day_bucket"""


def sealed_manifest(spark, sf_dir):
    """The manifest of sealed records, whose counters came with the write; agrees: a second look at the files finds the same digest."""
    path = _folder(spark, "sealed")
    rows = tables.facts(spark, sf_dir).select("session_id", "request_id", "created_at", "cost_micros")
    told = artifacts.seal(rows, path, session="session_id", fence="created_at")
    again = spark.read.schema(rows.schema).parquet(path)
    digest = F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256)
    seen = multiset_digest(again.select(digest.alias("d")), "d")
    same = (F.col("digest") == told["output_sha256"]) & (F.col("rows") == told["rows"])
    return seen.select(F.lit(told["rows"]).cast("long").alias("rows"), F.lit(told["sessions"]).cast("long").alias("sessions"), F.lit(told["fence"]).cast("long").alias("fence"), same.alias("agrees"))


#: Keys under which rows are stored, by class.
KEYS = ("raw-cache/a", "tenants/t/cas/v1", "tenants/t/other", "staging/x", "readiness")


#: Records of a file, and files that a group of rows fills.
PER_FILE, FILES = 100, 50


def in_full_files(rows, key, files=FILES):
    """rows dealt to tasks by groups that fill so many files of PER_FILE records; only the last group may leave one that isn't full. Places are counted by shards of the key."""
    shards = max(rows.count() // 1000, 1)
    rows = rows.withColumn("_shard", F.pmod(F.hash(key), F.lit(shards)))
    before = F.sum("count").over(Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1))  # a row a shard
    starts = rows.groupBy("_shard").count().select("_shard", F.coalesce(before, F.lit(0)).alias("_start"))
    placed = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("_shard").orderBy(key))).join(starts, "_shard")
    group = F.floor((F.col("_start") + F.col("_nth") - 1) / (files * PER_FILE))
    return placed.withColumn("_group", group).repartition("_group").drop("_shard", "_nth", "_start", "_group")


def object_listing(spark, sf_dir):
    """Objects and bytes by class of files that hold documents, a hundred in each, found by listing them."""
    root = _folder(spark, "objects")
    docs = tables.read(spark, sf_dir, "documents").select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("text"), (F.col("doc_id") % len(KEYS)).alias("k"))
    for k, key in enumerate(KEYS):
        rows = in_full_files(docs.where(F.col("k") == k), "doc_id").select(F.regexp_replace(F.base64("text"), r"\s", "").alias("value"))
        rows.write.option("maxRecordsPerFile", PER_FILE).text(f"{root}/{key}")
    return listing.by_class(listing.objects(spark, root)).select("class", "objects", "bytes")


LISTING_SQL = """WITH d AS (SELECT doc_id % 5 AS k, length(base64(encode(coalesce(text, '')))) + 1 AS n FROM documents), s AS (SELECT k, (count(*) + 99) // 100 AS objects, sum(n) AS bytes FROM d GROUP BY 1)
SELECT CASE k WHEN 0 THEN 'cache_candidate_requires_reference_and_retention_proof' WHEN 1 THEN 'protected_training_or_shared_cas' WHEN 2 THEN 'unclassified_protected' WHEN 3 THEN 'staging_requires_owner_fence' ELSE 'readiness_requires_owner_fence' END AS class,
  CAST(objects AS BIGINT) AS objects, CAST(bytes AS BIGINT) AS bytes FROM s"""


def battery(spark, sf_dir):
    """Twelve checks over five tables in one row."""
    read = lambda t: tables.read(spark, sf_dir, t)
    c = F.col
    return receipts.battery([
        (tables.facts(spark, sf_dir), {"facts": F.count("*"), "keys": F.countDistinct("key_id"), "failures": F.count_if(c("status_class") == "failure"), "fact_cost": F.sum("cost_micros")}),
        (read("orders"), {"orders": F.count("*"), "open_orders": F.count_if(c("o_orderstatus") == "O"), "orders_without_key": F.count_if(c("o_orderkey").isNull())}),
        (read("documents"), {"documents": F.count("*"), "empty_documents": F.count_if(F.coalesce(c("text"), F.lit("")) == "")}),
        (read("labels"), {"toxic": F.sum("toxic"), "labels": F.count("*")}),
        (read("customer"), {"indebted": F.count_if(c("c_acctbal") < 0)}),
    ])


BATTERY_SQL = f"""WITH f AS ({duck(FACTS)}) SELECT (SELECT count(*) FROM f) AS facts, (SELECT count(DISTINCT key_id) FROM f) AS keys, (SELECT count(*) FROM f WHERE status_class = 'failure') AS failures, (SELECT CAST(sum(cost_micros) AS BIGINT) FROM f) AS fact_cost,
  (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open_orders, (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS orders_without_key, (SELECT count(*) FROM documents) AS documents,
  (SELECT count(*) FROM documents WHERE coalesce(text, '') = '') AS empty_documents, (SELECT CAST(sum(toxic) AS BIGINT) FROM labels) AS toxic, (SELECT count(*) FROM labels) AS labels, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS indebted"""

QUERIES = {"scoped_rebuild": scoped_rebuild, "sealed_manifest": sealed_manifest, "object_listing": object_listing, "battery": battery}
ORACLE_SQL = {
    "scoped_rebuild": REBUILD_SQL, "object_listing": LISTING_SQL, "battery": BATTERY_SQL,
    "sealed_manifest": f"SELECT count(*) AS rows, count(DISTINCT session_id) AS sessions, max(created_at) AS fence, true AS agrees FROM ({duck(FACTS)}) t",
}
