"""The driver's tables, and the relations of metered usage as views over them.

A view is one SELECT that Spark and DuckDB both run, so an operator and its oracle start from the same rows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

EVENTS_MS = {"spark": "CAST(unix_millis(CAST(ts AS TIMESTAMP)) AS BIGINT)", "duckdb": "epoch_us(ts) // 1000"}
DAYS = {"spark": "CAST(datediff(CAST(o_orderdate AS DATE), DATE'1970-01-01') AS BIGINT)", "duckdb": "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT)"}

#: The joins under USAGE. Spark meets orders last, so events come to lie by order.
USAGE_JOINS = {"spark": "{lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {orders} ON l_orderkey = o_orderkey", "duckdb": "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey"}

#: Raw usage events: one per order line, with models, service tiers and cache modes derived from it.
USAGE = """
SELECT {more}md5(CAST(l_orderkey AS STRING) || '|' || CAST(l_partkey AS STRING) || '|' || CAST(l_suppkey AS STRING) || '|' || CAST(l_linenumber AS STRING)
           || '|' || CAST(CAST(l_quantity AS BIGINT) AS STRING) || '|' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING) || l_returnflag) AS event_hash,
  {days} * 86400000 + l_linenumber * 3600000 + l_orderkey % 3600 * 1000 AS timestamp_ms,
  CAST(o_custkey AS STRING) AS api_key_hash,
  CASE l_linestatus WHEN 'F' THEN 'anthropic' ELSE CASE WHEN l_suppkey % 5 = 0 THEN 'openai-image' ELSE '' END END AS provider,
  p_brand AS model,
  CASE WHEN p_brand = 'Brand#7' THEN 'lab/gpt-5.5' WHEN p_brand = 'Brand#11' THEN 'gpt-5.4-2026' WHEN l_returnflag = 'A' THEN '' WHEN l_returnflag = 'N' THEN 'alias/' || p_brand ELSE p_brand END AS resolved_model,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'priority' WHEN '2-HIGH' THEN ' Fast ' WHEN '3-MEDIUM' THEN '' WHEN '4-NOT SPECIFIED' THEN 'flex' ELSE CASE WHEN l_partkey % 97 = 0 THEN 'gold' ELSE 'auto' END END AS service_tier,
  CAST(l_quantity AS BIGINT) * CASE WHEN l_quantity >= 46 THEN 6000 ELSE 10 END + 100 AS input_tokens,
  l_partkey % 37 AS output_tokens, CAST(0 AS BIGINT) AS reasoning_tokens, l_suppkey % 15 AS cached_tokens, l_suppkey % 7 AS cache_tokens,
  CAST(l_linenumber AS BIGINT) AS cache_read_tokens, CAST(l_linenumber % 3 AS BIGINT) AS cache_creation_tokens,
  CASE WHEN l_linenumber = 7 AND l_partkey % 11 = 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS skew,
  l_linestatus = 'O' AS separate_cache,
  l_partkey * 37 % 70000 AS latency_ms,
  CASE WHEN l_returnflag = 'R' AND l_linenumber <= 2 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS failed,
  CASE WHEN l_suppkey % 3 = 0 THEN CAST(429 AS BIGINT) WHEN l_suppkey % 3 = 1 THEN CAST(200 AS BIGINT) END AS fail_status_code
FROM {joins}"""

NORMALISED = """
SELECT u.*, residual AS residual_cached_tokens,
  CASE WHEN separate_cache THEN input_tokens ELSE input_tokens - residual - cache_read_tokens - cache_creation_tokens END AS normalized_uncached_input_tokens,
  CASE WHEN separate_cache THEN input_tokens + residual + cache_read_tokens + cache_creation_tokens ELSE input_tokens END + skew AS normalized_total_input_tokens,
  residual + cache_read_tokens AS normalized_cache_read_tokens, cache_creation_tokens AS normalized_cache_creation_tokens,
  input_tokens + output_tokens AS total_tokens
FROM (SELECT *, GREATEST(GREATEST(cached_tokens, cache_tokens) - cache_read_tokens - cache_creation_tokens, CAST(0 AS BIGINT)) AS residual FROM ({usage}) raw) u"""

BRANDS = "SELECT DISTINCT p_brand AS model, CAST(substr(p_brand, 7) AS BIGINT) AS b FROM {part}"
MONEY = "CAST({} AS DECIMAL(18,6))"


def _prices(scale: str) -> str:
    per = {"prompt": "b * 0.25", "completion": "b * 0.75", "cache": "b % 4 * 0.05", "cache_read": "b % 3 * 0.025", "cache_creation": "b % 5 * 0.3"}
    return ", ".join(f"CAST(({v}) * {scale} AS DECIMAL(18,6)) AS {k}_per_1m" for k, v in per.items())


FLAGS = "CAST(1 AS BIGINT) AS prompt_configured, CAST(1 AS BIGINT) AS completion_configured, CAST(b % 2 AS BIGINT) AS cache_configured, CASE WHEN b % 3 > 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS cache_read_configured, CASE WHEN b % 5 > 0 THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS cache_creation_configured"
PRICES = f"SELECT model, {_prices('1.0')}, {FLAGS}, 'list' AS source FROM ({BRANDS}) t WHERE b <> 25"
CONTEXT_TIERS = f"SELECT model, CAST(threshold AS BIGINT) AS threshold_tokens, {_prices('(1.0 + threshold * 0.001)')}, {FLAGS} FROM ({BRANDS}) t CROSS JOIN (SELECT 150 AS threshold UNION ALL SELECT 400) h WHERE b % 5 = 0"
SERVICE_TIERS = f"SELECT model, mode, tier AS service_tier, {_prices('0.5')}, {FLAGS} FROM ({BRANDS}) t CROSS JOIN (SELECT 'fast' AS mode, 'priority' AS tier UNION ALL SELECT 'batch', 'flex') h WHERE b % 4 < 2"

#: Request facts: one per event.
FACTS = """
SELECT CAST(event_id AS STRING) AS request_id, CAST(user_id AS STRING) AS key_id, {ms} AS created_at, event_type AS model,
  CASE event_id % 4 WHEN 0 THEN 'anthropic' WHEN 1 THEN 'anthropic-messages' WHEN 2 THEN 'openai-image' ELSE 'openai-chat' END AS protocol,
  CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status_class,
  CASE WHEN event_type = 'error' THEN 'http_' || CAST(400 + event_id % 5 AS STRING) ELSE '' END AS error_code,
  CASE event_id % 3 WHEN 0 THEN 'default' WHEN 1 THEN 'priority' ELSE 'flex' END AS service_tier, 'USD' AS currency,
  CAST(round(value * 100) AS BIGINT) * (event_id % 7) AS duration_ms,
  100 + event_id % 211 AS input_tokens, event_id % 89 AS output_tokens, event_id % 31 AS cached_input_tokens, event_id % 13 AS cache_write_tokens,
  CAST(round(value * 100) AS BIGINT) AS cost_micros, CAST(user_id AS STRING) || ':' || CAST(event_id % 5 AS STRING) AS session_id
FROM {events}"""


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Tables that grow with the data.
LARGE = ("lineitem", "events", "orders", "documents")


def spread(df: DataFrame) -> DataFrame:
    """df dealt to all cores where it comes in fewer splits than there are; a table of many files is left as it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the folder that spark.checkpoint.dir names.

    Where it names none, a local session gets a folder of its own; elsewhere executors would share none, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder")
        root = "file://" + tempfile.mkdtemp(prefix="meterline-")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder (see shared_checkpoints). Lineage ends there, and its size is that of its files.

    A checkpoint keeps the size that its plan was thought to have. A loop of joins multiplies these guesses each round, until the number itself fills the driver.
    """
    path = f"{df.sparkSession.conf.get('spark.checkpoint.dir')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, *keys: str) -> DataFrame:
    """written() in buckets by keys, as many as a shuffle has parts: joins and groups by keys read them where they are, without a shuffle.

    Rows that lie by keys already are written as they lie (Spark leaves out a second shuffle), so a bucket is one file. Hex digests take half their length under zstd. The table has a
    name in the session's catalog, its files are in the shared folder.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    path, n = f"{spark.conf.get('spark.checkpoint.dir')}/{name}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *keys).write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(n, *keys).saveAsTable(name)
    return spark.table(name)


def view(spark: SparkSession, sf_dir: str, sql: str, *tables: str, more: str = "") -> DataFrame:
    """A view's SELECT over the driver's tables, in Spark. more are further columns of usage events, each followed by a comma."""
    sql = sql.replace("{usage}", USAGE).replace("{joins}", USAGE_JOINS["spark"]).replace("{more}", more).replace("{ms}", EVENTS_MS["spark"]).replace("{days}", DAYS["spark"])
    return spark.sql(sql, **{t: spread(read(spark, sf_dir, t)) if t in LARGE else read(spark, sf_dir, t) for t in tables})


def usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage events, and the order of each as order_key: they lie by it, and it follows from event_hash."""
    return view(spark, sf_dir, NORMALISED, "lineitem", "orders", "part", more="l_orderkey AS order_key, ")


def prices(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(view(spark, sf_dir, sql, "part") for sql in (PRICES, CONTEXT_TIERS, SERVICE_TIERS))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FACTS, "events")


def duck(sql: str) -> str:
    """The same SELECT for DuckDB."""
    sql = sql.replace("{usage}", USAGE).replace("{joins}", USAGE_JOINS["duckdb"]).replace("{more}", "").replace("{ms}", EVENTS_MS["duckdb"]).replace("{days}", DAYS["duckdb"])
    for table in ("lineitem", "orders", "part", "events", "customer", "conversations", "documents", "supplier", "nation", "region", "labels", "pages"):
        sql = sql.replace("{" + table + "}", table)
    return sql
