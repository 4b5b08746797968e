"""Goldens and properties of rating, load, rollups, archives and streams."""

import random

import pytest
from pyspark.sql import functions as F

from meterline.functions import scalars
from meterline.operators import archive, graph, load, rating, rollups
from meterline.plans import ledgers, usage
from meterline.sources import artifacts, tables
from meterline.streaming import events

FLAGS = {f"{c}_configured": 1 for c in rating.COMPONENTS}


def price(prompt, completion, cache, read, creation, **more):
    from decimal import Decimal

    values = dict(zip(rating.COMPONENTS, (prompt, completion, cache, read, creation)))
    return {f"{k}_per_1m": Decimal(str(v)) for k, v in values.items()} | FLAGS | more


PRICE = ", ".join(f"{c}_per_1m decimal(18,6), {c}_configured long" for c in rating.COMPONENTS)


def rows_of(spark, schema, *rows):
    names = [c.split()[0] for c in schema.replace("decimal(18,6)", "decimal").split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


USAGE = "event_hash string, timestamp_ms long, model string, resolved_model string, service_tier string, input_tokens long, output_tokens long, reasoning_tokens long, cached_tokens long, cache_tokens long, cache_read_tokens long, cache_creation_tokens long, normalized_uncached_input_tokens long, normalized_total_input_tokens long, normalized_cache_read_tokens long, normalized_cache_creation_tokens long, total_tokens long"


def event(name, model, tier, raw, out, cached, read, creation, normal, **more):
    u, t, r, c = normal
    base = dict(event_hash=name, timestamp_ms=1, model=model, resolved_model="", service_tier=tier, input_tokens=raw, output_tokens=out, reasoning_tokens=0, cached_tokens=cached, cache_tokens=0, cache_read_tokens=read, cache_creation_tokens=creation)
    return base | dict(normalized_uncached_input_tokens=u, normalized_total_input_tokens=t, normalized_cache_read_tokens=r, normalized_cache_creation_tokens=c, total_tokens=raw + out) | more


def books(spark):
    base = rows_of(spark, f"model string, source string, {PRICE}", price(2, 4, 0.5, 0.25, 3, model="m", source="s"), price(2, 4, 0.5, 0.25, 3, model="plain", source="s"), price(1, 2, 0, 0, 0, model="gpt-5.5", source="s", cache_read_configured=0, cache_creation_configured=0))
    context = rows_of(spark, f"model string, threshold_tokens long, {PRICE}", price(10, 20, 1, 2, 12, model="m", threshold_tokens=100))
    service = rows_of(spark, f"model string, mode string, service_tier string, {PRICE}", price(3, 5, 0.6, 0.2, 4, model="m", mode="fast", service_tier="priority"))
    return base, context, service


def test_prices_of_unknown_size_dont_shuffle_events(spark):
    base, context, service = books(spark)
    unknown = base.unionByName(base.crossJoin(spark.range(1_000_000)).where("id < 0").drop("id"))  # thought to be large
    rated = rating.rate(rows_of(spark, USAGE, event("a", "m", "priority", 100, 10, 40, 0, 0, (60, 100, 40, 0))), unknown, context, service)
    assert "hashpartitioning(billing_model" not in rated._jdf.queryExecution().executedPlan().toString()
    assert [r.cost_micros for r in rated.collect()] == [254]


def test_costs_beyond_64_bits_and_below_zero(spark):
    base = rows_of(spark, f"model string, source string, {PRICE}", price(999_999_999, 999_999_999, 1, 1, 1, model="dear", source="s"))
    _, context, service = books(spark)
    n = 9_000_000_000
    rows = [event("wide", "dear", "", n, 0, 0, 0, 0, (n, n, 0, 0)), event("below", "dear", "", -1, 0, 0, 0, 0, (-3, -3, 0, 0)), event("edge", "dear", "", 3, 0, 0, 0, 0, (3, 3, 0, 0))]
    got = {r.event_hash: r.cost_micros for r in rating.rate(rows_of(spark, USAGE, *rows), base, context, service).collect()}
    assert got == {"wide": n * 999_999_999, "below": -3 * 999_999_999, "edge": 3 * 999_999_999}


def test_rating_goldens(spark):
    rows = [
        event("service", "m", "priority", 100, 10, 40, 0, 0, (60, 100, 40, 0)),
        event("context", "m", "default", 80, 5, 30, 20, 10, (80, 110, 20, 10)),
        event("base", "m", "auto", 10, 1, 0, 0, 0, (10, 10, 0, 0)),
        event("edge", "m", "", 100, 0, 0, 0, 0, (100, 100, 0, 0)),
        event("flex", "plain", "flex", 3, 0, 0, 0, 0, (3, 3, 0, 0)),
        event("long", "gpt-5.5", "", 300_000, 10, 0, 0, 0, (300_000, 300_000, 0, 0)),
        event("hurried", "gpt-5.5", "Fast", 100, 10, 0, 0, 0, (100, 100, 0, 0)),
        event("hurried-long", "gpt-5.5", "priority", 300_000, 10, 0, 0, 0, (300_000, 300_000, 0, 0)),
        event("unknown", "x", "", 1, 1, 0, 0, 0, (1, 1, 0, 0)),
        event("negative", "m", "", -1, 1, 0, 0, 0, (-1, -1, 0, 0)),
        event("incomplete", "m", "", 1, 1, 0, 0, 0, (None, None, None, None)),
        event("sum", "m", "", 1, 1, 0, 0, 0, (1, 5, 0, 0)),
        event("read", "m", "", 1, 1, 0, 0, 0, (1, 2, 1, 0)),
        event("tier", "m", "gold", 1, 1, 0, 0, 0, (1, 1, 0, 0)),
    ]
    got = {r["event_hash"]: (r["pricing_rule"], r["cost_micros"], r["validation_error"]) for r in rating.rate(rows_of(spark, USAGE, *rows), *books(spark)).collect()}
    assert got["service"] == ("service", 254, "") and got["context"] == ("context", 1060, "") and got["base"] == ("base", 24, "")
    assert got["edge"] == ("base", 200, "")
    assert got["flex"] == ("base", 3, "")
    assert got["long"] == ("legacy-long", 600_030, "") and got["hurried"] == ("base", 300, "")
    assert got["hurried-long"] == ("legacy-long-base", 600_030, "")
    assert got["unknown"] == ("zero-token", 0, "missing source model price")
    errors = {k: v[2] for k, v in got.items() if v[2]}
    assert errors["negative"] == "negative token dimension" and errors["incomplete"] == "cache-accounting migration is incomplete"
    assert errors["sum"] == "normalized input buckets do not sum to total input" and errors["tier"] == "unsupported effective service tier"
    assert errors["read"] == "cache-read normalization disagrees with source cache buckets"


def test_latency_bins_cover_once(spark):
    ms = spark.range(0, 70_000, 7).select(F.col("id").alias("ms"))
    row = ms.select(*scalars.latency_bins(F.col("ms"))).select(F.expr(" + ".join(rollups.BINS)).alias("n")).agg(F.min("n"), F.max("n")).first()
    assert tuple(row) == (1, 1)


def test_replay_loads_nothing(spark, sf_dir):
    new = load.requests(usage._accepted(spark, sf_dir), "t", "s")
    assert load.claim(new, new).count() == 0
    assert load.locator_conflicts(new.withColumn("created_at", F.col("created_at") + 1), new).count() == new.count()
    assert new.select("id").distinct().count() == new.count()


def test_daily_of_hours_is_daily_of_facts(spark, sf_dir):
    a, b = usage.analysis_daily(spark, sf_dir), usage.analysis_daily_of_facts(spark, sf_dir)
    assert a.exceptAll(b.select(a.columns)).count() == 0 and b.select(a.columns).exceptAll(a).count() == 0


def test_verify_finds_a_change(spark, sf_dir):
    from meterline.operators import refunds

    facts, entries, keys = tables.view(spark, sf_dir, ledgers.FACTS, "orders"), ledgers._plan(spark, sf_dir), ["key_id", "day_bucket"]
    right = refunds.rebuilt(facts, entries, keys)
    n = right.count()
    assert n > 0 and refunds.mismatches(right, right.withColumn("cost_micros", F.col("cost_micros") + 1), keys, "cost_micros").count() == n


def test_multiset_digest(spark, sf_dir):
    import hashlib

    words = [f"w{i % 7}" for i in range(50)]
    random.Random(1).shuffle(words)
    digests = [hashlib.sha256(w.encode()).hexdigest() for w in words]
    expected = format(sum(int(d, 16) for d in digests) % 2**256, "064x")
    assert graph.multiset_digest(spark.createDataFrame([(d,) for d in digests], "d string"), "d").first().digest == expected
    assert graph.multiset_digest(spark.createDataFrame([], "d string"), "d").first().digest == "0" * 64


def test_sealed_chain(spark, sf_dir, tmp_path):
    nation = tables.read(spark, sf_dir, "nation")
    first = artifacts.seal(nation, f"file://{tmp_path}/a", fence=1, watermark=10)
    second = artifacts.seal(nation.where("n_nationkey > 3"), f"file://{tmp_path}/b", first, fence=2, watermark=20)
    schema = "source string, sequence long, output_sha256 string, prior_output_sha256 string, watermark long, prior_watermark long, fence long, prior_fence long, full boolean"
    names = [c.split()[0] for c in schema.split(", ")]
    chain = lambda *ms: spark.createDataFrame([tuple(({"source": "s"} | m)[n] for n in names) for m in ms], schema)
    assert archive.chain_breaks(chain(first, second)).count() == 0
    assert [r.reason for r in archive.chain_breaks(chain(first, second | {"prior_output_sha256": "x"})).collect()] == ["prior digest"]
    assert [r.reason for r in archive.chain_breaks(chain(second)).collect()] == ["first is no full snapshot"]


def test_required_columns(spark, sf_dir):
    with pytest.raises(ValueError, match="absent"):
        artifacts.require_columns(tables.read(spark, sf_dir, "nation"), "n_name", "absent")


def test_streams(spark, tmp_path):
    folder, target = f"{tmp_path}/in", f"{tmp_path}/out"
    schema = "event_hash string, key_id string, timestamp_ms long, cost_micros long"
    day = scalars.DAY_MS

    def put(number, *rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)
        events.load_new(spark.readStream.schema(schema).json(folder), target, f"{tmp_path}/cp").awaitTermination()

    put(0, ("a", "k", day, 5), ("b", "k", day + 1, 7), ("a", "k", day, 5))
    put(1, ("b", "k", day + 1, 7), ("c", "k", 2 * day, 9))
    assert sorted(r.event_hash for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]
    stream = events.daily(spark.readStream.schema(schema).json(folder))
    query = stream.writeStream.format("memory").queryName("daily_use").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(tuple(r) for r in spark.table("daily_use").collect()) == [("k", 1, 2, 12), ("k", 2, 1, 9)]


def test_what_recordset_keeps_is_worked_out_once_an_array(spark):
    from pyspark.sql import functions as F

    from meterline.operators import extraction

    arrays = spark.range(2).repartition(2).select("id", F.lit('[{"a":1},{"a":null}]').alias("rows"), F.col("id").cast("string").alias("text"))
    back = extraction.recordset(arrays, "rows", "a bigint", "id", F.sha2("text", 256).alias("sha256"))
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.index("sha2(")  # below it, so before rows are made
    assert sorted((r.id, r.a) for r in back.collect() if r.a) == [(0, 1), (1, 1)] and back.count() == 4


def test_load_changed_rates_events_once(spark, sf_dir):
    plan = usage.load_changed(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "source_digest" in plan  # both sides read what was written
